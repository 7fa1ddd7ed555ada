"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitrec.storage import Scratch


def components(links: DataFrame, scratch: Scratch, label: str = "components") -> DataFrame:
    """For links (a, b): node and component, the smallest node that can be reached.

    Each round takes the least label among the neighbours, then that label's own label, so long chains
    shrink by half. Rounds hand over through stored tables; nothing is collected.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = scratch.keep(both.distinct(), f"{label}-edges")
    labels = scratch.keep(
        edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")),
        f"{label}-0",
    )
    done, step = False, 0
    while not done:
        step += 1
        near = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = scratch.keep(
            labels.join(near, "node").select(
                "node", "component", F.least("component", "near").alias("lower")
            ),
            f"{label}-{step}-lower",
        )
        jump = lower.select(F.col("node").alias("lower"), F.col("lower").alias("lowest"))
        moved = scratch.keep(
            lower.join(jump, "lower").select(
                "node",
                F.least("lower", "lowest").alias("component"),
                (F.least("lower", "lowest") < F.col("component")).alias("changed"),
            ),
            f"{label}-{step}",
        )
        done = moved.filter("changed").isEmpty()
        labels = moved.select("node", "component")
    return labels
