"""A Merkle manifest of a dataset, its proofs spread by a butterfly exchange.

1. Every row becomes a leaf. Leaves are put in order by ranges, each tree (a value of ``group``) after the
   other, and get their place from the counts of the ranges before; no window runs over a whole tree.
2. A tree is cut into aligned blocks of ``fanout ** block_levels`` leaves. Each block hashes its own part.
3. The blocks are the members of a butterfly. In round r, groups of ``fanout ** r`` blocks that share an
   ancestor are dealt ``fanout`` by ``fanout``: a block sends the ancestor to its counterparts in the other
   groups, gets theirs, and hashes the next ancestor itself, as its neighbours do too. So each block gathers
   the siblings of its whole path on the way up, and nothing comes down again. Counterparts have the same
   offset; where the last group is smaller, its blocks take turns.
4. The trees' roots are leaves of one more tree. Its rounds go on in the same way, block by block.
5. A block then has its upper siblings. With its leaves it gives each row's proof.

What moves is a row of digests for each row, and for each block a path of at most ``fanout`` digests a level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitrec.storage import Scratch

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT, BLOCK_LEVELS = 8, 4

_PART_BITS = 33  # monotonically_increasing_id: the partition above, the row in it below


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values one after the other: byte count, a colon and the value, or ``-`` for a null."""
    texts = [value.cast("string") for value in values]
    parts = [F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def joined_digest(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, "").cast("binary"), 256)


def _hash(digests: Sequence[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def _levels(leaves: list[str], depth: int, fanout: int) -> list[list[str]]:
    """The leaves, then the nodes of each level above."""
    levels = [leaves]
    for _ in range(depth):
        below = levels[-1]
        levels.append([_hash(below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def _depth(leaves: int, fanout: int) -> int:
    depth = 0
    while leaves > 1:
        leaves, depth = -(-leaves // fanout), depth + 1
    return depth


def _in_order(leaves: DataFrame, scratch: Scratch) -> DataFrame:
    """Leaves with the number of their tree, their place in it and its size; trees are numbered in order."""
    order = [F.col(c).asc_nulls_first() for c in ("tree_key", "place_key", "leaf", "copy")]
    ranged = leaves.repartitionByRange(*order).sortWithinPartitions(*order).drop("copy")
    ranged = scratch.keep(ranged.withColumn("seq", F.monotonically_increasing_id()), "in-order")
    ranged = ranged.withColumn("part", F.shiftright("seq", _PART_BITS))
    # a row for each partition and tree in it
    counts = ranged.groupBy("part", "tree_key").agg(
        F.min("seq").alias("first"), F.count(F.lit(1)).alias("leaves")
    )
    counts = scratch.keep(counts, "counts")
    # number the trees: those that begin in earlier partitions come first
    begins = counts.groupBy("tree_key").agg(F.min("part").alias("begin"), F.sum("leaves").alias("size"))
    before = begins.groupBy("begin").agg(F.count(F.lit(1)).alias("trees"))
    running = F.sum("trees").over(_window(None, "begin")) - F.col("trees")
    before = before.select("begin", running.alias("trees_before"))  # a row for each partition
    rank = F.row_number().over(_window("begin", "tree_key"))
    trees = begins.join(before, "begin").select(
        F.col("tree_key").alias("key"), "size", (F.col("trees_before") + rank - 1).alias("tree")
    )
    offset = F.sum("leaves").over(_window("tree_key", "part")) - F.col("leaves")
    offsets = (
        counts.withColumn("offset", offset)
        .join(trees, F.col("tree_key").eqNullSafe(F.col("key")))
        .select(F.col("part").alias("p"), "key", "first", "offset", "tree", "size")
    )
    return ranged.join(
        offsets, (F.col("part") == F.col("p")) & F.col("tree_key").eqNullSafe(F.col("key"))
    ).select(
        "tree",
        (F.col("offset") + F.col("seq") - F.col("first")).alias("place"),
        "size",
        F.col("place_key").alias("id"),
        "leaf",
        "altered",
    )


def _window(partition: str | None, order: str):
    from pyspark.sql import Window

    by = F.col(order).asc_nulls_first()
    spec = Window.partitionBy(partition).orderBy(by) if partition else Window.orderBy(by)
    ranking = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranking


def _climb(own: Column, run: Column) -> tuple[Column, Column]:
    """The digest above a run of (number, digest), and the digests left and right of the own one."""

    def of(keep) -> Column:
        return F.array_join(F.transform(F.filter(run, keep), lambda x: x["digest"]), "")

    beside = F.struct(of(lambda x: x["number"] < own).alias("left"), of(lambda x: x["number"] > own).alias("right"))
    return joined_digest(F.transform(run, lambda x: x["digest"])), beside


def _exchange(blocks: DataFrame, fanout: int, step: int) -> DataFrame:
    """One round inside the trees; groups of ``step`` blocks share their digest.

    ``blocks``: tree, block, blocks (of the tree), digest, path (siblings so far). A message goes from every
    group to every block around it, from the block with the same offset, or in a smaller group from
    that with the offset modulo the group's size.
    """
    block, total = F.col("block"), F.col("blocks")
    offset, base = block % step, block - block % (step * fanout)
    own_size = F.least(F.lit(step).cast("long"), total - (block - offset))

    def targets(number: Column) -> Column:
        start = base + number * step
        size = F.least(F.lit(step).cast("long"), total - start)
        there = F.sequence(start + offset, start + size - 1, own_size)
        return F.when(offset < size, there).otherwise(F.array().cast("array<long>"))

    numbers = F.sequence(F.lit(0).cast("long"), F.lit(fanout - 1).cast("long"))
    sent = blocks.select(
        "tree",
        "blocks",
        "block",
        "path",
        F.struct((F.floor(block / step) % fanout).alias("number"), "digest").alias("message"),
        F.explode(F.flatten(F.transform(numbers, targets))).alias("to"),
    )
    own = F.col("block") == F.col("to")
    received = sent.groupBy("tree", "blocks", "to").agg(
        F.sort_array(F.collect_list("message")).alias("run"),
        F.first(F.when(own, F.col("path")), ignorenulls=True).alias("path"),
    )
    above, beside = _climb(F.floor(F.col("to") / step) % fanout, F.col("run"))
    done = F.col("blocks") <= step  # a tree whose root is known
    return received.select(
        "tree",
        "blocks",
        F.col("to").alias("block"),
        F.when(done, F.col("run")[0]["digest"]).otherwise(above).alias("digest"),
        F.when(done, F.col("path")).otherwise(F.concat("path", F.array(beside))).alias("path"),
    )


def _exchange_roots(blocks: DataFrame, fanout: int, step: int, trees: int) -> DataFrame:
    """One round above the trees: groups of ``step`` trees share their digest, each block of them holds it.

    A block asks a block of a counterpart tree, again by its own number modulo what is there.
    """
    sizes = blocks.filter("block = 0").select(F.col("tree").alias("from_tree"), F.col("blocks").alias("from_blocks"))
    tree = F.col("tree")
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(fanout - 1).cast("long"))
    asked = (
        blocks.select("tree", "blocks", "block", "subroot", "path", F.explode(numbers).alias("number"))
        .withColumn("start", tree - tree % (step * fanout) + F.col("number") * step)
        .filter(F.col("start") < trees)
        .withColumn(
            "from_tree",
            F.col("start") + tree % step % F.least(F.lit(step).cast("long"), F.lit(trees) - F.col("start")),
        )
        .join(sizes, "from_tree")
        .withColumn("from_block", F.col("block") % F.col("from_blocks"))
    )
    # the path goes with the block's own message alone
    asked = asked.withColumn("path", F.when(F.col("from_tree") == tree, F.col("path")))
    held = blocks.select(F.col("tree").alias("from_tree"), F.col("block").alias("from_block"), "digest")
    received = (
        asked.join(held, ["from_tree", "from_block"])
        .groupBy("tree", "blocks", "block", "subroot")
        .agg(
            F.sort_array(F.collect_list(F.struct("number", "digest"))).alias("run"),
            F.first("path", ignorenulls=True).alias("path"),
        )
    )
    above, beside = _climb(F.floor(tree / step) % fanout, F.col("run"))
    return received.select(
        "tree",
        "blocks",
        "block",
        "subroot",
        above.alias("digest"),
        F.concat("path", F.array(beside)).alias("path"),
    )


def prove(
    rows: DataFrame,
    columns: Sequence[str] = COLUMNS,
    group: str = "lang",
    order: str = "doc_id",
    altered: dict[str, Column] | None = None,
    fanout: int = FANOUT,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """The proof of every row, and whether it still leads to the root.

    A leaf is the SHA-256 of the row's ``columns``. Leaves of one ``group`` make a tree in ascending
    ``order``; while there are several nodes, each ``fanout`` consecutive ones become their hash, as do the rest
    at the end, even a single one. The trees' roots, ordered by group, make the root in the same way.
    ``altered`` replaces columns by what the rows hold now; a null there is a null value.

    Returns a row for each row: the ``order`` column, leaf, subroot, root, proof_sha256 (hash of the siblings
    level by level, left to right), folded_root (from the row as it is now and its siblings), verified.

    A null group is a tree of its own and comes first, null order values come first in their tree. Rows with
    equal order values are placed by their leaves, equal rows stand side by side. An empty table has no
    rows and no root. Further columns of any name are left out.
    """
    scratch = Scratch(rows.sparkSession, "merkle")
    original = [rows[f"`{c}`"] for c in columns]
    now = [(altered or {}).get(c, rows[f"`{c}`"]) for c in columns]
    leaves = rows.select(
        rows[f"`{group}`"].alias("tree_key"),
        rows[f"`{order}`"].alias("place_key"),
        leaf_digest(original).alias("leaf"),
        leaf_digest(now).alias("altered"),
        F.monotonically_increasing_id().alias("copy"),
    )
    # the wide rows are read once; all that follows works on digests
    leaves = scratch.keep(leaves, "leaves")
    placed = _in_order(leaves, scratch)
    width = fanout**block_levels
    blocks_of = F.ceil(F.col("size") / width).cast("long")
    placed = placed.withColumn("block", F.floor(F.col("place") / width)).withColumn("blocks", blocks_of)

    def root_of_block(group_rows: pd.DataFrame) -> pd.DataFrame:
        first = group_rows.iloc[0]
        leaves = group_rows.sort_values("place")["leaf"].tolist()
        depth = block_levels if first["blocks"] > 1 else _depth(len(leaves), fanout)
        digest = _levels(leaves, depth, fanout)[-1][0]
        return pd.DataFrame([[first["tree"], first["block"], first["blocks"], digest]])

    blocks = (
        placed.select("tree", "block", "blocks", "place", "leaf")
        .groupBy("tree", "block")
        .applyInPandas(root_of_block, "tree long, block long, blocks long, digest string")
    )
    blocks = scratch.keep(blocks, "blocks")
    largest, last_tree = blocks.agg(F.max("blocks"), F.max("tree")).first()
    blocks = blocks.withColumn("path", F.array().cast("array<struct<left:string,right:string>>"))
    step = 1
    while step < (largest or 0):
        blocks, step = _exchange(blocks, fanout, step), step * fanout
    blocks, step = blocks.withColumn("subroot", F.col("digest")), 1
    trees = (last_tree if last_tree is not None else -1) + 1
    if trees > 1:
        blocks = scratch.keep(blocks, "subroots")  # the next rounds read it several times
    while step < trees:
        blocks, step = _exchange_roots(blocks, fanout, step, trees), step * fanout
    paths = blocks.select("tree", "block", "subroot", F.col("digest").alias("root"), "path")

    def prove_block(group_rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        group_rows = group_rows.sort_values("place")
        leaves = group_rows["leaf"].tolist()
        depth = block_levels if group_rows["blocks"].iloc[0] > 1 else _depth(len(leaves), fanout)
        levels = _levels(leaves, depth, fanout)
        subroot, root = above["subroot"].iloc[0], above["root"].iloc[0]
        upper = [(x["left"], x["right"]) for x in above["path"].iloc[0]]
        ending = "".join(left + right for left, right in upper)
        proofs, folded = [], []
        for i, digest in enumerate(group_rows["altered"]):
            beside = []
            for nodes in levels[:-1]:
                start = i - i % fanout
                beside.append(("".join(nodes[start:i]), "".join(nodes[i + 1 : start + fanout])))
                i //= fanout
            proofs.append(_hash([*(left + right for left, right in beside), ending]))
            for left, right in beside + upper:
                digest = _hash((left, digest, right))
            folded.append(digest)
        return pd.DataFrame(
            {
                order: group_rows["id"].tolist(),
                "leaf": leaves,
                "subroot": subroot,
                "root": root,
                "proof_sha256": proofs,
                "folded_root": folded,
                "verified": [digest == root for digest in folded],
            }
        ).astype({order: group_rows["id"].dtype})

    id_type = rows.schema[order].dataType.simpleString()
    return (
        placed.select("tree", "block", "blocks", "place", "id", "leaf", "altered")
        .groupBy("tree", "block")
        .cogroup(paths.groupBy("tree", "block"))
        .applyInPandas(
            prove_block,
            f"`{order}` {id_type}, leaf string, subroot string, root string, proof_sha256 string,"
            " folded_root string, verified boolean",
        )
    )
