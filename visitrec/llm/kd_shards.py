"""Sharding by a k-d tree over the metadata: near-equal bytes, similar documents side by side.

The root is all documents. A node that must make several shards is cut at a weighted median: along the
dimension in which it is widest, at the point that leaves each side the bytes of its share of the shards.
All nodes of a level are cut together. The median is found by counting bytes in bins and looking closer into
the bin that holds it, so a cut costs a few aggregations whose results have one row for each node and bin.
The tree has one node for each shard at most; rows walk down it as a constant, without a join.

Everything is DataFrame operations over narrow rows; texts are read once, for size and checksum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from visitrec.storage import Scratch

SHARDS = 40
#: Bins of one look, and looks. A place is ``PLACE_BITS`` of the dimension, then of a hash of doc_id.
BINS, LOOKS = 1 << 9, 6
#: A look is the last if the bin holds no more than this part of a shard.
FINE = 1 / 2000
PLACE_BITS, TIE_BITS = 24, 30
#: Rows numbered by one task.
CHUNK_ROWS = 20_000

#: Dimension, last place before the cut, and the node that takes the places behind it.
Cut = tuple[int, int, int]


def _levels(shards: int) -> list[list[tuple[int, int]]]:
    """For each level, the nodes that are cut, as ranges of shards."""
    level, out = [(0, shards)], []
    while level := [(a, b) for a, b in level if b - a > 1]:
        out.append(level)
        level = [half for a, b in level for half in ((a, (a + b) // 2), ((a + b) // 2, b))]
    return out


def _place(value: Column, low: Column, high: Column) -> Column:
    """Where a value lies between the least and the greatest of all, as a whole number; null is least."""
    share = F.when(high > low, (value - low) / (high - low)).otherwise(F.lit(0.0))
    top = (1 << PLACE_BITS) - 1
    return F.coalesce(F.floor(share * top), F.lit(0)).cast("long")


def default_dimensions(documents: DataFrame) -> dict[str, Column]:
    """Language and source by checksum, length by logarithm."""
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    return {
        "lang": F.crc32(F.col("lang").cast("string").cast("binary")).cast("double"),
        "source": F.crc32(F.col("source").cast("string").cast("binary")).cast("double"),
        "length": F.log1p(size.cast("double")),
    }


def _measured(
    documents: DataFrame, dimensions: dict[str, Column], scratch: Scratch
) -> tuple[DataFrame, int]:
    """Narrow rows: id, size, checksum, and for each dimension one sortable place, ties broken by a hash."""
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    names = [f"d{i}" for i in range(len(dimensions))]
    rows = scratch.keep(
        documents.select(
            "doc_id",
            (F.octet_length(data) + 16).cast("long").alias("size"),
            F.crc32(data).alias("text_crc32"),
            *(value.alias(name) for name, value in zip(names, dimensions.values())),
            F.monotonically_increasing_id().alias("copy"),
        ),
        "measured",
    )
    # equal rows need a number of their own to be cut apart; there are usually none
    same = F.xxhash64("doc_id", "text_crc32")
    repeated = scratch.keep(
        rows.groupBy(same.alias("same")).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("same"),
        "repeated",
    )
    tie = same
    if not repeated.isEmpty():
        marked = rows.withColumn("same", same).join(repeated.withColumn("again", F.lit(True)), "same", "left")
        rows = scratch.keep(marked.drop("same"), "measured-again")
        tie = F.when(F.col("again"), F.xxhash64("doc_id", "text_crc32", "copy")).otherwise(same)
    bounds = rows.agg(
        *(F.min(n).alias(f"{n}_low") for n in names), *(F.max(n).alias(f"{n}_high") for n in names)
    ).first()
    tie = F.shiftrightunsigned(tie, 64 - TIE_BITS)
    places = [
        F.shiftleft(_place(F.col(n), F.lit(bounds[f"{n}_low"]), F.lit(bounds[f"{n}_high"])), TIE_BITS)
        .bitwiseOR(tie)
        .alias(n)
        for n in names
    ]
    return rows.select("doc_id", "size", "text_crc32", F.array(*places).alias("places")), len(names)


def _walked(places: Column, tree: list[dict[int, Cut]]) -> Column:
    """The node that a row reaches when it walks down the levels of the tree; the tree is a constant."""
    if not tree:
        return F.lit(0)
    nodes = max(max(level) for level in tree) + 1
    none = F.lit(None).cast("struct<dim:int,cut:bigint,middle:int>")

    def node(cut: Cut | None) -> Column:
        if cut is None:
            return none
        dim, place, middle = cut
        return F.struct(
            F.lit(dim).alias("dim"), F.lit(place).cast("long").alias("cut"), F.lit(middle).alias("middle")
        )

    levels = F.array(*(F.array(*(node(level.get(n)) for n in range(nodes))) for level in tree))

    def step(at: Column, level: Column) -> Column:
        cut = F.get(level, at)
        return F.when(F.get(places, cut["dim"]) > cut["cut"], cut["middle"]).otherwise(at)

    return F.aggregate(levels, F.lit(0), step)


def _by_node(values: dict[int, int], kind: str) -> Column:
    """The value of a row's node; null for a node without one."""
    listed = F.array(*(F.lit(values.get(n)).cast(kind) for n in range(max(values) + 1)))
    return F.get(listed, F.col("node"))


def _cuts(rows: DataFrame, level: list[tuple[int, int]], width: int) -> dict[int, Cut]:
    """For each node of a level: the dimension of the cut, the last place before it, and the node behind it."""
    spans = (
        rows.groupBy("node")
        .agg(
            F.sum("size").alias("bytes"),
            *(F.min(F.col("places")[i]).alias(f"low{i}") for i in range(width)),
            *(F.max(F.col("places")[i]).alias(f"high{i}") for i in range(width)),
        )
        .collect()  # one row for each node
    )
    state, fine = {}, {}
    shares = {a: ((a + b) // 2 - a, b - a) for a, b in level}
    for r in spans:
        if r.node in shares:
            part, whole = shares[r.node]
            dim = max(range(width), key=lambda i: ((r[f"high{i}"] - r[f"low{i}"]) >> TIE_BITS, -i))
            # bytes sought below the cut; range of places that holds it; bytes below that range, and in it
            state[r.node] = [dim, r.bytes * part // whole, r[f"low{dim}"], r[f"high{dim}"], 0, r.bytes]
            fine[r.node] = r.bytes / whole * FINE
    for _ in range(LOOKS):
        now = {
            n: (dim, low, max(1, -(-(high - low + 1) // BINS)), high)
            for n, (dim, _, low, high, _, held) in state.items()
            if high > low and held > fine[n]
        }
        if not now:
            break
        dim, low, step, high = (
            _by_node({n: v[i] for n, v in now.items()}, kind)
            for i, kind in enumerate(("int", "long", "long", "long"))
        )
        sums = (
            rows.select("node", "size", F.get("places", dim).alias("place"), low.alias("low"), step.alias("step"), high.alias("high"))
            .filter("place BETWEEN low AND high")
            .groupBy("node", F.expr("(place - low) div step").alias("bin"))
            .agg(F.sum("size").alias("bytes"))
            .collect()  # BINS rows for each node at most, whatever the size of the input
        )
        found = set()
        for r in sorted(sums):
            s = state[r.node]
            if r.node in found:
                continue
            if s[4] + r.bytes < s[1]:
                s[4] += r.bytes
                continue
            found.add(r.node)  # this bin holds the goal
            _, first, wide, last = now[r.node]
            s[2:4] = first + r.bin * wide, min(last, first + (r.bin + 1) * wide - 1)
            s[5] = r.bytes
    # the last bin goes where that leaves the bytes nearer to their goal
    middle = {a: (a + b) // 2 for a, b in level}
    return {
        node: (dim, high if 2 * (goal - below) >= held else low - 1, middle[node])
        for node, (dim, goal, low, high, below, held) in state.items()
    }


def shard_documents(
    documents: DataFrame, shards: int = SHARDS, dimensions: dict[str, Column] | None = None
) -> DataFrame:
    """Deal ``documents`` (doc_id, text, lang, source) into ``shards`` shards of near-equal bytes.

    ``dimensions`` are numeric expressions over the rows; a null counts as the least value. Where many rows
    share a value, a hash of doc_id and text decides between them, so a hot value is cut like any other;
    rows alike in all of that are told apart by a number.

    Returns doc_id, size (bytes of the text plus 16), text_crc32, law, shard, slot (from 0, without gaps) and
    grown_shard (null). A null text has no bytes. Rows that repeat a doc_id are dealt one by one. An empty
    table gives no rows. Other columns are ignored.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "shards")
    rows, width = _measured(documents, dimensions or default_dimensions(documents), scratch)
    tree: list[dict[int, Cut]] = []
    for level in _levels(shards):
        cuts = _cuts(rows.withColumn("node", _walked(F.col("places"), tree)), level, width)
        if cuts:
            tree.append(cuts)
    rows = rows.withColumn("node", _walked(F.col("places"), tree))
    return _numbered(
        scratch.keep(
            rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("node").alias("shard")),
            "dealt",
        )
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """Number the rows of each shard in chunks, each on its own, and add the rows of the chunks before."""
    total = rows.count()
    chunks = max(1, -(-total // CHUNK_ROWS))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_crc32", "shard"), F.lit(chunks)))
    sizes = rows.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "shard", "chunk", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    own = Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("place", F.row_number().over(own) - 1)
        .join(offsets, ["shard", "chunk"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "law",
            "shard",
            (F.col("offset") + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
