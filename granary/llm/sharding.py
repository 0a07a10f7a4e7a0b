"""K-d tree sharding: recursive splits at weighted medians along the widest metadata dimension.

Each row is a point: its source, its language (both put on a line by a hash) and
the logarithm of its size. A node that is to become m shards is split across its widest
dimension, at the place that gives its first half of shards their share of the bytes;
leaves are shards of near equal bytes. All nodes of a level are split at once.

The median is found by counting, not by sorting: a row's place along a
dimension is a 60-bit number (20 bits of the dimension, 20 of a hash of the
text, 20 of a hash of doc_id), and each round sums bytes by the next 12 bits
below the known prefix, until the prefix in question holds next to nothing or
has no bits left. So a hot source, or many copies of one text, are split as any
other rows: copies stay next to each other, and a group is cut in a shard's end only. Every step is a DataFrame operation.

Nulls: a null text has no bytes; a null language or source is a value of its own. Repeated rows
are rows like others. Extra columns are not read. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.numbering import numbered
from granary.sources.workspace import settle

SHARDS = 24
ROW_BYTES = 8  # added to the bytes of each text
BITS = 20  # of a dimension, of the text's hash and of doc_id's hash
STEP = 12  # bits looked at in one round
TOLERANCE = 0.002  # of a shard's bytes: what may remain undivided at a cut
DIMENSIONS = ("source", "lang", "size")


def _line(value: Column) -> Column:
    """A place on a line of 2^BITS for any value; null has one too."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(value.cast("string"), F.lit("\u0000"))), 64 - BITS)


def points(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, tie, place of source, language and size) of every row; equal texts share the places."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = (F.octet_length(text) + ROW_BYTES).cast("long")
    tie = F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 64 - BITS), BITS) + F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("long")), 64 - BITS)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("same"),
        size.alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        tie.alias("tie"),
        _line(F.col("source")).alias("d0"),
        _line(F.col("lang")).alias("d1"),
        F.least(F.lit((1 << BITS) - 1), F.floor(F.log2(size.cast("double")) * (1 << (BITS - 6)))).cast("long").alias("d2"),
    )
    rows = settle(rows, "rows")
    least = rows.groupBy("same").agg(F.min("d0").alias("d0"), F.min("d1").alias("d1"))
    return rows.drop("d0", "d1").join(least, "same").drop("same")


def _place() -> Column:
    """A row's 60-bit place along its node's dimension."""
    along = F.when(F.col("axis") == 0, F.col("d0")).when(F.col("axis") == 1, F.col("d1")).otherwise(F.col("d2"))
    return F.shiftleft(along, 2 * BITS) + F.col("tie")


def _axes(rows: DataFrame) -> DataFrame:
    """For each node that is to be split: its widest dimension and the bytes wanted before the cut."""
    spread = [(F.max(f"d{i}") - F.min(f"d{i}")).alias(f"w{i}") for i in range(len(DIMENSIONS))]
    nodes = rows.filter("leaves > 1").groupBy("first", "leaves").agg(F.sum("size").alias("total"), *spread)
    widest = F.when((F.col("w0") >= F.col("w1")) & (F.col("w0") >= F.col("w2")), 0).when(F.col("w1") >= F.col("w2"), 1).otherwise(2)
    half = F.floor(F.col("leaves") / 2)
    return nodes.select(
        "first", widest.alias("axis"),
        F.round(F.col("total") * half / F.col("leaves")).cast("long").alias("wanted"),
        (F.col("total") / F.col("leaves") * TOLERANCE).alias("enough"),
        F.lit(0).cast("long").alias("prefix"), F.lit(3 * BITS).alias("open"), F.lit(0).cast("long").alias("before"),
        F.col("total").alias("inside"),
    )


def _narrow(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """One round: the next bits of the prefix that holds each node's cut."""
    seen = rows.join(cuts, "first").withColumn("place", _place()).filter(F.expr("shiftright(place, open) = prefix"))
    step = F.least(F.lit(STEP), F.col("open")).cast("int")
    seen = seen.withColumn("next", F.expr(f"shiftright(place, cast(greatest(open - {STEP}, 0) as int))"))
    sums = seen.groupBy("first", "next").agg(F.sum("size").alias("bytes"))
    order = Window.partitionBy("first").orderBy("next")  # at most 2^STEP rows a node, whatever the number of documents
    run = sums.join(cuts.withColumn("step", step), "first")
    run = run.withColumn("through", F.col("before") + F.sum("bytes").over(order))
    run = run.withColumn("hit", F.row_number().over(Window.partitionBy("first").orderBy(F.col("through") < F.col("wanted"), "next")))
    return run.filter("hit = 1").select(
        "first", "axis", "wanted", "enough", F.col("next").alias("prefix"), (F.col("open") - F.col("step")).alias("open"),
        (F.col("through") - F.col("bytes")).alias("before"), F.col("bytes").alias("inside"),
    )


def _cuts(rows: DataFrame) -> DataFrame:
    """(first, axis, cut, open): rows whose place, without its open bits, is below the cut go to the first half."""
    cuts = settle(_axes(rows), "axes")
    while cuts.filter((F.col("inside") > F.col("enough")) & (F.col("open") > 0)).limit(1).count():
        done = (F.col("inside") <= F.col("enough")) | (F.col("open") == 0)
        cuts = settle(_narrow(rows, cuts.filter(~done)).unionByName(cuts.filter(done)), "cuts")
    nearer = F.col("wanted") - F.col("before") > F.col("before") + F.col("inside") - F.col("wanted")
    return cuts.select("first", "axis", (F.col("prefix") + nearer.cast("long")).alias("cut"), "open")


def leaves(rows: DataFrame, shards: int) -> DataFrame:
    """Points with their ``shard``."""
    rows = rows.withColumn("first", F.lit(0)).withColumn("leaves", F.lit(shards))
    columns = rows.columns
    for _ in range(max(0, shards - 1).bit_length()):
        split = rows.join(_cuts(rows), "first", "left").withColumn("place", _place())
        low = F.col("cut").isNull() | F.expr("shiftright(place, open) < cut")
        half = F.floor(F.col("leaves") / 2).cast("int")
        first = F.when(low, F.col("first")).otherwise(F.col("first") + half)
        kept = F.when(F.col("leaves") < 2, F.col("leaves")).when(low, half).otherwise(F.col("leaves") - half)
        split = split.withColumn("__first", first.cast("int")).withColumn("__leaves", kept.cast("int"))
        rows = settle(split.drop("first", "leaves").withColumnsRenamed({"__first": "first", "__leaves": "leaves"}).select(columns), "level")
    return rows.withColumnRenamed("first", "shard")


def shard_documents(docs: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    Give the number of shards, or the bytes a shard should have (then ``shards`` is None).
    """
    rows = settle(points(docs), "points")
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    placed = leaves(rows, shards)
    slots = numbered(placed.select("doc_id", "size", "text_crc32", "shard"), "shard", ["doc_id", "text_crc32"], "slot")
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
