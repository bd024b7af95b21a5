"""Sharding by proportional stratified interleaving.

Within each source the rows are ranked in the order of a seeded hash. A row's rank over the size of its source is a
fraction; all rows are ordered by it, so every stretch of that order holds the sources in their proportions. The order
is cut into shards whose numbers of rows differ by one at most (law ``rows``).

No group is ranked in one task. The hash is even, so its leading bits split a source of any size into buckets; rows are
ranked inside a bucket and the counts of the lower buckets are added. The fractions are even as well and are placed in
the same way. The number of buckets follows ``spark.sql.shuffle.partitions`` and does not change the result.

NULL sources are one source, a NULL text has no bytes, NULL ids are allowed. Rows equal in id and text are interchangeable.
Equal texts under different ids are rows like any other: the law counts rows. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, nested, shuffle_partitions, text_or_empty, unnested, utf8_bytes

SHARDS = 40
SEED = "shard-1"
ROW_OVERHEAD = 16


def _bits(documents: DataFrame) -> int:
    """Leading bits of the hash that make a bucket: some four buckets per shuffle partition."""
    return min(24, max(4, (4 * shuffle_partitions(documents.sparkSession)).bit_length()))


def _before(counts: DataFrame, by: list[str], bucket: str) -> DataFrame:
    """Rows in the lower buckets, and all rows, of each group of ``by``."""
    group = Window.partitionBy(*by)
    lower = group.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("lower", F.coalesce(F.sum("n").over(lower), F.lit(0))).withColumn("all", F.sum("n").over(group)).drop("n")


def placed(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """The nested row with its place in the interleaved order (from 0) and the number of all rows."""
    bits = _bits(documents)
    table = nested(documents).select(
        ROW,
        F.coalesce(F.concat(F.lit("="), F.col(f"{ROW}.source")), F.lit("")).alias("source_key"),
        F.crc32(utf8_bytes(f"{ROW}.text")).alias("crc"),
    )
    named = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(f"{ROW}.doc_id").cast("string"), F.lit("")), "crc")
    table = table.withColumn("order_key", F.md5(named.cast("binary")))
    leading = F.conv(F.substring("order_key", 1, 6), 16, 10).cast("int")
    table = table.withColumn("bucket", F.shiftright(leading, 24 - bits))

    counts = table.groupBy("source_key", "bucket").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy("source_key", "bucket").orderBy("order_key", f"{ROW}.doc_id", "crc")
    table = table.withColumn("inside", F.row_number().over(inside) - 1)
    table = table.join(_before(counts, ["source_key"], "bucket"), ["source_key", "bucket"])
    fraction = (2 * (F.col("lower") + F.col("inside")) + 1).cast("double") / (2 * F.col("all"))
    table = table.select(ROW, "source_key", "crc", fraction.alias("fraction"), F.floor(fraction * float(1 << bits)).alias("stretch"))

    # How many rows lie below a stretch follows from the sizes of the sources alone.
    sizes = counts.groupBy("source_key").agg(F.sum("n").alias("all"))
    ranks = sizes.select("all", F.explode(F.sequence(F.lit(0), F.lit((1 << bits) - 1))).alias("stretch"))
    below = F.shiftright(2 * F.col("all") * F.col("stretch") + ((1 << bits) - 1), bits + 1)
    ranks = ranks.groupBy("stretch").agg(F.sum(below).alias("lower"), F.sum("all").alias("all"))
    within = Window.partitionBy("stretch").orderBy("fraction", "source_key")
    table = table.withColumn("inside", F.row_number().over(within) - 1)
    table = table.join(ranks, "stretch")
    return table.select(ROW, "crc", (F.col("lower") + F.col("inside")).alias("place"), F.col("all").alias("rows"))


def _cut(shards: int) -> tuple[Column, Column]:
    """Shard and slot of a place: shard i starts at the first place whose share of the rows is i."""
    shard = F.expr(f"place * {shards} div rows")
    start = F.expr(f"(place * {shards} div rows * rows + {shards - 1}) div {shards}")
    return shard.cast("int"), (F.col("place") - start).cast("long")


def shard_report(documents: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (NULL: the law is by rows)."""
    shard, slot = _cut(shards)
    return placed(documents, seed).select(
        F.col(f"{ROW}.doc_id").alias("doc_id"),
        (F.octet_length(text_or_empty(f"{ROW}.text")) + ROW_OVERHEAD).cast("long").alias("size"),
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        shard.alias("shard"),
        slot.alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_rows(documents: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """The documents with their shard and their slot in it."""
    shard, slot = _cut(shards)
    return unnested(placed(documents, seed), documents.columns, shard=shard, slot=slot)
