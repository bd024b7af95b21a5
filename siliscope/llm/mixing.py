"""Mixing sources to target weights by repeating or thinning whole documents.

Words are summed per source. The sources, ordered by name with NULL last, weigh 5, 2, 1, 5, 2, 1 ... and share a budget
of words; a source gets at most ``MAX_REPEATS`` times its own words and the excess goes to the others by weight. Target
over size is the source's repetition rate: each document is emitted floor(rate) times, plus once more if a seeded hash of
its id, as a number in [0, 1), is below the fraction. Reruns agree, as the hash decides.

The table of sources has one row per source; one task orders it, and it is written to the shared folder before documents are
joined to it. So Spark knows its size: up to ``spark.sql.autoBroadcastJoinThreshold`` it goes to the documents, which then
are not shuffled at all; a larger table is joined by source, and adaptive execution splits a hot one.

NULL sources are one source, a NULL text has 0 words, a NULL id is hashed as an empty one. A source without words has
rate 0. Repeated rows have the same id and share its decision. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, WORD, nested, stored, text_or_empty, unnested

WEIGHTS = (5, 2, 1)
BUDGET_HALVES = 3  # the budget in halves of all words: 150 percent
MAX_REPEATS = 2
SEED = "mix-1"


def sized(documents: DataFrame) -> DataFrame:
    """The nested row with its source under a key that is never NULL and its number of words."""
    return nested(documents).select(
        ROW,
        F.coalesce(F.concat(F.lit("="), F.col(f"{ROW}.source")), F.lit("")).alias("source_key"),
        F.regexp_count(text_or_empty(f"{ROW}.text"), F.lit(WORD)).cast("long").alias("size"),
    )


def source_targets(sizes: DataFrame) -> DataFrame:
    """source_key, source_size, target of every source.

    Sources are taken by cap over weight: while a source's cap is below its share of what the earlier caps leave, it is
    filled; the rest is shared by weight among those that follow. This is where sharing the excess again and again ends.
    """
    sources = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source_key") == "", "source_key")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    sources = sources.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * MAX_REPEATS)
    everyone = Window.partitionBy()
    upward = Window.orderBy(F.col("cap").cast("double") / F.col("weight"), F.col("source_key"))
    sources = (
        sources.withColumn("total", F.sum("source_size").over(everyone))
        .withColumn("lower_caps", F.sum("cap").over(upward.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("weights_left", F.sum("weight").over(upward.rowsBetween(0, Window.unboundedFollowing)))
        .na.fill(0, ["lower_caps"])
    )
    left = F.col("total") * BUDGET_HALVES - F.col("lower_caps") * 2
    full = (F.col("cap") * 2).cast("decimal(38,0)") * F.col("weights_left") <= left.cast("decimal(38,0)") * F.col("weight")
    sources = sources.withColumn("full", full)
    sources = (
        sources.withColumn("filled", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everyone))
        .withColumn("weights_open", F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(everyone))
    )
    open_words = (F.col("total") * BUDGET_HALVES).cast("double") / 2 - F.col("filled")
    shared = open_words * F.col("weight") / F.when(F.col("weights_open") > 0, F.col("weights_open"))
    return sources.select(
        "source_key", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(shared).alias("target")
    )


def _fraction(seed: str):
    """A number in [0, 1) that the id and the seed decide: the first 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"{ROW}.doc_id").cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2**52)


def rated(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """The nested row with size, source_size, target and the number of copies the mix takes."""
    sizes = sized(documents)
    table = sizes.join(stored(source_targets(sizes), "targets"), "source_key")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    extra = F.when(_fraction(seed) < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return table.withColumn("rate", rate).withColumn("copies", (F.floor("rate") + extra).cast("int"))


def mix_report(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target of its source, words the mix takes of it."""
    return rated(documents, seed).select(
        F.col(f"{ROW}.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every document as many times as the mix takes it."""
    table = rated(documents, seed).filter("copies > 0")
    table = table.select(ROW, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return unnested(table, documents.columns)


MIX_SQL = f"""
WITH sizes AS (
  SELECT doc_id, coalesce('=' || source, '') AS k, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size
  FROM documents),
places AS (
  SELECT k, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY k = '', k) - 1 AS place FROM sizes GROUP BY k),
weighed AS (
  SELECT k, source_size, source_size * {MAX_REPEATS} AS cap, list_extract({list(WEIGHTS)}, place % {len(WEIGHTS)} + 1) AS weight
  FROM places),
sums AS (
  SELECT *, sum(source_size) OVER () AS total,
    coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower_caps,
    sum(weight) OVER (ORDER BY cap::DOUBLE / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_left
  FROM weighed),
judged AS (
  SELECT *, 2 * cap * weights_left <= ({BUDGET_HALVES} * total - 2 * lower_caps) * weight AS is_full FROM sums),
opened AS (
  SELECT *, sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER () AS filled,
    sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () AS weights_open FROM judged),
targets AS (
  SELECT k, source_size, CASE WHEN is_full THEN cap::DOUBLE
    ELSE (({BUDGET_HALVES} * total)::DOUBLE / 2 - filled::DOUBLE) * weight::DOUBLE / weights_open::DOUBLE END AS target FROM opened),
rates AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / {2**52}::DOUBLE AS u
  FROM sizes JOIN targets USING (k))
SELECT doc_id, size, source_size, target,
  ((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM rates
"""
