"""Previous and next rows in a global order, without one task holding everything."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .reshape import quoted

_COPIES_PER_CHUNK = 100_000
# Keys in the sample for each range.
_SAMPLE_PER_RANGE = 24


def _range_count(df: DataFrame) -> int:
    """More ranges than cores, because two ranges can land in one task."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def _sort_key(keys: Sequence[str]) -> list[Column]:
    """NULL flags in front of the values make comparisons of structs agree with "NULLs last"."""
    return [part for i, k in enumerate(keys) for part in (quoted(k).isNull().alias(f"n{i}"), quoted(k).alias(f"k{i}"))]


def order_range(rows: DataFrame, keys: Sequence[str], ranges: int) -> Column:
    """Number of the stretch of the order of ``keys`` that a row lies in, evenly filled with distinct keys.

    The bounds are the quantiles of a sample of the distinct keys, taken by their hashes, and stand in the expression as a
    literal: the number is a function of the row alone, so a task that is run again gives the same. The sample holds
    ``ranges`` times 24 keys at most, whatever the size of the table, fewer if keys repeat: the distinct keys of a range
    are about the share of the rows by which there are ranges, or less. Only the bounds come to the driver. (Any bounds
    give numbers that follow the order, so it does no harm that they travel as text.)
    """
    columns = [quoted(k) for k in keys]
    key = F.struct(*_sort_key(keys))
    share = F.shiftrightunsigned(F.xxhash64(*columns), 1) / F.lit(float(1 << 63))
    many = rows.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("many")).scalar()
    sample = rows.filter(share < F.lit(float(_SAMPLE_PER_RANGE * ranges)) / many).select(key.alias("key"))
    # Bounds in two levels, so that a row is compared with twice the root of their number.
    width = math.isqrt(max(ranges, 1) - 1) + 1
    place = lambda i: f"bounds[CAST(floor(CAST({i} AS DOUBLE) * size(bounds) / {width * width}) AS INT)]"
    coarse = f"transform(sequence(1, {width - 1}), i -> {place(f'i * {width}')})"
    fine = f"transform(sequence(0, {width - 1}), c -> transform(sequence(1, {width - 1}), i -> {place(f'(c * {width} + i)')}))"
    gathered = sample.agg(F.array_sort(F.collect_set("key")).alias("bounds")).filter((F.size("bounds") > 0) & F.lit(width > 1))
    levels = gathered.select(F.struct(F.expr(coarse).alias("coarse"), F.expr(fine).alias("fine")).alias("levels"))
    found = levels.select(F.to_json("levels").alias("levels")).first()
    if found is None:
        return F.lit(0)
    bounds = F.from_json(F.lit(found.levels), levels.schema["levels"].dataType)
    kind = levels.select(bounds.alias("levels")).schema["levels"].dataType  # as it is read: every field may be NULL
    below = lambda some, own: F.size(F.filter(some, lambda bound: bound <= own))
    both = lambda own, outer: outer * width + below(F.get(bounds["fine"], outer), own)
    # Arrays of one element name the key and the outer place, so that each is worked out once a row.
    own = F.array(key.cast(kind["coarse"].dataType.elementType))
    placed = F.transform(own, lambda k: F.struct(k.alias("own"), below(bounds["coarse"], k).alias("outer")))
    return F.get(F.transform(placed, lambda p: both(p["own"], p["outer"])), F.lit(0))


def with_neighbour(
    df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], value: str, out: str, following: bool, sample_from: DataFrame | None = None
) -> DataFrame:
    """Add the ``value`` of the previous (or following) row of the same group as ``out``.

    Rows must be unique in (group, order); NULLs sort last. The rows are put
    into ranges of the full order, so the size of a group does not matter; each
    range is ordered by itself, and the edge row of each range (one per range)
    is handed to its neighbour. ``sample_from`` holds the same keys, but is
    cheaper to read.
    """
    keys = [*group_by, *order_by]
    ascending = [quoted(k).asc_nulls_last() for k in keys]
    ranged = df.withColumn("_range", order_range(sample_from or df, keys, _range_count(df)))
    # With all plain columns, so that both uses of the rows need the same ones and read the same shuffle.
    plain = [quoted(f.name) for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType, T.VariantType))]
    row = F.struct(*_sort_key(keys), quoted(value).alias("value"), *plain)
    inside = Window.partitionBy("_range").orderBy(*ascending)
    between = Window.orderBy("_range")
    move = F.lead if following else F.lag
    edge = F.min if following else F.max
    edges = ranged.groupBy("_range").agg(edge(row).alias("_edge"))
    edges = edges.select("_range", move("_edge").over(between).alias("_edge"))
    moved = ranged.withColumn("_next", move(row).over(inside))
    # One row per range: bounded by the number of ranges, whatever the data.
    joined = moved.join(F.broadcast(edges), "_range", "left").withColumn("_next", F.coalesce("_next", "_edge"))
    same_group = F.lit(True)
    for i, g in enumerate(group_by):
        same_group = same_group & quoted(g).eqNullSafe(F.col(f"_next.k{i}"))
    found = F.when(same_group, F.col("_next.value"))
    return joined.select(*[quoted(c) for c in df.columns], found.alias(out))


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Each row ``copies`` times; long repeats are cut into chunks that spread over the tasks."""
    chunk = F.lit(_COPIES_PER_CHUNK)
    many = df.filter(F.col(copies) > 0).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / chunk)))
    )
    spread = many.repartition(*[quoted(c) for c in df.columns], "_chunk")
    left = F.least(chunk.cast("long"), F.col(copies) - F.col("_chunk") * chunk)
    once = spread.withColumn("_copy", F.sequence(F.lit(1).cast("long"), left))
    return once.withColumn("_copy", F.explode("_copy")).drop("_chunk", "_copy", copies)
