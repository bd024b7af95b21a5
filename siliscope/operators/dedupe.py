"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .reshape import quoted


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(field.dataType) for field in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order; the other columns break ties.

    The filter on the row number becomes a group limit before the shuffle, so a
    key with very many rows sends one row per task.
    """
    ties = [
        quoted(field.name).asc_nulls_last()
        for field in df.schema.fields
        if field.name not in partition_by and _orderable(field.dataType)
    ]
    window = Window.partitionBy(*[quoted(name) for name in partition_by]).orderBy(*order_by, *ties)
    numbered = df.withColumn("_row_number", F.row_number().over(window))
    return numbered.filter(F.col("_row_number") == 1).drop("_row_number")


def latest_snapshot(df: DataFrame, loaded_at: str, key: str | Sequence[str] = "url") -> DataFrame:
    """The last loaded record of each key out of an appended history; records without a (last) key column all stay."""
    keys = [key] if isinstance(key, str) else list(key)
    known = deduplicate(df.filter(quoted(keys[-1]).isNotNull()), keys, [quoted(loaded_at).desc_nulls_last()])
    return known.unionByName(df.filter(quoted(keys[-1]).isNull()))
