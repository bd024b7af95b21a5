"""A single value out of a query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reshape import quoted


def single_value(df: DataFrame, default=None) -> DataFrame:
    """One row, column ``value``: first column of the first row, the default when there are no rows."""
    first = df.select(quoted(df.columns[0]).alias("_value")).limit(1)
    found = first.agg(F.count(F.lit(1)).alias("_rows"), F.first("_value").alias("_value"))
    return found.select(
        F.when(F.col("_rows") == 0, F.lit(default).cast(first.schema["_value"].dataType))
        .otherwise(F.col("_value"))
        .alias("value")
    )


def get_single_value(df: DataFrame, default=None) -> Column:
    """``single_value`` as a scalar subquery, to be used like a literal in another query."""
    return single_value(df, default).scalar()
