"""Number and date series, made on the executors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _timestamp(value) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)).cast("timestamp_ntz")


def intervals_between(start: Column, end: Column, datepart: str) -> Column:
    """Number of datepart boundaries between two times."""
    part = datepart.upper()
    low, high = F.date_trunc(part, _timestamp(start)), F.date_trunc(part, _timestamp(end))
    return F.timestamp_diff(part, low.cast("timestamp_ntz"), high.cast("timestamp_ntz"))


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1, 2, ... upper_bound as ``generated_number``."""
    if upper_bound <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def date_spine(spark: SparkSession, datepart: str, start, end) -> DataFrame:
    """Every datepart step from ``start`` up to, not including, ``end`` as ``date_<datepart>``."""
    as_date = isinstance(start, dt.date) and not isinstance(start, dt.datetime)
    n = spark.range(1).select(intervals_between(_timestamp(start), _timestamp(end), datepart).alias("n")).first()["n"]
    step = F.timestamp_add(datepart.upper(), (F.col("generated_number") - 1).cast("int"), _timestamp(start))
    kind = "date" if as_date and datepart.lower() not in ("hour", "minute", "second") else "timestamp_ntz"
    name = f"date_{datepart}"
    spine = generate_series(spark, n).select(step.cast(kind).alias(name))
    return spine.filter(F.col(name) <= _timestamp(end).cast(kind))
