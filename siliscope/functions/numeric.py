"""Arithmetic that tolerates NULL and zero, and bucketing."""

from __future__ import annotations

from functools import reduce
from operator import add, sub

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = "decimal(28,6)"


def _filled(fields: list[Column]) -> list[Column]:
    if not isinstance(fields, (list, tuple)):
        raise TypeError("pass the fields as one list")
    return [F.coalesce(field, F.lit(0)) for field in fields]


def safe_add(fields: list[Column]) -> Column:
    return reduce(add, _filled(fields))


def safe_subtract(fields: list[Column]) -> Column:
    return reduce(sub, _filled(fields))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL instead of a division by zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def width_bucket(
    value: Column, min_value: Column | float, max_value: Column | float, num_buckets: Column | int, native: bool = False
) -> Column:
    """Histogram bucket of a value.

    The default form moves a value on a multiple of the bin size one bucket up
    (the test ignores ``min_value``); ``native`` is Spark's own function.
    """
    low, high, n = (x if isinstance(x, Column) else F.lit(x) for x in (min_value, max_value, num_buckets))
    if native:
        return F.width_bucket(value, low, high, n)
    size = (high - low) / n
    remainder = value.try_cast(NUMERIC) % F.nullif(size.try_cast(NUMERIC), F.lit(0))
    on_edge = F.when(remainder == 0, 1).otherwise(0)
    bucket = F.least(F.ceil((value - low) / size), (n + 1).cast("bigint"))
    return on_edge + bucket
