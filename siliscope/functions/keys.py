"""Hashed row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a surrogate key, so that NULL and '' differ.
NULL_MARK = "_dbt_utils_surrogate_key_null_"


def surrogate_key(fields: list[Column], nulls_as_empty: bool = False) -> Column:
    """md5 over the fields as text, joined by '-'."""
    mark = F.lit("" if nulls_as_empty else NULL_MARK)
    return F.md5(F.concat_ws("-", *[F.coalesce(f.cast("string"), mark) for f in fields]))
