"""Text cleaning expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(text: Column, kind: str) -> Column:
    """A number from text that is '' or a number; '' is NULL and so is a number that does not fit.

    The empty text is taken out first: a failing try_cast costs an exception per row.
    """
    return F.nullif(text, F.lit("")).try_cast(kind)


def clean_price(text: Column) -> Column:
    """Digits before the first point as a long; anything without digits is 0, more digits than a long holds are NULL."""
    digits = F.regexp_replace(F.substring_index(text, ".", 1), "[^0-9]", "")
    return F.when(digits.isNull() | (digits == ""), F.lit(0).cast("bigint")).otherwise(parsed(digits, "bigint"))


def normalize_spec_key(key: Column, drop_colon: bool = False) -> Column:
    """Trimmed, lower-case key with blanks as underscores."""
    out = F.lower(F.replace(F.trim(key), F.lit(" "), F.lit("_")))
    return F.replace(out, F.lit(":"), F.lit("")) if drop_colon else out


def slugify(text: Column) -> Column:
    """Lower-case identifier made of letters, digits and underscores; NULL gives ''."""
    joined = F.regexp_replace(F.lower(text), "[ -]+", "_")
    kept = F.regexp_replace(joined, "[^a-z0-9_]+", "")
    marked = F.when(F.left(kept, F.lit(1)).between("0", "9"), F.concat(F.lit("_"), kept)).otherwise(kept)
    return F.coalesce(marked, F.lit(""))


def slugify_name(text: str | None) -> str:
    """``slugify`` for a column name known on the driver."""
    if not text:
        return ""
    kept = "".join(ch for ch in re.sub(r"[ \-]+", "_", text.lower()) if ch in "_" or ch.isascii() and ch.isalnum())
    return f"_{kept}" if kept[:1].isdigit() else kept


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_int(text: Column) -> Column:
    """First run of digits as an int, NULL when there is none."""
    return parsed(F.regexp_extract(text, r"(\d+)", 1), "int")


def first_float(text: Column) -> Column:
    """First decimal number as a float, NULL when there is none."""
    return parsed(F.regexp_extract(text, r"(\d+\.?\d*)", 1), "float")
