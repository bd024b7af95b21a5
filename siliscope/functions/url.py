"""URL parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scheme prefixes that are removed before splitting.
HOST_SCHEMES = ["android-app://", "http://", "https://"]
PATH_SCHEMES = ["http://", "https://"]


def _without(text: Column, parts: list[str]) -> Column:
    for part in parts:
        text = F.replace(text, F.lit(part), F.lit(""))
    return text


def url_host(url: Column) -> Column:
    """Text before the first '/' and '?' once the scheme is gone."""
    bare = _without(url, HOST_SCHEMES)
    return F.substring_index(F.substring_index(bare, "/", 1), "?", 1)


def url_path(url: Column) -> Column:
    """Text after the first '/' up to '?'.

    Without a '/' the cut is made just before '?'; with neither, the whole text is the path.
    """
    bare = _without(url, PATH_SCHEMES)
    slash = F.instr(bare, "/")
    cut = F.when(slash > 0, slash).otherwise(F.greatest(F.instr(bare, "?") - 1, F.lit(0)))
    return F.substring_index(F.substr(bare, cut + 1), "?", 1)


def url_parameter(url: Column, parameter: str) -> Column:
    """Value of a query parameter; NULL when it is missing or empty."""
    after = F.split_part(url, F.lit(f"{parameter}="), F.lit(2))
    return F.nullif(F.substring_index(after, "&", 1), F.lit(""))
