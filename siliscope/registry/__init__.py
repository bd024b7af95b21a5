"""All queries by name."""

from __future__ import annotations

from .base import Query


def all_queries() -> dict[str, Query]:
    from . import library, products, quality

    return {**products.QUERIES, **library.QUERIES, **quality.QUERIES}
