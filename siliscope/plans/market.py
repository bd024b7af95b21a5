"""Master catalogue over all categories and the best value per category."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.products import extract_gen, value_score

# Categories of the master catalogue with their tables, and the length of the report.
CATALOG_CATEGORIES = {"laptops": "laptop", "cpus": "cpu", "gpus": "gpu", "ram": "ram"}
TOP_PER_CATEGORY = 5
# End of fixed values.


def _priced(table: DataFrame) -> DataFrame:
    return table.filter(F.col("price_inr") > 0)


def master_catalog(tables: Mapping[str, DataFrame]) -> DataFrame:
    """UNION ALL of the priced products of the category tables, each under its category name."""
    parts = [
        _priced(tables[name]).select("name", "price_inr", "url", F.lit(category).alias("category"))
        for name, category in CATALOG_CATEGORIES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def master_catalog_from_bronze(bronze: DataFrame) -> DataFrame:
    """The same rows from one dataset that holds all categories, in a single scan."""
    wanted = F.col("category").isin(*CATALOG_CATEGORIES.values())
    return _priced(bronze).filter(wanted).select("name", "price_inr", "url", "category")


def scored_catalog(catalog: DataFrame) -> DataFrame:
    scored = catalog.withColumn("gen_score", extract_gen(F.col("name")))
    return scored.withColumn("value_score", value_score(F.col("gen_score"), F.col("price_inr")))


def value_topk(catalog: DataFrame, k: int = TOP_PER_CATEGORY) -> DataFrame:
    """The k products of each category with the highest value score; ties by name and URL.

    Whatever categories there are. The filter on the place becomes a group limit
    below the shuffle: a task sends k rows of each category.
    """
    best = [F.col("value_score").desc_nulls_last(), F.col("name").asc_nulls_last(), F.col("url").asc_nulls_last()]
    place = F.row_number().over(Window.partitionBy("category").orderBy(*best))
    return scored_catalog(catalog).withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")
