"""Declared tables and how they are found."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.reshape import union_relations

# Names of the product tables and the category each one holds.
PRODUCT_TABLES = {"cpus": "cpu", "gpus": "gpu", "laptops": "laptop", "monitors": "monitor", "ram": "ram"}
# End of fixed values.

# Tables a folder of test or raw data may hold, one Parquet file or directory each.
DATA_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(table: DataFrame) -> DataFrame:
    """The same rows, dealt evenly on all cores.

    For tables of narrow rows that much work per row follows on, such as the pages of products. A file may have many splits
    and few row groups, whose rows then all lie in few of the splits; so tables with enough splits are dealt out as well.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(max(cores, table.rdd.getNumPartitions()))


class Sources:
    """Named tables, read only when asked for."""

    def __init__(self, readers: Mapping[str, Callable[[], DataFrame]]):
        self._readers = dict(readers)

    def __contains__(self, name: str) -> bool:
        return name in self._readers

    def names(self) -> list[str]:
        return list(self._readers)

    def table(self, name: str) -> DataFrame:
        if name not in self._readers:
            raise KeyError(f"{name} is not a declared source; there are {', '.join(self._readers)}")
        return self._readers[name]()

    @classmethod
    def from_folder(cls, spark: SparkSession, folder: str, names: list[str] = DATA_TABLES) -> Sources:
        return cls({name: (lambda n=name: read_table(spark, folder, n)) for name in names})

    @classmethod
    def from_bronze(cls, bronze: DataFrame, by_category: bool = True) -> Sources:
        """Product tables over one bronze dataset; without ``by_category`` each one holds everything."""
        from ..plans.silver import sync_table

        return cls(
            {
                name: (lambda c=category: sync_table(bronze, c if by_category else None))
                for name, category in PRODUCT_TABLES.items()
            }
        )


def _like(pattern: str) -> re.Pattern:
    """A LIKE pattern without regard to case."""
    parts = {"%": ".*", "_": "."}
    return re.compile("".join(parts.get(ch, re.escape(ch)) for ch in pattern), re.IGNORECASE | re.DOTALL)


def tables_by_pattern(spark: SparkSession, table_pattern: str, exclude: str = "", schema_pattern: str | None = None) -> list[str]:
    """Names of catalog tables and views that match one pattern and not the other.

    Only names are listed on the driver. Without a schema pattern the current database is searched.
    """
    wanted, hidden = _like(table_pattern), _like(exclude)
    if schema_pattern is None:
        databases = [spark.catalog.currentDatabase()]
    else:
        schemas = _like(schema_pattern)
        databases = [db.name for db in spark.catalog.listDatabases() if schemas.fullmatch(db.name)]
    found = {}
    for database in databases:
        for table in spark.catalog.listTables(database):
            if wanted.fullmatch(table.name) and not hidden.fullmatch(table.name):
                owner = "" if table.isTemporary else f"{database}."
                found[f"{owner}{table.name}"] = None
    return sorted(found)


def tables_by_prefix(spark: SparkSession, prefix: str, exclude: str = "", schema: str | None = None) -> list[str]:
    return tables_by_pattern(spark, f"{prefix}%", exclude, schema)


def union_tables_by_pattern(spark: SparkSession, table_pattern: str, exclude: str = "", schema_pattern: str | None = None, **options) -> DataFrame:
    """Union of all catalog tables whose names match."""
    names = tables_by_pattern(spark, table_pattern, exclude, schema_pattern)
    if not names:
        raise ValueError(f"no table matches {table_pattern!r}")
    return union_relations({name: spark.table(name) for name in names}, **options)
