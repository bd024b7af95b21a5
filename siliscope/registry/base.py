"""How a registered query and the SQL that checks it are declared."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.derived import CATALOGUE_SQL, derived_catalogue
from ..sources.tables import read_table

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


class Registry(dict):
    """Queries by name; used as a decorator."""

    def add(self, name: str, sql: str | None = None):
        def register(run: Run) -> Run:
            if name in self:
                raise ValueError(f"{name} is registered twice")
            self[name] = Query(run, sql)
            return run

        return register


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    return derived_catalogue(read_table(spark, folder, "part"))


def over_catalogue(sql: str) -> str:
    """SQL that may use the derived product catalogue under the name ``catalogue``."""
    return f"WITH catalogue AS ({CATALOGUE_SQL.format(part='part')}) {sql}"
