"""The whole refresh: pages to bronze, bronze to product tables, product tables to models."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import latest_snapshot
from ..sources import bronze as B
from ..sources import versions as V
from ..sources.tables import PRODUCT_TABLES
from ..streaming.incremental import incremental_sync
from . import gold, market, silver
from .extraction import extract_products, specs_to_columns

# Specification keys that the models read.
MODEL_KEYS = [
    "cores", "speed", "socket", "tdp", "memory_size", "memory_type", "recommended_psu", "model", "model_name",
    "cpu", "graphics_card", "gpu", "integrated_graphics", "weight",
]
# Names of the stored market tables.
MASTER_TABLE, INSIGHTS_TABLE = "master_catalog_final", "market_insights_final"
# End of fixed values.


def ingest(pages: DataFrame, bronze_path: str, loaded_at: Column | None = None) -> None:
    """Append the records of the given product pages to the bronze history."""
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    B.write_bronze(extract_products(pages).withColumn("loaded_at", stamp), bronze_path)


def sync(
    spark: SparkSession, bronze_path: str, tables_path: str, by_category: bool = True, latest_only: bool = False
) -> DataFrame:
    """Replace the product tables from the bronze history and report read, dropped, sent and stored rows of each.

    With ``by_category=False`` every table holds the records of all categories;
    ``latest_only`` keeps the last record of each URL. An empty history
    replaces nothing and gives an empty report.
    """
    bronze = specs_to_columns(B.read_partitioned_bronze(spark, bronze_path), MODEL_KEYS, keep_map=True)
    if bronze.isEmpty():
        counts = ", ".join(f"{count} bigint" for count in silver.DROP_COUNTS)
        return spark.createDataFrame([], f"table_name string, {counts}, rows_sent bigint, rows_stored bigint, matches boolean")

    def cleaned(category: str | None) -> tuple[DataFrame, Observation]:
        # The resource comes first: it skips folders, and each history is put in order only once.
        rows = bronze if category is None else bronze.filter(F.col(B.RESOURCE) == category)
        return silver.sync_clean_observed(latest_snapshot(rows, "loaded_at") if latest_only else rows)

    audits, everything, seen = [], None, None
    for name, category in PRODUCT_TABLES.items():
        path = f"{tables_path}/{name}"
        if by_category or everything is None:
            rows, seen = cleaned(category if by_category else None)
        else:
            rows = everything
        audit = B.refresh_audit(rows, path)
        if not by_category and everything is None:
            everything = V.read_published(spark, path)
        dropped = [F.lit(seen.get[count]).cast("long").alias(count) for count in silver.DROP_COUNTS]
        audits.append(audit.select(F.lit(name).alias("table_name"), *dropped, "*"))
    out = audits[0]
    for audit in audits[1:]:
        out = out.union(audit)
    return out


def sync_new(
    spark: SparkSession, bronze_path: str, tables_path: str, progress_path: str, buckets: int = 64, max_files_per_trigger: int = 10_000
) -> DataFrame:
    """Bring the product tables up to date with the bronze files that arrived since the last call.

    Gives the same tables as ``sync`` with ``latest_only``, but reads new files and rewrites only the buckets that hold
    their URLs. Returns the rows of each table.
    """
    history = B.read_partitioned_bronze(spark, bronze_path)
    tables = {category: name for name, category in PRODUCT_TABLES.items()}
    incremental_sync(
        spark,
        bronze_path,
        history.schema,
        tables_path,
        progress_path,
        table=F.create_map(*[F.lit(text) for pair in tables.items() for text in pair])[F.col(B.RESOURCE)],
        transform=lambda records: specs_to_columns(records, MODEL_KEYS, keep_map=True),
        buckets=buckets,
        max_files_per_trigger=max_files_per_trigger,
    )
    counts = []
    for name in PRODUCT_TABLES:
        if V.current(spark, f"{tables_path}/{name}") is not None:
            rows = V.read_published(spark, f"{tables_path}/{name}").agg(F.count(F.lit(1)).alias("rows_stored"))
            counts.append(rows.select(F.lit(name).alias("table_name"), "rows_stored"))
    if not counts:
        return spark.createDataFrame([], "table_name string, rows_stored bigint")
    return reduce(DataFrame.union, counts)


def product_tables(spark: SparkSession, tables_path: str) -> dict[str, DataFrame]:
    """The newest version of each product table, however it was made."""
    return {name: V.read_published(spark, f"{tables_path}/{name}") for name in PRODUCT_TABLES}


def build_models(tables: Mapping[str, DataFrame], models_path: str) -> dict[str, DataFrame]:
    """Publish the silver views and store the gold and market tables; returns all of them by name."""
    models = {
        "stg_cpus": B.view_model(silver.stg_cpus(tables["cpus"]), "stg_cpus"),
        "stg_gpus": B.view_model(silver.stg_gpus(tables["gpus"]), "stg_gpus"),
        "stg_laptops": B.view_model(silver.stg_laptops(tables["laptops"]), "stg_laptops"),
    }
    laptops = models["stg_laptops"]

    def stored(name: str, df: DataFrame) -> None:
        models[name] = B.table_model(df, name, f"{models_path}/{name}")

    stored("fact_hardware_recommendations", gold.fact_hardware_recommendations(laptops))
    stored("fact_laptop_rankings", gold.fact_laptop_rankings(laptops))
    stored(MASTER_TABLE, market.master_catalog(tables))
    stored(INSIGHTS_TABLE, market.value_topk(models[MASTER_TABLE]))
    return models
