"""Cleaning of bronze records and the typed product views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import first_float, first_int

# What marks a processor or a graphics card, and defaults of the views.
CPU_CATEGORIES, CPU_MARK = ["Processors"], "Processor"
GPU_CATEGORIES, GPU_MARK = ["Graphics Card"], "Graphics Card"
RTX_MARK = "rtx"
NAME_PREFIX = 50
DEFAULT_RAM_GB = 8
UPDATED_AT = "dbt_updated_at"
DROP_COUNTS = ["rows_read", "dropped_null_name", "dropped_no_price", "dropped_unread_price"]
# End of fixed values.


def valid_record() -> Column:
    """A record that cleaning keeps: it has a name and a price above zero."""
    return F.col("name").isNotNull() & (F.col("price_inr") > 0)


def sync_clean(bronze: DataFrame) -> DataFrame:
    """Records with a name and a price above zero."""
    return bronze.filter(valid_record())


def sync_clean_observed(bronze: DataFrame) -> tuple[DataFrame, Observation]:
    """``sync_clean`` plus the dropped counts, taken in the same pass when the result is used.

    Prices that could not be read (NULL, such as more digits than a long holds) are among those without a price, and have a count of their own.
    """
    seen = Observation()
    no_name = F.col("name").isNull()
    counted = bronze.observe(
        seen,
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(no_name).alias("dropped_null_name"),
        F.count_if(~no_name & ~F.coalesce(F.col("price_inr") > 0, F.lit(False))).alias("dropped_no_price"),
        F.count_if(~no_name & F.col("price_inr").isNull()).alias("dropped_unread_price"),
    )
    return counted.filter(valid_record()), seen


def sync_report(bronze: DataFrame) -> DataFrame:
    """The same counts as one row, for a report without a write."""
    no_name = F.col("name").isNull()
    return bronze.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(no_name).alias("dropped_null_name"),
        F.count_if(~no_name & ~F.coalesce(F.col("price_inr") > 0, F.lit(False))).alias("dropped_no_price"),
        F.count_if(~no_name & F.col("price_inr").isNull()).alias("dropped_unread_price"),
        F.count_if(valid_record()).alias("rows_clean"),
    )


def sync_table(bronze: DataFrame, category: str | None = None) -> DataFrame:
    """A product table: cleaned records, of one category if given."""
    rows = bronze if category is None else bronze.filter(F.col("category") == category)
    return sync_clean(rows)


def column_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    """A column that pages may never have filled: typed NULL when it does not exist."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _of_kind(categories: list[str], mark: str) -> Column:
    return F.col("name").isNotNull() & (F.col("category").isin(*categories) | F.col("name").contains(mark))


def stg_cpus(cpus: DataFrame, categories: list[str] = CPU_CATEGORIES) -> DataFrame:
    """Processors with typed core count and clock speed."""
    return cpus.filter(_of_kind(categories, CPU_MARK)).select(
        F.col("name").alias("cpu_full_name"),
        column_or_null(cpus, "brand").alias("brand"),
        F.coalesce(first_int(column_or_null(cpus, "cores")), F.lit(0)).alias("core_count"),
        first_float(column_or_null(cpus, "speed")).alias("clock_speed_ghz"),
        column_or_null(cpus, "socket").alias("socket"),
        column_or_null(cpus, "tdp").alias("tdp_watts"),
        F.col("source").alias("website_source"),
    )


def stg_gpus(gpus: DataFrame, categories: list[str] = GPU_CATEGORIES) -> DataFrame:
    """Graphics cards with typed memory size."""
    return gpus.filter(_of_kind(categories, GPU_MARK)).select(
        F.col("name").alias("gpu_full_name"),
        column_or_null(gpus, "brand").alias("brand"),
        F.coalesce(first_int(column_or_null(gpus, "memory_size")), F.lit(0)).alias("vram_gb"),
        column_or_null(gpus, "memory_type").alias("memory_type"),
        F.lower("name").contains(RTX_MARK).alias("is_rtx"),
        column_or_null(gpus, "recommended_psu").alias("recommended_psu"),
        F.col("source").alias("website_source"),
    )


def stg_laptops(
    laptops: DataFrame,
    default_ram_gb: int = DEFAULT_RAM_GB,
    default_cpu: str | None = None,
    with_weight: bool = False,
    updated_at: Column | None = None,
    name_prefix: int | None = NAME_PREFIX,
) -> DataFrame:
    """Laptops with descriptions in lower case and typed memory size.

    Without a processor the first ``name_prefix`` characters of the name describe it, with None the whole name.

    ``default_ram_gb=0``, ``default_cpu='unknown cpu'`` and ``with_weight`` give the older form of the view.
    """
    name, cpu = F.col("name"), column_or_null(laptops, "cpu")
    described = [cpu, name if name_prefix is None else F.left(name, F.lit(name_prefix))]
    if default_cpu is not None:
        described.append(F.lit(default_cpu))
    graphics = [column_or_null(laptops, c) for c in ("graphics_card", "gpu", "integrated_graphics")]
    columns = [
        F.coalesce(name, column_or_null(laptops, "model"), column_or_null(laptops, "model_name")).alias("laptop_name"),
        column_or_null(laptops, "brand").alias("brand"),
        F.col("source").alias("website_source"),
        F.lower(F.coalesce(*described)).alias("cpu_description"),
        F.coalesce(first_int(column_or_null(laptops, "memory_type")), F.lit(default_ram_gb)).alias("ram_gb"),
        F.lower(F.coalesce(*graphics)).alias("gpu_description"),
        (F.current_timestamp() if updated_at is None else updated_at).alias(UPDATED_AT),
    ]
    if with_weight:
        columns.append(column_or_null(laptops, "weight").alias("weight"))
    return laptops.filter(name.isNotNull()).select(*columns)
