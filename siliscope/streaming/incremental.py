"""Hourly refresh as an incremental file stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import latest_snapshot
from ..plans.silver import sync_clean, valid_record
from ..session import scratch_path
from ..sources import versions as V

BUCKETS = 64
_TABLE, _BUCKET, _SHOWN = "_table", "_bucket", "_shown"


def _new_files(
    spark: SparkSession, source_path: str, schema: T.StructType, path_glob: str | None, max_files_per_trigger: int, plain_subfolders: bool
) -> DataFrame:
    reader = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", str(plain_subfolders).lower())
        .option("maxFilesPerTrigger", max_files_per_trigger)
    )
    if path_glob is not None:
        reader = reader.option("pathGlobFilter", path_glob)
    return reader.parquet(source_path)


def incremental_append(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    target_path: str,
    checkpoint_path: str,
    transform: Callable[[DataFrame], DataFrame] = sync_clean,
    path_glob: str | None = None,
    max_files_per_trigger: int = 10_000,
    plain_subfolders: bool = False,
) -> DataFrame:
    """Process the files that arrived since the last run, append the result, and return the whole target.

    The run is stateless per row and stops when all files are done. The file
    sink commits each batch once, so a run that was cut off is repeated
    without doubled rows. Folders named ``column=value`` give their columns;
    ``plain_subfolders`` also reads folders with other names, without such columns.
    """
    cleaned = transform(_new_files(spark, source_path, schema, path_glob, max_files_per_trigger, plain_subfolders))
    run = (
        cleaned.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target_path)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.schema(cleaned.schema).parquet(target_path)


def _bucket(key: str, buckets: int) -> Column:
    """Records with a key lie by it; those without one all stay, so they lie by their name."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(key), F.col("name"))), F.lit(buckets)).cast("int")


def upsert_batch(
    batch: DataFrame, tables_path: str, stream: str, batch_id: int, table: Column, key: str, loaded_at: str, buckets: int
) -> list[str]:
    """Put the records of one batch into the tables they belong to; returns the names of the tables that changed.

    Only the buckets of the batch's keys are read and written again. A table that has seen the batch before is left
    alone, so a batch may be repeated after a failure at any point. A bucket holds the last record of each key, also
    those that cleaning drops, apart from the others, so that an older record that arrives later does not come back.
    Records of no table are left out.
    """
    spark = batch.sparkSession
    staged_path = scratch_path(spark, "batch")
    # Of each key the last record of the batch is enough; the batch is read once.
    placed = batch.withColumn(_TABLE, table).filter(F.col(_TABLE).isNotNull())
    latest = latest_snapshot(placed, loaded_at, [_TABLE, key])
    latest = latest.withColumn(_BUCKET, _bucket(key, buckets))
    latest.write.parquet(staged_path)
    staged = spark.read.schema(latest.schema).parquet(staged_path)
    touched: dict[str, list[int]] = {}
    for row in staged.select(_TABLE, _BUCKET).distinct().collect():  # tables times buckets at most
        touched.setdefault(row[_TABLE], []).append(row[_BUCKET])
    versions = {name: V.current(spark, f"{tables_path}/{name}") for name in touched}
    due = [name for name, base in versions.items() if base is None or base.progress.get(stream, -1) < batch_id]
    for name in due:
        if versions[name] is not None and versions[name].buckets != buckets:
            raise ValueError(f"{name} has {versions[name].buckets} buckets, not {buckets}")
    if not due:
        return []
    merged, stored = staged.filter(F.col(_TABLE).isin(due)).drop(_BUCKET), False
    for name in due:
        base = versions[name]
        if base is not None:
            own = {str(b) for b in touched[name]}
            for parts in (base.parts, base.hidden):
                old = {b: folder for b, folder in parts.items() if b in own}
                if old:
                    rows = V.read_folders(spark, f"{tables_path}/{name}", base, old).withColumn(_TABLE, F.lit(name))
                    merged, stored = merged.unionByName(rows, allowMissingColumns=True), True
    # The staged rows are the last of their keys already.
    merged = latest_snapshot(merged, loaded_at, [_TABLE, key]) if stored else merged
    shown = F.coalesce(valid_record(), F.lit(False))
    merged = merged.withColumn(_BUCKET, _bucket(key, buckets)).withColumn(_SHOWN, shown)
    kept = T.StructType([merged.schema[name] for name in merged.columns if name not in (_TABLE, _BUCKET, _SHOWN)])
    folder = V.new_data_folder()
    # One write for all tables; each table then takes its own folders.
    written = f"{tables_path}/_writes/{folder.split('/')[1]}"
    merged.hint("rebalance", _TABLE, _BUCKET).write.partitionBy(_TABLE, _BUCKET, _SHOWN).parquet(written)
    for name in due:
        V.move_in(spark, f"{written}/{_TABLE}={name}", f"{tables_path}/{name}", folder)
        found = V.partition_folders(spark, f"{tables_path}/{name}", folder, 2)
        base, own = versions[name], {str(b) for b in touched[name]}
        parts = {b: f for b, f in (base.parts if base else {}).items() if b not in own}
        hidden = {b: f for b, f in (base.hidden if base else {}).items() if b not in own}
        for place, path in found.items():
            bucket, visible = (text.split("=")[1] for text in place.split("/"))
            (parts if visible == "true" else hidden)[bucket] = path
        progress = {**(base.progress if base else {}), stream: batch_id}
        schema = V.merged_schema(base, kept)
        V.publish(spark, f"{tables_path}/{name}", base, schema=schema, parts=parts, hidden=hidden, buckets=buckets, progress=progress)
    return due


def incremental_sync(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    tables_path: str,
    checkpoint_path: str,
    table: Column,
    transform: Callable[[DataFrame], DataFrame] = lambda records: records,
    key: str = "url",
    loaded_at: str = "loaded_at",
    buckets: int = BUCKETS,
    max_files_per_trigger: int = 10_000,
) -> None:
    """Upsert the records of the files that arrived since the last run into bucketed, published tables.

    ``table`` names the table of a record; of each key the record with the latest ``loaded_at`` stays, and a key whose
    last record cleaning drops disappears, as if the tables had been made from the whole history. Stops when all files
    are done. A run that was cut off anywhere is repeated without loss or doubled rows.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        upsert_batch(batch, tables_path, stream, batch_id, table, key, loaded_at, buckets)

    records = transform(_new_files(spark, source_path, schema, None, max_files_per_trigger, False))
    run = records.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
    run.awaitTermination()
