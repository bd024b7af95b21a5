"""What the operators of this folder share: nesting of rows, tables in the shared folder, words as regular expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# A word is a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"
ROW = "row"


def nested(table: DataFrame) -> DataFrame:
    """The whole row as one struct, so that helper columns cannot clash with the table's own names."""
    return table.select(F.struct(*[F.col(f"`{name}`") for name in table.columns]).alias(ROW))


def unnested(table: DataFrame, names: list[str], **more: Column) -> DataFrame:
    """The columns ``names`` of the nested row; a column of ``more`` replaces one of the same name."""
    kept = [F.col(f"{ROW}.`{name}`").alias(name) for name in names if name not in more]
    return table.select(*kept, *[column.alias(name) for name, column in more.items()])


def stored(table: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it again: later jobs start from files, not from lineage."""
    spark = table.sparkSession
    path = scratch_path(spark, name)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


BATCH_ROWS = 1000


def texts_for_python(table: DataFrame) -> DataFrame:
    """The same table; Arrow batches that go to Python get at most BATCH_ROWS rows, as texts can be long."""
    conf = table.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return table


def shuffle_partitions(spark: SparkSession) -> int:
    """The number of partitions the cluster's owner has chosen for a shuffle of this input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def utf8_bytes(column: str = "text") -> Column:
    return F.encode(text_or_empty(column), "UTF-8")
