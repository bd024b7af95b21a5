"""Parquet storage of product records: append, read by column name, replace, and audit."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.reshape import quoted
from . import versions as V

# Records that name the crawl they come from are stored by it: a page cannot change that column.
RESOURCE = "resource"
PARTITIONS = ["category", "source"]
# Integer types from narrow to wide; mixed with a fraction they become double.
_INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_FRACTIONS = [T.FloatType(), T.DoubleType()]
# A conflict of types reaches Python as it is thrown in the JVM.
_READ_ERRORS = (PySparkException, Py4JJavaError)


def widest_type(kinds: Sequence[T.DataType]) -> T.DataType:
    """One type that holds all of them: the wider number, else text."""
    distinct = [k for k in dict.fromkeys(kinds) if not isinstance(k, T.NullType)]
    if not distinct:
        return T.StringType()
    if len(distinct) == 1:
        return distinct[0]
    if all(k in _INTEGERS for k in distinct):
        return max(distinct, key=_INTEGERS.index)
    if all(k in _INTEGERS or k in _FRACTIONS for k in distinct):
        return T.DoubleType()
    return T.StringType()


def _files(spark: SparkSession, path: str) -> list[str]:
    """The Parquet files below a folder, in the order they were written; no file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return [row.path for row in sorted(listed.select("path", "modificationTime").collect(), key=lambda r: (r.modificationTime, r.path))]


def _conflict(error: Exception) -> bool:
    return "CANNOT_MERGE_SCHEMAS" in str(error) or "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE" in str(error)


def _agree(one: T.StructType, other: T.StructType) -> bool:
    kinds = {field.name.lower(): field.dataType for field in one.fields}
    return all(kinds.get(field.name.lower(), field.dataType) == field.dataType for field in other.fields)


def _by_schema(spark: SparkSession, files: list[str], options: dict[str, str]) -> list[list[str]]:
    """Files in groups that agree in the types of their columns.

    Spark reads the footers of all files in one job. Only where it meets a conflict are the files, in the order they
    were written, split in halves: a type changes at a few moments, so the jobs follow the logarithm of their number.
    Groups that agree are joined, so that there is one scan per set of types.
    """

    def merged(some: list[str]) -> T.StructType:
        return spark.read.options(**options).parquet(*some).schema

    todo, groups = [files], []
    while todo:
        some = todo.pop()
        try:
            schema = merged(some)
        except _READ_ERRORS as error:
            if len(some) == 1 or not _conflict(error):
                raise
            todo += [some[: len(some) // 2], some[len(some) // 2 :]]
            continue
        same = next((group for group in groups if _agree(group[0], schema)), None)
        if same is None:
            groups.append([schema, list(some)])
        else:
            more = [f for f in schema.fields if f.name.lower() not in {n.lower() for n in same[0].names}]
            same[0] = T.StructType([*same[0].fields, *more])
            same[1] += some
    return [found for _, found in groups]


def _resource(spark: SparkSession, path: str) -> list[DataFrame]:
    """One folder: with its partition columns, or, if its files lie in plain subfolders, all of them.

    One table for all its files, or one for each set of types if a column has changed its type.
    """
    for more in ({}, {"recursiveFileLookup": "true"}):
        options = {"mergeSchema": "true", **more}
        try:
            return [spark.read.options(**options).parquet(path)]
        except _READ_ERRORS as error:
            if _conflict(error):
                options = {**options, **({} if more else {"basePath": path})}
                return [spark.read.options(**options).parquet(*files) for files in _by_schema(spark, _files(spark, path), options)]
            if more or not isinstance(error, AnalysisException) or error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
    raise AssertionError("not reached")


def _united(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all parts, matched by column name, each column as the widest of its types."""
    kinds: dict[str, list[T.DataType]] = {}
    names: dict[str, str] = {}
    for part in parts:
        for field in part.schema.fields:
            kinds.setdefault(field.name.lower(), []).append(field.dataType)
            names.setdefault(field.name.lower(), field.name)
    target = {key: widest_type(found) for key, found in kinds.items()}
    aligned = [
        part.select(
            *[quoted(f.name).cast(target[f.name.lower()]).alias(names[f.name.lower()]) for f in part.schema.fields]
        )
        for part in parts
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def read_bronze(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All records below the given folders, matched by column name.

    Each folder is one resource with its own columns. A column that is missing in a folder or file is NULL there; one
    that differs in type between folders, or between files of one folder, is read as the wider type.
    """
    return _united([part for path in paths for part in _resource(spark, path)])


def write_bronze(records: DataFrame, path: str, mode: str = "append") -> None:
    """Append records below ``path``, one folder per resource, or per category and source without that column.

    Rebalancing gives each folder few, even files, and splits the folder of a
    source that holds most of the rows.
    """
    folders = [RESOURCE] if RESOURCE in records.columns else PARTITIONS
    records.hint("rebalance", *folders).write.mode(mode).partitionBy(*folders).parquet(path)


def read_partitioned_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The dataset that ``write_bronze`` makes, with the columns of all appends; filters on the folder columns skip folders."""
    return _united(_resource(spark, path))


def _write_version(df: DataFrame, path: str, partition_by: Sequence[str]) -> tuple[dict[str, str], dict[str, str], V.Manifest]:
    """Write ``df`` and publish it: (what the rows sent add up to, the parts written, the new version)."""
    spark = df.sparkSession
    base, folder, sent = V.current(spark, path), V.new_data_folder(), Observation()
    writer = df.observe(sent, *V.digest_columns(df.schema)).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{folder}")
    digest = V.digest_of(sent.get)
    if partition_by:
        written = V.partition_folders(spark, path, folder, len(partition_by))
        kept = base.parts if base and base.partition_by == list(partition_by) else {}
        schema = V.merged_schema(base, df.schema)
    else:
        written, kept, schema = {"": folder}, {}, df.schema.jsonValue()
    manifest = V.publish(
        spark, path, base, schema=schema, parts=kept | written, partition_by=list(partition_by), digest=None if kept else digest
    )
    return digest, written, manifest


def refresh_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Publish ``df`` as the next version of the table at ``path`` and return the number of rows sent.

    With partitions only the partitions that occur in ``df`` are replaced. Readers see the old version until all rows
    are stored; of two writers that start from the same version one gets a PublishConflict.
    """
    return int(_write_version(df, path, partition_by)[0]["rows"])


def refresh_audit(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the table, then compare the rows sent with the rows found on reading it again.

    They match if their number, and the sum and xor of their hashes, are the same.
    """
    sent, written, manifest = _write_version(df, path, partition_by)
    stored = V.read_folders(df.sparkSession, path, manifest, written).select(*[quoted(name) for name in df.columns])
    same = [F.col(name).cast("string") == F.lit(total) for name, total in sent.items()]
    return stored.agg(*V.digest_columns(df.schema)).select(
        F.lit(int(sent["rows"])).cast("long").alias("rows_sent"),
        F.col("rows").alias("rows_stored"),
        reduce(lambda a, b: a & b, same).alias("matches"),
    )


def view_model(df: DataFrame, name: str) -> DataFrame:
    """Publish a lazy model under a name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def table_model(df: DataFrame, name: str, path: str) -> DataFrame:
    """Store a model and publish the stored rows under a name; readers of the name keep the version they began with."""
    refresh_table(df, path)
    return view_model(V.read_published(df.sparkSession, path), name)
