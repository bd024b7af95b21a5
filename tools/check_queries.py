"""Compare the registered queries with their SQL on DuckDB.

usage: python tools/check_queries.py [folder] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import duckdb  # noqa: E402
import pyarrow as pa  # noqa: E402

from siliscope.registry import all_queries  # noqa: E402
from siliscope.session import get_spark  # noqa: E402
from siliscope.sources.tables import DATA_TABLES  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in DATA_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _kind(kind: pa.DataType) -> str:
    if pa.types.is_decimal(kind):
        return f"decimal({kind.scale})"
    if pa.types.is_timestamp(kind):
        return "timestamp"
    return "string" if pa.types.is_large_string(kind) else str(kind)


def rows_of(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=repr) if columns else []


def compare(ours: pa.Table, theirs: pa.Table) -> str | None:
    """What differs, or None."""
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} against {sorted(theirs.column_names)}"
    kinds = [(n, _kind(ours.schema.field(n).type), _kind(theirs.schema.field(n).type)) for n in ours.column_names]
    wrong = [k for k in kinds if k[1] != k[2]]
    if wrong:
        return f"types {wrong}"
    a, b = rows_of(ours), rows_of(theirs)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"row {x} against {y}"
    return None


def main(folder: str, names: list[str]) -> int:
    spark = get_spark(cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name, query in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            ours = query.run(spark, folder).toArrow()
            took = time.time() - start
            if query.sql is None:
                result = f"no SQL, {ours.num_rows} rows"
            else:
                difference = compare(ours, con.execute(query.sql).to_arrow_table())
                result = f"ok, {ours.num_rows} rows" if difference is None else f"DIFFERS {difference}"
                failed += difference is not None
        except Exception as error:  # noqa: BLE001
            took, result = time.time() - start, f"ERROR {str(error)[:600]}"
            failed += 1
        print(f"{name:38s} {took:6.2f}s {result}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])))
