"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default all)
BENCH_RUNS    runs per query, the median counts (default 3)
BENCH_DUCKDB  1: also time the checking SQL on DuckDB
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from siliscope.plans import gold, market, silver  # noqa: E402
from siliscope.registry import all_queries  # noqa: E402
from siliscope.session import get_spark  # noqa: E402
from siliscope.sources.derived import derived_catalogue  # noqa: E402
from siliscope.sources.tables import read_table  # noqa: E402

HEADLINE = [
    "stg_cpus", "stg_gpus", "stg_laptops", "fact_hardware_recommendations", "fact_laptop_rankings",
    "master_catalog", "value_topk", "sync_report", "extract_links", "base_record", "cap_links",
    "deduplicate", "pivot", "unpivot", "union_relations", "surrogate_key", "width_bucket", "slugify",
    "relationships_where", "cardinality_equality", "equality", "unique_combination_of_columns", "not_constant",
    "sequential_values", "sequential_values_grouped", "mutually_exclusive_ranges", "mutually_exclusive_ranges_global",
    "dq_run",
]


def offers(spark, folder):
    """One product record per order line: the models at the size of the largest table."""
    catalogue = derived_catalogue(read_table(spark, folder, "part"))
    lines = read_table(spark, folder, "lineitem").select("l_partkey")
    return silver.sync_clean(lines.join(catalogue, lines["l_partkey"] == catalogue["item_id"]).drop("l_partkey"))


def _laptops(spark, folder):
    return silver.stg_laptops(offers(spark, folder)).drop(silver.UPDATED_AT)


OFFERS = {
    "offers_stg_cpus": lambda s, f: silver.stg_cpus(offers(s, f)),
    "offers_stg_gpus": lambda s, f: silver.stg_gpus(offers(s, f)),
    "offers_stg_laptops": _laptops,
    "offers_fact_hardware_recommendations": lambda s, f: gold.fact_hardware_recommendations(_laptops(s, f)),
    "offers_fact_laptop_rankings": lambda s, f: gold.fact_laptop_rankings(_laptops(s, f)),
    "offers_value_topk": lambda s, f: market.value_topk(market.master_catalog_from_bronze(offers(s, f))),
}


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_spark("siliscope-bench", cores=cores)
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: all_queries()[name].run for name in HEADLINE} | OFFERS
    seconds = {}
    for name, query in queries.items():
        times = [timed(lambda: query(spark, folder).write.format("noop").mode("overwrite").save()) for _ in range(runs)]
        seconds[name] = round(statistics.median(times), 3)
    out = {
        "metric": "sum of the median seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rsplit("sf", 1)[-1],
        "cpus": cores,
        "runs": runs,
    }
    if os.environ.get("BENCH_DUCKDB") == "1":
        import duckdb

        from siliscope.sources.tables import DATA_TABLES

        con = duckdb.connect()
        con.execute(f"SET threads = {cores}")
        for name in DATA_TABLES:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
        out["duckdb"] = {
            name: round(
                statistics.median(timed(lambda: con.execute(all_queries()[name].sql).to_arrow_table()) for _ in range(runs)), 3
            )
            for name in HEADLINE
            if all_queries()[name].sql
        }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
