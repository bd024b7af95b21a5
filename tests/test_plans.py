from __future__ import annotations


import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from siliscope.plans import gold, market, refresh, silver
from siliscope.plans.extraction import extract_products
from siliscope.session import scratch_path
from siliscope.sources import bronze as B
from siliscope.sources import versions as V
from siliscope.sources.derived import derived_catalogue, product_pages
from siliscope.sources.tables import PRODUCT_TABLES, Sources
from siliscope.streaming import incremental
from siliscope.streaming.incremental import incremental_append, incremental_sync

LAPTOP = "name string, model string, brand string, source string, cpu string, memory_type string, gpu string, price_inr bigint, category string"


@pytest.fixture(scope="module")
def catalogue(part):
    return derived_catalogue(part)


def text_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- silver ---


def test_sync_clean_counts_what_it_drops(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 5), ("b", 0), ("c", None), (None, 0)], "name string, price_inr bigint")
    assert rows(silver.sync_clean(df)) == [("a", 1)]
    clean, seen = silver.sync_clean_observed(df)
    assert clean.count() == 1
    assert seen.get == {"rows_read": 5, "dropped_null_name": 2, "dropped_no_price": 2, "dropped_unread_price": 1}
    assert rows(silver.sync_report(df)) == [(5, 2, 2, 1, 1)]


def test_stg_cpus_keeps_the_predicate(spark):
    schema = "name string, brand string, source string, category string, cores string, speed string, tdp string"
    df = spark.createDataFrame(
        [("A Processor", "x", "s", "cpu", "6 Cores", "4.2GHz", "65W"), ("B", "x", "s", "cpu", "8", "3", None),
         ("C", "x", "s", "Processors", None, None, None), (None, "x", "s", "Processors", None, None, None),
         ("a processor", "x", "s", "cpu", None, None, None)],
        schema,
    )
    found = {r["cpu_full_name"]: r for r in silver.stg_cpus(df).collect()}
    assert set(found) == {"A Processor", "C"}
    assert (found["A Processor"]["core_count"], round(found["A Processor"]["clock_speed_ghz"], 2)) == (6, 4.2)
    assert (found["C"]["core_count"], found["C"]["clock_speed_ghz"], found["C"]["socket"]) == (0, None, None)
    assert silver.stg_cpus(df, categories=["cpu"]).count() == 3


def test_stg_gpus(spark):
    df = spark.createDataFrame([("RTX Graphics Card", "b", "s", "gpu", "8GB GDDR6"), ("Graphics Card x", "b", "s", "gpu", "n")], "name string, brand string, source string, category string, memory_size string")
    found = {r["gpu_full_name"]: (r["vram_gb"], r["is_rtx"]) for r in silver.stg_gpus(df).collect()}
    assert found == {"RTX Graphics Card": (8, True), "Graphics Card x": (0, False)}


def test_stg_laptops_and_its_older_form(spark):
    df = spark.createDataFrame([("N" * 60, "m", "b", "s", None, None, "RTX 4060", 1, "laptop"), ("X", None, "b", "s", "Core I7", "16GB", None, 1, "laptop"), (None, "m", "b", "s", None, None, None, 1, "laptop")], LAPTOP)
    found = {r["laptop_name"]: r for r in silver.stg_laptops(df).collect()}
    assert set(found) == {"N" * 60, "X"}
    first = found["N" * 60]
    assert (first["cpu_description"], first["ram_gb"], first["gpu_description"]) == ("n" * 50, 8, "rtx 4060")
    assert found["X"]["ram_gb"] == 16 and found["X"]["cpu_description"] == "core i7"
    older = silver.stg_laptops(df, default_ram_gb=0, default_cpu="unknown cpu", with_weight=True)
    assert {r["ram_gb"] for r in older.collect()} == {0, 16} and "weight" in older.columns


# --- gold ---


def _laptops(spark):
    return spark.createDataFrame(
        [("a", "b", "s", "core i9", 32, "rtx 5080"), ("b", "b", "s", "core i7", 16, "rtx 4060"),
         ("c", "b", "s", "core i5", 8, "rx 7900"), ("d", "b", "s", None, 4, None), ("e", "b", "s", "ryzen 7", 64, "integrated"),
         ("f Monitor", "b", "s", "ryzen 5", 16, "no"), ("g", "b", "s", "ryzen 5", 16, "no")],
        "laptop_name string, brand string, website_source string, cpu_description string, ram_gb int, gpu_description string",
    )


def test_hardware_scores(spark):
    found = {r["laptop_name"]: r for r in gold.fact_hardware_recommendations(_laptops(spark)).collect()}
    values = {k: (r["gaming_tier_score"], r["dev_score"], r["build_category"], r["global_rank"]) for k, r in found.items()}
    assert values == {
        "a": (100, 100, "Extreme Workstation", 1),
        "b": (85, 65, "High-End Gaming", 2),
        "c": (85, 25, "High-End Gaming", 3),
        "d": (20, 25, "Entry Level / Student", 7),
        "e": (20, 85, "DevOps/Data Science Ready", 4),
        "f Monitor": (20, 45, "Entry Level / Student", 5),
        "g": (20, 45, "Entry Level / Student", 5),
    }


def test_laptop_rankings(spark):
    found = {r["laptop_name"]: r for r in gold.fact_laptop_rankings(_laptops(spark)).collect()}
    values = {k: (r["coding_score"], r["gaming_score"], r["coding_rank"], r["gaming_rank"]) for k, r in found.items()}
    assert values == {
        "a": (13, 3, 1, 1), "b": (20, 15, 1, 1), "c": (12, 8, 5, 3), "d": (5, 3, 6, 3), "e": (20, 1, 1, 3), "g": (17, 1, 1, 3),
    }


def test_ranks_equal_the_plain_window_and_move_no_rows_into_one_task(catalogue, rows):
    laptops = silver.stg_laptops(silver.sync_clean(catalogue)).drop(silver.UPDATED_AT)
    ours = gold.fact_hardware_recommendations(laptops)
    total = F.col("gaming_tier_score") + F.col("dev_score")
    plain = gold.scored_hardware(laptops).withColumn("r", F.rank().over(Window.orderBy(total.desc())).cast("long"))
    assert rows(ours.select(*plain.columns[:-1], "global_rank")) == rows(plain)
    text = text_plan(ours)
    single = text[text.index("SinglePartition"):]
    assert text.count("SinglePartition") == 1 and "HashAggregate" in single and "BroadcastHashJoin" in text


# --- market ---


def test_catalogue_from_tables_and_from_one_dataset_agree(catalogue, rows):
    sources = Sources.from_bronze(catalogue)
    tables = {name: sources.table(name) for name in sources.names()}
    assert rows(market.master_catalog(tables)) == rows(market.master_catalog_from_bronze(silver.sync_clean(catalogue)))


def test_value_topk_ties_and_plan(spark, rows):
    df = spark.createDataFrame([(f"n{i % 3}", 1000, f"u{i}", "cpu") for i in range(9)] + [("x7950X", 1000, "u", "gpu")], "name string, price_inr bigint, url string, category string")
    found = market.value_topk(df)
    assert rows(found.select("name", "url")) == [("n0", "u0"), ("n0", "u3"), ("n0", "u6"), ("n1", "u1"), ("n1", "u4"), ("x7950X", "u")]
    assert [r["value_score"] for r in found.filter("category = 'gpu'").collect()] == [790.0]
    plan = text_plan(found)  # one scan of any number of categories, and a group limit on both sides of the shuffle
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("WindowGroupLimit") == 2
    odd = df.union(df.filter("category = 'gpu'").selectExpr("name", "price_inr", "url", "'ssd' AS category"))
    assert market.value_topk(odd).filter("category = 'ssd'").count() == 1


# --- storage ---


def test_read_bronze_widens_types_and_fills_columns(spark, rows):
    root = scratch_path(spark, "t")
    spark.createDataFrame([("a", 1, "x")], "name string, price_inr int, Cores string").write.parquet(f"{root}/one/deep")
    spark.createDataFrame([("b", "2", 5)], "name string, price_inr string, cores int").write.parquet(f"{root}/two")
    spark.createDataFrame([("c", 7)], "name string, tdp bigint").write.parquet(f"{root}/three")
    df = B.read_bronze(spark, [f"{root}/one", f"{root}/two", f"{root}/three"])
    assert rows(df.select("name", "price_inr", "Cores", "tdp")) == [("a", "1", "x", None), ("b", "2", "5", None), ("c", None, None, 7)]


def test_read_bronze_with_types_that_change_inside_a_folder(spark, rows):
    root = scratch_path(spark, "t")
    for k, kind in enumerate(["int", "bigint", "string", "int", "string", "double"]):
        df = spark.range(k, k + 1).select(F.col("id").cast(kind).alias("price_inr"), F.lit(k).alias("n"), F.lit("cpu").alias("category"))
        df = df.withColumn("tdp", F.lit(k)) if k == 5 else df
        df.write.mode("append").partitionBy("category").parquet(f"{root}/a")
        df.write.mode("append").parquet(f"{root}/b/deep/{k % 2}")
    found = B.read_bronze(spark, [f"{root}/a"])
    assert dict(found.dtypes)["price_inr"] == "string" and dict(found.dtypes)["category"] == "string"
    expected = [("0", 0, "cpu"), ("1", 1, "cpu"), ("2", 2, "cpu"), ("3", 3, "cpu"), ("4", 4, "cpu"), ("5.0", 5, "cpu")]
    assert rows(found.select("price_inr", "n", "category")) == expected
    assert rows(B.read_bronze(spark, [f"{root}/b"]).select("price_inr", "n", "category")) == expected
    assert rows(B.read_partitioned_bronze(spark, f"{root}/a").select("price_inr", "tdp")) == [(p, 5 if n == 5 else None) for p, n, _ in expected]
    numbers = scratch_path(spark, "t")
    spark.range(1).select(F.col("id").cast("int").alias("x")).write.parquet(numbers)
    spark.range(1).select(F.lit(0.5).alias("x")).write.mode("append").parquet(numbers)
    assert rows(B.read_bronze(spark, [numbers])) == [(0.0,), (0.5,)]


def test_write_bronze_appends_and_prunes(spark, catalogue):
    path = scratch_path(spark, "t")
    B.write_bronze(catalogue, path)
    B.write_bronze(catalogue.filter("category = 'ram'"), path)
    stored = B.read_partitioned_bronze(spark, path)
    assert stored.count() == catalogue.count() + catalogue.filter("category = 'ram'").count()
    assert "PartitionFilters: [isnotnull(category" in text_plan(stored.filter("category = 'ram'"))


def test_refresh_table_replaces_only_given_partitions(spark, rows):
    path = scratch_path(spark, "t")
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "x int, p string")
    assert B.refresh_table(df, path, ["p"]) == 3
    assert B.refresh_table(df.filter("x = 1"), path, ["p"]) == 1
    assert rows(V.read_published(spark, path)) == [(1, "a"), (3, "b")]
    whole = scratch_path(spark, "t")
    B.refresh_table(df, whole)
    assert rows(B.refresh_audit(df.filter("x > 1"), whole)) == [(2, 2, True)]


def test_models(spark, rows):
    df = spark.range(3)
    assert rows(B.view_model(df, "test_view_model")) == rows(spark.table("test_view_model"))
    stored = B.table_model(df, "test_table_model", scratch_path(spark, "t"))
    assert "FileScan" in text_plan(stored) and rows(stored) == rows(df)


def test_sources(spark, data, catalogue):
    found = Sources.from_folder(spark, data)
    assert "orders" in found and found.table("nation").count() == 25
    with pytest.raises(KeyError):
        found.table("nothing")
    everything = Sources.from_bronze(catalogue, by_category=False)
    assert everything.names() == list(PRODUCT_TABLES)
    assert everything.table("ram").count() == silver.sync_clean(catalogue).count()


# --- the whole refresh ---


def test_refresh_from_pages_to_models(spark, catalogue, rows):
    root = scratch_path(spark, "t")
    pages = product_pages(catalogue)
    refresh.ingest(pages, f"{root}/bronze")
    refresh.ingest(pages.filter("category = 'laptop'"), f"{root}/bronze")
    audit = refresh.sync(spark, f"{root}/bronze", f"{root}/tables")
    assert all(r["matches"] for r in audit.collect())
    tables = refresh.product_tables(spark, f"{root}/tables")
    once = pages.join(tables["laptops"].select("url").distinct(), "url").count()
    assert tables["laptops"].count() == 2 * once
    models = refresh.build_models(tables, f"{root}/models")
    assert set(models) == {
        "stg_cpus", "stg_gpus", "stg_laptops", "fact_hardware_recommendations", "fact_laptop_rankings",
        "master_catalog_final", "market_insights_final",
    }
    assert models["fact_laptop_rankings"].count() == models["fact_hardware_recommendations"].count() == 2 * once
    assert rows(spark.table("market_insights_final")) == rows(market.value_topk(models["master_catalog_final"]))
    whole = refresh.sync(spark, f"{root}/bronze", f"{root}/whole", by_category=False)
    assert len({r["rows_stored"] for r in whole.collect()}) == 1
    refresh.sync(spark, f"{root}/bronze", f"{root}/latest", latest_only=True)
    assert refresh.product_tables(spark, f"{root}/latest")["laptops"].count() == once


def test_an_empty_history_replaces_nothing(spark, catalogue):
    root = scratch_path(spark, "t")
    pages = product_pages(catalogue)
    refresh.ingest(pages, f"{root}/bronze")
    refresh.sync(spark, f"{root}/bronze", f"{root}/tables")
    before = refresh.product_tables(spark, f"{root}/tables")["ram"].count()
    extract_products(pages).filter("false").write.parquet(f"{root}/empty")
    assert refresh.sync(spark, f"{root}/empty", f"{root}/tables").isEmpty()
    assert refresh.product_tables(spark, f"{root}/tables")["ram"].count() == before > 0


def test_pages_can_be_ingested_as_a_stream(spark, catalogue, rows):
    root = scratch_path(spark, "t")
    pages = product_pages(catalogue)
    pages.write.parquet(f"{root}/pages")
    out = incremental_append(spark, f"{root}/pages", pages.schema, f"{root}/out", f"{root}/progress", transform=extract_products)
    assert rows(out.drop("specs")) == rows(extract_products(pages).drop("specs"))


# --- incremental refresh ---


def test_incremental_append_takes_each_file_once(spark, rows):
    root = scratch_path(spark, "t")
    schema = "name string, price_inr bigint"

    def arrive(*records):
        spark.createDataFrame(list(records), schema).coalesce(1).write.mode("append").parquet(f"{root}/in")

    def run():
        return incremental_append(spark, f"{root}/in", spark.read.parquet(f"{root}/in").schema, f"{root}/out", f"{root}/progress", max_files_per_trigger=1)

    arrive(("a", 1), (None, 2))
    assert rows(run()) == [("a", 1)]
    assert rows(run()) == [("a", 1)]
    arrive(("b", 3), ("c", 0))
    arrive(("d", 4))
    assert rows(run()) == [("a", 1), ("b", 3), ("d", 4)]


def test_checkpoints_refuse_a_local_folder_on_a_cluster(monkeypatch):
    from siliscope import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())

