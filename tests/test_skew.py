"""One key holds a third of all rows: the results stay whole and equal the plain form."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from siliscope.operators import quality as Q
from siliscope.operators.dedupe import deduplicate
from siliscope.operators.neighbours import order_range
from siliscope.session import scratch_path
from siliscope.sources import bronze as B


@pytest.fixture(scope="module")
def skewed(spark):
    third = F.col("id") % 3
    return spark.range(30_000).select(
        "id",
        F.when(third == 0, 7).otherwise(F.xxhash64("id") % 50).alias("g"),
        F.when(third == 1, 5).otherwise(F.xxhash64("id", F.lit(1)) % 9000).alias("v"),
    )


def test_sequential_values(skewed, rows):
    window = Window.partitionBy("g").orderBy("v")
    plain = skewed.select("g", "v", F.lag("v").over(window).alias("previous_v")).filter("NOT v = previous_v + 1")
    found = Q.sequential_values(skewed, "v", group_by=["g"])
    assert rows(found) == rows(plain)


def test_mutually_exclusive_ranges(skewed, rows):
    window = Window.partitionBy("g").orderBy("v")
    plain = skewed.select(F.col("g").alias("partition_by_col"), F.col("v").alias("lower_bound"), F.lead("v").over(window).alias("next_lower_bound"))
    plain = plain.filter("NOT coalesce(lower_bound + 2 <= next_lower_bound, true)")
    found = Q.mutually_exclusive_ranges(skewed, "v", "v + 2", "g")
    assert rows(found.select(plain.columns)) == rows(plain)


def test_range_checks_put_no_key_into_one_task_and_write_nothing(skewed):
    found = Q.sequential_values(skewed, "v", group_by=["g"])
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert "Scan ExistingRDD" not in final  # no checkpoint
    # Rows move when they are counted, by range, and when copies are dealt out; the subqueries move single numbers and the sample.
    assert "RangePartitioning" not in final and final.count("hashpartitioning(_range") >= 1
    ranged = skewed.select(order_range(skewed, ["g", "v"], 32).alias("r")).groupBy("r").count().collect()
    assert len(ranged) > 20
    distinct = skewed.select("g", "v").distinct()
    sizes = [r["count"] for r in distinct.select(order_range(skewed, ["g", "v"], 32).alias("r")).groupBy("r").count().collect()]
    assert max(sizes) < 4 * sum(sizes) / 32


def test_ranges_follow_the_order(spark):
    df = spark.createDataFrame([(None, "b"), ("x", None), ("x", "a"), (None, None), ("a", "z"), ("x", "b")], "g string, v string")
    for ranges in (1, 2, 5, 100):
        numbered = df.select("g", "v", order_range(df, ["g", "v"], ranges).alias("r")).collect()
        order = sorted(numbered, key=lambda t: (t.g is None, t.g or "", t.v is None, t.v or ""))
        assert [t.r for t in order] == sorted(t.r for t in order) and all(0 <= t.r < max(1, (ranges**0.5 + 1) ** 2) for t in order)
    assert df.limit(0).select(order_range(df.limit(0), ["g"], 4).alias("r")).count() == 0


def test_relationships_where(skewed, rows):
    partners = skewed.filter("v % 2 = 0").select("v")
    found = Q.relationships_where(skewed, "v", partners, "v")
    assert found.count() == skewed.join(partners.distinct(), "v", "left_anti").count() > 10_000


def test_deduplicate(skewed, rows):
    first = skewed.groupBy("g").agg(F.max(F.struct("v", -F.col("id"))).alias("m"))
    plain = first.select((-F.col("m.col2")).alias("id"), "g", "m.v")
    assert rows(deduplicate(skewed, ["g"], [F.col("v").desc()])) == rows(plain)


def test_a_hot_source_is_written_as_several_files(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        path = scratch_path(spark, "skew")
        rows = spark.range(0, 200_000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("url"),
            F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("source"),
            F.lit("cpu").alias("category"),
        )
        B.write_bronze(rows, path)
        stored = B.read_partitioned_bronze(spark, path)
        named = stored.select("source", F.input_file_name().alias("file")).distinct()
        files = {r["source"]: r["count"] for r in named.groupBy("source").count().collect()}
        assert files.pop("big") >= 2 and min(files.values()) == 1
        assert stored.count() == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
