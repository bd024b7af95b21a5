from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from siliscope.operators import reshape as R
from siliscope.operators.dedupe import deduplicate, latest_snapshot
from siliscope.operators.neighbours import repeat_rows, with_neighbour
from siliscope.operators.ranking import global_rank
from siliscope.operators.scalar import get_single_value, single_value
from siliscope.operators.series import date_spine, generate_series, intervals_between
from siliscope.sources.tables import read_table, spread, tables_by_pattern, tables_by_prefix, union_tables_by_pattern


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- columns ---


def test_star_and_filtered_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "field_1 int, field_2 int, FIELD_3 int")
    assert R.filtered_columns(df, ["FIELD_2"]) == ["field_1", "FIELD_3"]
    assert df.select(*R.star(df, ["field_3"], prefix="p_", suffix="_s")).columns == ["p_field_1_s", "p_field_2_s"]
    assert df.alias("t").select(*R.star(df, relation_alias="t")).columns == df.columns
    assert R.star(df, df.columns) == []


def test_nullcheck_table_keeps_blanks(spark, rows):
    df = spark.createDataFrame([("", 0, " "), (None, 1, "x")], "a string, b int, c string")
    assert rows(R.nullcheck_table(df)) == [(None, 0, " "), (None, 1, "x")]


def test_base_model(spark):
    df = spark.createDataFrame([(1,)], "MixedCase int")
    assert R.base_model(df).columns == ["mixedcase"]
    assert R.base_model(df, case_sensitive=True).columns == ["MixedCase"]


def test_column_values(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("c", 2), (None, 9)], "field string, x int")
    assert R.column_value_list(df, "field", 99) == ["b", "a", "c", None]
    assert R.column_value_list(df, "field", max_records=1) == ["b"]
    assert R.column_value_list(df, "field", 99, where="x = 2") == ["b", "c"]
    assert R.column_value_list(df, "field", 99, order_by=[(F.max("x"), False)])[0] is None
    assert R.column_value_list(df, "field", 99, where="x = 77", default=["z"]) == ["z"]
    assert R.column_value_list(None, "field", 99, default=["z"]) == ["z"]
    with pytest.raises(ValueError):
        R.column_value_list(None, "field", 99)


# --- pivot, unpivot, union ---


def test_pivot(spark, rows):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "red"), ("M", "red"), ("L", "blue's")], "size string, color string")
    out = R.pivot(df, ["size"], "color", ["red", "blue", "blue's"])
    assert out.columns == ["size", "red", "blue", "blue's"]
    assert rows(out) == [("L", 0, 0, 1), ("M", 1, 0, 0), ("S", 2, 1, 0)]
    slugged = R.pivot(df, ["size"], "color", ["blue's"], prefix="0 ", quote_identifiers=False)
    assert slugged.columns == ["size", "_0_blues"]
    other = R.pivot(df, ["size"], "color", ["red"], cmp="!=", agg="max", then_value=5, else_value=None)
    assert rows(other) == [("L", 5), ("M", None), ("S", 5)]
    distinct = R.pivot(df, ["size"], "color", ["red"], distinct=True)
    assert rows(distinct) == [("L", 0), ("M", 1), ("S", 1)]


@pytest.mark.parametrize("agg", ["sum", "count"])
@pytest.mark.parametrize("else_value", [0, 5, None])
def test_distinct_pivot_equals_distinct_aggregates(spark, rows, agg, else_value):
    values = [("g", "a", 5), ("g", "a", 5), ("g", "a", None), ("g", "b", 7), ("g", None, 8), ("h", "b", 5), ("h", "b", 6), ("i", None, None), (None, "a", 1), (None, "a", 2)]
    df = spark.createDataFrame(values, "g string, v string, x int")
    two = R.pivot(df, ["g"], "v", ["a", "b", "no"], agg=agg, distinct=True, then_value="x", else_value=else_value)
    columns = R.pivot_columns("v", ["a", "b", "no"], agg=agg, distinct=True, then_value="x", else_value=else_value)
    assert rows(two) == rows(df.groupBy("g").agg(*columns)) and two.columns == ["g", "a", "b", "no"]
    assert "Expand" not in two._jdf.queryExecution().executedPlan().toString()


def test_pivot_map(spark):
    df = spark.createDataFrame([("g", "a", 1), ("g", "a", 2), ("g", None, 3), ("h", "b", 4)], "g string, v string, x int")
    found = {r.g: r.cells for r in R.pivot_map(df, ["g"], "v", F.sum("x")).collect()}
    assert found == {"g": {"a": 3}, "h": {"b": 4}}
    with pytest.raises(ValueError):
        R.column_value_list(df, "v", None)


def test_unpivot(spark, rows):
    df = spark.createDataFrame([(1, "2020-01-01", True, 5, "x")], "customer_id int, created_at string, flag boolean, n int, name string")
    out = R.unpivot(df, exclude=["customer_id", "created_at"], remove=["NAME"], field_name="prop", value_name="val")
    assert out.columns == ["customer_id", "created_at", "prop", "val"]
    assert rows(out) == [(1, "2020-01-01", "flag", "true"), (1, "2020-01-01", "n", "5")]
    assert "Expand" in plan(out) and plan(out).count("Scan") == 1


def test_union_relations(spark, rows):
    a = spark.createDataFrame([(1, "drew")], "id int, name string")
    b = spark.createDataFrame([(1, "red", 7), (2, "blue", 8)], "ID bigint, favorite_color string, n int")
    out = R.union_relations({"a": a, "b": b})
    assert out.columns == ["_dbt_source_relation", "id", "name", "favorite_color", "n"]
    assert rows(out) == [("a", 1, "drew", None, None), ("b", 1, None, "red", 7), ("b", 2, None, "blue", 8)]
    assert dict(out.dtypes)["id"] == "int"
    slim = R.union_relations({"a": a, "b": b}, exclude=["NAME", "n"], source_column_name=None, where="id = 1")
    assert rows(slim) == [(1, None), (1, "red")]
    assert R.union_relations({"a": a, "b": b}, include=["ID"]).columns == ["_dbt_source_relation", "id"]
    wide = R.union_relations({"a": a, "b": b}, column_override={"id": "string"})
    assert dict(wide.dtypes)["id"] == "string"
    with pytest.raises(ValueError):
        R.union_relations({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        R.union_relations({"a": a}, include=["nothing"])


def test_tables_by_pattern(spark, rows):
    for name in ("pat_events_1", "pat_events_2", "pat_other"):
        spark.range(2).createOrReplaceTempView(name)
    assert tables_by_prefix(spark, "PAT_EVENTS_") == ["pat_events_1", "pat_events_2"]
    assert tables_by_pattern(spark, "pat%", exclude="%events%") == ["pat_other"]
    assert union_tables_by_pattern(spark, "pat_events__").count() == 4
    with pytest.raises(ValueError):
        union_tables_by_pattern(spark, "pat_nothing%")


# --- dedupe ---


def test_deduplicate(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, None, "c"), (2, None, "b"), (None, 3, "x")], "user_id int, version int, t string")
    out = deduplicate(df, ["user_id"], [F.col("version").desc_nulls_last()])
    assert rows(out) == [(1, 2, "b"), (2, None, "b"), (None, 3, "x")]


def test_deduplicate_limits_groups_before_the_shuffle(spark, data):
    events = read_table(spark, data, "events")
    text = plan(deduplicate(events, ["user_id"], [F.col("ts").desc()]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_latest_snapshot_with_a_map_column(spark, rows):
    df = spark.createDataFrame([("u", 1, {"a": "1"}), ("u", 2, {"a": "2"})], "url string, loaded int, specs map<string,string>")
    assert [r["specs"] for r in latest_snapshot(df, "loaded").collect()] == [{"a": "2"}]


# --- series and single values ---


def test_series(spark, rows):
    assert rows(generate_series(spark, 3)) == [(1,), (2,), (3,)]
    with pytest.raises(ValueError):
        generate_series(spark, 0)


def test_date_spine(spark):
    days = date_spine(spark, "day", dt.date(2018, 1, 1), dt.date(2018, 1, 10))
    assert [r[0] for r in days.orderBy("date_day").collect()] == [dt.date(2018, 1, d) for d in range(1, 10)]
    months = date_spine(spark, "month", dt.date(2018, 1, 31), dt.date(2018, 4, 1))
    assert [r[0] for r in months.orderBy("date_month").collect()] == [dt.date(2018, 1, 31), dt.date(2018, 2, 28), dt.date(2018, 3, 31)]
    hours = date_spine(spark, "hour", dt.datetime(2018, 1, 1, 0, 30), dt.datetime(2018, 1, 1, 2, 10))
    assert [r[0].hour for r in hours.orderBy("date_hour").collect()] == [0, 1]
    with pytest.raises(ValueError):
        date_spine(spark, "day", dt.date(2018, 1, 1), dt.date(2018, 1, 1))


def test_intervals_count_boundaries(spark):
    pair = F.lit("2024-01-01 00:30:00"), F.lit("2024-01-01 01:10:00")
    assert spark.range(1).select(intervals_between(*pair, "hour"), intervals_between(*pair, "day")).first()[:] == (1, 0)


def test_single_value(spark, rows):
    df = spark.createDataFrame([(5,)], "x int")
    assert rows(single_value(df, default=9)) == [(5,)]
    assert rows(single_value(df.filter("x > 5"), default=9)) == [(9,)]
    assert rows(single_value(df.select(F.lit(None).cast("int").alias("x")), default=9)) == [(None,)]
    assert rows(df.select(F.col("x") + get_single_value(spark.range(3).agg(F.max("id"))))) == [(7,)]


# --- global order ---


def test_global_rank_equals_the_plain_window(spark, data, rows):
    lines = read_table(spark, data, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("q"), F.nullif("l_linenumber", F.lit(3)).alias("n"))
    ours = global_rank(lines, {"by_q": "q", "by_n": "n"}).select("l_orderkey", "l_linenumber", "q", "n", "by_q", "by_n")
    plain = lines.select(
        "*",
        F.rank().over(Window.orderBy(F.col("q").desc_nulls_last())).cast("long").alias("by_q"),
        F.rank().over(Window.orderBy(F.col("n").desc_nulls_last())).cast("long").alias("by_n"),
    )
    assert rows(ours) == rows(plain)


def _unordered(df):
    return df.select("g", "v").distinct()


@pytest.mark.parametrize("following", [True, False])
@pytest.mark.parametrize("shape", ["many", "one group", "three rows", "none"])
def test_with_neighbour_equals_the_plain_window(spark, rows, following, shape):
    df = spark.range(5000).select((F.col("id") % 7).alias("g"), F.nullif((F.col("id") * 37) % 900, F.lit(5)).alias("v"))
    df = _unordered(df)
    df = {"many": df, "one group": df.filter("g = 3"), "three rows": df.filter("g = 1 and v < 40").limit(3), "none": df.filter("g < 0")}[shape]
    if shape == "three rows":
        df = spark.createDataFrame([(1, 3), (1, None), (2, 4)], "g bigint, v bigint")
    window = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_last())
    move = F.lead if following else F.lag
    assert rows(with_neighbour(df, ["g"], ["v"], "v", "w", following)) == rows(df.withColumn("w", move("v").over(window)))


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 250_001)], "k string, n bigint")
    assert {r["k"]: r["count"] for r in repeat_rows(df, "n").groupBy("k").count().collect()} == {"b": 1, "c": 250_001}


def test_spread_deals_out_a_file_of_one_row_group(spark, tmp_path):
    """Many splits of a file may hold one row group, which then lies in one of them."""
    spark.range(20_000).coalesce(1).write.parquet(str(tmp_path / "one"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        table = spark.read.parquet(str(tmp_path / "one"))
        assert table.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        rows = spread(table).groupBy(F.spark_partition_id().alias("part")).count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sum(r["count"] for r in rows) == 20_000
    assert max(r["count"] for r in rows) <= 20_000 // 2
