from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siliscope.operators import quality as Q
from siliscope.operators.checks import Check, dq_run
from siliscope.sources.tables import read_table


def test_accepted_range(spark, rows):
    df = spark.createDataFrame([(-1,), (11,), (None,)], "id int")
    assert rows(Q.accepted_range(df, "id", -1, 11)) == []
    assert rows(Q.accepted_range(df, "id", -1, 11, inclusive=False)) == [(-1,), (11,)]
    assert rows(Q.accepted_range(df, "id", "-1 + 1")) == [(-1,)]
    assert rows(Q.accepted_range(df, "id")) == []


def test_expression_is_true(spark, rows):
    df = spark.createDataFrame([(0.5, 0.5), (0.0, 1.0), (None, 1.0), (1.0, 1.0)], "col_a double, col_b double")
    assert rows(Q.expression_is_true(df, "col_a + col_b = 1")) == [(1.0, 1.0)]
    assert rows(Q.expression_is_true(df, "+ col_b = 1", column="col_a")) == [(1.0, 1.0)]


def test_not_empty_string(spark, rows):
    df = spark.createDataFrame([("   ",), ("",), (None,), ("x  ",)], "string string")
    assert rows(Q.not_empty_string(df, "string")) == [("",), ("",)]
    assert rows(Q.not_empty_string(df, "string", trim_whitespace=False)) == [("",)]


def test_value_checks(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "city string")
    assert rows(Q.unique(df, "city")) == [("a", 2)]
    assert rows(Q.not_null(df, "city")) == [(None,), (None,)]
    assert rows(Q.accepted_values(df, "city", ["a"])) == [("b", 1)]
    assert rows(Q.not_accepted_values(df, "city", ["a", "z"])) == [("a",)]
    assert rows(Q.unique_combination_of_columns(df, ["city"])) == [("a",), (None,)]


def test_assert_equal_lets_null_pass(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 2)], "actual int, expected int")
    assert rows(Q.assert_equal(df, "actual", "expected")) == [(1, 2)]


def test_at_least_one(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", 1), ("b", None)], "field string, value int")
    assert rows(Q.at_least_one(df, "value")) == []
    assert rows(Q.at_least_one(df, "value", ["field"])) == [("b", 0)]
    assert rows(Q.at_least_one(df.filter("field = 'b'"), "value")) == [(0,)]
    assert rows(Q.at_least_one(df.filter("false"), "value")) == [(0,)]
    assert rows(Q.at_least_one(df.filter("false"), "value", ["field"])) == []


def test_not_constant(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", None), ("d", 4), ("d", None)], "field string, x int")
    assert rows(Q.not_constant(df, "x")) == []
    assert rows(Q.not_constant(df, "x", ["field"])) == [("a", 1), ("d", 1)]
    assert rows(Q.not_constant(df.filter("field = 'c'"), "x")) == []


def test_not_null_proportion(spark):
    df = spark.createDataFrame([(1, "g"), (None, "g"), (1, "h")], "point_5 int, g string")
    assert Q.not_null_proportion(df, "point_5", 0.5).isEmpty()
    assert not Q.not_null_proportion(df, "point_5", 0.7).isEmpty()
    assert not Q.not_null_proportion(df, "point_5", 0.1, 0.6).isEmpty()
    assert [r["g"] for r in Q.not_null_proportion(df, "point_5", 0.9, group_by=["g"]).collect()] == ["g"]


def test_recency(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', TIMESTAMP_NTZ '2024-01-01 13:00:00'), ('b', TIMESTAMP_NTZ '2024-01-01 11:00:00') AS t(k, created_at)")
    assert [r["k"] for r in Q.recency(df, "created_at", "day", 1, group_by=["k"], as_of="2024-01-02 12:00:00").collect()] == ["b"]
    assert Q.recency(df, "created_at", "day", 1, as_of="2024-01-02 12:00:00").isEmpty()
    assert Q.recency(df, "created_at", "day", 1, True, ["k"], as_of="2024-01-02 23:00:00").isEmpty()
    now = df.withColumn("created_at", F.current_timestamp() - F.expr("INTERVAL 23 HOURS"))
    assert Q.recency(now, "created_at", "day", 1).isEmpty()
    assert not Q.recency(now, "created_at", "hour", 22).isEmpty()


def test_relationships_where(spark, rows):
    a = spark.createDataFrame([(1,), (4,), (4,), (None,), (9,)], "id int")
    b = spark.createDataFrame([(1,), (2,), (9,), (9,)], "id int")
    assert rows(Q.relationships_where(a, "id", b, "id")) == [(4, None), (4, None)]
    assert rows(Q.relationships_where(a, "id", b, "id", from_condition="id <> 4")) == []
    assert rows(Q.relationships_where(a, "id", b, "id", "id <> 4", "id < 5")) == [(9, None)]


def test_cardinality_equality(spark, rows):
    a = spark.createDataFrame([("x",), ("x",), (None,)], "same_name string")
    b = spark.createDataFrame([("x", "x"), ("x", "y"), (None, None)], "same_name string, different_name string")
    assert rows(Q.cardinality_equality(a, "same_name", b, "same_name")) == []
    assert rows(Q.cardinality_equality(a, "same_name", b, "different_name")) == [("x", 1), ("x", 2), ("y", 1)]


def test_row_counts(spark, rows):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "f string")
    b = spark.createDataFrame([("x",), ("z",), (None,), (None,)], "f string")
    empty = a.filter("false")
    assert rows(Q.equal_rowcount(a, b)) == [(4, 4, 0)]
    assert rows(Q.equal_rowcount(a, empty)) == [(4, None, None)]
    grouped = [("x", "x", 2, 1, 1), ("y", None, 1, None, None), (None, "z", None, 1, None), (None, None, 1, None, None), (None, None, None, 2, None)]
    assert rows(Q.equal_rowcount(a, b, ["f"])) == grouped
    assert rows(Q.fewer_rows_than(a, b)) == [(4, 4, 1)]
    assert rows(Q.fewer_rows_than(a, a.union(b))) == [(4, 8, 0)]
    assert rows(Q.fewer_rows_than(a.union(b), a)) == [(8, 4, 4)]
    assert [r["row_count_delta"] for r in Q.fewer_rows_than(a, b, ["f"]).filter("f_a = 'y'").collect()] == [0]


def test_equality(spark, rows):
    a = spark.createDataFrame([(1, 2, 3), (1, 2, 3), (None, 5, 6)], "col_a int, col_b int, col_c int")
    b = spark.createDataFrame([(1, 2, 4), (None, 5, 6)], "COL_A int, col_b int, col_c int")
    assert rows(Q.equality(a, a.distinct())) == []
    assert rows(Q.equality(a, b)) == [("a_minus_b", 1, 2, 3), ("b_minus_a", 1, 2, 4)]
    assert rows(Q.equality(a, b, compare_columns=["col_a", "col_b"])) == []
    assert rows(Q.equality(a, b, exclude_columns=["COL_C"])) == []
    with pytest.raises(ValueError):
        Q.equality(a, b, ["col_a"], ["col_b"])
    with pytest.raises(ValueError):
        Q.equality(a, b.drop("col_c"))


def test_equality_of_random_tables(spark, rows):
    """NULLs, both zeros, NaN, repeated rows and types that differ by side, against two EXCEPTs."""

    def shown(found):  # NaN is not equal to itself; the zeros are one value
        return sorted(repr(tuple(row)).replace("-0.0", "0.0") for row in found.collect())

    schema = "k int, f double, s string, n decimal(9,2)"
    for seed in range(3):
        pick = random.Random(seed).choice
        made = [
            [(pick([None, 1, 2, 3]), pick([None, 0.0, -0.0, float("nan"), 1.5]), pick([None, "", "x"]), pick([None, Decimal("1.50")])) for _ in range(90)]
            for _ in range(2)
        ]
        a, b = spark.createDataFrame(made[0], schema), spark.createDataFrame(made[1], schema.replace("int", "long"))
        plain = [
            x.distinct().exceptAll(y.distinct()).select(F.lit(w).alias("which_diff"), "*") for x, y, w in ((a, b, "a_minus_b"), (b, a, "b_minus_a"))
        ]
        for way in (False, True):
            assert shown(Q.equality(a, b, by_digest=way)) == shown(plain[0].union(plain[1]))
        counts = [t.groupBy("f").agg(F.count(F.lit(1)).alias("num_rows")) for t in (a, b)]
        plain = counts[0].exceptAll(counts[1]).union(counts[1].exceptAll(counts[0]))
        for way in (False, True):
            assert shown(Q.cardinality_equality(a, "f", b, "f", by_digest=way)) == shown(plain)
    assert rows(Q.equality(a, a, by_digest=True)) == rows(Q.cardinality_equality(a, "f", a, "f", by_digest=True)) == []
    assert Q.equality(a, a.limit(0), by_digest=True).count() == a.distinct().count()
    nested = a.select(F.struct("k", "f").alias("both"))
    assert Q.equality(nested, nested, by_digest=True).isEmpty()


def test_equal_tables_shuffle_digests_only(spark):
    """The second pass is left out once no bucket differs; one changed row sends the rows of its buckets only."""
    a = spark.range(50_000).select("id", (F.col("id") % 7).alias("v"))
    changed = a.withColumn("v", F.when(F.col("id") == 123, 99).otherwise(F.col("v")))

    def ran(found):
        out = found.collect()
        return out, found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

    again = a.filter("id >= 0")
    for found in (Q.equality(a, again, by_digest=True), Q.cardinality_equality(a, "id", again, "id", by_digest=True)):
        out, final = ran(found)
        assert not out and "EmptyRelation" in final and "Exchange hashpartitioning(id" not in final
    out, final = ran(Q.equality(a, changed, by_digest=True))
    assert sorted(out) == [("a_minus_b", 123, 4), ("b_minus_a", 123, 99)] and "Exchange hashpartitioning(id" in final


def test_equality_with_precision(spark):
    a = spark.createDataFrame([(1, 1.23456)], "id int, x double")
    b = spark.createDataFrame([(1, 1.23457)], "id int, x double")
    assert Q.equality(a, b, precision=4).isEmpty()
    assert Q.equality(a, b, precision=5).count() == 2


def test_sequential_values(spark, rows):
    even = spark.createDataFrame([(2,), (4,), (None,), (6,)], "my_even_sequence int")
    assert rows(Q.sequential_values(even, "my_even_sequence", interval=2)) == []
    assert rows(Q.sequential_values(even, "my_even_sequence")) == [(4, 2), (6, 4)]
    twice = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 5)], "g string, x int")
    assert rows(Q.sequential_values(twice, "x", group_by=["g"])) == [("a", 1, 1)]


def test_sequential_timestamps(spark, rows):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ '2021-01-01 00:00:00', TIMESTAMP_NTZ '2021-01-01 05:00:00', INTERVAL 1 HOUR)) AS my_timestamp")
    assert Q.sequential_values(df, "my_timestamp", interval=1, datepart="hour").isEmpty()
    assert Q.sequential_values(df, "my_timestamp", interval=1, datepart="day").count() == 5


RANGES = "SELECT * FROM VALUES {} AS t(g, lo, hi)"


@pytest.mark.parametrize(
    "values,gaps,zero,bad",
    [
        ("(1,1,2),(1,2,3),(2,7,9)", "not_allowed", False, 0),
        ("(1,1,2),(1,3,4)", "not_allowed", False, 1),
        ("(1,1,2),(1,3,4)", "required", False, 0),
        ("(1,1,2),(1,2,4)", "required", False, 1),
        ("(1,1,3),(1,2,4)", "allowed", False, 1),
        ("(1,2,2),(1,2,4)", "allowed", True, 0),
        ("(1,2,2),(1,2,4)", "allowed", False, 1),
        ("(1,1,NULL),(1,4,5)", "allowed", False, 1),
        ("(1,NULL,3),(1,4,5)", "allowed", False, 1),
        ("(1,4,5),(1,4,5),(1,4,5)", "allowed", False, 2),
    ],
)
def test_mutually_exclusive_ranges(spark, values, gaps, zero, bad):
    df = spark.sql(RANGES.format(values))
    found = Q.mutually_exclusive_ranges(df, "lo", "hi", "g", gaps, zero)
    assert found.count() == bad
    one = Q.mutually_exclusive_ranges(df.filter("g = 1"), "lo", "hi", None, gaps, zero)
    assert one.count() == bad


def test_mutually_exclusive_ranges_with_expressions(spark):
    df = spark.sql("SELECT * FROM VALUES (1, DATE '2020-01-01', DATE '2020-02-01'), (1, DATE '2020-02-01', NULL) AS t(subscription_id, valid_from, valid_to)")
    upper = "coalesce(valid_to, DATE '2099-01-01')"
    assert Q.mutually_exclusive_ranges(df, "valid_from", upper, "subscription_id").isEmpty()
    with pytest.raises(ValueError):
        Q.mutually_exclusive_ranges(df, "valid_from", upper, gaps="some")


def test_global_order_checks_use_no_single_task_for_the_rows(spark, data):
    lines = read_table(spark, data, "lineitem")
    text = Q.sequential_values(lines, "l_orderkey")._jdf.queryExecution().executedPlan().toString()
    # The one exchange into a single task carries the edge row of each range.
    assert text.count("SinglePartition") <= 2
    edges = text[text.index("SinglePartition"):]
    assert "max(" in edges


def test_dq_run(spark, rows):
    t = spark.createDataFrame([(1, "a"), (2, ""), (2, None)], "id int, s string")
    u = spark.createDataFrame([(1, "a")], "id int, s string")
    checks = [
        Check("range", "t", "accepted_range", {"column": "id", "max_value": 1}),
        Check("range where", "t", "accepted_range", {"column": "id", "max_value": 1}, where="s IS NULL"),
        Check("blank", "t", "not_empty_string", {"column": "s"}, severity="warn"),
        Check("null", "t", "not_null", {"column": "id"}),
        Check("must fail", "t", "unique", {"column": "id"}, error_if="< 1", warn_if="< 0"),
        Check("same", "t", "equality", {"compare": "u"}),
        Check("rows", "u", "equal_rowcount", {"compare": "t"}),
        Check("fewer", "u", "fewer_rows_than", {"compare": "t"}),
    ]
    assert rows(dq_run({"t": t, "u": u}, checks)) == sorted(
        [
            ("range", "t", 2, "fail"),
            ("range where", "t", 1, "fail"),
            ("blank", "t", 1, "warn"),
            ("null", "t", 0, "pass"),
            ("must fail", "t", 1, "pass"),
            ("same", "t", 4, "fail"),
            ("rows", "u", 2, "fail"),
            ("fewer", "u", 0, "pass"),
        ],
        key=repr,
    )
    with pytest.raises(ValueError):
        dq_run({"t": t}, [Check("x", "t", "no such kind")])


# --- many checks in one pass ---


def _odd_table(spark):
    rows = [(1, "a", 1.0, "x"), (2, "a", None, "x"), (2, "b", 3.0, None), (None, "b", 3.0, "y"), (5, None, 7.0, "x"), (5, None, 7.0, " "), (9, "c", None, "z")]
    return spark.createDataFrame(rows, "k int, g string, v double, t string").withColumn("at", F.expr("timestamp_ntz'2026-01-01' + make_interval(0, 0, 0, k)"))


ONE_TABLE = [
    ("unique", {"column": "k"}), ("unique_combination_of_columns", {"columns": ["k", "g"]}), ("unique_combination_of_columns", {"columns": ["g"]}),
    ("accepted_values", {"column": "g", "values": ["a"]}), ("not_accepted_values", {"column": "g", "values": ["a", "c", "q"]}), ("at_least_one", {"column": "v"}),
    ("at_least_one", {"column": "v", "group_by": ["g"]}), ("not_constant", {"column": "v"}), ("not_constant", {"column": "v", "group_by": ["g"]}),
    ("not_constant", {"column": "t", "group_by": ["g", "k"]}), ("not_null_proportion", {"column": "v", "at_least": 0.8, "group_by": ["g"]}),
    ("recency", {"field": "at", "datepart": "day", "interval": 3, "as_of": "2026-01-10 00:00:00"}),
    ("recency", {"field": "at", "datepart": "day", "interval": 3, "as_of": "2026-01-10 00:00:00", "group_by": ["g"]}),
    ("recency", {"field": "at", "datepart": "day", "interval": 1, "as_of": "2026-01-11 00:00:00", "ignore_time_component": True}),
    ("not_null", {"column": "k"}), ("not_empty_string", {"column": "t"}), ("accepted_range", {"column": "v", "max_value": 5}), ("sequential_values", {"column": "k"}),
    ("mutually_exclusive_ranges", {"lower": "k", "upper": "k + 1", "partition_by": "g"}), ("relationships_where", {"column": "k", "to": "t", "field": "v"}),
]


@pytest.mark.parametrize("where", [None, "t = 'x'", "v > 2", "g = 'nothing'"])
def test_one_pass_counts_what_the_checks_return(spark, where):
    df = _odd_table(spark)
    checks = [Check(f"{i} {kind}", "t", kind, args, where=where) for i, (kind, args) in enumerate(ONE_TABLE)]
    found = {r["check"]: r["failures"] for r in dq_run({"t": df}, checks).collect()}
    rows = df if where is None else df.filter(where)
    for i, (kind, args) in enumerate(ONE_TABLE):
        own = {k: df if k == "to" else v for k, v in args.items()}
        assert found[f"{i} {kind}"] == getattr(Q, kind)(rows, **own).count(), (kind, args)


def test_checks_share_their_scans_and_expand_nothing(spark, data):
    orders, lines = (spark.read.parquet(f"{data}/{name}.parquet") for name in ("orders", "lineitem"))
    checks = [
        Check("a", "orders", "not_null", {"column": "o_custkey"}), Check("b", "orders", "not_constant", {"column": "o_custkey"}),
        Check("c", "orders", "recency", {"field": "o_orderdate", "datepart": "day", "interval": 3}), Check("d", "orders", "unique", {"column": "o_custkey"}),
        Check("e", "orders", "accepted_values", {"column": "o_custkey", "values": [1]}), Check("f", "orders", "at_least_one", {"column": "o_totalprice", "group_by": ["o_custkey"]}),
    ]
    plan = dq_run({"orders": orders}, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # one without groups, one by customer
    check = [Check("x", "orders", "relationships_where", {"column": "o_custkey", "to": "lines", "field": "l_partkey"})]
    assert "Generate" not in dq_run({"orders": orders, "lines": lines}, check)._jdf.queryExecution().executedPlan().toString()
