"""Queries over the data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.checks import Check, dq_run
from ..sources.tables import read_table
from .base import Registry

QUERIES = Registry()

# Parts of the checking SQL: lag and lead over the whole table. A row number puts equal ranges into one order.
_SPANS = "SELECT o_custkey AS g, o_orderdate AS lo, o_orderdate + INTERVAL 20 DAY AS hi FROM orders"


def _sequence_sql(table: str, column: str, step: str, group: str = "") -> str:
    part = f"PARTITION BY {group}" if group else ""
    lead = f"{group}, " if group else ""
    return f"""SELECT * FROM (SELECT {lead}{column}, lag({column}) OVER ({part} ORDER BY {column}) AS previous_{column} FROM {table})
  WHERE NOT ({column} = previous_{column} + {step})"""


def _ranges_sql(rows: str, gap: str, gap_name: str, grouped: bool, length: str = "<", length_name: str = "lower_bound_less_than_upper_bound") -> str:
    part, column = ("PARTITION BY g", "g AS partition_by_col, ") if grouped else ("", "")
    return f"""SELECT * FROM (SELECT {column}lo AS lower_bound, hi AS upper_bound, next_lo AS next_lower_bound, is_last AS is_last_record,
    (lo {length} hi) IS TRUE AS {length_name}, CASE WHEN next_lo IS NULL THEN is_last ELSE (hi {gap} next_lo) IS TRUE END AS {gap_name}
    FROM (SELECT *, lead(lo) OVER w AS next_lo, lead(k) OVER w IS NULL AS is_last
      FROM (SELECT *, row_number() OVER () AS k FROM ({rows})) WINDOW w AS ({part} ORDER BY lo, hi, k)))
  WHERE NOT {length_name} OR NOT {gap_name}"""


def _orders(spark, folder):
    return read_table(spark, folder, "orders")


def _lineitem(spark, folder):
    return read_table(spark, folder, "lineitem")


def _events(spark, folder):
    return read_table(spark, folder, "events")


# --- rows and values ---


@QUERIES.add("accepted_range", "SELECT l_orderkey, l_linenumber, q FROM (SELECT *, nullif(l_quantity, 7) AS q FROM lineitem) WHERE NOT q > 5 OR NOT q < 45")
def accepted_range(spark, folder):
    rows = _lineitem(spark, folder).select("l_orderkey", "l_linenumber", F.nullif(F.col("l_quantity"), F.lit(7)).alias("q"))
    return Q.accepted_range(rows, "q", 5, 45, inclusive=False)


@QUERIES.add("expression_is_true", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE NOT (l_extendedprice * (1 - l_discount) > 5000)")
def expression_is_true(spark, folder):
    return Q.expression_is_true(_lineitem(spark, folder), "l_extendedprice * (1 - l_discount) > 5000").select(
        "l_orderkey", "l_linenumber", "l_discount"
    )


@QUERIES.add("not_empty_string", "SELECT trim(t) AS t FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN '   ' ELSE o_orderstatus END AS t FROM orders) WHERE trim(t) = ''")
def not_empty_string(spark, folder):
    text = F.when(F.col("o_orderstatus") == "P", "   ").otherwise(F.col("o_orderstatus"))
    return Q.not_empty_string(_orders(spark, folder).select(text.alias("t")), "t")


@QUERIES.add("not_null", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE nullif(l_tax, 0) IS NULL")
def not_null(spark, folder):
    rows = _lineitem(spark, folder).select("l_orderkey", "l_linenumber", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"))
    return Q.not_null(rows, "tax").drop("tax")


@QUERIES.add("unique", "SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders GROUP BY 1 HAVING count(*) > 1")
def unique(spark, folder):
    return Q.unique(_orders(spark, folder), "o_custkey")


@QUERIES.add("accepted_values", "SELECT o_orderpriority AS value_field, count(*) AS n_records FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') GROUP BY 1")
def accepted_values(spark, folder):
    return Q.accepted_values(_orders(spark, folder), "o_orderpriority", ["1-URGENT", "5-LOW"])


@QUERIES.add("not_accepted_values", "SELECT DISTINCT event_type AS value_field FROM events WHERE event_type IN ('error', 'click', 'unheard')")
def not_accepted_values(spark, folder):
    return Q.not_accepted_values(_events(spark, folder), "event_type", ["error", "click", "unheard"])


@QUERIES.add("assert_equal", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag <> CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'N' END")
def assert_equal(spark, folder):
    rows = _lineitem(spark, folder).withColumn("expected", F.when(F.col("l_linestatus") == "F", "A").otherwise("N"))
    return Q.assert_equal(rows, "l_returnflag", "expected").select("l_orderkey", "l_linenumber")


@QUERIES.add("unique_combination_of_columns", "SELECT l_partkey, l_suppkey FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_combination(spark, folder):
    return Q.unique_combination_of_columns(_lineitem(spark, folder), ["l_partkey", "l_suppkey"])


@QUERIES.add("at_least_one", "SELECT o_custkey, count(v) AS filler_column FROM (SELECT o_custkey, CASE WHEN o_totalprice > 400000 THEN 1 END AS v FROM orders) GROUP BY 1 HAVING count(v) = 0")
def at_least_one(spark, folder):
    rows = _orders(spark, folder).select("o_custkey", F.when(F.col("o_totalprice") > 400000, 1).alias("v"))
    return Q.at_least_one(rows, "v", ["o_custkey"])


@QUERIES.add("at_least_one_ungrouped", "SELECT count(v) AS filler_column FROM (SELECT CASE WHEN o_totalprice < 0 THEN 1 END AS v FROM orders) HAVING count(v) = 0")
def at_least_one_ungrouped(spark, folder):
    return Q.at_least_one(_orders(spark, folder).select(F.when(F.col("o_totalprice") < 0, 1).alias("v")), "v")


@QUERIES.add("not_constant", "SELECT o_custkey, count(DISTINCT o_orderstatus) AS filler_column FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 1")
def not_constant(spark, folder):
    return Q.not_constant(_orders(spark, folder), "o_orderstatus", ["o_custkey"])


@QUERIES.add(
    "not_null_proportion",
    """SELECT l_suppkey, p AS not_null_proportion FROM (
  SELECT l_suppkey, sum(CASE WHEN l_tax = 0 THEN 0 ELSE 1 END) / count(*) AS p FROM lineitem GROUP BY 1) WHERE p < 0.85 OR p > 0.95""",
)
def not_null_proportion(spark, folder):
    rows = _lineitem(spark, folder).select("l_suppkey", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"))
    return Q.not_null_proportion(rows, "tax", 0.85, 0.95, ["l_suppkey"])


@QUERIES.add(
    "recency",
    """SELECT user_id, event_type, max(ts) AS most_recent, TIMESTAMP '2024-01-29 12:00:00' AS threshold FROM events GROUP BY 1, 2
  HAVING max(ts) < TIMESTAMP '2024-01-29 12:00:00'""",
)
def recency(spark, folder):
    return Q.recency(_events(spark, folder), "ts", "day", 1, group_by=["user_id", "event_type"], as_of="2024-01-30 12:00:00")


@QUERIES.add(
    "recency_by_date",
    """SELECT user_id, CAST(max(ts) AS DATE) AS most_recent, DATE '2024-01-30' AS threshold FROM events GROUP BY 1
  HAVING CAST(max(ts) AS DATE) < DATE '2024-01-30'""",
)
def recency_by_date(spark, folder):
    return Q.recency(_events(spark, folder), "ts", "day", 1, True, ["user_id"], as_of="2024-01-31 12:00:00")


# --- two tables ---


@QUERIES.add(
    "relationships_where",
    """SELECT l.l_partkey AS id, NULL::BIGINT AS right_id FROM lineitem l WHERE l.l_quantity > 3
  AND NOT EXISTS (SELECT 1 FROM part WHERE p_size > 5 AND p_partkey = l.l_partkey)""",
)
def relationships_where(spark, folder):
    parts = read_table(spark, folder, "part")
    return Q.relationships_where(_lineitem(spark, folder), "l_partkey", parts, "p_partkey", "l_quantity > 3", "p_size > 5")


@QUERIES.add(
    "cardinality_equality",
    """SELECT * FROM (WITH a AS (SELECT l_orderkey, count(*) AS num_rows FROM lineitem GROUP BY 1),
  b AS (SELECT o_orderkey, count(*) AS num_rows FROM orders GROUP BY 1)
  (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a))""",
)
def cardinality_equality(spark, folder):
    return Q.cardinality_equality(_lineitem(spark, folder), "l_orderkey", _orders(spark, folder), "o_orderkey")


_BY_STATUS = """FROM (SELECT l_linestatus AS s, count(*) AS x FROM lineitem GROUP BY 1) a
  FULL JOIN (SELECT o_orderstatus AS s, count(*) AS y FROM orders GROUP BY 1) b ON a.s = b.s"""


@QUERIES.add("equal_rowcount", f"SELECT a.s AS s_a, b.s AS s_b, x AS count_a, y AS count_b, abs(x - y) AS diff_count {_BY_STATUS}")
def equal_rowcount(spark, folder):
    lines = _lineitem(spark, folder).select(F.col("l_linestatus").alias("s"))
    return Q.equal_rowcount(lines, _orders(spark, folder).select(F.col("o_orderstatus").alias("s")), ["s"])


@QUERIES.add(
    "fewer_rows_than",
    f"""SELECT a.s AS s_a, b.s AS s_b, x AS count_our_model, y AS count_comparison_model,
  CAST(CASE WHEN x > y THEN x - y WHEN x = y THEN 1 ELSE 0 END AS BIGINT) AS row_count_delta {_BY_STATUS}""",
)
def fewer_rows_than(spark, folder):
    lines = _lineitem(spark, folder).select(F.col("l_linestatus").alias("s"))
    return Q.fewer_rows_than(lines, _orders(spark, folder).select(F.col("o_orderstatus").alias("s")), ["s"])


@QUERIES.add(
    "equality",
    """WITH a AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
  b AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH'))
  SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
  UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def equality(spark, folder):
    orders = _orders(spark, folder)
    first = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return Q.equality(orders.filter(first), orders.filter(~first), compare_columns=["o_custkey", "o_orderstatus"])


@QUERIES.add(
    "equality_rounded",
    """WITH a AS (SELECT l_returnflag, round(CAST(l_extendedprice / 10 AS DECIMAL(28,6)), 1) AS price FROM lineitem WHERE l_linestatus = 'F'),
  b AS (SELECT l_returnflag, round(CAST(l_extendedprice / 10 AS DECIMAL(28,6)), 1) AS price FROM lineitem WHERE l_linestatus = 'O')
  SELECT which_diff, l_returnflag, CAST(price * 10 AS BIGINT) AS price FROM (
    SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a))""",
)
def equality_rounded(spark, folder):
    lines = _lineitem(spark, folder).select("l_returnflag", (F.col("l_extendedprice") / 10).alias("price"), "l_linestatus")
    done, is_open = (lines.filter(F.col("l_linestatus") == s) for s in ("F", "O"))
    found = Q.equality(done, is_open, exclude_columns=["L_LINESTATUS"], precision=1)
    return found.withColumn("price", (F.col("price") * 10).cast("bigint"))


_ALMOST = "SELECT * EXCLUDE (o_totalprice), o_totalprice + CASE WHEN o_orderkey % 5003 = 0 THEN 1 ELSE 0 END AS o_totalprice FROM orders"


def _almost_orders(spark, folder):
    """The orders with a few changed prices."""
    changed = F.when(F.col("o_orderkey") % 5003 == 0, 1).otherwise(0)
    return _orders(spark, folder).withColumn("o_totalprice", F.col("o_totalprice") + changed)


@QUERIES.add(
    "equality_by_digest",
    f"""WITH a AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders),
  b AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM ({_ALMOST}))
  SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
  UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def equality_by_digest(spark, folder):
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    return Q.equality(_orders(spark, folder), _almost_orders(spark, folder), compare_columns=columns, by_digest=True)


@QUERIES.add(
    "cardinality_equality_by_digest",
    f"""SELECT * FROM (WITH a AS (SELECT o_totalprice, count(*) AS num_rows FROM orders GROUP BY 1),
  b AS (SELECT o_totalprice, count(*) AS num_rows FROM ({_ALMOST}) GROUP BY 1)
  (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a))""",
)
def cardinality_equality_by_digest(spark, folder):
    return Q.cardinality_equality(_orders(spark, folder), "o_totalprice", _almost_orders(spark, folder), "o_totalprice", by_digest=True)


# --- order of rows ---


@QUERIES.add("sequential_values", _sequence_sql("lineitem", "l_orderkey", "1"))
def sequential_values(spark, folder):
    return Q.sequential_values(_lineitem(spark, folder), "l_orderkey")


@QUERIES.add("sequential_values_grouped", _sequence_sql("events", "event_id", "10", "user_id"))
def sequential_values_grouped(spark, folder):
    return Q.sequential_values(_events(spark, folder), "event_id", interval=10, group_by=["user_id"])


@QUERIES.add("sequential_values_hot_groups", _sequence_sql("lineitem", "l_partkey", "1", "l_returnflag"))
def sequential_values_hot(spark, folder):
    return Q.sequential_values(_lineitem(spark, folder), "l_partkey", group_by=["l_returnflag"])


@QUERIES.add("sequential_values_dates", _sequence_sql("orders", "o_orderdate", "INTERVAL 1 DAY"))
def sequential_values_dates(spark, folder):
    return Q.sequential_values(_orders(spark, folder), "o_orderdate", interval=1, datepart="day")


@QUERIES.add("mutually_exclusive_ranges", _ranges_sql(_SPANS, "<=", "upper_bound_less_than_or_equal_to_next_lower_bound", True))
def mutually_exclusive_ranges(spark, folder):
    return Q.mutually_exclusive_ranges(
        _orders(spark, folder), "o_orderdate", "o_orderdate + INTERVAL 20 DAY", partition_by="o_custkey"
    )


@QUERIES.add(
    "mutually_exclusive_ranges_global",
    _ranges_sql("SELECT l_partkey AS lo, l_partkey + l_linenumber - 1 AS hi FROM lineitem", "=", "upper_bound_equal_to_next_lower_bound", False, "<=", "lower_bound_less_than_or_equal_to_upper_bound"),
)
def mutually_exclusive_ranges_global(spark, folder):
    return Q.mutually_exclusive_ranges(
        _lineitem(spark, folder), "l_partkey", "l_partkey + l_linenumber - 1", gaps="not_allowed", zero_length_range_allowed=True
    )


@QUERIES.add(
    "mutually_exclusive_ranges_hot_groups",
    _ranges_sql("SELECT o_orderstatus AS g, o_orderkey AS lo, o_orderkey + 3 AS hi FROM orders", "<", "upper_bound_less_than_next_lower_bound", True),
)
def mutually_exclusive_ranges_hot(spark, folder):
    return Q.mutually_exclusive_ranges(
        _orders(spark, folder), "o_orderkey", "o_orderkey + 3", partition_by="o_orderstatus", gaps="required"
    )


# --- many checks at once ---

_CHECKS = [
    Check("quantity in range", "lineitem", "accepted_range", {"column": "l_quantity", "min_value": 1, "max_value": 40}),
    Check("flag given", "lineitem", "not_empty_string", {"column": "l_returnflag"}),
    Check("price above discount", "lineitem", "expression_is_true", {"expression": "l_extendedprice > l_discount"}, where="l_tax > 0"),
    Check("status known", "orders", "accepted_values", {"column": "o_orderstatus", "values": ["F", "O"]}, severity="warn"),
    Check("customer exists", "orders", "relationships_where", {"column": "o_custkey", "to": "customer", "field": "c_custkey"}),
    Check("fewer orders", "orders", "fewer_rows_than", {"compare": "lineitem"}),
    Check("order key given", "orders", "not_null", {"column": "o_orderkey"}),
    Check("keys unique", "orders", "unique", {"column": "o_orderkey"}, error_if="> 10", warn_if="> 0"),
    Check("some large balance", "customer", "expression_is_true", {"expression": "c_acctbal < 9000"}, error_if="> 1000000"),
]
# With these, every kind of check.
_MORE_CHECKS = [
    Check("line has its key twice", "lineitem", "unique_combination_of_columns", {"columns": ["l_orderkey", "l_partkey"]}),
    Check("part once an order", "lineitem", "not_constant", {"column": "l_partkey", "group_by": ["l_orderkey"]}, where="l_quantity > 10"),
    Check("order has a small line", "lineitem", "at_least_one", {"column": "l_quantity", "group_by": ["l_orderkey"]}),
    Check("flags that must not be", "lineitem", "not_accepted_values", {"column": "l_returnflag", "values": ["A", "X"]}),
    Check("quantity not constant", "lineitem", "not_constant", {"column": "l_quantity"}),
    Check("some tax", "lineitem", "at_least_one", {"column": "l_tax"}, where="l_tax > 100"),
    Check("status same twice", "orders", "assert_equal", {"actual": "o_custkey", "expected": "o_orderkey"}),
    Check("orders are recent", "orders", "recency", {"field": "o_orderdate", "datepart": "day", "interval": 30, "as_of": "1999-01-01 00:00:00"}),
    Check("each status is recent", "orders", "recency", {"field": "o_orderdate", "datepart": "day", "interval": 30, "group_by": ["o_orderstatus"], "as_of": "1990-01-01 00:00:00"}),
    Check("prices given", "orders", "not_null_proportion", {"column": "o_totalprice", "at_least": 0.5, "at_most": 0.9}),
    Check("prices given by customer", "orders", "not_null_proportion", {"column": "o_totalprice", "at_least": 0.9, "group_by": ["o_custkey"]}),
    Check("same customers", "orders", "cardinality_equality", {"column": "o_custkey", "to": "customer", "field": "c_custkey"}),
    Check("as many orders", "orders", "equal_rowcount", {"compare": "customer"}),
    Check("customers equal", "customer", "equality", {"compare": "customer"}),
    Check("keys follow", "lineitem", "sequential_values", {"column": "l_orderkey"}),
    Check("spans apart", "orders", "mutually_exclusive_ranges", {"lower": "o_orderdate", "upper": "o_orderdate + INTERVAL 20 DAY", "partition_by": "o_custkey"}),
]


_DQ_SQL = """SELECT "check", table_name, CAST(failures AS BIGINT) AS failures, CASE WHEN is_error THEN 'fail' WHEN is_warn THEN 'warn' ELSE 'pass' END AS status FROM (
  SELECT "check", table_name, failures, CASE "check" WHEN 'status known' THEN false WHEN 'keys unique' THEN failures > 10
    WHEN 'some large balance' THEN failures > 1000000 ELSE failures <> 0 END AS is_error,
    CASE "check" WHEN 'keys unique' THEN failures > 0 ELSE failures <> 0 END AS is_warn FROM (
  SELECT 'quantity in range' AS "check", 'lineitem' AS table_name, count(*) AS failures FROM lineitem WHERE l_quantity < 1 OR l_quantity > 40
  UNION ALL SELECT 'flag given', 'lineitem', count(*) FROM lineitem WHERE trim(l_returnflag) = ''
  UNION ALL SELECT 'price above discount', 'lineitem', count(*) FROM lineitem WHERE l_tax > 0 AND NOT l_extendedprice > l_discount
  UNION ALL SELECT 'status known', 'orders', count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
  UNION ALL SELECT 'customer exists', 'orders', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT 'fewer orders', 'orders', CASE WHEN x > y THEN x - y WHEN x = y THEN 1 ELSE 0 END FROM (SELECT (SELECT count(*) FROM orders) AS x, (SELECT count(*) FROM lineitem) AS y)
  UNION ALL SELECT 'order key given', 'orders', count(*) FROM orders WHERE o_orderkey IS NULL
  UNION ALL SELECT 'keys unique', 'orders', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'some large balance', 'customer', count(*) FROM customer WHERE NOT c_acctbal < 9000 {more}))"""
_MORE_SQL = """
  UNION ALL SELECT 'line has its key twice', 'lineitem', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)
  UNION ALL SELECT 'part once an order', 'lineitem', count(*) FROM (SELECT 1 FROM lineitem WHERE l_quantity > 10 GROUP BY l_orderkey HAVING count(DISTINCT l_partkey) = 1)
  UNION ALL SELECT 'order has a small line', 'lineitem', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(l_quantity) = 0)
  UNION ALL SELECT 'flags that must not be', 'lineitem', count(DISTINCT l_returnflag) FROM lineitem WHERE l_returnflag IN ('A', 'X')
  UNION ALL SELECT 'quantity not constant', 'lineitem', CASE WHEN count(DISTINCT l_quantity) = 1 THEN 1 ELSE 0 END FROM lineitem
  UNION ALL SELECT 'some tax', 'lineitem', CASE WHEN count(l_tax) = 0 THEN 1 ELSE 0 END FROM lineitem WHERE l_tax > 100
  UNION ALL SELECT 'status same twice', 'orders', count(*) FROM orders WHERE o_custkey <> o_orderkey
  UNION ALL SELECT 'orders are recent', 'orders', CASE WHEN max(o_orderdate) < TIMESTAMP '1998-12-02' THEN 1 ELSE 0 END FROM orders
  UNION ALL SELECT 'each status is recent', 'orders', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderstatus HAVING max(o_orderdate) < TIMESTAMP '1989-12-02')
  UNION ALL SELECT 'prices given', 'orders', CASE WHEN count(o_totalprice) / count(*) NOT BETWEEN 0.5 AND 0.9 THEN 1 ELSE 0 END FROM orders
  UNION ALL SELECT 'prices given by customer', 'orders', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(o_totalprice) / count(*) NOT BETWEEN 0.9 AND 1)
  UNION ALL SELECT 'same customers', 'orders', count(*) FROM (
    (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1 EXCEPT SELECT c_custkey, count(*) FROM customer GROUP BY 1)
    UNION ALL (SELECT c_custkey, count(*) FROM customer GROUP BY 1 EXCEPT SELECT o_custkey, count(*) FROM orders GROUP BY 1))
  UNION ALL SELECT 'as many orders', 'orders', abs((SELECT count(*) FROM orders) - (SELECT count(*) FROM customer))
  UNION ALL SELECT 'customers equal', 'customer', 0
  UNION ALL SELECT 'keys follow', 'lineitem', count(*) FROM (SELECT l_orderkey, lag(l_orderkey) OVER (ORDER BY l_orderkey) AS p FROM lineitem WHERE l_orderkey IS NOT NULL)
    WHERE l_orderkey <> p + 1
  UNION ALL SELECT 'spans apart', 'orders', count(*) FROM (SELECT o_orderdate + INTERVAL 20 DAY AS hi, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS nx FROM orders)
    WHERE NOT coalesce(hi <= nx, true)"""


@QUERIES.add("dq_run", _DQ_SQL.replace("{more}", ""))
def run_checks(spark, folder):
    tables = {name: read_table(spark, folder, name) for name in ("lineitem", "orders", "customer")}
    return dq_run(tables, _CHECKS)


@QUERIES.add("dq_run_all_kinds", _DQ_SQL.replace("{more}", _MORE_SQL))
def run_all_checks(spark, folder):
    tables = {name: read_table(spark, folder, name) for name in ("lineitem", "orders", "customer")}
    return dq_run(tables, _CHECKS + _MORE_CHECKS)
