"""Queries over the table operators and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geo import degrees_to_radians, haversine
from ..functions.keys import surrogate_key
from ..functions.numeric import safe_add, safe_divide, safe_subtract, width_bucket
from ..functions.text import slugify
from ..functions.url import url_host, url_parameter, url_path
from ..operators import reshape as R
from ..operators.dedupe import deduplicate
from ..operators.scalar import get_single_value
from ..operators.series import date_spine, generate_series, intervals_between
from ..sources.tables import read_table, tables_by_prefix, union_tables_by_pattern
from .base import Registry

QUERIES = Registry()

_STATUSES = ["F", "O", "P"]


# --- columns ---


@QUERIES.add(
    "star",
    """SELECT c_custkey AS x_c_custkey_y, c_name AS x_c_name_y, c_nationkey AS x_c_nationkey_y, c_mktsegment AS x_c_mktsegment_y FROM customer""",
)
def star(spark, folder):
    df = read_table(spark, folder, "customer")
    return df.select(*R.star(df, except_=["C_ACCTBAL"], prefix="x_", suffix="_y"))


@QUERIES.add(
    "filtered_columns",
    "SELECT max(o_orderkey) AS o_orderkey, max(o_totalprice) AS o_totalprice, max(o_orderdate) AS o_orderdate, max(o_orderpriority) AS o_orderpriority FROM orders",
)
def filtered_columns(spark, folder):
    df = read_table(spark, folder, "orders")
    return df.agg(*[F.max(c).alias(c) for c in R.filtered_columns(df, ["o_custkey", "O_ORDERSTATUS"])])


@QUERIES.add(
    "nullcheck",
    "SELECT o_orderkey, nullif(CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END, '') AS o_orderstatus FROM orders",
)
def nullcheck(spark, folder):
    orders = read_table(spark, folder, "orders")
    blanked = orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    return blanked.select(*R.nullcheck(blanked))


@QUERIES.add(
    "nullcheck_table",
    "SELECT c_custkey, c_name, nullif(replace(c_mktsegment, 'MACHINERY', ''), '') AS c_mktsegment, c_acctbal FROM customer",
)
def nullcheck_table(spark, folder):
    rows = read_table(spark, folder, "customer").select(
        "c_custkey", "c_name", F.replace("c_mktsegment", F.lit("MACHINERY"), F.lit("")).alias("c_mktsegment"), "c_acctbal"
    )
    return R.nullcheck_table(rows)


@QUERIES.add("base_model", "SELECT s_suppkey AS supplierkey, s_name AS suppliername FROM supplier")
def base_model(spark, folder):
    raw = read_table(spark, folder, "supplier").select(F.col("s_suppkey").alias("SupplierKey"), F.col("s_name").alias("SupplierName"))
    return R.base_model(raw)


@QUERIES.add(
    "group_by_n",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS qty FROM lineitem GROUP BY 1, 2",
)
def group_by_n(spark, folder):
    rows = read_table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return R.group_by_n(rows, 2).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(28,2)").alias("qty")
    )


@QUERIES.add(
    "column_values",
    "SELECT p_brand AS value FROM part WHERE p_size > 10 GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 7",
)
def column_values(spark, folder):
    return R.column_values(read_table(spark, folder, "part"), "p_brand", max_records=7, where="p_size > 10")


@QUERIES.add("column_values_all", "SELECT o_custkey AS value FROM orders GROUP BY o_custkey")
def column_values_all(spark, folder):
    newest_first = [(F.max("o_orderdate"), False)]
    return R.column_values(read_table(spark, folder, "orders"), "o_custkey", order_by=newest_first)


# --- pivot, unpivot, union ---


@QUERIES.add(
    "pivot",
    """SELECT user_id, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS n_click,
  sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)::BIGINT AS n_view,
  sum(CASE WHEN event_type = 'no such' THEN 1 ELSE 0 END)::BIGINT AS "n_no such" FROM events GROUP BY user_id""",
)
def pivot(spark, folder):
    return R.pivot(read_table(spark, folder, "events"), ["user_id"], "event_type", ["click", "view", "no such"], prefix="n_")


@QUERIES.add(
    "pivot_values_from_table",
    """SELECT o_custkey, count(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderstatus END) AS _1_urgent,
  count(DISTINCT CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderstatus END) AS _2_high,
  count(DISTINCT CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_orderstatus END) AS _3_medium,
  count(DISTINCT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_orderstatus END) AS _4_not_specified,
  count(DISTINCT CASE WHEN o_orderpriority = '5-LOW' THEN o_orderstatus END) AS _5_low FROM orders GROUP BY o_custkey""",
)
def pivot_values_from_table(spark, folder):
    orders = read_table(spark, folder, "orders")
    priorities = R.column_value_list(orders, "o_orderpriority", max_records=50)
    return R.pivot(
        orders, ["o_custkey"], "o_orderpriority", priorities,
        agg="count", distinct=True, then_value="o_orderstatus", else_value=None, quote_identifiers=False,
    )


@QUERIES.add(
    "pivot_distinct",
    """SELECT user_id, count(DISTINCT CASE WHEN event_type = 'click' THEN CAST(value AS INTEGER) ELSE 7 END) AS click,
  count(DISTINCT CASE WHEN event_type = 'view' THEN CAST(value AS INTEGER) ELSE 7 END) AS view FROM events GROUP BY user_id""",
)
def pivot_distinct(spark, folder):
    events = read_table(spark, folder, "events").withColumn("whole", F.rint("value").cast("int"))
    return R.pivot(events, ["user_id"], "event_type", ["click", "view"], agg="count", distinct=True, then_value="whole", else_value=7)


@QUERIES.add(
    "pivot_map",
    """SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_values, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent,
  count(*) FILTER (o_orderpriority = '5-LOW') AS low FROM orders GROUP BY o_custkey""",
)
def pivot_map(spark, folder):
    cells = R.pivot_map(read_table(spark, folder, "orders"), ["o_custkey"], "o_orderpriority", F.count(F.lit(1)))
    entry = lambda name: F.coalesce(F.element_at("cells", F.lit(name)), F.lit(0).cast("long"))
    return cells.select("o_custkey", F.size("cells").cast("long").alias("n_values"), entry("1-URGENT").alias("urgent"), entry("5-LOW").alias("low"))


@QUERIES.add(
    "unpivot",
    """SELECT o_orderkey, 'o_custkey' AS prop, CAST(o_custkey AS VARCHAR) AS val FROM orders
  UNION ALL SELECT o_orderkey, 'o_orderstatus', o_orderstatus FROM orders
  UNION ALL SELECT o_orderkey, 'is_large', CAST(o_totalprice > 100000 AS VARCHAR) FROM orders""",
)
def unpivot(spark, folder):
    orders = read_table(spark, folder, "orders").withColumn("is_large", F.col("o_totalprice") > 100000)
    return R.unpivot(
        orders, exclude=["o_orderkey"], remove=["O_TotalPrice", "o_orderdate", "o_orderpriority"],
        field_name="prop", value_name="val",
    )


@QUERIES.add(
    "union_relations",
    """SELECT 'customers' AS _dbt_source_relation, c_custkey AS id, c_nationkey::BIGINT AS nation, c_mktsegment AS segment, NULL::DOUBLE AS balance
  FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT 'suppliers', s_suppkey, s_nationkey, NULL, s_acctbal FROM supplier WHERE s_suppkey % 2 = 0""",
)
def union_relations(spark, folder):
    customers = read_table(spark, folder, "customer").selectExpr(
        "c_custkey AS id", "c_nationkey AS nation", "c_mktsegment AS segment", "c_name AS name"
    )
    suppliers = read_table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS id", "s_nationkey AS nation", "s_acctbal AS balance", "s_name AS name"
    )
    return R.union_relations(
        {"customers": customers, "suppliers": suppliers},
        column_override={"nation": "bigint"}, exclude=["NAME"], where="id % 2 = 0",
    )


@QUERIES.add(
    "union_tables_by_pattern",
    """SELECT 'shop_events_click' AS source_table, event_id, user_id, value FROM events WHERE event_type = 'click'
  UNION ALL SELECT 'shop_events_rest', event_id, user_id, value FROM events WHERE event_type NOT IN ('click', 'view', 'error')
  UNION ALL SELECT 'shop_events_view', event_id, user_id, NULL FROM events WHERE event_type = 'view'
  UNION ALL SELECT 'shop_events_was_error', event_id, NULL, NULL FROM events WHERE event_type = 'error'""",
)
def union_by_pattern(spark, folder):
    events = read_table(spark, folder, "events")
    events.filter("event_type = 'click'").select("event_id", "user_id", "value").createOrReplaceTempView("shop_events_click")
    events.filter("event_type = 'view'").select("event_id", "user_id").createOrReplaceTempView("shop_events_view")
    rest = events.filter("event_type NOT IN ('click', 'view', 'error')").select("event_id", "user_id", "value")
    rest.createOrReplaceTempView("shop_events_rest")
    errors = events.filter("event_type = 'error'").select("event_id")
    errors.createOrReplaceTempView("shop_events_was_error")
    errors.createOrReplaceTempView("shop_events_error")
    return union_tables_by_pattern(spark, "SHOP_events%", exclude="%events_error", source_column_name="source_table")


@QUERIES.add(
    "union_tables_by_prefix",
    "SELECT o_orderkey, o_orderstatus FROM orders",
)
def union_by_prefix(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    for status in ("F", "O", "P"):
        orders.filter(F.col("o_orderstatus") == status).createOrReplaceTempView(f"status_orders_{status}")
    relations = {name: spark.table(name) for name in tables_by_prefix(spark, "status_orders_")}
    return R.union_relations(relations, source_column_name=None)


@QUERIES.add(
    "deduplicate",
    """SELECT event_id, ts, user_id, event_type, value FROM (SELECT *, row_number() OVER
  (PARTITION BY user_id, event_type ORDER BY value DESC, ts, event_id) AS rn FROM events) WHERE rn = 1""",
)
def dedupe(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return deduplicate(events, ["user_id", "event_type"], [F.col("value").desc(), F.col("ts").asc()])


# --- single values and series ---


@QUERIES.add(
    "get_single_value",
    """SELECT o_orderkey, o_totalprice - (SELECT max(o_totalprice) FROM orders) AS below_max, CAST(-1 AS BIGINT) AS fallback
  FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
)
def single_value(spark, folder):
    orders = read_table(spark, folder, "orders")
    newest = get_single_value(orders.agg(F.max("o_orderdate")))
    dearest = get_single_value(orders.agg(F.max("o_totalprice")))
    nothing = get_single_value(orders.filter("o_orderkey < 0").select("o_custkey"), default=-1)
    return orders.filter(F.col("o_orderdate") == newest).select(
        "o_orderkey", (F.col("o_totalprice") - dearest).alias("below_max"), nothing.alias("fallback")
    )


@QUERIES.add(
    "generate_series",
    """SELECT CAST(g AS BIGINT) AS generated_number, o_orderstatus FROM
  (SELECT unnest(generate_series(1, (SELECT count(*) FROM orders))) AS g) LEFT JOIN orders ON o_orderkey = g""",
)
def series(spark, folder):
    orders = read_table(spark, folder, "orders")
    numbers = generate_series(spark, orders.count())
    return numbers.join(orders, F.col("generated_number") == F.col("o_orderkey"), "left").select("generated_number", "o_orderstatus")


@QUERIES.add(
    "date_spine",
    """SELECT d AS date_hour, n FROM (SELECT unnest(generate_series(date_trunc('hour', (SELECT min(ts) FROM events)),
    (SELECT max(ts) FROM events) - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS d)
  LEFT JOIN (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1) ON d = h""",
)
def spine(spark, folder):
    events = read_table(spark, folder, "events").select(F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("h"))
    span = events.agg(F.min("h").alias("a"), F.max("h").alias("b")).first()
    counts = events.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    hours = date_spine(spark, "hour", span["a"], span["b"])
    return hours.join(counts, F.col("date_hour") == F.col("h"), "left").select("date_hour", "n")


@QUERIES.add(
    "intervals_between",
    """SELECT event_id, date_diff('hour', TIMESTAMP '2024-01-03 10:30:00', ts) AS hours, date_diff('day', TIMESTAMP '2024-01-03 10:30:00', ts) AS days,
  date_diff('month', TIMESTAMP '2023-11-30 00:00:00', ts) AS months FROM events""",
)
def intervals(spark, folder):
    start, old = F.lit("2024-01-03 10:30:00"), F.lit("2023-11-30 00:00:00")
    return read_table(spark, folder, "events").select(
        "event_id",
        intervals_between(start, F.col("ts"), "hour").alias("hours"),
        intervals_between(start, F.col("ts"), "day").alias("days"),
        intervals_between(old, F.col("ts"), "month").alias("months"),
    )


# --- scalar functions ---


@QUERIES.add(
    "surrogate_key",
    """SELECT l_orderkey, l_linenumber,
  md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || coalesce(nullif(l_returnflag, 'R'), '_dbt_utils_surrogate_key_null_')) AS row_key,
  md5(CAST(l_orderkey AS VARCHAR) || '-' || coalesce(nullif(l_returnflag, 'R'), '')) AS lenient_key FROM lineitem""",
)
def keys(spark, folder):
    flag = F.nullif(F.col("l_returnflag"), F.lit("R"))
    return read_table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        surrogate_key([F.col("l_orderkey"), F.col("l_linenumber"), flag]).alias("row_key"),
        surrogate_key([F.col("l_orderkey"), flag], nulls_as_empty=True).alias("lenient_key"),
    )


_FEW = "nullif(l_linenumber, 3)"


@QUERIES.add(
    "safe_add",
    f"SELECT l_orderkey, l_linenumber, coalesce({_FEW}, 0) + coalesce(l_partkey, 0) + coalesce(NULL::INTEGER, 0) AS total FROM lineitem",
)
def add_up(spark, folder):
    few = F.nullif(F.col("l_linenumber"), F.lit(3))
    fields = [few, F.col("l_partkey"), F.lit(None).cast("int")]
    return read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", safe_add(fields).alias("total"))


@QUERIES.add(
    "safe_subtract",
    f"SELECT l_orderkey, l_linenumber, coalesce(l_partkey, 0) - coalesce({_FEW}, 0) - coalesce(l_suppkey, 0) AS total FROM lineitem",
)
def subtract(spark, folder):
    few = F.nullif(F.col("l_linenumber"), F.lit(3))
    fields = [F.col("l_partkey"), few, F.col("l_suppkey")]
    return read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", safe_subtract(fields).alias("total"))


@QUERIES.add(
    "safe_divide",
    "SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_tax, 0) AS ratio, l_partkey / nullif(l_linenumber - 2, 0) AS share FROM lineitem",
)
def divide(spark, folder):
    return read_table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        safe_divide(F.col("l_extendedprice"), F.col("l_tax")).alias("ratio"),
        safe_divide(F.col("l_partkey"), F.col("l_linenumber") - 2).alias("share"),
    )


@QUERIES.add(
    "width_bucket",
    """SELECT l_orderkey, l_linenumber, CAST(CASE WHEN CAST(l_quantity AS DECIMAL(28,6)) % 5 = 0 THEN 1 ELSE 0 END
  + least(ceil(l_quantity / 5.0::DOUBLE), 9) AS BIGINT) AS bucket,
  CASE WHEN l_quantity < 0 THEN 0 WHEN l_quantity >= 40 THEN 9 ELSE CAST(floor(l_quantity / 5.0::DOUBLE) AS BIGINT) + 1 END::BIGINT AS native_bucket
  FROM lineitem""",
)
def buckets(spark, folder):
    value = F.col("l_quantity").cast("double")
    return read_table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        width_bucket(value, 0.0, 40.0, 8).alias("bucket"),
        width_bucket(value, 0.0, 40.0, 8, native=True).alias("native_bucket"),
    )


_PLACES = "(c_custkey % 180 - 90)::DOUBLE, (c_custkey % 360 - 180)::DOUBLE, (c_nationkey * 3)::DOUBLE, (c_nationkey * 7)::DOUBLE"


def _haversine_sql(unit: str) -> str:
    return f"""2 * 3961 * asin(sqrt(pow(sin(radians((lat2 - lat1) / 2)), 2)
  + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians((lon2 - lon1) / 2)), 2))) * {1 if unit == "mi" else 1.60934}"""


@QUERIES.add(
    "haversine",
    f"""SELECT c_custkey, CAST(round({_haversine_sql("mi")}, 3) AS DECIMAL(18,3)) AS miles, CAST(round({_haversine_sql("km")}, 3) AS DECIMAL(18,3)) AS km
  FROM (SELECT c_custkey, (c_custkey % 180 - 90)::DOUBLE AS lat1, (c_custkey % 360 - 180)::DOUBLE AS lon1,
  (c_nationkey * 3)::DOUBLE AS lat2, (c_nationkey * 7)::DOUBLE AS lon2 FROM customer)""",
)
def distances(spark, folder):
    places = [F.col("c_custkey") % 180 - 90, F.col("c_custkey") % 360 - 180, F.col("c_nationkey") * 3, F.col("c_nationkey") * 7]
    places = [p.cast("double") for p in places]
    return read_table(spark, folder, "customer").select(
        "c_custkey",
        F.round(haversine(*places), 3).cast("decimal(18,3)").alias("miles"),
        F.round(haversine(*places, unit="km"), 3).cast("decimal(18,3)").alias("km"),
    )


@QUERIES.add(
    "degrees_to_radians",
    "SELECT c_custkey, CAST(round(acos(-1) * (c_custkey % 360) / 180, 9) AS DECIMAL(18,9)) AS angle FROM customer",
)
def angles(spark, folder):
    angle = degrees_to_radians(F.col("c_custkey") % 360)
    return read_table(spark, folder, "customer").select("c_custkey", F.round(angle, 9).cast("decimal(18,9)").alias("angle"))


@QUERIES.add(
    "url_host",
    "SELECT page_id, regexp_extract(regexp_replace(url, '(android-app|https?)://', '', 'g'), '^[^/?]*') AS host FROM pages",
)
def hosts(spark, folder):
    return read_table(spark, folder, "pages").select("page_id", url_host(F.col("url")).alias("host"))


@QUERIES.add(
    "url_path",
    """SELECT page_id, CASE WHEN contains(bare, '/') THEN regexp_extract(bare, '^[^/]*/([^?]*)', 1)
  WHEN contains(bare, '?') THEN '' ELSE bare END AS path FROM (SELECT page_id, regexp_replace(url, 'https?://', '', 'g') AS bare FROM pages)""",
)
def paths(spark, folder):
    return read_table(spark, folder, "pages").select("page_id", url_path(F.col("url")).alias("path"))


@QUERIES.add(
    "url_parameter",
    "SELECT page_id, nullif(regexp_extract(url, 'page=([^&]*)', 1), '') AS page, nullif(regexp_extract(url, 'ref=([^&]*)', 1), '') AS ref FROM pages",
)
def parameters(spark, folder):
    url = F.col("url")
    return read_table(spark, folder, "pages").select(
        "page_id", url_parameter(url, "page").alias("page"), url_parameter(url, "ref").alias("ref")
    )


@QUERIES.add(
    "slugify",
    """SELECT doc_id, coalesce(regexp_replace(regexp_replace(regexp_replace(lower(t), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g'), '^([0-9])', '_\\1'), '') AS slug
  FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN doc_id || '-' || text ELSE text END AS t FROM documents
    UNION ALL SELECT NULL, NULL FROM documents)""",
)
def slugs(spark, folder):
    documents = read_table(spark, folder, "documents")
    numbered = F.concat_ws("-", F.col("doc_id").cast("string"), "text")
    texts = documents.select("doc_id", F.when(F.col("doc_id") % 3 == 0, numbered).otherwise(F.col("text")).alias("t"))
    missing = documents.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("t"))
    return texts.union(missing).select("doc_id", slugify(F.col("t")).alias("slug"))


@QUERIES.add(
    "pivot_long",
    "SELECT l_returnflag, l_partkey AS value, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2",
)
def pivot_long(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    return R.pivot_long(lines, ["l_returnflag"], "l_partkey", F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
