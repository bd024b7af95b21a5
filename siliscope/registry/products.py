"""Queries over product pages and product records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import products as P
from ..functions.text import clean_price, first_float, first_int, normalize_spec_key
from ..operators.dedupe import latest_snapshot
from ..plans import extraction as X
from ..plans import gold, market, refresh, silver
from ..session import scratch_path
from ..sources import bronze as B
from ..sources.derived import derived_catalogue, listing_pages, product_pages
from ..sources import versions as V
from ..sources.tables import PRODUCT_TABLES, Sources, read_table, spread
from ..streaming.incremental import incremental_append, incremental_sync
from .base import Registry, catalogue, over_catalogue

QUERIES = Registry()

# Parts of the checking SQL. Word and point lists come from the plans; their values are checked by hand in the tests.
_CLEAN = "name IS NOT NULL AND price_inr > 0"


def _mentions(words: list[str], text: str = "t") -> str:
    return "(" + " OR ".join(f"contains(lower({text}), '{word}')" for word in words) + ")"


def _labels(labels: dict[str, list[str]], otherwise: str) -> str:
    cases = " ".join(f"WHEN {_mentions(words)} THEN '{label}'" for label, words in labels.items())
    return f"CASE {cases} ELSE '{otherwise}' END"


def _word_points(column: str, scale: list[tuple[int, list[str]]], otherwise: int, more: str = "") -> str:
    cases = " ".join(
        "WHEN " + " OR ".join(f"contains({column}, '{word}')" for word in words) + f" THEN {points}" for points, words in scale
    )
    return f"CASE {cases} {more} ELSE {otherwise} END"


def _size_points(column: str, scale: list[tuple[int, int]], otherwise: int) -> str:
    return "CASE " + " ".join(f"WHEN {column} >= {least} THEN {points}" for points, least in scale) + f" ELSE {otherwise} END"


_CPU_COMBO, _GPU_COMBO = _mentions(P.CPU_COMBO_WORDS), _mentions(P.GPU_COMBO_WORDS)
_CPU_BRAND = _labels(P.CPU_BRANDS, P.UNKNOWN_BRAND)
_GPU_BRAND = _labels(P.GPU_BRANDS, P.UNKNOWN_BRAND)
_FORM = _labels({"laptop": P.LAPTOP_RAM_WORDS}, "desktop")
_STG_LAPTOPS = """SELECT name AS laptop_name, brand, source AS website_source,
  lower(coalesce(cpu, left(name, 50))) AS cpu_description,
  coalesce(TRY_CAST(regexp_extract(memory_type, '(\\d+)', 1) AS INTEGER), 8) AS ram_gb,
  lower(gpu) AS gpu_description
  FROM laptops WHERE name IS NOT NULL"""
# The laptop table holds the records of all categories unless one is asked for; the models tell laptops by name.
_LAPTOPS = f"laptops AS (SELECT * FROM catalogue WHERE {_CLEAN}), stg AS ({_STG_LAPTOPS})"
_SCORED = f"""scored AS (SELECT laptop_name, brand, cpu_description, ram_gb, gpu_description,
  {_word_points("gpu_description", gold.GAMING_TIER, gold.GAMING_TIER_ELSE)} AS gaming_tier_score,
  {_size_points("ram_gb", gold.DEV_RAM, gold.DEV_RAM_ELSE)} + {_word_points("cpu_description", gold.DEV_CPU, gold.DEV_CPU_ELSE)} AS dev_score
  FROM stg)"""
_BUILD = f"""CASE WHEN gaming_tier_score >= {gold.WORKSTATION_GAMING} AND dev_score >= {gold.WORKSTATION_DEV} THEN '{gold.WORKSTATION}'
  WHEN gaming_tier_score >= {gold.GAMING_LEVEL} THEN '{gold.GAMING}'
  WHEN dev_score >= {gold.DEVOPS_LEVEL} THEN '{gold.DEVOPS}' ELSE '{gold.ENTRY}' END AS build_category"""
_WEAK_GPU = f"""WHEN gpu_description = '{gold.GAMING_NO_GPU}' OR contains(gpu_description, '{gold.GAMING_INTEGRATED}')
  THEN {gold.GAMING_INTEGRATED_POINTS}"""


def _no_mark(column: str) -> str:
    return " AND ".join(f"NOT contains({column}, '{mark}')" for mark in gold.NOT_LAPTOP_MARKS)


_MASTER = " UNION ALL ".join(
    f"SELECT name, price_inr, url, '{c}' AS category FROM catalogue WHERE category = '{c}' AND {_CLEAN}"
    for c in ("laptop", "cpu", "gpu", "ram")
)
_GEN = "coalesce(TRY_CAST(regexp_extract(name, '(\\d{2})\\d{2}', 1) AS INTEGER), 10)"
_MONEY = "format('{:,}', {v}) || '.00'"
_PRICE_TEXT = f"""CASE WHEN price_inr IS NULL THEN '0'
  WHEN source = 'MD Computers' AND item_id % 5 = 0 THEN 'Rs ' || CAST(price_inr AS VARCHAR)
  WHEN source IN ('MD Computers', 'Vedant') THEN '₹ ' || {_MONEY.replace("{v}", "price_inr")}
  WHEN category <> 'monitor' AND item_id % 7 = 0 THEN '₹' || {_MONEY.replace("{v}", "price_inr * 2")}
  ELSE '₹' || {_MONEY.replace("{v}", "price_inr")} END"""
_PAGE_PRICE = """CASE WHEN price_inr IS NULL THEN 0
  WHEN source = 'PrimeABGB' AND category <> 'monitor' AND item_id % 7 = 0 THEN price_inr * 2 ELSE price_inr END"""
_PAGE_NAME = "CASE WHEN name IS NULL THEN 'N/A' ELSE name || '& box' END"
_PAGE_SPECS = """SELECT item_id, source, category, 'cores' AS spec_key, coalesce(cores, '1 Core') AS spec_value FROM catalogue
  WHERE source = 'MD Computers' AND (cores IS NOT NULL OR item_id % 4 = 0)
  UNION ALL SELECT item_id, source, category, 'cores', cores FROM catalogue WHERE source = 'Vedant' AND cores IS NOT NULL
  UNION ALL SELECT item_id, source, category, 'speed', speed FROM catalogue
    WHERE source = 'MD Computers' OR (source = 'PrimeABGB' AND category = 'monitor')
  UNION ALL SELECT item_id, source, category, 'memory_type', memory_type FROM catalogue
    WHERE memory_type IS NOT NULL AND (source <> 'PrimeABGB' OR category = 'monitor')
  UNION ALL SELECT item_id, source, category, 'brand', brand FROM catalogue WHERE source = 'MD Computers' AND item_id % 3 = 0
  UNION ALL SELECT item_id, source, category, 'category', 'Components' FROM catalogue WHERE source = 'MD Computers' AND item_id % 10 = 3
  UNION ALL SELECT item_id, source, category, 'category', 'Hardware' FROM catalogue WHERE source = 'Vedant' AND item_id % 4 = 1
  UNION ALL SELECT item_id, source, category, 'source', 'Imported & boxed' FROM catalogue WHERE source = 'MD Computers' AND item_id % 14 = 5
  UNION ALL SELECT item_id, source, category, 'warranty_term', CAST(item_id % 3 + 1 AS VARCHAR) || ' Years' FROM catalogue WHERE source = 'MD Computers'
  UNION ALL SELECT item_id, source, category, 'box_contents', brand FROM catalogue WHERE source = 'Vedant' AND brand IS NOT NULL"""
_NOT_COMBO = f"""NOT (category = 'cpu' AND {_CPU_COMBO.replace("(t)", "(n)")}) AND NOT (category = 'gpu' AND {_GPU_COMBO.replace("(t)", "(n)")})"""


def _tables(spark, folder) -> dict:
    sources = Sources.from_bronze(catalogue(spark, folder))
    return {name: sources.table(name) for name in sources.names()}


def _stg_laptops(spark, folder):
    return silver.stg_laptops(silver.sync_table(catalogue(spark, folder))).drop(silver.UPDATED_AT)


def _pages(spark, folder):
    return product_pages(derived_catalogue(spread(read_table(spark, folder, "part"))))


# --- storage ---


@QUERIES.add(
    "read_bronze",
    over_catalogue(
        """SELECT name, CAST(price_inr AS VARCHAR) AS price_inr, url, cores, NULL::VARCHAR AS memory_size
  FROM catalogue WHERE category = 'cpu'
  UNION ALL SELECT name, CAST(price_inr AS VARCHAR), url, NULL, memory_type FROM catalogue WHERE category <> 'cpu'"""
    ),
)
def read_bronze(spark, folder):
    rows, root = catalogue(spark, folder), scratch_path(spark, "read-bronze")
    cpus = rows.filter("category = 'cpu'").select("name", "price_inr", "url", "cores", "source")
    gpus = rows.filter("category <> 'cpu'")
    gpus = gpus.select("name", F.col("price_inr").cast("string"), "url", F.col("memory_type").alias("memory_size"))
    # The price changes its type inside the folder.
    vedant = F.col("source") == "Vedant"
    cpus.filter(vedant).drop("source").write.parquet(f"{root}/cpu_details")
    cpus.filter(~vedant).drop("source").withColumn("price_inr", F.col("price_inr").cast("string")).write.mode("append").parquet(f"{root}/cpu_details")
    gpus.write.parquet(f"{root}/gpu_details")
    return B.read_bronze(spark, [f"{root}/cpu_details", f"{root}/gpu_details"])


@QUERIES.add("write_bronze", over_catalogue("SELECT * FROM catalogue"))
def write_bronze(spark, folder):
    rows, path = catalogue(spark, folder), scratch_path(spark, "write-bronze")
    B.write_bronze(rows.filter("category = 'cpu'"), path)
    B.write_bronze(rows.filter("category <> 'cpu'"), path)
    return B.read_partitioned_bronze(spark, path)


@QUERIES.add(
    "refresh_table",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F' OR o_totalprice > 100000",
)
def refresh_table(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    path = scratch_path(spark, "refresh-table")
    B.refresh_table(orders, path, ["o_orderstatus"])
    B.refresh_table(orders.filter("o_orderstatus = 'F' AND o_totalprice > 100000"), path, ["o_orderstatus"])
    return V.read_published(spark, path)


@QUERIES.add(
    "refresh_audit",
    over_catalogue(f"SELECT count(*) AS rows_sent, count(*) AS rows_stored, true AS matches FROM catalogue WHERE {_CLEAN}"),
)
def refresh_audit(spark, folder):
    return B.refresh_audit(silver.sync_clean(catalogue(spark, folder)), scratch_path(spark, "refresh-audit"))


@QUERIES.add(
    "view_model",
    over_catalogue(f"SELECT brand, count(*) AS n FROM catalogue WHERE {_CLEAN} AND name LIKE '%Processor%' GROUP BY brand"),
)
def view_model(spark, folder):
    B.view_model(silver.stg_cpus(silver.sync_table(catalogue(spark, folder))), "stg_cpus_model")
    return spark.sql("SELECT brand, count(*) AS n FROM stg_cpus_model GROUP BY brand")


@QUERIES.add(
    "table_model",
    over_catalogue(f"SELECT brand, count(*) AS n FROM catalogue WHERE {_CLEAN} AND name LIKE '%Graphics Card%' GROUP BY brand"),
)
def table_model(spark, folder):
    path = scratch_path(spark, "table-model")
    B.table_model(silver.stg_gpus(silver.sync_table(catalogue(spark, folder))), "stg_gpus_model", path)
    return spark.sql("SELECT brand, count(*) AS n FROM stg_gpus_model GROUP BY brand")


@QUERIES.add(
    "sources",
    over_catalogue(
        f"""SELECT CASE category WHEN 'cpu' THEN 'cpus' WHEN 'gpu' THEN 'gpus' WHEN 'laptop' THEN 'laptops'
  WHEN 'monitor' THEN 'monitors' ELSE 'ram' END AS table_name, count(*) AS n_rows FROM catalogue WHERE {_CLEAN} GROUP BY 1"""
    ),
)
def sources(spark, folder):
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in _tables(spark, folder).items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


@QUERIES.add("incremental_append", over_catalogue(f"SELECT * FROM catalogue WHERE {_CLEAN}"))
def appended(spark, folder):
    root = scratch_path(spark, "incremental")
    return incremental_append(
        spark,
        folder,
        read_table(spark, folder, "part").schema,
        f"{root}/cleaned",
        f"{root}/progress",
        transform=lambda part: silver.sync_clean(derived_catalogue(part)),
        path_glob="part.parquet",
    )


@QUERIES.add(
    "incremental_sync",
    over_catalogue(
        f"""SELECT name, price_inr, url, source, category, brand, cores, CASE category WHEN 'cpu' THEN 'cpus' WHEN 'gpu' THEN 'gpus'
    WHEN 'laptop' THEN 'laptops' WHEN 'monitor' THEN 'monitors' ELSE 'ram' END AS table_name
  FROM (SELECT * REPLACE (CASE WHEN source = 'MD Computers' THEN 2 * price_inr WHEN source = 'Vedant' AND cores IS NULL THEN NULL
    ELSE price_inr END AS price_inr) FROM catalogue) WHERE {_CLEAN}"""
    ),
)
def incremental(spark, folder):
    """Every record, then a second crawl: new prices, products that lost theirs, and older records that come late."""
    root = scratch_path(spark, "incremental")
    records = catalogue(spark, folder).select("name", "price_inr", "url", "source", "category", "brand", "cores", F.col("category").alias(B.RESOURCE))
    tables = F.create_map(*[F.lit(text) for name, category in PRODUCT_TABLES.items() for text in (category, name)])

    def crawl(hour: int, rows, price):
        stamp = F.lit(f"2026-01-01 {hour:02d}:00:00").cast("timestamp")
        B.write_bronze(rows.withColumn("price_inr", price.cast("long")).withColumn("loaded_at", stamp), f"{root}/bronze")

    def sync():
        schema = B.read_partitioned_bronze(spark, f"{root}/bronze").schema
        incremental_sync(spark, f"{root}/bronze", schema, f"{root}/tables", f"{root}/progress", table=tables[F.col(B.RESOURCE)], buckets=8)

    crawl(8, records, F.col("price_inr"))
    sync()
    crawl(9, records.filter("source = 'MD Computers'"), 2 * F.col("price_inr"))
    crawl(9, records.filter("source = 'Vedant' AND cores IS NULL"), F.lit(None))
    crawl(7, records.filter("source <> 'Vedant'"), F.lit(1))
    sync()
    found = [V.read_published(spark, f"{root}/tables/{name}").withColumn("table_name", F.lit(name)) for name in PRODUCT_TABLES if V.current(spark, f"{root}/tables/{name}")]
    return reduce(DataFrame.unionByName, found).drop(B.RESOURCE, "loaded_at")


@QUERIES.add(
    "latest_snapshot",
    "SELECT user_id, event_id, ts, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1",
)
def latest(spark, folder):
    events = read_table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_snapshot(events, "ts", key="user_id")


# --- pages ---


@QUERIES.add(
    "extract_name",
    r"""SELECT page_id, trim(replace(replace(replace(replace(replace(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1),
  '&nbsp;', ' '), '&quot;', '"'), '&#x27;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS name FROM pages""",
)
def extract_name(spark, folder):
    return X.extract_name(read_table(spark, folder, "pages"))


@QUERIES.add(
    "extract_links",
    r"""SELECT page_id, CAST(i - 1 AS INTEGER) AS position, regexp_extract(a[i], 'href="([^"]*)"', 1) AS href,
  regexp_extract(a[i], '>(.*)</a>', 1) AS text
  FROM (SELECT page_id, a, unnest(generate_series(1, len(a))) AS i FROM
    (SELECT page_id, regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), '<a href=.*?</a>') AS a FROM pages))""",
)
def extract_links(spark, folder):
    return X.element_links(read_table(spark, folder, "pages"), "nav")


@QUERIES.add(
    "cap_links",
    over_catalogue(
        f"""SELECT page_id, source, category, CAST(rn - 1 AS INTEGER) AS position, url || '?a=1&b=2' AS href, n AS text FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id, source, category ORDER BY item_id) AS rn FROM (
    SELECT *, coalesce(name, '') AS n, CAST(floor(item_id / 400) AS BIGINT) AS page_id FROM catalogue) WHERE {_NOT_COMBO})
  WHERE (source = 'PrimeABGB' AND category IN ('cpu', 'gpu'))
     OR rn <= CASE WHEN category IN ('laptop', 'ram') THEN 30 ELSE 20 END"""
    ),
)
def cap_links(spark, folder):
    return X.listing_links(listing_pages(catalogue(spark, folder)), X.LINK_CAPS, X.UNCAPPED_LINKS)


@QUERIES.add(
    "listing_links",
    over_catalogue(
        f"""SELECT page_id, source, category, CAST(row_number() OVER (PARTITION BY page_id, source, category ORDER BY item_id) - 1 AS INTEGER)
    AS position, url || '?a=1&b=2' AS href, n AS text FROM (
    SELECT *, coalesce(name, '') AS n, CAST(floor(item_id / 400) AS BIGINT) AS page_id FROM catalogue) WHERE {_NOT_COMBO}"""
    ),
)
def listing_links(spark, folder):
    return X.listing_links(listing_pages(catalogue(spark, folder)))


@QUERIES.add("extract_price_text", over_catalogue(f"SELECT item_id AS page_id, {_PRICE_TEXT} AS price_text FROM catalogue"))
def extract_price_text(spark, folder):
    return X.extract_price_text(_pages(spark, folder))


@QUERIES.add(
    "clean_price",
    """SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS whole, CAST(0 AS BIGINT) AS marked, CAST(0 AS BIGINT) AS nothing,
  TRY_CAST('9' || lpad(CAST(o_orderkey AS VARCHAR), 17 + CAST(o_custkey % 3 AS INTEGER), '0') AS BIGINT) AS long FROM orders""",
)
def clean_prices(spark, folder):
    orders = read_table(spark, folder, "orders")
    money = F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2)
    return orders.select(
        "o_orderkey",
        clean_price(F.concat(F.lit("  ₹ "), money, F.lit(" "))).alias("whole"),
        clean_price(F.concat(F.lit("Rs. "), money)).alias("marked"),
        clean_price(F.lower(F.col("o_orderstatus"))).alias("nothing"),
        clean_price(F.concat(F.lit("₹9,"), F.lpad(F.col("o_orderkey").cast("string"), (17 + F.col("o_custkey") % 3).cast("int"), "0"), F.lit(".50"))).alias("long"),
    )


@QUERIES.add(
    "extract_specs",
    over_catalogue(f"SELECT item_id AS page_id, spec_key, spec_value FROM ({_PAGE_SPECS})"),
)
def extract_specs(spark, folder):
    specs = X.extract_specs(_pages(spark, folder))
    return specs.select("page_id", F.explode_outer("specs").alias("spec_key", "spec_value")).filter("spec_key IS NOT NULL")


@QUERIES.add(
    "spec_key_census",
    over_catalogue(
        f"""SELECT coalesce(v.own, r.category) AS category, spec_key, count(*) AS n_records FROM
  (SELECT s.*, {_PAGE_NAME} AS n FROM ({_PAGE_SPECS}) s JOIN (SELECT item_id, name FROM catalogue) USING (item_id)) r
  LEFT JOIN (SELECT item_id, spec_value AS own FROM ({_PAGE_SPECS}) WHERE spec_key = 'category') v USING (item_id)
  WHERE {_NOT_COMBO.replace('category', 'r.category')} GROUP BY 1, spec_key"""
    ),
)
def spec_key_census(spark, folder):
    return X.spec_key_census(X.extract_products(_pages(spark, folder)))


@QUERIES.add(
    "normalize_spec_key",
    """SELECT p_partkey, lower(replace(trim('  ' || p_name || ' : ' || p_type || ' '), ' ', '_')) AS spec_key,
  replace(lower(replace(trim('  ' || p_name || ' : ' || p_type || ' '), ' ', '_')), ':', '') AS bare_key FROM part""",
)
def normalize_keys(spark, folder):
    text = F.concat(F.lit("  "), "p_name", F.lit(" : "), "p_type", F.lit(" "))
    return read_table(spark, folder, "part").select(
        "p_partkey", normalize_spec_key(text).alias("spec_key"), normalize_spec_key(text, drop_colon=True).alias("bare_key")
    )


@QUERIES.add(
    "extract_highlights",
    over_catalogue(
        """SELECT item_id AS page_id, CASE WHEN source = 'PrimeABGB' AND category <> 'monitor'
  THEN coalesce(cores || ' | ', '') || speed || ' > 1' END AS highlights FROM catalogue"""
    ),
)
def extract_highlights(spark, folder):
    return X.extract_highlights(_pages(spark, folder))


_RECORD = f"""SELECT c.name, c.url, coalesce(f.spec_value, c.source) AS source, coalesce(k.spec_value, c.category) AS category, c.category AS resource,
  coalesce(b.spec_value, CASE c.category WHEN 'cpu' THEN {_CPU_BRAND.replace('(t)', '(c.n)')} WHEN 'gpu' THEN {_GPU_BRAND.replace('(t)', '(c.n)')} END) AS brand,
  CASE WHEN c.category = 'ram' THEN {_FORM.replace('(t)', '(c.n)')} END AS form_factor, c.price_inr,
  CASE WHEN c.source = 'PrimeABGB' AND c.category <> 'monitor' THEN coalesce(c.cores || ' | ', '') || c.speed || ' > 1' END AS highlights,
  c.item_id
  FROM (SELECT item_id, url, source, category, cores, speed, {_PAGE_NAME} AS name, {_PAGE_NAME} AS n, {_PAGE_PRICE} AS price_inr FROM catalogue) c
  LEFT JOIN (SELECT * FROM ({_PAGE_SPECS}) WHERE spec_key = 'brand') b USING (item_id)
  LEFT JOIN (SELECT * FROM ({_PAGE_SPECS}) WHERE spec_key = 'category') k USING (item_id)
  LEFT JOIN (SELECT * FROM ({_PAGE_SPECS}) WHERE spec_key = 'source') f USING (item_id)
  WHERE {_NOT_COMBO.replace('category', 'c.category')}"""


@QUERIES.add(
    "base_record",
    over_catalogue(f"SELECT name, url, source, category, resource, brand, form_factor, price_inr, highlights FROM ({_RECORD})"),
)
def base_records(spark, folder):
    return X.extract_products(_pages(spark, folder)).drop("specs")


@QUERIES.add(
    "specs_to_columns",
    over_catalogue(
        f"""SELECT r.url, r.source, r.category, r.resource, r.brand, r.price_inr, k.spec_value AS cores, s.spec_value AS speed,
    m.spec_value AS memory_type, w.spec_value AS warranty_term, n.n_specs FROM ({_RECORD}) r
  LEFT JOIN (SELECT * FROM ({_PAGE_SPECS}) WHERE spec_key = 'cores') k USING (item_id)
  LEFT JOIN (SELECT * FROM ({_PAGE_SPECS}) WHERE spec_key = 'speed') s USING (item_id)
  LEFT JOIN (SELECT * FROM ({_PAGE_SPECS}) WHERE spec_key = 'memory_type') m USING (item_id)
  LEFT JOIN (SELECT * FROM ({_PAGE_SPECS}) WHERE spec_key = 'warranty_term') w USING (item_id)
  JOIN (SELECT item_id, CAST(count(spec_key) AS INTEGER) AS n_specs FROM (SELECT item_id FROM catalogue)
    LEFT JOIN ({_PAGE_SPECS}) USING (item_id) GROUP BY 1) n USING (item_id)"""
    ),
)
def specs_to_columns(spark, folder):
    """Requested keys as columns; the map, with the keys that nobody asked for, is kept beside them."""
    records = X.extract_products(_pages(spark, folder))
    wide = X.specs_to_columns(records, ["cores", "speed", "memory_type", "warranty_term", "brand", "category"], keep_map=True)
    columns = ["url", "source", "category", "resource", "brand", "price_inr", "cores", "speed", "memory_type", "warranty_term"]
    return wide.select(*columns, F.size("specs").alias("n_specs"))


# --- names and predicates ---


@QUERIES.add(
    "combo_filter",
    over_catalogue(f"SELECT item_id, n AS name, category FROM (SELECT item_id, category, coalesce(name, '') || CASE item_id % 6 WHEN 0 THEN ' + Motherboard' WHEN 1 THEN ' + PSU' ELSE '' END AS n FROM catalogue) WHERE {_NOT_COMBO}"),
)
def combo_filter(spark, folder):
    extra = F.when(F.col("item_id") % 6 == 0, " + Motherboard").when(F.col("item_id") % 6 == 1, " + PSU").otherwise("")
    named = catalogue(spark, folder).select(
        "item_id", F.concat(F.coalesce("name", F.lit("")), extra).alias("name"), "category"
    )
    return X.combo_filter(named)


def _classified(name: str, sql: str, column):
    @QUERIES.add(name, over_catalogue(f"SELECT item_id, {sql.replace('(t)', '(name)')} AS label FROM catalogue"))
    def run(spark, folder):
        return catalogue(spark, folder).select("item_id", column(F.col("name")).alias("label"))


_classified("detect_brand_cpu", _CPU_BRAND, P.detect_brand_cpu)
_classified("detect_brand_gpu", _GPU_BRAND, P.detect_brand_gpu)
_classified("ram_form_factor", _FORM, P.ram_form_factor)
_classified("extract_gen", _GEN, P.extract_gen)


@QUERIES.add(
    "number_regex",
    over_catalogue(
        """SELECT item_id, TRY_CAST(regexp_extract(cores, '(\\d+)', 1) AS INTEGER) AS cores,
  TRY_CAST(regexp_extract(speed, '(\\d+\\.?\\d*)', 1) AS FLOAT) AS speed,
  TRY_CAST(regexp_extract(memory_type, '(\\d+)', 1) AS INTEGER) AS memory FROM catalogue"""
    ),
)
def number_regex(spark, folder):
    return catalogue(spark, folder).select(
        "item_id",
        first_int(F.col("cores")).alias("cores"),
        first_float(F.col("speed")).alias("speed"),
        first_int(F.col("memory_type")).alias("memory"),
    )


# --- silver ---


@QUERIES.add("sync_clean", over_catalogue(f"SELECT * FROM catalogue WHERE {_CLEAN}"))
def sync_clean(spark, folder):
    return silver.sync_clean(catalogue(spark, folder))


@QUERIES.add(
    "sync_report",
    over_catalogue(
        f"""SELECT count(*) AS rows_read, count(*) FILTER (name IS NULL) AS dropped_null_name,
  count(*) FILTER (name IS NOT NULL AND (price_inr IS NULL OR price_inr <= 0)) AS dropped_no_price,
  count(*) FILTER (name IS NOT NULL AND price_inr IS NULL) AS dropped_unread_price, count(*) FILTER ({_CLEAN}) AS rows_clean FROM catalogue"""
    ),
)
def sync_report(spark, folder):
    return silver.sync_report(catalogue(spark, folder))


@QUERIES.add(
    "stg_cpus",
    over_catalogue(
        f"""SELECT name AS cpu_full_name, brand, coalesce(TRY_CAST(regexp_extract(cores, '(\\d+)', 1) AS INTEGER), 0) AS core_count,
  TRY_CAST(regexp_extract(speed, '(\\d+\\.?\\d*)', 1) AS FLOAT) AS clock_speed_ghz,
  NULL::VARCHAR AS socket, NULL::VARCHAR AS tdp_watts, source AS website_source
  FROM catalogue WHERE {_CLEAN} AND (category = 'Processors' OR name LIKE '%Processor%')"""
    ),
)
def stg_cpus(spark, folder):
    return silver.stg_cpus(silver.sync_table(catalogue(spark, folder)))


@QUERIES.add(
    "stg_gpus",
    over_catalogue(
        f"""SELECT name AS gpu_full_name, brand, 0 AS vram_gb, memory_type, lower(name) LIKE '%rtx%' AS is_rtx,
  NULL::VARCHAR AS recommended_psu, source AS website_source
  FROM catalogue WHERE {_CLEAN} AND (category = 'Graphics Card' OR name LIKE '%Graphics Card%')"""
    ),
)
def stg_gpus(spark, folder):
    return silver.stg_gpus(silver.sync_table(catalogue(spark, folder)))


@QUERIES.add("stg_laptops", over_catalogue(f", {_LAPTOPS} SELECT * FROM stg"))
def stg_laptops(spark, folder):
    return _stg_laptops(spark, folder)


@QUERIES.add(
    "stg_laptops_older_form",
    over_catalogue(
        f"""SELECT name AS laptop_name, brand, source AS website_source, lower(coalesce(cpu, left(name, 50), 'unknown cpu')) AS cpu_description,
  coalesce(TRY_CAST(regexp_extract(memory_type, '(\\d+)', 1) AS INTEGER), 0) AS ram_gb, NULL::VARCHAR AS weight
  , lower(gpu) AS gpu_description FROM catalogue WHERE {_CLEAN}"""
    ),
)
def stg_laptops_older(spark, folder):
    laptops = silver.sync_table(catalogue(spark, folder))
    older = silver.stg_laptops(laptops, default_ram_gb=0, default_cpu="unknown cpu", with_weight=True)
    return older.drop(silver.UPDATED_AT)


@QUERIES.add(
    "stg_laptops_whole_name", over_catalogue(f", {_LAPTOPS.replace('left(name, 50)', 'name')} SELECT * FROM stg")
)
def stg_laptops_whole_name(spark, folder):
    laptops = silver.sync_table(catalogue(spark, folder))
    return silver.stg_laptops(laptops, name_prefix=None).drop(silver.UPDATED_AT)


# --- gold ---


@QUERIES.add("build_category", over_catalogue(f", {_LAPTOPS}, {_SCORED} SELECT *, {_BUILD} FROM scored"))
def build_category(spark, folder):
    return gold.scored_hardware(_stg_laptops(spark, folder))


@QUERIES.add(
    "not_laptop_filter",
    over_catalogue(
        f"SELECT name AS laptop_name FROM catalogue WHERE {_CLEAN} AND {_no_mark('name')}"
    ),
)
def not_laptop_filter(spark, folder):
    return gold.not_laptop_filter(silver.stg_laptops(silver.sync_table(catalogue(spark, folder)))).select("laptop_name")


@QUERIES.add(
    "fact_hardware_recommendations",
    over_catalogue(
        f", {_LAPTOPS}, {_SCORED} SELECT *, {_BUILD}, RANK() OVER (ORDER BY gaming_tier_score + dev_score DESC) AS global_rank FROM scored"
    ),
)
def fact_hardware_recommendations(spark, folder):
    return gold.fact_hardware_recommendations(_stg_laptops(spark, folder))


@QUERIES.add(
    "fact_laptop_rankings",
    over_catalogue(
        f""", {_LAPTOPS}, points AS (SELECT *, {_size_points("ram_gb", gold.CODING_RAM, gold.CODING_RAM_ELSE)} AS memory,
    {_word_points("gpu_description", gold.GAMING_RANK, gold.GAMING_RANK_ELSE)} AS rtx
    FROM stg WHERE {_no_mark("laptop_name")})
  SELECT laptop_name, brand, cpu_description, ram_gb, gpu_description, website_source,
    memory + {_word_points("cpu_description", gold.CODING_CPU, gold.CODING_CPU_ELSE)} AS coding_score,
    {_word_points("gpu_description", gold.GAMING_GPU, gold.GAMING_GPU_ELSE, _WEAK_GPU)} AS gaming_score,
    RANK() OVER (ORDER BY memory DESC) AS coding_rank, RANK() OVER (ORDER BY rtx DESC) AS gaming_rank FROM points"""
    ),
)
def fact_laptop_rankings(spark, folder):
    return gold.fact_laptop_rankings(_stg_laptops(spark, folder))


@QUERIES.add("master_catalog", over_catalogue(_MASTER))
def master_catalog(spark, folder):
    return market.master_catalog(_tables(spark, folder))


@QUERIES.add(
    "master_catalog_shared_tables",
    over_catalogue(
        " UNION ALL ".join(
            f"SELECT name, price_inr, url, '{c}' AS category FROM catalogue WHERE {_CLEAN}" for c in ("laptop", "cpu", "gpu", "ram")
        )
    ),
)
def master_catalog_shared_tables(spark, folder):
    """Product tables that each hold all categories: every product is listed under each category."""
    sources = Sources.from_bronze(catalogue(spark, folder), by_category=False)
    return market.master_catalog({name: sources.table(name) for name in sources.names()})


def _top_sql(master: str) -> str:
    return f"""SELECT name, price_inr, url, category, gen_score, value_score FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY value_score DESC, name, url) AS place FROM (
    SELECT *, (gen_score * 10) / (CAST(price_inr AS DOUBLE) / 1000) AS value_score FROM (
      SELECT *, {_GEN} AS gen_score FROM ({master})))) WHERE place <= 5"""


@QUERIES.add("value_topk", over_catalogue(_top_sql(_MASTER)))
def value_topk(spark, folder):
    clean = silver.sync_clean(catalogue(spark, folder))
    return market.value_topk(market.master_catalog_from_bronze(clean))


@QUERIES.add("value_topk_all_categories", over_catalogue(_top_sql(f"SELECT name, price_inr, url, category FROM catalogue WHERE {_CLEAN}")))
def value_topk_all_categories(spark, folder):
    clean = silver.sync_clean(catalogue(spark, folder))
    return market.value_topk(clean.select("name", "price_inr", "url", "category"))


# --- from pages to the report ---


def _refreshed(spark, folder):
    """Two loads of the same pages, so that the history holds every record twice."""
    root, pages = scratch_path(spark, "refresh"), _pages(spark, folder)
    refresh.ingest(pages, f"{root}/bronze", F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
    refresh.ingest(pages, f"{root}/bronze", F.lit("2026-01-01 01:00:00").cast("timestamp_ntz"))
    return root, refresh.sync(spark, f"{root}/bronze", f"{root}/tables", latest_only=True)


_STORED = f"SELECT * FROM ({_RECORD}) WHERE price_inr > 0"


@QUERIES.add(
    "full_refresh_audit",
    over_catalogue(
        f"""SELECT CASE resource WHEN 'cpu' THEN 'cpus' WHEN 'gpu' THEN 'gpus' WHEN 'laptop' THEN 'laptops' WHEN 'monitor' THEN 'monitors' ELSE 'ram' END AS table_name,
  count(*) AS rows_read, count(*) FILTER (name IS NULL) AS dropped_null_name, count(*) FILTER (price_inr <= 0) AS dropped_no_price,
  count(*) FILTER (price_inr IS NULL) AS dropped_unread_price,
  count(*) FILTER (price_inr > 0) AS rows_sent, count(*) FILTER (price_inr > 0) AS rows_stored, true AS matches
  FROM ({_RECORD}) GROUP BY 1"""
    ),
)
def full_refresh_audit(spark, folder):
    return _refreshed(spark, folder)[1]


@QUERIES.add(
    "incremental_refresh",
    over_catalogue(
        f"""SELECT CASE resource WHEN 'cpu' THEN 'cpus' WHEN 'gpu' THEN 'gpus' WHEN 'laptop' THEN 'laptops' WHEN 'monitor' THEN 'monitors' ELSE 'ram' END AS table_name,
  count(*) AS rows_stored FROM ({_STORED}) GROUP BY 1"""
    ),
)
def incremental_refresh(spark, folder):
    """The tables brought up to date after each of two loads of the same pages."""
    root, pages = scratch_path(spark, "refresh"), _pages(spark, folder)
    for hour in (0, 1):
        refresh.ingest(pages, f"{root}/bronze", F.lit(f"2026-01-01 {hour:02d}:00:00").cast("timestamp"))
        found = refresh.sync_new(spark, f"{root}/bronze", f"{root}/tables", f"{root}/progress", buckets=8)
    return found


@QUERIES.add(
    "market_insights",
    over_catalogue(_top_sql(f"SELECT name, price_inr, url, resource AS category FROM ({_STORED}) WHERE resource <> 'monitor'")),
)
def market_insights(spark, folder):
    root, _ = _refreshed(spark, folder)
    models = refresh.build_models(refresh.product_tables(spark, f"{root}/tables"), f"{root}/models")
    return models[refresh.INSIGHTS_TABLE]
