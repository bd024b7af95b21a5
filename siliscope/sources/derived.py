"""Product data derived from the ``part`` table, for queries, benches and tests.

The general tables hold no products with specifications, so each part becomes
one product record, one product page and one entry of a listing page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The same text runs on Spark and on the engine that checks the results.
CATALOGUE_SQL = """
SELECT p_partkey AS item_id,
  CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE
    CASE p_partkey % 8
      WHEN 0 THEN p_name || ' Intel Core i7-13700K Processor'
      WHEN 1 THEN p_name || ' AMD Ryzen 9 7950X Processor'
      WHEN 2 THEN p_name || ' GeForce RTX 4060 Graphics Card'
      WHEN 3 THEN p_name || ' Radeon RX 7900 XTX Graphics Card'
      WHEN 4 THEN p_name || ' DDR5 SODIMM 5600MHz'
      WHEN 5 THEN p_name || ' 27 Inch Monitor'
      WHEN 6 THEN p_name || ' Gaming Laptop combo'
      ELSE p_name || ' Creator Laptop' END END AS name,
  CASE WHEN p_partkey % 37 = 0 THEN CAST(0 AS BIGINT)
       WHEN p_partkey % 53 = 0 THEN CAST(NULL AS BIGINT)
       ELSE CAST(FLOOR(p_retailprice) AS BIGINT) * (1 + p_size) END AS price_inr,
  'https://shop.example/p/' || CAST(p_partkey AS VARCHAR(20)) AS url,
  CASE p_size % 3 WHEN 0 THEN 'MD Computers' WHEN 1 THEN 'PrimeABGB' ELSE 'Vedant' END AS source,
  CASE p_partkey % 8 WHEN 0 THEN 'cpu' WHEN 1 THEN 'cpu' WHEN 2 THEN 'gpu' WHEN 3 THEN 'gpu'
       WHEN 4 THEN 'ram' WHEN 5 THEN 'monitor' ELSE 'laptop' END AS category,
  p_brand AS brand,
  CASE WHEN p_size % 11 = 0 THEN NULL WHEN p_size % 13 = 0 THEN 'n/a' ELSE CAST(4 + 2 * (p_size % 8) AS VARCHAR(20)) || ' Cores' END AS cores,
  CAST(2 + p_size % 4 AS VARCHAR(20)) || '.' || CAST(p_partkey % 10 AS VARCHAR(20)) || 'GHz' AS speed,
  CASE WHEN p_size % 9 = 0 THEN NULL ELSE CAST(8 * (p_size % 7) AS VARCHAR(20)) || 'GB DDR5' END AS memory_type,
  CASE p_size % 5 WHEN 0 THEN 'Core i9' WHEN 1 THEN 'Ryzen 7' WHEN 2 THEN 'Core i5' WHEN 3 THEN 'Core i7' ELSE NULL END AS cpu,
  CASE p_size % 7 WHEN 0 THEN 'RTX 5080' WHEN 1 THEN 'RTX 4060' WHEN 2 THEN 'RTX 3050' WHEN 3 THEN 'RX 7900'
       WHEN 4 THEN 'Integrated' WHEN 5 THEN 'no' ELSE NULL END AS gpu
FROM {part}
"""

# Items per block of ids on a listing page; bounds the groups that make the pages.
LISTING_BLOCK = 400


def derived_catalogue(part: DataFrame) -> DataFrame:
    """One product record per part."""
    return part.sparkSession.sql(CATALOGUE_SQL, part=part)


def _row(*cells: Column | str, tag: str = "td") -> Column:
    parts: list[Column] = [F.lit("<tr>")]
    for i, cell in enumerate(cells):
        name = tag if i == 0 else "td"
        parts += [F.lit(f"<{name}>"), F.lit(cell) if isinstance(cell, str) else cell, F.lit(f"</{name}>")]
    return F.coalesce(F.concat(*parts, F.lit("</tr>")), F.lit(""))


def product_pages(catalogue: DataFrame) -> DataFrame:
    """A product page per record, marked up the way its site does.

    Some pages have rows called Category and Source, which replace those columns of the record but not its resource,
    and rows that no model asks for.
    """
    item, source, price = F.col("item_id"), F.col("source"), F.col("price_inr")

    def amount(value: Column) -> Column:
        return F.concat(
            F.lit('<span class="woocommerce-Price-amount amount"><bdi><span class="sign">&#8377;</span>'),
            F.format_number(value, 2),
            F.lit("</bdi></span>"),
        )

    plain = F.concat(F.lit('<span class="price-new">&#x20B9; '), F.format_number(price, 2), F.lit("</span>"))
    as_list = F.concat(F.lit('<ul class="list-unstyled"><li>Rs '), price.cast("string"), F.lit("</li></ul>"))
    old = F.concat(F.lit("<del>"), amount(price * 2), F.lit("</del>"))
    prime = F.concat(
        F.lit('<p class="price">'),
        F.when(item % 7 == 0, old).otherwise(F.lit("")),
        F.lit("<ins>"),
        amount(price),
        F.lit("</ins></p>"),
    )
    price_html = (
        F.when((source == "MD Computers") & (item % 5 == 0), as_list)
        .when(source.isin("MD Computers", "Vedant"), plain)
        .otherwise(prime)
    )
    md_specs = F.concat(
        F.lit('<div class="tab" id="tab-specification"><div>Details</div><table>'),
        _row("Heading"),
        F.when(item % 4 == 0, _row("Cores", "1 Core")).otherwise(F.lit("")),
        _row(" Cores ", F.col("cores")),
        _row("Speed", F.concat(F.lit("<b>"), F.col("speed"), F.lit("</b>"))),
        F.when(item % 3 == 0, _row("Brand", F.col("brand"))).otherwise(F.lit("")),
        _row("Memory Type", F.col("memory_type")),
        F.when(item % 10 == 3, _row("Category", "Components")).otherwise(F.lit("")),
        F.when(item % 14 == 5, _row(" Source ", "Imported &amp; boxed")).otherwise(F.lit("")),
        _row("Warranty Term", F.concat((item % 3 + 1).cast("string"), F.lit(" Years"))),
        _row("Three", "cells", "here"),
        F.lit("</table></div><table><tr><td>Outside</td><td>no</td></tr></table>"),
    )
    vedant_specs = F.concat(
        F.lit('<table class="MsoNormalTable">'),
        _row("Specification", "heading"),
        _row("Cores:", F.col("cores"), "note"),
        _row("Memory Type:", F.col("memory_type")),
        F.when(item % 4 == 1, _row("Category:", "Hardware")).otherwise(F.lit("")),
        _row("Box Contents:", F.col("brand")),
        _row("", "empty"),
        F.lit("</table>"),
    )
    prime_specs = F.concat(
        F.lit('<table class="shop woocommerce-product-attributes">'),
        _row("Speed", F.col("speed"), tag="th"),
        _row("Memory Type", F.col("memory_type"), tag="th"),
        F.lit("</table>"),
    )
    highlights = F.concat(
        F.lit('<div class="woocommerce-product-details__short-description"><div><ul><li>'),
        F.coalesce(F.col("cores"), F.lit("")),
        F.lit("</li><li> "),
        F.col("speed"),
        F.lit(" &gt; 1</li></ul></div></div><div>after</div>"),
    )
    specs = (
        F.when(source == "MD Computers", md_specs)
        .when(source == "Vedant", vedant_specs)
        .when(F.col("category") == "monitor", prime_specs)
        .otherwise(highlights)
    )
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><script>var t = '<h1>no</h1>';</script></head><body><!-- <h1>no</h1> -->"),
        F.coalesce(F.concat(F.lit('<h1 class="title"> '), F.col("name"), F.lit(" <b>&amp; box</b></h1>")), F.lit("")),
        F.coalesce(price_html, F.lit("")),
        specs,
        F.lit("</body></html>"),
    )
    return catalogue.select(item.alias("page_id"), "url", "source", "category", html.alias("html"))


def listing_pages(catalogue: DataFrame) -> DataFrame:
    """A listing page per site, category and block of item ids."""
    source, monitor = F.col("source"), F.col("category") == "monitor"
    link = F.concat(
        F.lit('<a class="x" href="'),
        F.col("url"),
        F.lit('?a=1&amp;b=2">'),
        F.coalesce(F.col("name"), F.lit("")),
        F.lit("</a>"),
    )
    entry = (
        F.when(
            source == "MD Computers",
            F.concat(F.lit('<h3 class="product-entities-title">'), link, F.lit('<a href="/cart">buy</a></h3>')),
        )
        .when(source == "Vedant", F.concat(F.lit('<div class="name">'), link, F.lit("</div>")))
        .when(monitor, F.concat(F.lit('<div class="product-name">'), link, F.lit("</div>")))
        .otherwise(F.concat(F.lit('<h3 class="product-title">'), link, F.lit("</h3>")))
    )
    block = F.floor(F.col("item_id") / LISTING_BLOCK)
    entries = catalogue.select("source", "category", block.alias("page_id"), "item_id", entry.alias("entry"))
    grouped = entries.groupBy("page_id", "source", "category").agg(
        F.sort_array(F.collect_list(F.struct("item_id", "entry"))).alias("entries")
    )
    body = F.array_join(F.transform("entries", lambda e: e["entry"]), "\n")
    html = F.concat(F.lit("<html><body><a href='/home'>home</a>"), body, F.lit("</body></html>"))
    return grouped.select("page_id", "source", "category", html.alias("html"))
