"""Product pages and listing pages to records, as one column pipeline without a shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.products import detect_brand_cpu, detect_brand_gpu, is_combo, ram_form_factor
from ..functions.text import clean_price, normalize_spec_key

# Site names, the marks of their page parts, and how many links a listing gives.
MD, VEDANT, PRIME = "MD Computers", "Vedant", "PrimeABGB"
MISSING_NAME, MISSING_PRICE = "N/A", "0"
NEW_PRICE_CLASS = "price-new"
LIST_CLASS = "list-unstyled"
PRICE_BLOCK_CLASS = "price"
AMOUNT_CLASS = "woocommerce-Price-amount"
SPEC_TAB_ID = "tab-specification"
VEDANT_SPEC_CLASS = "MsoNormalTable"
PRIME_SPEC_CLASS = "woocommerce-product-attributes"
SPEC_HEADING = "specification"
HIGHLIGHTS_CLASS = "woocommerce-product-details__short-description"
HIGHLIGHTS_SEPARATOR = " | "
MD_LINK_CLASS, PRIME_LINK_CLASS, PRIME_LINK_FALLBACK, VEDANT_LINK_CLASS = (
    "product-entities-title",
    "product-title",
    "product-name",
    "name",
)
LINK_CAPS = {"cpu": 20, "gpu": 20, "monitor": 20, "laptop": 30, "ram": 30}
UNCAPPED_LINKS = [(PRIME, "cpu"), (PRIME, "gpu")]
# End of fixed values.

# Base columns that a row of the page's own specification table replaces.
OVERRIDABLE = ["name", "url", "source", "category", "brand", "form_factor"]


# Each step below is its own projection, so that a fragment used twice is cut out of the page once.
_MONITOR = "category = 'monitor'"


def _per_site(md: str, vedant: str, prime: str) -> str:
    return f"CASE source WHEN {H.literal(MD)} THEN {md} WHEN {H.literal(VEDANT)} THEN {vedant} ELSE {prime} END"


def _visible(pages: DataFrame) -> DataFrame:
    return pages.withColumn("html", F.expr(H.visible("html")))


def _with_name(pages: DataFrame) -> DataFrame:
    heading = F.expr(H.text_of(H.first_inner("html", "h1")))
    return pages.withColumn("name", F.coalesce(heading, F.lit(MISSING_NAME)))


def _with_price_text(pages: DataFrame) -> DataFrame:
    """Text of the price element of the site, after its fallbacks."""
    new_price = H.first_inner("html", "span", H.has_class(NEW_PRICE_CLASS))
    price_list = H.first_inner("html", "ul", H.has_class(LIST_CLASS))
    priced = H.first_inner("html", "p", H.has_class(PRICE_BLOCK_CLASS))
    reduced = H.first_inner(H.first_inner("_block", "ins"), "span", H.has_class(AMOUNT_CLASS))
    amount = H.first_inner("_block", "span", H.has_class(AMOUNT_CLASS))
    block = _per_site(f"coalesce({new_price}, {price_list})", new_price, priced)
    price = _per_site("_block", "_block", f"coalesce(IF({_MONITOR}, {reduced}, NULL), {amount})")
    return (
        pages.withColumn("_block", F.expr(block))
        .withColumn("_price", F.expr(price))
        .withColumn("price_text", F.coalesce(F.expr(H.text_of("_price")), F.lit(MISSING_PRICE)))
        .drop("_block", "_price")
    )


def _with_highlights(pages: DataFrame) -> DataFrame:
    """Texts of the short description joined by a bar, NULL without one."""
    described = (F.col("source") == PRIME) & ~F.expr(_MONITOR)
    short = F.expr(H.first_inner("html", "div", H.has_class(HIGHLIGHTS_CLASS)))
    texts = F.expr(H.text_of("_short", HIGHLIGHTS_SEPARATOR))
    return pages.withColumn("_short", F.when(described, short)).withColumn("highlights", texts).drop("_short")


def _with_specs(pages: DataFrame) -> DataFrame:
    """Specification rows of the page as map key -> value, the last of equal keys; empty without any."""
    table = _per_site(
        H.first_inner("html", "div", H.has_id(SPEC_TAB_ID)),
        H.first_inner("html", "table", H.has_class(VEDANT_SPEC_CLASS)),
        f"IF({_MONITOR}, {H.first_inner('html', 'table', H.has_class(PRIME_SPEC_CLASS))}, NULL)",
    )
    rows = H.flat_elements("coalesce(_table, '')", "tr")
    cells = f"transform({rows}, r -> named_struct('th', {H.flat_elements('r', 'th')}, 'td', {H.flat_elements('r', 'td')}))"
    fits = _per_site("size(r.td) = 2", "size(r.td) >= 2", "size(r.td) >= 1 AND size(r.th) >= 1")
    key, value = _per_site("get(r.td, 0)", "get(r.td, 0)", "get(r.th, 0)"), _per_site("get(r.td, 1)", "get(r.td, 1)", "get(r.td, 0)")
    texts = f"""transform(transform(filter(_cells, r -> {fits}), r -> array({key}, {value})),
      r -> transform(r, x -> {H.text_of("x")}))"""

    def pair(row: Column) -> Column:
        plain, vedant = (normalize_spec_key(row[0], drop_colon=drop) for drop in (False, True))
        return F.struct(F.when(F.col("source") == VEDANT, vedant).otherwise(plain).alias("key"), row[1].alias("value"))

    def named(p: Column) -> Column:
        return (F.col("source") != VEDANT) | ((p["key"] != "") & (p["key"] != SPEC_HEADING))

    # Of the rows in order of key and place, the last of each key.
    ranked = "array_sort(transform(_pairs, (p, i) -> named_struct('key', p.key, 'place', i, 'value', p.value)))"
    ends = "filter(_ranked, (p, i) -> i + 1 = size(_ranked) OR NOT (get(_ranked, i + 1).key <=> p.key))"
    last = f"transform({ends}, p -> named_struct('key', p.key, 'value', p.value))"
    return (
        pages.withColumn("_table", F.expr(table))
        .withColumn("_cells", F.expr(cells))
        .withColumn("_texts", F.expr(texts))
        .withColumn("_pairs", F.filter(F.transform("_texts", pair), named))
        .withColumn("_ranked", F.expr(ranked))
        .withColumn("specs", F.map_from_entries(F.expr(last)))
        .drop("_table", "_cells", "_texts", "_pairs", "_ranked")
    )


def extract_name(pages: DataFrame) -> DataFrame:
    """pages(page_id, html) to (page_id, name): the text of the first h1."""
    return _with_name(_visible(pages)).select("page_id", "name")


def extract_price_text(pages: DataFrame) -> DataFrame:
    return _with_price_text(_visible(pages)).select("page_id", "price_text")


def extract_specs(pages: DataFrame) -> DataFrame:
    return _with_specs(_visible(pages)).select("page_id", "specs")


def extract_highlights(pages: DataFrame) -> DataFrame:
    return _with_highlights(_visible(pages)).select("page_id", "highlights")


def parsed_pages(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, source, category, html) with name, price text, highlights and specs."""
    parsed = _with_specs(_with_highlights(_with_price_text(_with_name(_visible(pages)))))
    return parsed.select("page_id", "url", "source", "category", "name", "price_text", "highlights", "specs")


def combo_filter(records: DataFrame, name: str = "name") -> DataFrame:
    """Leave out bundles by the word list of the record's category."""
    return records.filter(~is_combo(F.col(name), F.col("category")))


def _judged_once(rows: DataFrame, condition: Column) -> DataFrame:
    """A filter on extracted columns: as a plain one it would move below the extraction and repeat it."""
    kept = F.when(condition, F.array(F.struct(F.lit(True).alias("_there"), "*")))
    # The outer form, as Spark tests the array of the plain one in a filter, which moves down again.
    return rows.select(F.inline_outer(kept)).filter("_there").drop("_there")


def base_record(parsed: DataFrame) -> DataFrame:
    """Bronze records: bundles are left out, and a specification row replaces a base column of the same name.

    ``resource`` is the category of the crawl; no row of a page changes it.
    """
    name, category = F.col("name"), F.col("category")
    base = {
        "name": name,
        "url": F.col("url"),
        "source": F.col("source"),
        "category": category,
        "brand": F.when(category == "cpu", detect_brand_cpu(name)).when(category == "gpu", detect_brand_gpu(name)),
        "form_factor": F.when(category == "ram", ram_form_factor(name)),
    }
    # The base columns are judged as extracted; the page's own rows come on top.
    return _judged_once(parsed, ~is_combo(name, category)).select(
        *[F.coalesce(F.element_at("specs", F.lit(c)), base[c]).alias(c) for c in OVERRIDABLE],
        clean_price(F.col("price_text")).alias("price_inr"),
        "highlights",
        "specs",
        category.alias("resource"),
    )


def extract_products(pages: DataFrame) -> DataFrame:
    """Product pages to bronze records."""
    return base_record(parsed_pages(pages))


def specs_to_columns(records: DataFrame, keys: Sequence[str], keep_map: bool = False) -> DataFrame:
    """The map as one column per requested key; a base column of that name is kept as it is.

    ``keep_map`` keeps the map beside them, with the keys that are not asked for.
    """
    missing = [k for k in keys if k not in records.columns]
    wide = records.select("*", *[F.element_at("specs", F.lit(k)).alias(k) for k in missing])
    return wide if keep_map else wide.drop("specs")


def spec_key_census(records: DataFrame) -> DataFrame:
    """How many records have each specification key."""
    keys = records.select("category", F.explode_outer(F.map_keys("specs")).alias("spec_key"))
    return keys.filter(F.col("spec_key").isNotNull()).groupBy("category", "spec_key").agg(F.count(F.lit(1)).alias("n_records"))


def _links(html: str, tag: str, condition: str = "", first_only: bool = False) -> str:
    found = f"transform({H.all_inner(html, tag, condition)}, e -> {H.anchors('e')})"
    return f"flatten({f'transform({found}, l -> slice(l, 1, 1))' if first_only else found})"


def _exploded(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    # The outer form keeps Spark from testing the whole link expression once more before the explode.
    exploded = found.select(*keys, F.posexplode_outer("links").alias("position", "link"))
    return exploded.filter(F.col("position").isNotNull()).select(
        *keys, "position", F.col("link.href").alias("href"), F.col("link.text").alias("text")
    )


def _with_links(listings: DataFrame) -> DataFrame:
    """Product links of a listing page as array of (href, text), in document order."""
    by_site = _per_site(
        _links("html", "h3", H.has_class(MD_LINK_CLASS), first_only=True),
        _links("html", "div", H.has_class(VEDANT_LINK_CLASS)),
        _links("html", "h3", H.has_class(PRIME_LINK_CLASS)),
    )
    fallback = F.expr(_links("html", "(?:div|span|li|p|h2|h4)", H.has_class(PRIME_LINK_FALLBACK)))
    without = (F.col("source") == PRIME) & F.expr(_MONITOR) & (F.size("links") == 0)
    found = listings.withColumn("links", F.expr(by_site))
    return found.withColumn("links", F.when(without, fallback).otherwise(F.col("links")))


def element_links(pages: DataFrame, tag: str) -> DataFrame:
    """(page_id, position, href, text) of the links inside each element of one kind, for pages without a site rule."""
    found = _visible(pages).select("page_id", F.expr(_links("html", tag)).alias("links"))
    return _exploded(found, ["page_id"])


def cap_links(links: Column, most: Column | int) -> Column:
    """The first links of an array; a NULL cap keeps all."""
    cap = most if isinstance(most, Column) else F.lit(most)
    return F.when(cap.isNull(), links).otherwise(F.slice(links, F.lit(1), F.coalesce(cap, F.lit(1))))


def listing_links(
    listings: DataFrame, caps: Mapping[str, int] | None = None, uncapped: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """listings(page_id, source, category, html) to (page_id, source, category, position, href, text).

    All product links by the rule of the site. ``caps`` limits the links of a listing by category, as a crawl does
    (``LINK_CAPS``), but for the ``uncapped`` pairs of source and category. Bundles are left out before a cap counts. Everything happens inside the row, before it is exploded.
    """
    source, category = F.col("source"), F.col("category")
    found = _with_links(_visible(listings))
    kept = found.withColumn("links", F.filter("links", lambda link: ~is_combo(link["text"], category)))
    if caps:
        most = F
        for site, kind in uncapped:
            most = most.when((source == site) & (category == kind), F.lit(None).cast("int"))
        for kind, cap in caps.items():
            most = most.when(category == kind, cap)
        kept = kept.withColumn("links", cap_links(F.col("links"), most.otherwise(F.lit(None).cast("int"))))
    return _exploded(kept, ["page_id", "source", "category"])
