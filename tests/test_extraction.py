from __future__ import annotations

import pytest

from siliscope.plans import extraction as X
from siliscope.sources.derived import derived_catalogue, listing_pages, product_pages

MD_PAGE = """<html><h1> Intel Core i5 <b>14400F</b></h1><span class="price-old">&#8377;20,000</span>
<span class="price-new big">&#8377;15,499.50</span><div class="tab-pane" id="tab-specification"><div><table>
<tr><td colspan="2">General</td></tr><tr><td>Cores </td><td>10 Cores</td></tr><tr><td> Clock Speed</td><td><p>4.7 GHz</p></td></tr>
<tr><td>a</td><td>b</td><td>c</td></tr><tr><td>cores</td><td>12 &amp; more</td></tr><tr><td>Brand</td><td>INTEL</td></tr>
</table></div></div><table><tr><td>outside</td><td>x</td></tr></table></html>"""
PRIME_PRICE = """<p class="price"><del><span class="woocommerce-Price-amount amount"><bdi><span>&#8377;</span>9,000.00</bdi></span></del>
<ins><span class="woocommerce-Price-amount amount"><bdi><span>&#8377;</span>8,000.00</bdi></span></ins></p>"""
PRIME_SPECS = """<table class="woocommerce-product-attributes shop_attributes"><tr><th>Panel Type</th><td><p>IPS</p></td></tr>
<tr><th>only head</th></tr><tr><td>only cell</td></tr></table>"""
VEDANT_SPECS = """<table class="MsoNormalTable" border=0><tr><td>Specification</td><td>Details</td></tr>
<tr><td>Refresh Rate:</td><td>75 Hz</td><td>note</td></tr><tr><td> </td><td>nothing</td></tr><tr><td>one</td></tr></table>"""
SHORT = '<div class="woocommerce-product-details__short-description"><div><ul><li> 24 inch </li><li>75Hz &lt;fast&gt;</li></ul></div></div><div>more</div>'

CASES = {
    "md": (MD_PAGE, X.MD, "cpu"),
    "md list price": ('<h1>GeForce</h1><ul class="list-unstyled"><li>Price</li><li>₹1,200</li></ul>', X.MD, "gpu"),
    "md nothing": ("<p>gone</p>", X.MD, "laptop"),
    "md unclosed rows": ('<h1>x</h1><div id="tab-specification"><table><tr><td>A<td>1<tr><td>B</td><td>2</table></div>', X.MD, "ram"),
    "rs": ('<h1>SO-DIMM 8GB</h1><span class="price-new">Rs. 12,345</span>', X.MD, "ram"),
    "vedant": (f'<h1>Mon</h1><span class="price-new">₹12,345.00</span>{VEDANT_SPECS}', X.VEDANT, "monitor"),
    "vedant list": ('<h1>Mon</h1><ul class="list-unstyled"><li>5</li></ul>', X.VEDANT, "monitor"),
    "prime monitor": (f"<h1>Mon</h1>{PRIME_PRICE}{PRIME_SPECS}{SHORT}", X.PRIME, "monitor"),
    "prime laptop": (f"<h1>Lap</h1>{PRIME_PRICE}{PRIME_SPECS}{SHORT}", X.PRIME, "laptop"),
    "prime no ins": (PRIME_PRICE.replace("ins>", "b>"), X.PRIME, "monitor"),
    "combo": ("<h1>Ryzen + Motherboard</h1>", X.PRIME, "cpu"),
    "combo kept": ("<h1>Laptop combo</h1>", X.PRIME, "laptop"),
}


@pytest.fixture(scope="module")
def records(spark):
    pages = spark.createDataFrame(
        [(i, key, site, category, html) for i, (key, (html, site, category)) in enumerate(CASES.items())],
        "page_id long, url string, source string, category string, html string",
    )
    return {r["url"]: r for r in X.extract_products(pages).collect()}


def test_md_page(records):
    r = records["md"]
    assert (r["name"], r["price_inr"], r["source"], r["category"]) == ("Intel Core i514400F", 15499, X.MD, "cpu")
    assert r["specs"] == {"cores": "12 & more", "clock_speed": "4.7 GHz", "brand": "INTEL"}
    assert r["brand"] == "INTEL"


def test_md_fallbacks(records):
    assert (records["md list price"]["price_inr"], records["md list price"]["brand"]) == (1200, "Nvidia")
    r = records["md nothing"]
    assert (r["name"], r["price_inr"], r["specs"], r["brand"], r["form_factor"]) == ("N/A", 0, {}, None, None)
    assert records["md unclosed rows"]["specs"] == {"a": "1", "b": "2"}


def test_price_with_an_early_point_is_zero(records):
    assert records["rs"]["price_inr"] == 0
    assert records["rs"]["form_factor"] == "laptop"


def test_vedant_page(records):
    assert records["vedant"]["price_inr"] == 12345
    assert records["vedant"]["specs"] == {"refresh_rate": "75 Hz"}
    assert records["vedant list"]["price_inr"] == 0


def test_prime_pages(records):
    monitor, laptop = records["prime monitor"], records["prime laptop"]
    assert (monitor["price_inr"], monitor["specs"], monitor["highlights"]) == (8000, {"panel_type": "IPS"}, None)
    assert (laptop["price_inr"], laptop["specs"], laptop["highlights"]) == (9000, {}, "24 inch | 75Hz <fast>")
    assert records["prime no ins"]["price_inr"] == 9000


def test_combos_are_left_out_for_cpu_and_gpu_only(records):
    assert "combo" not in records and "combo kept" in records


def test_specs_to_columns(spark):
    pages = spark.createDataFrame([(1, "u", X.MD, "cpu", MD_PAGE)], "page_id long, url string, source string, category string, html string")
    wide = X.specs_to_columns(X.extract_products(pages), ["cores", "tdp", "brand"]).first()
    assert (wide["cores"], wide["tdp"], wide["brand"]) == ("12 & more", None, "INTEL")
    census = X.spec_key_census(X.extract_products(pages)).collect()
    assert {(r["spec_key"], r["n_records"]) for r in census} == {("cores", 1), ("clock_speed", 1), ("brand", 1)}


def _listing(spark, site, category, body):
    df = spark.createDataFrame([(1, site, category, body)], "page_id long, source string, category string, html string")
    return [(r["position"], r["href"], r["text"]) for r in X.listing_links(df, X.LINK_CAPS, X.UNCAPPED_LINKS).orderBy("position").collect()]


def test_md_links_first_anchor_and_cap_after_combos(spark):
    entry = '<h3 class="product-entities-title"><a name="x">no</a><a href="/{0}">{1}</a><a href="/cart">buy</a></h3>'
    body = "".join(entry.format(i, "CPU combo" if i % 2 else f"CPU {i}") for i in range(60))
    links = _listing(spark, X.MD, "cpu", "<a href='/home'>home</a>" + body)
    assert len(links) == 20 and links[19] == (19, "/38", "CPU 38")
    assert len(_listing(spark, X.MD, "laptop", body)) == 30


def test_prime_links(spark):
    body = "".join(f"<h3 class='product-title'><a href='/{i}'>n{i}</a></h3>" for i in range(45))
    assert len(_listing(spark, X.PRIME, "gpu", body)) == 45
    assert len(_listing(spark, X.PRIME, "ram", body)) == 30
    fallback = '<div class="product-name"><a href="/a">A</a></div>'
    assert _listing(spark, X.PRIME, "monitor", fallback) == [(0, "/a", "A")]
    assert _listing(spark, X.PRIME, "laptop", fallback) == []


def test_vedant_links(spark):
    body = '<div class="name"><div>x</div><a href="/1">One</a><a>none</a><a href="/2">Two</a></div><div class="names"><a href="/3">3</a></div>'
    assert [x[1] for x in _listing(spark, X.VEDANT, "monitor", body)] == ["/1", "/2"]


def test_extraction_stays_in_the_jvm_and_does_not_shuffle(spark, part):
    pages = product_pages(derived_catalogue(part))
    text = X.extract_products(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text
    links = X.listing_links(listing_pages(derived_catalogue(part)), X.LINK_CAPS, X.UNCAPPED_LINKS)
    assert "Python" not in links._jdf.queryExecution().executedPlan().toString()
