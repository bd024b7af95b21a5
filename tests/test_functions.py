from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siliscope.functions import html as H
from siliscope.functions import products as P
from siliscope.functions.geo import haversine
from siliscope.functions.keys import surrogate_key
from siliscope.functions.numeric import safe_add, safe_divide, safe_subtract, width_bucket
from siliscope.functions.text import clean_price, first_float, first_int, normalize_spec_key, slugify, slugify_name
from siliscope.functions.url import url_host, url_parameter, url_path


def one(spark, schema, values, column):
    """The column's value for each given input row."""
    numbered = [(i, *v) for i, v in enumerate(values)]
    df = spark.createDataFrame(numbered, f"_i int, {schema}")
    return [r[0] for r in df.orderBy("_i").select(column).collect()]


def test_clean_price(spark):
    texts = ["₹12,345.00", "Rs. 12,345", "  1 200 ", "", None, "call us", "9" * 30, "0"]
    assert one(spark, "t string", [(t,) for t in texts], clean_price(F.col("t"))) == [12345, 0, 1200, 0, 0, 0, None, 0]


def test_normalize_spec_key(spark):
    texts = [(" Memory Type ",), ("Cores :",), ("TDP",)]
    assert one(spark, "t string", texts, normalize_spec_key(F.col("t"))) == ["memory_type", "cores_:", "tdp"]
    assert one(spark, "t string", texts, normalize_spec_key(F.col("t"), True)) == ["memory_type", "cores_", "tdp"]


SLUGS = {"": "", None: "", "!Hell0 world-hi": "hell0_world_hi", "0Hell0 world-hi": "_0hell0_world_hi", "a -  b": "a_b", "é": ""}


def test_slugify(spark):
    assert one(spark, "t string", [(t,) for t in SLUGS], slugify(F.col("t"))) == list(SLUGS.values())
    assert [slugify_name(t) for t in SLUGS] == list(SLUGS.values())


def test_numbers_in_text(spark):
    texts = [("6 Cores",), ("n/a",), (None,), ("99999999999 x",)]
    assert one(spark, "t string", texts, first_int(F.col("t"))) == [6, None, None, None]
    assert one(spark, "t string", [("4.5GHz",), ("5. x",), ("-",)], first_float(F.col("t"))) == [4.5, 5.0, None]


def test_brands(spark):
    names = ["Intel Core i5", "AMD Ryzen", "core i7 with AMD", "Athlon", "Arm", None]
    assert one(spark, "t string", [(n,) for n in names], P.detect_brand_cpu(F.col("t"))) == [
        "Intel", "AMD", "Intel", "AMD", "Unknown", "Unknown",
    ]
    names = ["GeForce", "Radeon RX 7900", "RX7900", "Arc A770", "arcade", "GTX AMD", "Iris"]
    assert one(spark, "t string", [(n,) for n in names], P.detect_brand_gpu(F.col("t"))) == [
        "Nvidia", "AMD", "Unknown", "Intel", "Unknown", "Nvidia", "Intel",
    ]


def test_form_factor_and_combo(spark):
    names = [("Kit SO-DIMM",), ("DDR5 Laptop",), ("DDR5",)]
    assert one(spark, "t string", names, P.ram_form_factor(F.col("t"))) == ["laptop", "laptop", "desktop"]
    pairs = [("CPU + Motherboard", "cpu"), ("CPU + PSU", "cpu"), ("Card + PSU", "gpu"), ("Combo", "ram"), ("Kit with fan", "gpu"), (None, "cpu")]
    assert one(spark, "t string, c string", pairs, P.is_combo(F.col("t"), F.col("c"))) == [True, False, True, False, True, False]


def test_extract_gen(spark):
    names = [("i7-13700K",), ("Ryzen 9 7950X",), ("RTX 50",), (None,), ("5600MHz",), ("0012",)]
    assert one(spark, "t string", names, P.extract_gen(F.col("t"))) == [13, 79, 10, 10, 56, 0]


@pytest.mark.parametrize(
    "url,host,path",
    [
        ("https://a.example/b/c?x=1", "a.example", "b/c"),
        ("http://a.example?x=1", "a.example", ""),
        ("android-app://a.example/b", "a.example", "/a.example/b"),
        ("a.example", "a.example", "a.example"),
        ("?x=1", "", ""),
        ("https://a.example/", "a.example", ""),
    ],
)
def test_url_host_and_path(spark, url, host, path):
    assert one(spark, "u string", [(url,)], F.struct(url_host(F.col("u")), url_path(F.col("u")))) == [(host, path)]


def test_url_parameter(spark):
    urls = [("http://a/?utm_medium=mail&utm_source=x",), ("http://a/?utm_medium=&y=1",), ("http://a/",), (None,)]
    assert one(spark, "u string", urls, url_parameter(F.col("u"), "utm_medium")) == ["mail", None, None, None]


def test_surrogate_key_tells_null_from_empty(spark):
    rows = [("a", ""), ("a", None)]
    first, second = one(spark, "a string, b string", rows, surrogate_key([F.col("a"), F.col("b")]))
    assert first != second
    first, second = one(spark, "a string, b string", rows, surrogate_key([F.col("a"), F.col("b")], nulls_as_empty=True))
    assert first == second


def test_safe_arithmetic(spark):
    rows = [(1, None, 3), (None, None, None)]
    fields = [F.col("a"), F.col("b"), F.col("c")]
    assert one(spark, "a int, b int, c int", rows, safe_add(fields)) == [4, 0]
    assert one(spark, "a int, b int, c int", rows, safe_subtract(fields)) == [-2, 0]
    assert one(spark, "a int, b int", [(6, 4), (6, 0), (None, 2), (6, None)], safe_divide(F.col("a"), F.col("b"))) == [1.5, None, None, None]
    with pytest.raises(TypeError):
        safe_subtract("a")


def test_width_bucket_ties(spark):
    values = [(0.5,), (2.0,), (9.0,), (11.0,), (12.0,), (None,)]
    column = width_bucket(F.col("x"), 0.0, 10.0, 5)
    assert one(spark, "x double", values, column) == [1, 2, 5, 6, 7, 6]
    native = width_bucket(F.col("x"), 0.0, 10.0, 5, native=True)
    assert one(spark, "x double", values, native) == [1, 2, 5, 6, 6, None]


def test_haversine(spark):
    places = [(48.864716, 2.349014, 52.379189, 4.899431)]
    columns = [F.col(c) for c in ("a", "b", "c", "d")]
    schema = "a double, b double, c double, d double"
    miles, km = (one(spark, schema, places, haversine(*columns, unit=u))[0] for u in ("mi", "km"))
    assert round(miles) == 267 and math.isclose(km, miles * 1.60934)
    with pytest.raises(ValueError):
        haversine(*columns, unit="ft")


# --- HTML ---


def texts(spark, html, column):
    return one(spark, "html string", [(html,)], F.expr(column))[0]


def test_first_inner_counts_nested_tags(spark):
    html = '<div id="x"><div>a<div>b</div></div>c</div><div>d</div>'
    assert texts(spark, html, H.first_inner("html", "div", H.has_id("x"))) == "<div>a<div>b</div></div>c"
    assert texts(spark, html, H.first_inner("html", "div", H.has_id("y"))) is None
    assert texts(spark, "<div id=x>never <div>closed", H.first_inner("html", "div", H.has_id("x"))) == "never <div>closed"
    assert texts(spark, "<DIV CLASS='a b-c'></DIV>", H.first_inner("html", "div", H.has_class("a"))) == ""
    assert texts(spark, "<div class='a b-c'></div>", H.first_inner("html", "div", H.has_class("b"))) is None


def test_text_of_strips_each_node_and_decodes(spark):
    html = "\n A &amp; <b> B&nbsp;</b> &#8377;&#x20B9; &bogus; <i>  </i>c"
    assert texts(spark, html, H.text_of("html")) == "A &B₹₹ &bogus;c"
    assert texts(spark, html, H.text_of("html", " | ")) == "A & | B | ₹₹ &bogus; | c"


def test_scripts_and_comments_are_not_seen(spark):
    html = "<script>var a='<h1>no</h1>'</script><!-- <h1>no</h1> --><style>h1{}</style><h1 title='a>b'>yes</h1><h1>later</h1>"
    assert texts(spark, html, H.text_of(H.first_inner(H.visible("html"), "h1"))) == "yes"


def test_anchors(spark):
    html = """<a name=x>no</a><a class="l" href="/a?b=1&amp;c=2">One <b>two</b></a><a href='/c'></a><A HREF=/d>D</A>"""
    found = texts(spark, html, H.anchors("html"))
    assert [tuple(x) for x in found] == [("/a?b=1&c=2", "Onetwo"), ("/c", ""), ("/d", "D")]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="<&\r\x00", exclude_categories=("Cs", "Cc", "Zs", "Zl", "Zp", "Cf")), min_size=1), max_size=20))
def test_decode_entities_round_trip(spark, words):
    import html as stdlib

    coded = ["".join(f"&#{ord(c)};" if i % 2 else stdlib.escape(c) for i, c in enumerate(w)) for w in words]
    if words:
        assert one(spark, "t string", [(c,) for c in coded], F.expr(H.decode_entities("t"))) == words


def test_texts_are_split_without_a_pattern_per_row(spark):
    """A mark stands for the tags; a text that holds the mark itself, one without tags, and none at all stay right."""
    rows = [("a<b>b</b> c",), ("a\x01<i>b\x01c</i>",), ("plain",), ("",), (None,), ("<p></p>",)]
    df = spark.createDataFrame(rows, "h string")
    found = [r[0] for r in df.select(F.expr(H.text_of("h", "|"))).collect()]
    assert found == ["a|b|c", "a\x01|b\x01c", "plain", "", None, ""]
    nested = spark.createDataFrame([("<div id='x'>\x01<div>a</div>b</div>c",), ("<div id='x'><div>a</div>b</div>c",)], "h string")
    assert [r[0] for r in nested.select(F.expr(H.first_inner("h", "div", H.has_id("x")))).collect()] == ["\x01<div>a</div>b", "<div>a</div>b"]
    assert "IF(contains(f, chr(1))" in H.text_of("h")
