"""Queries of the text operators against their SQL, on the given tables and on awkward rows."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

from check_queries import compare, connect  # noqa: E402

from siliscope.llm import licenses, mixing, quality_rules, queries, warc_store  # noqa: E402
from siliscope.llm.common import scratch_path  # noqa: E402

LINE = "This is a line of words that goes on for a while, and it ends as a sentence does. "
OTHER = " ".join(f"Sentence {i} has the words w{i} and v{i}." for i in range(20))  # no three words come twice
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t\n", None, None), (4, "one", "en", None), (4, "one", "en", None),
    (5, LINE * 400, "en", "b"), (6, LINE * 400, "en", "b"), (None, "Released under the MIT License.\n" + LINE * 5, "en", "a"),
    (7, "a | b | c | d |\nHome\n" + OTHER, "de", "c"), (8, "ä é 文 \x00 mot! " * 30, "fr", "c"), (9, "word " * 300, "en", "b"),
    (10, "Licensed\nunder the Apache License,\nVersion 2.0.\n\n" + "All rights reserved.\n" * 3 + LINE, "en", "a"),
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Awkward documents with columns whose names the operators use themselves."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("size", F.lit(1)).withColumn("row", F.lit("x")).withColumn("shard", F.lit(0))
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    df.write.parquet(path)
    return spark.read.parquet(path), path


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_matches_sql(spark, data, name):
    assert compare(queries.QUERIES[name](spark, data).toArrow(), connect(data).execute(queries.ORACLE_SQL[name]).to_arrow_table()) is None


@pytest.mark.parametrize(
    "run,sql",
    [
        (licenses.license_scan, licenses.LICENSE_SQL),
        (mixing.mix_report, mixing.MIX_SQL),
        (quality_rules.quality_report, quality_rules.QUALITY_SQL),
    ],
    ids=["licences", "mix", "quality"],
)
def test_awkward_rows_match_sql(odd, run, sql):
    documents, path = odd
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert compare(run(documents).toArrow(), con.execute(sql).to_arrow_table()) is None
    assert run(documents.limit(0)).count() == 0


def test_mix_emits_whole_rows(odd):
    documents, _ = odd
    mixed = mixing.mix(documents)
    assert mixed.columns == documents.columns
    report = mixing.mix_report(documents).collect()
    emitted = {(r.doc_id, r.text or "") for r in mixed.collect()}
    assert sum(r.taken for r in report) > 0
    assert {r.doc_id for r in report if r.taken and r.doc_id} <= {doc for doc, _ in emitted}
    words = sum(len((r.text or "").split()) for r in mixed.collect())
    assert words == sum(r.taken for r in report)


def test_quality_keeps_columns_and_drops_bad_lines(odd):
    documents, _ = odd
    kept = quality_rules.quality_clean(documents)
    assert kept.columns == documents.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert "Home" not in texts[7] and "a | b" not in texts[7] and 9 not in texts and 1 not in texts


def test_archive_round_trip(spark):
    rows = [(3, "http://x/a b", "<p>é</p>"), (1, None, "<p>é</p>"), (7, "u", None), (5, "u", ""), (9, "u", "z\r\n" * 9), (9, "u", "z\r\n" * 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("sha256", F.lit(2))
    folder = scratch_path(spark, "test-archive")
    warc_store.write_archive(pages, folder)
    archive = warc_store.read_archive(spark, folder)
    assert spark.read.parquet(f"{folder}/payloads").count() == 3
    report = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc_store.archive_report(archive).collect()}
    assert report == {(1, "response", None, 9), (3, "revisit", 1, 9), (5, "response", None, 0), (7, "revisit", 5, 0), (9, "response", None, 27)}
    records = [bytes(r.record) for r in warc_store.warc_records(archive).collect()]
    assert all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
    for record in records:  # the length field tells where the block ends
        head, _, rest = record.partition(b"\r\n\r\n")
        length = int(head.split(b"\r\nContent-Length: ")[1].split(b"\r\n")[0])
        assert rest[length:] == b"\r\n\r\n"
    warc_store.write_archive(pages, folder + "-9", min_bytes=10)
    assert warc_store.archive_report(warc_store.read_archive(spark, folder + "-9")).filter("record_type = 'revisit'").count() == 0
    warc_store.write_archive(pages.limit(0), folder + "-0")
    assert warc_store.read_archive(spark, folder + "-0").count() == 0


def test_damaged_payload_is_noticed(spark):
    folder = scratch_path(spark, "test-damaged")
    warc_store.write_archive(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"), folder)
    payloads = spark.read.parquet(f"{folder}/payloads").withColumn("payload", F.lit(b"abd"))
    payloads.write.parquet(f"{folder}-bad/payloads")
    spark.read.parquet(f"{folder}/records").write.parquet(f"{folder}-bad/records")
    with pytest.raises(Exception, match="damaged"):
        warc_store.archive_report(warc_store.read_archive(spark, f"{folder}-bad")).collect()
