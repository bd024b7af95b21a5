"""A content-addressed web archive.

Payload bytes are stored once under their SHA-256; the exact head of every record (WARC and HTTP header, byte for byte)
is stored apart with the digest of its payload. A join of the two gives back the records as they would stand in a WARC
file, and every payload is checked against its digest and length when it is read.

Of records with equal payloads of at least ``min_bytes`` the one with the smallest page id is a response, the others are
revisits that refer to it; records with smaller payloads are all responses. A NULL page is an empty payload. NULL ids
come after all others; rows that repeat the smallest id are responses as well. A NULL url leaves its field out. Further columns are not archived.
An empty table gives an empty archive.

Equal payloads are brought together before the shuffle, so a payload that fills a third of the table is one row per task;
what is shuffled for the heads is digests and ids only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_of_hex(digest: Column, chars: int = 40) -> Column:
    """Base 32 of a hexadecimal digest: five hexadecimal digits are four letters."""
    letters = []
    for start in range(1, chars + 1, 5):
        value = F.conv(F.substring(digest, start, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(BASE32), place, 1))
    return F.concat(*letters)


def _field(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _record_id(page_id: Column) -> Column:
    digest = F.md5(page_id.cast("string").cast("binary"))
    parts = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(page_id.isNotNull(), F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")))


def _digests(pages: DataFrame) -> DataFrame:
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select("page_id", "url", payload.alias("payload")).select(
        "page_id", "url", "payload", F.sha2("payload", 256).alias("sha256")
    )


def _roles(digested: DataFrame, min_bytes: int) -> DataFrame:
    """Every record with the response its payload refers to, NULL for a response itself."""
    facts = digested.select(
        "page_id", "url", "sha256", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("payload_bytes")
    )
    firsts = digested.groupBy("sha256").agg(F.min("page_id").alias("first_page"))
    first = F.when((F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_page")), F.col("first_page"))
    return facts.join(firsts, "sha256").withColumn("refers_to", first).drop("first_page")


def _heads(roles: DataFrame, date: str) -> DataFrame:
    """The head of every record: WARC fields, an empty line, HTTP fields, an empty line."""
    revisit = F.col("refers_to").isNotNull()
    size = F.col("payload_bytes").cast("string")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size, F.lit(CRLF + CRLF)
    )
    http_bytes = F.octet_length(http).cast("long")
    block = F.when(revisit, http_bytes).otherwise(http_bytes + F.col("payload_bytes"))
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    warc = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _record_id(F.coalesce(F.col("page_id").cast("string"), F.lit("")))),
        _field("WARC-Page-ID", F.col("page_id").cast("string")),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", url),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1")))),
        _field("WARC-Refers-To", _record_id(F.col("refers_to"))),
        _field("WARC-Refers-To-Page-ID", F.col("refers_to").cast("string")),
        _field("WARC-Profile", F.when(revisit, PROFILE)),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        _field("Content-Length", block.cast("string")),
        F.lit(CRLF),
    )
    return roles.select(F.encode(F.concat(warc, http), "UTF-8").alias("head"), "sha256", "payload_bytes")


def write_archive(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, date: str = DATE) -> None:
    """Write ``folder``/payloads (sha256, payload) and ``folder``/records (head, sha256, payload_bytes)."""
    digested = _digests(pages)
    payloads = digested.groupBy("sha256").agg(F.first("payload").alias("payload"))
    payloads.write.option("compression", "zstd").parquet(f"{folder}/payloads")
    _heads(_roles(digested, min_bytes), date).write.option("compression", "zstd").parquet(f"{folder}/records")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """head, payload of every record. A payload that does not match its digest or length stops the job."""
    records = spark.read.parquet(f"{folder}/records")
    payloads = spark.read.parquet(f"{folder}/payloads")
    joined = records.join(payloads, "sha256", "left")
    sound = (F.sha2("payload", 256) == F.col("sha256")) & (F.octet_length("payload") == F.col("payload_bytes"))
    checked = F.when(sound, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged or missing payload "), F.col("sha256"))).cast("binary")
    )
    return joined.select("head", checked.alias("payload"))


def head_field(name: str) -> Column:
    """A field of the WARC part of a head, NULL if it is not there."""
    found = F.regexp_extract(F.decode("head", "UTF-8"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def warc_records(archive: DataFrame) -> DataFrame:
    """The bytes of every record as they stand in a WARC file."""
    body = F.when(head_field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return archive.select(F.concat("head", body, F.lit((CRLF + CRLF).encode())).alias("record"))


def archive_report(archive: DataFrame) -> DataFrame:
    """One row per record, from its head and its payload."""
    return archive.select(
        head_field("WARC-Page-ID").cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
        head_field("WARC-Type").alias("record_type"),
        head_field("WARC-Refers-To-Page-ID").cast("long").alias("refers_to"),
    )


ARCHIVE_SQL = f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(encode(coalesce(html, ''))) AS h FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_page FROM payloads)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}',
    ((('0x' || substr(h, (5 * (i // 4) + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4)))::BIGINT & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM firsts
"""
