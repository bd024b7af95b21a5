"""Quality rules, line first: lines that break a rule go, then documents that lost too much text.

Everything is a column expression; nothing leaves the row and nothing is shuffled.

* A line without a word is neutral: it is kept, and counts neither as text kept nor as text lost.
* Punctuation: a line has to hold the end of a sentence, and at most ``MAX_MARKS`` percent of it may be symbols and
  exclamation marks.
* Navigation: a line made of separators, or a short line of menu words.
* Boilerplate: a line with a phrase of notices, sign-up boxes or script errors.
* A document is rejected if it has fewer than ``MIN_WORDS`` words, if more than ``MAX_REPEATED`` percent of its words
  stand in 3-word windows found twice or more, or if less than ``MIN_KEPT`` percent of its characters in words remain.

A NULL text is an empty one: all counts 0, rejected. Repeated rows are judged one by one, an empty table gives an
empty result, and other columns pass through.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, ROW, WORD, nested, text_or_empty, unnested

MIN_WORDS = 50
MAX_REPEATED = 50
MIN_KEPT = 50
MAX_MARKS = 10

SYMBOLS = r"[#*$%&|<>]"
MARKS = r"[#*$%&|<>!]"
# The end of a sentence, perhaps with closing quotes and brackets, before a blank or the end of the line.
SENTENCE_END = r"[.!?…。！？:;]['\"”’»)\]]*([\x20\x09-\x0D]|$)"
# Three separators or more in a line, each followed by a blank: a menu, a path of links, a table row.
SEPARATOR = r"[|>»›•·][\x20\x09-\x0D]"
SEPARATORS = 3
ANY_MARK = r"[#*$%&|<>!»›•·]"
# Up to six words, the first of which names a place of a site.
MENU = (
    r"(?i)^[\x20\x09-\x0D]*(home|menu|login|log in|sign in|sign up|register|search|next|previous|back to top|contact us"
    r"|about us|site map|skip to content|read more|share this)([\x20\x09-\x0D]+[^\x20\x09-\x0D]+){0,4}[\x20\x09-\x0D]*$"
)
BOILERPLATE = (
    "lorem ipsum", "enable javascript", "javascript is disabled", "all rights reserved", "terms of use", "terms of service",
    "privacy policy", "cookie policy", "use of cookies", "uses cookies", "accept cookies", "subscribe to our", "click here",
    "add to cart",
)


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def word_chars(text: Column) -> Column:
    """Code points of a text that are not blanks."""
    return F.char_length(text).cast("long") - count(text, BLANK)


def any_of(tests: list[Column]) -> Column:
    return functools.reduce(operator.or_, tests)


def _forms(phrase: str) -> list[str]:
    """A phrase in the cases it is written in: small, capital first letter, capital words, all capitals."""
    return list(dict.fromkeys([phrase, phrase.capitalize(), phrase.title(), phrase.upper()]))


def _cores(phrase: str) -> list[str]:
    """What every form of a phrase holds: its longest word without the first letter, in small letters or in capitals."""
    core = max(phrase.split(), key=len)[1:]
    return [core, core.upper()]


def may_hold_notice(text: Column) -> Column:
    """False for a text that holds no boilerplate phrase; a cheap test of the whole text."""
    return any_of([text.contains(core) for core in dict.fromkeys(c for phrase in BOILERPLATE for c in _cores(phrase))])


def bad_line(line: Column, notices: bool) -> Column:
    crowded = F.regexp_count(line, F.lit(MARKS)) * 100 > F.char_length(line) * MAX_MARKS
    listed = F.regexp_count(line, F.lit(SEPARATOR)) >= SEPARATORS
    marked = line.rlike(ANY_MARK) & (crowded | listed)
    tests = [~line.rlike(SENTENCE_END), marked, line.rlike(MENU)]
    if notices:
        tests += [line.contains(form) for phrase in BOILERPLATE for form in _forms(phrase)]
    return any_of(tests)


def kept_text(text: Column) -> Column:
    """The text without its bad lines. The choice by the whole text stands outside the lambdas, or it would run per line."""

    def kept(notices: bool) -> Column:
        return F.filter(F.split(text, "\n"), lambda line: ~line.rlike(WORD) | ~bad_line(line, notices))

    return F.array_join(F.when(may_hold_notice(text), kept(True)).otherwise(kept(False)), "\n")


def window_hashes(words: Column) -> Column:
    """A 64-bit hash of every window of three words, in order."""
    windows = F.greatest(F.size(words) - 2, F.lit(0))
    pairs = F.zip_with(F.slice(words, 1, windows), F.slice(words, 2, windows), lambda a, b: F.xxhash64(a, b))
    return F.zip_with(pairs, F.slice(words, 3, windows), lambda pair, word: F.xxhash64(pair, word))


def sorted_windows(hashes: Column) -> Column:
    """Hash and place of the windows by hash, so that equal windows are neighbours."""
    return F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def words_in_repeats(placed: Column) -> Column:
    """How many words stand in a window that has an equal neighbour."""
    neighbours = F.size(placed) - 1
    twice = F.zip_with(
        F.slice(placed, 1, neighbours),
        F.slice(placed, 2, neighbours),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], a["i"] + 1, a["i"] + 2, b["i"], b["i"] + 1, b["i"] + 2)),
    )
    return F.size(F.array_distinct(F.flatten(F.filter(twice, lambda x: x.isNotNull())))).cast("long")


def judged(documents: DataFrame) -> DataFrame:
    """The nested row with its counts, the text that its good lines make, and the verdict."""
    body = text_or_empty(f"{ROW}.text")
    table = nested(documents).select(
        ROW,
        body.alias("body"),
        F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD)).alias("lines"),
        kept_text(body).alias("cleaned"),
    )
    table = table.select(
        ROW,
        "cleaned",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        count(F.col("body"), SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        (F.col("cleaned") == F.col("body")).alias("unchanged"),
        window_hashes(F.col("words")).alias("windows"),
    )
    repeats = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.col("windows"))
    kept_chars = F.when(F.col("unchanged"), F.col("word_chars")).otherwise(word_chars(F.col("cleaned")))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    table = table.select(ROW, "cleaned", *counts, kept_chars.alias("kept_chars"), sorted_windows(repeats).alias("placed"))
    n_repeat_words = F.when(F.col("placed").isNull(), F.lit(0).cast("long")).otherwise(words_in_repeats(F.col("placed")))
    table = table.select(ROW, "cleaned", *counts, n_repeat_words.alias("n_repeat_words"), "kept_chars")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    table = table.withColumn("base_failed", failed)
    return table.withColumn("kept", ~failed & (F.col("kept_chars") * 100 >= F.col("word_chars") * MIN_KEPT))


def quality_report(documents: DataFrame) -> DataFrame:
    """One row per document: its counts and the verdict."""
    return judged(documents).select(
        F.col(f"{ROW}.doc_id").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept_chars", "base_failed", "kept",
    )


def quality_clean(documents: DataFrame) -> DataFrame:
    """The documents that are kept, without their bad lines; ``n_chars`` follows the text.

    Rejected rows leave through a generator: a filter would be moved below the projections with copies of their expressions.
    """
    replaced = {"text": F.col("cleaned")}
    if "n_chars" in documents.columns:
        replaced["n_chars"] = F.char_length("cleaned").cast(documents.schema["n_chars"].dataType)
    verdict = F.array(F.struct(ROW, "cleaned", "kept"))
    kept = judged(documents).select(F.explode(F.filter(verdict, lambda row: row["kept"])).alias("one")).select(f"one.{ROW}", "one.cleaned")
    return unnested(kept, documents.columns, **replaced).select(*documents.columns)


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


QUALITY_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), {_sql(WORD)}) AS words,
         string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
windows AS (
  SELECT n, unnest(range(1, len(words) - 1)) AS i, unnest(list_transform(range(1, len(words) - 1),
         lambda j: words[j] || ' ' || words[j + 1] || ' ' || words[j + 2])) AS w FROM texts),
twice AS (SELECT n, i FROM windows QUALIFY count(*) OVER (PARTITION BY n, w) > 1),
covered AS (SELECT n, count(DISTINCT i + k) AS c FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY n),
counts AS (
  SELECT n, doc_id, len(words)::BIGINT AS n_words,
    (length(body) - len(regexp_extract_all(body, {_sql(BLANK)})))::BIGINT AS word_chars,
    len(regexp_extract_all(body, {_sql(SYMBOLS)}))::BIGINT AS n_symbols,
    list_filter(lines, lambda x: regexp_matches(x, {_sql(WORD)})) AS full_lines,
    array_to_string(list_filter(lines, lambda x: NOT regexp_matches(x, {_sql(WORD)}) OR regexp_matches(x, {_sql(SENTENCE_END)})
      AND len(regexp_extract_all(x, {_sql(MARKS)})) * 100 <= length(x) * {MAX_MARKS}
      AND len(regexp_extract_all(x, {_sql(SEPARATOR)})) < {SEPARATORS} AND NOT regexp_matches(x, {_sql(MENU)})
      AND NOT ({" OR ".join(f"contains(x, {_sql(form)})" for phrase in BOILERPLATE for form in _forms(phrase))})), chr(10)) AS cleaned FROM texts),
metrics AS (
  SELECT doc_id, n_words, word_chars, n_symbols, (len(full_lines) - len(list_distinct(full_lines)))::BIGINT AS n_dup_lines,
    coalesce(c, 0)::BIGINT AS n_repeat_words,
    (length(cleaned) - len(regexp_extract_all(cleaned, {_sql(BLANK)})))::BIGINT AS kept_chars
  FROM counts LEFT JOIN covered USING (n))
SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEATED} AS base_failed,
  NOT (n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEATED})
    AND kept_chars * 100 >= word_chars * {MIN_KEPT} AS kept
FROM metrics
"""
