"""Token counts against an independent encoder, and on very long runs."""

from __future__ import annotations

import base64

import pytest
import regex

from siliscope.llm import token_counts

MERGES = ["th", "the", " the", "in", "ing", "  ", "    ", "aa", "aaaa", "\n\n", " a", "11", "é"]
TEXTS = [
    "the thing is in the\n\n\nhouse,   isn't it?  ", "aaaaaaa aaa  aa", " " * 255 + "x", " " * 256 + "x", " " * 257, "x" + " " * 300 + "\n" + "  y", "x" + "\n" * 300 + "the",
    "\t" * 400 + " the", "é" * 20 + "\u3000" * 300 + "é", "\x1f" * 300 + "a", "a" + " " * 300 + "b" + "\u2003" * 301 + "'s" + " " * 999, "111 11 1", "", "\xa0" * 256 + "!", "a" + "\x85" * 700 + " 1",
]


@pytest.fixture(scope="module")
def small(tmp_path_factory):
    """A vocabulary of all bytes and a few merges."""
    tokens = [bytes([b]) for b in range(256)] + [m.encode() for m in MERGES]
    path = tmp_path_factory.mktemp("vocabulary") / "small.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % k for k, t in enumerate(tokens)))
    return str(path), {t: k for k, t in enumerate(tokens)}


def encoded(text: str, ranks: dict[bytes, int]) -> int:
    """Tokens by the definition: split by the pattern, then join the pair of lowest rank, the first of equals."""
    total = 0
    # White space is the property of that name, as the encoder takes it.
    for piece in regex.findall(token_counts.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"), text):
        parts = [bytes([b]) for b in piece.encode()]
        while True:
            pairs = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not pairs:
                break
            k = min(pairs)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        total += len(parts)
    return total


def test_counts_match_an_independent_encoder(spark, small):
    path, ranks = small
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = {r.doc_id: r.n_tokens for r in token_counts.token_lengths(df, vocabulary=path).collect()}
    assert found == {k: encoded(text, ranks) for k, text in enumerate(TEXTS)}


def test_long_runs_do_not_stop_the_job(spark):
    texts = [" " * 1_000_000 + "a", "\n" * 1_000_000, "a" * 1_000_000, "#" * 1_000_000, "1" * 1_000_000, "\u3000" * 400_000 + "x", (" " * 5_000 + "word ") * 200, "\x1f" * 1_000_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    histogram = token_counts.length_histogram(token_counts.token_lengths(df))
    assert sum(r.n_docs for r in histogram.collect()) == len(texts)
