"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits, A-Z as a-z. Seeds are runs of ``MIN_MATCH`` tokens; documents that share seeds with
a benchmark item become pairs, unless the shared seeds cannot cover enough of the item. Each pair is tiled by running
Karp-Rabin: rolling hashes of runs of a search length find matches of unmarked tokens, the longest are marked first, the
search length falls to ``MIN_MATCH``. The share of the item's tokens that lie in tiles is its coverage, wherever in the
document and in whatever order the tiles stand, so reordered passages are caught.

An item with fewer than ``MIN_MATCH`` tokens says nothing: "Yes." stands in clean documents as well. Such items, those without
tokens among them, match nothing and are listed by ``undecidable_items``. An item with fewer than twice as many tokens would
pass the threshold by one common phrase, so all of it must be covered.
A NULL text has no tokens. Repeated documents give repeated rows, items with the same id and different texts are items of
their own, NULL ids are allowed, empty tables give an empty result, and further columns do not matter.

Documents are shuffled once, and only to meet their pairs. The benchmark's seeds are sent to all executors only after
their number has been counted against ``BROADCAST_SEEDS``; a larger benchmark is joined by a shuffle.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, nested, texts_for_python, unnested
from .textwords import STEP, letters_and_digits, shingles, slices, text_arrays

MIN_MATCH = 5
MIN_COVERAGE = 0.5
START_LENGTH = 20
BROADCAST_SEEDS = 1_000_000
INVERSE_STEP = np.uint64(pow(int(STEP), -1, 1 << 64))


def _seeds(hashes: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` tokens and the number of its text; a shorter text has none."""
    runs, owners = shingles(hashes, firsts, size)
    whole = np.diff(firsts)[owners] >= size
    if not whole.all():
        runs, owners = runs[whole], owners[whole]
    return runs + np.uint64(size * int(STEP) % (1 << 64)), owners


def _document_seeds(documents: DataFrame, min_match: int) -> DataFrame:
    """doc_key, seed: every seed of every document."""
    words = letters_and_digits()

    def seeds(batches):
        for batch in slices(batches, 1):
            runs, owners = _seeds(*words.hashes(*text_arrays(batch.column(1))), min_match)
            keys = pa.array(batch.column(0).to_numpy()[owners])
            yield pa.RecordBatch.from_arrays([keys, pa.array(runs.view(np.int64))], ["doc_key", "seed"])

    return documents.select("doc_key", "text").mapInArrow(seeds, "doc_key long, seed long")


def _item_seeds(items: DataFrame, min_match: int) -> DataFrame:
    """item_key, seed, places (how often the seed stands in the item), item_tokens."""
    words = letters_and_digits()

    def seeds(batches):
        for batch in slices(batches, 1):
            hashes, firsts = words.hashes(*text_arrays(batch.column(1)))
            runs, owners = _seeds(hashes, firsts, min_match)
            columns = [batch.column(0).to_numpy()[owners], runs.view(np.int64), np.diff(firsts)[owners].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["item_key", "seed", "item_tokens"])

    rows = items.select("item_key", "text").mapInArrow(seeds, "item_key long, seed long, item_tokens long")
    return rows.groupBy("item_key", "seed", "item_tokens").agg(F.count(F.lit(1)).alias("places"))


def undecidable_items(benchmark: DataFrame, min_match: int = MIN_MATCH) -> DataFrame:
    """item_id, item_tokens of the items that are too short to be looked for."""
    words = letters_and_digits()

    def count(batches):
        for batch in slices(batches, 1):
            counts = np.diff(words.hashes(*text_arrays(batch.column(1)))[1]).astype(np.int64)
            rows = pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts)], ["item_id", "item_tokens"])
            yield rows.filter(pa.array(counts < min_match))

    kind = benchmark.schema["item_id"].dataType.simpleString()
    items = texts_for_python(benchmark.select("item_id", "text").distinct())
    return items.mapInArrow(count, f"item_id {kind}, item_tokens long")


def candidate_pairs(documents: DataFrame, items: DataFrame, min_match: int, min_coverage: float) -> DataFrame:
    """doc_key, item_key of the pairs whose shared seeds could cover enough of the item."""
    item_seeds = _item_seeds(items, min_match)
    if item_seeds.count() <= BROADCAST_SEEDS:
        item_seeds = F.broadcast(item_seeds)
    pairs = _document_seeds(documents, min_match).join(item_seeds, "seed").groupBy("doc_key", "item_key")
    # A seed that the document repeats is counted again: more than enough for a bound.
    pairs = pairs.agg(F.sum("places").alias("seeds"), F.max("item_tokens").alias("item_tokens"))
    most = F.least(F.col("seeds") * min_match, F.col("item_tokens"))
    wanted = F.when(F.col("item_tokens") < 2 * min_match, 1.0).otherwise(min_coverage)
    return pairs.filter(most >= F.col("item_tokens") * wanted).select("doc_key", "item_key")


def _rolling(tokens: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``size`` tokens, from running sums."""
    n = len(tokens)
    if n < size:
        return np.zeros(0, np.uint64)
    powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, STEP)]))
    inverse = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, INVERSE_STEP)]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens * powers[:n])])
    return (sums[size:] - sums[: n - size + 1]) * inverse[: n - size + 1]


def _unmarked_runs(marked: np.ndarray, size: int) -> np.ndarray:
    """Whether the run of ``size`` tokens from each place holds no marked one."""
    sums = np.concatenate([[0], np.cumsum(marked)])
    return sums[size:] == sums[: len(marked) - size + 1]


def tiles(document: np.ndarray, item: np.ndarray, min_match: int = MIN_MATCH, start: int = START_LENGTH) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in the document, place in the item, length) of the tiles, longest first."""
    min_match = min(min_match, len(item))
    if not min_match:
        return []
    doc_marked, item_marked = np.zeros(len(document), bool), np.zeros(len(item), bool)
    laid: list[tuple[int, int, int]] = []
    size = max(min_match, min(start, len(item)))
    while True:
        longest = 0
        matches: list[tuple[int, int, int]] = []
        if len(document) >= size and len(item) >= size:
            doc_hash, item_hash = _rolling(document, size), _rolling(item, size)
            doc_at = np.flatnonzero(_unmarked_runs(doc_marked, size))
            item_at = np.flatnonzero(_unmarked_runs(item_marked, size))
            order = doc_at[np.argsort(doc_hash[doc_at], kind="stable")]
            sorted_hash = doc_hash[order]
            low = np.searchsorted(sorted_hash, item_hash[item_at], "left")
            high = np.searchsorted(sorted_hash, item_hash[item_at], "right")
            for place, a, b in zip(item_at, low, high):
                for at in order[a:b]:
                    # A match that could begin earlier is part of one that does.
                    if place and at and item[place - 1] == document[at - 1] and not item_marked[place - 1] and not doc_marked[at - 1]:
                        continue
                    length = 0
                    while (
                        place + length < len(item) and at + length < len(document)
                        and item[place + length] == document[at + length]
                        and not item_marked[place + length] and not doc_marked[at + length]
                    ):
                        length += 1
                    if length >= size:
                        matches.append((length, int(at), int(place)))
                        longest = max(longest, length)
        if longest > 2 * size:
            size = longest
            continue
        # What longer tiles have taken is cut off a match; a free piece waits for its turn by its own length.
        waiting = [(-length, at, place) for length, at, place in matches]
        heapq.heapify(waiting)
        while waiting:
            length, at, place = heapq.heappop(waiting)
            taken = doc_marked[at : at - length] | item_marked[place : place - length]
            if not taken.any():
                doc_marked[at : at - length] = True
                item_marked[place : place - length] = True
                laid.append((at, place, -length))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]]).astype(np.int8)))
            for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if end - begin >= size:
                    heapq.heappush(waiting, (begin - end, at + begin, place + begin))
        if size == min_match:
            return laid
        size = max(min_match, size // 2)


def document_keys(doc_id: str, text: str) -> dict[str, Column]:
    """Two hashes of id and text. Candidates are found by the first, as one too many does no harm; rows go by both."""
    return {"doc_key": F.xxhash64(doc_id, text), "doc_key_2": F.xxhash64(F.lit(2), text, doc_id)}


def contaminated_pairs(
    documents: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, min_coverage: float = MIN_COVERAGE
) -> DataFrame:
    """doc_key, doc_key_2, doc_id, item_id, item_tokens, covered_tokens, n_tiles, coverage of pairs with enough coverage."""
    items = benchmark.select("item_id", "text").distinct()
    items = items.withColumn("item_key", F.xxhash64("item_id", "text"))
    keyed = documents.select("doc_id", "text").withColumns(document_keys("doc_id", "text"))
    keyed = texts_for_python(keyed)
    pairs = candidate_pairs(keyed, items, min_match, min_coverage)
    pairs = pairs.join(items.select("item_key", "item_id", F.col("text").alias("item_text")), "item_key")
    pairs = pairs.join(keyed, "doc_key").select("doc_key", "doc_key_2", "doc_id", "item_id", "text", "item_text")
    words = letters_and_digits()

    def tile(batches):
        for batch in slices(batches, 4):
            doc_words, doc_firsts = words.hashes(*text_arrays(batch.column(4)))
            item_words, item_firsts = words.hashes(*text_arrays(batch.column(5)))
            rows, kept = [], []
            for row in range(batch.num_rows):
                item = item_words[item_firsts[row] : item_firsts[row + 1]]
                laid = tiles(doc_words[doc_firsts[row] : doc_firsts[row + 1]], item, min_match)
                covered = sum(length for _, _, length in laid)
                wanted = 1.0 if len(item) < 2 * min_match else min_coverage
                if covered >= min_match and covered >= wanted * len(item):
                    kept.append(row)
                    rows.append((len(item), covered, len(laid), covered / len(item)))
            columns = list(zip(*rows)) if rows else [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            where = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(where) for i in range(4)] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_key", "doc_key_2", "doc_id", "item_id", "item_tokens", "covered_tokens", "n_tiles", "coverage"],
            )

    doc_kind, item_kind = (t.schema[c].dataType.simpleString() for t, c in ((documents, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_key long, doc_key_2 long, doc_id {doc_kind}, item_id {item_kind}, item_tokens long, covered_tokens long, n_tiles long, coverage double"
    return pairs.mapInArrow(tile, schema)


def contamination_report(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per contaminated document and benchmark item; clean documents have none."""
    return contaminated_pairs(documents, benchmark, **options).drop("doc_key", "doc_key_2")


def decontaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item."""
    keys = ["doc_key", "doc_key_2"]
    leaks = contaminated_pairs(documents, benchmark, **options).select(*keys).distinct()
    keyed = nested(documents).withColumns(document_keys(f"{ROW}.doc_id", f"{ROW}.text"))
    return unnested(keyed.join(leaks, keys, "left_anti"), documents.columns)
