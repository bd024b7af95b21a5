"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is a vector of hashed terms with logarithmic counts: its words without regard to case, the shapes of its words
(capitals, letters, digits, the marks on them), repeated neighbouring words and repeated lines. The latent space is
spanned by the leading right singular vectors of a bounded sample of labelled texts. The labelled latent vectors of that
sample go to every task; every document is compared with all of them, in blocks of exact cosine products, and the labels
of its nearest ones are averaged with the similarities as weights.

The sample holds ``max_labelled`` texts at most (those with the smallest hashes of their ids, one text per id), so what
the driver fits and what is broadcast is bounded by ``max_labelled`` times the number of terms or of latent dimensions.
Everything else covers all documents and whole texts; long texts are read in pieces of a million characters.

Labels of ids whose CRC-32 is 2 modulo 4 are held out. NULL ids are never held out and have no label; labels other than
0 and 1 are ignored; of labels that contradict each other the more frequent one counts, of equally many 0. Texts without
terms (NULL, empty) and texts near nothing get the share of label 1 in the sample, 0.5 without any labelled text. As
many neighbours vote as asked for, and all others that are as near as the last of them. Repeated rows get equal scores,
an empty table an empty result; other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, texts_for_python

TERMS = 1024
LATENT = 48
NEIGHBOURS = 15
MAX_LABELLED = 8000
THRESHOLD = 0.7
HELD_OUT_OF, HELD_OUT = 4, 2
_PIECE = 1_000_000
_BLOCK = 128  # documents compared with the sample at a time
_KNOWN_WORDS = 100_000  # words whose terms a task remembers
_TIE = 1e-6


def held_out(doc_id: Column) -> Column:
    """Whether the labels of an id are kept for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == HELD_OUT, F.lit(False))


def shape(word: str) -> str:
    """Runs of capitals, letters and digits as A, a and 0; other marks stay, doubled ones once."""
    out: list[str] = []
    for ch in word[:64]:
        kind = "A" if ch.isupper() else "a" if ch.isalpha() else "0" if ch.isdigit() else ch
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def _term(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}{value}".encode("utf-8", "surrogatepass")) % TERMS


_SAME_WORD, _SAME_LINE = _term("r", "word"), _term("r", "line")


def pieces(text: str):
    """The text in pieces that end at white space, if there is some."""
    start = 0
    while start < len(text):
        end = start + _PIECE
        if end < len(text):
            while end < len(text) and end < start + 2 * _PIECE and not text[end].isspace():
                end += 1
        yield text[start:end]
        start = end


def term_counts(text: str, known: dict[str, tuple[int, int]]) -> Counter:
    """Counts of the hashed terms of a whole text; ``known`` remembers the terms of words."""
    counts: Counter = Counter()
    last, lines = None, Counter()
    for piece in pieces(text):
        words = piece.split()
        for word, n in Counter(words).items():
            terms = known.get(word)
            if terms is None:
                terms = (_term("w", word.lower()), _term("s", shape(word)))
                if len(known) < _KNOWN_WORDS:
                    known[word] = terms
            counts[terms[0]] += n
            counts[terms[1]] += n
        same = sum(a == b for a, b in zip(words, words[1:])) + (bool(words) and words[0] == last)
        if same:
            counts[_SAME_WORD] += same
        last = words[-1] if words else last
        lines.update(line for line in piece.split("\n") if line and not line.isspace())
    again = sum(lines.values()) - len(lines)
    if again:
        counts[_SAME_LINE] += again
    return counts


def term_vector(text: str | None, known: dict[str, tuple[int, int]]) -> np.ndarray:
    """Unit vector of logarithmic term counts; all zero without terms."""
    vector = np.zeros(TERMS, dtype=np.float32)
    for term, n in term_counts(text or "", known).items():
        vector[term] = math.log1p(n)
    size = float(np.linalg.norm(vector))
    return vector / size if size else vector


@dataclass(frozen=True)
class LatentSample:
    """Directions of the latent space, unit latent vectors of the labelled texts, their labels, the share of label 1."""

    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float


def labelled_sample(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, label, text: at most ``max_labelled`` labelled texts outside the held-out part, one per id."""
    given = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("quality"))
    given = given.filter(F.col("id").isNotNull() & F.col("quality").isin(0.0, 1.0) & ~held_out(F.col("id")))
    single = given.groupBy("id").agg((F.avg("quality") > 0.5).cast("int").alias("label"))
    # A hash range with some more than the bound comes first, so that few ids are put in order.
    single = single.withColumn("hash", F.xxhash64("id"))
    many = given.select(F.approx_count_distinct("id").alias("n")).first().n
    share = min(1.0, 1.5 * max_labelled / many) if many else 1.0
    low = -(1 << 63)
    if share < 1.0:
        single = single.filter(F.col("hash") <= low + int(share * ((1 << 64) - 1)))
    chosen = stored(single.orderBy("hash", "id").limit(max_labelled).select("id", "label"), "labelled")
    # At most max_labelled rows of an id and a label.
    texts = documents.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(chosen), "id")
    return texts.groupBy("id", "label").agg(F.min("text").alias("text")).select(F.col("id").alias("doc_id"), "label", "text")


def fit_sample(sample: DataFrame, latent: int = LATENT) -> LatentSample | None:
    """Span the latent space by the labelled texts; None without texts that have terms."""

    def vectors(batches):
        known: dict[str, tuple[int, int]] = {}
        for batch in batches:
            packed = [term_vector(value.as_py(), known).astype("<f4").tobytes() for value in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["doc_id", "label", "vector"])

    schema = T.StructType([sample.schema["doc_id"], sample.schema["label"], T.StructField("vector", T.BinaryType())])
    found = texts_for_python(sample.select("doc_id", "label", "text")).mapInArrow(vectors, schema).toArrow()
    if not found.num_rows:
        return None
    order = np.argsort(np.array([str(v) for v in found.column("doc_id").to_pylist()]), kind="stable")
    matrix = np.stack([np.frombuffer(v, "<f4") for v in found.column("vector").to_pylist()])[order]
    labels = np.array(found.column("label").to_pylist(), dtype=np.float32)[order]
    prior = float(labels.mean())
    _, directions = np.linalg.eigh((matrix.T @ matrix).astype(np.float64))
    directions = np.ascontiguousarray(directions[:, ::-1][:, :latent]).astype(np.float32)
    latent_vectors = matrix @ directions
    sizes = np.linalg.norm(latent_vectors, axis=1)
    there = sizes > 0
    return LatentSample(directions, latent_vectors[there] / sizes[there, None], labels[there], prior)


def votes(model: LatentSample, terms: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores of rows of term vectors: the labels of the nearest labelled texts, weighted by similarity."""
    scores = np.full(len(terms), model.prior)
    k = min(neighbours, len(model.labels))
    if not k:
        return scores
    own = terms @ model.directions
    sizes = np.linalg.norm(own, axis=1)
    for start in range(0, len(terms), _BLOCK):
        rows = np.flatnonzero(sizes[start : start + _BLOCK] > 1e-6) + start
        if not len(rows):
            continue
        near = (own[rows] / sizes[rows, None]) @ model.vectors.T
        last = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
        weight = np.where((near >= last[:, None] - _TIE) & (near > 0), near, 0).astype(np.float64)
        total = weight.sum(axis=1)
        some = total > 0
        scores[rows[some]] = np.clip((weight[some] @ model.labels) / total[some], 0.0, 1.0)
    return scores


def quality_scores(documents: DataFrame, model: LatentSample | None, keep: list[str], neighbours: int = NEIGHBOURS) -> DataFrame:
    """The columns ``keep`` and the score of every document."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by the size of the sample

    def score(batches):
        known: dict[str, tuple[int, int]] = {}
        for batch in batches:
            scores = np.full(batch.num_rows, 0.5)
            if shared.value is not None and batch.num_rows:
                scores = votes(shared.value, np.stack([term_vector(value.as_py(), known) for value in batch.column(0)]), neighbours)
            kept = [batch.column(k + 1) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], [*keep, "score"])

    schema = T.StructType([documents.schema[name] for name in keep] + [T.StructField("score", T.DoubleType())])
    rows = documents.select(F.col("text"), *[F.col(f"`{name}`") for name in keep])
    return texts_for_python(rows).mapInArrow(score, schema)


def quality_votes(
    documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, neighbours: int = NEIGHBOURS, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit_sample(labelled_sample(documents, labels, max_labelled))
    scores = quality_scores(documents, model, ["doc_id"], neighbours)
    predicted = (F.col("score") >= threshold).cast("int")
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
