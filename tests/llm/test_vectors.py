"""Clustering on bit planes, whitening and nearest-neighbour voting against brute-force versions and on awkward rows."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from siliscope.llm import bit_planes, neighbour_votes, singular_values, whitening

rng = random.Random(7)
VECTOR = [rng.uniform(-1, 1) for _ in range(64)]
OTHERS = [[rng.gauss(0, 0.3) for _ in range(64)] for _ in range(40)]
ROWS = [(k, v) for k, v in enumerate(OTHERS)] + [
    (100, None), (101, []), (102, [1.0] * 63), (103, [None] + [1.0] * 63), (104, [float("nan")] + [1.0] * 63), (105, [float("-inf")] + [0.0] * 63),
    (106, [0.0] * 64), (107, [-0.0] * 64), (None, VECTOR), (3, VECTOR), (3, VECTOR), (108, [-1 / 64] * 64), (109, [1.0, -1.0] * 32), (110, [0.5] * 65),
]
LARGE = [(200, [3e38] + [0.0] * 63), (201, [-1e30, 2e17] + VECTOR[2:]), (202, [float(1 << 40)] * 64), (203, [1e300] * 64)]


def table(spark, rows):
    """Vectors with more columns, of names the operators use themselves."""
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.select("*", *[F.lit(k).alias(name) for k, name in enumerate(("planes", "vector", "cluster", "key", "x", "n", "size", "part"))])


def good(vector, size=None):
    return vector is not None and (size is None or len(vector) == size) and all(c is not None and math.isfinite(c) for c in vector)


def clusters_by_force(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * Fraction(c)) for c in v]) for i, v in rows if good(v, 64)]
    order = [(i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "", v, x) for (i, v), (_, x) in zip([r for r in rows if good(r[1], 64)], kept)]
    centroids = [x for *_, x in sorted(order)[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, x in kept:
            groups[nearest(x)[1]].append(x)
        centroids = [[sum(d) // len(groups[n]) for d in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)]
    found = [(i, *nearest(x)) for i, x in kept]
    inertia = collections.Counter()
    for _, distance, n in found:
        inertia[n] += distance
    fit = lambda d: d if d < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    total = sum(inertia.values())
    # A sum that holds a distance beyond the longs is itself beyond them.
    return sorted(((i, n, fit(d), fit(inertia[n]), fit(total), digest[n]) for i, d, n in found), key=repr)


@pytest.mark.parametrize("rows", [ROWS, ROWS + LARGE, ROWS[:5], ROWS[40:46], [(1, VECTOR)] * 50 + ROWS], ids=["odd", "large", "few", "none", "copies"])
def test_clusters_match_brute_force(spark, rows):
    found = [tuple(r) for r in bit_planes.centroid_clusters(table(spark, rows).repartition(3)).collect()]
    assert sorted(found, key=repr) == clusters_by_force(rows)


def test_clusters_of_nothing(spark):
    assert bit_planes.centroid_clusters(table(spark, ROWS).limit(0)).count() == 0


def test_planes_give_exact_products():
    for width in (1, 5, 27, 40, 62, 200):
        values = np.array([[rng.randrange(-(1 << width), 1 << width) for _ in range(64)] for _ in range(6)], dtype=object)
        planes = bit_planes.planes_of(values if width > 61 else values.astype(np.int64))
        assert (bit_planes.products(planes, planes).astype(object) == values @ values.T).all()
        assert (bit_planes.squares(planes).astype(object) == (values * values).sum(axis=1)).all()


def whitened_by_force(rows, components=4):
    kept = [(i, [max(-(1 << 63), min((1 << 63) - 1, math.floor(256 * Fraction(c)))) for c in v]) for i, v in rows if good(v)]
    lengths = collections.Counter(len(x) for _, x in kept if x)
    if not lengths:
        return []
    size = max(lengths, key=lambda k: (lengths[k], k))
    fit = sorted({tuple(x) for _, x in kept if len(x) == size})
    n, sums = len(fit), [sum(d) for d in zip(*fit)]
    off = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(off.T @ off / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for i, x in kept:
        for k in range(min(components, size) if x else 0):
            if len(x) != size:
                out.append((i, k + 1, n, None, None, values[k]))
                continue
            deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
            mine = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)]) @ vectors[:, k] / math.sqrt(max(values[k], 1e-300))
            out.append((i, k + 1, n, deviation if deviation < 1 << 63 else None, mine, values[k] / (off * off).sum() * n if off.any() else None))
    return out


@pytest.mark.parametrize("copies", [1, 3])
def test_whitening_matches_brute_force(spark, copies):
    rows = ROWS * copies
    found = [tuple(r) for r in whitening.whitened(table(spark, rows).repartition(11)).collect()]
    expected = whitened_by_force(rows)
    key = lambda r: (repr(r[0]), r[1], repr(r[3]), abs(r[4] or 0.0).__round__(6))
    found.sort(key=key)
    expected.sort(key=key)
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    for ours, theirs in zip(found, expected):
        assert (ours[4] is None) == (theirs[4] is None)
        if ours[4] is not None:
            assert abs(ours[4]) == pytest.approx(abs(theirs[4]), abs=1e-9) and ours[5] == pytest.approx(theirs[5], rel=1e-9)
        assert ours[6] <= 1e-9
    for k in (1, 2, 3, 4):  # one sign for all rows
        pairs = {(repr(t[0]), repr(t[3])): t[4] for t in expected if t[1] == k and t[4]}
        signs = {np.sign(r[4] * pairs[repr(r[0]), repr(r[3])]) for r in found if r[1] == k and r[4] is not None and abs(r[4]) > 1e-6}
        assert len(signs) == 1


def test_whitening_of_few_and_flat_rows(spark):
    assert whitening.whitened(table(spark, ROWS).limit(0)).count() == 0
    assert whitening.whitened(table(spark, [(1, []), (2, None)])).count() == 0
    same = whitening.whitened(table(spark, [(1, VECTOR)] * 7)).collect()
    assert len(same) == 28 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.explained is None and r.identity_error is None for r in same)
    two = whitening.whitened(table(spark, [(1, [0.0, 1.0]), (2, [2.0, 1.0]), (3, [7.0])])).collect()
    assert sorted((r.vec_id, r.component, r.deviation, None if r.whitened is None else round(abs(r.whitened), 9), r.explained) for r in two) == [
        (1, 1, 512 * 512, 1.0, 1.0), (1, 2, 512 * 512, None, 0.0), (2, 1, 512 * 512, 1.0, 1.0), (2, 2, 512 * 512, None, 0.0),
        (3, 1, None, None, 1.0), (3, 2, None, None, 0.0),
    ]
    large = whitening.whitened(table(spark, ROWS + [(300, [1e300] * 64), (301, [-3e38] * 64)])).collect()
    assert all(r.deviation is None for r in large if r.vec_id in (300, 301)) and large[0].identity_error < 1e-4


def test_whitening_of_the_given_vectors(spark, data):
    given = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in given.collect()]
    expected = {(r[0], r[1]): r for r in whitened_by_force(rows)}
    found = whitening.whitened(given.repartition(70)).collect()  # three levels of triangles
    assert len(found) == len(expected)
    for r in found:
        theirs = expected[r.vec_id, r.component]
        assert r.deviation == theirs[3] and abs(r.whitened) == pytest.approx(abs(theirs[4]), abs=1e-8) and r.identity_error < 1e-9


@pytest.mark.parametrize("spread", [[5] * 8, [5, 5, 5, 5, 5, 1, 1, 1], [3, 2, 0, 0, 0, 0, 0, 0], [0] * 8, [7, 7 - 1e-13, 7 - 2e-13, 6, 5, 4, 3, 2], [1, 1e-4, 1e-8, 1e-12] * 2])
def test_singular_vectors(spread):
    turn = np.linalg.qr(np.random.default_rng(1).normal(size=(8, 8)))[0]
    matrix = np.linalg.qr(np.diag(np.array(spread, float)) @ turn.T)[1]
    values, directions = singular_values.leading_directions(matrix, 4)
    expected = np.linalg.svd(matrix)[1] ** 2
    assert np.abs(values - expected).max() <= 1e-13 * max(expected[0], 1e-300)
    live = [k for k in range(4) if expected[k] > 1e-20]
    assert np.abs(directions[:, live].T @ directions[:, live] - np.eye(len(live))).max(initial=0) < 1e-12
    assert np.abs(matrix.T @ (matrix @ directions[:, live]) - directions[:, live] * expected[live]).max(initial=0) < 1e-12 * max(expected[0], 1)


GOOD = ["plain words that follow each other in a sentence, and then stop.", "Another one of those texts, with words and commas.\nA second line."]
BAD = ["BUY!! NOW!! BUY!! NOW!!", "menu | home | menu | home |", "word word word word word"]


def documents(spark):
    texts = [(k, (GOOD + BAD)[k % 5] + f" {k}") for k in range(60)] + [
        (None, GOOD[0]), (70, None), (71, ""), (72, " \n\t"), (73, "a" * 1_500_000), (74, ("some words, then. " * 70_000)), (75, "\n" * 1_100_000), (5, GOOD[1]), (5, GOOD[1]),
        (76, "😀 文字 ñ \x00"),
    ]
    labels = [(k, int(k % 5 < 2)) for k in range(60)] + [(None, 1), (5, None), (7, 3), (71, 1), (90, 0), (9, 1), (9, 1)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("quality", F.lit(9)).withColumn("id", F.lit(1))
    return docs, spark.createDataFrame(labels, "doc_id long, quality int").withColumn("text", F.lit("no")), texts, labels


def votes_by_force(texts, labels, neighbours):
    """Scores by comparing term vectors one by one; ties of the last neighbour all vote."""
    given = collections.defaultdict(list)
    for i, q in labels:
        if i is not None and q in (0, 1) and zlib.crc32(str(i).encode()) % 4 != 2:
            given[i].append(q)
    first = {}
    for i, text in texts:
        if i in given and text is not None:
            first[i] = min(first.get(i, text), text)
    for i, _ in texts:
        if i in given:
            first.setdefault(i, None)
    matrix = np.array([neighbour_votes.term_vector(t, {}) for _, t in sorted(first.items(), key=lambda p: str(p[0]))], dtype=np.float64)
    labels_of = [int(2 * sum(given[i]) > len(given[i])) for i in sorted(first, key=str)]
    _, _, rows = np.linalg.svd(matrix, full_matrices=False)
    space = rows[: neighbour_votes.LATENT].T
    known = [(v, q) for v, q in zip(matrix @ space, labels_of) if np.linalg.norm(v) > 0]
    out = []
    for i, text in texts:
        own = neighbour_votes.term_vector(text, {}).astype(np.float64) @ space
        if np.linalg.norm(own) <= 1e-6:
            out.append((i, sum(labels_of) / len(labels_of)))
            continue
        near = sorted(((own @ v / np.linalg.norm(own) / np.linalg.norm(v), q) for v, q in known), reverse=True)
        last = near[min(neighbours, len(near)) - 1][0]
        voters = [(s, q) for s, q in near if s >= last - 1e-6 and s > 0]
        out.append((i, sum(s * q for s, q in voters) / sum(s for s, _ in voters) if voters else sum(labels_of) / len(labels_of)))
    return out


def test_votes_match_brute_force(spark):
    docs, labels, texts, given = documents(spark)
    found = neighbour_votes.quality_votes(docs.repartition(4), labels, neighbours=5).collect()
    expected = votes_by_force(texts, given, 5)
    assert len(found) == len(expected)
    key = lambda p: (repr(p[0]), round(p[1], 3))
    for (i, score), (j, wanted) in zip(sorted(((r.doc_id, r.score) for r in found), key=key), sorted(expected, key=key)):
        assert i == j and score == pytest.approx(wanted, abs=1e-3)
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.7)


def test_votes_without_labels_or_documents(spark):
    docs, labels, *_ = documents(spark)
    assert {(r.score, r.predicted) for r in neighbour_votes.quality_votes(docs, labels.limit(0)).collect()} == {(0.5, 0)}
    assert neighbour_votes.quality_votes(docs.limit(0), labels).count() == 0


def test_sample_is_bounded(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    sample = neighbour_votes.labelled_sample(docs.union(docs), labels, max_labelled=100)
    assert sample.count() == 100 and sample.select("doc_id").distinct().count() == 100
    assert not sample.filter(neighbour_votes.held_out(F.col("doc_id"))).count()


def test_held_out_labels_are_predicted(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = neighbour_votes.quality_votes(docs, labels).filter("held_out").join(labels, "doc_id").groupBy("quality", "predicted").count().collect()
    counts = {(r.quality, r.predicted): r["count"] for r in rows}
    right = {q: counts.get((q, q), 0) / (counts.get((q, 0), 0) + counts.get((q, 1), 0)) for q in (0, 1)}
    assert right[1] > 0.99 and right[0] > 0.95


def test_pieces_keep_words_whole():
    text = "word " * 450_000
    parts = list(neighbour_votes.pieces(text))
    assert "".join(parts) == text and len(parts) == 3 and all(part[0] == " " for part in parts[1:])
    assert neighbour_votes.term_counts(text, {})[neighbour_votes._SAME_WORD] == 449_999
