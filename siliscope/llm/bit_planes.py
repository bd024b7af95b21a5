"""Centroid clustering on bit planes.

Components become integers, and each bit plane of the 64 components of a vector is packed into one unsigned 64-bit
word: the words of a vector are its two's complement read downwards, the last one has negative weight. A dot product is
then the weighted sum of the set bits in ANDs of planes, and the sums of a cluster come from counting set bits per plane
and component. Every number is an exact integer at any width; Python's integers take over where 64 bits would not do.

The packed vectors are written once to the shared folder. Each round is one pass without a shuffle of vectors: a task
sends one row of counts per cluster and plane, whatever the size of a cluster, so a cluster, or copies of one vector,
that hold most of the rows cost nothing more. The driver holds the centroids only.

Vectors that are NULL, of another length than 64, or with NULL or non-finite components are left out. Ids may be NULL
(they come last as first centroids) or repeated; equal rows give equal rows. With fewer vectors than clusters there are
fewer clusters; an empty table gives an empty result. A squared distance or a sum of them that no long holds is NULL,
while the clusters stay exact. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

SIZE = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = "1"
_CHUNK = 1024  # rows whose planes are compared with the centroids at a time
_LONG = 63
_WIDE = float(1 << 55)  # components below it are scaled in 64 bits


def usable(vector: Column, size: int | None = None) -> Column:
    """No NULL, no NaN, no infinity, and ``size`` components if that is given; never NULL itself."""
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    good = vector.isNotNull() & finite
    if size is not None:
        good = good & (F.size(vector) == size)
    return F.coalesce(good, F.lit(False))


def scaled(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of finite doubles: int64, or Python integers if one is too large."""
    if not vectors.size or np.abs(vectors).max() < _WIDE:
        return np.floor(vectors * scale).astype(np.int64)
    exact = lambda x: int(x) * scale if abs(x) >= _WIDE else int(np.floor(x * scale))
    return np.array([[exact(float(x)) for x in row] for row in vectors], dtype=object).reshape(vectors.shape)


def planes_of(values: np.ndarray) -> np.ndarray:
    """(rows, planes) of 64-bit words: two's complement of (rows, 64) integers, the last plane is the sign."""
    widest = max((int(values.max()).bit_length(), (-int(values.min()) - 1).bit_length())) if values.size else 0
    bits = [((values >> j) & 1).astype(np.uint8) for j in range(widest + 1)]
    packed = [np.packbits(plane, axis=1, bitorder="little").view("<u8").reshape(-1) for plane in bits]
    return np.stack(packed, axis=1)


def weighted(planes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The planes and what each one counts; equal planes that follow each other, such as copies of the sign, are one."""
    last = planes.shape[1] - 1
    keep = [j for j in range(last) if (planes[:, j] != planes[:, j + 1]).any()] + [last]
    starts = [0, *[j + 1 for j in keep[:-1]]]
    counts = [(1 << (j + 1)) - (1 << start) if j < last else -(1 << start) for start, j in zip(starts, keep)]
    return planes[:, keep], counts


def _kind(*counts: list[int]):
    """Sums of products of such weights and 64 bits fit a long, or need Python's integers."""
    return np.int64 if sum(max(map(abs, c)).bit_length() + 1 for c in counts) + 8 < _LONG else object


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact dot products of every row of ``left`` with every row of ``right``, both given as planes."""
    (left, ours), (right, theirs) = weighted(left), weighted(right)
    total = np.zeros((left.shape[0], right.shape[0]), dtype=_kind(ours, theirs))
    for i, a in enumerate(ours):
        for j, b in enumerate(theirs):
            total += np.bitwise_count(left[:, i, None] & right[None, :, j]).astype(total.dtype) * (a * b)
    return total


def squares(planes: np.ndarray) -> np.ndarray:
    """Exact sum of squares of every row."""
    planes, counts = weighted(planes)
    total = np.zeros(planes.shape[0], dtype=_kind(counts, counts))
    for i, a in enumerate(counts):
        for j, b in enumerate(counts):
            total += np.bitwise_count(planes[:, i] & planes[:, j]).astype(total.dtype) * (a * b)
    return total


# Numbers and planes of the centroids of about the same width.
Groups = list[tuple[np.ndarray, np.ndarray]]


def grouped(centroids: list[list[int]]) -> Groups:
    """The planes of the centroids; each one of large components by itself, so that it does not slow down the others."""
    wide = [max(map(abs, c)) >= 1 << 24 for c in centroids]
    groups = [[k for k, w in enumerate(wide) if not w], *[[k] for k, w in enumerate(wide) if w]]
    return [(np.array(g), planes_of(np.array([centroids[k] for k in g], dtype=object))) for g in groups if g]


def nearest(planes: np.ndarray, centroids: Groups) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and the squared distance to it; of equally near ones the smaller number."""
    own, parts = squares(planes), []
    for numbers, words in centroids:
        dots, theirs = products(planes, words), squares(words)
        if any(x.dtype == object for x in (dots, own, theirs)):
            dots, theirs = dots.astype(object), theirs.astype(object)
        parts.append((numbers, own.astype(dots.dtype)[:, None] + theirs[None, :] - 2 * dots))
    kind = object if any(part.dtype == object for _, part in parts) else np.int64
    distances = np.zeros((len(planes), sum(len(numbers) for numbers, _ in parts)), dtype=kind)
    for numbers, part in parts:
        distances[:, numbers] = part
    best = distances.argmin(axis=1)
    return best, distances[np.arange(len(best)), best]


def _words(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, planes) of a column of plane lists, one pair per number of planes, in chunks."""
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
    lengths, out = np.diff(offsets), []
    for width in np.unique(lengths):
        rows = np.flatnonzero(lengths == width)
        for start in range(0, len(rows), _CHUNK):
            some = rows[start : start + _CHUNK]
            out.append((some, flat[offsets[some][:, None] + np.arange(width)]))
    return out


def packed(table: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``planes``, the packed words, of all rows whose vector can be used."""
    good = table.filter(usable(F.col(f"`{vector}`"), SIZE))
    good = good.select(F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double")).alias("vector"), *[F.col(f"`{name}`") for name in keep])

    def pack(batches):
        for batch in batches:
            vectors = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, SIZE)
            large = np.abs(vectors).max(axis=1, initial=0) >= _WIDE
            for rows in (np.flatnonzero(~large), np.flatnonzero(large)):
                if len(rows):
                    words = planes_of(scaled(vectors[rows]))
                    offsets = pa.array(np.arange(0, words.size + 1, words.shape[1]), pa.int32())
                    lists = pa.ListArray.from_arrays(offsets, pa.array(words.reshape(-1).view(np.int64)))
                    kept = [batch.column(k + 1).take(pa.array(rows)) for k in range(len(keep))]
                    yield pa.RecordBatch.from_arrays([*kept, lists], [*keep, "planes"])

    schema = T.StructType([table.schema[name] for name in keep] + [T.StructField("planes", T.ArrayType(T.LongType()))])
    return good.mapInArrow(pack, schema)


def first_centroids(table: DataFrame, id_column: str, vector: str, clusters: int, seed: str) -> list[list[int]]:
    """The vectors with the smallest hashes of seed and id, in that order; equal ids by their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(f"`{id_column}`").cast("string")), 256)
    rows = table.filter(usable(F.col(f"`{vector}`"), SIZE)).select(
        key.alias("key"), F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double")).alias("vector")
    )
    found = rows.orderBy(F.col("key").asc_nulls_last(), "vector").limit(clusters).collect()
    return [[int(x) for x in scaled(np.array([row.vector]))[0]] for row in found]


def plane_counts(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """cluster, weight (exponent of two; the sign plane has -1 - exponent), n (vectors), counts of set bits by component.

    One row per task, cluster and plane.
    """
    targets = grouped(centroids)

    def count(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        sizes: dict[tuple[int, int], int] = {}
        for batch in batches:
            for _, words in _words(batch.column(0)):
                best, _ = nearest(words, targets)
                bits = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(len(words), -1, 8), axis=2, bitorder="little")
                for cluster in np.unique(best):
                    members = bits[best == cluster]
                    found = members.sum(axis=0, dtype=np.int64)
                    for j in range(found.shape[0]):
                        key = (int(cluster), j if j < found.shape[0] - 1 else -1 - j)
                        sums[key] = sums.get(key, 0) + found[j]
                        sizes[key] = sizes.get(key, 0) + (len(members) if key[1] < 0 else 0)
        keys = sorted(sums)
        columns = [[k[0] for k in keys], [k[1] for k in keys], [sizes[k] for k in keys], [sums[k].tolist() for k in keys]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["cluster", "weight", "n", "counts"])

    return vectors.select("planes").mapInArrow(count, "cluster int, weight int, n long, counts array<long>")


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: exact floors of the means; a centroid without vectors stays."""
    sums = F.array(*[F.sum(F.col("counts")[k]) for k in range(SIZE)])
    found = plane_counts(vectors, centroids).groupBy("cluster", "weight").agg(F.sum("n").alias("n"), sums.alias("counts")).collect()
    totals, sizes = {}, {}
    for row in found:  # one row per cluster and plane
        value = 1 << row.weight if row.weight >= 0 else -(1 << (-1 - row.weight))
        old = totals.get(row.cluster, [0] * SIZE)
        totals[row.cluster] = [a + value * b for a, b in zip(old, row.counts)]
        sizes[row.cluster] = sizes.get(row.cluster, 0) + row.n
    return [[x // sizes[c] for x in totals[c]] if sizes.get(c) else centroids[c] for c in range(len(centroids))]


def assigned(vectors: DataFrame, centroids: list[list[int]], id_column: str) -> DataFrame:
    """id, cluster and squared distance (NULL if no long holds it) of every vector."""
    targets = grouped(centroids)

    def assign(batches):
        for batch in batches:
            clusters, distances = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, object)
            for rows, words in _words(batch.column(1)):
                clusters[rows], distances[rows] = nearest(words, targets)
            fits = [int(d) if d < 1 << _LONG else None for d in distances]
            columns = [batch.column(0), pa.array(clusters), pa.array(fits, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [id_column, "cluster", "distance"])

    kept = T.StructType([vectors.schema[id_column]])
    schema = T.StructType(kept.fields + [T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    return vectors.select(f"`{id_column}`", "planes").mapInArrow(assign, schema)


def _long_sum(part: Column, rows: Column) -> Column:
    """Sum of longs as a long; NULL if one is NULL or the sum does not fit."""
    return F.when(F.count(part) == F.count(rows), F.sum(part.cast("decimal(20,0)"))).cast("decimal(38,0)")


def fitted(
    table: DataFrame, id_column: str, vector: str, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED
) -> tuple[DataFrame, list[list[int]]]:
    """(the packed vectors, the centroids after the last round)."""
    vectors = stored(packed(table, vector, [id_column]), "planes")
    centroids = first_centroids(table, id_column, vector, clusters, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(vectors, centroids)
    return vectors, centroids


def centroid_clusters(
    table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED
) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that can be used."""
    spark = table.sparkSession
    vectors, centroids = fitted(table, id_column, vector, clusters, rounds, seed)
    rows = stored(assigned(vectors, centroids or [[0] * SIZE], id_column), "assigned")
    one = F.lit(1)
    sums = rows.groupBy("cluster").agg(_long_sum(F.col("distance"), one).alias("part"), F.count(one).alias("n")).collect()
    largest = (1 << _LONG) - 1
    parts = {row.cluster: None if row.part is None else int(row.part) for row in sums}
    whole = None if None in parts.values() else sum(parts.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    fit = lambda x: None if x is None or x > largest else x
    about = spark.createDataFrame(
        [(c, fit(parts[c]), fit(whole), digests[c]) for c in sorted(parts)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    # One row per cluster.
    return rows.join(F.broadcast(about), "cluster").select(f"`{id_column}`", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


# Rounds are spelled out: R{r} holds the centroids before round r as lists of integers.
def _sql_round(r: int) -> str:
    return f"""
near{r} AS (
  SELECT vec_id, x, cluster, distance FROM (
    SELECT v.row_no, v.vec_id, v.x, c.cluster, list_sum(list_transform(list_zip(v.x, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance,
      row_number() OVER (PARTITION BY v.row_no ORDER BY list_sum(list_transform(list_zip(v.x, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.cluster) AS place
    FROM kept v, c{r} c) WHERE place = 1)"""


def _sql_move(r: int) -> str:
    return f"""
means{r} AS (
  SELECT cluster, list(m ORDER BY d) AS c FROM (
    SELECT cluster, d, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m FROM (
      SELECT cluster, d, CAST(sum(x[d]) AS BIGINT) AS s, count(*) AS n
      FROM near{r}, (SELECT unnest(range(1, 65)) AS d) GROUP BY cluster, d)) GROUP BY cluster),
c{r + 1} AS (SELECT c{r}.cluster, coalesce(means{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN means{r} ON means{r}.cluster = c{r}.cluster)"""


CLUSTER_SQL = (
    """WITH kept AS (
  SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding, lambda e: CAST(floor(CAST(e AS DOUBLE) * 64) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0),
c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS INTEGER) AS cluster, x AS c
  FROM kept ORDER BY sha256('1:' || vec_id) LIMIT 16),"""
    + ",".join(_sql_round(r) + "," + _sql_move(r) for r in range(ROUNDS))
    + ","
    + _sql_round(ROUNDS)
    + f"""
SELECT n.vec_id, n.cluster, CAST(n.distance AS BIGINT) AS distance,
  CAST(sum(n.distance) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(n.distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM near{ROUNDS} n JOIN c{ROUNDS} c ON c.cluster = n.cluster"""
)
