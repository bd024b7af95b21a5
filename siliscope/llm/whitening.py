"""Embedding whitening: blockwise QR, bidiagonal form, dqds, twisted factorisations.

Entries become integers. Every distinct vector counts once; the rows n*x - S, exact integers, are reduced to one
triangular matrix by QR factorisations of blocks of rows, then of pairs of triangles, level by level. The squared
singular values of that triangle are the eigenvalues of the covariance, its right singular vectors the directions; the
covariance itself, which would square the condition number, is never formed.

The distinct vectors are written once to the shared folder; copies meet in the aggregation before the shuffle, so a
vector that fills the table is one row a task. A task sends one triangle of the width of a vector. The driver holds one
number per dimension and component.

Rows whose vector is NULL or holds NULL or non-finite entries are left out. The vectors of one covariance have one
length, the most frequent one (of equally frequent ones the longer); rows of another length stay in the result with
NULL for deviation and whitened. Ids may be NULL or repeated, equal rows give equal rows. A component without variance
has whitened NULL and explained 0 (NULL if there is no variance at all) and is left out of identity_error; a deviation
that no long holds is NULL. Entries beyond the longs are the largest long. Empty vectors and empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bit_planes import usable
from .common import stored
from .singular_values import EPS, leading_directions

SCALE = 256
COMPONENTS = 4
_CHUNK = 2048  # rows of a block of the QR factorisation
_FAN_IN = 8  # triangles that one task joins
_LONG = 63
LONGS = T.ArrayType(T.LongType())


@dataclass(frozen=True)
class Whitening:
    """What a row needs to be whitened: number and sums of the fit list, directions as columns, eigenvalues, shares."""

    n: int
    sums: list[int]
    directions: np.ndarray
    values: list[float]
    explained: list[float | None]

    @property
    def size(self) -> int:
        return len(self.sums)


def as_longs(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * c) of every entry."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def usable_rows(table: DataFrame, id_column: str, vector: str, scale: int = SCALE) -> DataFrame:
    """The id and ``x``, the integers, of every row that can be used."""
    good = table.filter(usable(F.col(f"`{vector}`")))
    return good.select(F.col(f"`{id_column}`"), as_longs(F.col(f"`{vector}`"), scale).alias("x"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S exactly: int64, or Python integers if one could be too large."""
    limit = 1 << 62
    largest = max(int(x.max()), -int(x.min()), 0) if x.size else 0
    if n * largest + max(map(abs, sums), default=0) < limit:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def column_sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Rows of the fit list and the sums of its columns, exact; a task sends one row per column."""

    def add(batches):
        n, total = 0, [0] * size
        for batch in batches:
            x = _matrix(batch.column(0), size)
            n += len(x)
            high, low = x >> 32, x & 0xFFFFFFFF  # sums of halves cannot overflow
            total = [t + (h << 32) + lo for t, h, lo in zip(total, high.sum(axis=0).tolist(), low.sum(axis=0).tolist())]
        columns = [pa.array([n] * size, pa.int64()), pa.array(range(size), pa.int32()), pa.array(map(str, total), pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["n", "place", "total"])

    parts = fit.select("x").mapInArrow(add, "n long, place int, total string")
    found = parts.groupBy("place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    sums = {row.place: int(row.total) for row in found}
    return (found[0].n if found else 0), [sums.get(k, 0) for k in range(size)]


def _stacked(upper: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    """The triangle of the rows below the triangle so far."""
    return np.linalg.qr(rows if upper is None else np.vstack([upper, rows]), mode="r")


def triangles(fit: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """part, r: one triangular factor of the centred rows of each partition, as bytes."""
    size = len(sums)

    def factor(batches):
        from pyspark import TaskContext

        upper = None
        for batch in batches:
            x = _matrix(batch.column(0), size)
            for start in range(0, len(x), _CHUNK):
                upper = _stacked(upper, centred(x[start : start + _CHUNK], n, sums).astype(np.float64) / n)
        if upper is not None:
            part = pa.array([TaskContext.get().partitionId()], pa.int64())
            yield pa.RecordBatch.from_arrays([part, pa.array([upper.tobytes()], pa.binary())], ["part", "r"])

    return fit.select("x").mapInArrow(factor, "part long, r binary")


def joined_triangle(parts: DataFrame, size: int, many: int) -> DataFrame:
    """One row with the triangular factor of all triangles, joined ``_FAN_IN`` at a time."""

    def join(key, group):
        upper = None
        for r in group.sort_values("part")["r"]:
            upper = _stacked(upper, np.frombuffer(r).reshape(-1, size))
        import pandas as pd

        return pd.DataFrame({"part": [key[0]], "r": [upper.tobytes()]})

    parts = stored(parts, "triangles")
    while True:
        parts = parts.groupBy(F.floor(F.col("part") / _FAN_IN).alias("part")).applyInPandas(join, "part long, r binary")
        many = -(-many // _FAN_IN)
        if many <= 1:
            return parts
        parts = stored(parts, "triangles")


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> tuple[Whitening, DataFrame] | None:
    """(the whitening of the rows' integers, the fit list), or None without rows."""
    sizes = rows.filter(F.size("x") > 0).groupBy(F.size("x").alias("size")).count()
    usual = sizes.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not usual:
        return None
    size = usual[0]["size"]
    fit = stored(rows.filter(F.size("x") == size).select("x").distinct(), "fit")
    n, sums = column_sums(fit, size)
    found = joined_triangle(triangles(fit, n, sums), size, fit.rdd.getNumPartitions()).collect()
    upper = np.frombuffer(found[0].r).reshape(-1, size)  # one matrix of the width of a vector
    squares, directions = leading_directions(upper if len(upper) >= size else np.vstack([upper, np.zeros((size - len(upper), size))]), components)
    total = float(squares.sum())
    least = squares[0] * (16 * size * EPS) ** 2
    real = [float(v) if v > least else 0.0 for v in squares[: directions.shape[1]]]
    signs = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(directions.shape[1])])
    shares = [v / total if total else None for v in real]
    return Whitening(n, sums, directions * np.where(signs == 0, 1.0, signs), [v / n for v in real], shares), fit


def _project(model: Whitening, x: np.ndarray) -> tuple[list[int | None], np.ndarray]:
    """(deviation, whitened) of rows of integers; components without variance are NaN."""
    off = centred(x, model.n, model.sums)
    values = np.array([v if v > 0 else np.nan for v in model.values])
    whitened = (off.astype(np.float64) / model.n) @ model.directions / np.sqrt(values)
    if off.dtype == np.int64 and (not off.size or np.abs(off).max() < 1 << ((62 - model.size.bit_length()) // 2)):
        return (off * off).sum(axis=1).tolist(), whitened
    exact = (off.astype(object) ** 2).sum(axis=1)
    return [int(d) if d < 1 << _LONG else None for d in exact], whitened


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest entry of (covariance of the whitened fit list - identity), over the components that have variance."""
    live = [k for k, v in enumerate(model.values) if v > 0]
    if not live:
        return None

    def project(batches):
        for batch in batches:
            _, whitened = _project(model, _matrix(batch.column(0), model.size))
            yield pa.RecordBatch.from_arrays([pa.array(whitened[:, k]) for k in live], [f"w{k}" for k in live])

    values = fit.select("x").mapInArrow(project, ", ".join(f"w{k} double" for k in live))
    pairs = [(a, b) for a in live for b in live if a <= b]
    covariances = values.agg(*[F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(covariances[f"c{a}_{b}"] - float(a == b)) for a, b in pairs)


def whitened(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error: one row per usable row and component."""
    rows = usable_rows(table, id_column, vector, scale)
    kept = T.StructField(id_column, rows.schema[id_column].dataType)
    more = [("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()), ("explained", T.DoubleType())]
    schema = T.StructType([kept, *[T.StructField(name, kind) for name, kind in more], T.StructField("identity_error", T.DoubleType())])
    fitted = fit_whitening(rows, components)
    if fitted is None:
        return table.sparkSession.createDataFrame([], schema)
    model, fit = fitted
    error, count = identity_error(fit, model), len(model.values)

    def whiten(batches):
        for batch in batches:
            total = batch.num_rows
            right = np.asarray(batch.column(2)) == model.size
            deviations, values = [None] * total, np.full((total, count), np.nan)
            if right.any():
                places = np.flatnonzero(right)
                found, values[places] = _project(model, _matrix(batch.column(1).filter(pa.array(right)), model.size))
                for place, deviation in zip(places, found):
                    deviations[place] = deviation
            again = pa.array(np.repeat(np.arange(total), count))
            flat = values.reshape(-1)
            columns = [
                batch.column(0).take(again),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), total)),
                pa.array(np.full(total * count, model.n, np.int64)),
                pa.array(deviations, pa.int64()).take(again),
                pa.array(flat, mask=np.isnan(flat)),
                pa.array(model.explained * total, pa.float64()),
                pa.array([error] * (total * count), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.filter(F.size("x") > 0).select(f"`{id_column}`", "x", F.size("x").alias("size")).mapInArrow(whiten, schema)
