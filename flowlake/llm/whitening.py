"""Whitening of embeddings with a covariance found by polarisation.

Entries become integers ``x = floor(scale * c) + offset``. The variance of each dimension and of
the sum of each two dimensions is an aggregate of exact integer squares; half of what a sum's
variance exceeds its parts' by is their covariance:
``2 cov(i, j) = var(i + j) - var(i) - var(j)``.

Centring is exact. Entries are taken from the whole number ``m`` nearest to their dimension's
mean, ``c = x - m``; with ``r = S - n m`` the sum of ``(n x - S)`` squared is
``n (n * sum c^2 - r^2)``, in integers without bound. Tasks send one partial sum per dimension and
pair, Spark adds them up, and the driver gets D (D + 1) / 2 numbers, whatever the number of rows.

Defined results: vectors that are null or hold null, NaN or entries that are not finite in single
precision take no part, nor do vectors of another width than the most frequent one (of equally
frequent ones the least); repeated rows and rows with a null id count like any other; no vectors
or vectors without entries give no rows; a component whose eigenvalue is zero up to rounding
(below ``LEAST_VALUE`` of the largest) has no whitened values and is left out, so a table of equal
vectors has no component; ``deviation`` is null where it exceeds a long. Only the id and the
vector are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a batch whose pair sums are formed at once, and the largest entry for which the sum
#: of that many squares of two entries' sum stays below 2^63.
ROWS = 1 << 15
NARROW = 1 << 22
#: Entries from here on are infinite in single precision.
INFINITE = 2.0 ** 128
#: Sums cross Spark as three decimals, parts to this base: no sum of squares is too large.
BASE = 10 ** 30
#: Part of the largest eigenvalue below which rounding would show in the whitened values.
LEAST_VALUE = 1e-11


@dataclass(frozen=True)
class Whitener:
    """What a fit leaves: row count, sums, and components by falling eigenvalue."""

    rows: int
    sums: tuple[int, ...]
    covariance: np.ndarray
    values: np.ndarray
    components: np.ndarray  # one per row

    @property
    def explained(self) -> np.ndarray:
        return self.values / np.trace(self.covariance)



def middles_of(rows: int, sums: tuple[int, ...]) -> np.ndarray:
    """Whole numbers nearest to the means."""
    return narrow(np.array([(2 * s + rows) // (2 * rows) for s in sums], object), 1 << 62)


def usable(vectors: DataFrame, id_column: str = "vec_id",
           vector_column: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the vectors that take part, entries as double."""
    v = F.col(vector_column).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < INFINITE))
    whole = vectors.select(F.col(id_column).alias("vec_id"), v.alias("vector")).where(
        F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)))
    widths = whole.groupBy(F.size("vector").alias("width")).count().orderBy(
        F.desc("count"), "width").limit(1).collect()
    if not widths or not widths[0]["width"]:
        return whole.where("false")
    return whole.where(F.size("vector") == widths[0]["width"])


def integers(batch: pa.RecordBatch, scale: int, offset: int) -> np.ndarray:
    """The batch's vectors as whole numbers: int64, or Python's where these do not fit."""
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    values = np.floor(flat * float(scale)).reshape(batch.num_rows, -1)
    if np.abs(values).max(initial=0) < 2.0 ** 62:
        return values.astype(np.int64) + offset
    # The exact floor also where scaling leaves the range of a double.
    exact = [int(c * scale // 1) if abs(c) < 2.0 ** 52 else int(c) * scale for c in flat.tolist()]
    return np.array(exact, object).reshape(values.shape) + offset


def blocks(batches: Iterator[pa.RecordBatch], scale: int, offset: int,
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, integers(part, scale, offset)


def narrow(values: np.ndarray, limit: int) -> np.ndarray:
    """int64 where all values are below ``limit``, Python's whole numbers elsewhere."""
    if values.size and max(abs(int(values.min())), abs(int(values.max()))) >= limit:
        return values.astype(object)
    return values.astype(np.int64)


def _totals(frame: DataFrame, partials, keys: list[str]) -> dict:
    """Sums over tasks of the whole numbers that ``partials`` yields as ``(keys..., number)``."""
    parts = ["low", "middle", "high"]
    kinds = [*(f"{k} int" for k in keys), *(f"{p} decimal(38,0)" for p in parts)]

    def emit(batches):
        rows = []
        for *key, number in partials(batches):
            rest, low = divmod(number, BASE)
            high, middle = divmod(rest, BASE)
            rows.append((*key, Decimal(low), Decimal(middle), Decimal(high)))
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int32()) for c in columns[:len(keys)]),
             *(pa.array(c, pa.decimal128(38, 0)) for c in columns[len(keys):])], [*keys, *parts])

    sums = (frame.mapInArrow(emit, ", ".join(kinds))
            .groupBy(*keys).agg(*(F.sum(p).alias(p) for p in parts)))
    return {tuple(row[k] for k in keys):
            int(row["low"]) + BASE * (int(row["middle"]) + BASE * int(row["high"]))
            for row in sums.collect()}


def sums_of(frame: DataFrame, scale: int, offset: int) -> tuple[int, tuple[int, ...]]:
    """Number of vectors and the sum of each dimension."""

    def partials(batches):
        rows, total = 0, None
        for _, x in blocks(batches, scale, offset):
            part = narrow(x, 1 << 47).sum(0).astype(object)
            rows, total = rows + len(x), part if total is None else total + part
        if rows:
            yield -1, rows
            yield from ((i, int(v)) for i, v in enumerate(total))

    found = _totals(frame, partials, ["i"])
    if not found:
        return 0, ()
    return found[(-1,)], tuple(found[(i,)] for i in range(len(found) - 1))


def squares_of(frame: DataFrame, middles: np.ndarray, scale: int, offset: int) -> dict:
    """``(i, j)`` to the sum of squares of dimension i, or of dimensions i and j added (i < j)."""
    width = len(middles)

    def partials(batches):
        total = None
        for _, x in blocks(batches, scale, offset):
            c = narrow(x - middles, NARROW)
            part = [np.square(c).sum(0).astype(object)]
            part += [np.square(c[:, :-d] + c[:, d:]).sum(0).astype(object)
                     for d in range(1, width)]
            total = part if total is None else [a + b for a, b in zip(total, part, strict=True)]
        for d, part in enumerate(total or ()):
            yield from ((i, i + d, int(v)) for i, v in enumerate(part))

    return _totals(frame, partials, ["i", "j"])


def covariance_of(rows: int, sums: tuple[int, ...], middles: np.ndarray, squares: dict,
                  ) -> np.ndarray:
    """Covariance with divisor ``rows``, each entry the double nearest to the exact value."""
    width = len(sums)
    rest = [s - rows * int(m) for s, m in zip(sums, middles, strict=True)]
    # n^2 times the variance of each dimension and of each sum of two.
    own = [rows * squares[i, i] - rest[i] ** 2 for i in range(width)]
    out = np.empty((width, width))
    for i in range(width):
        out[i, i] = own[i] / rows ** 2
        for j in range(i + 1, width):
            both = rows * squares[i, j] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * rows ** 2)
    return out


def fitted(frame: DataFrame, scale: int = 64, offset: int = 1_000_000) -> Whitener | None:
    """Covariance and components of all vectors of ``usable``; None if there are none."""
    rows, sums = sums_of(frame, scale, offset)
    if not rows:
        return None
    middles = middles_of(rows, sums)
    covariance = covariance_of(rows, sums, middles, squares_of(frame, middles, scale, offset))
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1].T
    real = values > max(values[0], 0.0) * LEAST_VALUE
    return Whitener(rows, sums, covariance, values[real], np.ascontiguousarray(vectors[real]))


def centred(x: np.ndarray, fit: Whitener) -> tuple[np.ndarray, np.ndarray]:
    """``n x - S`` in whole numbers, and ``x - S / n``."""
    middles = middles_of(fit.rows, fit.sums)
    rest = np.array([s - fit.rows * int(m) for s, m in zip(fit.sums, middles, strict=True)],
                    object)
    c = narrow(x - middles, NARROW)
    plain = c.astype(float) - np.array([r / fit.rows for r in rest])
    if fit.rows >= 1 << 38:
        c = c.astype(object)
    return c * fit.rows - narrow(rest, 1 << 62), plain


def deviations(scaled: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exact; None beyond a long."""
    limit = int((2 ** 62 / scaled.shape[1]) ** 0.5)
    totals = np.square(narrow(scaled, limit)).sum(1).tolist()
    return [t if t < 1 << 63 else None for t in totals]


def whiten(x: np.ndarray, fit: Whitener, count: int) -> np.ndarray:
    """Whitened values of the first ``count`` components, one row per vector."""
    _, plain = centred(x, fit)
    return plain @ (fit.components[:count].T / np.sqrt(fit.values[:count]))


def identity_error(frame: DataFrame, fit: Whitener, count: int, scale: int = 64,
                   offset: int = 1_000_000) -> float:
    """Largest entry of the whitened values' covariance less the identity, of all vectors."""
    count = min(count, len(fit.values))

    def partials(batches):
        total, moments = np.zeros(count), np.zeros((count, count))
        for _, x in blocks(batches, scale, offset):
            w = whiten(x, fit, count)
            total += w.sum(0)
            moments += w.T @ w
        i, j = np.triu_indices(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, np.full(count, -1)), pa.int32()),
             pa.array(np.append(j, np.arange(count)), pa.int32()),
             pa.array(np.append(moments[i, j], total))], ["i", "j", "total"])

    sums = (frame.mapInArrow(partials, "i int, j int, total double")
            .groupBy("i", "j").agg(F.sum("total").alias("total"))).collect()
    found = {(r["i"], r["j"]): r["total"] / fit.rows for r in sums}
    return max(abs(v - found[-1, i] * found[-1, j] - (i == j))
               for (i, j), v in found.items() if i >= 0)


def whitened(vectors: DataFrame, count: int = 32, scale: int = 64, offset: int = 1_000_000,
             id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per vector and component, by falling eigenvalue up to ``count``.

    ``vec_id, component, n, deviation, whitened, explained, identity_error``. ``vectors`` is read
    by five small passes, so it should be a table; the driver holds one covariance matrix.
    """
    frame = usable(vectors, id_column, vector_column)
    fit = fitted(frame, scale, offset)
    id_type = frame.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {id_type}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    if fit is None or not len(fit.values):
        return frame.sparkSession.createDataFrame([], schema)
    count = min(count, len(fit.values))
    error = identity_error(frame, fit, count, scale, offset)
    explained = fit.explained[:count]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in blocks(batches, scale, offset):
            scaled, _ = centred(x, fit)
            rows = np.repeat(np.arange(len(x)), count)
            ids = part.column("vec_id").take(pa.array(rows))
            deviation = pa.array(deviations(scaled), pa.int64()).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                 deviation, pa.array(whiten(x, fit, count).ravel()),
                 pa.array(np.tile(explained, len(x)))],
                ["vec_id", "component", "deviation", "whitened", "explained"])

    found = frame.mapInArrow(
        project, f"vec_id {id_type}, component int, deviation long, whitened double, "
                 "explained double")
    return found.select("vec_id", "component", F.lit(fit.rows).cast("long").alias("n"),
                        "deviation", "whitened", "explained",
                        F.lit(error).alias("identity_error"))
