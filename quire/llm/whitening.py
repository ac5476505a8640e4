"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor.

Spark scales, deduplicates and sums; tasks turn their rows into partial scatter matrices with
NumPy, and Spark adds these. Only sums whose size is fixed by the dimension (d and d * d numbers)
come to the driver. There the scatter is factored as L L', columns of L are rotated until they are
orthogonal: their squared norms are the eigenvalues of the scatter, the normalised columns its
eigenvectors. A last pass projects every row.

Entries are whole numbers and are centred by whole numbers next to their means, so products and
sums are exact and the same for every partitioning; the remaining fraction of the mean is taken
off exactly. Only entries that lie more than about 10^8 apart are summed as doubles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import written

#: Components that are given out at most.
COMPONENTS = 16
SCALE = 64
#: Added to every scaled entry; a missing entry of a short vector counts as 0 before it.
SHIFT = 1_000_000
#: Scaled entries are held at these limits.
LIMIT = 2.0**61
#: Rows that a task multiplies at a time.
BLOCK_ROWS = 4_096

_DOUBLE_EXACT = 2**53
_LONG = 2**63


@dataclass(frozen=True)
class Fit:
    """Sums over the fit list and the components: what whitening a row needs."""

    n: int
    base: list[int]  # whole numbers next to the means
    rest: list[int]  # sums of the entries less ``base``: the mean is base + rest / n
    spread: int  # the largest distance of an entry from ``base``
    vectors: np.ndarray  # (d, k): unit eigenvectors by falling eigenvalue
    values: np.ndarray  # (k,): eigenvalues of the covariance
    trace: float


def scaled(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, x): entries as floor(64 * c) + 1000000; rows with a null or non-finite entry or a null vector are left out.

    Short vectors are filled with zero entries up to the longest one. Scaled entries beyond 2^61
    are held there.
    """
    parts = F.col(vector).cast("array<double>")
    usable = parts.isNotNull() & F.forall(parts, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    held = F.transform(parts, lambda c: F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), c * SCALE))) + F.lit(SHIFT))
    rows = df.where(usable).select(F.col(key).alias("id"), held.alias("x"))
    width = df.where(usable).agg(F.max(F.size(vector)).alias("d")).first()["d"] or 0
    return rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(SHIFT).cast("bigint"), F.lit(width) - F.size("x"))))


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) and len(flat) else np.zeros((len(column), 0), np.int64)


def _per_task(x: DataFrame, start: Callable, add: Callable, schema: str, give: Callable) -> DataFrame:
    """One state per task: ``add(state, rows)`` for each block of rows, then ``give(state)`` as a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, seen = start(), False
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                state, seen = add(state, _matrix(batch.column(0).slice(at, BLOCK_ROWS))), True
        if seen:
            yield give(state)

    return x.select("x").mapInArrow(run, schema)


def _sums(x: DataFrame, width: int) -> tuple[int, list[int], list[int], list[int]]:
    """Number of rows, and per dimension the exact sum, least and largest entry."""
    half = np.int64(32)

    def start():
        zero = np.zeros(width, np.int64)
        return 0, zero, zero, zero + np.iinfo(np.int64).max, zero + np.iinfo(np.int64).min

    def add(state, rows):
        n, high, low, least, most = state
        return (
            n + len(rows), high + (rows >> half).sum(axis=0), low + (rows & np.int64(2**32 - 1)).sum(axis=0),
            np.minimum(least, rows.min(axis=0)), np.maximum(most, rows.max(axis=0)),
        )

    def give(state):
        n, *arrays = state
        columns = [pa.array(np.arange(width, dtype=np.int32)), pa.array(np.full(width, n)), *map(pa.array, arrays)]
        return pa.RecordBatch.from_arrays(columns, ["i", "n", "high", "low", "least", "most"])

    parts = _per_task(x, start, add, "i int, n bigint, high bigint, low bigint, least bigint, most bigint", give)
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), total("high"), total("low"), F.min("least").alias("least"), F.max("most").alias("most")).orderBy("i").collect()
    sums = [(int(r["high"]) << 32) + int(r["low"]) for r in rows]
    return (rows[0]["n"] if rows else 0), sums, [r["least"] for r in rows], [r["most"] for r in rows]


def _products(x: DataFrame, width: int, centred: Callable[[np.ndarray], np.ndarray], exact_rows: int) -> list[list]:
    """Sums of products of all pairs of centred entries: whole numbers if ``exact_rows``, which bounds what a double sums exactly."""
    kind, sql = (np.int64, "bigint") if exact_rows else (np.float64, "double")

    def add(state, rows):
        step = exact_rows or len(rows)
        for at in range(0, len(rows), step):
            block = centred(rows[at : at + step])
            state = state + (block.T @ block).astype(kind)
        return state

    def give(state):
        offsets = pa.array(np.arange(width + 1, dtype=np.int32) * width)
        columns = [pa.array(np.arange(width, dtype=np.int32)), pa.ListArray.from_arrays(offsets, pa.array(state.ravel()))]
        return pa.RecordBatch.from_arrays(columns, ["i", "row"])

    parts = _per_task(x, lambda: np.zeros((width, width), kind), add, f"i int, row array<{sql}>", give)
    cells = parts.select("i", F.posexplode("row").alias("j", "v"))
    value = F.col("v").cast("decimal(38,0)") if exact_rows else F.col("v")
    out = [[0] * width for _ in range(width)]
    for r in cells.groupBy("i", "j").agg(F.sum(value).alias("v")).collect():
        out[r["i"]][r["j"]] = int(r["v"]) if exact_rows else r["v"]
    return out


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """(d, r) with a = L L', of the numerical rank r; its rows are lower triangular in the order of the pivots."""
    left, d = a.astype(np.float64).copy(), len(a)
    tiny = np.finfo(np.float64).eps * max(d, 1) * left.diagonal().max(initial=0.0)
    columns = []
    for _ in range(d):
        pivot = int(left.diagonal().argmax())
        if left[pivot, pivot] <= tiny:
            break
        column = left[:, pivot] / np.sqrt(left[pivot, pivot])
        left -= np.outer(column, column)
        left[pivot, :] = left[:, pivot] = 0.0
        columns.append(column)
    return np.array(columns).T.reshape(d, len(columns))


def orthogonal_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """One-sided Jacobi: the columns rotated in pairs until all are orthogonal; each round takes disjoint pairs."""
    w = factor.copy()
    r = w.shape[1]
    if r < 2:
        return w
    players = list(range(r + r % 2))  # the last one of an odd number sits out
    rounds = []
    for _ in range(len(players) - 1):
        half = len(players) // 2
        pairs = [(min(a, b), max(a, b)) for a, b in zip(players[:half], reversed(players[half:]), strict=True)]
        rounds.append(np.array([p for p in pairs if p[1] < r]).T)
        players = [players[0], players[-1], *players[1:-1]]
    for _ in range(sweeps):
        worst = 0.0
        for p, q in rounds:
            a, b = w[:, p], w[:, q]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            off = np.abs(ab) / np.sqrt(np.maximum(aa * bb, np.finfo(np.float64).tiny))
            worst = max(worst, float(off.max()))
            turn = off > 1e-16
            zeta = np.divide(bb - aa, 2 * ab, out=np.zeros_like(ab), where=turn)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            w[:, p], w[:, q] = c * a - c * t * b, c * t * a + c * b
        if worst < 1e-15:
            break
    return w


def components(scatter: np.ndarray, n: int, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors (d, k) and eigenvalues of ``scatter`` / ``n`` by falling value; fewer at a lower rank.

    Of the two signs the one is taken that makes the entry of largest size positive.
    """
    w = orthogonal_columns(pivoted_cholesky(scatter))
    norms = np.sqrt((w * w).sum(axis=0))
    order = np.argsort(-norms, kind="stable")[:k]
    vectors = w[:, order] / norms[order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]) if len(order) else np.zeros(0)
    return vectors * signs, norms[order] ** 2 / n


def fit(distinct: DataFrame, k: int = COMPONENTS) -> Fit:
    """Sums and components over ``distinct`` (x): vectors of one width, each once. Empty input has no components."""
    first = distinct.select(F.size("x").alias("d")).first()
    width = first["d"] if first else 0
    n, sums, least, most = _sums(distinct, width) if width else (0, [], [], [])
    if not n:
        return Fit(0, [], [], 0, np.zeros((0, 0)), np.zeros(0), 0.0)
    base = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * b for s, b in zip(sums, base, strict=True)]
    spread = max(max(abs(a - b), abs(z - b)) for a, b, z in zip(least, base, most, strict=True))
    exact_rows = min(BLOCK_ROWS, _DOUBLE_EXACT // max(spread * spread, 1)) if n * spread * spread < _LONG else 0
    offset = np.array(base, np.int64)
    part = np.array([r / n for r in rest]) if not exact_rows else np.zeros(width)
    products = _products(distinct, width, lambda rows: (rows - offset).astype(np.float64) - part, exact_rows)
    if exact_rows:
        scatter = np.array([[(n * products[i][j] - rest[i] * rest[j]) / n for j in range(width)] for i in range(width)])
    else:
        scatter = np.array(products, np.float64)
        scatter = (scatter + scatter.T) / 2
    vectors, values = components(scatter, n, k)
    return Fit(n, base, rest, spread, vectors, values, float(scatter.trace()) / n)


def _projected(rows: np.ndarray, fitted: Fit) -> np.ndarray:
    part = np.array([r / fitted.n for r in fitted.rest])
    centred = (rows - np.array(fitted.base, np.int64)).astype(np.float64) - part
    return centred @ (fitted.vectors / np.sqrt(fitted.values))


def identity_error(distinct: DataFrame, fitted: Fit) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance less the identity; None without components."""
    k = len(fitted.values)
    if not k:
        return None

    # Projections are centred already; the rest of their mean, left by rounding, is taken off as well.
    def start():
        return np.zeros((k + 1, k))

    def add(state, rows):
        z = _projected(rows, fitted)
        return state + np.vstack([z.T @ z, z.sum(axis=0)])

    def give(state):
        offsets = pa.array(np.arange(k + 2, dtype=np.int32) * k)
        columns = [pa.array(np.arange(k + 1, dtype=np.int32)), pa.ListArray.from_arrays(offsets, pa.array(state.ravel()))]
        return pa.RecordBatch.from_arrays(columns, ["i", "row"])

    parts = _per_task(distinct, start, add, "i int, row array<double>", give)
    found = np.zeros((k + 1, k))
    for r in parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        found[r["i"], r["j"]] = r["v"]
    mean = found[k] / fitted.n
    return float(np.abs(found[:k] / fitted.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(rows: np.ndarray, fitted: Fit) -> list:
    """Exact sums of squares of n * x - S; None beyond 64 bits."""
    base, rest = np.array(fitted.base, np.int64), fitted.rest
    if len(rest) * (2 * fitted.n * max(fitted.spread, 1)) ** 2 < _LONG:
        off = (rows - base) * fitted.n - np.array(rest, np.int64)
        return (off * off).sum(axis=1).tolist()
    off = (rows - base).astype(object) * fitted.n - np.array(rest, object)
    return [s if s < _LONG else None for s in (off * off).sum(axis=1)]


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): ``k`` rows per usable row of ``df``.

    The fit list holds each distinct scaled vector once: repeated rows weigh nothing more, but all
    of them are given out. ``n`` is its length, ``whitened`` the projection of the centred scaled
    vector on the component over the root of its eigenvalue, ``explained`` the eigenvalue's share
    of the trace, ``deviation`` the exact sum of squares of n * x - S (null beyond 64 bits). There
    are at most as many components as the covariance has rank, so a single distinct vector, or an
    empty table, gives no rows. Equal eigenvalues have some orthogonal basis of their space. Rows
    with a null key stay. Vectors that are null or hold a null or non-finite entry take no part.
    """
    rows = scaled(df, key, vector)
    distinct = written(rows.select("x").distinct(), "whitening-vectors")
    fitted = fit(distinct, k)
    error, explained = identity_error(distinct, fitted), (fitted.values / fitted.trace if len(fitted.values) else fitted.values)
    k = len(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows if k else 0, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x, m = _matrix(part.column(1)), part.num_rows
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(_deviations(x, fitted), pa.int64()).take(each),
                    pa.array(_projected(x, fitted).ravel()), pa.array(np.tile(explained, m)),
                ], ["id", "component", "deviation", "whitened", "explained"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, component int, deviation bigint, whitened double, explained double")
    return out.select(
        F.col("id").alias(key), "component", F.lit(fitted.n).cast("bigint").alias("n"), "deviation", "whitened", "explained",
        F.lit(error).cast("double").alias("identity_error"),
    )
