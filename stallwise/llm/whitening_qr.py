"""Whitening components of embeddings by shifted Cholesky QR.

Entries become whole numbers x = floor(``scale`` * c) + ``offset``; with n rows and sums S per dimension the centred row
(n*x - S) / n is exact but for one rounding. The centred rows A are factored as A = Q R by repeated Gram passes: G = Q'Q
of the rows so far, its Cholesky factor (shifted by a little in the first pass and wherever G isn't positive definite) is
applied to the rows by a triangular solve and composed into R. Passes end when G is the identity on the space of the rows.
The singular values s and right vectors w of R are those of A, so component i is w_i with eigenvalue e_i = s_i^2 / n, and a row
is whitened by projecting it on w_i and dividing by the root of e_i. The Gram matrix of the covariance itself is never
decomposed, so small eigenvalues keep their digits.

Scale. A pass reads the stored rows once; a task sends one d x d partial per vector length, a row of it at a time, and the
partials are added per row of the matrix. What reaches the driver is d x d per length; nothing there grows with the
number of rows. Rows are stored once, without other columns, and discarded by the caller with ``discard``.

Defined cases. Vectors that are null or hold null or non-finite entries take no part; vectors of each length are a fit of
their own, and empty ones have no component. x is held within +-2^44. Rows that share an id, or have none, are rows of
their own; repeated rows count as often as they occur. A component without variance (a single row, equal rows,
dependent dimensions) has a null ``whitened`` and takes no part in ``identity_error``; without any variance ``explained`` is null.
The squared distance is exact; ``deviation`` is null where it doesn't fit a long. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm.common import portions
from stallwise.session import durable

HELD = 2**44
PASSES = 12  # each gains seven digits or more; three do for anything short of dependent dimensions
LONG = 2**63


@dataclass
class Whitening:
    """Fit of one vector length. ``sums`` are exact whole numbers; ``components`` has a unit vector per column."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    usable: np.ndarray
    passes: int = 0
    error: float | None = None


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, embedding: rows whose vector can be used, as they are stored."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    return kept.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)


def whole(batch: pa.RecordBatch, scale: int, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the rows of each length, and their whole numbers."""
    column = batch.column(batch.schema.get_field_index("embedding"))
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = column.offsets.to_numpy().astype(np.int64)
    starts = starts - starts[0]
    sizes = np.diff(starts)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        entries = flat[starts[at][:, None] + np.arange(size)]
        with np.errstate(over="ignore"):
            moved = np.floor(scale * entries)
        yield at, np.clip(moved, -HELD, HELD).astype(np.int64) + offset


def from_sums(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S, exact: 64-bit where that provably fits, whole Python numbers elsewhere."""
    most = max(int(np.abs(x).max()), 1) * n + max(abs(s) for s in sums)
    if most < LONG:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def squares(d: np.ndarray) -> list[int]:
    """Exact sum of squares per row."""
    if d.dtype != object and int(np.abs(d).max()) ** 2 * d.shape[1] < LONG:
        return (d * d).sum(axis=1).tolist()
    d = d.astype(object)
    return (d * d).sum(axis=1).tolist()


def partials(rows: DataFrame, matrix: Callable[[np.ndarray], np.ndarray], scale: int, offset: int) -> dict[int, np.ndarray]:
    """Sum of ``matrix`` of the whole numbers of every batch, per vector length. Added in order of the partitions."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[int, np.ndarray] = {}
        for batch in portions(batches, "embedding"):
            for _, x in whole(batch, scale, offset):
                made = matrix(x)
                held[x.shape[1]] = held[x.shape[1]] + made if x.shape[1] in held else made
        number = TaskContext.get().partitionId()
        for dim, total in sorted(held.items()):
            k = len(total)
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim] * k, pa.int32()), "i": pa.array(range(k), pa.int32()), "part": pa.array([number] * k, pa.int32()), "row": pa.array(list(total), pa.list_(pa.float64()))})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(frame.sort_values("part")["row"].to_list()), axis=0)
        return pd.DataFrame({"dim": frame["dim"].iloc[:1], "i": frame["i"].iloc[:1], "row": [total]})

    sent = rows.select("embedding").mapInArrow(part, "dim int, i int, part int, row array<double>")
    summed = sent.groupBy("dim", "i").applyInPandas(add, "dim int, i int, row array<double>").collect()
    out: dict[int, list] = {}
    for r in sorted(summed, key=lambda r: (r.dim, r.i)):
        out.setdefault(r.dim, []).append(r.row)
    return {dim: np.array(found) for dim, found in out.items()}


def totals(rows: DataFrame, scale: int, offset: int) -> dict[int, tuple[int, list[int]]]:
    """Rows and exact sums per vector length."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in portions(batches, "embedding"):
            for at, x in whole(batch, scale, offset):
                known = held.setdefault(x.shape[1], [0, [0] * x.shape[1]])
                known[0] += len(at)
                known[1] = [a + int(b) for a, b in zip(known[1], x.sum(axis=0))]
        found = [(dim, n, i, s) for dim, (n, sums) in held.items() for i, s in enumerate(sums)]
        yield pa.RecordBatch.from_pydict({
            "dim": pa.array([f[0] for f in found], pa.int32()), "n": pa.array([f[1] for f in found], pa.int64()), "i": pa.array([f[2] for f in found], pa.int32()),
            "high": pa.array([f[3] >> 32 for f in found], pa.int64()), "low": pa.array([f[3] & (2**32 - 1) for f in found], pa.int64())})

    sent = rows.select("embedding").mapInArrow(part, "dim int, n long, i int, high long, low long")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sent.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("dim", "i").collect():
        out.setdefault(r.dim, (r.n, []))[1].append((r.high << 32) + r.low)
    return out


def solved(a: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverse of every factor in turn."""
    for factor in factors:
        a = np.linalg.solve(factor.T, a.T).T
    return a


def root(g: np.ndarray) -> np.ndarray:
    """Symmetric root of a positive semidefinite matrix."""
    values, vectors = np.linalg.eigh((g + g.T) / 2)
    return (vectors * np.sqrt(np.clip(values, 0, None))) @ vectors.T


def factored(rows: DataFrame, fits: dict[int, tuple[int, list[int]]], scale: int, offset: int) -> dict[int, tuple[np.ndarray, int]]:
    """R of the centred rows and the number of passes, per vector length."""
    factors: dict[int, list[np.ndarray]] = {dim: [] for dim in fits}
    composed = {dim: np.eye(dim) for dim in fits}
    done: dict[int, int] = {}
    for number in range(PASSES):
        now = {dim: list(factors[dim]) for dim in fits if dim not in done}
        if not now:
            break

        def gram(x: np.ndarray) -> np.ndarray:
            dim = x.shape[1]
            if dim not in now:
                return np.zeros((0, dim))
            n, sums = fits[dim]
            q = solved(from_sums(x, n, sums).astype(np.float64) / n, now[dim])
            return q.T @ q

        for dim, g in partials(rows, gram, scale, offset).items():
            if dim not in now:
                continue
            g = (g + g.T) / 2
            last = number == PASSES - 1 or (number > 0 and np.abs(g @ g - g).max() < 1e-6)
            size = float(np.abs(np.diag(g)).max())
            if size == 0:
                composed[dim], done[dim] = np.zeros((dim, dim)), number + 1
                continue
            shift = 11 * np.finfo(float).eps * (fits[dim][0] * dim + dim * (dim + 1)) * size
            shift = min(shift, 1e-8 * size)
            if last:
                try:
                    step = np.linalg.cholesky(g).T
                except np.linalg.LinAlgError:
                    step = root(g)
                done[dim] = number + 1
            elif number == 0:
                step = np.linalg.cholesky(g + shift * np.eye(dim)).T
            else:
                try:
                    step = np.linalg.cholesky(g).T
                    if np.diag(step).min() ** 2 < shift:
                        raise np.linalg.LinAlgError
                except np.linalg.LinAlgError:
                    step = np.linalg.cholesky(g + shift * np.eye(dim)).T
            factors[dim].append(step)
            composed[dim] = step @ composed[dim]
    return {dim: (composed[dim], done.get(dim, PASSES)) for dim in fits}


def fit(rows: DataFrame, most: int = 8, scale: int = 1024, offset: int = 100_000) -> dict[int, Whitening]:
    """The fit of each vector length; ``rows`` is a stored table of usable vectors. Up to ``most`` components are kept."""
    fits = totals(rows, scale, offset)
    out = {}
    for dim, (r, passes) in factored(rows, fits, scale, offset).items():
        n, sums = fits[dim]
        _, s, w = np.linalg.svd(r)
        real = s > s.max() * dim * 64 * np.finfo(float).eps
        out[dim] = Whitening(n, sums, w.T, s**2 / n, real, passes)
    judged = checked(rows, out, most, scale, offset)
    for dim, error in judged.items():
        out[dim].error = error
    return out


def projected(x: np.ndarray, of: Whitening, most: int) -> np.ndarray:
    """Whitened values of the first components, NaN without variance."""
    k = min(most, x.shape[1])
    centred = from_sums(x, of.n, of.sums).astype(np.float64) / of.n
    divisor = np.where(of.usable[:k], np.sqrt(of.eigenvalues[:k]), np.nan)
    return centred @ of.components[:, :k] / divisor


def checked(rows: DataFrame, fits: dict[int, Whitening], most: int, scale: int, offset: int) -> dict[int, float | None]:
    """Largest entry by which the covariance of the whitened rows misses the identity, per vector length."""

    def sums(x: np.ndarray) -> np.ndarray:
        return np.nan_to_num(projected(x, fits[x.shape[1]], most)).sum(axis=0)[None, :]

    means = {dim: total[0] / fits[dim].n for dim, total in partials(rows, sums, scale, offset).items()}

    def products(x: np.ndarray) -> np.ndarray:
        centred = np.nan_to_num(projected(x, fits[x.shape[1]], most)) - means[x.shape[1]]
        return centred.T @ centred

    out: dict[int, float | None] = {}
    for dim, total in partials(rows, products, scale, offset).items():
        real = fits[dim].usable[:most]
        covariance = (total / fits[dim].n)[np.ix_(real, real)]
        out[dim] = float(np.abs(covariance - np.eye(len(covariance))).max()) if len(covariance) else None
    return out


def whitened(rows: DataFrame, fits: dict[int, Whitening], most: int = 8, scale: int = 1024, offset: int = 100_000) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every row and its first components."""
    kind = rows.schema["vec_id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, x in whole(batch, scale, offset):
                of = fits[x.shape[1]]
                k = min(most, x.shape[1])
                z = projected(x, of, most).ravel()
                far = [d if d < LONG else None for d in squares(from_sums(x, of.n, of.sums))]
                trace = of.eigenvalues.sum()
                share = of.eigenvalues[:k] / trace if trace > 0 else np.full(k, np.nan)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": ids.take(pa.array(np.repeat(at, k))), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    "n": pa.array(np.full(len(z), of.n, dtype=np.int64)), "deviation": pa.array(far, pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))),
                    "whitened": pa.array(z, from_pandas=True), "explained": pa.array(np.tile(share, len(at)), from_pandas=True),
                    "identity_error": pa.array([of.error] * len(z), pa.float64())})

    return rows.mapInArrow(apply, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def components(vectors: DataFrame, most: int = 8) -> DataFrame:
    """Whitened coordinates of all usable vectors on their first components."""
    rows = durable(usable(vectors))
    return whitened(rows, fit(rows, most), most)
