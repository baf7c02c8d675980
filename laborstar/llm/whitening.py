"""Embedding whitening by shifted CholeskyQR.

1. Entries become integers x = floor(64 c) + 1000000; the fit list is every distinct x vector once. Its size n and the sums S per
   dimension are exact, so the centred row (n x - S) / n has one rounding, at the division.
2. A pass over the fit list sends every centred row through the triangular solves of the factors found so far and adds up the Gram matrix
   of the results. The first factor is the Cholesky factor of the Gram matrix plus a shift (Fukaya and others, 2020), which cannot
   break down; passes go on, unshifted where the matrix allows, until the solved rows are orthonormal (or zero, along directions the
   data do not have). No solved row is stored: a lost executor costs the rows it was reading.
3. The last Gram matrix, whose eigenvalues are all near one or near zero, is folded in by its square root. The composed factors are R
   with X'X = R'R, so the singular values and right vectors of R are those of the centred rows: components, and
   eigenvalues e = sigma^2 / n, without ever forming the covariance of ill-conditioned columns.
4. Every remaining row is projected; one more pass over the fit list measures the covariance of what came out.

A task sends one matrix of d rows, added up by row on the executors; the driver holds matrices of d x d numbers (d at most
``MAX_DIMS``), executors get them as broadcasts. Distinct vectors are combined before they are shuffled, so a vector that a third
of the rows share is one row a task.

Edge cases: null vectors and vectors with null or non-finite entries are left out; repeated ids and vectors are rows like any other; a
vector shorter than the longest one has zeros for what it lacks (also an empty one); integers beyond +-2^53 stay there;
``deviation`` is null where it exceeds a long, and for all rows if a dimension has integers cut at both ends, which would cancel; a component without variance has whitened 0 and explained 0 and does not count in
identity_error; without rows the result is empty; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborstar.llm._store import stored

SCALE, OFFSET = 64, 1_000_000
LIMIT = float(1 << 53)
COMPONENTS = 16
MAX_DIMS = 2_048
MAX_PASSES = 8
CLEAN = 1e-8            # eigenvalues of the last Gram matrix this near to one, or to zero, end the passes
ROWS = 1_000            # rows that are dense at once
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integers(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows whose vector is whole and finite, all of the longest one's length."""
    finite = F.forall("embedding", lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(c))

    def integer(c: Column) -> Column:
        return F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(LIMIT)), F.lit(-LIMIT))).cast("long") + OFFSET

    rows = stored(embeddings.where(F.col("embedding").isNotNull() & finite)
                  .select("vec_id", F.transform("embedding", integer).cast("array<long>").alias("x")), "integers")
    size = rows.agg(F.max(F.size("x")).alias("most"), F.min(F.size("x")).alias("least")).first()
    if (size["most"] or 0) > MAX_DIMS:
        raise ValueError(f"vectors of {size['most']} entries; at most {MAX_DIMS} are supported")
    if size["most"] == size["least"]:
        return rows
    lacking = F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(size["most"]) - F.size("x"))
    return rows.withColumn("x", F.concat("x", lacking))


def _dense(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of at most ROWS rows with their integers as a matrix."""
    for batch in batches:
        for i in range(0, len(batch), ROWS):
            part = batch.slice(i, ROWS)
            flat = part.column("x").flatten().to_numpy(zero_copy_only=False)
            yield part, flat.reshape(len(part), -1)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """(n x - S) / n, exact before the division; beyond the range of a long, n x and S are taken as doubles."""
    if float(np.abs(x).max(initial=0)) * n + float(np.abs(sums.astype(float)).max(initial=0)) < 2.0 ** 62:
        return (x * n - sums.astype(np.int64)) / n
    return x - (sums / n).astype(float)


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverses of the upper triangular factors, by forward substitution over the columns."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(rows.shape[1]):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def gram(fit: DataFrame, dims: int, row: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The Gram matrix of ``row`` applied to the matrices of integers of the fit list: one message per task and matrix row."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((dims, dims)), False
        for _, x in _dense(batches):
            q = row(x)
            total += q.T @ q
            some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(list(total))], names=["i", "v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}                                     # dims rows at most
        for batch in batches:
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), dims)
            for i, one in zip(batch.column("i").to_pylist(), v):
                held[i] = held[i] + one if i in held else one.copy()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(list(held.values()))], names=["i", "v"])

    schema = "i int, v array<double>"
    sent = fit.select("x").mapInArrow(part, schema).repartition("i").mapInArrow(add, schema).collect()      # dims rows
    out = np.zeros((dims, dims))
    for r in sent:
        out[r["i"]] = r["v"]
    return (out + out.T) / 2


def factor(g: np.ndarray, rows: int, first: bool) -> np.ndarray:
    """Upper Cholesky factor of a Gram matrix: plain where it is safely positive, else shifted by the bound of its rounding errors."""
    d = len(g)
    lam = np.linalg.eigvalsh(g)
    shift = 11.0 * (rows * d + d * (d + 1)) * np.finfo(float).eps / 2 * max(lam[-1], 0.0)
    if not first and lam[0] > 1e-6 * lam[-1]:
        shift = 0.0
    while True:
        try:
            return np.linalg.cholesky(g + np.eye(d) * (shift or 0.0)).T
        except np.linalg.LinAlgError:
            shift = max(shift * 100, np.finfo(float).eps * max(lam[-1], 1e-300))


class Whitening:
    """n, the sums, the components (rows, by falling eigenvalue), their eigenvalues and the trace."""

    def __init__(self, fit: DataFrame, components: int = COMPONENTS):
        spark = fit.sparkSession
        dims = fit.select(F.size("x").alias("d")).first()
        self.dims = dims["d"] if dims else 0
        sums = (fit.select(F.posexplode("x").alias("i", "x")).groupBy("i")
                .agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.min("x").alias("least"), F.max("x").alias("most"))
                .collect()) if self.dims else []                                                             # dims rows
        self.n = fit.count()
        self.sums = np.zeros(self.dims, object)
        for r in sums:
            self.sums[r["i"]] = int(r["s"])
        self.cancel = any(r["least"] - OFFSET <= -LIMIT and r["most"] - OFFSET >= LIMIT for r in sums)
        self.factors: list[np.ndarray] = []
        r = np.zeros((self.dims, self.dims))
        n, total = self.n, self.sums
        for k in range(MAX_PASSES if self.dims else 0):
            shared = spark.sparkContext.broadcast((total, list(self.factors)))
            g = gram(fit, self.dims, lambda x, s=shared: solved(centred(x, n, s.value[0]), s.value[1]))
            lam, vec = np.linalg.eigh(g)
            if k and np.all((np.abs(lam - 1) < CLEAN) | (lam < CLEAN)) or not lam[-1] > 0:
                break
            if k < MAX_PASSES - 1:
                self.factors.append(factor(g, n, not k))
        self.passes = len(self.factors)
        if self.dims:
            r = (vec * np.sqrt(np.maximum(lam, 0))) @ vec.T if self.factors else r
            for f in reversed(self.factors):
                r = r @ f
        _, sigma, right = np.linalg.svd(r)
        variance = sigma ** 2 / max(self.n, 1)
        self.trace = float(variance.sum())
        right *= np.sign(right[np.arange(len(right)), np.abs(right).argmax(1)])[:, None] if len(right) else 1.0
        keep = min(components, self.dims)
        self.e = np.where(sigma > (sigma[0] if self.dims else 0.0) * 1e-13 * self.dims, variance, 0.0)[:keep]
        with np.errstate(divide="ignore"):
            self.project = right[:keep].T * np.where(self.e > 0, 1 / np.sqrt(self.e), 0.0)
        self.explained = self.e / self.trace if self.trace else self.e * 0.0
        self.identity_error = self._error(fit) if keep else 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ self.project

    def _error(self, fit: DataFrame) -> float:
        """Largest absolute entry of the covariance of the whitened fit list less the identity."""
        shared = fit.sparkSession.sparkContext.broadcast((self.n, self.sums, self.project))

        def row(x: np.ndarray) -> np.ndarray:
            n, sums, project = shared.value
            w = centred(x, n, sums) @ project
            return np.concatenate([w, np.ones((len(w), 1))], axis=1)

        g = gram(fit, len(self.e) + 1, row) / self.n
        mean, live = g[-1, :-1], self.e > 0
        off = g[:-1, :-1] - np.outer(mean, mean) - np.eye(len(self.e))
        return float(np.abs(off[np.ix_(live, live)]).max(initial=0.0))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list:
    """Exact sums of (n x - S)^2; None beyond a long."""
    bound = (float(np.abs(x).max(initial=0)) * n + float(np.abs(sums.astype(float)).max(initial=0)))
    if bound < 2.0 ** 62:
        c = x * n - sums.astype(np.int64)
        if float(np.square(c.astype(float)).sum(1).max(initial=0)) < 2.0 ** 62:
            return np.square(c).sum(1).tolist()
        x = c.astype(object)
    else:
        x = x.astype(object) * n - sums
    exact = [sum(int(v) * int(v) for v in row) for row in x]
    return [v if v < 1 << 63 else None for v in exact]


def fit_list(rows: DataFrame) -> DataFrame:
    """Every distinct x once."""
    return stored(rows.select("x").groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit-list")


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = integers(embeddings)
    found = Whitening(fit_list(rows), components)
    spark = embeddings.sparkSession
    shared = spark.sparkContext.broadcast((found.n, found.sums, found.project, found.explained, found.identity_error, found.cancel))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, matrix, explained, error, cancel = shared.value
        k = matrix.shape[1]
        for part, x in _dense(batches):
            if not k:
                continue
            w = (centred(x, n, sums) @ matrix).ravel()
            every = np.repeat(np.arange(len(part)), k)
            far = [None] * len(part) if cancel else deviations(x, n, sums)
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id").cast(pa.int64()).take(pa.array(every)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                pa.array(np.full(len(w), n)), pa.array(far, pa.int64()).take(pa.array(every)), pa.array(w),
                pa.array(np.tile(explained, len(part))), pa.array(np.full(len(w), error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, OUT)
