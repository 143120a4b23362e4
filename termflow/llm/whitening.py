"""Whitening of embeddings by principal components, found by QDWH spectral
divide and conquer.

The entries of a vector become whole numbers, floor(256 * c). The fit list holds
each distinct vector once. Its size, sums and products are sums of whole
numbers, taken around a whole number near the mean, so the covariance is the
exact one rounded once, whatever the partitions. Tasks add up d x d partial sums;
these meet row by row of the matrix. What reaches the driver is d x d and does not
grow with the table.

The eigenvectors come from polar decompositions. The polar factor U of V - sI
(QR- or Cholesky-based dynamically weighted Halley iterations) gives the spectral
projector (U + I) / 2 on all eigenvalues above s. It splits the space in two
invariant subspaces, in which the work goes on until they have one
dimension, or all their eigenvalues are equal to rounding. The components that
are asked for are broadcast (d numbers each), and every row is whitened
where it is.

Defined results: rows whose vector is null or holds null or non-finite entries
drop out, whatever their id; other ids, null and repeated ones too, are kept, a
row for each. Vectors of each length have a fit of their own; an empty vector has
no components and so no rows. A component whose eigenvalue is 0 to rounding
(one distinct vector, or fewer than dimensions) has a null ``whitened`` and
an ``explained`` of 0 (null where all variance is 0), and takes no part in
``identity_error``. Equal eigenvalues: any orthonormal basis of their space.
``deviation`` is null where it does not fit a bigint. An empty table gives no rows;
other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from termflow.llm.common import drop_written, source, written

COMPONENTS = 4
EPS = np.finfo(float).eps
OUT = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
       "identity_error double")


# -- eigenvectors ---------------------------------------------------------------

def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix that is not singular."""
    x = a / np.linalg.norm(a, "fro")
    low, eye = EPS, np.eye(len(a))
    for _ in range(30):
        if low >= 1:
            wa, wb, wc = 3.0, 1.0, 3.0
        else:
            d = np.cbrt(4 * (1 - low**2) / low**4)
            wa = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + d))) / 2
            wb = (wa - 1) ** 2 / 4
            wc = wa + wb - 1
        if wc > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))[0]
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:len(a)] @ q[len(a):].T
        else:
            r = np.linalg.cholesky(eye + wc * x.T @ x)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(r.T, np.linalg.solve(r, x.T)).T
        low = min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x, "fro"), new
        if low > 1 - 10 * EPS and moved < 1e-13 * len(a):
            break
    return x


def split(a: np.ndarray, s: float, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces of the eigenvalues above and
    below ``s``; None where ``s`` does not part them cleanly."""
    n = len(a)
    projector = (polar_factor(a - s * np.eye(n)) + np.eye(n)) / 2
    k = int(round(np.trace(projector)))
    if not 0 < k < n or abs(np.trace(projector) - k) > 1e-6:
        return None
    # A basis of the range: subspace iteration from the columns that stand out most.
    start = projector[:, np.argsort(-np.diag(projector))[:k]]
    for _ in range(3):
        q = np.linalg.qr(start, mode="complete")[0]
        start = projector @ q[:, :k]
    q = np.linalg.qr(start, mode="complete")[0]
    above, below = q[:, :k], q[:, k:]
    if np.linalg.norm(below.T @ a @ above) > 100 * n * EPS * scale:
        return None
    return above, below


def eigenvectors(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    v = (v + v.T) / 2
    scale = np.linalg.norm(v, "fro")
    values, vectors, open_ = [], [], [np.eye(len(v))]
    while open_:
        basis = open_.pop()
        a = basis.T @ v @ basis
        a = (a + a.T) / 2
        n, mean = len(a), np.trace(a) / len(a)
        if n > 1 and np.linalg.norm(a - mean * np.eye(n), "fro") > n * EPS * scale:
            parts, rng = None, np.random.default_rng(n)
            spread = np.linalg.norm(a - mean * np.eye(n), "fro")
            shifts = [float(np.median(np.diag(a))), float(mean)] + list(mean + spread * (rng.random(60) - 0.5))
            for s in shifts:
                if np.linalg.norm(a - s * np.eye(n), "fro") > 0:
                    parts = split(a, s, scale)
                if parts is not None:
                    break
            if parts is not None:
                open_ += [basis @ p for p in parts]
                continue
        # One dimension, or eigenvalues that no shift tells apart.
        for x in basis.T:
            x = x / np.linalg.norm(x)
            vectors.append(x)
            values.append(float(x @ v @ x))
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors)[order].T


# -- sums over the fit list -----------------------------------------------------

def whole(table: DataFrame, vec_id: str, vec: str) -> DataFrame:
    """vec_id, x (the whole numbers) and dim of the rows that take part."""
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("vec"))
    rows = rows.where((F.size("vec") > 0) & F.forall("vec", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))))
    return rows.select("vec_id", F.transform("vec", lambda c: F.floor(256 * c).cast("long")).alias("x"),
                       F.size("vec").alias("dim"))


def by_length(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each vector length of a batch: it, the rows of that length, their vectors."""
    x = b.column("x")
    size = np.diff(x.offsets.to_numpy())
    flat = x.flatten().to_numpy()
    begin = np.cumsum(size) - size
    for d in np.unique(size).tolist():
        rows = np.flatnonzero(size == d)
        yield d, rows, flat[begin[rows][:, None] + np.arange(d)]


def products(y: np.ndarray) -> np.ndarray:
    """y' y of whole numbers, exactly: by floating point where all sums stay
    under 2^53, else by numbers of any size."""
    top = int(np.abs(y).max(initial=0)) if y.dtype != object else None
    if top is not None and top * top * len(y) < 2**53:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T @ y


def sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For each vector length the size of the fit list and its sums, exactly."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[int, np.ndarray]] = {}
        for b in batches:
            for d, rows, x in by_length(b):
                n, s = total.get(d, (0, 0))
                total[d] = n + len(rows), s + x.astype(object).sum(axis=0)
        for d, (n, s) in total.items():
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([d] * d, pa.int32()), "at": pa.array(range(d), pa.int32()),
                "n": pa.array([n] * d, pa.int64()), "s": pa.array(list(s), pa.decimal128(38))})

    rows = (fit.mapInArrow(add, "dim int, at int, n bigint, s decimal(38,0)").groupBy("dim", "at")
            .agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).collect())
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(rows, key=lambda r: (r["dim"], r["at"])):
        out.setdefault(r["dim"], (r["n"], []))[1].append(int(r["s"]))
    return out


def covariances(fit: DataFrame, of: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """For each vector length the covariance of its fit list."""
    centre = {d: np.array([round(s / n) for s in ss], object) for d, (n, ss) in of.items()}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for d, _, x in by_length(b):
                near = max(abs(int(c)) for c in centre[d]) < 2**61 and int(np.abs(x).max()) < 2**61
                y = x - centre[d].astype(np.int64) if near else x.astype(object) - centre[d]
                total[d] = total.get(d, 0) + products(y)
        for d, g in total.items():
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([d] * d, pa.int32()), "at": pa.array(range(d), pa.int32()),
                "g": [[str(v) for v in row] for row in g]})

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, i = key[0].as_py(), key[1].as_py()
        n, s = of[d]
        row = np.array([0] * d, object)
        for b in batches:
            for part in b.column("g").to_pylist():
                row = row + np.array([int(v) for v in part], object)
        rest = [s[j] - n * int(centre[d][j]) for j in range(d)]
        cov = [(n * int(row[j]) - rest[i] * rest[j]) / (n * n) for j in range(d)]
        yield pa.RecordBatch.from_pydict({"dim": pa.array([d], pa.int32()), "at": pa.array([i], pa.int32()),
                                          "v": pa.array([cov], pa.list_(pa.float64()))})

    rows = (fit.mapInArrow(add, "dim int, at int, g array<string>").groupBy("dim", "at")
            .applyInArrow(merge, "dim int, at int, v array<double>").collect())
    out = {d: np.zeros((d, d)) for d in of}
    for r in rows:
        out[r["dim"]][r["at"]] = r["v"]
    return out


class Model:
    """The fit of one vector length: its components and how to whiten by them."""

    def __init__(self, n: int, total: list[int], v: np.ndarray, components: int):
        self.n, self.total, d = n, total, len(total)
        e, vectors = eigenvectors(v)
        trace = float(np.trace(v))
        self.e, self.vectors = e[:components], vectors[:, :components]
        self.used = self.e > d * EPS * max(float(e[0]), 0.0)
        self.explained = [float(x) / trace if u else 0.0 for x, u in zip(self.e, self.used)] if trace > 0 else [None] * len(self.e)
        self.error: float | None = None

    def off(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly."""
        top = max([abs(t) for t in self.total])
        if self.n * int(np.abs(x).max(initial=0)) + top < 2**62:
            return self.n * x - np.array(self.total, np.int64)
        return self.n * x.astype(object) - np.array(self.total, object)

    def whiten(self, off: np.ndarray) -> np.ndarray:
        y = (off / self.n).astype(float) @ self.vectors
        return y / np.sqrt(np.where(self.used, self.e, np.inf))


def deviations(off: np.ndarray) -> list[int | None]:
    top = int(np.abs(off).max(initial=0))
    if off.dtype != object and top * top * off.shape[1] < 2**63:
        return (off * off).sum(axis=1).tolist()
    return [s if s < 2**63 else None for s in (sum(int(v) ** 2 for v in row) for row in off)]


def identity_errors(fit: DataFrame, models) -> dict[int, float]:
    """For each vector length the largest absolute entry of the covariance of its
    whitened fit list minus the identity."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for d, _, x in by_length(b):
                m = models.value[d]
                z = m.whiten(m.off(x))[:, m.used]
                total[d] = total.get(d, 0) + np.vstack([z.sum(axis=0), z.T @ z])
        for d, t in total.items():
            yield pa.RecordBatch.from_pydict({"dim": pa.array([d] * t.size, pa.int32()), "at": pa.array(range(t.size), pa.int32()),
                                              "s": pa.array(t.ravel(), pa.float64())})

    rows = fit.mapInArrow(add, "dim int, at int, s double").groupBy("dim", "at").agg(F.sum("s").alias("s")).collect()
    errors = {}
    for d, m in models.value.items():
        k = int(m.used.sum())
        t = np.zeros((k + 1) * k)
        for r in rows:
            if r["dim"] == d:
                t[r["at"]] = r["s"]
        t = t.reshape(k + 1, k) / m.n
        if k:
            errors[d] = float(np.abs(t[1:] - np.outer(t[0], t[0]) - np.eye(k)).max())
    return errors


def whitened(table: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each row that takes part and each of its first ``components`` components:
    vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = table.sparkSession
    rows = whole(table, vec_id, vec)
    fit, path = written(rows.select("x").distinct(), "fit-list")
    of = sums(fit)
    models = {d: Model(*of[d], v, components) for d, v in covariances(fit, of).items()}
    shared = spark.sparkContext.broadcast(models)
    for d, error in identity_errors(fit, shared).items():
        models[d].error = error
    drop_written(spark, path)
    shared.unpersist()
    shared = spark.sparkContext.broadcast(models)

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, at, x in by_length(b):
                m = shared.value[d]
                off = m.off(x)
                z, k = m.whiten(off), len(m.e)
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()),
                     pa.array(np.full(len(at) * k, m.n), pa.int64()),
                     pa.array(deviations(off), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))),
                     pa.array(z.ravel(), pa.float64(), mask=np.tile(~m.used, len(at))),
                     pa.array(m.explained * len(at), pa.float64()), pa.array([m.error] * (len(at) * k), pa.float64())],
                    schema=pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                                      ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())]))

    return rows.select("vec_id", "x").mapInArrow(whiten, OUT)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on its first four whitened components."""
    return whitened(source(spark, sf_dir, "embeddings", "vec_id", "embedding"))
