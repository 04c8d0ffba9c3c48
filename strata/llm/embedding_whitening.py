"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Every entry c becomes the long x = floor(64 c) + 1000000. The model is fitted on
the fit list, each distinct x vector once:

1. Spark finds the distinct vectors (partial aggregates first, so a vector of a
   third of all rows costs one row a task) and writes them to the shared folder.
2. One pass gives n and the exact sums S. A second adds the outer products of
   x - S/n; integers keep that difference exact to the last bit. A task sends
   its sums, one row for each dimension, and the sums of all tasks meet by
   dimension, so what reaches the driver is one scatter matrix.
3. The scatter C, d x d whatever the corpus, is factored as P'CP = LL' by
   Cholesky with the largest pivot first, ending where no pivot is left above
   rounding: that is the rank. One-sided Jacobi then rotates the columns of L
   until they are orthogonal; the squared norms are n times the eigenvalues and
   the normalised columns, with rows back in their places, the components.
   Neither C's eigenvalues nor C itself are touched again, so small eigenvalues
   keep the accuracy that the factor gives them.
4. A third pass over the fit list measures the covariance of the whitened
   vectors, and a last one over the table projects every row.

Cases: rows whose vector is null, or holds a null, NaN or infinite entry, or
one beyond 2**56 in size, are dropped. Vectors of another length than the
table's most frequent one (of equally frequent ones the longest) are dropped
too, and so are empty vectors. Equal vectors, with any ids, count once in the
fit and each have their rows in the result; rows with a null id are kept with a
null id. Components of no variance are left out, so a table with fewer distinct
vectors than ``components`` gives fewer, and one distinct vector or an empty
table none. ``deviation`` is null where it does not fit a long. Extra columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.tables import written

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: Entries of larger size are not numbers that a scaled long could hold.
LARGEST = float(1 << 56)
#: Rows worked on at once.
ROWS = 2048

WHITENED = T.StructType([
    T.StructField("vec_id", T.LongType()),
    T.StructField("component", T.IntegerType()),
    T.StructField("n", T.LongType()),
    T.StructField("deviation", T.LongType()),
    T.StructField("whitened", T.DoubleType()),
    T.StructField("explained", T.DoubleType()),
    T.StructField("identity_error", T.DoubleType()),
])


# ---------------------------------------------------------------- the factorisation

def pivoted_cholesky(c: np.ndarray) -> np.ndarray:
    """L of c's shape[0] rows and rank columns with c = L L', by the largest pivot first.

    Rows are in the places of ``c``; taken in the order of the pivots L is lower triangular.
    """
    d = len(c)
    rest = np.diag(c).astype(float).copy()
    least = d * np.finfo(float).eps * max(rest.max(initial=0.0), 0.0)
    factor, done = np.zeros((d, d)), np.zeros(d, bool)
    for k in range(d):
        left = np.where(done, -np.inf, rest)
        p = int(left.argmax())
        if not left[p] > least:
            return factor[:, :k]
        done[p] = True
        root = np.sqrt(left[p])
        column = (c[:, p] - factor[:, :k] @ factor[p, :k]) / root
        column[done] = 0.0
        column[p] = root
        factor[:, k] = column
        rest -= column**2
    return factor


def _rounds(n: int):
    """Pairs of 0..n-1 in rounds of disjoint pairs that together hold every pair once (a tournament)."""
    ring = list(range(n + n % 2))
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(a, b) for a, b in zip(ring[:half], ring[: half - 1 : -1]) if a < n and b < n]
        yield np.array([min(p) for p in pairs], int), np.array([max(p) for p in pairs], int)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared norms, falling, and normalised columns of ``factor`` rotated until they are orthogonal.

    Raises ArithmeticError if 60 sweeps are not enough (a handful are).
    """
    a = factor.copy()
    r = a.shape[1]
    if not r:
        return np.zeros(0), a
    eps = np.finfo(float).eps * max(len(a), 1) ** 0.5
    for _ in range(60):
        turned = False
        for p, q in _rounds(r):
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(xy) > eps * np.sqrt(xx * yy)
            if not turn.any():
                continue
            turned = True
            p, q, x, y, xx, yy, xy = p[turn], q[turn], x[:, turn], y[:, turn], xx[turn], yy[turn], xy[turn]
            zeta = (yy - xx) / (2 * xy)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
        if not turned:
            break
    else:
        raise ArithmeticError("the columns did not become orthogonal")
    norm = np.sqrt((a * a).sum(0))
    order = np.argsort(-norm, kind="stable")
    return norm[order] ** 2, a[:, order] / norm[order]


# ---------------------------------------------------------------- vectors

@dataclass
class Centre:
    """n and the sums of x - 1000000, as whole part and remainder of the mean."""

    n: int
    whole: list[int]
    rest: list[int]

    @classmethod
    def of(cls, n: int, sums: list[int]) -> Centre:
        whole, rest = zip(*(divmod(s, n) for s in sums))
        return cls(n, list(whole), list(rest))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n as doubles; the integer part is subtracted exactly."""
        return (x - np.array(self.whole, np.int64)) - np.array(self.rest, float) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n x - S)**2 for each row, exactly; None beyond a long."""
        y = x - np.array(self.whole, np.int64)
        widest = int(np.abs(y).max(initial=0)) + 1
        if self.n * widest * self.n * widest * x.shape[1] < 1 << 62:
            m = y * self.n - np.array(self.rest, np.int64)
            return (m * m).sum(1).tolist()
        out = []
        for row in y.tolist():
            total = sum((v * self.n - r) ** 2 for v, r in zip(row, self.rest))
            out.append(total if total < 1 << 63 else None)
        return out


def _x(col: pa.Array, d: int) -> np.ndarray:
    """x - 1000000 of a list column whose rows all hold ``d`` numbers."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(float)
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, d)


def _packed(x: np.ndarray) -> pa.Array:
    """Each vector as bytes, in two bytes an entry where they do (equal vectors give equal bytes)."""
    narrow = (x >= -(1 << 15)).all(1) & (x < 1 << 15).all(1)
    small = x.astype(np.int16)
    return pa.array([small[i].tobytes() if w else x[i].tobytes() for i, w in enumerate(narrow.tolist())], pa.binary())


def _unpacked(col: pa.Array, d: int) -> np.ndarray:
    raw = col.to_pylist()
    out = np.zeros((len(raw), d), np.int64)
    for i, b in enumerate(raw):
        out[i] = np.frombuffer(b, np.int16 if len(b) == 2 * d else np.int64)
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``v`` of the rows whose vector takes part, whatever their length."""
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) > LARGEST)
    return kept.where(F.col("v").isNotNull() & (F.size("v") > 0) & ~F.coalesce(F.exists("v", bad), F.lit(False)))


def _sums(fit: DataFrame, d: int) -> Centre | None:
    """n and the exact sums of every dimension."""

    def run(batches):
        n, total = 0, [0] * d
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                x = _unpacked(batch.column(0).slice(lo, ROWS), d)
                n += len(x)
                wide = int(np.abs(x).max(initial=0)) * len(x) >= 1 << 62
                part = [sum(c) for c in x.T.tolist()] if wide else x.sum(0).tolist()
                total = [a + b for a, b in zip(total, part)]
        if n:
            yield pa.RecordBatch.from_pydict({"i": list(range(d)), "n": [n] * d, "s": [str(t) for t in total]}, pa.schema([("i", pa.int32()), ("n", pa.int64()), ("s", pa.string())]))

    parts = fit.mapInArrow(run, "i int, n long, s string")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    return Centre.of(rows[0]["n"], [int(r["s"]) for r in rows]) if rows else None


def _scatter(fit: DataFrame, d: int, width: int, values) -> np.ndarray:
    """The sum over the fit list of y y' for y = ``values(x)``, ``width`` wide."""
    schema = pa.schema([("i", pa.int32()), ("sums", pa.list_(pa.float64()))])

    def run(batches):
        total, seen = np.zeros((width, width)), False
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                y = values(_unpacked(batch.column(0).slice(lo, ROWS), d))
                total += y.T @ y
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], schema=schema)

    cells = fit.mapInArrow(run, "i int, sums array<double>").select("i", F.posexplode("sums").alias("j", "s"))
    out = np.zeros((width, width))
    for r in cells.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["i"], r["j"]] = r["s"]
    return (out + out.T) / 2


@dataclass
class Whitening:
    """A fitted model: ``components`` columns of unit length with variances ``values``."""

    d: int
    centre: Centre
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ (self.components / np.sqrt(self.values))


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on all vectors of the table; None if no vector takes part."""
    rows = usable(vectors)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return None
    d = lengths[0]["d"]

    def pack(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                yield pa.RecordBatch.from_arrays([_packed(_x(batch.column(0).slice(lo, ROWS), d))], names=["x"])

    packed = rows.where(F.size("v") == d).select("v").mapInArrow(pack, "x binary")
    fit = written(packed.distinct(), "fit-list")
    centre = _sums(fit, d)
    scatter = _scatter(fit, d, d, centre.centred)
    values, vectors_ = one_sided_jacobi(pivoted_cholesky(scatter))
    values, trace = values / centre.n, float(np.trace(scatter)) / centre.n
    model = Whitening(d, centre, values[:components], vectors_[:, :components], trace, 0.0)
    k = len(model.values)
    if k:
        model.identity_error = float(np.abs(_scatter(fit, d, k, model.apply) / centre.n - np.eye(k)).max())
    return model


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each row that takes part and each component; see the module's text for cases.

    ``vec_id``; ``component`` from 1, by falling variance; ``n`` vectors in the fit list;
    ``deviation``, the sum over dimensions of (n x - S)**2; ``whitened``, x - S/n
    projected on the component over the root of its variance; ``explained``, the
    component's share of the total variance; ``identity_error``, the largest entry of the whitened
    fit list's covariance minus the identity.
    """
    model = fit_whitening(vectors, components)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], WHITENED)
    k = len(model.values)
    share = (model.values / model.trace).tolist()

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                x = _x(part.column(1), model.d)
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.centre.n, np.int64)),
                        pa.array(model.centre.deviations(x), pa.int64()).take(each), pa.array(model.apply(x).ravel()),
                        pa.array(np.tile(share, m)), pa.array(np.full(m * k, model.identity_error)),
                    ],
                    names=WHITENED.names,
                )

    return usable(vectors).where(F.size("v") == model.d).mapInArrow(run, WHITENED)
