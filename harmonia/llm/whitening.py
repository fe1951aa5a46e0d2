"""Embedding whitening by contour integration (FEAST).

Vectors become whole numbers, x = floor(scale * c) + shift.  One pass over them gives their number and exact
sums, a second the covariance of centred entries; tasks add up outer products of their own rows in numpy, so
a d x d table is all that leaves a task, and a middle layer of tasks adds these up by row.

Eigenpairs come from the covariance V by intervals of its spectrum.  Inertia counts (signs of the pivots of
V - s) say how many eigenvalues lie on either side of a shift s and bisect the spectrum into intervals that
hold a few each.  For every interval a task integrates the resolvent around it: solves
(z_k - V) X_k = Y at the nodes z_k of a Gauss-Legendre rule on the circle through the interval's ends and adds
them up, which keeps of Y what lies in the interval's eigenvectors.  Rayleigh-Ritz on that subspace gives
eigenpairs; they go round again until their residuals are at rounding level.  An interval whose pairs are not as
many as its inertia count is repeated with a larger subspace, so none is missed.  A last
Rayleigh-Ritz over all of them makes them orthogonal across intervals.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, materialise, table

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Entries whose whole number is larger than this are not representable and count as non-finite.
LARGEST = float(1 << 52)
#: Eigenvalues in an interval, at most, unless they are too close to be told apart.
IN_INTERVAL = 8
#: Nodes on the upper half circle, rounds of an interval, and the residual at which a pair has converged (against the norm of V).
NODES, ROUNDS, RESIDUAL = 8, 30, 2e-14
#: Eigenvalues below this share of the largest are rounding noise: they have no whitened component.
LEAST = 1e-11


# ---- eigenpairs of a symmetric matrix -----------------------------------------------------------------

def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """(positive, negative, zero) eigenvalues of a symmetric matrix, by pivots of 1 x 1 and 2 x 2 blocks (complete pivoting)."""
    a = np.array(a, dtype=np.float64)
    positive = negative = 0
    alpha = (1 + math.sqrt(17)) / 8
    tiny = np.abs(a).max(initial=0.0) * np.finfo(float).eps * max(1, len(a))
    while len(a):
        diag = np.abs(np.diag(a))
        p = int(diag.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        i, j = np.unravel_index(int(off.argmax()), off.shape)
        if max(diag[p], off[i, j]) <= tiny:
            return positive, negative, len(a)
        if diag[p] >= alpha * off[i, j]:
            pivot, keep = a[p, p], np.arange(len(a)) != p
            column = a[keep, p]
            positive, negative = positive + int(pivot > 0), negative + int(pivot < 0)
            a = a[np.ix_(keep, keep)] - np.outer(column, column) / pivot
        else:   # a block of negative determinant: one eigenvalue on either side
            keep = ~np.isin(np.arange(len(a)), (i, j))
            block, columns = a[np.ix_([i, j], [i, j])], a[np.ix_(keep, [i, j])]
            positive, negative = positive + 1, negative + 1
            a = a[np.ix_(keep, keep)] - columns @ np.linalg.solve(block, columns.T)
        a = (a + a.T) / 2
    return positive, negative, 0


def above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``v`` above ``shift``."""
    return inertia(v - shift * np.eye(len(v)))[0]


def bounds(v: np.ndarray) -> tuple[float, float]:
    """Gershgorin's interval, a little wider."""
    radius = np.abs(v).sum(axis=1) - np.abs(np.diag(v))
    lo, hi = float((np.diag(v) - radius).min()), float((np.diag(v) + radius).max())
    room = max(1e-300, 1e-3 * max(abs(lo), abs(hi)))
    return lo - room, hi + room


def intervals(v: np.ndarray, most: int, in_interval: int = IN_INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) of disjoint intervals that hold the ``most`` largest eigenvalues or a few more."""
    lo, hi = bounds(v)
    close = 64 * np.finfo(float).eps * max(abs(lo), abs(hi))
    done, queue = [], [(lo, hi, len(v), 0)]   # low, high, eigenvalues above low, above high
    while queue:
        a, b, over_a, over_b = queue.pop()
        n = over_a - over_b
        if n == 0 or over_b >= most:
            continue
        if n <= in_interval or b - a <= close:
            done.append((a, b, n))
            continue
        middle = a + (b - a) / 2
        over = above(v, middle)
        queue += [(a, middle, over_a, over), (middle, b, over, over_b)]
    return sorted(done)


def filtered(v: np.ndarray, y: np.ndarray, low: float, high: float, nodes: int = NODES) -> np.ndarray:
    """The contour integral of (z - V)^-1 Y around [low, high]: y without what other eigenvectors hold of it."""
    points, weights = np.polynomial.legendre.leggauss(nodes)
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(y)
    for t, w in zip(points, weights):
        turn = np.exp(1j * math.pi / 2 * (t + 1))   # upper half; the lower half is its conjugate
        z = centre + radius * turn
        out += (w / 2) * np.real(radius * turn * np.linalg.solve(z * np.eye(len(v)) - v, y.astype(complex)))
    return out


def ritz(v: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ritz values (rising) and vectors of the space that the columns of ``y`` span."""
    basis, singular, _ = np.linalg.svd(y, full_matrices=False)
    basis = basis[:, singular > singular.max(initial=0.0) * 1e-13]
    small = basis.T @ v @ basis
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return values, basis @ vectors


def in_interval(v: np.ndarray, low: float, high: float, expected: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The ``expected`` eigenpairs of ``v`` in [low, high]; raises if they cannot all be found.

    Eigenvalues are counted by inertia, so a subspace that lost one is seen and grown.
    """
    d, norm = len(v), np.abs(v).sum(axis=1).max()
    rng = np.random.default_rng(seed)
    size, slack = min(d, max(expected + 2, math.ceil(1.5 * expected))), 4 * np.finfo(float).eps * norm
    y = rng.normal(size=(d, size))
    best = None
    for _ in range(ROUNDS):
        values, vectors = ritz(v, filtered(v, y, low, high))
        residual = np.linalg.norm(v @ vectors - vectors * values, axis=0)
        at = np.flatnonzero((values >= low - slack) & (values <= high + slack))
        at = at[np.argsort(residual[at], kind="stable")[:expected]]
        worst = residual[at].max(initial=0.0) if len(at) == expected else math.inf
        if best is not None and worst < math.inf and worst >= best[0] / 2:   # no better by another round
            if best[0] <= 1e-10 * norm:
                break
        if best is None or worst < best[0]:
            best = (worst, values[at], vectors[:, at])
        if worst <= RESIDUAL * norm:
            break
        if len(at) < expected:   # one is missing: start wider
            size = min(d, size + expected)
            y = np.concatenate([vectors, rng.normal(size=(d, max(1, size - vectors.shape[1])))], axis=1)
        else:
            y = vectors
    if best[0] > 1e-10 * norm:
        raise ValueError(f"{expected} eigenvalues lie in [{low}, {high}], their vectors were not found")
    return best[1], best[2]


def eigenpairs(spark, v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of ``v``, falling, and their unit eigenvectors as columns.

    One task an interval; the driver sees ``most`` pairs or a few more.  A vector's entry of largest size is positive.
    """
    parts = intervals(v, most)
    if not parts:
        return np.zeros(0), np.zeros((len(v), 0))
    shared = spark.sparkContext.broadcast(v)   # d x d

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a, b, n in zip(pdf["low"], pdf["high"], pdf["n"]):
                values, vectors = in_interval(shared.value, a, b, int(n))
                yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

    asked = spark.createDataFrame(parts, "low double, high double, n int").repartition(len(parts), "low")
    got = sorted(asked.mapInPandas(solve, "value double, vector array<double>").collect(), key=lambda r: r["value"])
    if len(got) != sum(n for _, _, n in parts):
        raise ValueError("the intervals' eigenpairs are not as many as their inertia counts")
    values, vectors = ritz(v, np.array([r["vector"] for r in got]).T)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    if len(values) < min(most, len(v)) or above(v, values[-1] - 1e-9 * np.abs(v).sum(axis=1).max()) < len(values):
        raise ValueError("an eigenvalue was missed")
    turn = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * turn


# ---- moments over all rows ----------------------------------------------------------------------------

def fit_list(vector: Column) -> Column:
    """A vector without null, non-finite or unrepresentably large entries."""
    fine = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double") * SCALE) < LARGEST))   # NaN is larger than all
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def whole(vectors: pd.Series) -> np.ndarray:
    """floor(SCALE * c) of vectors of one length, as 64-bit whole numbers (``SHIFT`` less than x)."""
    return np.floor(SCALE * np.stack(vectors.to_numpy()).astype(np.float64)).astype(np.int64)


def products(rows: DataFrame, of, d: int) -> np.ndarray:
    """The sum over all rows of y y' where ``of`` turns a batch of vectors into rows y of ``d`` entries.

    Tasks add up their own rows; then each row of the d x d table is added up by a few tasks, then by Spark.
    """
    def outer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((d, d))
        for pdf in batches:
            if len(pdf):
                y = of(pdf["vector"])
                total += y.T @ y
        for at in range(d):
            yield pd.DataFrame({"i": [at], "x": [total[at]]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for i, x in zip(pdf["i"], pdf["x"]):
                total[i] = total[i] + x if i in total else np.array(x)
        for i, x in total.items():
            yield pd.DataFrame({"i": [i], "x": [x]})

    parts = rows.select("vector").mapInPandas(outer, "i int, x array<double>").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    layer = parts.repartition(16, "salt", "i").select("i", "x").mapInPandas(add, "i int, x array<double>")
    out = np.zeros((d, d))
    for r in layer.collect():   # d rows from each of 16 tasks, whatever the input
        out[r["i"]] += np.array(r["x"])
    return out


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    Vectors that are null, hold null or non-finite entries or entries of 2**46 and more are left out.  All others are
    fitted, repeated rows and null ids too.  Vectors of another length are another fit list and whiten
    among themselves; an empty vector has no component.  Components without variance (one vector, or all equal, or
    eigenvalues below 1e-11 of the largest) cannot be scaled to one and are left out.  ``deviation`` is null
    where it exceeds 64 bits.  An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    bound_batches(spark, 4000)
    rows = (vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
            .where(fit_list(F.col("vector"))).where(F.size("vector") > 0).withColumn("d", F.size("vector")))
    rows = materialise(rows, "whiten-rows")
    out = None
    # as many rows as there are vector lengths; a model has one
    for (d,) in sorted(tuple(r) for r in rows.select("d").distinct().collect()):
        part = _whiten(spark, rows.where(F.col("d") == d), d, components)
        out = part if out is None else out.unionByName(part)
    schema = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    if out is None:
        return rows.where("false").select("vec_id", *[F.lit(None).cast(t.split()[1]).alias(t.split()[0]) for t in schema.split(", ")])
    return out


def _whiten(spark, rows: DataFrame, d: int, components: int) -> DataFrame:
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s = 0, [0] * d   # Python's whole numbers: exact at any size
        for pdf in batches:
            for at in range(0, len(pdf), 1024):   # 1024 * 2**52 fits 64 bits
                x = whole(pdf["vector"].iloc[at:at + 1024])
                n, s = n + len(x), [a + b for a, b in zip(s, x.sum(axis=0).tolist())]
        yield pd.DataFrame({"i": range(-1, d), "x": [str(v) for v in (n, *s)]})

    total = (rows.select("vector").mapInPandas(sums, "i int, x string").groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")))
    exact = {r["i"]: int(r["x"]) for r in total.collect()}   # d + 1 rows
    n, s = exact[-1], [exact[i] for i in range(d)]
    mean = np.array([v / n for v in s])

    v = products(rows, lambda x: whole(x) - mean, d) / n
    v = (v + v.T) / 2
    values, vectors = eigenpairs(spark, v, min(components, d)) if v.any() else (np.zeros(0), np.zeros((d, 0)))
    keep = values > LEAST * values.max(initial=0.0)
    values, vectors = values[keep], vectors[:, keep]
    trace, turn = float(np.trace(v)), vectors / np.sqrt(values)

    error = 0.0
    if len(values):   # measured on the rows themselves; their mean is nought by construction, up to rounding
        error = float(np.abs(products(rows, lambda x: (whole(x) - mean) @ turn, len(values)) / n - np.eye(len(values))).max())
    shared = spark.sparkContext.broadcast((mean, turn, n, s))   # d x components

    @F.pandas_udf("struct<deviation:long,whitened:array<double>>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        mean, turn, n, s = shared.value
        for vector in batches:
            if not len(vector):
                yield pd.DataFrame({"deviation": pd.Series([], dtype="Int64"), "whitened": []})
                continue
            x = whole(vector)
            y = (x - mean) @ turn
            # n*x - S for whole numbers of this size and number
            largest = n * int(np.abs(x).max(initial=0)) + max(map(abs, s), default=0)
            if d * largest * largest < 1 << 62:
                off = n * x - np.array(s, dtype=np.int64)
                deviation = (off * off).sum(axis=1).tolist()
            else:
                deviation = [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x.tolist()]
            fits = pd.array([e if e < 1 << 63 else None for e in deviation], dtype="Int64")
            yield pd.DataFrame({"deviation": fits, "whitened": list(y)})

    share = F.array(*[F.lit(float(e / trace)) for e in values]) if len(values) else F.array().cast("array<double>")
    made = rows.select("vec_id", project("vector").alias("p")).select("vec_id", F.col("p.deviation").alias("deviation"), F.posexplode("p.whitened").alias("at", "whitened"))
    return made.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
