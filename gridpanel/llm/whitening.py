"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

An entry c becomes the whole number x = floor(64 c) + 1,000,000. Three sums over all
vectors are taken by the tasks and added up by Spark: the count with the sums S of each
dimension; the scatter, of vectors centred on the whole number next to the mean, so that
products are small whole numbers whose sums are exact, and what that centre is off the mean
is taken off exactly; and, as a check, the covariance of the whitened vectors.

The scatter (dimensions x dimensions, whatever the number of rows) is factored on the
driver: V = L L' by Cholesky with diagonal pivots, which ends at the rank, then rotations
of pairs of columns make the columns of the triangular factor L orthogonal (one-sided
Jacobi). Their squared norms are the eigenvalues, the normalised columns the components;
V is not squared or formed again, so small components keep their digits.

Defined results: a vector that is null, empty, or holds a null or non-finite entry is
dropped, and so is one with an entry beyond +-2**47, whose x a double cannot hold exactly;
of vectors of different lengths those of the most frequent length take part (of equally
frequent ones the longest). Directions without variance have no whitened value: there are
as many components as the rank, ``most`` at most. A repeated row counts and returns as
often as it stands there; null ids stay. The sign of a component makes its largest entry
positive. Other columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0 ** 47     # of an entry's size
EXACT = 2.0 ** 52       # doubles add whole numbers exactly up to here
ROWS = 4_096            # vectors multiplied at once
EXACT_INTEGER = "decimal(38,0)"


# ---- dense helpers -----------------------------------------------------------------

def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L with V = L L', a column per pivot; rows are in V's order, so that L is lower
    triangular in the order of the pivots. Ends when only rounding is left."""
    d = len(v)
    left = np.diag(v).astype(float).copy()
    least = d * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    out = np.zeros((d, d))
    for k in range(d):
        p = int(np.argmax(left))
        if left[p] <= least:
            return out[:, :k]
        column = (v[:, p] - out[:, :k] @ out[p, :k]) / np.sqrt(left[p])
        column[left == -np.inf] = 0.0       # pivots so far
        column[p] = np.sqrt(left[p])
        out[:, k] = column
        left -= column * column
        left[p] = -np.inf
    return out


def one_sided_jacobi(a: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(squared norms, falling; unit columns) of ``a`` after rotations that make its columns
    orthogonal. A round rotates pairs without common columns, all at once."""
    a = a.copy()
    n = a.shape[1]
    seats = np.arange(n + n % 2)            # of a tournament where each meets each
    for _ in range(sweeps):
        rotated = False
        for _ in range(len(seats) - 1):
            p, q = seats[:len(seats) // 2], seats[len(seats) // 2:][::-1]
            both = (p < n) & (q < n)
            p, q = p[both], q[both]
            alpha, beta = (a[:, p] ** 2).sum(axis=0), (a[:, q] ** 2).sum(axis=0)
            gamma = (a[:, p] * a[:, q]).sum(axis=0)
            turn = np.abs(gamma) > np.finfo(float).eps * np.sqrt(len(a) * alpha * beta)
            if turn.any():
                rotated = True
                p, q, g = p[turn], q[turn], gamma[turn]
                zeta = (beta[turn] - alpha[turn]) / (2 * g)
                t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                left, right = a[:, p].copy(), a[:, q].copy()
                a[:, p], a[:, q] = c * left - c * t * right, c * t * left + c * right
            seats = np.concatenate((seats[:1], seats[-1:], seats[1:-1]))
        if not rotated:
            break
    value = (a * a).sum(axis=0)
    order = np.argsort(-value, kind="stable")
    return value[order], a[:, order] / np.sqrt(value[order])


# ---- sums on Spark -----------------------------------------------------------------

def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))


def _usable(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, lengths, flat whole numbers x) of the vectors that take part."""
    column = batch.column("v")
    size = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    value = flat.to_numpy(zero_copy_only=False)     # a null is NaN here
    good = np.isfinite(value) & (np.abs(value) <= LARGEST)
    bad = np.bincount(np.repeat(np.arange(len(size)), size)[~good], minlength=len(size))
    keep = (size > 0) & (bad == 0)
    value = value[np.repeat(keep, size)]
    return np.flatnonzero(keep), size[keep], np.floor(SCALE * value).astype(np.int64) + SHIFT


def _of_length(batch: pa.RecordBatch, d: int):
    """(rows, x as a matrix) of the usable vectors of length d, few at a time."""
    rows, size, x = _usable(batch)
    x = x[np.repeat(size == d, size)].reshape(-1, d)
    rows = rows[size == d]
    for a in range(0, len(rows), ROWS):
        yield rows[a:a + ROWS], x[a:a + ROWS]


def _whole(values: np.ndarray) -> pa.Array:
    if values.dtype == np.int64:
        return pa.array(values).cast(pa.decimal128(38, 0))
    return pa.array([Decimal(int(x)) for x in values], pa.decimal128(38, 0))


def _sums(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """(n, S of each dimension as Python integers) of the most frequent length."""
    def task(batches):
        n, total = {}, {}
        for batch in batches:
            _, size, x = _usable(batch)
            for d in np.unique(size).tolist():
                own = x[np.repeat(size == d, size)].reshape(-1, d)
                n[d] = n.get(d, 0) + len(own)
                # halves, so that no sum of a batch leaves 64 bits
                halves = np.stack([(own >> 31).sum(axis=0), (own & (2**31 - 1)).sum(axis=0)]).astype(object)
                total[d] = total.get(d, 0) + halves[0] * 2**31 + halves[1]
        for d in n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n[d]] * d, pa.int64()),
                 _whole(total[d])], ["d", "i", "n", "s"])

    sums = (vectors.mapInArrow(task, f"d int, i int, n bigint, s {EXACT_INTEGER}")
            .groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").cast(EXACT_INTEGER).alias("s")))
    per = F.array_sort(F.collect_list(F.struct("i", "s")))
    most = sums.groupBy("d").agg(F.max("n").alias("n"), per.alias("sums")).orderBy(F.desc("n"), F.desc("d")).first()
    if most is None:
        return 0, np.zeros(0, object)
    return most.n, np.array([int(r.s) for r in most.sums], object)


def _upper(d: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(d)


def _scatter(vectors: DataFrame, n: int, sums: np.ndarray) -> list[list[Fraction]]:
    """The covariance of x (divisor n) without rounding."""
    d = len(sums)
    centre = np.array([int((2 * s + n) // (2 * n)) for s in sums], np.int64)    # next to the mean
    shared = vectors.sparkSession.sparkContext.broadcast(centre.tolist())

    def task(batches):
        total, at = 0, np.array(shared.value, np.int64)
        for batch in batches:
            for _, x in _of_length(batch, d):
                y = x - at
                if float(np.abs(y).max()) ** 2 * len(y) < EXACT:
                    y = y.astype(float)
                    total = total + (y.T @ y).astype(np.int64).astype(object)
                else:
                    y = y.astype(object)
                    total = total + y.T @ y
        if isinstance(total, np.ndarray):
            i, j = _upper(d)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), _whole(total[i, j])],
                                             ["i", "j", "s"])

    found = (vectors.mapInArrow(task, f"i int, j int, s {EXACT_INTEGER}")
             .groupBy("i", "j").agg(F.sum("s").cast(EXACT_INTEGER).alias("s")).collect())   # d * (d + 1) / 2 rows
    off = [int(s) - n * int(c) for s, c in zip(sums, centre, strict=True)]
    out = [[Fraction(0)] * d for _ in range(d)]
    for r in found:
        out[r.i][r.j] = out[r.j][r.i] = Fraction(n * int(r.s) - off[r.i] * off[r.j], n * n)
    return out


def _identity_error(whitened: DataFrame, r: int) -> float:
    """Largest absolute entry of the covariance of the vectors ``w`` minus the identity."""
    spark = whitened.sparkSession

    def totals(batches):
        n, total = 0, np.zeros(r)
        for batch in batches:
            w = batch.column("w").flatten().to_numpy().reshape(-1, r)
            n, total = n + len(w), total + w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(r), pa.int32()), pa.array([n] * r, pa.int64()), pa.array(total)],
                                         ["i", "n", "s"])

    rows = (whitened.mapInArrow(totals, "i int, n bigint, s double").groupBy("i")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
    n, mean = rows[0].n, [0.0] * r
    for x in rows:
        mean[x.i] = x.s / n
    shared = spark.sparkContext.broadcast(mean)

    def products(batches):
        total, at = np.zeros((r, r)), np.array(shared.value)
        for batch in batches:
            w = batch.column("w").flatten().to_numpy().reshape(-1, r) - at
            total += w.T @ w
        i, j = _upper(r)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                         ["i", "j", "s"])

    off = F.abs(F.col("s") / n - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    return (whitened.mapInArrow(products, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
            .agg(F.max(off).alias("e")).first().e)


def fit(df: DataFrame, most: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> dict | None:
    """The model, in plain values: n, S, components (rows), eigenvalues, explained shares;
    None if no vector takes part."""
    vectors = _vectors(df, id_col, vector_col)
    n, sums = _sums(vectors)
    if not n:
        return None
    v = _scatter(vectors, n, sums)
    trace = sum(v[i][i] for i in range(len(v)))
    value, component = one_sided_jacobi(pivoted_cholesky(np.array([[float(x) for x in row] for row in v])))
    value, component = value[:most], component.T[:most]
    flip = [1.0 if c[np.argmax(np.abs(c))] >= 0 else -1.0 for c in component]
    return {"n": n, "sums": [int(s) for s in sums], "components": (component * np.array(flip)[:, None]).tolist(),
            "eigenvalues": value.tolist(), "explained": [float(Fraction(x) / trace) for x in value.tolist()]}


def transform(df: DataFrame, model: dict, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (id, deviation, w): for each vector that takes part the exact whole number
    sum of (n x - S)**2 and the whitened coordinates."""
    vectors = _vectors(df, id_col, vector_col)
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    d, r = len(model["sums"]), len(model["eigenvalues"])

    def task(batches):
        m = shared.value
        n, sums = m["n"], m["sums"]
        # S = n * base + rest, so n x - S = n (x - base) - rest without leaving 64 bits early
        base, rest = (np.array(x, np.int64) for x in zip(*(divmod(s, n) for s in sums), strict=True))
        to = (np.array(m["components"]).reshape(r, d) / np.sqrt(np.array(m["eigenvalues"]))[:, None]).T
        for batch in batches:
            for rows, x in _of_length(batch, d):
                y = x - base
                far = n * (float(np.abs(y).max()) + 1)
                if d * far * far < 2.0 ** 62:
                    deviation = ((n * y - rest) ** 2).sum(axis=1)
                else:
                    deviation = ((n * y.astype(object) - rest) ** 2).sum(axis=1)
                w = (y - rest / n) @ to
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(rows)), _whole(deviation),
                     pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), r).cast(pa.list_(pa.float64()))],
                    ["id", "deviation", "w"])

    id_type = vectors.schema["id"].dataType.simpleString()
    return (vectors.mapInArrow(task, f"id {id_type}, deviation {EXACT_INTEGER}, w array<double>")
            .withColumnRenamed("id", id_col))


def whiten(df: DataFrame, most: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (id, component, n, deviation, whitened, explained, identity_error)."""
    model = fit(df, most, id_col, vector_col)
    r = len(model["eigenvalues"]) if model else 0
    if not r:
        id_type = df.schema[id_col].dataType.simpleString()
        return df.sparkSession.createDataFrame(
            [], f"{id_col} {id_type}, component int, n bigint, deviation {EXACT_INTEGER}, whitened double, "
                "explained double, identity_error double")
    rows = transform(df, model, id_col, vector_col)
    error = _identity_error(rows.select("w"), r)
    explained = F.array(*[F.lit(x) for x in model["explained"]])
    return (rows.select(id_col, "deviation", F.posexplode("w").alias("at", "whitened"))
            .select(id_col, (F.col("at") + 1).alias("component"), F.lit(model["n"]).cast("long").alias("n"), "deviation",
                    "whitened", F.element_at(explained, F.col("at") + 1).alias("explained"),
                    F.lit(error).alias("identity_error")))
