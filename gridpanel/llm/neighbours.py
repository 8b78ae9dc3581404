"""Approximate nearest neighbours by collision counting.

Every vector is projected on a number of random lines; the projections on one line
form a sorted array. A query looks at the window around its own projection in each
array. Virtual rehashing widens all windows with the radius, so each round only counts
what has come in; vectors that have fallen into the windows of enough lines are
verified by their true cosine. A query is done when ``k`` verified vectors lie within
the radius. There is no cap on candidates, and a query that reaches the largest radius
verifies all that is left.

For unit vectors cosine and distance order alike. A vector at distance r of the query
falls into the window of half width h*R with probability 2*Phi(h*R/r) - 1; the number of
lines required is that of a vector at distance R less ``slack`` standard deviations.

Vectors are dealt by a hash of their id into blocks, queries into blocks of their own;
a task searches one block of either kind, and the best of all blocks are merged. The
work is that of a stated query set against all rows; no task holds more than two blocks.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, as query or candidate; only vectors of the same length are
compared; of an id that is repeated the smallest vector counts; equal scores are in
order of the ids; rows with a null id take no part. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gridpanel.llm.common import written

BLOCK_ROWS = 8192
QUERY_ROWS = 1024


@dataclass(frozen=True)
class Collisions:
    lines: int = 96
    half_width: float = 1.0
    slack: float = 1.6
    radius: float = 0.2
    ratio: float = 1.15
    seed: int = 20_240_601

    @property
    def threshold(self) -> int:
        p = 2 * NormalDist().cdf(self.half_width) - 1
        return max(1, round(self.lines * p - self.slack * (self.lines * p * (1 - p)) ** 0.5))


def usable(v: Column) -> Column:
    """Finite components and a length above zero."""
    return (F.coalesce(F.size(v) > 0, F.lit(False))
            & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class BlockIndex:
    """Sorted projections of one block of unit vectors."""

    def __init__(self, x: np.ndarray, by: Collisions):
        self.x, self.by = x, by
        self.line = np.random.default_rng([by.seed, x.shape[1]]).normal(size=(x.shape[1], by.lines))
        at = x @ self.line
        self.order = np.ascontiguousarray(np.argsort(at, axis=0, kind="stable").T)
        self.sorted = np.take_along_axis(np.ascontiguousarray(at.T), self.order, 1)

    def search(self, q: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, cosines) of the verified vectors of each query; ``own[i]`` is the row
        that query i may not find, or -1."""
        n, lines = self.x.shape[0], self.by.lines
        centre = (q @ self.line).T
        lo = np.stack([np.searchsorted(s, c) for s, c in zip(self.sorted, centre, strict=True)])
        hi = lo.copy()
        counts = np.zeros((len(q), n), np.int16)
        rows: list[list[np.ndarray]] = [[] for _ in q]
        cosines: list[list[np.ndarray]] = [[] for _ in q]
        for i, r in enumerate(own):
            if r >= 0:
                counts[i, r] = -2 * lines - 1       # never a candidate
        live = np.arange(len(q))
        radius = self.by.radius
        while len(live):
            last = radius >= 2
            wide = self.by.half_width * radius
            lo_then = np.stack([np.searchsorted(s, c[live] - wide, "left") for s, c in zip(self.sorted, centre, strict=True)])
            hi_then = np.stack([np.searchsorted(s, c[live] + wide, "right") for s, c in zip(self.sorted, centre, strict=True)])
            going = []
            for j, i in enumerate(live.tolist()):
                a, b, c, d = lo_then[:, j].tolist(), lo[:, i].tolist(), hi[:, i].tolist(), hi_then[:, j].tolist()
                found = [o[s:e] for o, s, e in zip(self.order, a, b, strict=True) if s < e]
                found += [o[s:e] for o, s, e in zip(self.order, c, d, strict=True) if s < e]
                mine = counts[i]
                if found:
                    mine += np.bincount(np.concatenate(found), minlength=n).astype(np.int16)
                hit = np.flatnonzero(mine >= (-lines if last else self.by.threshold))
                if len(hit):
                    mine[hit] = -2 * lines - 1      # verified once
                    rows[i].append(hit)
                    cosines[i].append(self.x[hit] @ q[i])
                near = sum(int((c >= 1 - radius * radius / 2).sum()) for c in cosines[i])
                if not last and near < k:
                    going.append(j)
            lo[:, live], hi[:, live] = lo_then, hi_then
            live = live[going]
            radius *= self.by.ratio
        none = np.zeros(0, np.int64), np.zeros(0)
        return [(np.concatenate(r), np.concatenate(c)) if r else none for r, c in zip(rows, cosines, strict=True)]


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if n else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _taking_part(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    good = df.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    return (good.groupBy(F.col(id_col).alias("id")).agg(F.min(vector_col).alias("v"))
            .withColumn("d", F.size("v")))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, by: Collisions | None = None,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, id, score): the ``k`` vectors of the largest cosine found for
    each query among all vectors but the one with the query's own id."""
    by = by or Collisions()
    spark = vectors.sparkSession
    data = written(spark, _taking_part(vectors, id_col, vector_col), "vectors")
    asked = written(spark, _taking_part(queries, id_col, vector_col), "queries")
    id_type = data.schema["id"].dataType.simpleString()

    def blocks(df: DataFrame, rows: int):
        size = {r.d: r.n for r in df.groupBy("d").agg(F.count("*").alias("n")).collect()}
        return {d: -(-n // rows) for d, n in size.items()}

    data_blocks, query_blocks = blocks(data, BLOCK_ROWS), blocks(asked, QUERY_ROWS)
    shared_lengths = sorted(set(data_blocks) & set(query_blocks))
    if not shared_lengths:
        return spark.createDataFrame([], f"query_id {id_type}, rank int, {id_col} {id_type}, score double")

    def lookup(counts):
        return F.create_map(*[F.lit(x) for d in shared_lengths for x in (d, counts[d])])[F.col("d")]

    def dealt(df: DataFrame, own: dict, other: dict, own_name: str, other_name: str) -> DataFrame:
        return (df.where(F.col("d").isin(shared_lengths))
                .withColumn(own_name, F.pmod(F.xxhash64("id"), lookup(own)).cast("int"))
                .withColumn(other_name, F.explode(F.sequence(F.lit(0), lookup(other) - 1))))

    left = dealt(data, data_blocks, query_blocks, "db", "qb")
    right = dealt(asked, query_blocks, data_blocks, "qb", "db")

    def search(rows: pa.Table, questions: pa.Table) -> pa.Table:
        out_q, out_r, out_s = [], [], []
        if rows.num_rows and questions.num_rows:
            x, q = _matrix(rows["v"], rows.num_rows), _matrix(questions["v"], questions.num_rows)
            x, q = unit(x), unit(q)
            ids, wanted = rows["id"].to_pylist(), questions["id"].to_pylist()
            place = {v: i for i, v in enumerate(ids)}
            found = BlockIndex(x, by).search(q, np.array([place.get(w, -1) for w in wanted]), k)
            for i, (hit, cosine) in enumerate(found):
                if len(hit) > k:     # all that may be among the first k, whatever the rounding
                    keep = cosine >= np.partition(cosine, -k)[-k] - 1e-9
                    hit = hit[keep]
                # row by row, so that equal vectors have equal scores
                exact = (x[hit] * q[i]).sum(axis=1)
                best = sorted(zip((-exact).tolist(), [ids[h] for h in hit.tolist()], strict=True))[:k]
                out_q += [wanted[i]] * len(best)
                out_r += [b for _, b in best]
                out_s += [min(1.0, max(-1.0, -a)) for a, _ in best]
        kind = rows.schema.field("id").type
        return pa.table({"query_id": pa.array(out_q, kind), "id": pa.array(out_r, kind),
                         "score": pa.array(out_s, pa.float64())})

    best = (left.groupBy("d", "db", "qb").cogroup(right.groupBy("d", "db", "qb"))
            .applyInArrow(search, f"query_id {id_type}, id {id_type}, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
