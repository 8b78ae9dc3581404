import numpy as np
from pyspark.sql import functions as F

from gridpanel.llm import neighbours as N

SCHEMA = "vec_id bigint, embedding array<float>, id int, v string, d string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x", "y", 2)
                                  for i, v in rows], SCHEMA)


def exact(rows, queries, k):
    good = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        v = np.array(v, np.float32).astype(float)
        if i not in good or tuple(v) < tuple(good[i]):
            good[i] = v
    out = {}
    for q in queries & set(good):
        s = [(-float(np.dot(good[q], v) / np.linalg.norm(good[q]) / np.linalg.norm(v)), i) for i, v in good.items()
             if i != q and len(v) == len(good[q])]
        out[q] = [(i, -a) for a, i in sorted((round(a, 12), i) for a, i in s)[:k]]
    return out


def test_recall_and_scores_on_clusters(spark):
    r = np.random.default_rng(3)
    centres = r.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + 0.7 * r.normal(size=24)).tolist()) for i in range(3000)]
    df = frame(spark, rows)
    got = N.nearest(df, df.where(F.col("vec_id") % 50 == 0), k=5).collect()
    want = exact(rows, {i for i, _ in rows if i % 50 == 0}, 5)
    hit = sum(len({g.vec_id for g in got if g.query_id == q} & {i for i, _ in w}) for q, w in want.items())
    assert hit >= 0.9 * 5 * len(want) and len(got) == 5 * len(want)
    score = {(q, i): s for q, w in want.items() for i, s in w}
    assert all(abs(g.score - score[g.query_id, g.vec_id]) < 1e-9 for g in got if (g.query_id, g.vec_id) in score)
    assert all([g.rank for g in got if g.query_id == q] == [1, 2, 3, 4, 5] for q in want)


def test_odd_vectors_ties_and_repeats(spark):
    rows = [(0, [1, 0]), (1, [2, 0]), (2, [3, 0]), (3, [0, -1]), (4, None), (5, []), (6, [0, 0]), (7, [None, 1]),
            (8, [float("nan"), 1]), (9, [float("inf"), 1]), (10, [1, 0, 0]), (11, [1e-20, 0]), (None, [1, 0]),
            (1, [2, 0]), (2, [5, 5]), (-50, [-1, 0]), (50, [1e30, 1e30])]
    df = frame(spark, rows)
    got = {}
    for g in N.nearest(df, df.where(F.col("vec_id") % 50 == 0), k=4).orderBy("query_id", "rank").collect():
        got.setdefault(g.query_id, []).append((g.vec_id, g.score))
    want = exact(rows, {0, 50, -50}, 4)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(abs(a - b) < 1e-12 for q in want for (_, a), (_, b) in zip(got[q], want[q], strict=True))


def test_few_candidates_and_empty(spark):
    df = frame(spark, [(0, [1, 2]), (1, [2, 1])])
    assert [(g.query_id, g.vec_id) for g in N.nearest(df, df.where("vec_id = 0"), k=5).collect()] == [(0, 1)]
    assert N.nearest(df.limit(0), df, k=5).count() == 0


def test_many_copies_are_all_candidates(spark):
    r = np.random.default_rng(1)
    rows = [(i, [1, 2, 3, 4]) for i in range(400)] + [(400 + i, r.normal(size=4).tolist()) for i in range(100)]
    df = frame(spark, rows)
    got = N.nearest(df, df.where("vec_id = 300"), k=5).orderBy("rank").collect()
    assert [g.vec_id for g in got] == [0, 1, 2, 3, 4]


