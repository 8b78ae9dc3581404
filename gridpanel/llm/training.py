"""Bounded samples of labelled documents for the trained operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridpanel.llm.common import U, byte_slices, fresh, mix, written
from gridpanel.llm.jaccard import shingles

BANDS, ROWS = 16, 3
SLICE = 1 << 20


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, folds: int, held_out: int,
                    per_class: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, text, label) of labelled documents outside the held-out fold: of each of
    the labels 0 and 1 the ``per_class`` ids that come first by a hash of the id.

    The ids are at most 2 * per_class and are broadcast; the documents are not shuffled.
    An id with several labels has the larger one; a null text is empty.
    """
    key = F.col(id_col)
    known = (labels.where(key.isNotNull() & F.col(label_col).isin(0, 1) & (fold(id_col, folds) != held_out))
             .groupBy(key.alias("id")).agg(F.max(label_col).cast("int").alias("label")))
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(key.alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("id", "text", "label")


def _bands(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Of each (non-empty) set a hash of each band of its MinHash samples."""
    if not sets:
        return []
    code, first = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    least = np.array([np.minimum.reduceat(mix(code ^ U(k)), first) for k in range(1, BANDS * ROWS + 1)], np.uint64)
    out = np.zeros((BANDS, len(sets)), np.uint64)
    for i in range(ROWS):
        out = mix(out ^ least[i::ROWS])
    return list(np.ascontiguousarray(out.T).view(np.int64))


def without_copies(sample: DataFrame) -> DataFrame:
    """The sample without copies and near copies of a text, written once: a row goes if
    a row of the same label and a smaller id has 75 % or more of their five-word shingles in
    common, checked on the full sets. A group of copies would else count as so many
    witnesses. Rows that share a band of MinHash samples are compared with the smallest."""
    spark, id_type = sample.sparkSession, sample.schema["id"].dataType.simpleString()

    def task(batches):
        for batch in batches:
            column = batch.column("text")
            for a, b in byte_slices(column, SLICE):
                code, first = shingles(column.slice(a, b - a).cast(pa.binary()).to_pylist())
                sets = [np.sort(code[x:y]) if x < y else np.zeros(1, np.uint64)     # texts without words are alike
                        for x, y in zip(first.tolist(), first[1:].tolist(), strict=False)]
                bands = _bands(sets)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, b - a) for c in ("id", "text", "label")),
                     pa.array([s.view(np.int64) for s in sets], longs), pa.array(bands, longs)],
                    ["id", "text", "label", "set", "bands"])

    rows = sample.mapInArrow(fresh(task), f"id {id_type}, text string, label int, set array<bigint>, bands array<bigint>")
    rows = written(spark, rows.withColumn("row", F.xxhash64("id", "text")).dropDuplicates(["label", "row"]), "training-sets")
    keys = rows.select("label", "row", "id", F.posexplode("bands").alias("k", "m"))
    heads = keys.groupBy("label", "k", "m").agg(F.count("*").alias("c"), F.min(F.struct("id", "row")).alias("head")).where("c > 1")
    pairs = (keys.join(heads, ["label", "k", "m"]).where(F.col("row") != F.col("head.row"))
             .select("label", "row", F.col("head.row").alias("head")).distinct())
    sets = rows.select("label", "row", "set")
    both = pairs.join(sets, ["label", "row"]).join(sets.toDF("label", "head", "head_set"), ["label", "head"])
    common = F.size(F.array_intersect("set", "head_set"))
    copies = both.where(100 * common >= 75 * (F.size("set") + F.size("head_set") - common)).select("label", "row").distinct()
    return written(spark, rows.join(copies, ["label", "row"], "left_anti").select("id", "text", "label"), "training")


def logistic(x, y, ridge: float = 1e-3, steps: int = 50):
    """Weights (last: intercept) of a ridge logistic regression by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * len(x) * w
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * len(x) * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
