"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words that cover it whole. Every passage is
encoded (byte-class pairs and word repetition, then a learned layer), gated attention
learned from document labels alone weighs the passages, and the weighted sum of their
encodings gives the document's score.

The network is trained with numpy on at most ``per_class`` labelled documents of each
class; every passage of every text is scored.

Defined results: a null, empty or blank text is a bag of one empty passage; without
training rows of both classes every score is the share of label 1 among them (0
without any); repeated rows are scored row by row. Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gridpanel.llm.common import byte_slices
from gridpanel.llm.training import labelled_sample, without_copies

PASSAGE_WORDS = 64
PER_CLASS = 2_500
MOST_PASSAGES = 200_000 # of a class' training documents; about 100 MB
HIDDEN, GATE = 24, 12
STEPS, BATCH, RATE = 500, 64, 0.01

#: Byte classes: small, large, digit, space, line end, UTF-8 head, UTF-8 tail, end of
#: sentence, comma-like, quote or bracket, and six for other ASCII signs.
CLASSES = 16


def _class_table() -> np.ndarray:
    t = np.full(256, 10, np.uint8)
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                               b" \t\x0b\x0c", b"\r\n")):
        t[list(chars)] = k
    t[0xC0:] = 5
    t[0x80:0xC0] = 6
    for k, chars in ((7, b".?"), (8, b",;:"), (9, b"'\"()[]{}"), (11, b"|"), (12, b"!"), (13, b"$%&#*"),
                     (14, b"<>/=\\"), (15, b"-_+~^@`")):
        t[list(chars)] = k
    return t


TABLE = _class_table()
FEATURES = CLASSES * CLASSES + 4
LONG, BLOCK = 1 << 20, 1_024        # bytes of a long text, passages of its blocks
ROWS = 8_192
WORD = re.compile(rb"[^ \t\n\r\x0b\x0c]+")
SPACES = np.zeros(256, bool)
SPACES[list(b" \t\n\r\x0b\x0c")] = True


def blocks_of(text: bytes) -> list[bytes]:
    """A long text in blocks of whole passages, which are encoded one after the other."""
    at = [m.start() for n, m in enumerate(WORD.finditer(text)) if n % (PASSAGE_WORDS * BLOCK) == 0]
    return [text[a:b] for a, b in zip([0, *at[1:]], [*at[1:], len(text)], strict=True)]


def encode(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """``encode_block`` with bounded memory: texts of more than LONG bytes go in blocks of
    BLOCK passages, between which the line ends."""
    if not any(t and len(t) > LONG for t in texts):
        return encode_block(texts)
    rows, bags = [], []
    for text in texts:
        found = [encode_block([b])[0] for b in (blocks_of(text) if text and len(text) > LONG else [text])]
        rows += found
        bags.append(sum(len(x) for x in found))
    return np.concatenate(rows), np.concatenate(([0], np.cumsum(bags)))


def encode_block(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(passages x FEATURES, first passage of each text and their end).

    Features are square roots of the shares of byte-class pairs, then the share of
    different words, of words equal to the one before, of the most frequent word, and
    the mean word length over 20.
    """
    body = b"\n".join(t or b"" for t in texts) + b"\n"
    data = np.frombuffer(body, np.uint8)
    size = np.array([len(t or b"") + 1 for t in texts])
    begin = np.cumsum(size) - size
    space = SPACES[data]
    head = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    tail = np.flatnonzero(~space & np.concatenate((space[1:], [True]))) + 1
    doc = np.searchsorted(begin, head, "right") - 1
    words = np.bincount(doc, minlength=len(texts))
    bags = np.maximum(1, -(-words // PASSAGE_WORDS))
    first = np.concatenate(([0], np.cumsum(bags)))
    nth = np.arange(len(head)) - (np.cumsum(words) - words)[doc]
    passage = first[doc] + nth // PASSAGE_WORDS
    n = int(first[-1])
    out = np.zeros((n, FEATURES), np.float32)
    if not len(head):
        return out, first
    # byte pairs belong to the passage of the word they begin in or follow; those before the
    # first word to the first passage, those between texts and of blank texts to none
    own = np.repeat(np.arange(len(texts)), size)[:-1]
    word = np.maximum(np.searchsorted(head, np.arange(len(data) - 1), "right") - 1, 0)
    of_byte = np.where(doc[word] == own, passage[word], first[own])
    inside = words[own] > 0
    inside[(begin + size - 1)[:-1]] = False
    kind = TABLE[data].astype(np.int64)
    code = of_byte * CLASSES * CLASSES + kind[:-1] * CLASSES + kind[1:]
    pair = np.bincount(code[inside], minlength=n * CLASSES * CLASSES).reshape(n, -1)
    out[:, :-4] = np.sqrt(pair / np.maximum(1, pair.sum(axis=1, keepdims=True)))
    # words by hash: sum of bytes times odd powers of their place in the word
    place = np.arange(len(data)) - head[np.maximum(np.searchsorted(head, np.arange(len(data)), "right") - 1, 0)]
    power = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))[place % 64]
    value = np.where(space, 0, (data.astype(np.uint64) + 1) * power * (1 + 2 * (place // 64).astype(np.uint64)))
    code = np.add.reduceat(value, head)
    order = np.lexsort((code, passage))
    p, c = passage[order], code[order]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (c[1:] != c[:-1])
    run = np.diff(np.concatenate((np.flatnonzero(new), [len(p)])))
    count = np.maximum(1, np.bincount(passage, minlength=n))
    most = np.zeros(n)
    np.maximum.at(most, p[new], run)
    same = np.zeros(len(head), bool)
    same[1:] = (code[1:] == code[:-1]) & (passage[1:] == passage[:-1])
    out[:, -4] = np.bincount(p[new], minlength=n) / count
    out[:, -3] = np.bincount(passage[same], minlength=n) / count
    out[:, -2] = most / count
    out[:, -1] = np.bincount(passage, tail - head, n) / count / 20
    return out, first


@dataclass
class AttentionNetwork:
    weights: dict[str, np.ndarray]
    base: float = 0.0       # the score where nothing was learned

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        # rows in blocks: a long text has very many, and all but their encodings is let go
        h = np.concatenate([np.tanh(x[a:a + ROWS].astype(float) @ w["encode"] + w["shift"]) for a in range(0, len(x), ROWS)])
        t, g = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        s = (t * g) @ w["attend"]
        s = np.exp(s - np.maximum.reduceat(s, first[:-1])[bag])
        a = s / np.add.reduceat(s, first[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
        logit = z @ w["score"] + w["offset"]
        return {"bag": bag, "h": h, "t": t, "g": g, "a": a, "z": z, "p": 1 / (1 + np.exp(-np.clip(logit, -30, 30)))}

    def gradient(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(x, first)
        bag, h, t, g, a = (f[k] for k in ("bag", "h", "t", "g", "a"))
        d = (f["p"] - y) / len(y)
        dz = (d[:, None] * w["score"])[bag]
        da = (dz * h).sum(axis=1)
        ds = a * (da - np.add.reduceat(a * da, first[:-1])[bag])
        dtg = ds[:, None] * w["attend"]
        dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
        dh = (a[:, None] * dz + dt @ w["tanh"].T + dg @ w["gate"].T) * (1 - h * h)
        return {"encode": x.T @ dh + 1e-4 * w["encode"], "shift": dh.sum(axis=0), "tanh": h.T @ dt, "gate": h.T @ dg,
                "attend": (t * g).T @ ds, "score": f["z"].T @ d + 1e-4 * w["score"], "offset": np.array([d.sum()])}


def train(bags: list[np.ndarray], y: np.ndarray, seed: int = 11) -> AttentionNetwork:
    """Adam on the log loss over batches with as many documents of either class."""
    if len(set(y.tolist())) < 2:
        return AttentionNetwork({}, float(y.mean()) if len(y) else 0.0)
    rng = np.random.default_rng(seed)
    p = {"encode": rng.normal(0, 0.3, (FEATURES, HIDDEN)), "shift": np.zeros(HIDDEN),
         "tanh": rng.normal(0, 0.2, (HIDDEN, GATE)), "gate": rng.normal(0, 0.2, (HIDDEN, GATE)),
         "attend": rng.normal(0, 0.2, GATE), "score": rng.normal(0, 0.2, HIDDEN), "offset": np.zeros(1)}
    m, v = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}
    of_class = [np.flatnonzero(y == k) for k in (0, 1)]
    for step in range(1, STEPS + 1):
        rows = np.concatenate([rng.choice(r, BATCH // 2) for r in of_class])
        first = np.concatenate(([0], np.cumsum([len(bags[i]) for i in rows])))
        g = AttentionNetwork(p).gradient(np.concatenate([bags[i] for i in rows]).astype(float), first, y[rows])
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            p[k] = p[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return AttentionNetwork(p)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 3, held_out: int = 1,
        per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text",
        most_passages: int = MOST_PASSAGES) -> AttentionNetwork:
    """Train on at most ``per_class`` whole labelled documents of each class outside the fold,
    in the order of a hash of their ids, as long as they have no more than ``most_passages``
    passages together (the first document counts whatever its length)."""
    sample = without_copies(labelled_sample(docs, labels, label_col, folds, held_out, per_class, id_col, text_col))

    def bags(batches):
        for batch in batches:
            x, first = encode(batch.column("text").cast(pa.binary()).to_pylist())
            rows = [x[a:b].astype(np.float16).tobytes() for a, b in zip(first.tolist(), first[1:].tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(rows, pa.binary())],
                                             ["id", "label", "bag"])

    id_type = sample.schema["id"].dataType.simpleString()
    # at most 2 * per_class rows are numbered here, by label
    so_far = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id", "row").rowsBetween(Window.unboundedPreceding, -1)
    before = (sample.select("id", "label", F.xxhash64("text").alias("row"), F.size(F.split("text", r"\s+")).alias("words"))
              .withColumn("before", F.sum(F.ceil(F.col("words") / PASSAGE_WORDS)).over(so_far))
              .withColumn("own", F.ceil(F.col("words") / PASSAGE_WORDS))
              .where(F.col("before").isNull() | (F.col("before") + F.col("own") <= most_passages)).select("id", "label", "row"))
    sample = (sample.withColumn("row", F.xxhash64("text")).join(before, ["id", "label", "row"], "left_semi")
              .select("id", "text", "label"))
    rows = sample.mapInArrow(bags, f"id {id_type}, label int, bag binary").toPandas().sort_values(["id", "bag"])
    return train([np.frombuffer(b, np.float16).reshape(-1, FEATURES) for b in rows.bag], rows.label.to_numpy())


def score(docs: DataFrame, net: AttentionNetwork, id_col: str = "doc_id", text_col: str = "text",
          with_passages: bool = False) -> DataFrame:
    """Per document row: id, score, and on request the passages' (first word, attention)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vars(net))
    attention = pa.list_(pa.struct([("first_word", pa.int64()), ("attention", pa.float64())]))

    def task(batches):
        net = AttentionNetwork(**shared.value)
        for batch in batches:
            column = batch.column("text")
            for a, b in byte_slices(column, 2 << 20):
                texts = column.slice(a, b - a).cast(pa.binary()).to_pylist()
                x, first = encode(texts)
                if net.weights:
                    f = net.forward(x, first)
                    p, weight = f["p"], f["a"]
                else:
                    p, weight = np.full(len(texts), net.base), np.repeat(1 / np.diff(first), np.diff(first))
                columns = [batch.column("id").slice(a, b - a), pa.array(p, pa.float64())]
                if with_passages:
                    columns.append(pa.array([[{"first_word": PASSAGE_WORDS * i, "attention": float(w)}
                                              for i, w in enumerate(weight[s:e])]
                                             for s, e in zip(first, first[1:], strict=False)], attention))
                yield pa.RecordBatch.from_arrays(columns, ["id", "score", "passages"][:len(columns)])

    more = ", passages array<struct<first_word:bigint,attention:double>>" if with_passages else ""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(task, f"id {id_type}, score double{more}").withColumnRenamed("id", id_col)
