"""Language identification by a convolutional network over bytes.

Filters of several widths slide over the one-hot bytes of a fixed-length window, their
largest response in the window feeds a softmax. The network is trained with numpy on
windows of a bounded number of labelled documents of each language. To score, filters
become tables over byte pairs, a text is cut into windows that cover it whole, and
the log-probabilities of its windows are averaged by their length.

Defined results: a null text, or one without a letter, is ``und`` with score 1; without
training rows everything is ``und`` with score 0; repeated rows are scored row by row.
Languages are those of the training rows. Other columns are ignored
(``keep_identified`` keeps them).
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridpanel.llm.common import byte_slices, fresh
from gridpanel.llm.training import fold, without_copies

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16            # of each width
PER_LANGUAGE = 1_500    # training documents of a language, about
PER_WINDOWS = 6_000     # training windows of a language, about, out of all windows of those
STEPS, BATCH, RATE = 500, 128, 0.01
LETTER = re.compile(r"[^\W\d_]")
UNDETERMINED = "und"


def to_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode(), np.uint8)


def windows(data: np.ndarray) -> np.ndarray:
    """Rows of WINDOW bytes that cover the data; the last is filled up with zeros."""
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[:len(data)] = data
    return out.reshape(n, WINDOW)


@dataclass
class ByteNetwork:
    languages: list[str]
    taps: dict[int, np.ndarray]     # width -> (width, 256, filters)
    bias: np.ndarray                # of the pooled responses
    head: np.ndarray                # (widths * filters, languages)
    offset: np.ndarray

    def tables(self) -> dict[int, list[tuple[int, bool, np.ndarray]]]:
        """Per width the (position, over pairs?, table) lookups that sum to a response."""
        out = {}
        for width, tap in self.taps.items():
            parts = [(k, True, (tap[k][:, None, :] + tap[k + 1][None, :, :]).reshape(65536, -1).astype(np.float32))
                     for k in range(0, width - 1, 2)]
            if width % 2:
                parts.append((width - 1, False, tap[width - 1].astype(np.float32)))
            out[width] = parts
        return out


class Identifier:
    def __init__(self, net: ByteNetwork):
        self.net, self.tables = net, net.tables() if net.languages else {}

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """(windows, languages)"""
        out = np.empty((len(x), len(self.net.languages)))
        for a in range(0, len(x), 64):
            block = x[a:a + 64]
            pair = block[:, :-1].astype(np.int32) * 256 + block[:, 1:]
            pooled = []
            for width, parts in self.tables.items():
                n = WINDOW - width + 1
                response = None
                for k, pairs, table in parts:
                    found = np.take(table, (pair if pairs else block)[:, k:k + n], axis=0)
                    response = found if response is None else np.add(response, found, out=response)
                pooled.append(response.max(axis=1))
            z = np.maximum(np.hstack(pooled) + self.net.bias, 0) @ self.net.head + self.net.offset
            z -= z.max(axis=1, keepdims=True)
            out[a:a + 64] = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        return out

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNDETERMINED, 1.0)] * len(texts)
        if not self.net.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        lettered = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
        if not lettered:
            return out
        data = [to_bytes(texts[i]) for i in lettered]
        cut = [windows(d) for d in data]
        logs = self.log_probabilities(np.concatenate(cut))
        at = 0
        for i, d, c in zip(lettered, data, cut, strict=True):
            weight = np.full(len(c), WINDOW, float)
            weight[-1] = len(d) - WINDOW * (len(c) - 1)
            mean = weight @ logs[at:at + len(c)] / weight.sum()
            at += len(c)
            p = np.exp(mean - mean.max())
            p /= p.sum()
            best = int(p.argmax())
            out[i] = (self.net.languages[best], float(p[best]))
        return out


def train(x: np.ndarray, y: np.ndarray, languages: list[str], seed: int = 7) -> ByteNetwork:
    """Adam on the softmax loss. Only the position of a filter's largest response gets
    its gradient, so a step touches few table rows."""
    rng = np.random.default_rng(seed)
    p: dict[object, np.ndarray] = {w: rng.normal(0, 0.1, (w, 256, FILTERS)) for w in WIDTHS}
    p |= {"bias": np.zeros(len(WIDTHS) * FILTERS), "offset": np.zeros(len(languages)),
          "head": rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(languages)))}
    m, v = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}
    of_language = [np.flatnonzero(y == k) for k in range(len(languages))]
    filters = np.arange(FILTERS)
    for step in range(1, STEPS + 1):
        rows = np.concatenate([rng.choice(r, max(1, BATCH // len(languages))) for r in of_language])
        xb, yb = x[rows].copy(), y[rows]
        short = rng.random(len(xb)) < 0.3       # texts of less than a window
        for i in np.flatnonzero(short):
            xb[i, rng.integers(8, WINDOW):] = 0
        pooled, where = [], {}
        for w in WIDTHS:
            n = WINDOW - w + 1
            response = sum(p[w][k][xb[:, k:k + n]] for k in range(w))
            where[w] = response.argmax(axis=1)
            pooled.append(np.take_along_axis(response, where[w][:, None, :], 1)[:, 0])
        h = np.maximum(np.hstack(pooled) + p["bias"], 0)
        z = h @ p["head"] + p["offset"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        d = z / z.sum(axis=1, keepdims=True)
        d[np.arange(len(yb)), yb] -= 1
        d /= len(yb)
        dh = (d @ p["head"].T) * (h > 0)
        g = {"head": h.T @ d + 1e-4 * p["head"], "offset": d.sum(axis=0), "bias": dh.sum(axis=0)}
        for j, w in enumerate(WIDTHS):
            g[w] = np.zeros_like(p[w])
            own = dh[:, j * FILTERS:(j + 1) * FILTERS]
            for k in range(w):
                np.add.at(g[w][k], (np.take_along_axis(xb, where[w] + k, 1), filters[None, :]), own)
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            p[k] = p[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return ByteNetwork(languages, {w: p[w] for w in WIDTHS}, p["bias"], p["head"], p["offset"])


def fit(docs: DataFrame, folds: int = 4, held_out: int = 2, per_language: int = PER_LANGUAGE, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang", per_windows: int = PER_WINDOWS) -> ByteNetwork:
    """Train on about ``per_language`` labelled documents of each language outside the
    fold, chosen by a hash of the id, and on about ``per_windows`` of all the windows of
    these whole texts, by chance. A repeated id counts once in its language, and so do near
    copies."""
    known = (docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col, folds) != held_out))
             .select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"))
             .where(F.col("text").isNotNull()))
    size = {r.lang: r.n for r in known.groupBy("lang").agg(F.approx_count_distinct("id").alias("n")).collect()}
    if not size:
        return ByteNetwork([], {}, *(np.zeros(0) for _ in range(3)))
    languages = sorted(size)
    every = F.create_map(*[F.lit(x) for k in languages for x in (k, max(1, size[k] // per_language))])
    label = F.create_map(*[F.lit(x) for i, k in enumerate(languages) for x in (k, i)])
    chosen = (known.where(F.pmod(F.xxhash64("id"), every[F.col("lang")]) == 0)
              .groupBy("id", label[F.col("lang")].alias("label")).agg(F.min("text").alias("text")))
    sample = without_copies(chosen.select("id", "text", "label"))

    windows_of = {r.label: r.n for r in sample.groupBy("label").agg(
        F.sum(F.ceil(F.greatest(F.octet_length("text"), F.lit(1)) / WINDOW)).alias("n")).collect()}
    share = {k: min(1.0, per_windows / n) for k, n in windows_of.items()}

    def cut(batches):
        for batch in batches:
            lang, window = [], []
            for key, k, text in zip(*(batch.column(c).to_pylist() for c in ("id", "label", "text")), strict=True):
                if not LETTER.search(text):
                    continue
                rows = windows(to_bytes(text))
                taken = np.random.default_rng(zlib.crc32(str(key).encode())).random(len(rows)) < share[k]
                lang += [languages[k]] * int(taken.sum())
                window += [row.tobytes() for row in rows[taken]]
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(window, pa.binary())],
                                             ["lang", "window"])

    rows = sample.mapInArrow(fresh(cut), "lang string, window binary").toPandas().sort_values(["lang", "window"])
    languages = sorted(set(rows.lang))
    if not languages:
        return ByteNetwork([], {}, *(np.zeros(0) for _ in range(3)))
    x = np.frombuffer(b"".join(rows.window), np.uint8).reshape(-1, WINDOW)
    return train(x, np.searchsorted(languages, rows.lang.to_numpy()), languages)


def _identified(batches, text_col: str, shared):
    identify = Identifier(ByteNetwork(**shared.value))
    for batch in batches:
        column = batch.column(text_col)
        for a, b in byte_slices(column, 2 << 20):
            yield batch.slice(a, b - a), identify(column.slice(a, b - a).to_pylist())


def identify(docs: DataFrame, net: ByteNetwork, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: id, lang_pred, score."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vars(net))

    def task(batches):
        for rows, found in _identified(batches, "text", shared):
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["id", "lang_pred", "score"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return (source.mapInArrow(fresh(task), f"id {id_type}, lang_pred string, score double").withColumnRenamed("id", id_col))


def keep_identified(docs: DataFrame, net: ByteNetwork, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The documents, with all their columns, whose language is found with a score of
    ``least`` or more; undetermined ones go."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(net))

    def task(batches):
        for rows, found in _identified(batches, text_col, shared):
            yield rows.filter(pa.array([lang != UNDETERMINED and p >= least for lang, p in found], pa.bool_()))

    return docs.mapInArrow(fresh(task), docs.schema)
