"""Toxic passages by maximum-scoring segments of token log-odds.

A word scores the log-odds of occurring in toxic against other training documents.
Its Dirichlet prior comes from its longest known prefix, whose prior comes from the
next shorter one, so that a word never seen inherits what its stem says. One
linear-time scan over the scores (less a drift for each word) finds all maximal
segments. Their scores are put on the extreme-value scale of segments of documents
that are not toxic; those with a small E-value are the toxic passages, and a logistic
curve over the best and the summed normalized scores gives the document's score.

The model is fitted on at most ``per_class`` labelled documents of each class; it is
scored on every word of every text. Nothing but the bounded sample's ids and the
model is broadcast, and no document is shuffled.

A run of letters that is no single word - of a script without spaces, or of more than
LONGEST characters - is scored by overlapping pieces that begin at each of its characters.

Defined results: a null or wordless text has no passages and the score of one without
any; without training rows of both classes every score is 0; repeated rows are
scored row by row. Other columns are ignored (``remove_toxic`` keeps them).
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridpanel.llm.common import byte_slices, fresh, per_worker
from gridpanel.llm.training import labelled_sample, logistic, without_copies

WORD = re.compile(r"[^\W_]+")
#: What ends a word, made a space, in ASCII; ``_kinds`` tells it in other texts.
ASCII_GAPS = {i: " " for i in range(128) if not chr(i).isalnum()}
PREFIXES = (3, 4, 5, 6)     # lengths of the prefixes a word's prior comes from
PREFIXES_DOWN = PREFIXES[::-1]
LONGEST = 40                # a longer run of letters is many words
#: Letters of scripts without spaces: Thai, Lao, Tibetan, Burmese, Khmer, Japanese and Chinese.
UNSPACED = ("\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ece\u0f40-\u0fbc\u1000-\u109f\u1780-\u17d3\u3005-\u3007\u3041-\u309f"
            "\u30a1-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff")
HAS_UNSPACED, RUN = re.compile(f"[{UNSPACED}]"), re.compile(f"[{UNSPACED}]+|[^{UNSPACED}]+")
PER_CLASS = 8_000
MIN_DOCS = 3
PRIOR = 0.15                # the prior is worth so many times the root of the number of documents
DRIFT = 0.5                 # subtracted from every word
REPEAT = 8                  # a word that stands among so many words before it says nothing new
SIGNIFICANT = 0.01          # E-value of a toxic passage
CACHE_WORDS = 150_000
PIECE = 1 << 20             # characters of a text looked up at once
BINS, BIN = 400, 0.1        # of the background's word scores, from -20 on


def _kind(c: str) -> int:
    """0: ends a word, 1: part of one, 2: of a script without spaces."""
    return 2 if HAS_UNSPACED.match(c) else int(c.isalnum())


def _kinds(code: np.ndarray) -> np.ndarray:
    """``_kind`` of each character of an array of code points."""
    table = per_worker(("toxicity kinds",), lambda: np.array([*map(_kind, map(chr, range(1 << 16))), 0], np.uint8))
    kind = table[np.minimum(code, 1 << 16)]
    high = np.flatnonzero(code >= 1 << 16)
    if len(high):
        value, at = np.unique(code[high], return_inverse=True)
        kind[high] = np.array([_kind(chr(c)) for c in value.tolist()], np.uint8)[at]
    return kind


def _plain_words(text: str) -> list[str] | None:
    """The text's words, or None if there are letters of a script without spaces or words of
    more than LONGEST. As ``WORD.findall``, in a fraction of its time."""
    if text.isascii():
        found = text.translate(ASCII_GAPS).split()
    else:
        pieces = []
        for i in range(0, len(text), PIECE):
            code = np.frombuffer(bytearray(text[i:i + PIECE].encode("utf-32-le", "surrogatepass")), "<u4")
            kind = _kinds(code)
            if kind.max() == 2:
                return None
            code[kind == 0] = 32
            pieces.append(code.tobytes().decode("utf-32-le"))
        found = "".join(pieces).split()
    return None if max(map(len, found), default=0) > LONGEST else found


def _runs(text: str) -> list[tuple[int, int]]:
    """Places of the words, those of runs without spaces in pieces."""
    out = []
    for word in WORD.finditer(text):
        for run in RUN.finditer(text, *word.span()):
            a, b = run.span()
            unspaced = HAS_UNSPACED.match(text, a) is not None
            if not unspaced and b - a <= LONGEST:
                out.append((a, b))
                continue
            # two characters of an unspaced script; else as long as the longest prefix,
            # and down to the shortest at the end
            size, least = (2, 2) if unspaced else (PREFIXES[-1], PREFIXES[0])
            out += [(i, min(i + size, b)) for i in range(a, max(a + 1, b - least + 1))]
    return out


def spans(text: str) -> list[tuple[int, int]]:
    """Places [start, end) of the text's words, and of the pieces of runs without spaces."""
    return _runs(text) if _plain_words(text) is None else [word.span() for word in WORD.finditer(text)]


def words_of(text: str) -> list[str]:
    found = _plain_words(text)
    return [text[a:b] for a, b in _runs(text)] if found is None else found


def chain(word: str) -> list[str]:
    """Features of a word from the most general to the word itself ("$" ends it)."""
    return [word[:n] for n in PREFIXES if len(word) > n] + [word + "$"]


def count_features(batches):
    """(feature, documents of label 0, of label 1) by task; partial counts are given
    out when there are many."""
    counts: tuple[Counter, Counter] = Counter(), Counter()

    def out():
        found = list(counts[0].keys() | counts[1].keys())
        rows = pa.RecordBatch.from_arrays(
            [pa.array(found, pa.string()), *(pa.array([c[f] for f in found], pa.int64()) for c in counts)], ["feature", "n0", "n1"])
        for c in counts:
            c.clear()
        return rows

    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            words = set(words_of(text.lower()))
            found = {w + "$" for w in words}        # the words' chains
            for n in PREFIXES:
                found.update([w[:n] for w in words if len(w) > n])
            counts[label].update(found)
            if sum(map(len, counts)) > 300_000:
                yield out()
    yield out()


def log_odds(counts: dict[str, tuple[int, int]], n0: int, n1: int) -> dict[str, float]:
    """Score of each feature under its prior; features that say what their prior says
    are left out."""
    weight = PRIOR / np.sqrt(n0 + n1)
    kept: dict[str, float] = {}
    for f in sorted(counts, key=lambda f: (f.endswith("$"), len(f))):
        above = next((kept[p] for p in reversed(chain(f.rstrip("$"))) if p != f and p in kept and f.startswith(p)), 0.0)
        a, b = counts[f][1] / n1 + weight * np.exp(above / 2), counts[f][0] / n0 + weight * np.exp(-above / 2)
        score = float(np.log(a / b))
        if abs(score - above) > 0.25:
            kept[f] = score
    return kept


class WordScores(dict):
    """Scores by word: always those of the known words, and a bounded number of others, which
    are worked out from their prefixes when first asked for."""

    def __init__(self, odds: dict[str, float]):
        super().__init__()
        self.stems = {f: score - DRIFT for f, score in odds.items() if not f.endswith("$")}
        self.known = {f[:-1]: score - DRIFT for f, score in odds.items() if f.endswith("$")}
        self.most = len(self.known) + CACHE_WORDS
        self.update(self.known)

    def __missing__(self, word: str) -> float:
        if len(self) >= self.most:
            self.clear()
            self.update(self.known)
        stems = self.stems
        for n in PREFIXES_DOWN:
            if len(word) > n and (stem := word[:n]) in stems:
                score = stems[stem]
                break
        else:
            score = -DRIFT
        self[word] = score
        return score


class Scorer:
    """Word scores of texts, with a bounded cache."""

    def __init__(self, odds: dict[str, float]):
        self.cache = WordScores(odds)

    def __call__(self, text: str) -> np.ndarray:
        words = words_of(text.lower())
        scores = np.fromiter(map(self.cache.__getitem__, words), float, len(words))
        for i in np.flatnonzero(scores > 0).tolist():
            if words[i] in words[max(0, i - REPEAT):i]:
                scores[i] = -DRIFT
        return scores


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score), left to right, in linear time.

    Candidates are kept with the sums before (l) and after (r) them. A new positive
    score joins the nearest candidate with a smaller l unless that one's r is as large;
    each candidate remembers which one that was, so none is passed over twice.
    """
    total = np.cumsum(scores)
    at = np.flatnonzero(scores > 0)
    before = np.where(at > 0, total[at - 1], 0.0)
    starts: list[int] = []
    ends: list[int] = []
    left: list[float] = []
    right: list[float] = []
    lower: list[int] = []
    for i, l, r in zip(at.tolist(), before.tolist(), total[at].tolist(), strict=True):
        start = i
        while True:
            j = len(starts) - 1
            while j >= 0 and left[j] >= l:
                j = lower[j]
            if j < 0 or right[j] >= r:
                break
            start, l = starts[j], left[j]
            del starts[j:], ends[j:], left[j:], right[j:], lower[j:]
        starts.append(start)
        ends.append(i + 1)
        left.append(l)
        right.append(r)
        lower.append(j)
    return [(a, b, r - l) for a, b, l, r in zip(starts, ends, left, right, strict=True)]


@dataclass
class ToxicityModel:
    odds: dict[str, float]
    rate: float             # lambda of the extreme-value distribution
    log_k: float            # ln K: what is added to ln(words) for the expected maximum
    weights: np.ndarray     # of best and summed normalized score; intercept

    def normalized(self, segments: list[tuple[int, int, float]], words: int) -> np.ndarray:
        """-ln(E-value) of each segment."""
        return self.rate * np.array([s for _, _, s in segments], float) - self.log_k - np.log(max(1, words))

    def features(self, n: np.ndarray) -> tuple[float, float]:
        """Best and summed evidence of a text, from its normalized segments."""
        significant = n[n >= -np.log(SIGNIFICANT)]
        best = float(n.max()) if len(n) else -10.0
        return min(max(best, -10.0), 15.0), float(np.log1p(significant.sum()))

    def score(self, features: tuple[float, float]) -> float:
        if not self.odds:
            return 0.0
        z = float(np.dot(self.weights[:-1], features) + self.weights[-1])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _background_rate(bins: np.ndarray) -> float:
    """lambda > 0 with mean(exp(lambda * score)) = 1 over the background's word scores
    and one pseudo word of the highest score."""
    values = -20 + BIN * (np.arange(BINS) + 0.5)
    n = bins.astype(float)
    if not n.sum():
        return 1.0
    n[np.searchsorted(values, 8.0)] += 1
    share = n / n.sum()
    low, high = 1e-3, 10.0
    if (share * values).sum() >= 0:
        return low
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (share * np.exp(np.minimum(mid * values, 700))).sum() < 1 else (low, mid)
    return low


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 5, held_out: int = 0,
        per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Fit on at most ``per_class`` labelled documents of each class outside the fold."""
    spark = docs.sparkSession
    sample = without_copies(labelled_sample(docs, labels, label_col, folds, held_out, per_class, id_col, text_col))
    size = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return ToxicityModel({}, 1.0, 0.0, np.zeros(3))
    counted = (sample.mapInArrow(count_features, "feature string, n0 bigint, n1 bigint")
               .groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
               .where(F.col("n0") + F.col("n1") >= MIN_DOCS).toPandas())
    odds = log_odds(dict(zip(counted.feature, zip(counted.n0, counted.n1, strict=True), strict=True)), size[0], size[1])
    shared = spark.sparkContext.broadcast(odds)

    def scan(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            rows, bins = [], np.zeros(BINS, np.int64)
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                scores = scorer(text)
                if label == 0 and len(scores):
                    bins += np.bincount(np.clip((scores + 20) / BIN, 0, BINS - 1).astype(int), minlength=BINS)
                    rows.append((len(scores), max((s for _, _, s in maximal_segments(scores)), default=0.0), None))
            words, best, counts = zip(*[*rows, (0, 0.0, bins.tolist())], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array(best, pa.float64()),
                                              pa.array(counts, pa.list_(pa.int64()))], ["words", "best", "bins"])

    seen = sample.mapInArrow(scan, "words bigint, best double, bins array<bigint>").toPandas()
    rate = _background_rate(np.sum([np.asarray(b) for b in seen.bins if b is not None], axis=0))
    model = ToxicityModel(odds, rate, 0.0, np.zeros(3))
    # Gumbel location of clean documents' best segments: mean less Euler's constant
    clean = seen[seen.words > 0]
    best = rate * clean.best.to_numpy() - np.log(clean.words.to_numpy(float))
    model.log_k = float(np.median(best) + np.log(np.log(2))) if len(best) else 0.0
    calibrated = spark.sparkContext.broadcast(vars(model))

    def evidence(batches):
        model = ToxicityModel(**calibrated.value)
        scorer = Scorer(model.odds)
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                scores = scorer(text)
                found.append(model.features(model.normalized(maximal_segments(scores), len(scores))))
            best, total = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(best, pa.float64()), pa.array(total, pa.float64())],
                                             ["label", "best", "total"])

    # two numbers of each whole training text
    seen = sample.mapInArrow(evidence, "label int, best double, total double").toPandas()
    seen = seen.sort_values(["label", "best", "total"])
    model.weights = logistic(seen[["best", "total"]].to_numpy(), seen.label.to_numpy().astype(float))
    return model


def _scored(batches, text_col: str, shared):
    """(rows, per row (score, segments, their normalized scores, text)) in slices of bounded text."""
    model = ToxicityModel(**shared.value)
    scorer = Scorer(model.odds)
    for batch in batches:
        column = batch.column(text_col)
        for a, b in byte_slices(column, 8 << 20):
            out = []
            for text in column.slice(a, b - a).to_pylist():
                scores = scorer(text or "")
                segments = maximal_segments(scores)
                level = model.normalized(segments, len(scores))
                out.append((model.score(model.features(level)), segments, level, text or ""))
            yield batch.slice(a, b - a), out


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: id, score and the toxic passages (character spans [start, end)
    of the lower-cased text, segment score, E-value)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    passage = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()),
                                  ("e_value", pa.float64())]))

    def passages(segments, level, text):
        chosen = [(segments[i], float(level[i])) for i in np.flatnonzero(level >= -np.log(SIGNIFICANT)).tolist()]
        if not chosen:
            return []
        places = spans(text.lower())
        return [{"start": places[a][0], "end": places[b - 1][1], "score": s, "e_value": float(np.exp(-n))}
                for (a, b, s), n in chosen]

    def task(batches):
        for rows, out in _scored(batches, "text", shared):
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), pa.array([x[0] for x in out], pa.float64()),
                 pa.array([passages(*x[1:]) for x in out], passage)], ["id", "score", "passages"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(
        task, f"id {id_type}, score double, passages array<struct<start:bigint,end:bigint,score:double,e_value:double>>"
    ).withColumnRenamed("id", id_col)


def remove_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents, with all their columns, that score below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def task(batches):
        for rows, out in _scored(batches, text_col, shared):
            yield rows.filter(pa.array([x[0] < threshold for x in out], pa.bool_()))

    return docs.mapInArrow(fresh(task), docs.schema)
