"""Benchmark decontamination with suffix arrays over shards of the training text.

A shard is a run of documents inside one task (a bounded amount of text). Its words
become integers of the benchmark's vocabulary, its suffixes are sorted by their
first words, and every test suffix is binary-searched in the sorted order. The
range it finds holds all places of that word window; windows that follow one
another in text and item make up the longest verbatim matches. Nothing is shuffled:
a document is read once, and shards are independent.

The benchmark is measured before it is broadcast. Beyond ``max_benchmark_bytes`` it
is cut by a hash of its ids into parts below that size, each part is searched in
its own pass, and the matches of a text are put together by the text's digest.

Defined results: null or wordless texts have no words and no matches; null or
wordless items match nothing; rows repeated in the documents are answered row by
row; an item id that is repeated stands for all its texts; an item with a null id
marks words as hit but is not named. Other columns of either table are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridpanel.llm.common import byte_slices, expand_ranges, fresh, unused

#: Fixed word pattern on ASCII-lower-cased UTF-8: digits, a-z and everything beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SHARD_BYTES = 4 << 20
MAX_BENCHMARK_BYTES = 2 << 20

MATCHES_AT_ONCE = 1 << 20     # occurrences of windows that a report holds
SPANS = "array<struct<start:int,end:int>>"
MATCH = "item_id string, item_start int, doc_start int, n_words int"


def words(text: bytes | None) -> list[bytes]:
    """bytes.lower() lowers A-Z only, and no byte of a longer UTF-8 sequence is below 0x80."""
    return WORD.findall(text.lower()) if text else []


@dataclass
class TestSet:
    """Windows of the benchmark. A distinct window ("pattern") has packed bounds per
    64-bit column; ``occ_*`` list the places of each pattern in the items."""

    vocab: dict[bytes, int]
    item_ids: list[str | None]
    length: np.ndarray
    bits: int
    low: np.ndarray
    high: np.ndarray
    occ_from: np.ndarray
    occ_item: np.ndarray
    occ_start: np.ndarray

    @property
    def per_column(self) -> int:
        return 64 // self.bits


def build_test_set(items: list[tuple[str | None, bytes | None]], window: int) -> TestSet:
    """Vocabulary and distinct windows of (item id, text) rows."""
    vocab: dict[bytes, int] = {}
    ids: dict[str | None, int] = {}
    places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
    for item_id, text in items:
        coded = [vocab.setdefault(w, len(vocab) + 1) for w in words(text)]
        if not coded:
            continue
        k = ids.setdefault(item_id, len(ids))
        for s in range(max(1, len(coded) - window + 1)):
            places.setdefault(tuple(coded[s:s + window]), []).append((k, s))
    bits = max(1, len(vocab).bit_length())
    per = 64 // bits
    columns = -(-window // per)
    n = len(places)
    length = np.fromiter((len(p) for p in places), np.int64, n)
    low = np.zeros((n, columns), np.uint64)
    high = np.zeros((n, columns), np.uint64)
    full = (1 << bits) - 1
    for i, pattern in enumerate(places):
        for c in range(columns):
            a = b = 0
            for j in range(c * per, min((c + 1) * per, window)):
                known = j < len(pattern)
                a = a << bits | (pattern[j] if known else 0)
                b = b << bits | (pattern[j] if known else full)
            low[i, c], high[i, c] = a, b
    occurrences = [len(v) for v in places.values()]
    flat = [x for v in places.values() for x in v]
    return TestSet(vocab, list(ids), length, bits, low, high,
                   np.concatenate(([0], np.cumsum(occurrences, dtype=np.int64))),
                   np.array([k for k, _ in flat], np.int64), np.array([s for _, s in flat], np.int64))


def suffix_array(coded: np.ndarray, test: TestSet, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes of a shard by their first ``window`` words: (start positions,
    packed keys). Word 0 is unknown to the benchmark or ends a document; a suffix that
    has it within the shortest window can match nothing and is left out."""
    shortest = int(test.length.min())
    n = len(coded)
    unknown = np.flatnonzero(coded == 0)
    following = np.concatenate((unknown, [n]))[np.searchsorted(unknown, np.arange(n))]
    start = np.flatnonzero(following - np.arange(n) >= shortest)
    padded = np.concatenate((coded, np.zeros(window, coded.dtype))).astype(np.uint64)
    per, bits = test.per_column, np.uint64(test.bits)
    keys = np.zeros((test.low.shape[1], len(start)), np.uint64)
    for j in range(window):
        column = keys[j // per]
        column <<= bits
        column |= padded[start + j]
    order = np.lexsort(keys[::-1])
    return start[order], keys[:, order]


def bounds(column: np.ndarray, lo: np.ndarray, hi: np.ndarray, key: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of key[i] in column[lo[i]:hi[i]], for all i at once."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        value = column[np.minimum(mid, len(column) - 1)]
        below = open_ & ((value <= key) if right else (value < key))
        lo = np.where(below, mid + 1, lo)
        hi = np.where(open_ & ~below, mid, hi)
    return lo


def search(keys: np.ndarray, test: TestSet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pattern, first, last) of the patterns that occur: their range in the suffix array."""
    n = keys.shape[1]
    live = np.arange(len(test.length))
    lo, hi = np.zeros(len(live), np.int64), np.full(len(live), n, np.int64)
    for c in range(keys.shape[0]):
        first = bounds(keys[c], lo, hi, test.low[live, c], False)
        last = bounds(keys[c], first, hi, test.high[live, c], True)
        keep = first < last
        live, lo, hi = live[keep], first[keep], last[keep]
        if not len(live):
            break
    return live, lo, hi


@dataclass
class ShardHits:
    """What a shard of texts has of the benchmark: per text the number of words, the hit
    spans (merged runs of hit words) and the items; and every occurrence of a window as
    (pattern, place in the shard). Places and items meet in ``matches`` alone, because a
    common line of many items occurs places x items times."""

    counts: list[int]
    spans: list[list[tuple[int, int]]]
    items: list[list[int]]
    pattern: np.ndarray
    place: np.ndarray
    begin: np.ndarray

    def matches(self, test: TestSet):
        """Arrays (text, item, item start, text start, words) of the longest verbatim
        matches, for a bounded number of occurrences at a time. Windows that follow one
        another in the text and in the item are one match."""
        order = np.argsort(self.pattern, kind="stable")
        place = self.place[order]
        known, first = np.unique(self.pattern[order], return_index=True)
        many = np.diff(np.append(first, len(place)))
        which, occ = expand_ranges(test.occ_from[known], test.occ_from[known + 1])
        by_item = np.argsort(test.occ_item[occ], kind="stable")
        which, occ = which[by_item], occ[by_item]
        item_of = test.occ_item[occ]
        ends = np.flatnonzero(np.diff(item_of, append=-1)) + 1      # of each item's windows
        so_far = np.cumsum(many[which])
        at = 0
        while at < len(occ):
            reach = (so_far[at - 1] if at else 0) + MATCHES_AT_ONCE
            fits = ends[(ends > at) & (so_far[ends - 1] <= reach)]
            to = int(fits[-1]) if len(fits) else int(ends[ends > at][0])
            w, o = which[at:to], occ[at:to]
            each, spot = expand_ranges(first[w], first[w] + many[w])
            item, at_item, at_text = item_of[at:to][each], test.occ_start[o[each]], place[spot]
            size = test.length[known[w[each]]]
            sort = np.lexsort((at_text, at_text - at_item, item))
            item, at_item, at_text, size = item[sort], at_item[sort], at_text[sort], size[sort]
            new = np.ones(len(item), bool)
            new[1:] = (np.diff(item) != 0) | (np.diff(at_text - at_item) != 0) | (np.diff(at_text) != 1)
            head = np.flatnonzero(new)
            run = np.diff(np.append(head, len(item)))
            text = np.searchsorted(self.begin, at_text[head], "right") - 1
            yield text, item[head], at_item[head], at_text[head] - self.begin[text], size[head] + run - 1
            at = to


def search_shard(texts: list[bytes | None], test: TestSet, window: int) -> ShardHits:
    parts, begin, counts, at = [], [], [], 0
    get = test.vocab.get
    for text in texts:
        ws = words(text)
        counts.append(len(ws))
        begin.append(at)
        parts.append(np.fromiter(map(get, ws, repeat(0)), np.int32, len(ws)))
        parts.append(np.zeros(1, np.int32))
        at += len(ws) + 1
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[list[int]] = [[] for _ in texts]
    none = np.zeros(0, np.int64)
    hits = ShardHits(counts, spans, items, none, none, np.array(begin, np.int64))
    if not len(test.length) or not at:
        return hits
    start, keys = suffix_array(np.concatenate(parts), test, window)
    pattern, lo, hi = search(keys, test)
    which, place = expand_ranges(lo, hi)
    if not len(place):
        return hits
    hits.pattern, hits.place = pattern[which], start[place]
    # hit words: merged runs of the windows that occur
    edge = np.zeros(at + window + 1, np.int32)
    np.add.at(edge, hits.place, 1)
    np.add.at(edge, hits.place + test.length[hits.pattern], -1)
    covered = np.concatenate(([0], (np.cumsum(edge) > 0).astype(np.int8)))
    step = np.diff(covered)
    for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True):
        d = int(np.searchsorted(hits.begin, a, "right")) - 1
        spans[d].append((a - begin[d], b - begin[d]))
    # items: each window once for a text, however often it stands there
    text = np.searchsorted(hits.begin, hits.place, "right") - 1
    once = np.unique(np.stack((text, hits.pattern)), axis=1)
    each, occ = expand_ranges(test.occ_from[once[1]], test.occ_from[once[1] + 1])
    for d, k in np.unique(np.stack((once[0][each], test.occ_item[occ])), axis=1).T.tolist():
        items[d].append(k)
    return hits


def _test_sets(benchmark: DataFrame, id_col: str, text_col: str, window: int, max_bytes: int):
    """Broadcast test sets, one for each part of the benchmark of at most ``max_bytes``."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    total = rows.agg(F.sum(F.octet_length("t")).alias("b")).first().b or 0
    n = max(1, -(-total // max_bytes))
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        items = sorted(((r.i, None if r.t is None else r.t.encode()) for r in part.toLocalIterator()),
                       key=lambda x: (x[0] is not None, x[0] or "", x[1] or b""))
        yield spark.sparkContext.broadcast(vars(build_test_set(items, window)))


def _searched(batches, text_col: str, shared, window: int):
    """(record batch slice, test set, hits) for each shard of the batches."""
    test = TestSet(**shared.value)
    for batch in batches:
        column = batch.column(text_col)
        for a, b in byte_slices(column, SHARD_BYTES):
            texts = column.slice(a, b - a).cast(pa.binary()).to_pylist()
            yield batch.slice(a, b - a), test, search_shard(texts, test, window)


def _merged_spans(spans: Column) -> Column:
    """Sorted spans without overlaps."""
    def add(done, span):
        last = F.element_at(done, -1)
        grown = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end")))
        joins = (F.size(done) > 0) & (span["start"] <= F.try_element_at(done, F.lit(-1))["end"])
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), grown)).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), add)


def overlap(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text", window: int = 13,
            max_benchmark_bytes: int = MAX_BENCHMARK_BYTES) -> DataFrame:
    """Per document row: id, n_words, n_hit, spans (runs of hit words as [start, end)) and
    items (ids, sorted, of items with an occurring window; null ids are left out)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    tests = list(_test_sets(benchmark, item_col, item_text_col, window, max_benchmark_bytes))
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    detail = f"spans {SPANS}, items array<string>"

    def found_in(hits: ShardHits, test: TestSet, rows: list[int]):
        names = [sorted(n for k in hits.items[i] if (n := test.item_ids[k]) is not None) for i in rows]
        return [pa.array([[{"start": a, "end": b} for a, b in hits.spans[i]] for i in rows], span_type),
                pa.array(names, pa.list_(pa.string()))]

    def task(shared):
        def run(batches):
            for rows, test, hits in _searched(batches, "text", shared, window):
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), pa.array(hits.counts, pa.int64()), *found_in(hits, test, range(rows.num_rows))],
                    ["id", "n_words", "spans", "items"])
        return run

    def task_part(shared):
        def run(batches):
            for rows, test, hits in _searched(batches, "text", shared, window):
                hit = [i for i, s in enumerate(hits.spans) if s]
                texts = rows.column("text").take(pa.array(hit, pa.int64())).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary()), *found_in(hits, test, hit)],
                    ["digest", "spans", "items"])
        return run

    if len(tests) == 1:
        found = source.mapInArrow(task(tests[0]), f"id {id_type}, n_words bigint, {detail}")
    else:
        parts = None
        for t in tests:
            p = source.mapInArrow(task_part(t), f"digest binary, {detail}").dropDuplicates(["digest"])
            parts = p if parts is None else parts.unionByName(p)
        whole = parts.groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        nothing = docs.sparkSession.sparkContext.broadcast(vars(build_test_set([], window)))
        counted = source.select("id", "text").withColumn("digest", F.unhex(F.sha2("text", 256)))

        def count(batches):
            for rows, _, hits in _searched(batches, "text", nothing, window):
                yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("digest"),
                                                  pa.array(hits.counts, pa.int64())], ["id", "digest", "n_words"])

        found = (counted.mapInArrow(count, f"id {id_type}, digest binary, n_words bigint")
                 .join(whole, "digest", "left").drop("digest"))
        found = (found.withColumn("spans", _merged_spans(F.coalesce("spans", F.array().cast(SPANS))))
                 .withColumn("items", F.coalesce("items", F.array().cast("array<string>"))))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return found.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), "spans", "items")


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text", window: int = 13,
            max_benchmark_bytes: int = MAX_BENCHMARK_BYTES) -> DataFrame:
    """The longest verbatim matches with their places, a row each: id, item_id, item_start,
    doc_start, n_words (in words)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def task(shared):
        def run(batches):
            for rows, test, hits in _searched(batches, "text", shared, window):
                for text, item, at_item, at_text, size in hits.matches(test):
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("id").take(pa.array(text)), pa.array([test.item_ids[k] for k in item.tolist()], pa.string()),
                         *(pa.array(x, pa.int32()) for x in (at_item, at_text, size))],
                        ["id", "item_id", "item_start", "doc_start", "n_words"])
        return run

    out = None
    for shared in _test_sets(benchmark, item_col, item_text_col, window, max_benchmark_bytes):
        part = source.mapInArrow(task(shared), f"id {id_type}, {MATCH}")
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("id", id_col)


def is_contaminated(n_hit, n_words, share: int = 20):
    """At least one in ``share`` words is hit."""
    return (n_hit > 0) & (share * n_hit >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", window: int = 13, share: int = 20,
                      max_benchmark_bytes: int = MAX_BENCHMARK_BYTES) -> DataFrame:
    """The documents, with all their columns, that are not contaminated."""
    tests = list(_test_sets(benchmark, item_col, item_text_col, window, max_benchmark_bytes))
    if len(tests) > 1:
        digest, name = F.sha2(F.col(text_col).cast("string"), 256), unused(docs.columns, "digest")
        texts = docs.select(digest.alias(name), F.col(text_col).cast("string").alias("t")).dropDuplicates([name])
        bad = (overlap(texts, benchmark, name, "t", item_col, item_text_col, window, max_benchmark_bytes)
               .where(is_contaminated(F.col("n_hit"), F.col("n_words"), share)).select(name))
        return docs.withColumn(name, digest).join(bad, name, "left_anti").select(*docs.columns)
    shared = tests[0]

    def task(batches):
        for rows, _, hits in _searched(batches, text_col, shared, window):
            hit = [sum(b - a for a, b in s) for s in hits.spans]
            yield rows.filter(pa.array([not (h > 0 and share * h >= n) for h, n in zip(hit, hits.counts, strict=True)], pa.bool_()))

    return docs.mapInArrow(fresh(task), docs.schema)


def digest_columns(found: DataFrame) -> DataFrame:
    """The query's columns from overlap()'s rows."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))
