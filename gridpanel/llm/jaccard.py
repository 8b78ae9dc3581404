"""N-gram Jaccard join of documents by T-occurrence search (DivideSkip).

A document is the set of its distinct five-word shingles, as 64-bit hashes. Two link when
100 * intersection >= 75 * union, that is when one's inverted lists name the other at least
T times. Equal sets are one class, found by the set's hash, and only classes are compared.

DivideSkip is used twice. Between tasks: a class of n shingles must share one of the
n - T + 1 shingles that are first in a common order (rare ones first, by a count sketch of
the corpus) with whatever it links to. Those prefix lists are the short lists; lists of
one class are dropped where they are made, and what short lists have in common bounds the
overlap of a pair. Within a task: a query's lists over an index shard of whole sets are
split into short ones, merged by counting, and long ones that are never merged: what they
add is probed for the candidates.

Large groups of near copies are first tied to a few anchors (smallest class of those
that share one of four minima and a size band), a linear number of searches; after that
only classes of different components are compared. Prefix lists longer than ``LONG`` are
never paired: classes on them go into index shards by size, and each is searched in the
shards its long lists lead to. So no group is expanded into all its pairs, and none is
cut off.

Hashes of 64 bits stand for shingles and sets; among 10 million documents the chance that
two different sets meet is 3 in a million.

Defined results: a null, empty or blank text has no shingles and links with nothing, not
even its like; a text of one to four words is one shingle; repeated rows are documents
of the same class; a null id never is a component's name, unless all its ids are null.
Other columns are ignored (``keep_one`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gridpanel.llm.common import U as _U, bloom, byte_slices, fresh, in_bloom, mix, set_code, unused, written

SHINGLE = 5
SHARE = 75                  # percent
SKETCH_BITS = 22            # counters of the sketch; 2 bytes each are broadcast
MINIMA = 4
BUCKET_POSTINGS = 500_000   # prefix postings of a bucket, about
LONG = 200                  # classes on a list that is no longer paired
SHARD_SETS = 1_000          # sets in an index shard, about
HOT_QUERIES = 100_000       # queries of more than a shard that are broadcast at most (2 MB)
QUERIES = 2_000             # queries of a shard in one group, about; its sets go to each group
LONG_QUERIES = 250          # the same for long lists, where a query is more work
PROBE = 4                   # listed sets that are counted in the time of a probe, about
SLICE = 1 << 20
PIECE = 1 << 20             # bytes of a long text at a time

#: Odd numbers for a shingle's first to fifth word.
ORDINALS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as were needed."""

    base = 0x2545F4914F6CDD1D
    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, x in (("up", cls.base), ("down", pow(cls.base, -1, 1 << 64))):
                table = np.full(size, x, np.uint64)
                table[0] = 1
                setattr(cls, name, np.cumprod(table))
        return cls.up, cls.down


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, beginnings) of the words of lower-cased bytes that end with a space."""
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    head, tail = edge[::2], edge[1::2]
    # a word's polynomial, from sums up to its ends, moved to its own beginning
    up, down = _Powers.of(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * up[:len(data)], out=total[1:])
    return mix((total[tail] - total[head]) * down[head] + (tail - head).astype(np.uint64)), head


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_word_hashes`` in pieces of about PIECE bytes, cut where a word ends."""
    if len(data) <= 2 * PIECE:
        return _word_hashes(data)
    word, head, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and not (spaces := np.flatnonzero(_SPACE[data[end - 1:end - 1 + PIECE]])).size:
            end += PIECE
        if end < len(data):
            end += int(spaces[0])
        w, h = _word_hashes(data[at:end])
        word.append(w)
        head.append(h + at)
        at = end
    return np.concatenate(word), np.concatenate(head)


def shingles(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first hash of each text and the end): per text its sorted distinct shingles."""
    data = _LOWER[np.frombuffer(b"\n".join(t or b"" for t in texts) + b"\n", np.uint8)]
    size = np.array([len(t or b"") + 1 for t in texts], np.int64)
    word, head = _words(data)       # the last byte is a space, so every word ends
    if not len(head):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    last = np.searchsorted(head, np.cumsum(size))
    words = np.diff(last, prepend=0)
    first = last - words
    count = np.where(words >= SHINGLE, words - SHINGLE + 1, np.minimum(words, 1))
    n = len(word) - SHINGLE + 1
    full = np.zeros(max(0, n), np.uint64)
    for k, c in enumerate(ORDINALS):
        full += word[k:k + len(full)] * _U(c)
    full = mix(full)
    out = []
    for a, w, c in zip(first.tolist(), words.tolist(), count.tolist(), strict=True):
        if w >= SHINGLE:
            code = full[a:a + c]
            code.sort()
            out.append(code)
        else:
            out.append(mix(sum((word[a + k:a + k + 1] * _U(o) for k, o in enumerate(ORDINALS[:w])), np.full(c, w, np.uint64))))
    code = np.concatenate(out)
    first = np.cumsum(count) - count
    new = np.ones(len(code), bool)
    new[1:] = code[1:] != code[:-1]
    new[first[count > 0]] = True
    kept = np.concatenate(([0], np.cumsum(new)))
    return code[new], kept[np.concatenate((first, [len(code)]))]


def required(n: int) -> int:
    """Overlap that a set of n shingles needs with any it links to."""
    return -(-SHARE * n // 100)


def links(overlap: int, a: int, b: int) -> bool:
    return overlap > 0 and 100 * overlap >= SHARE * (a + b - overlap)


# ---- DivideSkip within a task --------------------------------------------------

def merge_skip(lists: list, t: int) -> list[tuple[int, int]]:
    """(value, number of lists) of the values on at least t of the sorted lists of small
    numbers. All lists are merged by counting, in a few array operations."""
    count = np.bincount(np.concatenate(lists))
    value = np.flatnonzero(count >= t)
    return list(zip(value.tolist(), count[value].tolist(), strict=True))


class Shard:
    """Inverted lists over whole sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        code = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(code, kind="stable")     # so the sets on a list are sorted
        new = np.ones(len(code), bool)
        new[1:] = code[order[1:]] != code[order[:-1]]
        self.code, self.first = code[order[new]], np.append(np.flatnonzero(new), len(code))
        self.owner = np.repeat(np.arange(len(sets)), self.size)[order]
        self.token = np.empty(len(code), np.int64)  # of each shingle of each set, its list
        self.token[order] = np.cumsum(new) - 1
        self.asked = np.zeros(len(self.code), bool)

    def search(self, query: np.ndarray) -> list[int]:
        """Sets of the shard that link with the query."""
        n, t = len(query), required(len(query))
        at = np.searchsorted(self.code, query)
        known = at < len(self.code)
        known[known] = self.code[at[known]] == query[known]
        hit = at[known]
        if len(hit) < t:
            return []
        length = self.first[hit + 1] - self.first[hit]
        # DivideSkip's rule for the number of long lists, with its constant 0.01
        held = min(t - 1, int(t / (0.01 * np.log2(int(length.max()) + 1) + 1)))
        hit = hit[np.argsort(length, kind="stable")]
        lists = [self.owner[a:b] for a, b in zip(self.first[hit].tolist(), self.first[hit + 1].tolist(), strict=True)]
        found = merge_skip(lists[:len(lists) - held], t - held)
        if not found:
            return []
        may, count = np.array(found, np.int64).T
        near = 100 * np.minimum(n, self.size[may]) >= SHARE * np.maximum(n, self.size[may])
        may, count = may[near], count[near]
        if not len(may):
            return []
        # what the long lists add: all of it counted, or the candidates' own shingles probed in the query's
        if held and int(length.sum()) <= PROBE * int(self.size[may].sum()):
            count += np.bincount(np.concatenate(lists[len(lists) - held:]), minlength=len(self.size))[may]
        elif held:
            self.asked[hit] = True
            for k, i in enumerate(may.tolist()):
                count[k] = np.count_nonzero(self.asked[self.token[self.begin[i]:self.begin[i] + self.size[i]]])
            self.asked[hit] = False
        return may[100 * count >= SHARE * (n + self.size[may] - count)].tolist()


# ---- stages ---------------------------------------------------------------------

def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def _shingled(batches):
    for batch in batches:
        column = batch.column("text")
        for a, b in byte_slices(column, SLICE):
            yield batch.slice(a, b - a), *shingles(column.slice(a, b - a).cast(pa.binary()).to_pylist())


def _profiles(source: DataFrame) -> DataFrame:
    """Per document: id, size, class (null without shingles) and the set's minima."""
    def task(batches):
        for rows, code, first in _shingled(batches):
            n = np.diff(first)
            has = np.flatnonzero(n)
            own = np.concatenate((first[:-1][has], first[-1:]))
            cls = np.zeros(len(n), np.int64)
            minima = np.zeros((MINIMA, len(n)), np.int64)
            if len(has):
                cls[has] = set_code(code, own)
                for k in range(MINIMA):
                    minima[k, has] = np.minimum.reduceat(mix(code ^ mix(np.array([k + 1], np.uint64))), own[:-1]).view(np.int64)
            flat, offsets = minima.T.ravel(), np.arange(0, MINIMA * len(n) + 1, MINIMA, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), pa.array(n, pa.int64()), pa.array(cls, pa.int64(), mask=n == 0),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["id", "n", "cls", "minima"])

    id_type = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(fresh(task), f"id {id_type}, n bigint, cls bigint, minima array<bigint>")


def _sketch(source: DataFrame) -> np.ndarray:
    """Counts (up to 65535) of the corpus' shingles by the first bits of their hash."""
    cells, parts = 1 << SKETCH_BITS, 64
    step = cells // parts

    def count(batches):
        total, seen = np.zeros(cells, np.uint32), False
        for _, code, _ in _shingled(batches):
            total += np.bincount(code >> _U(64 - SKETCH_BITS), minlength=cells).astype(np.uint32)
            seen = True
        if seen:
            total = np.minimum(total, 65535).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(parts), pa.int32()),
                 pa.array([total[i * step:(i + 1) * step].tobytes() for i in range(parts)], pa.binary())], ["part", "n"])

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(step, np.uint32)
        for x in rows["n"].to_pylist():
            total += np.frombuffer(x, "<u2")
        return pa.table({"part": pa.array([rows["part"][0].as_py()], pa.int32()),
                         "n": pa.array([np.minimum(total, 65535).astype("<u2").tobytes()], pa.binary())})

    out = np.zeros(cells, np.uint16)
    for r in source.mapInArrow(fresh(count), "part int, n binary").groupBy("part").applyInArrow(add, "part int, n binary").collect():
        out[r.part * step:(r.part + 1) * step] = np.frombuffer(r.n, "<u2")
    return out


def _order(code: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Keys of the common order of shingles: rare ones first; of equal keys the smaller shingle."""
    return (counts[code >> _U(64 - SKETCH_BITS)].astype(np.uint64) << _U(48)) | (code & _U((1 << 48) - 1))


def _prefix_lists(source: DataFrame, buckets: int, shared) -> DataFrame:
    """Rows (token, cls, n) of the prefix lists that name two classes or more. ``shared``:
    the sketch, broadcast."""
    def emit(batches):
        counts, seen = shared.value, set()
        for _, code, first in _shingled(batches):
            n = np.diff(first)
            has = np.flatnonzero(n)
            if not len(has):
                continue
            cls = set_code(code, np.concatenate((first[:-1][has], first[-1:])))
            fresh = np.zeros(len(n), bool)
            for i, c in zip(has.tolist(), cls.tolist(), strict=True):
                if c not in seen:       # copies of a text within the task are named once
                    seen.add(c)
                    fresh[i] = True
            key = _order(code, counts)
            inside = np.zeros(len(code), bool)
            for i in np.flatnonzero(fresh).tolist():
                a, b = first[i], first[i + 1]
                size = int(n[i]) - required(int(n[i])) + 1
                inside[a:b] = key[a:b] <= np.partition(key[a:b], size - 1)[size - 1]
            owner = np.repeat(np.arange(len(n)), n)[inside]
            code = code[inside]
            if not len(code):
                continue
            of = np.zeros(len(n), np.int64)
            of[has] = cls
            bucket = (code % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            code, owner, bucket = code[order], owner[order], bucket[order]
            cut = np.concatenate((np.flatnonzero(np.diff(bucket, prepend=-1)), [len(bucket)]))
            packed = [(int(bucket[a]), code[a:b].tobytes(), of[owner[a:b]].tobytes(), n[owner[a:b]].astype("<u4").tobytes())
                      for a, b in zip(cut, cut[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*packed, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                ["bucket", "token", "cls", "n"])

    def group(rows: pa.Table) -> pa.Table:
        token, cls, n = (np.frombuffer(b"".join(rows[c].to_pylist()), t)
                         for c, t in (("token", np.int64), ("cls", np.int64), ("n", "<u4")))
        order = np.lexsort((cls, token))
        token, cls, n = token[order], cls[order], n[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
        token, cls, n = token[new], cls[new], n[new]
        same = token[1:] == token[:-1]
        two = np.concatenate((same, [False])) | np.concatenate(([False], same))
        return pa.table({"token": token[two], "cls": cls[two], "n": n[two].astype(np.int64)})

    return (source.mapInArrow(fresh(emit), "bucket int, token binary, cls binary, n binary")
            .groupBy("bucket").applyInArrow(group, "token bigint, cls bigint, n bigint"))


def _sets(source: DataFrame, classes: DataFrame, needed: DataFrame) -> DataFrame:
    """(cls, set) of the needed classes (column cls). Only documents whose id is that of
    a needed class, or passes its Bloom filter by chance, are shingled again."""
    ids = needed.join(classes.select("cls", "id"), "cls").select(F.xxhash64("id").alias("h")).distinct()
    shared = source.sparkSession.sparkContext.broadcast(bloom(ids))

    def task(batches):
        words, bits = shared.value
        seen = set()
        for batch in batches:
            may = in_bloom(batch.column("h").to_numpy().view(np.uint64), words, bits)
            for _, code, first in _shingled([batch.filter(pa.array(may))]):
                n = np.diff(first)
                has = np.flatnonzero(n)
                if not len(has):
                    continue
                cls = set_code(code, np.concatenate((first[:-1][has], first[-1:])))
                rows = []
                for i, c in zip(has.tolist(), cls.tolist(), strict=True):
                    if c not in seen:
                        seen.add(c)
                        rows.append((c, code[first[i]:first[i + 1]].tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                                      pa.array([r[1] for r in rows], pa.binary())], ["cls", "set"])

    found = source.withColumn("h", F.xxhash64("id")).mapInArrow(fresh(task), "cls bigint, set binary")
    return found.join(needed, "cls", "left_semi").groupBy("cls").agg(F.first("set").alias("set"))


def _search(source: DataFrame, classes: DataFrame, index: DataFrame, queries: DataFrame, at_once: int,
            every: bool = False, sets: DataFrame | None = None) -> DataFrame:
    """Links (a, b) between the classes of each index shard (rows s1, s2, cls) and its
    queries (the same columns): every one, or of the links that a task finds a spanning
    forest, which has the same components and fewer links than classes."""
    spark = source.sparkSession
    index = written(spark, index.distinct(), "index")
    queries = written(spark, queries.distinct(), "queries")
    if sets is None:
        sets = written(spark, _sets(source, classes, index.select("cls").union(queries.select("cls")).distinct()), "sets")
    parts = (queries.groupBy("s1", "s2").agg(F.ceil(F.count("*") / at_once).cast("int").alias("parts")))
    left = (index.join(parts, ["s1", "s2"]).withColumn("s3", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .drop("parts").join(sets, "cls"))
    right = (queries.join(parts, ["s1", "s2"]).withColumn("s3", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
             .drop("parts").join(sets, "cls")
             .select(*[F.col(c).alias(f"q_{c}") for c in ("s1", "s2", "s3", "cls", "set")]))

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        a, b = [], []
        if rows.num_rows and asked.num_rows:
            ids = rows["cls"].to_pylist()
            shard = Shard([np.frombuffer(x, np.uint64) for x in rows["set"].to_pylist()])
            above: dict[int, int] = {}

            def top(v: int) -> int:
                while (u := above.get(v, v)) != v:
                    above[v] = v = above.get(u, u)
                return v

            for c, x in zip(asked["q_cls"].to_pylist(), asked["q_set"].to_pylist(), strict=True):
                for i in shard.search(np.frombuffer(x, np.uint64)):
                    if c == ids[i]:
                        continue
                    u, v = top(c), top(ids[i])
                    if u != v or every:     # of a group's links those that tie it together
                        above[u] = v
                        a.append(min(c, ids[i]))
                        b.append(max(c, ids[i]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    # dealt by number: a few bytes of sets are much work, and must not meet in a few tasks
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left = left.repartition(tasks, "s1", "s2", "s3")
    right = right.repartition(tasks, "q_s1", "q_s2", "q_s3")
    return (left.groupBy("s1", "s2", "s3").cogroup(right.groupBy("q_s1", "q_s2", "q_s3"))
            .applyInArrow(run, "a bigint, b bigint").distinct())


def _search_pairs(source: DataFrame, classes: DataFrame, pairs: DataFrame, every: bool = False) -> DataFrame:
    """Links among pairs (query, member). Queries are dealt into buckets, the members of a
    query that has very many into shards of their own."""
    spark = source.sparkSession
    pairs = written(spark, pairs.distinct(), "pairs")
    # only queries of more than a shard are looked up; they are few, so pairs need not meet by query
    hot = written(spark, pairs.groupBy("query").agg(F.ceil(F.count("*") / SHARD_SETS).alias("salts")).where("salts > 1"), "hot-queries")
    hot = F.broadcast(hot) if hot.count() <= HOT_QUERIES else hot
    buckets = max(1, -(-pairs.count() // SHARD_SETS))
    dealt = (pairs.join(hot, "query", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
             .withColumn("s1", F.when(F.col("salts") > 1, F.col("query")).otherwise(F.pmod(F.xxhash64("query"), F.lit(buckets))))
             .withColumn("s2", F.when(F.col("salts") > 1, F.pmod(F.xxhash64("member"), F.col("salts")) + 1).otherwise(0)))
    return _search(source, classes, dealt.select("s1", "s2", F.col("member").alias("cls")),
                   dealt.select("s1", "s2", F.col("query").alias("cls")), QUERIES, every)


def _anchor_pairs(classes: DataFrame) -> DataFrame:
    """(query, member): for classes that share a minimum and one of two overlapping size
    bands, the smallest class asks for the others."""
    x = F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3))
    keys = classes.select("cls", "n", F.posexplode("minima").alias("k", "m"), F.floor(x).alias("lo"), F.floor(x + 0.5).alias("hi"))
    keys = keys.select("cls", "n", F.explode(F.array(
        F.struct("k", "m", F.lit(0).alias("shift"), F.col("lo").alias("band")),
        F.struct("k", "m", F.lit(1).alias("shift"), F.col("hi").alias("band")))).alias("key"))
    # the tie-break differs by key, so that a class which links with few is no anchor everywhere
    first = (keys.groupBy("key").agg(F.min(F.struct(F.xxhash64("cls", "key.k"), F.col("cls").alias("query"))).alias("f"), F.count("*").alias("c"))
             .where("c > 1").select("key", "f.query"))
    return (keys.join(first, "key").where(F.col("cls") != F.col("query"))
            .select("query", F.col("cls").alias("member")).distinct())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(cls, comp): the smallest class reachable, for all classes with an edge. Each round
    takes the smallest label of the neighbours and then the label of that label."""
    n = 2 * edges.count()       # classes with an edge, at most
    both = written(spark, edges.union(edges.select("b", "a")).toDF("u", "v"), "edges", n)
    labels = written(spark, both.groupBy(F.col("u").alias("cls")).agg(F.least(F.col("cls"), F.min("v")).alias("comp")), "labels", n)
    while True:
        near = (both.join(labels.toDF("v", "comp"), "v").groupBy(F.col("u").alias("cls")).agg(F.min("comp").alias("near")))
        step = labels.join(near, "cls").select("cls", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jumped = (step.join(labels.toDF("comp", "above"), "comp", "left")
                  .select("cls", "old", F.least("comp", F.coalesce("above", "comp")).alias("comp")))
        then = written(spark, jumped, "labels", n)
        labels = then.select("cls", "comp")
        if then.where("old <> comp").limit(1).count() == 0:
            return labels


def _cross_pairs(lists: DataFrame) -> DataFrame:
    """(query, member) of pairs of different components whose common short prefix lists
    leave the required overlap possible. ``lists``: token, cls, n, comp, held (long lists
    on the class's prefix)."""
    whole = lists.groupBy("token").agg(F.sort_array(F.collect_list(F.struct("cls", "n", "comp", "held"))).alias("e"))

    def pair(batches):
        for batch in batches:
            column = batch.column("e")
            flat = column.flatten()
            cls, n, comp, held = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("cls", "n", "comp", "held"))
            size = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
            left = np.arange(len(cls))
            ends = np.repeat(np.cumsum(size), size)
            for away in range(1, int(size.max(initial=1))):     # all lists at once
                left = left[left + away < ends[left]]
                right = left + away
                ok = ((comp[left] != comp[right])
                      & (100 * np.minimum(n[left], n[right]) >= SHARE * np.maximum(n[left], n[right])))
                i, j = left[ok], right[ok]
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (cls[i], cls[j], n[i], n[j], held[i], held[j])],
                                                     ["a", "b", "na", "nb", "ha", "hb"])

    kinds = "a bigint, b bigint, na bigint, nb bigint, ha bigint, hb bigint"
    counted = (whole.select("e").mapInArrow(pair, kinds).groupBy("a", "b").agg(
        F.count("*").alias("c"), *[F.max(x).alias(x) for x in ("na", "nb", "ha", "hb")]))
    needed = F.ceil(F.lit(SHARE) * (F.col("na") + F.col("nb")) / (100 + SHARE))
    rest = F.ceil(F.lit(SHARE) * F.greatest("na", "nb") / 100) - 1
    possible = F.col("c") + F.least("ha", "hb") + rest >= needed
    return counted.where(possible).select(F.col("a").alias("query"), F.col("b").alias("member"))


def _long_places(sets: DataFrame, shared) -> DataFrame:
    """(token, cls, place): the place in the common order that a shingle which may have a long
    list has in its set, for those of the set's prefix."""
    def task(batches):
        counts = shared.value
        for batch in batches:
            token, place, size = [], [], []
            for x in batch.column("set").to_pylist():
                code = np.frombuffer(x, np.uint64)
                key = _order(code, counts)
                last = np.partition(key, k := len(code) - required(len(code)))[k]
                first = np.flatnonzero(key <= last)
                first = first[np.argsort(key[first], kind="stable")]    # sets are sorted, so ties too
                # a list of more than LONG classes is of a shingle that the sketch counts as often
                long_ = np.flatnonzero(counts[code[first] >> _U(64 - SKETCH_BITS)] > min(LONG, 65534))
                token.append(code[first[long_]].view(np.int64))
                place.append(long_)
                size.append(len(long_))
            if size:
                cls = np.repeat(batch.column("cls").to_numpy(), size)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(token)), pa.array(cls), pa.array(np.concatenate(place))],
                                                 ["token", "cls", "place"])

    return sets.select("cls", "set").mapInArrow(fresh(task), "token bigint, cls bigint, place bigint")


def _long_search(source: DataFrame, classes: DataFrame, entries: DataFrame, shared, every: bool = False) -> DataFrame:
    """Links among classes on long prefix lists (rows token, cls, n, comp). On each list
    the classes of its largest component need not ask: the others ask for them.

    Two classes need only meet on the first shingle that they have in common. With n shingles,
    a class has at most n - place left from there on, so it links with sizes up to a reach."""
    sets = written(source.sparkSession, _sets(source, classes, entries.select("cls").distinct()), "sets")
    reach = F.lit(100) * F.col("n") - F.lit(100 + SHARE) * F.col("place")       # in units of 1 / SHARE
    entries = entries.join(_long_places(sets, shared), ["token", "cls"]).withColumn("reach", reach).drop("place")
    least = entries.groupBy("token").agg(F.min("n").alias("least"))
    entries = entries.join(least, "token").where(F.lit(SHARE) * F.col("least") <= F.col("reach")).drop("least")
    entries = written(source.sparkSession, entries, "long-entries")
    largest = (entries.groupBy("token", "comp").agg(F.count("*").alias("k")).groupBy("token")
               .agg(F.max(F.struct("k", "comp")).alias("m")).select("token", F.col("m.comp").alias("largest")))
    asking = entries.join(largest, "token").where("comp <> largest")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.1)))
    members = entries.select("cls", "n", band.alias("s1")).distinct()
    salts = members.groupBy("s1").agg(F.ceil(F.count("*") / SHARD_SETS).alias("salts"))
    index = members.join(salts, "s1").select("cls", "n", "s1", F.pmod(F.xxhash64("cls"), F.col("salts")).alias("s2"))
    placed = entries.select("token", "cls", "reach").join(index, "cls")
    shards = placed.groupBy("token", "s1", "s2").agg(F.min("n").alias("least"), F.max("reach").alias("furthest"))
    low, high = F.pow(F.lit(1.1), F.col("s1")), F.pow(F.lit(1.1), F.col("s1") + 1)
    routes = (asking.select("token", "cls", "n", "reach").join(shards, "token")
              .where((high * 100 / SHARE + 1 >= F.col("n")) & (low * SHARE / 100 - 1 <= F.col("n")))
              .where((F.lit(SHARE) * F.col("least") <= F.col("reach")) & (F.lit(SHARE) * F.col("n") <= F.col("furthest")))
              .select("s1", "s2", "cls"))
    return _search(source, classes, index.select("s1", "s2", "cls"), routes, LONG_QUERIES, every, sets)


def _classes(source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(profiles of the documents, classes with their smallest id), written."""
    spark = source.sparkSession
    profiles = written(spark, _profiles(source), "profiles")
    classes = written(spark, profiles.where("cls is not null").groupBy("cls").agg(
        F.min("id").alias("id"), F.min("n").alias("n"), F.min("minima").alias("minima")), "classes")
    return profiles, classes


def _list_links(source: DataFrame, classes: DataFrame, labels: DataFrame | None, every: bool = False) -> DataFrame:
    """Links (a, b) between classes of different components (``labels``: cls, comp; without
    it each class is one) that share a prefix list."""
    spark = source.sparkSession
    total = classes.agg(F.sum("n").alias("s")).first().s or 0
    buckets = max(1, int(total * (100 - SHARE) // 100) // BUCKET_POSTINGS)
    shared = spark.sparkContext.broadcast(_sketch(source))
    lists = _prefix_lists(source, buckets, shared)
    lists = lists.withColumn("comp", F.col("cls")) if labels is None else (
        lists.join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls")))
    lists = written(spark, lists, "lists")
    size = (lists.groupBy("token").agg(F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high"))
            .where("low <> high"))
    lists = written(spark, lists.join(size.select("token", "size"), "token"), "cross-lists")
    held = lists.where(F.col("size") > LONG).groupBy("cls").agg(F.count("*").alias("held"))
    short = (lists.where(F.col("size") <= LONG).join(held, "cls", "left")
             .select("token", "cls", "n", "comp", F.coalesce("held", F.lit(0)).cast("long").alias("held")))
    found = _search_pairs(source, classes, _cross_pairs(short), every)
    long_ = lists.where(F.col("size") > LONG)
    if long_.limit(1).count():
        found = found.unionByName(_long_search(source, classes, long_.select("token", "cls", "n", "comp"), shared, every))
    return found


def link_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(profiles, labels): per document row its id, n and class; per linked class its
    component (a class)."""
    spark = docs.sparkSession
    source = _source(docs, id_col, text_col)
    profiles, classes = _classes(source)
    near = written(spark, _search_pairs(source, classes, _anchor_pairs(classes)), "anchor-links")
    labels = components(spark, near)
    more = written(spark, _list_links(source, classes, labels), "links")
    if more.limit(1).count():
        labels = components(spark, near.unionByName(more).distinct())
    return profiles, labels


def links_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The whole join: (members, links). Members have each document row's id, n_shingles
    and class (null without shingles; equal sets are one class); links are all pairs of
    classes a < b that link, none left out, so their number is that of the answer. For
    components alone ``join`` is much less work."""
    source = _source(docs, id_col, text_col)
    profiles, classes = _classes(source)
    links = written(docs.sparkSession, _list_links(source, classes, None, every=True).distinct(), "all-links")
    return profiles.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "cls"), links


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: id, n_shingles and component_id, the smallest id of its component."""
    profiles, labels = link_classes(docs, id_col, text_col)
    own = profiles.where("cls is not null").groupBy("cls").agg(F.min("id").alias("id"))
    named = own.join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    name = named.groupBy("comp").agg(F.min("id").alias("component_id"))
    of_class = named.join(name, "comp").select("cls", "component_id")
    return (profiles.join(of_class, "cls", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")))


def _with_class(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """The documents with their class in a further column."""
    def task(batches):
        for batch in batches:
            column = batch.column(text_col)
            for a, b in byte_slices(column, SLICE):
                code, first = shingles(column.slice(a, b - a).cast(pa.string()).cast(pa.binary()).to_pylist())
                n = np.diff(first)
                has, cls = np.flatnonzero(n), np.zeros(len(n), np.int64)
                if len(has):
                    cls[has] = set_code(code, np.concatenate((first[:-1][has], first[-1:])))
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cls, pa.int64(), mask=n == 0)],
                                                 [*rows.schema.names, name])

    return docs.mapInArrow(fresh(task), T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document, with all its columns, of each component: the one of the smallest id;
    of rows that repeat that id, one of the smallest class. Documents without shingles stay."""
    profiles, labels = link_classes(docs, id_col, text_col)
    known = profiles.where("cls is not null").join(labels, "cls", "left")
    kept = (known.groupBy(F.coalesce("comp", "cls").alias("comp"))
            .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "cls")).alias("k")))
    cls, key = unused(docs.columns, "cls"), unused(docs.columns, "row_key")
    kept = kept.select(F.xxhash64("k.id", "k.cls").alias("kept_key"), F.col("k.id").alias("kept_id"),
                       F.col("k.cls").alias("kept_cls"))
    blank = ~F.coalesce(F.col(text_col).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # dealt by one key that no id, class or null makes hot; rows of a kept document meet there
    rows = (_with_class(docs.where(~blank), text_col, cls)
            .withColumn(key, F.xxhash64(F.col(id_col), F.col(cls)))
            .join(kept, (F.col(key) == F.col("kept_key")) & F.col(id_col).eqNullSafe(F.col("kept_id"))
                  & (F.col(cls) == F.col("kept_cls")), "left_semi")
            .dropDuplicates([key]))
    return rows.select(*docs.columns).unionByName(docs.where(blank))
