"""Near-duplicates by MinHash bands and odd sketches, every link confirmed on full sets.

A document's set are its distinct 3-word shingles, as 64-bit hashes; two sets link when
they share 85 % or more of their union. Equal sets are one class, and classes are compared.

Each class has 128 MinHash samples. The first 60 make 20 bands of 3: a pair at the threshold
shares none of them with probability 5e-9. All are also folded into an odd sketch, 512
bits of which each sample flips one: the bits in which two sketches differ are twice the
samples in which the classes differ, up to flips that meet, so a population count tells
high similarities apart without the sets. A pair that differs in more bits than a linked one
does with probability 1e-9 (``sketch_limit``, from the exact distribution) is no candidate.

Every bucket (classes with the same band) is first tied to one anchor, and each class is
compared with the most similar anchor of its buckets. After that only buckets that still hold
different components count, and only pairs of different components in them. Buckets of up
to ``SMALL`` classes give their candidates as pairs. Wider ones are cut into blocks of
classes; those outside the bucket's largest component meet every block, and a task counts
the overlaps of two blocks exactly and gives a spanning forest of the links it finds. So a
group of near copies is never expanded into its pairs, and none is cut off. Joins in
which an anchor or a bucket is hot are left to adaptive skew splitting.

Defined results: a null, empty or blank text has no shingles and links with nothing, not
even its like; a text of one or two words is one shingle; repeated rows are documents of
the same class; a null id names a component only if all its ids are null. Other columns
are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from gridpanel.llm.common import U, bloom, byte_slices, in_bloom, mix, set_code, written
from gridpanel.llm.jaccard import components

SHINGLE = 3
SHARE = 85                  # percent
BANDS, ROWS = 20, 3
SAMPLES = 128
BITS = 512                  # of an odd sketch
MISS = 1e-9                 # chance that a pair at the threshold fails the sketches
SMALL = 32                  # classes of a bucket whose candidates are given as pairs
BLOCK = 1_000               # classes of a block of a wider bucket, about
BLOCK_SHINGLES = 4_000_000  # and shingles of its sets
SLICE = 1 << 20             # bytes of text at a time
COLUMNS = 4_096             # shingles multiplied at once

ORDINALS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)     # odd: first to third word
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


# ---- sets and sketches ---------------------------------------------------------------

def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words between white space, A-Z in lower case; a long text is read in
    pieces that end where a word does."""
    out, at = [], 0
    while at < len(text):
        cut = _SPACE.search(text, at + SLICE) if at + SLICE < len(text) else None
        end = cut.start() if cut else len(text)
        words = text[at:end].lower().split()        # of bytes: ASCII only
        out.append(np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first hash of each text and the end): per text its sorted distinct shingles."""
    sets = []
    for text in texts:
        w = word_hashes(text or b"")
        n = len(w) - SHINGLE + 1
        if n > 0:
            sets.append(np.unique(mix(sum(w[k:k + n] * U(c) for k, c in enumerate(ORDINALS)))))
        else:
            one = sum((w[k:k + 1] * U(c) for k, c in enumerate(ORDINALS[:len(w)])), np.full(min(len(w), 1), len(w), np.uint64))
            sets.append(mix(one))
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets], dtype=np.int64))) if sets else np.zeros(1, np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), first


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    k = np.arange(SAMPLES, dtype=np.uint64)
    return mix(k) | U(1), mix(k + U(1 << 32))


def min_hashes(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(samples, sets) of the least values of each set under the hash functions."""
    times, plus = _multipliers()
    return np.stack([np.minimum.reduceat(code * a + b, first[:-1]) for a, b in zip(times, plus, strict=True)])


def band_keys(mins: np.ndarray) -> np.ndarray:
    """(sets, bands) of hashes of the bands' samples."""
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64)[:, None], (BANDS, mins.shape[1]))
    for r in range(ROWS):
        key = mix(key ^ mins[r:BANDS * ROWS:ROWS])
    return key.T.view(np.int64)


def odd_sketches(mins: np.ndarray) -> np.ndarray:
    """(sets, words) of the parities of the samples that fall on each bit."""
    n = mins.shape[1]
    bit = mix(mins ^ mix(np.arange(SAMPLES, dtype=np.uint64))[:, None]) % U(BITS)
    out = np.zeros((n, BITS // 64), np.uint64)
    for row in bit:
        out[np.arange(n), (row >> U(6)).astype(np.int64)] ^= U(1) << (row & U(63))
    return out


def sketch_limit(share: float = SHARE / 100, miss: float = MISS) -> int:
    """Differing bits that a pair of this share of common elements exceeds with probability
    ``miss`` at most: differing samples are binomial, and each flips two random bits."""
    odd = np.zeros(BITS + 1)        # distribution of the number of odd bits
    odd[0] = 1.0
    count = np.arange(BITS + 1)
    chance = (share ** SAMPLES)     # of no differing sample
    total = chance * odd
    for d in range(1, SAMPLES + 1):
        for _ in range(2):
            then = np.zeros(BITS + 1)
            then[1:] += odd[:-1] * (BITS - count[:-1]) / BITS
            then[:-1] += odd[1:] * count[1:] / BITS
            odd = then
        chance *= (SAMPLES - d + 1) / d * (1 - share) / share
        total += chance * odd
    above = np.cumsum(total[::-1])[::-1]        # of at least so many
    return int(np.flatnonzero(above > miss)[-1])


def links(overlap, a, b):
    return (overlap > 0) & (100 * overlap >= SHARE * (a + b - overlap))


def alike(a, b):
    """Whether sets of these sizes can link at all."""
    return 100 * np.minimum(a, b) >= SHARE * np.maximum(a, b)


# ---- stages --------------------------------------------------------------------------

def _sets_of(batches):
    """(rows, hashes, beginnings, class of each row and which rows have one)."""
    for batch in batches:
        column = batch.column("text")
        for a, b in byte_slices(column, SLICE):
            rows = batch.slice(a, b - a)
            code, first = shingles(column.slice(a, b - a).cast(pa.binary()).to_pylist())
            n = np.diff(first)
            has, cls = np.flatnonzero(n), np.zeros(len(n), np.int64)
            if len(has):
                cls[has] = set_code(code, np.concatenate((first[:-1][has], first[-1:])))
            yield rows, code, first, n, has, cls


def _fresh(has: np.ndarray, cls: np.ndarray, seen: set) -> list[int]:
    """The rows whose class the task has not met."""
    out = []
    for i, c in zip(has.tolist(), cls[has].tolist(), strict=True):
        if c not in seen:
            seen.add(c)
            out.append(i)
    return out


def _profiles(source: DataFrame) -> DataFrame:
    """Per document: id, size, class (null without shingles), and bands and sketch once for
    each class of a task."""
    def task(batches):
        seen: set[int] = set()
        for rows, code, first, n, has, cls in _sets_of(batches):
            fresh = _fresh(has, cls, seen)
            bands, sketch = [None] * len(n), [None] * len(n)
            if fresh:
                own = np.concatenate([code[first[i]:first[i + 1]] for i in fresh])
                mins = min_hashes(own, np.concatenate(([0], np.cumsum(n[fresh]))))
                for i, k, s in zip(fresh, band_keys(mins), odd_sketches(mins).view(np.int64), strict=True):
                    bands[i], sketch[i] = k, s
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), pa.array(n, pa.int64()), pa.array(cls, pa.int64(), mask=n == 0),
                 pa.array(bands, longs), pa.array(sketch, longs)], ["id", "n", "cls", "bands", "sketch"])

    id_type = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(task, f"id {id_type}, n bigint, cls bigint, bands array<bigint>, sketch array<bigint>")


def _sets(source: DataFrame, classes: DataFrame, needed: DataFrame) -> DataFrame:
    """(cls, set) of the needed classes, and a few more; a class may be there more than
    once. Only documents whose id is that of a needed class, or passes the Bloom filter of
    those by chance, are read for their words again."""
    ids = needed.join(classes.select("cls", "id"), "cls").select(F.xxhash64("id").alias("h")).distinct()
    shared = source.sparkSession.sparkContext.broadcast(bloom(ids))

    def task(batches):
        seen: set[int] = set()
        hit = (b.filter(pa.array(in_bloom(b.column("h").to_numpy().view(np.uint64), *shared.value))) for b in batches)
        for _, code, first, _, has, cls in _sets_of(hit):
            fresh = _fresh(has, cls, seen)
            if fresh:
                code = code.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cls[fresh]), pa.array([code[first[i]:first[i + 1]] for i in fresh], pa.list_(pa.int64()))],
                    ["cls", "set"])

    return source.withColumn("h", F.xxhash64("id")).mapInArrow(task, "cls bigint, set array<bigint>")


def _differing(a: str, b: str) -> Column:
    """Bits in which two sketches differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _confirmed(source: DataFrame, classes: DataFrame, pairs: DataFrame, most: int | None = None) -> DataFrame:
    """The pairs (a, b) that link, by their full sets."""
    spark = source.sparkSession
    pairs = written(spark, pairs, "candidates", most)
    needed = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    sets = written(spark, _sets(source, classes, needed), "sets")
    both = (pairs.join(sets.toDF("b", "set_b"), "b").join(sets.toDF("a", "set_a"), "a"))
    overlap = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - overlap
    return both.where((overlap > 0) & (100 * overlap.cast("long") >= SHARE * union.cast("long"))).select("a", "b").distinct()


def _anchor_pairs(lists: DataFrame, classes: DataFrame, limit: int) -> DataFrame:
    """(a, b): each class with the anchor of its buckets that is most like it by the
    sketches. The anchor of a bucket is the class of the least hash."""
    first = lists.groupBy("key").agg(F.min(F.struct(F.xxhash64("cls"), F.col("cls").alias("a"))).alias("f")).select("key", "f.a")
    found = lists.join(first, "key").where("cls <> a").select(F.col("cls").alias("b"), "a").distinct()
    about = classes.select("cls", "n", "sketch")
    found = (found.join(about.toDF("b", "n_b", "sketch_b"), "b").join(about.toDF("a", "n_a", "sketch_a"), "a")
             .withColumn("off", _differing("sketch_a", "sketch_b"))
             .where((F.col("off") <= limit) & (100 * F.least("n_a", "n_b") >= SHARE * F.greatest("n_a", "n_b"))))
    return found.groupBy("b").agg(F.min(F.struct("off", "a")).alias("m")).select("m.a", "b")


def _small_pairs(lists: DataFrame, limit: int) -> DataFrame:
    """Candidate pairs (a, b) of different components from the rows (key, cls, comp, n,
    sketch) of small buckets."""
    whole = lists.groupBy("key").agg(F.collect_list(F.struct("cls", "comp", "n", "sketch")).alias("e")).select("e")

    def task(batches):
        for batch in batches:
            column = batch.column("e")
            flat = column.flatten()
            cls, comp, n = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("cls", "comp", "n"))
            sketch = flat.field("sketch").flatten().to_numpy().view(np.uint64).reshape(-1, BITS // 64)
            size = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
            left, ends = np.arange(len(cls)), np.repeat(np.cumsum(size), size)
            for away in range(1, int(size.max(initial=1))):     # all buckets at once
                left = left[left + away < ends[left]]
                right = left + away
                ok = (comp[left] != comp[right]) & alike(n[left], n[right])
                i, j = left[ok], right[ok]
                ok = np.bitwise_count(sketch[i] ^ sketch[j]).sum(axis=1) <= limit
                a, b = cls[i[ok]], cls[j[ok]]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return whole.mapInArrow(task, "a bigint, b bigint").distinct()


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """(left, right) of the sizes of the intersections; only shingles of both sides count,
    a bounded number of them at a time."""
    codes = [np.concatenate(side) if side else np.zeros(0, np.uint64) for side in (left, right)]
    owners = [np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right)]
    common = np.intersect1d(*codes)
    places = []
    for code, owner in zip(codes, owners, strict=True):
        at = np.searchsorted(common, code)
        known = at < len(common)
        known[known] = common[at[known]] == code[known]
        order = np.argsort(at[known], kind="stable")
        places.append((at[known][order], owner[known][order]))
    out = np.zeros((len(left), len(right)), np.float32)
    for a in range(0, len(common), COLUMNS):
        x, y = (np.zeros((len(side), COLUMNS), np.float32) for side in (left, right))
        for table, (at, owner) in zip((x, y), places, strict=True):
            lo, hi = np.searchsorted(at, (a, a + COLUMNS))
            table[owner[lo:hi], at[lo:hi] - a] = 1.0
        out += x @ y.T
    return out.astype(np.int64)


def _wide_links(source: DataFrame, classes: DataFrame, lists: DataFrame, limit: int) -> DataFrame:
    """Links (a, b) between different components of wide buckets (rows key, cls, comp, n,
    sketch): of the links that a task finds, a spanning forest."""
    spark = source.sparkSession
    lists = written(spark, lists, "wide")
    per = lists.groupBy("key", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
    per = per.groupBy("key").agg(F.sum("c").alias("c"), F.sum("n").alias("n"), F.max(F.struct("c", "n", "comp")).alias("m"))

    def blocks(c, n):
        return F.ceil(F.greatest(c / BLOCK, n / BLOCK_SHINGLES)).cast("int")

    per = per.select("key", F.col("m.comp").alias("largest"), blocks(F.col("c"), F.col("n")).alias("blocks"),
                     blocks(F.col("c") - F.col("m.c"), F.col("n") - F.col("m.n")).alias("parts"))
    sets = written(spark, _sets(source, classes, lists.select("cls").distinct()).dropDuplicates(["cls"]), "sets")
    rows = lists.drop("c").join(per, "key")
    code = F.xxhash64("cls")
    asked = (rows.withColumn("block", F.pmod(code, F.col("blocks")).cast("int"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    asking = (rows.where("comp <> largest").withColumn("part", F.pmod(code, F.col("parts")).cast("int"))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    on, about = ["key", "block", "part"], ["cls", "comp", "n", "sketch", "set"]
    asked = asked.join(sets, "cls").select(*on, *about)
    asking = asking.join(sets, "cls").select(*[F.col(c).alias(f"q_{c}") for c in (*on, *about)])

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        a, b = [], []
        if index.num_rows and queries.num_rows:
            queries = queries.rename_columns(index.column_names)
            (ca, ka, na, sa), (cb, kb, nb, sb) = (
                (t["cls"].to_numpy(), t["comp"].to_numpy(), t["n"].to_numpy(),
                 np.array(t["sketch"].to_pylist(), np.int64).view(np.uint64))
                for t in (index, queries))
            off = np.zeros((len(ca), len(cb)), np.int32)
            for k in range(BITS // 64):
                off += np.bitwise_count(sa[:, k][:, None] ^ sb[:, k])
            may = (off <= limit) & (ka[:, None] != kb) & alike(na[:, None], nb)
            if may.any():
                i, j = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
                left, right = ([np.asarray(t["set"][int(r)].values).view(np.uint64) for r in at]
                               for t, at in ((index, i), (queries, j)))
                linked = links(overlaps(left, right), na[i][:, None], nb[j]) & may[np.ix_(i, j)]
                above: dict[int, int] = {}

                def top(v: int) -> int:
                    while (u := above.get(v, v)) != v:
                        above[v] = v = above.get(u, u)
                    return v

                for x, y in zip(*np.nonzero(linked), strict=True):
                    u, v = top(int(ka[i[x]])), top(int(kb[j[y]]))     # whole components are tied
                    if u != v:
                        above[u] = v
                        a.append(int(ca[i[x]]))
                        b.append(int(cb[j[y]]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    q_on = [f"q_{c}" for c in on]
    return (asked.repartition(tasks, *on).groupBy(*on).cogroup(asking.repartition(tasks, *q_on).groupBy(*q_on))
            .applyInArrow(run, "a bigint, b bigint"))


def link_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(profiles, labels, links): per document row its id, n and class; per linked class its
    component (a class); the links (a, b) that were needed to tie the components."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    profiles = written(spark, _profiles(source), "profiles")
    classes = written(spark, profiles.where("cls is not null").groupBy("cls").agg(
        F.min("id").alias("id"), F.min("n").alias("n"), F.first("bands", ignorenulls=True).alias("bands"),
        F.first("sketch", ignorenulls=True).alias("sketch")), "classes", profiles.count())
    most = classes.count()
    keys = classes.select(F.explode("bands").alias("key"), "cls")
    shared = keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    lists = written(spark, keys.join(shared, "key"), "lists", BANDS * most)
    limit = sketch_limit()
    near = written(spark, _confirmed(source, classes, _anchor_pairs(lists, classes, limit), most), "anchor-links", most)
    labels = components(spark, near)
    named = lists.join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    mixed = (named.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key"))
    mixed = written(spark, named.join(mixed, "key").join(classes.select("cls", "n", "sketch"), "cls"), "mixed", BANDS * most)
    more = _confirmed(source, classes, _small_pairs(mixed.where(F.col("c") <= SMALL), limit))
    wide = mixed.where(F.col("c") > SMALL).drop("c")
    if wide.limit(1).count():
        more = more.unionByName(_wide_links(source, classes, wide, limit))
    more = written(spark, more, "links")
    if more.limit(1).count():
        near = near.unionByName(more).distinct()
        labels = components(spark, near)
    return profiles.select("id", "n", "cls"), labels, near


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: id, n_shingles, component_id (the smallest id of its component) and
    whether it is the one to keep."""
    profiles, labels, _ = link_classes(docs, id_col, text_col)
    own = profiles.where("cls is not null").groupBy("cls").agg(F.min("id").alias("id"))
    named = own.join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    name = named.groupBy("comp").agg(F.min("id").alias("component_id"))
    of_class = named.join(name, "comp").select("cls", "component_id")
    found = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return (profiles.join(of_class, "cls", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), found.alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))
