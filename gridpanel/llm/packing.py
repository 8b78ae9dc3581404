"""Packing of tokenized documents by patterns fitted with non-negative least squares.

Tasks tokenize whole texts, cut what is longer than a sequence and number the pieces of
each length; the lengths' histogram (one number for each possible length) is all the
driver sees. Patterns of up to three lengths that fill a sequence exactly get repeat
counts by non-negative least squares, rounded down and held to what there is; the rest
is packed by best fit over lengths, largest first. What a pattern takes of a length is
a range of numbers, so tasks look up each piece's sequence and offset on their own.

The token ids are those of a byte-level BPE tokenizer file of the ``tokenizers``
library. Texts that hold none of its special strings are encoded word by word through
a bounded cache; others, and other kinds of tokenizer, by the library as a whole.

Defined results: a null text is empty, an empty one is the end token alone; a repeated
row is another document; an empty table packs into nothing. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from gridpanel.llm.common import byte_slices, per_worker, release, written

CACHE_WORDS = 200_000       # words of at most 40 characters whose ids a worker keeps: 50 MB
SLICE = 1 << 20             # bytes of text at a time
#: Fixed word pattern of byte-level BPE files with use_regex.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# ---- tokenizing ------------------------------------------------------------------

def _byte_of() -> dict[str, int]:
    """Character that stands for a byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others follow from U+0100 in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Encoder:
    """Token ids of a text as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self.whole = path, None
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.words = self._word_encoder(spec)
        self.cache: dict[str, bytes] = {}
        self.cache_words = cache_words
        self.odd_space = re.compile(r" (?!\S)")

    @staticmethod
    def _word_encoder(spec: dict):
        """An encoder of single words if the file is plain byte-level BPE, with ids in
        the order of its merges; None if not."""
        import tiktoken

        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        if (spec.get("normalizer") or model.get("type") != "BPE" or split.get("type") != "ByteLevel"
                or split.get("add_prefix_space") or not split.get("use_regex", True) or model.get("dropout")
                or model.get("ignore_merges") or model.get("byte_fallback")):
            return None
        byte_of = _byte_of()
        added = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in word): i for word, i in model["vocab"].items() if word not in added}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        ids = [model["vocab"][m] for m in merged]
        if ids != sorted(ids) or len(ranks) != 256 + len(ids):
            return None
        return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _encode(self, text: str) -> bytes:
        return np.array(self.words.encode_ordinary(text), "<u4").tobytes()

    def _word(self, chunk: str) -> bytes:
        if len(self.cache) >= self.cache_words:
            self.cache.clear()
        ids = self._encode(" " + chunk)
        if len(chunk) <= 40:
            self.cache[chunk] = ids
        return ids

    def _library(self, text: str) -> bytes:
        if self.whole is None:      # large, and most texts do without
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if self.words is None or any(s in text for s in self.special):
            return self._library(text)
        # A space before a non-space always begins a word of the pattern, so such texts
        # can be encoded between spaces; any other space needs its neighbours.
        if self.odd_space.search(text):
            return self._encode(text)
        first, *rest = text.split(" ")
        get, word = self.cache.get, self._word
        return self._encode(first) + b"".join([get(c) or word(c) for c in rest])


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole sequences, but for the first."""
    if n <= size:
        return [(0, n)]
    first = n % size
    return [(0, first)] * bool(first) + [(a, size) for a in range(first, n, size)]


def tokenized_pieces(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Rows of (id, piece, start, length, ids_crc32) with the task's number ``part`` and
    the piece's number ``nth`` among the task's pieces of its length; on request the ids."""
    id_type = docs.schema[id_col].dataType.simpleString()
    ids_type = ", ids binary" if with_ids else ""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def task(batches):
        encode = per_worker(("encoder", tokenizer), lambda: Encoder(tokenizer))
        end, part = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        nth = [0] * (size + 1)
        for batch in batches:
            column = batch.column("text")
            for a, b in byte_slices(column, SLICE):
                at, out, kept = [], [], []
                for i, text in enumerate(column.slice(a, b - a).to_pylist()):
                    ids = encode(text or "") + end
                    for k, (start, n) in enumerate(cut(len(ids) // 4, size)):
                        own = ids[4 * start:4 * (start + n)]
                        at.append(a + i)
                        out.append((k, start, n, zlib.crc32(own), nth[n]))
                        kept.append(own)
                        nth[n] += 1
                piece, start, n, crc, number = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64()),
                     pa.array([part] * len(at), pa.int32()), pa.array(number, pa.int64()),
                     *([pa.array(kept, pa.binary())] if with_ids else [])],
                    ["id", "piece", "start", "length", "ids_crc32", "part", "nth", *(["ids"] if with_ids else [])])
        release(kept=True)

    return source.mapInArrow(task, f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                   f"part int, nth bigint{ids_type}")


# ---- fitting ---------------------------------------------------------------------

def patterns(size: int) -> np.ndarray:
    """All descending triples (0: none) of lengths with the sum ``size``."""
    out = [(size, 0, 0)]
    for a in range(size - 1, 0, -1):
        for b in range(min(a, size - a), 0, -1):
            c = size - a - b
            if c <= b:
                out.append((a, b, c))
            else:
                break
    return np.array(out, np.int64)


def non_negative_fit(pats: np.ndarray, wanted: np.ndarray, steps: int = 800) -> np.ndarray:
    """Repeat counts x >= 0 with the least squared error of their length counts, by
    accelerated projected gradients. ``wanted[0]`` is unused."""
    n = len(wanted)

    def counts(x):
        return np.bincount(pats.ravel(), np.repeat(x, 3), n)

    def back(r):
        r = r.copy()
        r[0] = 0
        return r[pats].sum(axis=1)

    v = np.ones(len(pats))
    for _ in range(30):
        v = back(counts(v))
        v /= np.linalg.norm(v)
    rate = 1 / (1.02 * np.linalg.norm(back(counts(v))))
    x = y = np.zeros(len(pats))
    t = 1.0
    for _ in range(steps):
        then = np.maximum(0, y - rate * back(counts(y) - wanted))
        if (y - then) @ (then - x) > 0:     # overshot: start the momentum anew
            t, y = 1.0, x
            then = np.maximum(0, y - rate * back(counts(y) - wanted))
        t_then = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = then + (t - 1) / t_then * (then - x)
        x, t = then, t_then
    return x


@dataclass
class Plan:
    """Sequences [first, first + repeats) of each pattern, and for the lookup one slot
    per (length, range of numbers): the first number, its sequence and the offset."""

    patterns: list[tuple[tuple[int, ...], int]]
    slot_length: np.ndarray
    slot_first: np.ndarray
    slot_sequence: np.ndarray
    slot_offset: np.ndarray


def best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: patterns with their repeats. Equal open
    sequences are handled together."""
    open_: dict[int, dict[tuple[int, ...], int]] = {}       # space -> content -> how many
    for length in range(size, 0, -1):
        todo = int(left[length])
        if not todo:
            continue
        placed: list[tuple[tuple[int, ...], int, int]] = []
        for space in sorted(s for s in open_ if s >= length):
            for content in list(open_[space]):
                have = open_[space][content]
                # a sequence takes as many of this length as fit before the next is used
                most = space // length
                full = min(have, todo // most)
                if full:
                    placed.append((content + (length,) * most, space - most * length, full))
                    todo -= full * most
                rest = todo if full < have and todo < most else 0
                if rest:
                    placed.append((content + (length,) * rest, space - rest * length, 1))
                    todo = 0
                used = full + bool(rest)
                if used == have:
                    del open_[space][content]
                else:
                    open_[space][content] = have - used
                if not todo:
                    break
            if not open_[space]:
                del open_[space]
            if not todo:
                break
        if todo:
            most = size // length
            full, rest = divmod(todo, most)
            if full:
                placed.append(((length,) * most, size - most * length, full))
            if rest:
                placed.append(((length,) * rest, size - rest * length, 1))
        for content, space, n in placed:
            here = open_.setdefault(space, {})
            here[content] = here.get(content, 0) + n
    return [(c, n) for by in open_.values() for c, n in by.items()]


def plan_packing(histogram: np.ndarray, size: int) -> Plan:
    """``histogram[n]``: pieces of n ids, n from 1 to ``size``."""
    left = histogram.astype(np.int64).copy()
    pats = patterns(size)
    fitted = non_negative_fit(pats, left.astype(float))
    chosen: list[tuple[tuple[int, ...], int]] = []
    whole = np.floor(fitted + 1e-6).astype(np.int64)
    for i in np.argsort(-whole, kind="stable"):
        if whole[i] == 0:
            break
        content = tuple(int(x) for x in pats[i] if x)
        n = int(min(whole[i], *(left[x] // content.count(x) for x in set(content))))
        if n > 0:
            for x in content:
                left[x] -= n
            chosen.append((content, n))
    chosen += best_fit(left, size)
    taken = np.zeros(size + 1, np.int64)
    slots, sequence = [], 0
    for content, n in chosen:
        offset = 0
        for length in content:
            slots.append((length, int(taken[length]), sequence, offset))
            taken[length] += n
            offset += length
        sequence += n
    table = np.array(sorted(slots), np.int64).reshape(-1, 4)
    return Plan(chosen, *table.T)


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Rows of the pieces with their sequence and the offset in it."""
    spark = docs.sparkSession
    pieces = written(spark, tokenized_pieces(docs, tokenizer, size, end_id, id_col, text_col, with_ids), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begin = counts.withColumn("begin", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    histogram = np.zeros(size + 1, np.int64)
    for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():
        histogram[r.length] = r.n
    shared = spark.sparkContext.broadcast(vars(plan_packing(histogram, size)))
    numbered = (pieces.join(begin, ["part", "length"])
                .select("id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("begin")).alias("number"),
                        *(["ids"] if with_ids else [])))

    def place(batches):
        plan = Plan(**shared.value)
        first_slot = np.searchsorted(plan.slot_length, np.arange(size + 2))
        for batch in batches:
            length, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            # last slot of the length that begins at or below the number
            order = np.lexsort((number, length))
            slot = np.empty(len(order), np.int64)
            for n in np.unique(length):
                own = order[np.searchsorted(length[order], n):np.searchsorted(length[order], n, "right")]
                a, b = first_slot[n], first_slot[n + 1]
                slot[own] = a + np.searchsorted(plan.slot_first[a:b], number[own], "right") - 1
            sequence = plan.slot_sequence[slot] + number - plan.slot_first[slot]
            columns = [batch.column(c) for c in batch.schema.names if c != "number"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(plan.slot_offset[slot])],
                [*(c for c in batch.schema.names if c != "number"), "sequence_id", "offset"])

    kept = numbered.drop("number").schema
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    placed = numbered.mapInArrow(place, f"{types}, sequence_id bigint, offset bigint")
    return placed.withColumnRenamed("id", id_col)
