"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridpanel.session import scratch_path


def byte_slices(column: pa.ChunkedArray | pa.Array, max_bytes: int):
    """Cut a string column into (start, stop) row ranges of about ``max_bytes`` of
    text; one longer text is a range of its own."""
    n = len(column)
    if n == 0:
        return
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > max_bytes:
            yield start, i
            start, held = i, 0
        held += size
    yield start, n


ROWS_A_FILE = 50_000


def written(spark: SparkSession, df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read again:
    computed once, without lineage, readable by every executor. Where it is known that it has
    ``most`` (short) rows at most, it goes into as many files as they need, but two for each
    core at least, instead of one for every shuffle partition."""
    path = scratch_path(spark, name)
    if most is not None:
        df = df.coalesce(max(2 * spark.sparkContext.defaultParallelism, -(-most // ROWS_A_FILE)))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_worker(key: tuple, make):
    """``make()``, kept by this Python worker for its later tasks. Functions that are pickled by
    value bring new globals with every task, so the value hangs on a module of the process;
    of keys with the same first part the last one stays."""
    kept = sys.modules.setdefault("gridpanel_worker_values", types.ModuleType("gridpanel_worker_values")).__dict__
    if kept.get(key[0], (None,))[0] != key:
        kept[key[0]] = (key, make())
    return kept[key[0]][1]


def release(kept: bool = False) -> None:
    """Give back memory that this Python worker's allocators hold but do not use, and with it
    (unless ``kept``) the values of ``per_worker``."""
    if not kept:
        sys.modules.pop("gridpanel_worker_values", None)
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def fresh(task):
    """The task (for ``mapInArrow``), begun without what earlier tasks left in their Python worker,
    those of other operators too, and leaving nothing itself: Spark's workers live on."""
    def run(batches):
        release()
        yield from task(batches)
        release()

    return run


U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with good avalanche (public-domain splitmix64)."""
    x = x + U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def set_code(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One signed 64-bit hash for each (non-empty) set of hashes; ``first`` holds the sets'
    beginnings and the end."""
    total = np.add.reduceat(mix(code), first[:-1])
    other = np.bitwise_xor.reduceat(mix(code ^ U(0xD6E8FEB86659FD93)), first[:-1])
    return mix(total ^ mix(other + (first[1:] - first[:-1]).astype(np.uint64))).view(np.int64)


BLOOM_SHIFTS = (0, 18, 37)  # a filter's positions are these bits of a 64-bit hash
BLOOM_BITS = 25             # of a filter at most: 4 MB


def bloom(hashes: DataFrame) -> tuple[np.ndarray, int]:
    """(words, bits) of a Bloom filter of the column ``h``, built by a bounded aggregate."""
    bits = min(BLOOM_BITS, max(12, int(12 * max(1, hashes.count())).bit_length()))
    cells = 1 << bits
    at = F.explode(F.array(*[F.shiftrightunsigned("h", k).bitwiseAND(F.lit(cells - 1)) for k in BLOOM_SHIFTS]))
    words = (hashes.select(at.alias("at")).groupBy(F.shiftright("at", 5).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 31 as int))")).alias("value")))
    found = words.toPandas()        # at most cells / 32 rows
    out = np.zeros(cells >> 5, np.uint32)
    out[found.word.to_numpy()] = found.value.to_numpy().astype(np.uint32)
    return out, bits


def in_bloom(h: np.ndarray, words: np.ndarray, bits: int) -> np.ndarray:
    """Which of the (unsigned) hashes may be in the filter."""
    may = np.ones(len(h), bool)
    for k in BLOOM_SHIFTS:
        at = (h >> U(k)) & U((1 << bits) - 1)
        may &= (words[(at >> U(5)).astype(np.int64)] >> (at & U(31)).astype(np.uint32)) & 1 == 1
    return may


def expand_ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, value) for every integer value of the ranges [lo, hi)."""
    n = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(lo)), n)
    ends = np.cumsum(n)
    value = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n) + np.repeat(lo, n)
    return which, value


def unused(columns: list[str], name: str) -> str:
    """``name``, lengthened until none of the columns has it (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
