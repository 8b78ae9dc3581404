"""Text normalisation as JVM-side expressions.

``fold_ascii(c)`` = trim Unicode whitespace at both ends, compatibility-decompose
(NFKD) and drop every non-ASCII character. NFKD followed by dropping non-ASCII
is a per-character map (the only characters NFKD reorders are combining marks,
which are dropped anyway), so the fold is built from tables generated at import
time from ``unicodedata``:

* characters whose ASCII fold is one character -> one ``translate`` call;
* characters whose ASCII fold is several characters -> a map applied with
  ``transform`` over the characters, only on rows that contain one of them;
* everything else non-ASCII -> deleted by one ``regexp_replace``.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


@functools.lru_cache(maxsize=1)
def _tables():
    single_src, single_dst, multi = [], [], {}
    spaces = []
    for cp in range(sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if ch.isspace():
            spaces.append(ch)
        if cp < 0x80:
            continue
        folded = "".join(c for c in unicodedata.normalize("NFKD", ch) if ord(c) < 0x80)
        if len(folded) == 1:
            single_src.append(ch)
            single_dst.append(folded)
        elif len(folded) > 1:
            multi[ch] = folded
    return "".join(single_src), "".join(single_dst), multi, spaces


def strip_unicode(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.btrim(c, F.lit("".join(_tables()[3])))


def fold_ascii_untrimmed(c: Column) -> Column:
    """Per-character ASCII fold. Membership tests use ``translate`` (a hash lookup
    per character) rather than a regex character class, whose cost grows with
    the class size; pure-ASCII rows skip the fold after one cheap scan."""
    src, dst, multi, _ = _tables()
    keys = list(multi)
    mmap = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]),
                             F.array(*[F.lit(multi[k]) for k in keys]))
    has_multi = F.length(F.translate(c, "".join(keys), "")) != F.length(c)
    expanded = F.when(
        has_multi,
        F.array_join(F.transform(F.split(c, ""), lambda ch: F.coalesce(F.element_at(mmap, ch), ch)), ""),
    ).otherwise(c)
    folded = F.regexp_replace(F.translate(expanded, src, dst), "[^\\x00-\\x7F]", "")
    return F.when(c.rlike("[^\\x00-\\x7F]"), folded).otherwise(c)


def fold_ascii(c: Column) -> Column:
    """trim -> NFKD -> drop non-ASCII (the name normalisation of the lookup cascade)."""
    return fold_ascii_untrimmed(strip_unicode(c))


def fold_ascii_py(s: str) -> str:
    """Plain-Python definition of the same fold (tests compare against it)."""
    s = s.strip()
    return unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii")
