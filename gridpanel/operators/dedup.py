"""Keep-first deduplication and ordering.

``keep_first`` picks, per key, the row that is smallest by an explicit order
(pandas' keep-first relies on physical row order, which Spark does not have).
It is an aggregate (``min_by`` over a struct), so map-side partial aggregation
collapses a hot key inside each task before the shuffle; a window would instead
sort every row of a hot key in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column] | None = None) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (then by all remaining columns,
    so the choice is deterministic). Column order is preserved."""
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    order_cols = [F.col(c) if isinstance(c, str) else c for c in (order or [])]
    tie = [F.col(c) for c in rest]
    ordkey = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order_cols + tie)]) if (order_cols or tie) \
        else F.lit(0)
    payload = F.struct(*[F.col(c) for c in rest]) if rest else F.lit(0)
    out = df.groupBy(*keys).agg(F.min_by(payload, ordkey).alias("_row"))
    return out.select(*[F.col(k) for k in keys], *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*cols)
