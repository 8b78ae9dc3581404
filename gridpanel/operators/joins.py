"""Join helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
_CONF_KEY = "spark.gridpanel.broadcastMaxBytes"


def broadcast_limit_bytes(df: DataFrame) -> int:
    v = df.sparkSession.conf.get(_CONF_KEY, None)
    return int(v) if v else DEFAULT_BROADCAST_BYTES


_FIXED = {"boolean", "byte", "short", "integer", "long", "float", "double", "date", "timestamp",
          "timestamp_ntz"}


def measured_bytes(df: DataFrame) -> int:
    """In-memory size (UnsafeRow: 8 bytes a field, plus what variable-length values hold),
    from one aggregate over all rows; nested values count by their text."""
    fields = df.schema.fields
    size = F.lit(16 + 8 * len(fields)).cast("long")
    for f in fields:
        if f.dataType.typeName() not in _FIXED:
            c = F.col(f"`{f.name}`")
            text = c if f.dataType.typeName() in ("string", "binary") else F.to_json(F.struct(c))
            size = size + F.coalesce(F.octet_length(text), F.lit(0)) + 8
    return df.agg(F.sum(size).alias("b")).first()["b"] or 0


def sized_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its measured size is under the limit, else ``df`` unchanged.

    The size is measured on the data (one action on the small side, cached so that the
    join does not compute it again); above the limit the join stays a shuffle join, so
    growth of this side can never turn into an oversized broadcast. A lost cached block
    is recomputed from lineage.
    """
    limit = max_bytes if max_bytes is not None else broadcast_limit_bytes(df)
    df = df.cache()
    return F.broadcast(df) if measured_bytes(df) <= limit else df
