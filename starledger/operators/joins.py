"""Dimension joins with a checked broadcast.

A dimension is broadcast only when its measured bytes are under a fixed limit
and broadcasts are not disabled in the session; beyond that the join is left
to the planner, which sort-merges with AQE splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.session import materialize

#: Most bytes of a broadcast side, as measured by ``measured_bytes``.
BROADCAST_LIMIT_BYTES = 8 << 20


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all values as text, plus 16 a value (one aggregate job)."""
    row = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(16))
    return df.agg(F.sum(row.cast("bigint")).alias("b")).first()["b"] or 0


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` (cheap to read: written, or an aggregate of it) may be
    broadcast."""
    disabled = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
    return not disabled and measured_bytes(df) <= BROADCAST_LIMIT_BYTES


def broadcast_if_small(dim: DataFrame) -> DataFrame:
    """``F.broadcast(dim)`` when it fits, else ``dim``; the dimension is
    written once so that the measurement and the join read the same rows."""
    dim = materialize(dim)
    return F.broadcast(dim) if fits_broadcast(dim) else dim
