"""Keep-first deduplication and duplicate flags.

All three are skew-safe: a key holding a third of all rows is reduced on the
map side before the shuffle (partial ``WindowGroupLimit`` for keep-first,
partial aggregation for counts), or joined on a key that includes the row
position so that it spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] = ("seq",)) -> DataFrame:
    """One row per key: the first by ``order_cols`` (pandas ``keep='first'``).

    NULL keys form one group, as in pandas. ``row_number() = 1`` is planned
    as a partial WindowGroupLimit before the exchange plus a final one after.
    ``dropDuplicates`` is not used: it keeps an arbitrary row.
    """
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return (df.withColumn("_keep_rank", F.row_number().over(w))
              .filter(F.col("_keep_rank") == 1)
              .drop("_keep_rank"))


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
              .filter(F.col("_n") > 1).drop("_n"))


def all_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once (pandas ``keep=False``).

    Semi join on null-safe equality, so a repeated NULL key is listed too.
    """
    dups = duplicated_keys(df, keys)
    dups = dups.select([F.col(k).alias(f"_dk_{k}") for k in keys])
    cond = [df[k].eqNullSafe(dups[f"_dk_{k}"]) for k in keys]
    return df.join(dups, cond, "left_semi")


def first_flag(df: DataFrame, keys: Sequence[str], order_col: str = "seq",
               flag: str = "is_first") -> DataFrame:
    """Add a boolean ``flag``: the row is the first of its key by ``order_col``.

    Keeps every row. The first positions come from a partially aggregated
    ``min`` and are joined back on (key, position), which spreads a hot key
    over many tasks instead of buffering its group in one window task.
    ``order_col`` must be unique within a key.
    """
    firsts = (df.groupBy(*keys).agg(F.min(order_col).alias(order_col))
                .withColumn(flag, F.lit(True)))
    renamed = firsts.select(*[F.col(c).alias(f"_ff_{c}") for c in firsts.columns])
    cond = [df[k].eqNullSafe(renamed[f"_ff_{k}"]) for k in keys]
    cond.append(df[order_col] == renamed[f"_ff_{order_col}"])
    joined = df.join(renamed, cond, "left")
    return (joined.withColumn(flag, F.coalesce(F.col(f"_ff_{flag}"), F.lit(False)))
                  .drop(*[f"_ff_{c}" for c in firsts.columns]))
