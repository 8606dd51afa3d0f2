"""Operator 2: mixing sources to target weights by Pfair scheduling.

The rows of each source are put in a fixed random-like order (MD5 of the id)
and cut into blocks of ``block_rows``. Time is counted in slots of one block.
Target weights are rounded to whole slots of a frame of about ``frame`` slots:
a source with a of the frame's Q slots has weight a / Q (at least one slot).
Block k (from 0) of a source is released at floor(k Q / a) and due at
ceil((k + 1) Q / a); in each slot the released block with the earliest
deadline is placed, ties to the source that sorts first. As the weights sum to
one, every block makes its deadline, so at any slot t a source that still has
blocks has had less than one block more or less than t a / Q.

All deadlines of one frame lie within it, so the schedule repeats every frame:
earliest-deadline-first is run for a single frame, in one SQL expression, and
the slot of any block follows by arithmetic. No step depends on the number of
rows but scans, one shuffle of the rows, and the small tables joined to it.

Every row is placed exactly once. A source that has run out leaves its slots
empty; the others keep their slots. Read in the order of ``mix_position``, the
output is the mix; up to the slot where the first source ends it has the target
weights without gaps.

The rank of a row in its source is found without bringing a source together:
rows are dealt to as many hash ranges as the source has blocks, ranges are
counted, counts are summed up in two levels, and only the rows of one range
are ordered.

Only DataFrame and SQL functions are used.

Defined cases: a null source is a source of its own, sorted before all others;
a null id is ordered by its text; repeated rows get places next to each other;
weights of sources that the table lacks are ignored, a source without a weight
gets the smallest given one; a weight must be positive; an empty table gives
no rows. ``mix_slot``, ``mix_position`` and columns starting ``__mix`` of the
input are replaced.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import local_rows

BLOCK_ROWS, FRAME, ALPHA = 64, 1000, 0.7
GROUP = 4096            # hash ranges summed up in one go
BROADCAST_SLOTS = 50_000  # a frame of at most so many slots is broadcast (it has one row a slot)


def _key(source: str) -> Column:
    """Sorts nulls first and tells them from every string."""
    s = F.col(f"`{source}`").cast("string")
    return F.when(s.isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), s))


def shares(counts: DataFrame, weights: dict[str, float] | None = None, frame: int = FRAME, alpha: float = ALPHA) -> DataFrame:
    """__mix_s, n, a: whole slots of each source in a frame. Without weights a
    source's weight is its row count to the power ``alpha``."""
    if weights is None:
        w = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(alpha)))
    else:
        if min(weights.values()) <= 0:
            raise ValueError("weights must be positive")
        given = local_rows(counts.sparkSession, json.dumps([{"k": f"s{k}", "v": v} for k, v in weights.items()]), "k string, v double")
        w = counts.join(given, counts["__mix_s"] == given.k, "left").withColumn("w", F.coalesce("v", F.lit(float(min(weights.values()))))).drop("k", "v")
    total = F.sum("w").over(Window.partitionBy())  # one row a source
    return w.withColumn("a", F.greatest(F.lit(1), F.round(F.col("w") / total * frame)).cast("long")).select("__mix_s", "n", "a")


def frame_slots(share: DataFrame) -> DataFrame:
    """__mix_s, nth, slot, a, q: the slot in a frame of each of a source's a
    blocks, by earliest deadline first. One row holds all sources."""
    one = share.groupBy().agg(F.array_sort(F.collect_list(F.struct("__mix_s", "a"))).alias("src")).withColumn(
        "q", F.aggregate("src", F.lit(0).cast("long"), lambda t, x: t + x["a"]))
    pick = """array_min(transform(filter(sequence(0, size(src) - 1),
                 i -> st.done[i] < src[i].a AND (st.done[i] * q) div src[i].a <= t),
               i -> struct(((st.done[i] + 1) * q + src[i].a - 1) div src[i].a AS due, i AS i))).i"""
    order = F.expr(f"""aggregate(sequence(0L, q - 1),
        named_struct('done', transform(src, x -> 0L), 'picks', cast(array() AS array<int>), 'last', 0),
        (st, t) -> aggregate(array({pick}), st, (s, p) -> named_struct(
            'done', transform(s.done, (d, i) -> d + if(i = p, 1L, 0L)), 'picks', concat(s.picks, array(p)), 'last', p)),
        st -> st.picks)""")
    picks = one.where("q > 0").select("src", "q", F.posexplode(order).alias("slot", "i"))
    picks = picks.select(F.col("src")[F.col("i")]["__mix_s"].alias("__mix_s"), F.col("src")[F.col("i")]["a"].alias("a"), "q", F.col("slot").cast("long").alias("slot"))
    return picks.withColumn("nth", (F.row_number().over(Window.partitionBy("__mix_s").orderBy("slot")) - 1).cast("long"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_rows: int = BLOCK_ROWS, frame: int = FRAME, alpha: float = ALPHA,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with mix_slot and mix_position (slot x block_rows + place in
    the block; unique, and the order of the mix)."""
    kept = [c for c in docs.columns if c not in ("mix_slot", "mix_position") and not c.startswith("__mix")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    text = F.col(f"`{text_col}`") if text_col in kept else F.lit("")
    rows = rows.withColumn("__mix_s", _key(source_col)).withColumn("__mix_h", F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), text, F.lit("")).cast("binary")))
    counts = rows.groupBy("__mix_s").agg(F.count("*").alias("n"))
    share = shares(counts, weights, frame, alpha)
    slots = frame_slots(share)
    total = share.agg(F.sum("a")).first()[0]
    small = (lambda df: F.broadcast(df)) if (total or 0) <= BROADCAST_SLOTS else (lambda df: df)
    # hash ranges: as many as the source has blocks
    ranges = share.select("__mix_s", F.ceil(F.col("n") / block_rows).cast("long").alias("__mix_b"))
    at = F.floor(F.conv(F.substring("__mix_h", 1, 8), 16, 10).cast("long") * F.col("__mix_b") / F.lit(1 << 32)).cast("long")
    rows = rows.join(small(ranges), "__mix_s").withColumn("__mix_b", at)
    per = rows.groupBy("__mix_s", "__mix_b").agg(F.count("*").alias("c")).withColumn("g", F.expr(f"__mix_b div {GROUP}"))
    groups = (per.groupBy("__mix_s", "g").agg(F.sum("c").alias("c"))
              .select("__mix_s", "g", F.coalesce(F.sum("c").over(Window.partitionBy("__mix_s").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("o1")))
    inner = F.coalesce(F.sum("c").over(Window.partitionBy("__mix_s", "g").orderBy("__mix_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = per.withColumn("o2", inner).join(groups, ["__mix_s", "g"]).select("__mix_s", "__mix_b", (F.col("o1") + F.col("o2")).alias("__mix_o"))
    place = Window.partitionBy("__mix_s", "__mix_b").orderBy("__mix_h", F.col(f"`{id_col}`"), text)
    ranked = (rows.join(offsets, ["__mix_s", "__mix_b"]).withColumn("__mix_i", F.col("__mix_o") + F.row_number().over(place) - 1)
              .withColumn("__mix_k", F.expr(f"__mix_i div {block_rows}")))
    share_a = share.select("__mix_s", F.col("a").alias("__mix_a"))
    ranked = ranked.join(small(share_a), "__mix_s").withColumn("nth", F.expr("__mix_k % __mix_a"))
    placed = ranked.join(small(slots.select("__mix_s", "nth", "slot", "q")), ["__mix_s", "nth"])
    slot = F.expr("__mix_k div __mix_a") * F.col("q") + F.col("slot")
    return placed.select(*[F.col(f"`{c}`") for c in kept], slot.alias("mix_slot"), (slot * block_rows + F.expr(f"__mix_i % {block_rows}")).alias("mix_position"))
