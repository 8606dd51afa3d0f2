"""Operator 10: exact top-k search over an impact-ordered index.

Each component x of a vector becomes floor(1024 x); the score is the integer
inner product. Queries are the rows whose id is divisible by ``every``.

Vectors are dealt into shards of about ``SHARD`` rows by a hash of the id. A
shard's index keeps, for each dimension, its postings ordered by value. A
query takes them score-at-a-time: it falls through quantised impact levels
(the greatest possible contribution of any posting, halved step by step, then
zero), and at each level adds every posting, of whatever dimension, whose
contribution lies in the level. What a vector has not shown yet can add at
most the level for each dimension, which bounds its score. The search stops
only when the bound proves all but a few vectors to be under the k-th best
exact score seen; every vector that may still belong is scored exactly.

Queries meet shards in blocks: a shard is paired with at most ``BLOCK``
queries a task, so both sides of a task are bounded. A task returns at most k
rows for a query; a window over those gives the final ranks.

Defined cases: vectors that are null, empty, or hold a null or non-finite
component take no part, nor do rows with a null id; a shorter vector counts
as filled up with zeros; rows that repeat the query's id are the query's own
and no candidates; other repeated rows are candidates each; of
rows that repeat a query's id the smallest vector is the query; ties go to the
smaller id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K, EVERY, SCALE = 10, 100, 1024
SHARD, BLOCK, FEW = 16_384, 16_384, 256


def quantise(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v (array of long) of the vectors that take part."""
    x = F.col(vector_col)
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return (vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0)).where(F.coalesce(good, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long")).alias("v")))


def _matrix(lists, width: int) -> np.ndarray:
    if all(len(v) == width for v in lists):
        return np.array([np.asarray(v, dtype=np.int64) for v in lists], dtype=np.int64).reshape(len(lists), width)
    out = np.zeros((len(lists), width), dtype=np.int64)
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


class ImpactIndex:
    """Postings of one shard: for each dimension the rows and values in
    order of value, so that those of an impact range are one slice."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.rows = np.argsort(x, axis=0, kind="stable")
        self.values = np.take_along_axis(x, self.rows, axis=0)
        self.rows, self.values = np.ascontiguousarray(self.rows.T), np.ascontiguousarray(self.values.T)

    def _slice(self, d: int, q: int, low: int) -> tuple[int, int]:
        """Postings of dimension d with contribution q * x of low or more."""
        v = self.values[d]
        if q > 0:  # x >= ceil(low / q): the upper end
            return int(np.searchsorted(v, -((-low) // q), "left")), len(v)
        return 0, int(np.searchsorted(v, low // q, "right"))  # x <= floor(low / q): the lower end

    def search(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than the query's own."""
        n = len(self.ids)
        alive = self.ids != own
        dims = np.flatnonzero(q)
        best = np.maximum(q[dims] * self.values[dims, -1], q[dims] * self.values[dims, 0]) if n and len(dims) else np.zeros(0, np.int64)
        members = np.flatnonzero(alive)
        if len(dims) and len(members) > max(FEW, k):
            acc, shown = np.zeros(n, np.int64), np.zeros(n, np.int32)
            done = {int(d): None for d in dims}
            top = int(best.max())
            levels, level = [], top
            while level > max(top // 64, 1):
                level //= 2
                levels.append(level)
            for level in [*levels, 0]:
                for d in map(int, dims):
                    lo, hi = self._slice(d, int(q[d]), level)
                    was = done[d]
                    new = (lo, hi) if was is None else (lo, was[0]) if q[d] > 0 else (was[1], hi)
                    done[d] = (lo, hi)
                    if new[1] > new[0]:
                        rows = self.rows[d, new[0]:new[1]]
                        acc[rows] += q[d] * self.values[d, new[0]:new[1]]
                        shown[rows] += 1
                bound = acc + (len(dims) - shown) * max(level - (level > 0), 0)
                lead = members[np.argpartition(-acc[members], k - 1)[:k]] if len(members) > k else members
                need = int((self.x[lead] @ q).min())
                members = members[bound[members] >= need]
                if len(members) <= max(FEW, k):
                    break
        scores = self.x[members] @ q
        order = np.lexsort((self.ids[members], -scores))[:k]
        return self.ids[members][order], scores[order]


def _search_shard(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            width = max(left.v.map(len).max(), right.q.map(len).max())
            index = ImpactIndex(left.vec_id.to_numpy(np.int64), _matrix(left.v.tolist(), width))
            for own, q in zip(right.query_id.to_numpy(np.int64), _matrix(right.q.tolist(), width)):
                ids, scores = index.search(q, own, k)
                out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
    return run


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score."""
    x = quantise(vectors, id_col, vector_col)
    ids = vectors.select(F.col(id_col).cast("long").alias("i"))
    n, m = ids.agg(F.count("*"), F.count_if(F.col("i") % every == 0)).first()
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-m // BLOCK))
    shards = max(shards, min(8, -(-n // 2048)))  # some parallelism for small tables too
    left = (x.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    right = (x.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))
             .withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    found = (left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
             .applyInPandas(_search_shard(k), "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
