"""Operator 8: SimHash near-dedup by multi-index hashing.

Each text gets a 64-bit fingerprint; fingerprints that differ in at most
``max_bits`` bits are linked, and linked documents form components.

Finding the links: the 64 bits are cut into ``segments`` parts. Two
fingerprints within ``max_bits`` agree in some part up to
``max_bits // segments`` bits, so every distinct fingerprint is put into a
table by the value of each part, the small Hamming ball round each part's
value is enumerated as look-ups, and each match is verified on all 64 bits.
Of the two directions in which a pair could meet only one is enumerated: a
look-up is made only if the fingerprint has the lowest bit of the flip set.

A crowded table value (a large group of near copies) would give all pairs of
the group; there a search walks from fingerprint to fingerprint and takes
what it reaches out of the set, which gives links that span the group, not
all of its pairs. No link between different groups is lost.

Components come from alternating large-star and small-star steps on the link
table (each an aggregation and a join, cut by a checkpoint).

Defined cases: null, empty and white-space-only texts have fingerprint zero
and are linked like any others; fewer words than a shingle form one shingle;
repeated rows each give a row; a component's id is the smallest doc_id in it,
null ids left out (null only if all are); an empty table gives no rows; extra
columns are not returned by ``near_duplicates`` and are kept by ``one_each``.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import batch_column, keep, partitions_for, text_bytes

SHINGLE_WORDS, MAX_BITS, SEGMENTS = 4, 4, 3
CROWDED = 4096   # table rows x look-ups of one value beyond which the walk is used
CHUNK = 2_000_000  # matches verified at a time
SALTS = 16         # parts in which a component's fingerprints meet its id


def fingerprint(data: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text's UTF-8 bytes: a bit is 1 if it is set in over half
    of the shingles' XXH64 (seed 42). bytes.lower and bytes.split know just
    A-Z and the white space 0x20, 0x09-0x0D."""
    words = data.lower().split()
    if not words:
        return 0
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle_words:
        return h(joined, 42)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    hashes = np.array([h(joined[s:e], 42) for s, e in
                       zip(starts[:len(words) - shingle_words + 1].tolist(), ends[shingle_words - 1:].tolist())], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i:i + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(shingle_words: int):
    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(x.as_buffer().to_pybytes(), shingle_words) for x in batch_column(batch, "data")], dtype=np.uint64)
            yield pa.record_batch([batch_column(batch, "doc_id"), pa.array(fps.view(np.int64), pa.int64())], names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a long); one row per input row."""
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("data"))
            .mapInArrow(_fingerprints(shingle_words), "doc_id long, fp long"))


@lru_cache(maxsize=8)
def _parts(segments: int, max_bits: int):
    """(shift, mask, flips) of each part; flips: (value, lowest bit of it)."""
    out, shift = [], 0
    for i in range(segments):
        width = 64 // segments + (i < 64 % segments)
        flips = [(sum(1 << b for b in bits), 1 << bits[0]) for r in range(1, max_bits // segments + 1) for bits in combinations(range(width), r)]
        out.append((shift, (1 << width) - 1, flips))
        shift += width
    return out


def _entries(segments: int, max_bits: int):
    """Table rows (own) and look-ups of each fingerprint."""
    def run(batches):
        for batch in batches:
            fps = batch_column(batch, "fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for i, (shift, mask, flips) in enumerate(_parts(segments, max_bits)):
                value = (fps >> np.uint64(shift)) & np.uint64(mask)
                keys, owners, own = [value], [fps], [np.ones(len(fps), bool)]
                for flip, lowest in flips:
                    use = (value & np.uint64(lowest)) != 0
                    keys.append(value[use] ^ np.uint64(flip))
                    owners.append(fps[use])
                    own.append(np.zeros(int(use.sum()), bool))
                key = (np.concatenate(keys) * np.uint64(segments) + np.uint64(i)).view(np.int64)
                yield pa.record_batch([pa.array(key), pa.array(np.concatenate(owners).view(np.int64)), pa.array(np.concatenate(own))],
                                      names=["key", "fp", "own"])
    return run


def _walk(table: np.ndarray, lookups: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that span what can be reached over table rows."""
    nodes = np.unique(np.concatenate((table, lookups)))
    is_table = np.isin(nodes, table)
    out, todo = [], np.argsort(~is_table, kind="stable")  # table rows first
    left, left_table = nodes[todo], is_table[todo]
    while len(left) and left_table[0]:
        frontier, left, left_table = [(left[0], True)], left[1:], left_table[1:]
        while frontier and len(left):
            x, wide = frontier.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if not wide:  # a look-up meets table rows only
                near &= left_table
            if near.any():
                hit, hit_table = left[near], left_table[near]
                out.append((np.full(len(hit), x), hit))
                frontier += list(zip(hit, hit_table))
                left, left_table = left[~near], left_table[~near]
    return out


def links_in(key: np.ndarray, fp: np.ndarray, own: np.ndarray, max_bits: int):
    """Links among the rows of one partition, as (a, b) arrays in parts."""
    order = np.argsort(key[own], kind="stable")
    tkey, tfp = key[own][order], fp[own][order]
    order = np.argsort(key[~own], kind="stable")
    qkey, qfp = key[~own][order], fp[~own][order]
    values, first, count = np.unique(tkey, return_index=True, return_counts=True)
    qlo, qhi = np.searchsorted(qkey, values, "left"), np.searchsorted(qkey, values, "right")
    crowded = count * (count + (qhi - qlo)) > CROWDED
    for i in np.flatnonzero(crowded):
        yield from _walk(tfp[first[i]:first[i] + count[i]], qfp[qlo[i]:qhi[i]], max_bits)
    # each table row meets the later rows of its value, each look-up all rows of it
    at = np.searchsorted(values, tkey)
    plain = ~crowded[at] if len(values) else np.zeros(0, bool)
    t_lo, t_hi, t_fp = np.flatnonzero(plain) + 1, (first + count)[at[plain]], tfp[plain]
    at = np.minimum(np.searchsorted(values, qkey), max(len(values) - 1, 0))
    good = (values[at] == qkey) & ~crowded[at] if len(values) else np.zeros(len(qkey), bool)
    lo, hi = np.concatenate((t_lo, first[at[good]] if len(values) else t_lo[:0])), np.concatenate((t_hi, (first + count)[at[good]] if len(values) else t_hi[:0]))
    who, n = np.concatenate((t_fp, qfp[good])), np.maximum(hi - lo, 0)
    total = np.cumsum(n)
    start = 0
    while start < len(n):
        end = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + CHUNK, "right")))
        m = n[start:end]
        rows = np.repeat(lo[start:end] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        a, b = np.repeat(who[start:end], m), tfp[rows]
        near = (np.bitwise_count(a ^ b) <= max_bits) & (a != b)
        yield a[near], b[near]
        start = end


def _match(max_bits: int):
    def run(batches):
        got = [(batch_column(b, "key").to_numpy(zero_copy_only=False), batch_column(b, "fp").to_numpy(zero_copy_only=False).view(np.uint64),
                batch_column(b, "own").to_numpy(zero_copy_only=False)) for b in batches]
        if not got:
            return
        key, fp, own = (np.concatenate(c) for c in zip(*got))
        for a, b in links_in(key, fp, own, max_bits):
            if len(a):
                a, b = a.view(np.int64), b.view(np.int64)
                yield pa.record_batch([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])
    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """Distinct links (a > b) among distinct fingerprints ``fp`` that keep
    every group within ``max_bits`` connected."""
    n = fps.count()
    parts = partitions_for(fps.sparkSession, n * 40, 1_500_000)
    return (fps.select("fp").mapInArrow(_entries(segments, max_bits), "key long, fp long, own boolean")
            .repartition(parts, "key").mapInArrow(_match(max_bits), "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) of each node that has
    an edge (a > b), by large-star and small-star steps until nothing
    changes. Every step aggregates before it joins, so a node with very many
    neighbours is split like any skewed key."""
    edges, mark = keep(edges), None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = keep(small.select("e.a", "e.b").where("a > b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = now


def _with_components(marked: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """fp, root, component_id for the distinct fingerprints of ``marked``.
    Most are alone; a root with very many fingerprints is aggregated map-side
    and looked up in ``SALTS`` parts."""
    fps = keep(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = components(links(fps, max_bits, segments))
    rooted = keep(fps.join(labels, fps.fp == labels.node, "left").select("fp", "least", "root"))
    alone = rooted.where("root is null").select("fp", F.col("fp").alias("root"), F.col("least").alias("component_id"))
    rooted = rooted.where("root is not null").withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)))
    least = (rooted.groupBy("root").agg(F.min("least").alias("component_id"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))))
    return alone.unionByName(rooted.join(least, ["root", "salt"]).select("fp", "root", "component_id"))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    segments: int = SEGMENTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint (hex), component_id."""
    marked = keep(fingerprints(docs, shingle_words, id_col, text_col))
    found = _with_components(marked, max_bits, segments)
    return marked.join(found, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_each(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """The rows of ``docs`` with one row of each component: of those with its
    smallest doc_id the one with the smallest text. A component without any
    id keeps the row with the smallest text.

    Rows whose id no other row has are kept or dropped by their id; only the
    others (repeated or null ids) are told apart by their fingerprints."""
    names = iter(n for n in (f"__one_each_{i}" for i in range(len(docs.columns) + 3)) if n not in docs.columns)
    fp, root, nth = next(names), next(names), next(names)
    marked = keep(fingerprints(docs, shingle_words))
    found = keep(_with_components(marked, max_bits, segments))
    rows = marked.groupBy("doc_id").agg(F.count("*").alias("n"))
    unclear = F.col("n").isNull() | (F.col("n") > 1) | F.col("id").isNull()
    ids = keep(rows.select(F.col("doc_id").alias("id"), "n").where(unclear).select("id"))
    first = marked.join(found, "fp").where("doc_id = component_id").select(F.col("doc_id").alias("id"))
    clear = docs.join(first.join(ids, "id", "left_anti"), docs.doc_id == F.col("id"), "left_semi")
    if not ids.limit(1).count():
        return clear

    @F.pandas_udf("long")
    def marks(data: pd.Series) -> pd.Series:
        fps = np.array([fingerprint(bytes(x), shingle_words) for x in data], np.uint64)
        return pd.Series(fps.view(np.int64))

    told = docs.join(ids, docs.doc_id.eqNullSafe(F.col("id")), "left_semi").withColumn(fp, marks(text_bytes()))
    found = found.select(F.col("fp").alias(nth), F.col("root").alias(root), F.col("component_id").alias(next(names, "__one_each_id")))
    told = told.join(found, told[fp] == found[nth]).where(F.col("doc_id").eqNullSafe(found[found.columns[2]])).select(*docs.columns, root)
    told = told.withColumn(nth, F.row_number().over(Window.partitionBy(root).orderBy("text"))).where(F.col(nth) == 1)
    return clear.unionByName(told.select(*docs.columns))
