"""Operator 4: benchmark decontamination by a BM25 index of the test items.

The items' word pairs are the terms of an inverted index (an item of one word
is its own term). A posting's weight is its BM25 impact divided by the item's
score against itself, so a passage's score for an item is the share of the
item's BM25 mass that the passage holds. Postings are kept by item in blocks
with block maxima.

Every passage of every document is a query: windows of ``passage`` words that
overlap by half, at least twice as long as the longest item, so an item that
occurs lies whole in some passage. The bound of the first WAND step (the sum
of the passage's terms' greatest impacts) is taken for all passages at once by
prefix sums; passages that it cannot rule out go through block-max WAND with
the fixed threshold, which returns every item at or above it, not a top k.
Each hit is verified: of the item's question and of its answer, the share of
five-word shingles found in the passage must be ``overlap`` or more. The
question is the text up to the first line break or question mark, the answer
the rest; an item without an answer is verified by its question.

The index is broadcast only up to ``index_bytes`` of item text (measured);
larger benchmarks are cut into so many parts by a hash of the item, each with
an index of its own, through which the documents pass one after the other.
Judging documents needs no shuffle.

Defined cases: null or empty texts are clean; items without a word are left
out; repeated items and documents are handled row by row; a part of fewer
than five words is one shingle; an empty benchmark leaves every document
clean; an empty table gives no rows; ``mark`` keeps all columns of the input.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.llm.common import batch_column

PASSAGE, THRESHOLD, OVERLAP, SHINGLE = 128, 0.5, 0.8, 5
K1, B, BLOCK = 1.2, 0.75, 64
INDEX_BYTES = 32 << 20


def split_words(texts: pa.Array) -> pa.ListArray:
    """Lower-cased runs of letters and digits; an empty word may stand at
    either end of a text."""
    return pc.split_pattern_regex(pc.utf8_lower(texts.cast(pa.large_string())), r"[^\p{L}\p{N}]+")


def _words(text: str) -> list[str]:
    return [w for w in split_words(pa.array([text], pa.string()))[0].as_py() if w]


def question_answer(text: str) -> tuple[str, str]:
    cuts = [i for i in (text.find("\n"), text.find("?")) if i >= 0]
    return (text[:min(cuts) + 1], text[min(cuts) + 1:]) if cuts else (text, "")


class ItemIndex:
    """Block-max inverted index of test items (ids ascending by position)."""

    def __init__(self, items: list[tuple[int, str]], passage: int = PASSAGE):
        parts = [(i, [_words(p) for p in question_answer(t or "")]) for i, t in items]
        parts = [(i, qa) for i, qa in parts if qa[0] or qa[1]]
        self.ids = [i for i, _ in parts]
        self.vocab = sorted({w for _, qa in parts for part in qa for w in part})
        number = {w: n for n, w in enumerate(self.vocab)}
        self.base = len(self.vocab) + 1
        words = [[number[w] for part in qa for w in part] for _, qa in parts]
        self.single = any(len(w) == 1 for w in words)
        self.passage = max([passage, *(2 * len(w) for w in words)])
        self.shingles = [[self._shingles([number[w] for w in part]) for part in qa if part] for _, qa in parts]
        terms = [Counter([a * self.base + b + 1 for a, b in zip(w, w[1:])] or [w[0] * self.base]) for w in words]
        df = Counter(t for c in terms for t in c)
        mean = sum(map(len, words)) / max(len(words), 1)
        postings: dict[int, list[tuple[int, float]]] = {}
        for n, (c, w) in enumerate(zip(terms, words)):
            impact = {t: math.log(1 + (len(words) - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * len(w) / mean)) for t, f in c.items()}
            total = sum(impact.values())
            for t, x in impact.items():
                postings.setdefault(t, []).append((n, x / total))
        self.codes = np.array(sorted(postings), dtype=np.int64)
        self.postings = [postings[int(c)] for c in self.codes]
        self.most = np.array([max(x for _, x in p) for p in self.postings], dtype=np.float64)
        self.block_most = []
        for p in self.postings:
            most: dict[int, float] = {}
            for n, x in p:
                most[n // BLOCK] = max(most.get(n // BLOCK, 0.0), x)
            self.block_most.append(most)

    @staticmethod
    def _shingles(words: list[int]) -> set[tuple]:
        return {tuple(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: every item whose score is ``threshold`` or more."""
        lists = [[self.postings[t], 0, t] for t in terms]
        found, limit = [], threshold - 1e-9
        while lists:
            lists.sort(key=lambda x: x[0][x[1]][0])
            total, pivot = 0.0, -1
            for i, (_, _, t) in enumerate(lists):
                total += self.most[t]
                if total >= limit:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = lists[pivot][0][lists[pivot][1]][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0][lists[pivot + 1][1]][0] == item:
                pivot += 1
            block = item // BLOCK
            if sum(self.block_most[t].get(block, 0.0) for _, _, t in lists[:pivot + 1]) < limit:
                # no item up to the block's end, or to the next list's item, can reach the threshold
                to = min([(block + 1) * BLOCK, *(p[at][0] for p, at, _ in lists[pivot + 1:pivot + 2])])
            elif lists[0][0][lists[0][1]][0] == item:
                score = sum(p[at][1] for p, at, _ in lists[:pivot + 1])
                if score >= limit:
                    found.append((item, score))
                to = item + 1
            else:
                to = item
            for x in lists[:pivot + 1]:
                while x[1] < len(x[0]) and x[0][x[1]][0] < to:
                    x[1] += 1
            lists = [x for x in lists if x[1] < len(x[0])]
        return found

    def verify(self, item: int, words: list[int]) -> tuple[float, ...]:
        """Shares of the question's and the answer's shingles in a passage."""
        out = []
        for part in self.shingles[item]:
            size = len(next(iter(part)))
            have = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
            out.append(len(part & have) / len(part))
        return tuple(out)


def leaks_in(index: ItemIndex, texts: pa.Array, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[dict[int, float]]:
    """For each text its leaked items with their best score."""
    out: list[dict[int, float]] = [{} for _ in range(len(texts))]
    if not len(index.codes):
        return out
    lists = split_words(texts)
    offsets = lists.offsets.to_numpy()
    flat = pc.index_in(lists.values, value_set=pa.array(index.vocab, pa.large_string())).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    base = int(offsets[0])
    offsets = offsets - base
    flat = flat[base:] if lists.values is not None else flat
    n = len(flat)
    if not n:
        return out
    doc_of = np.repeat(np.arange(len(texts)), np.diff(offsets))
    term = np.full(n, -1, np.int64)

    def look_up(codes, good):
        at = np.minimum(np.searchsorted(index.codes, codes), len(index.codes) - 1)
        return np.where(good & (index.codes[at] == codes), at, -1)

    pair_ok = (flat[:-1] >= 0) & (flat[1:] >= 0) & (doc_of[:-1] == doc_of[1:])
    term[:-1] = look_up(flat[:-1] * index.base + flat[1:] + 1, pair_ok)
    ub = np.where(term >= 0, index.most[term], 0.0)
    one = look_up(flat * index.base, flat >= 0) if index.single else None
    if one is not None:
        ub = ub + np.where(one >= 0, index.most[one], 0.0)
    sums = np.concatenate(([0.0], np.cumsum(ub)))
    if sums[-1] < threshold - 1e-6:
        return out
    size, step = index.passage, index.passage // 2
    length = np.diff(offsets)
    count = np.maximum(1, -(-(length - size) // step) + 1)
    which = np.repeat(np.arange(len(texts)), count)
    first = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[which] + first * step
    end = np.minimum(start + size, offsets[which + 1])
    for p in np.flatnonzero(sums[end] - sums[start] >= threshold - 1e-6):
        lo, hi, doc = int(start[p]), int(end[p]), int(which[p])
        terms = set(term[lo:hi - 1].tolist()) | (set(one[lo:hi].tolist()) if one is not None else set())
        terms.discard(-1)
        words = None
        for item, score in index.search(sorted(terms), threshold):
            if score > out[doc].get(item, 0.0):
                words = flat[lo:hi].tolist() if words is None else words
                if min(index.verify(item, words)) >= overlap:
                    out[doc][item] = score
    return out


def _mark(index, threshold: float, overlap: float):
    def run(batches):
        for batch in batches:
            texts = batch_column(batch, "text").fill_null("")
            found = leaks_in(index.value, texts, threshold, overlap)
            old = batch_column(batch, "leaked_items").to_pylist()
            best = batch_column(batch, "leak_score").to_pylist()
            ids = [sorted({*o, *(index.value.ids[i] for i in f if index.value.ids[i] is not None)}) for o, f in zip(old, found)]
            score = [round(max([b, *f.values()]), 6) for b, f in zip(best, found)]
            rest = batch.drop_columns(["leaked_items", "leak_score"])
            yield pa.record_batch([*rest.columns, pa.array(ids, pa.list_(pa.int64())), pa.array(score, pa.float64())],
                                  names=[*rest.schema.names, "leaked_items", "leak_score"])
    return run


def mark(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP,
         passage: int = PASSAGE, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``docs`` with leaked_items (sorted ids) and leak_score (best share; 0
    if clean). The columns of these names are replaced if they exist."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // index_bytes))
    out = docs.drop("leaked_items", "leak_score").withColumn("leaked_items", F.array().cast("array<long>")).withColumn("leak_score", F.lit(0.0))
    for part in range(parts):  # each part holds about index_bytes of text
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        index = spark.sparkContext.broadcast(ItemIndex(sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r)), passage))
        schema = T.StructType([*[f for f in out.schema.fields if f.name not in ("leaked_items", "leak_score")],
                               T.StructField("leaked_items", T.ArrayType(T.LongType())), T.StructField("leak_score", T.DoubleType())])
        out = out.mapInArrow(_mark(index, threshold, overlap), schema)
    return out


def judge(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, contaminated, leaked_items, leak_score."""
    marked = mark(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, **options)
    return marked.select("doc_id", (F.col("leak_score") > 0).alias("contaminated"), "leaked_items", "leak_score")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with their columns."""
    return mark(docs, benchmark, **options).where("leak_score = 0").select(*[F.col(f"`{c}`") for c in docs.columns])
