"""Operator 13: document fingerprints by consistent weighted sampling.

A text's weighted terms are its words (split at ASCII white space, A-Z
lower-cased), each weighted by its number of occurrences. For each of the
``samples`` samples a word draws r and c from Gamma(2, 1) and b from the
uniform distribution, all from hashes of the word and the sample's number. A
word of weight w has

    t = floor(ln w / r + b),   ln a = ln c - r * (t - b) - r

and the word with the smallest a, together with its t, is the sample. Two texts
agree in a sample with probability sum(min weight) / sum(max weight), the
generalised Jaccard similarity of their word weights, so the share of equal
samples estimates it with a standard error of sqrt(J * (1 - J) / samples), at
most 0.0625 for 64 samples. A sample is kept as a 16-bit hash of (word, t), so
different samples agree by chance once in 65,535. A fingerprint is written as
4 hexadecimal digits a sample; texts without words have the fingerprint of
zeros, which agrees only with itself.

``edited_fingerprints`` also needs each document's successor in order of id.
Texts are shuffled once, by ranges of ids whose first ids are known; a range
gets a copy of the first document of the next one, so each task streams
through its sorted range and sees every pair of neighbours. The driver
holds one id for each range (``ROWS_EACH`` rows).

Defined cases: a null text counts as empty; the documents of one id all have
the same successor, the next larger id's document (of several, the one with
the smallest text in order of UTF-8 bytes); a null id counts as the largest
64-bit number; the last id's successor is the first id's document, which for
a table with a single id is that id's own; an id on more than ``ROWS_EACH``
rows is spread over several tasks; texts of any length are taken whole;
an empty table gives no rows; extra columns of the input are not returned.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.llm.common import batch_column, keep, partitions_for

SAMPLES = 64
SEED = 13
ROWS_EACH = 50_000
WORDS_KEPT = 30_000  # words whose draws a task keeps at hand
WORDS_AT_ONCE = 8_000
LAST_ID = 2 ** 63 - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: xor-shifts and two odd multipliers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: 16 bits as a uniform number in (0, 1), and as minus its logarithm: the sum of
#: two such is drawn from Gamma(2, 1).
_UNIFORM = (np.arange(65_536) + 0.5) / 65_536
_EXPONENTIAL = -np.log(_UNIFORM)


def _draws(h: np.ndarray, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c and b of each word and sample, from 80 bits of its hash."""
    x = _mix(h[:, None] ^ stream[None, :])
    r = _EXPONENTIAL.take(x.astype(np.uint16))
    r += _EXPONENTIAL.take((x >> np.uint64(16)).astype(np.uint16))
    c = _EXPONENTIAL.take((x >> np.uint64(32)).astype(np.uint16))
    c += _EXPONENTIAL.take((x >> np.uint64(48)).astype(np.uint16))
    return r, np.log(c, out=c), _UNIFORM.take((x * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.uint16))


class Sampler:
    """Fingerprints of texts; keeps the draws of the words it met last."""

    def __init__(self, samples: int = SAMPLES, seed: int = SEED):
        self.samples, self.seed = samples, seed
        numbers = np.arange(1, 2 * samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
        self.streams = _mix(numbers).reshape(2, samples)
        self._forget()

    def _forget(self) -> None:
        self.row: dict[bytes, int] = {}
        size = (WORDS_KEPT + WORDS_AT_ONCE, self.samples)
        self.r, self.b, self.ln_c, self.once = (np.empty(size) for _ in range(4))
        self.hash = np.empty(size[0], np.uint64)

    def _rows(self, words: list[bytes]) -> np.ndarray:
        """Places of the words' draws, drawing for words not at hand."""
        if len(self.row) + len(words) > len(self.hash):
            self.row.clear()
        found = list(map(self.row.get, words))
        new = [i for i, place in enumerate(found) if place is None]
        if new:
            at = slice(len(self.row), len(self.row) + len(new))
            h = np.array([xxhash.xxh64_intdigest(words[i], self.seed) for i in new], np.uint64)
            r, ln_c, b = _draws(h, self.streams[0])
            self.hash[at], self.r[at], self.b[at], self.ln_c[at] = h, r, b, ln_c
            self.once[at] = ln_c + r * b - r  # ln a for weight 1, where t = 0
            for place, i in enumerate(new, at.start):
                self.row[words[i]] = found[i] = place
        return np.array(found, np.int64)

    def weights(self, text: bytes) -> Counter:
        return Counter(text.lower().split())  # both by ASCII rules alone

    def of_weights(self, weights: dict[bytes, int]) -> np.ndarray:
        """The samples (16-bit hashes) of a table of words and weights."""
        if not weights:
            return np.zeros(self.samples, np.uint16)
        words, counts = list(weights), np.fromiter(weights.values(), np.int64, len(weights))
        least, chosen, steps = np.full(self.samples, np.inf), np.zeros(self.samples, np.uint64), np.zeros(self.samples, np.int64)
        for i in range(0, len(words), WORDS_AT_ONCE):
            place, weight = self._rows(words[i:i + WORDS_AT_ONCE]), counts[i:i + WORDS_AT_ONCE]
            ln_a, many = self.once[place], np.flatnonzero(weight != 1)
            r, b = self.r[place[many]], self.b[place[many]]
            t = np.floor(np.log(weight[many])[:, None] / r + b)
            ln_a[many] = self.ln_c[place[many]] - r * (t - b) - r
            pick = ln_a.argmin(axis=0)
            low = ln_a[pick, np.arange(self.samples)]
            step, nth = np.zeros(self.samples, np.int64), np.full(len(place), -1)
            nth[many] = np.arange(len(many))
            of_many = np.flatnonzero(nth[pick] >= 0)
            step[of_many] = t[nth[pick[of_many]], of_many].astype(np.int64)
            better = low < least
            least = np.where(better, low, least)
            chosen = np.where(better, self.hash[place[pick]], chosen)
            steps = np.where(better, step, steps)
        x = _mix(_mix(chosen ^ self.streams[1]) + steps.astype(np.uint64))
        return (x % np.uint64(65_535) + np.uint64(1)).astype(np.uint16)

    def of_text(self, text: bytes) -> np.ndarray:
        return self.of_weights(self.weights(text))


def to_hex(samples: np.ndarray) -> str:
    return samples.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal samples."""
    return float(np.count_nonzero(a == b)) / len(a)


def fingerprints(docs: DataFrame, samples: int = SAMPLES, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint; no shuffle."""
    def run(batches):
        sampler = Sampler(samples, seed)
        for batch in batches:
            prints = [to_hex(sampler.of_text(t.as_py())) for t in batch_column(batch, "text")]
            yield pa.record_batch([batch_column(batch, "doc_id"), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def spliced(text: str, after: str) -> str:
    """The edit: the last quarter of the code points (rounded down) replaced
    by the first as many, or all, of the next document."""
    cut = len(text) // 4
    return text[:len(text) - cut] + after[:cut]


class _Ranges:
    """Which tasks get a row. Range j holds the ids from ``first[j]`` up to
    ``first[j + 1]``; one with a hot id holds only that id and is split."""

    def __init__(self, first: list[int], splits: dict[int, int]):
        self.first = np.array(sorted(first), np.int64)
        self.splits = np.array([splits.get(f, 1) for f in self.first.tolist()], np.int64)
        self.base = np.concatenate([[0], np.cumsum(self.splits)])
        self.hot = np.array(sorted(splits), np.int64)

    @property
    def tasks(self) -> int:
        return int(self.base[-1])

    def ahead_of(self, j: int) -> list[int]:
        """The tasks of the range before range j (the last one's next is the first)."""
        j = (j - 1) % len(self.first)
        return list(range(int(self.base[j]), int(self.base[j + 1])))

    def deal(self, key: pd.Series, salt: pd.Series) -> pd.Series:
        """Twice the task's number, plus one where the row is only looked at."""
        keys = key.to_numpy()
        j = np.searchsorted(self.first, keys, side="right") - 1
        own = (self.base[j] + salt.to_numpy() % self.splits[j]) * 2
        out = [[t] for t in own.tolist()]
        for i in np.flatnonzero((self.first[j] == keys) & ~np.isin(keys, self.hot)).tolist():
            out[i] += [2 * t + 1 for t in self.ahead_of(int(j[i]))]
        return pd.Series(out)


def _ranges(rows: DataFrame, rows_each: int) -> _Ranges:
    """Ranges of ids with about ``rows_each`` rows."""
    spark = rows.sparkSession
    counted = keep(rows.groupBy("key").agg(F.count("*").alias("n")))
    total, hot = counted.agg(F.sum("n")).first()[0] or 0, {r.key: -(-r.n // rows_each) for r in counted.where(F.col("n") > rows_each).collect()}
    dealt = counted.repartitionByRange(partitions_for(spark, total, rows_each), "key")
    first = {r.k for r in dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("k")).collect()}
    if hot:  # a hot id has a range of its own: the next larger id starts another
        bounds = np.array(sorted(first | set(hot)), np.int64)

        @F.pandas_udf("long")
        def slot(key: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(bounds, key.to_numpy(), side="left"))
        first |= set(hot) | {r.k for r in counted.groupBy(slot("key").alias("slot")).agg(F.min("key").alias("k")).collect()}
    return _Ranges(list(first), hot)


class _Doc:
    __slots__ = ("doc_id", "text", "samples")

    def __init__(self, doc_id, text):
        self.doc_id, self.text, self.samples = doc_id, text, None


_OUT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("edited", T.StringType()),
                     T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
                     T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])


def _neighbours(samples: int, seed: int):
    """Streams through sorted ranges; the documents of an id wait for the
    first document of the next id."""
    def run(batches):
        sampler = Sampler(samples, seed)

        def own(doc: _Doc) -> np.ndarray:
            if doc.samples is None:
                doc.samples = sampler.of_text(doc.text.encode())
            return doc.samples

        def judged(docs: list[_Doc], after: _Doc):
            for i in range(0, len(docs), 1_000):
                out = []
                for doc in docs[i:i + 1_000]:
                    edited = spliced(doc.text, after.text)
                    changed = sampler.of_text(edited.encode())
                    out.append((doc.doc_id, len(doc.text), edited, to_hex(own(doc)), to_hex(changed), likeness(own(doc), changed), likeness(own(doc), own(after))))
                yield out

        def as_batch(rows):
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=_OUT.names)

        waiting: list[_Doc] = []
        at, ready = None, []
        for batch in batches:
            columns = [batch_column(batch, c) for c in ("dealt", "key", "doc_id", "text")]
            for dealt, key, doc_id, text in zip(*(c.to_pylist() for c in columns[:3]), columns[3]):
                if at == (dealt, key):
                    if not dealt % 2:
                        waiting.append(_Doc(doc_id, text.as_py()))
                    continue
                doc = _Doc(doc_id, text.as_py())
                for rows in judged(waiting, doc):
                    ready += rows
                    if len(ready) >= 1_000:
                        yield as_batch(ready)
                        ready = []
                at, waiting = (dealt, key), [] if dealt % 2 else [doc]
        if ready:
            yield as_batch(ready)
    return run


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES, seed: int = SEED, rows_each: int = ROWS_EACH,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_chars, the edited text, both
    fingerprints, near_edited and near_next (shares of equal samples with the
    edited text's and the next document's fingerprint)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("key"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = _ranges(rows.select("key"), rows_each)
    if not ranges.tasks:
        return docs.sparkSession.createDataFrame([], _OUT)
    deal = F.pandas_udf(ranges.deal, "array<long>")
    # equal ids and texts may share a file, so the salt is the row's number
    dealt = rows.select("doc_id", "key", "text", F.explode(deal("key", F.monotonically_increasing_id())).alias("dealt"))
    if len(ranges.hot):  # of a hot id only the document that others look at is copied
        @F.pandas_udf("array<long>")
        def ahead(key: pd.Series) -> pd.Series:
            return pd.Series([[2 * t + 1 for t in ranges.ahead_of(int(j))] for j in np.searchsorted(ranges.first, key.to_numpy())])

        seen = rows.where(F.col("key").isin(ranges.hot.tolist())).groupBy("key").agg(F.min("text").alias("text"))
        dealt = dealt.unionByName(seen.select(F.lit(None).cast("long").alias("doc_id"), "key", "text", F.explode(ahead("key")).alias("dealt")))
    task = F.call_function("div", F.col("dealt"), F.lit(2)).cast("int")
    return dealt.repartitionById(ranges.tasks, task).sortWithinPartitions("dealt", "key", "text").mapInArrow(_neighbours(samples, seed), _OUT)


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from ``edited_fingerprints``."""
    return found.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint",
                        "edited_fingerprint", "near_edited", "near_next")
