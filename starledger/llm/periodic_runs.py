"""Operator 12: periodic runs of words, by seed and extend on diagonals.

A run is a stretch of consecutive words that repeats with its smallest period
q, is at least ``max(min_length, exponent * q)`` words long and cannot be
extended by a neighbouring word. On the diagonal of lag q (word i against word
i + q) a run is an unbroken stretch of matches, at least
``max(min_length, exponent * q) - q`` words long.

1. Lags are taken in classes [low, high]. ``k``, the smallest overlap that a
   run of any lag in the class guarantees, is the length of the class's
   k-grams, and ``high = k``.
2. The k-grams of all positions are indexed by exact ranks (built by
   doubling, only for positions whose shorter gram repeats in the document).
   Neighbouring occurrences of one gram in one document whose distance lies in
   the class are the seeds. Neighbours are enough, so the pairs are never more
   than the words: within a run of smallest period q <= k, a k-gram that came
   back after d < q words would give the k + d words periods d and q, hence
   (k >= q) a common period that divides q, against q being the smallest. For
   the same reason every lag found this way is a smallest period.
3. Each seed is extended to both sides along its diagonal by comparing words; a
   table of the furthest word covered per lag drops seeds inside a stretch that
   is known already.

All words of many documents are worked on as one array (a word's number
belongs to its document, so nothing matches across documents); rows never
leave their task, and memory is that of some hundred thousand words or of one
document.

Defined cases: a null text has no words; a text without words, or without
runs, gives an empty list and its words joined by one space; repeated rows and
repeated or null ids are judged row by row; a text of any length is taken
whole; an empty table gives no rows; extra columns of the input, whatever
their names, are not returned.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import batch_column

MIN_LENGTH, EXPONENT = 6, 4
WORDS_AT_ONCE = 300_000

Run = tuple[int, int, int]  # start, length, period
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lag_classes(longest: int, min_length: int, exponent: int) -> Iterator[tuple[int, int, int]]:
    """(low, high, k) of each class of lags a text of ``longest`` words can have."""
    low = 1
    while max(min_length, exponent * low) <= longest:
        k = min(max(min_length, exponent * q) - q for q in range(low, low + min_length + 1))
        high = max(low, k)
        yield low, high, k
        low = high + 1


def _ranks(first: np.ndarray, second: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Ranks of the pairs (first, second) at the places ``at``; -1 where a
    pair stands only once, and at all other places."""
    out = np.full(size, -1, np.int64)
    if len(at):
        _, rank, count = np.unique(first * size + second, return_inverse=True, return_counts=True)
        out[at] = np.where(count[rank] > 1, rank, -1)
    return out


def _neighbours(rank: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance to the next occurrence) of the k-grams that come
    back; ``rank`` numbers the grams of ``length`` <= k <= 2 * length words."""
    size = len(rank)
    at = np.flatnonzero(rank[:size - (k - length)] >= 0) if size > k - length else np.empty(0, np.int64)
    at = at[rank[at + k - length] >= 0]
    gram = rank[at] * size + rank[at + k - length]
    order = np.argsort(gram, kind="stable")
    gram, place = gram[order], at[order]
    same = gram[1:] == gram[:-1]
    return place[:-1][same], (place[1:] - place[:-1])[same]


def _stretch(words: np.ndarray, lag: int, left: int, right: int) -> tuple[int, int]:
    """The longest stretch of matches on the diagonal around [left, right)."""
    end, step = len(words) - lag, 64
    while right < end:
        to = min(end, right + step)
        differ = np.flatnonzero(words[right:to] != words[right + lag:to + lag])
        if len(differ):
            right += int(differ[0])
            break
        right, step = to, step * 2
    step = 64
    while left > 0:
        to = max(0, left - step)
        differ = np.flatnonzero(words[to:left] != words[to + lag:left + lag])
        if len(differ):
            left = to + int(differ[-1]) + 1
            break
        left, step = to, step * 2
    return left, right


def word_runs(words: np.ndarray, longest: int, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[Run]:
    """All runs in an array of word numbers below its length, where no number
    belongs to two documents; by start, then period."""
    size, runs = len(words), []
    if not size:
        return runs
    rank, length = np.where(np.bincount(words, minlength=size)[words] > 1, words, -1).astype(np.int64), 1
    for low, high, k in lag_classes(longest, min_length, exponent):
        while 2 * length <= k:
            at = np.flatnonzero(rank[:size - length] >= 0)
            at = at[rank[at + length] >= 0]
            rank, length = _ranks(rank[at], rank[at + length], at, size), 2 * length
        place, lag = _neighbours(rank, length, k)
        if not len(place):
            break  # a longer gram cannot repeat either
        seeds = (lag >= low) & (lag <= high)
        place, lag = place[seeds], lag[seeds]
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        fresh = np.ones(len(place), bool)
        fresh[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
        starts = np.flatnonzero(fresh)
        ends = np.append(starts, len(place))[1:] - 1
        covered: dict[int, int] = {}
        for q, i, j in zip(lag[starts].tolist(), place[starts].tolist(), place[ends].tolist()):
            if i < covered.get(q, 0):
                continue
            left, right = _stretch(words, q, i, j + k)
            covered[q] = right
            if right - left + q >= max(min_length, exponent * q):
                runs.append((left, right - left + q, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def best_run(runs: list[Run]) -> Run | None:
    """The run with the greatest exact length / period; ties: smallest start,
    then period."""
    best = None
    for run in runs:  # in order of start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that any run contains after its first period."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(words)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's edit: in one document of ten (by the id's checksum; a
    null id is never edited) the words from a on repeat the p words at a."""
    n = len(words)
    if doc_id is None or not n:
        return words
    g, tenth = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if tenth:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def _judge(edit: Callable | None, min_length: int, exponent: int, words_at_once: int):
    def of_texts(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        numbers, starts = [], [0]
        for words in texts:
            base, known = starts[-1], {}
            starts.append(base + len(words))
            numbers.append(np.fromiter(map(known.setdefault, words, range(base, starts[-1])), np.int64, len(words)))
        longest = max(map(len, texts), default=0)
        all_runs: list[list[Run]] = [[] for _ in texts]
        found = word_runs(np.concatenate(numbers) if numbers else np.empty(0, np.int64), longest, min_length, exponent)
        owner = np.searchsorted(starts, [r[0] for r in found], side="right") - 1
        for doc, (start, length, period) in zip(owner.tolist(), found):
            all_runs[doc].append((start - starts[doc], length, period))
        best = [best_run(r) for r in all_runs]
        names = ("start", "length", "period")
        return pa.record_batch([
            pa.array(ids, pa.int64()), pa.array([len(w) for w in texts], pa.int64()),
            pa.array([[dict(zip(names, r)) for r in runs] for runs in all_runs], pa.list_(_RUN)),
            pa.array([b and dict(zip(names, b)) for b in best], _RUN),
            pa.array([collapse(w, r) for w, r in zip(texts, all_runs)], pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "runs", "best", "collapsed"])

    def run(batches):
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch_column(batch, "doc_id").to_pylist(), batch_column(batch, "text")):
                words = text.as_py().split()  # bytes split at \x20 and \x09-\x0D alone
                words = edit(doc_id, words) if edit else words
                ids.append(doc_id)
                texts.append(words)
                held += len(words)
                if held >= words_at_once:
                    yield of_texts(ids, texts)
                    ids, texts, held = [], [], 0
            yield of_texts(ids, texts)
    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, exponent: int = EXPONENT, edit: Callable | None = None,
                  id_col: str = "doc_id", text_col: str = "text", words_at_once: int = WORDS_AT_ONCE) -> DataFrame:
    """One row per input row: doc_id, n_words, runs (start, length, period; by
    start, then period), best (the run of greatest length / period, or null)
    and the collapsed text. ``edit(doc_id, words)`` may change a document's
    words first. ``exponent`` is at least 3."""
    if exponent < 3:
        raise ValueError("exponent: runs of at least three periods")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    run = "struct<start:long,length:long,period:long>"
    return rows.mapInArrow(_judge(edit, min_length, exponent, words_at_once),
                           f"doc_id long, n_words long, runs array<{run}>, best {run}, collapsed string")


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from ``periodic_runs``."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")
