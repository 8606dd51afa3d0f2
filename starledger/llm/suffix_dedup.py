"""Operator 7: suffix-array dedup of whole texts.

Every byte covered by a ``MIN``-byte string that also starts anywhere else
(another document or the same one) is removed; strings are judged on the
input. Texts are UTF-8 bytes and matches never cross documents.

The suffix array is sparse: instead of all suffixes it holds those at anchors.
An anchor is the first smallest (by hash) ``GRAM``-byte string of a window of
``MIN`` bytes, so the same MIN bytes have the same anchor wherever they stand,
and MIN bytes that repeat show up as two anchors with a common suffix prefix.
An anchor's entry is its suffix (MIN bytes from it on) followed by the bytes
before it in reverse, which is all that windows round the anchor can see.

1. Anchors' grams are counted by hash; grams that occur once can't belong to
   a repeat. The others are put in a Bloom filter of at most
   ``FILTER_BYTES``. A false positive costs an entry, never a result.
2. Each task sorts the entries that pass into runs; equal entries of a run are
   one with several owners. Runs are front coded (common prefix length with
   the entry before, then the rest) and dealt out by gram.
3. A receiving task merges its runs with a loser tree that knows for every
   contender the common prefix with the last entry given out, compares these
   lengths first, and looks at bytes only beyond them. The merge yields the
   suffixes in order with the lengths of their common prefixes (LCP array).
4. A window that starts o bytes before the anchor repeats if another entry has
   the same MIN - o suffix bytes and the same o bytes before: both are
   intervals, of the suffix order and of the order of the reversed bytes.
   All decisions are made on bytes; hashes only deal out work.
5. Spans are united per document and cut out of the texts.

A gram with very many different entries (over ``HOT``) is dealt out over
several tasks by a hash of the entry; there the windows' MIN bytes are counted
by a digest (128 bits) over all tasks instead of step 4.

The rows' ids are positions in the scan (monotonically_increasing_id), read in
three passes: ``docs`` must be a stored table or a checkpoint.

Defined cases: null and empty texts have 0 bytes and nothing removed; repeated
rows are documents of their own and repeat each other; texts under MIN bytes
are kept; an empty table gives no rows; ``judge`` returns its own columns only,
``cut`` keeps those of the input.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.llm.common import batch_column, keep, partitions_for, text_bytes

MIN, GRAM = 200, 50
SPAN = MIN - GRAM          # an anchor lies at most so far into its window
SLICE = 1 << 20            # bytes of text worked on at a time
RUN = 40_000               # entries of a run
PART = 40_000              # entries of a merging task, about
HOT = 50_000               # different entries of one gram that a single task takes
FILTER_BYTES = 64 << 20
_POS = 21                  # bits of a position within a slice
_WIDTH = MIN + SPAN + 2    # entry: suffix, reversed bytes before, their lengths
_BASE = 0x9E3779B97F4A7C15 | 1


@lru_cache(maxsize=1)
def _powers():
    base = np.full(SLICE + 1, _BASE, np.uint64)
    base[0] = 1
    inverse = np.full(SLICE + 1, pow(_BASE, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    return np.cumprod(base, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, gram hashes and entry hashes of the anchors of the documents
    data[start:end] that lie side by side (at most SLICE bytes in all)."""
    n, window = len(data), SPAN + 1
    if n < MIN:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    power, inverse = _powers()
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    h = (sums[GRAM:] - sums[:-GRAM]) * inverse[:n - GRAM + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    m = len(h)
    low = np.uint64((1 << _POS) - 1)
    key = (h & ~low) | np.arange(m, dtype=np.uint64)
    padded = np.full(-(-m // window) * window, np.iinfo(np.uint64).max, np.uint64)
    padded[:m] = key
    grid = padded.reshape(-1, window)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n - MIN + 1], ahead[SPAN:SPAN + n - MIN + 1])
    inside = np.zeros(n + 1, np.int32)  # windows that lie within a document
    long = ends - starts >= MIN
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - MIN + 1, -1)
    pos = (least[np.cumsum(inside[:n - MIN + 1]) > 0] & low).astype(np.int64)
    if len(pos):
        pos = pos[np.concatenate(([True], pos[1:] != pos[:-1]))]
    doc = np.searchsorted(starts, pos, "right") - 1
    lo, hi = np.maximum(pos - SPAN, starts[doc]), np.minimum(pos + MIN, ends[doc])
    entry = (sums[hi] - sums[lo]) * inverse[lo] ^ ((pos - lo) << 8 | (hi - pos)).astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    return pos, h[pos], entry


def slices(batch):
    """The batch's texts in slices: (data, starts, ends, uid, offset of the
    slice in its document). A text longer than a slice is cut into slices that
    overlap by MIN - 1 bytes, so each window lies in exactly one."""
    parts, starts, ends, uids, offs, size = [], [], [], [], [], 0

    def out():
        return np.concatenate(parts), np.array(starts), np.array(ends), np.array(uids), np.array(offs)

    for uid, value in zip(batch_column(batch, "uid").to_pylist(), batch_column(batch, "data")):
        data = np.frombuffer(value.as_buffer(), np.uint8)
        for off in range(0, max(len(data) - MIN + 1, 0), SLICE - MIN + 1):
            piece = data[off:off + SLICE]
            if size + len(piece) > SLICE:
                yield out()
                parts, starts, ends, uids, offs, size = [], [], [], [], [], 0
            parts.append(piece)
            starts.append(size)
            ends.append(size + len(piece))
            uids.append(uid)
            offs.append(off)
            size += len(piece)
    if parts:
        yield out()


def _grams(batches):
    """gram, n (its anchors), entries (its different entries in the batch,
    by hash; only the dealing depends on them)."""
    for batch in batches:
        found = [anchors(data, starts, ends)[1:] for data, starts, ends, _, _ in slices(batch)]
        gram, entry = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        order = np.lexsort((entry, gram))
        gram, entry = gram[order], entry[order]
        first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1]))) if len(gram) else np.zeros(0, np.int64)
        new = np.concatenate(([True], (gram[1:] != gram[:-1]) | (entry[1:] != entry[:-1]))) if len(gram) else np.zeros(0, bool)
        entries = np.add.reduceat(new.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
        yield pa.record_batch([pa.array(gram[first].view(np.int64)), pa.array(np.diff(np.append(first, len(gram)))), pa.array(entries)], names=["gram", "n", "entries"])


class GramFilter:
    """Bloom filter of the grams that occur more than once (two bits each),
    and the number of tasks of each hot gram."""

    def __init__(self, bits: int, pieces: dict[int, bytes], piece_bits: int, hot: dict[int, int], parts: int):
        self.bits, self.parts = bits, parts
        self.data = np.zeros(bits // 8, np.uint8)
        for i, b in pieces.items():
            self.data[i * piece_bits // 8:(i + 1) * piece_bits // 8] = np.frombuffer(b, np.uint8)
        order = sorted(hot)
        self.hot, self.salts = np.array(order, np.uint64), np.array([hot[h] for h in order], np.uint64)

    @staticmethod
    def places(gram: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(bits - 1)
        return gram & mask, (gram >> np.uint64(32)) & mask

    def has(self, gram: np.ndarray) -> np.ndarray:
        out = np.ones(len(gram), bool)
        for at in self.places(gram, self.bits):
            out &= (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out

    def is_hot(self, gram: np.ndarray) -> np.ndarray:
        return np.isin(gram, self.hot)

    def part(self, gram: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Task of each entry: by gram; a hot gram's by gram and entry."""
        key = gram.copy()
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, gram), len(self.hot) - 1)
            for i in np.flatnonzero(self.hot[at] == gram):
                salt = int.from_bytes(hashlib.blake2b(entries[i].tobytes(), digest_size=8).digest(), "little") % int(self.salts[at[i]])
                key[i] ^= np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        return ((key >> np.uint64(20)) % np.uint64(self.parts)).astype(np.int32)


def _filter_piece(bits: int, piece_bits: int):
    def run(batches):
        pieces: dict[int, np.ndarray] = {}
        for batch in batches:
            which, at = (batch_column(batch, c).to_numpy(zero_copy_only=False) for c in ("piece", "at"))
            for p in np.unique(which):
                data = pieces.setdefault(int(p), np.zeros(piece_bits // 8, np.uint8))
                own = at[which == p] - int(p) * piece_bits
                np.bitwise_or.at(data, own >> 3, (1 << (own & 7)).astype(np.uint8))
        yield pa.record_batch([pa.array(list(pieces), pa.int32()), pa.array([d.tobytes() for d in pieces.values()], pa.binary())], names=["piece", "data"])
    return run


def _filter_places(bits: int, piece_bits: int):
    def run(batches):
        for batch in batches:
            gram = batch_column(batch, "gram").to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.unique(np.concatenate(GramFilter.places(gram, bits))).astype(np.int64)
            yield pa.record_batch([pa.array((at // piece_bits).astype(np.int32)), pa.array(at)], names=["piece", "at"])
    return run


def gram_filter(docs: DataFrame, parts_rows: int = PART, hot: int = HOT, filter_bytes: int = FILTER_BYTES) -> GramFilter | None:
    """Filter of the repeated grams of ``docs`` (uid, data); None if none
    repeats. What reaches the driver is bounded by ``filter_bytes`` and the
    hot grams, of which there are at most 100,000."""
    spark = docs.sparkSession
    counts = docs.mapInArrow(_grams, "gram long, n long, entries long").groupBy("gram").agg(F.sum("n").alias("n"), F.sum("entries").alias("entries")).where("n > 1")
    counts = keep(counts)
    grams, entries = counts.agg(F.count("*"), F.sum("entries")).first()
    if not grams:
        return None
    bits = 1 << 19
    while bits < 16 * grams and bits < filter_bytes * 8:
        bits *= 2
    piece_bits = min(bits // 64, 1 << 23)
    places = counts.select("gram").mapInArrow(_filter_places(bits, piece_bits), "piece int, at long")
    pieces = places.repartition(min(bits // piece_bits, 64), "piece").mapInArrow(_filter_piece(bits, piece_bits), "piece int, data binary").collect()
    hot = max(hot, entries // 100_000)
    many = {int(np.int64(r.gram).view(np.uint64)): -(-r.entries // hot) for r in counts.where(F.col("entries") > hot).collect()}
    return GramFilter(bits, {r.piece: r.data for r in pieces}, piece_bits, many, partitions_for(spark, entries, parts_rows))


def entries_of(data, starts, ends, pos) -> np.ndarray:
    """The anchors' entries, one row of _WIDTH bytes each. Bytes beyond the
    document are zero and not counted in the lengths."""
    doc = np.searchsorted(starts, pos, "right") - 1
    after, before = np.minimum(ends[doc] - pos, MIN), np.minimum(pos - starts[doc], SPAN)
    padded = np.concatenate((np.zeros(SPAN, np.uint8), data, np.zeros(MIN, np.uint8)))
    out = np.zeros((len(pos), _WIDTH), np.uint8)
    right, left = np.arange(MIN), np.arange(SPAN)
    for i in range(0, len(pos), 8192):
        p, a, b = pos[i:i + 8192, None], after[i:i + 8192, None], before[i:i + 8192, None]
        out[i:i + 8192, :MIN] = np.where(right < a, padded[p + SPAN + right], 0)
        out[i:i + 8192, MIN:MIN + SPAN] = np.where(left < b, padded[p + SPAN - 1 - left], 0)
    out[:, -2], out[:, -1] = after, before
    return out


def _common(rows: np.ndarray) -> np.ndarray:
    """Common prefix lengths of neighbouring rows; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    for i in range(1, len(rows), 16384):
        differ = rows[i:i + 16384] != rows[i - 1:i - 1 + len(rows[i:i + 16384])]
        out[i:i + 16384] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def coded_runs(part, rows, uid, pos):
    """Front-coded sorted runs by task: (part, lcps, rests, owner counts,
    owner ids, owner positions) as bytes."""
    keyed = np.concatenate((part.astype(">u4").view(np.uint8).reshape(-1, 4), rows), axis=1)
    order = np.argsort(np.ascontiguousarray(keyed).view(f"S{_WIDTH + 4}").ravel(), kind="stable")
    keyed, part, rows, uid, pos = keyed[order], part[order], rows[order], uid[order], pos[order]
    lcp = _common(keyed) - 4
    first = np.flatnonzero(lcp < _WIDTH)  # equal entries are one
    owners = np.diff(np.append(first, len(rows)))
    bounds = np.append(np.flatnonzero(np.concatenate(([True], part[first][1:] != part[first][:-1]))), len(first))
    for i, j in zip(bounds[:-1], bounds[1:]):
        at = first[i:j]
        cut = np.maximum(lcp[at], 0)
        cut[0] = 0
        lo, hi = first[i], first[j] if j < len(first) else len(rows)
        rest = b"".join(rows[a, c:].tobytes() for a, c in zip(at.tolist(), cut.tolist()))
        yield (int(part[at[0]]), cut.astype("<u2").tobytes(), rest, owners[i:j].astype("<u4").tobytes(),
               uid[lo:hi].astype("<i8").tobytes(), pos[lo:hi].astype("<i8").tobytes())


_RUN_SCHEMA = "part int, lcps binary, rests binary, owners binary, uids binary, poss binary"
_RUN_TYPES = (pa.int32(), *[pa.binary()] * 5)
_RUN_NAMES = ["part", "lcps", "rests", "owners", "uids", "poss"]


def _runs(shared):
    def run(batches):
        got, size = [], 0

        def out():
            part, rows, uid, pos = (np.concatenate(c) for c in zip(*got))
            runs = list(coded_runs(part, rows, uid, pos))
            for i in range(0, len(runs), 64):
                yield pa.record_batch([pa.array([r[c] for r in runs[i:i + 64]], t) for c, t in enumerate(_RUN_TYPES)], names=_RUN_NAMES)

        for batch in batches:
            for data, starts, ends, uids, offs in slices(batch):
                pos, gram, _ = anchors(data, starts, ends)
                use = shared.value.has(gram)
                pos, gram = pos[use], gram[use]
                for i in range(0, len(pos), RUN):
                    p, g = pos[i:i + RUN], gram[i:i + RUN]
                    rows = entries_of(data, starts, ends, p)
                    doc = np.searchsorted(starts, p, "right") - 1
                    got.append((shared.value.part(g, rows), rows, uids[doc], p - starts[doc] + offs[doc]))
                    size += len(p)
                    if size >= RUN:
                        yield from out()
                        got, size = [], 0
        if got:
            yield from out()
    return run


def _decoded(lcps: bytes, rests: bytes):
    """(lcp with the entry before, entry) of a front-coded run."""
    last, at = b"", 0
    for n in np.frombuffer(lcps, "<u2").tolist():
        end = at + _WIDTH - n
        last = last[:n] + rests[at:end]
        at = end
        yield n, last


def merge_runs(runs):
    """Loser tree over sorted runs of (lcp, entry): yields (run, lcp with the
    entry given out before, entry) in order. A contender's known common
    prefix with the last winner decides first; bytes are compared only past
    it, and the loser then keeps its common prefix with the winner."""
    runs = [iter(r) for r in runs]
    k = 1 << max(len(runs) - 1, 0).bit_length()
    none = (None, None)
    first = [next(r, none) for r in runs] + [none] * (k - len(runs))
    entry, known = [e for _, e in first], [0] * k
    tree = [0] * k

    def duel(a, b):
        """(winner, loser) of two runs."""
        x, y = entry[a], entry[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        n = known[a]
        if n != known[b]:
            return (a, b) if n > known[b] else (b, a)
        if x[n:] == y[n:]:
            known[b] = _WIDTH
            return a, b
        n += _WIDTH - n - ((int.from_bytes(x[n:], "big") ^ int.from_bytes(y[n:], "big")).bit_length() + 7) // 8
        if x[n] < y[n]:
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    level = list(range(k))
    at = k
    while len(level) > 1:
        at //= 2
        up = []
        for i in range(0, len(level), 2):
            win, lose = duel(level[i], level[i + 1])
            tree[at + i // 2] = lose
            up.append(win)
        level = up
    win = level[0]
    while entry[win] is not None:
        yield win, known[win], entry[win]
        known[win], entry[win] = next(runs[win], none)
        if entry[win] is None:
            known[win] = 0
        node = (win + k) // 2
        while node:
            win, tree[node] = duel(win, tree[node])
            node //= 2


def _merged(rows):
    """Entries of one task in order: (entries, lcp of the suffixes, owner
    counts, owner ids, owner positions); equal entries are one."""
    ends = [np.concatenate(([0], np.cumsum(np.frombuffer(r["owners"], "<u4").astype(np.int64)))) for r in rows]
    uids, poss = [np.frombuffer(r["uids"], "<i8") for r in rows], [np.frombuffer(r["poss"], "<i8") for r in rows]
    entries, lcps, who, at = [], [], [], [0] * len(rows)
    for r, n, e in merge_runs([_decoded(x["lcps"], x["rests"]) for x in rows]):
        if not entries or n < _WIDTH:
            entries.append(e)
            lcps.append(n)
            who.append([])
        i = at[r]
        at[r] = i + 1
        who[-1].append((r, ends[r][i], ends[r][i + 1]))
    counts = np.array([sum(b - a for _, a, b in w) for w in who], np.int64)
    own_uid = np.concatenate([uids[r][a:b] for w in who for r, a, b in w])
    own_pos = np.concatenate([poss[r][a:b] for w in who for r, a, b in w])
    return np.frombuffer(b"".join(entries), np.uint8).reshape(-1, _WIDTH), np.minimum(np.array(lcps), MIN), counts, own_uid, own_pos


def repeated_windows(rows: np.ndarray, lcp: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the smallest and largest o so that the window starting
    o bytes before its anchor repeats (smallest > largest: none does)."""
    n = len(rows)
    after, before = rows[:, -2].astype(np.int64), rows[:, -1].astype(np.int64)
    least, most = np.full(n, SPAN + 1), np.full(n, -1)
    many = (counts > 1) & (np.maximum(0, MIN - after) <= before)
    least[many], most[many] = np.maximum(0, MIN - after)[many], before[many]
    lefts = np.ascontiguousarray(rows[:, MIN:MIN + SPAN])
    order = np.argsort(lefts.view(f"S{SPAN}").ravel(), kind="stable")
    left_lcp = _common(lefts[order])
    lid = np.empty(n, np.int64)
    # entries whose suffix shares no MIN - SPAN bytes with a neighbour can't repeat
    for o in range(SPAN + 1):
        use = (before >= o) & (after >= MIN - o)
        if not use.any():
            continue
        rid = np.cumsum(lcp < MIN - o)
        used = np.flatnonzero(use)
        size = np.bincount(rid[used])
        used = used[size[rid[used]] > 1]
        if not len(used):
            continue
        lid[order] = np.cumsum(left_lcp < o)
        key = rid[used] * (n + 1) + lid[used]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        hit = used[by[np.concatenate((same, [False])) | np.concatenate(([False], same))]]
        least[hit] = np.minimum(least[hit], o)
        most[hit] = np.maximum(most[hit], o)
    return least, most


_FOUND_SCHEMA = "kind int, uid long, a long, b long, digest binary"
_FOUND_NAMES = ["kind", "uid", "a", "b", "digest"]


def _spans(shared):
    """kind 0: span [a, b) of document uid. For hot grams, kind 1: digest of
    the window at o = b of entry a (uid: its owners); kind 2: the owner of entry a
    if it has only one: document uid, anchor at b."""
    def run(batches):
        grouped: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                grouped.setdefault(r["part"], []).append(r)
        for part in sorted(grouped):
            rows, lcp, counts, uid, pos = _merged(grouped.pop(part))
            hot = np.zeros(len(rows), bool)
            if len(shared.value.hot):
                gram = np.array([_gram_hash(r) for r in rows], np.uint64)
                hot = shared.value.is_hot(gram)
            least, most = repeated_windows(rows, lcp, counts)
            ends = np.cumsum(counts)
            good = np.repeat((most >= least) & ~hot, counts)
            start, end = (pos - np.repeat(most, counts))[good], (pos - np.repeat(least, counts) + MIN)[good]
            yield pa.record_batch([pa.array(np.zeros(len(start), np.int32)), pa.array(uid[good]), pa.array(start), pa.array(end), pa.nulls(len(start), pa.binary())], names=_FOUND_NAMES)
            for i in np.flatnonzero(hot):
                entry = int(part) << 32 | int(i)
                after, before = int(rows[i, -2]), int(rows[i, -1])
                whole = rows[i, MIN:MIN + SPAN][::-1].tobytes() + rows[i, :MIN].tobytes()
                os_ = range(max(0, MIN - after), before + 1)
                # with o: one window seen from two of its anchors is not a repeat
                digests = [hashlib.blake2b(bytes([o]) + whole[SPAN - o:SPAN - o + MIN], digest_size=16).digest() for o in os_]
                own = slice(ends[i] - counts[i], ends[i])
                n, m = len(digests), int(counts[i])
                if m > 1 and n:  # its owners repeat each other: all its windows do
                    yield pa.record_batch([pa.array(np.zeros(m, np.int32)), pa.array(uid[own]), pa.array(pos[own] - os_[-1]),
                                           pa.array(pos[own] - os_[0] + MIN), pa.nulls(m, pa.binary())], names=_FOUND_NAMES)
                alone = m if m == 1 else 0
                yield pa.record_batch([
                    pa.array([1] * n + [2] * alone, pa.int32()), pa.array([m] * n + uid[own].tolist()[:alone], pa.int64()),
                    pa.array([entry] * (n + alone), pa.int64()), pa.array([*os_, *pos[own].tolist()[:alone]], pa.int64()),
                    pa.array([*digests, *[None] * alone], pa.binary())], names=_FOUND_NAMES)
    return run


def _gram_hash(row: np.ndarray) -> int:
    """Gram hash of an entry (as in ``anchors``)."""
    total, power, full = 0, 1, (1 << 64) - 1
    for b in row[:GRAM].tolist():
        total = (total + (b + 1) * power) & full
        power = power * _BASE & full
    total ^= total >> 29
    total = total * 0xBF58476D1CE4E5B9 & full
    return total ^ total >> 32


def spans(docs: DataFrame, hot: int = HOT, part_rows: int = PART) -> DataFrame:
    """uid, spans (united, in order) of the documents (uid, data) that have
    repeated bytes."""
    spark = docs.sparkSession
    grams = gram_filter(docs, part_rows, hot)
    if grams is None:
        return spark.createDataFrame([], "uid long, spans array<struct<a:long,b:long>>")
    shared = spark.sparkContext.broadcast(grams)  # at most FILTER_BYTES and the hot grams
    found = docs.mapInArrow(_runs(shared), _RUN_SCHEMA).repartition(grams.parts, "part").mapInArrow(_spans(shared), _FOUND_SCHEMA)
    if len(grams.hot):
        found = keep(found)
        windows = found.where("kind = 1")
        twice = windows.groupBy("digest").agg(F.sum("uid").alias("n")).where("n > 1").select("digest")
        ranges = windows.join(twice, "digest").groupBy("a").agg(F.min("b").alias("least"), F.max("b").alias("most"))
        owned = found.where("kind = 2").select("uid", "a", F.col("b").alias("pos")).join(ranges, "a")
        found = found.where("kind = 0").select("uid", "a", "b").unionByName(
            owned.select("uid", (F.col("pos") - F.col("most")).alias("a"), (F.col("pos") - F.col("least") + MIN).alias("b")))
    one = F.sort_array(F.collect_list(F.struct("a", "b")))  # bounded by the document's length
    united = """aggregate(s, cast(array() AS array<struct<a:bigint,b:bigint>>), (acc, x) ->
        CASE WHEN size(acc) > 0 AND x.a <= acc[size(acc) - 1].b
             THEN concat(slice(acc, 1, size(acc) - 1), array(named_struct('a', acc[size(acc) - 1].a, 'b', greatest(acc[size(acc) - 1].b, x.b))))
             ELSE concat(acc, array(named_struct('a', x.a, 'b', x.b))) END)"""
    return found.groupBy("uid").agg(one.alias("s")).select("uid", F.expr(united).alias("spans"))


def _kept(data: bytes, spans) -> bytes:
    out, at = [], 0
    for s in spans:
        out.append(data[at:s["a"]])
        at = s["b"]
    out.append(data[at:])
    return b"".join(out)


def _judge(batches):
    for batch in batches:
        out = []
        for value, spans_ in zip(batch_column(batch, "data"), batch_column(batch, "spans").to_pylist()):
            data = value.as_buffer().to_pybytes()
            left = _kept(data, spans_ or ())
            out.append((len(data), len(data) - len(left), len(spans_ or ()), hashlib.sha256(left).hexdigest()))
        yield pa.record_batch([batch_column(batch, "doc_id"), *(pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string())))],
                              names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def judge(docs: DataFrame, hot: int = HOT, part_rows: int = PART) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data")).withColumn("uid", F.monotonically_increasing_id())
    found = spans(rows.select("uid", "data"), hot, part_rows).withColumnRenamed("uid", "s_uid")
    return (rows.join(found, F.col("uid") == F.col("s_uid"), "left").select("doc_id", "data", "spans")
            .mapInArrow(_judge, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def _cut(names: list[str]):
    def run(batches):
        for batch in batches:
            texts = [None if not t.is_valid else t.as_py() if not s else _kept(t.as_py().encode(), s).decode("utf-8", "ignore")
                     for t, s in zip(batch_column(batch, "text"), batch_column(batch, "__spans").to_pylist())]
            cols = []
            for n in names:
                col = batch_column(batch, n)
                if n == "text":
                    col = pa.array(texts, pa.string())
                elif n == "n_chars":
                    col = pa.array([c if not s or t is None else len(t) for c, s, t in zip(col.to_pylist(), batch_column(batch, "__spans").to_pylist(), texts)], col.type)
                cols.append(col)
            yield pa.record_batch(cols, names=names)
    return run


def cut(docs: DataFrame, hot: int = HOT, part_rows: int = PART) -> DataFrame:
    """``docs`` with repeated bytes cut out of ``text`` (``n_chars`` follows).
    A character that a cut splits goes whole. All rows stay."""
    rows = docs.withColumn("__uid", F.monotonically_increasing_id())
    found = spans(rows.select(F.col("__uid").alias("uid"), text_bytes().alias("data")), hot, part_rows).select(F.col("uid").alias("__s"), F.col("spans").alias("__spans"))
    joined = rows.join(found, F.col("__uid") == F.col("__s"), "left").drop("__uid", "__s")
    return joined.mapInArrow(_cut(docs.columns), T.StructType(docs.schema.fields))
