"""Operator 11: source divergence audit.

Each language keeps the terms that stand in at least ``min_docs`` of its
documents. A group (language and source) and the language as a whole give a
kept term p = 1 + floor(SCALE * (count + 5) / (N + 5 * V)), all in integers.
The audit says how far each source is from every other source of its language
(``pair``: the sum of absolute differences over all kept terms) and which terms
a source overuses against its language (``term``: the first ``top`` by p - q).

1. One pass over the texts. A task finds the terms of some megabytes of text at
   a time, counts them by group and sends the counts packed, dealt out over
   ``part``s by a hash of the term (a third of the rows in one source is
   counted map-side, like any other). The task that gets a part has all
   counts of its terms, and keeps the terms that a language keeps.
2. ``term`` by dominance skybands. A term is dominated by one with at least
   its group count, at most its language count and an earlier name (UTF-8
   order). p grows with the count, so a dominating term has at least the value
   and goes first in a tie: a term dominated by ``top`` others is never among
   the first ``top``. Each partition keeps the terms dominated by fewer than
   ``top`` of its own (the skyband), partitions' skybands are merged ``FAN_IN``
   at a time by the same rule, and what is left is ranked exactly.
3. ``pair`` in blocks of ``BLOCK`` sources and some ``TERMS_EACH`` terms: a
   task fills the terms' p for two blocks and sends one partial sum for each
   pair of sources. Terms that neither source has differ by a constant. No
   row is made for a pair of sources and a term.

Defined cases: null text, lang and source count as ''; every row is a
document, repeated rows too; a group without terms takes part in the pairs; a
language without kept terms has pairs of value 0 and no term rows; a single
source has no pairs; an empty table gives no rows; extra columns, whatever
their names, are not read; a very long text is taken whole.
"""

from __future__ import annotations

import zlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import batch_column, pack_numbers, partitions_for, unpack_numbers
from starledger.operators.joins import fits_broadcast
from starledger.session import materialize

MIN_DOCS, TOP, SCALE, SMOOTH = 30, 50, 1_000_000_000, 5
PIECE = 16 << 20       # bytes of texts whose terms are counted at once, or one text
ROWS_EACH = 20_000     # rows whose different terms one task may hold
POINTS = 200_000       # points of which a task takes skybands at once
FAN_IN = 64
BLOCK, TERMS_EACH = 256, 2_048

#: Bytes that end a term become a space, A-Z become a-z; others stay.
_FOLD = bytes(32 if b < 0x41 or 0x5A < b < 0x61 or 0x7A < b < 0x80 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def _terms(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All terms of the texts (encoded), and the number of each one's text."""
    data = np.frombuffer(b" ".join([t.translate(_FOLD) for t in texts]) + b" ", np.uint8)
    inside = data != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = np.flatnonzero(inside[:1]), edge[~inside[edge]]
    starts = np.concatenate([starts, edge[inside[edge]]])
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    terms = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[inside].tobytes())])
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return terms.dictionary_encode(), np.searchsorted(begins, starts, side="right") - 1


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys: the different ones, and the number of each."""
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


_PACKED = "part int, langs array<string>, sources array<string>, terms binary, entries binary"


def _partial_counts(parts: int, piece: int):
    """Packed counts of some texts: for a part its terms in order, and for each
    (group, term) the places of both, occurrences and documents."""
    def count(groups: list[tuple], texts: list[bytes]):
        names = sorted(set(groups))
        number = {g: i for i, g in enumerate(names)}
        of_text = np.array([number[g] for g in groups], np.int64)
        terms, text = _terms(texts)
        words, width = terms.dictionary.to_pylist(), max(1, len(terms.dictionary))
        keys, n = _runs(np.sort(text * width + terms.indices.to_numpy()))  # by text and term
        by_group = of_text[keys // width] * width + keys % width
        order = np.argsort(by_group, kind="stable")
        entries, docs = _runs(by_group[order])
        used = np.add.reduceat(n[order], np.cumsum(docs) - docs) if len(docs) else docs
        part_of = np.array([zlib.crc32(w) % parts for w in words], np.int64)
        place = np.argsort(part_of, kind="stable")  # terms by part
        rank = np.empty(len(words), np.int64)
        rank[place] = np.arange(len(words))
        order = np.argsort(rank[entries % width], kind="stable")
        term, group, used, docs = rank[entries[order] % width], entries[order] // width, used[order], docs[order]
        rows = []
        for part, members in groupby(place.tolist(), key=part_of.__getitem__):
            members = list(members)
            lo, hi = np.searchsorted(term, [rank[members[0]], rank[members[-1]] + 1])
            mine, local = np.unique(group[lo:hi], return_inverse=True)
            packed = [pack_numbers(x) for x in (term[lo:hi] - rank[members[0]], local, used[lo:hi], docs[lo:hi])]
            rows.append((part, [names[i][0] for i in mine], [names[i][1] for i in mine], zstandard.compress(b" ".join([words[i] for i in members]), 3),
                         b"".join(len(x).to_bytes(8, "little") + x for x in packed)))
        # a term of no bytes stands for the groups themselves
        rows += [(zlib.crc32("\0".join(g).encode()) % parts, [g[0]], [g[1]], None, None) for g in names]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()), pa.binary(), pa.binary()))],
                               names=["part", "langs", "sources", "terms", "entries"])

    def run(batches):
        groups, texts, held = [], [], 0
        for batch in batches:
            for lang, source, text in zip(batch_column(batch, "lang").to_pylist(), batch_column(batch, "source").to_pylist(), batch_column(batch, "text")):
                groups.append((lang, source))
                texts.append(text.as_py())
                held += len(texts[-1]) + 1
                if held >= piece:
                    yield count(groups, texts)
                    groups, texts, held = [], [], 0
        if groups:
            yield count(groups, texts)
    return run


_COUNTS = "lang string, source string, term string, n long, lang_n long"


def _kept_counts(min_docs: int):
    """All counts of a task's terms, added up; the terms that enough documents
    of a language have, and a row without bytes for each group."""
    def run(batches):
        langs, sources, terms, numbers = [], [], [], ([], [])
        groups = set()
        for batch in batches:
            for row in batch.to_pylist():
                if row["terms"] is None:
                    groups.add((row["langs"][0], row["sources"][0]))
                    continue
                data, columns = row["entries"], []
                while data:
                    size = int.from_bytes(data[:8], "little")
                    columns.append(unpack_numbers(data[8:8 + size]))
                    data = data[8 + size:]
                term, group, n, docs = columns
                words = pa.array(zstandard.decompress(row["terms"]).split(b" "), pa.binary())
                terms.append(words.take(pa.array(term)))
                langs.append(pa.array(row["langs"], pa.string()).take(pa.array(group)))
                sources.append(pa.array(row["sources"], pa.string()).take(pa.array(group)))
                for held, column in zip(numbers, (n, docs)):
                    held.append(pa.array(column, pa.int64()))
        if terms:
            table = pa.table({"lang": pa.chunked_array(langs), "source": pa.chunked_array(sources), "term": pa.chunked_array(terms),
                              "n": pa.chunked_array(numbers[0]), "docs": pa.chunked_array(numbers[1])})
            del langs, sources, terms, numbers
            whole = table.group_by(["lang", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
            whole = whole.filter(pc.greater_equal(whole["docs_sum"], min_docs))
            whole = pa.table({"lang": whole["lang"], "term": whole["term"], "lang_n": whole["n_sum"]})
            table = table.drop_columns("docs").join(whole, ["lang", "term"], join_type="inner", use_threads=False)
            table = table.group_by(["lang", "source", "term", "lang_n"], use_threads=False).aggregate([("n", "sum")])
            out = pa.table({"lang": table["lang"], "source": table["source"], "term": table["term"].cast(pa.string()), "n": table["n_sum"], "lang_n": table["lang_n"]})
            yield from out.to_batches(max_chunksize=50_000)
        if groups:
            lang, source = zip(*sorted(groups))
            yield pa.record_batch([pa.array(lang), pa.array(source), pa.array([""] * len(lang)), pa.array([0] * len(lang), pa.int64()), pa.array([0] * len(lang), pa.int64())],
                                  names=["lang", "source", "term", "n", "lang_n"])
    return run


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                rows_each: int = ROWS_EACH, piece: int = PIECE) -> DataFrame:
    """lang, source, term, n (occurrences in the group), lang_n (in the
    language) of the kept terms; rows with an empty term for the groups (one or
    more each). Written once."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))],
                        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    parts = partitions_for(docs.sparkSession, docs.count(), rows_each)
    packed = texts.mapInArrow(_partial_counts(parts, piece), _PACKED)
    return materialize(packed.repartition(parts, "part").mapInArrow(_kept_counts(min_docs), _COUNTS))


def _share(count: Column, total: Column, terms: Column, scale: int, smooth: int) -> Column:
    """1 + floor(scale * (count + smooth) / (total + smooth * terms)), exact."""
    above = F.lit(scale).cast("decimal(10,0)") * (count + smooth).cast("decimal(20,0)")
    below = (total + terms * smooth).cast("decimal(20,0)")
    return F.call_function("div", above, F.when(below > 0, below)) + 1


def skyband(gain: np.ndarray, cost: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Whether each point is dominated by fewer than ``k`` others (at least
    its gain, at most its cost, a smaller name; names are different numbers).
    It is enough to count the dominating points that stay: the first k of
    many are themselves dominated by fewer than k."""
    order = np.lexsort((name, cost, -gain))
    g, c, n = gain[order], cost[order], name[order]
    new = np.ones(len(order), bool)
    new[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
    nth = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    left = np.flatnonzero(nth < k)  # of equal counts the first k names
    c, n = c[left], n[left]
    stays, costs, names, held = np.zeros(len(order), bool), np.empty(len(left), c.dtype), np.empty(len(left), n.dtype), 0
    for at in range(0, len(left), 128):
        cs, ns = c[at:at + 128, None], n[at:at + 128, None]
        before = np.tri(len(cs), k=-1, dtype=bool)
        above = ((costs[:held] <= cs) & (names[:held] < ns)).sum(axis=1) + ((cs.T <= cs) & (ns.T < ns) & before).sum(axis=1)
        few = np.flatnonzero(above < k)
        costs[held:held + len(few)], names[held:held + len(few)] = cs[few, 0], ns[few, 0]
        held += len(few)
        stays[order[left[at + few]]] = True
    return stays


_BAND = "lang string, source string, term string, n long, lang_n long, value long, part int"


def _bands(rows: pa.Table, k: int) -> pa.Table:
    """The skyband of each group of the rows."""
    rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in ("lang", "source", "term")])).combine_chunks()
    if not len(rows):
        return rows
    gain, cost = rows["n"].to_numpy(), rows["lang_n"].to_numpy()
    codes = [rows[c].combine_chunks().dictionary_encode() for c in ("lang", "source")]
    codes = [(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c).indices.to_numpy() for c in codes]
    new = np.append(True, (codes[0][1:] != codes[0][:-1]) | (codes[1][1:] != codes[1][:-1]))
    starts = np.flatnonzero(new)
    keep = np.concatenate([skyband(gain[i:j], cost[i:j], np.arange(j - i, dtype=np.int32), k) for i, j in zip(starts, np.append(starts[1:], len(rows)))])
    return rows.filter(pa.array(keep))


def skybands(points: DataFrame, k: int, fan_in: int = FAN_IN) -> DataFrame:
    """The rows of each (lang, source) that are dominated by fewer than ``k``
    others in higher n, lower lang_n and earlier term."""
    def first(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= POINTS:
                held = _bands(pa.Table.from_batches(held), k).to_batches()
                size = 0
        if held:
            yield from _bands(pa.Table.from_batches(held), k).to_batches()

    def merge(rows: pa.Table) -> pa.Table:
        return _bands(rows, k)

    parts = points.rdd.getNumPartitions()
    bands = points.withColumn("part", F.spark_partition_id()).mapInArrow(first, _BAND)
    while parts > 1:
        part = F.floor(F.col("part") / fan_in).cast("int")
        bands = bands.withColumn("part", part).groupBy("lang", "source", "part").applyInArrow(merge, _BAND)
        parts = -(-parts // fan_in)
    return bands


def _pair_sums(rows: pa.Table, size: int) -> pa.Table:
    """Partial sums for the pairs of sources in two blocks and one part of
    the terms. Rows without a term give every source's value of a term that it
    does not use."""
    lang, a, b = (rows.column(c)[0].as_py() for c in ("lang", "a", "b"))
    idx, p = rows.column("idx").to_numpy(), rows.column("p").to_numpy()
    marks = rows.column("term").is_null().to_numpy()
    order = np.argsort(idx[marks])
    sources, rest = idx[marks][order], p[marks][order]
    codes = rows.column("term").filter(pa.array(~marks)).combine_chunks().dictionary_encode()
    codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
    table = np.tile(rest[:, None], (1, len(codes.dictionary)))
    table[np.searchsorted(sources, idx[~marks]), codes.indices.to_numpy(zero_copy_only=False)] = p[~marks]
    block, out = sources // size, []
    for i in np.flatnonzero(block == a).tolist():
        others = np.flatnonzero((block == b) & (sources > sources[i]))
        if len(others):
            sums = np.abs(table[others] - table[i]).sum(axis=1)
            out.append((np.full(len(others), sources[i]), sources[others], sums, np.abs(rest[others] - rest[i])))
    i, j, s, d = (np.concatenate(c) for c in zip(*out)) if out else (np.empty(0, np.int64),) * 4
    return pa.table({"lang": pa.array([lang] * len(i), pa.string()), "i": pa.array(i, pa.int64()), "j": pa.array(j, pa.int64()), "s": pa.array(s, pa.int64()),
                     "d": pa.array(d, pa.int64()), "terms": pa.array(np.full(len(i), len(codes.dictionary)), pa.int64())})


def _pairs(kept: DataFrame, groups: DataFrame, block: int, terms_each: int) -> DataFrame:
    """lang, i, j, value: the distance of every two sources i < j."""
    blocks, parts = F.floor(F.col("sources") / block) + 1, F.floor(F.col("v") / terms_each) + 1
    mine = F.floor(F.col("idx") / block)
    with_block = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other")
    ends = [F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b")]
    terms = (kept.select("lang", "idx", "term", "p", F.pmod(F.xxhash64("term"), parts).alias("part"), mine.alias("mine"), with_block)
             .select("lang", "part", *ends, "idx", "term", "p"))
    marks = (groups.select("lang", "idx", F.col("rest").alias("p"), "v", mine.alias("mine"), with_block)
             .select("*", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
             .select("lang", "part", *ends, "idx", F.lit(None).cast("string").alias("term"), "p"))
    sums = terms.unionByName(marks).groupBy("lang", "part", "a", "b").applyInArrow(
        lambda rows: _pair_sums(rows, block), "lang string, i long, j long, s long, d long, terms long")
    return sums.groupBy("lang", "i", "j").agg(F.sum("s").alias("s"), F.max("d").alias("d"), F.sum("terms").alias("terms"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, scale: int = SCALE, smooth: int = SMOOTH,
          text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          block: int = BLOCK, terms_each: int = TERMS_EACH, rows_each: int = ROWS_EACH, piece: int = PIECE) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    counts = kept_counts(docs, min_docs, text_col, lang_col, source_col, rows_each, piece)
    used, all_groups = counts.where("term <> ''"), counts.where("term = ''").select("lang", "source").distinct()
    terms = used.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    langs = all_groups.groupBy("lang").agg(F.count("*").alias("sources")).join(langs, "lang", "left").na.fill(0, ["v", "lang_total"])
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (all_groups.join(totals, ["lang", "source"], "left").na.fill(0, ["total"]).join(langs, "lang")
              .withColumn("idx", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1))
    none = F.lit(0).cast("long")
    groups = materialize(groups.withColumn("rest", F.coalesce(_share(none, F.col("total"), F.col("v"), scale, smooth), none)))
    kept = used.join(F.broadcast(groups) if fits_broadcast(groups) else groups, ["lang", "source"])
    kept = materialize(kept.select("lang", "source", "idx", "sources", "v", "term", "n", "lang_n",
                                   _share(F.col("n"), F.col("total"), F.col("v"), scale, smooth).alias("p"),
                                   _share(F.col("lang_n"), F.col("lang_total"), F.col("v"), scale, smooth).alias("q")))

    over = skybands(kept.where(F.col("p") > F.col("q")).select("lang", "source", "term", "n", "lang_n", (F.col("p") - F.col("q")).alias("value")), top)
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    over = (over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
            .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top))

    pairs = _pairs(kept, groups, block, terms_each).select("lang", F.explode(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))).alias("x"), "s", "d", "terms")
    names = groups.select("lang", "source", "idx")
    pairs = (pairs.join(groups.select("lang", "source", "v", F.col("idx").alias("i")).alias("g"), (F.col("g.lang") == pairs["lang"]) & (F.col("g.i") == F.col("x.i")))
             .select(pairs["lang"], "g.source", "x.j", (F.col("s") + (F.col("v") - F.col("terms")) * F.col("d")).alias("value"))
             .join(names.select("lang", F.col("source").alias("item"), F.col("idx").alias("j")), ["lang", "j"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(ranked)))
    return pairs.unionByName(over)
