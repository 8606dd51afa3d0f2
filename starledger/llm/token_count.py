"""Operator 5: token counts without ids.

A tokenizer's pieces depend on the pre-token alone, so pieces are counted
once per distinct pre-token, the counts are joined to each document's
pre-token frequencies and summed. Token ids of a text are never made.

1. The texts are tokenised into pre-tokens once. Each task works off its rows
   in blocks of some ten thousand different pre-tokens. A block writes its
   vocabulary, dealt out over ``part``s by a hash of the word, and each
   document's frequencies as (place in that vocabulary, frequency), packed.
2. Of every part, the tokenizer's model counts the pieces of each distinct
   pre-token once, streaming through the blocks' words, and answers each block
   with one number a word. Parts grow with the rows, so a task holds the
   different words of about ``ROWS_EACH`` rows.
3. Frequencies and numbers of pieces meet by block, and are multiplied and
   summed per document. The plan is the same at every size; nothing is
   broadcast, and no key holds more than one block.

The library splits a text at its added special tokens and then by its
pre-tokenizer. For texts whose characters all lie below U+0250 that split is
done by a regular expression (equal to the library's, see the tests); other
texts are split by the library itself.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows
and repeated ids are counted row by row; a text of any length is taken whole;
an empty table gives no rows. Extra columns of the input are not returned.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import batch_column, pack_numbers, partitions_for, unpack_numbers
from starledger.session import materialize

LIMIT = 512
ROWS_EACH = 20_000      # rows whose different words one task may hold
WORDS_AT_ONCE = 60_000  # different pre-tokens of a block, or one document's

#: White space of the library's pattern (Unicode White_Space below U+0250).
_SPACE = r"\t-\r \x85\xa0"
_SPLIT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_RARE = regex.compile(r"[^\x00-ɏ]")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _tokenizer(name: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path(name))


@lru_cache(maxsize=2)
def _specials(name: str):
    """Pattern of the added tokens, longest first; None if there are none."""
    words = sorted((t.content for t in _tokenizer(name).get_added_tokens_decoder().values()), key=lambda w: (-len(w), w))
    return regex.compile("(" + "|".join(map(regex.escape, words)) + ")") if words else None


@lru_cache(maxsize=1)
def _byte_of() -> dict[int, int]:
    """The byte-level alphabet: character -> byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {256 + i: b for i, b in enumerate(rest)}


def _from_alphabet(piece: str) -> str:
    table = _byte_of()
    return bytes(table[ord(c)] for c in piece).decode("utf-8", "surrogateescape")


def pre_tokens(text: str, name: str) -> tuple[list[str], int]:
    """The pre-tokens of a text as the library makes them, and the number of
    special tokens in it."""
    specials, special = _specials(name), 0
    parts = [text]
    if specials is not None and specials.search(text):
        split = specials.split(text)
        parts, special = split[::2], len(split) // 2
    out: list[str] = []
    for part in parts:
        if _RARE.search(part):
            out += [_from_alphabet(p) for p, _ in _tokenizer(name).pre_tokenizer.pre_tokenize_str(part)]
        else:
            out += _SPLIT.findall(part)
    return out, special


_BLOCKS = "block long, part int, words binary, uses binary, ids array<long>, n_bytes array<long>, specials array<long>"
_ARROW = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64())]
_NAMES = ["block", "part", "words", "uses", "ids", "n_bytes", "specials"]


def _blocks(name: str, parts: int, words_at_once: int):
    """A task's rows in blocks. One row of a block holds its documents: ids,
    bytes, special tokens and ``uses`` (numbers of different words, then their
    places in ascending steps and their frequencies); the others its words of
    each part, in order, joined by a byte that UTF-8 does not have."""
    def block_rows(block, ids, n_bytes, specials, freqs):
        vocabulary = {w.encode() for freq in freqs for w in freq}
        placed = sorted((zlib.crc32(w) % parts, w) for w in vocabulary)
        place = {w.decode(): i for i, (_, w) in enumerate(placed)}
        sizes = np.fromiter(map(len, freqs), np.int64, len(freqs))
        total = int(sizes.sum())
        places = np.fromiter((place[w] for freq in freqs for w in freq), np.int64, total)
        counts = np.fromiter((n for freq in freqs for n in freq.values()), np.int64, total)
        order = np.lexsort((places, np.repeat(np.arange(len(freqs)), sizes)))
        places, starts = places[order], (np.cumsum(sizes) - sizes)[sizes > 0]
        steps = np.diff(places, prepend=0)
        steps[starts] = places[starts]
        uses = b"".join(len(x).to_bytes(8, "little") + x for x in (pack_numbers(sizes), pack_numbers(steps), pack_numbers(counts[order])))
        rows = [(block, -1, None, uses, ids, n_bytes, specials)]
        for part, words in groupby(placed, key=lambda x: x[0]):
            rows.append((block, part, zstandard.compress(b"\xff".join(w for _, w in words), 3), None, None, None, None))
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW)], names=_NAMES)

    def run(batches):
        block, held, seen = TaskContext.get().partitionId() << 32, ([], [], [], []), set()
        for batch in batches:
            for doc_id, size, text in zip(batch_column(batch, "doc_id").to_pylist(), batch_column(batch, "n_bytes").to_pylist(), batch_column(batch, "text")):
                words, special = pre_tokens(text.as_py(), name)
                freq = Counter(words)
                for column, value in zip(held, (doc_id, size, special, freq)):
                    column.append(value)
                seen.update(freq)
                if len(seen) >= words_at_once or len(held[0]) >= words_at_once:
                    yield block_rows(block, *held)
                    block, held, seen = block + 1, ([], [], [], []), set()
        if held[0]:
            yield block_rows(block, *held)
    return run


def _count_pieces(name: str):
    """Answers each block's words of a part with their numbers of tokens;
    each different word is counted once."""
    def run(batches):
        from tokenizers.pre_tokenizers import ByteLevel
        mapped, model = ByteLevel(add_prefix_space=False, use_regex=False), _tokenizer(name).model
        known: dict[bytes, int] = {}
        for batch in batches:
            answers = []
            for packed in batch_column(batch, "words"):
                words = zstandard.decompress(packed.as_py()).split(b"\xff")
                for w in words:
                    if w not in known:
                        known[w] = len(model.tokenize("".join(p for p, _ in mapped.pre_tokenize_str(w.decode()))))
                answers.append(pack_numbers([known[w] for w in words]))
            yield pa.record_batch([batch_column(batch, "block"), batch_column(batch, "part"), pa.array(answers, pa.binary())], names=["block", "part", "pieces"])
    return run


def _sum_up(documents: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a block with the pieces of its words, in order of part."""
    answers = answers.sort_by("part").column("pieces").to_pylist()
    pieces = np.concatenate([unpack_numbers(a) for a in answers]) if answers else np.empty(0, np.int64)
    out = []
    for row in documents.to_pylist():
        data, parts = row["uses"], []
        while data:
            size = int.from_bytes(data[:8], "little")
            parts.append(unpack_numbers(data[8:8 + size]))
            data = data[8 + size:]
        sizes, steps, counts = parts
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        sums = np.cumsum(steps)  # over all documents; each starts anew at its first step
        before = np.concatenate([[0], sums])[(ends - sizes)]
        upto = np.concatenate([[0], np.cumsum(counts * pieces[sums - before[owner]])])
        tokens = upto[ends] - upto[ends - sizes]
        out.append(pa.table({"doc_id": pa.array(row["ids"], pa.int64()), "n_bytes": pa.array(row["n_bytes"], pa.int64()),
                             "n_tokens": pa.array(tokens + np.array(row["specials"], np.int64), pa.int64())}))
    return pa.concat_tables(out) if out else pa.table({c: pa.array([], pa.int64()) for c in ("doc_id", "n_bytes", "n_tokens")})


def count_tokens(docs: DataFrame, name: str = "byte_bpe_50k.json", limit: int = LIMIT, rows_each: int = ROWS_EACH,
                 words_at_once: int = WORDS_AT_ONCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = partitions_for(spark, docs.count(), rows_each)
    blocks = materialize(texts.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(_blocks(name, parts, words_at_once), _BLOCKS))
    words = blocks.where("part >= 0").select("block", "part", "words").repartition(parts, "part")
    answers = words.mapInArrow(_count_pieces(name), "block long, part int, pieces binary")
    documents = blocks.where("part < 0").select("block", "ids", "n_bytes", "specials", "uses")
    counted = documents.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_sum_up, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
