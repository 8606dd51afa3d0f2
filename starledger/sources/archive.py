"""Byte-identical archive of the source files (S4) with a digest manifest.

Files are kept as pieces: ``<archive>/pieces/snapshot=<id>`` holds (name,
block, piece, content), and the concatenated pieces of a file, in order, are
its bytes. ``<archive>/manifest/snapshot=<id>`` holds each piece's length and
SHA-256 and each file's length, as read from the source.

* A file of at most ``whole_bytes`` is one piece, read as a binary file.
* A longer one is cut at Spark's own file splits and within a split after
  every ``piece_bytes`` at a line end, so no task holds more than one piece
  and one line, and no file passes through one task. The line reader drops
  a byte order mark and does not tell whether the last line has an end; both
  are looked up in the file (a few bytes). A copy whose length differs from its source is an error.

The sources are only read. A snapshot written again replaces itself.
``verify`` reads source and copy again and compares their digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.sources.sinks import write_partition

WHOLE_BYTES, PIECE_BYTES = 64 << 20, 8 << 20
_PIECE = "path string, block long, piece long, content binary"
_MARK = b"\xef\xbb\xbf"


class ArchiveError(RuntimeError):
    """A copy is not as long as its source (a file changed meanwhile, or its
    last line alone is longer than a split)."""


def _edges(spark: SparkSession, path: str, length: int) -> tuple[bool, bool]:
    """Whether a file starts with a byte order mark and ends with a line end."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        head = bytes(stream.read() for _ in range(3))
        stream.seek(length - 1)
        return head == _MARK, stream.read() == 0x0A
    finally:
        stream.close()


def _cut(marked: list[str], unended: list[str], piece_bytes: int):
    """Lines in file order into pieces of a split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, number, held, size = None, 0, [], 0

        def flush():
            return pa.record_batch([pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([number], pa.int64()),
                                    pa.array([b"".join(held)], pa.binary())], names=["path", "block", "piece", "content"])

        for batch in batches:
            for path, block, last, line in zip(*(batch.column(i) for i in range(4))):
                split, line = (path.as_py(), block.as_py(), last.as_py()), line.as_py()
                if split != at:
                    if held:
                        if at[2] and at[0] in unended:
                            held[-1] = held[-1][:-1]
                        yield flush()
                    at, number, held, size = split, 0, [_MARK] if split[1] == 0 and split[0] in marked else [], 0
                elif size >= piece_bytes:
                    yield flush()
                    number, held, size = number + 1, [], 0
                held.append(line + b"\n")
                size += len(line) + 1
        if held:
            if at[2] and at[0] in unended:
                held[-1] = held[-1][:-1]
            yield flush()
    return run


def pieces(spark: SparkSession, source: str, glob: str = "*.csv", whole_bytes: int = WHOLE_BYTES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """path, block, piece, content of every file of a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(source)
    small = files.filter(F.col("length") <= whole_bytes).select("path", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("piece"), "content")
    long = [(r["path"], r["length"]) for r in files.filter(F.col("length") > whole_bytes).select("path", "length").collect()]
    if not long:
        return small
    edges = {path: _edges(spark, path, length) for path, length in long}
    lines = spark.read.option("lineSep", "\n").text([path for path, _ in long]).select(
        "_metadata.file_path", "_metadata.file_block_start",
        ((F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length")) >= F.col("_metadata.file_size")).alias("last"),
        F.col("value").cast("binary").alias("line"))
    # one spelling of a path for both readers
    plain = {path: spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath() for path, _ in long}
    name = F.regexp_replace("file_path", "^[a-z0-9]+:(//[^/]*)?(?=/)", "")
    cut = lines.select(name.alias("path"), "file_block_start", "last", "line").mapInArrow(
        _cut([plain[p] for p in edges if edges[p][0]], [plain[p] for p in edges if not edges[p][1]], piece_bytes), _PIECE)
    return small.withColumn("path", F.regexp_replace("path", "^[a-z0-9]+:(//[^/]*)?(?=/)", "")).unionByName(cut)


def _digests(rows: DataFrame) -> DataFrame:
    name = F.element_at(F.split("path", "/"), -1)
    return rows.select(name.alias("name"), "block", "piece", F.octet_length("content").cast("long").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def archive(spark: SparkSession, source: str, out: str, snapshot: str, glob: str = "*.csv",
            whole_bytes: int = WHOLE_BYTES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Copy a folder's files as ``snapshot``; returns the manifest: name,
    block, piece, n_bytes, sha256."""
    out, options = out.rstrip("/"), (glob, whole_bytes, piece_bytes)
    rows = pieces(spark, source, *options)
    write_partition(rows.select(F.element_at(F.split("path", "/"), -1).alias("name"), "block", "piece", "content"), f"{out}/pieces", "snapshot", snapshot)
    write_partition(_digests(copied(spark, out, snapshot).withColumnRenamed("name", "path")), f"{out}/manifest", "snapshot", snapshot)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(source).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("wanted"))
    sums = manifest(spark, out, snapshot).groupBy("name").agg(F.sum("n_bytes").alias("got"))
    short = files.join(sums, "name", "left").filter(~F.col("wanted").eqNullSafe(F.coalesce("got", F.lit(0)))).select("name").collect()
    if short:
        raise ArchiveError(f"snapshot {snapshot}: not copied byte by byte: {', '.join(sorted(r['name'] for r in short))}")
    return manifest(spark, out, snapshot)


def manifest(spark: SparkSession, out: str, snapshot: str) -> DataFrame:
    return spark.read.parquet(f"{out.rstrip('/')}/manifest").filter(F.col("snapshot") == snapshot).drop("snapshot")


def copied(spark: SparkSession, out: str, snapshot: str) -> DataFrame:
    """name, block, piece, content of a snapshot."""
    return spark.read.parquet(f"{out.rstrip('/')}/pieces").filter(F.col("snapshot") == snapshot).drop("snapshot")


def verify(spark: SparkSession, out: str, snapshot: str, source: str | None = None, glob: str = "*.csv",
           whole_bytes: int = WHOLE_BYTES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The pieces of which copy and manifest (with ``source``: or the source
    and the manifest) differ, or that only one has; no rows if all agree."""
    wanted = manifest(spark, out, snapshot)
    key = ["name", "block", "piece", "n_bytes", "sha256"]
    have = _digests(copied(spark, out, snapshot).withColumnRenamed("name", "path")).select(*key)
    other = [have] if source is None else [have, _digests(pieces(spark, source, glob, whole_bytes, piece_bytes)).select(*key)]
    out_rows = None
    for found in other:
        differ = wanted.select(*key).exceptAll(found).unionByName(found.exceptAll(wanted.select(*key)))
        out_rows = differ if out_rows is None else out_rows.unionByName(differ)
    return out_rows

