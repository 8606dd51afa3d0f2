"""A stored index of order ids, bucketed by a hash of the id.

Ids live in ``<folder>/buckets=<n>/batch=<batch>/bucket=<b>``. A batch of ids
is looked up by reading only the buckets that its ids fall into (partition
pruning on ``bucket``) and joining on (bucket, id); the fact itself is never
scanned. Ids are sorted within a bucket's files, so a Parquet reader also skips
row groups outside the batch's range of ids.

Every batch owns its folders: adding a batch again replaces it as a whole, and
a look-up can leave batches out, so a retried batch does not find its own ids.
The number of buckets is fixed when an index is opened first; it follows from
the number of ids that a bucket should hold. A NULL id is an id like any other
(keep-first needs that; the intake rejects such rows before it looks them up).
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.operators.joins import fits_broadcast
from starledger.session import COMPRESSION, materialize

BUCKETS = 64
INTAKE = "intake-"    # prefix of the intake's batches
IDS_EACH = 2_000_000  # ids of a bucket for which ``buckets_for`` asks


def buckets_for(ids: int, ids_each: int = IDS_EACH) -> int:
    return max(BUCKETS, -(-ids // ids_each))


_STORED = "order_id string, batch string, bucket int"


class IdIndex:
    """The ids below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.path = f"{folder.rstrip('/')}/buckets={buckets}"

    def bucket(self, order_id: Column) -> Column:
        return F.pmod(F.xxhash64(order_id), F.lit(self.buckets)).cast("int")

    def add(self, ids: DataFrame, batch: str, shards: int = 1) -> None:
        """Store the ids of ``ids`` as ``batch``, replacing what that batch
        stored before. ``shards`` splits a bucket's rows over several files."""
        rows = ids.select(F.col("order_id").cast("string")).withColumn("bucket", self.bucket(F.col("order_id")))
        spread = rows.repartition("bucket") if shards == 1 else rows.repartition(
            self.buckets * shards, "bucket", F.pmod(F.xxhash64("order_id", F.lit(7)), F.lit(shards)))
        (spread.sortWithinPartitions("bucket", "order_id").write.option("compression", COMPRESSION).mode("overwrite").partitionBy("bucket")
               .parquet(f"{self.path}/batch={quote(batch, safe='')}"))

    def add_batches(self, ids: DataFrame) -> None:
        """Store ids (order_id, batch) of many batches, each replaced."""
        rows = ids.select("order_id", "batch", self.bucket(F.col("order_id")).alias("bucket"))
        (rows.repartition("batch", "bucket").sortWithinPartitions("batch", "bucket", "order_id").write.option("compression", COMPRESSION).mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch", "bucket").parquet(self.path))

    def ids(self, without: Sequence[str] = (), before: str | None = None) -> DataFrame | None:
        """All stored rows (with ``batch`` and ``bucket``); None if nothing was
        stored yet. ``without`` leaves batches out, ``before`` keeps those of
        smaller names."""
        try:
            rows = self.spark.read.schema(_STORED).parquet(self.path)  # a batch's name is a text, also if it is digits
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        if without:
            rows = rows.filter(~F.col("batch").isin(list(without)))
        if before is not None:
            rows = rows.filter(F.col("batch") < before)
        return rows

    def touched(self, ids: DataFrame) -> list[int]:
        """The buckets of these ids: at most ``buckets`` numbers."""
        return sorted(r["b"] for r in ids.select(self.bucket(F.col("order_id")).alias("b")).distinct().collect())

    def _stored_near(self, ids: DataFrame, without: Sequence[str], before: str | None) -> DataFrame | None:
        """The stored rows in the buckets of ``ids``; None if nothing was
        stored yet."""
        stored = self.ids(without, before)
        if stored is None:
            return None
        buckets = self.touched(ids)
        return stored.select("order_id", "bucket").filter(F.col("bucket").isin(buckets) if buckets else F.lit(False))

    def matching(self, ids: DataFrame, without: Sequence[str] = (), before: str | None = None) -> DataFrame:
        """The stored ids that are among ``ids`` (a frame with order_id, cheap
        to read twice), each once. Only the buckets of ``ids`` are read."""
        stored = self._stored_near(ids, without, before)
        wanted = ids.select("order_id").distinct()
        if stored is None:
            return wanted.limit(0)
        wanted = wanted.select(F.col("order_id").alias("_wanted"), self.bucket(F.col("order_id")).alias("_bucket"))
        if fits_broadcast(ids.select("order_id")):
            wanted = F.broadcast(wanted)
        found = stored.join(wanted, (stored["bucket"] == wanted["_bucket"]) & stored["order_id"].eqNullSafe(wanted["_wanted"]), "left_semi")
        return found.select("order_id").distinct()

    def unseen(self, rows: DataFrame, without: Sequence[str] = (), before: str | None = None,
               ids: DataFrame | None = None) -> DataFrame:
        """The rows whose id is not stored (one row an id expected). ``ids``:
        the ids of ``rows``, repeated or not, in a frame cheap to read twice;
        without it the rows are written for that.

        Ids too many to broadcast are not matched first: the rows are joined to
        the stored ids of their buckets, on the partitioning by id that
        keep-first has left."""
        if ids is None:
            rows = ids = materialize(rows)
        stored = self._stored_near(ids, without, before)
        if stored is None:
            return rows
        if stored.filter(F.col("order_id").isNull()).limit(1).count():
            rows = rows.filter(F.col("order_id").isNotNull())
        known = stored.select(F.col("order_id").alias("_known"))
        if fits_broadcast(ids.select("order_id")):
            known = F.broadcast(self.matching(ids, without, before).select(F.col("order_id").alias("_known")))
        return rows.join(known, rows["order_id"] == known["_known"], "left_anti")


def open_index(spark: SparkSession, folder: str) -> IdIndex:
    """The index that exists below ``folder``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []
    sizes = [int(n.split("=")[1]) for n in names if n.startswith("buckets=")]
    if len(sizes) != 1:
        raise FileNotFoundError(f"no id index in {folder}")
    return IdIndex(spark, folder, sizes[0])


def index_published(spark: SparkSession, orders: DataFrame, folder: str, run_id: str, appended: DataFrame | None = None,
                    ids_each: int = IDS_EACH) -> IdIndex:
    """An index over a published fact's ids, stored as batch ``run-<run_id>``,
    and over the ids of intake batches (``appended``: order_id, batch_id). The
    number of buckets follows from the fact's rows."""
    index = IdIndex(spark, folder, buckets_for(orders.count(), ids_each))
    index.add(orders.select("order_id"), f"run-{run_id}")
    if appended is not None:
        index.add_batches(appended.select("order_id", F.concat(F.lit(INTAKE), F.col("batch_id")).alias("batch")))
    return index
