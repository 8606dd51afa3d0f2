"""Session helpers.

The library never changes a session it is handed, except for setting a
checkpoint folder when the cluster names none (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library is designed and tested under. AQE is what turns a
# dimension join into a broadcast once the real size of the side is known,
# and what splits a skewed join partition.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of intermediates that are no longer referenced are
    # removed by the context cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "starledger",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the recommended settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is.
    Only when it is unset in a local session (a test or a laptop) a folder of
    our own is set; on any other master that would be the driver's disk, which
    executors do not see, so the missing setting is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context; the conf is what counts
        sc = None
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if not current:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="starledger-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "starledger", name)


#: Compression of what the library writes for itself: less disk than Spark's
#: default (snappy) at little more time.
COMPRESSION = "zstd"


def materialize(df):
    """Write ``df`` once as Parquet below the shared checkpoint folder and
    return a frame that reads it back (lineage cut; survives the loss of
    executors, unlike a cache or a local checkpoint). Used where one expensive
    intermediate feeds several branches whose column pruning would otherwise
    stop shuffle reuse; each branch reads only its own columns. The folder is
    deleted when the driver's JVM ends."""
    spark = df.sparkSession
    path = scratch_path(spark, f"written/{uuid.uuid4().hex}")
    df.write.option("compression", COMPRESSION).parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)
