"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.session import ensure_checkpoint_dir, scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_rows(spark: SparkSession, rows_json: str, schema: str) -> DataFrame:
    """A small literal table from a JSON array of objects, as one SQL
    expression (no local collection is shipped)."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows_json), f"array<struct<{schema}>>")))


def keep(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder."""
    return os.path.join(scratch_path(spark, name), uuid.uuid4().hex)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote, by Spark's own file access."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def partitions_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Partitions so that each gets about ``rows_each`` rows, and no fewer
    than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_each))


def text_bytes(name: str = "text") -> Column:
    """A text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def batch_column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def pack_numbers(values) -> bytes:
    """Numbers below 2**32 by byte planes, compressed."""
    planes = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 3)


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package's code to the executors through Spark's own file
    distribution, so that Python tasks can import it where it is not
    installed. Done once for a Spark application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = tempfile.mkdtemp(prefix="starledger-code-")
    shutil.copytree(os.path.join(root, "starledger"), os.path.join(folder, "code", "starledger"), ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "starledger_code"), "zip", os.path.join(folder, "code")))
    _shipped.add(sc.applicationId)
