"""Order intake over a folder stream.

New CSV files of submitted orders (text columns like the order form) are
picked up by ``readStream``; each micro-batch is validated and appended with
``foreachBatch`` through the same batch job (I6), keyed by stream and
micro-batch id: a stream with another checkpoint folder starts at batch 0
again and must not replace the first one's batches. A retried micro-batch rewrites its own partitions and is checked against
the fact without itself, so the sink is idempotent and the stream
exactly-once together with its checkpoint.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starledger.plans.id_index import IdIndex
from starledger.plans.intake_job import append_batch
from starledger.schemas import INTAKE_TEXT

FORM_FIELDS = [f for f in INTAKE_TEXT.fields if f.name != "seq"]


def intake_stream(spark: SparkSession, source_dir: str, files_at_once: int | None = None) -> DataFrame:
    """Submitted rows with their file and split; a micro-batch takes at most
    ``files_at_once`` files, oldest first."""
    from pyspark.sql import types as T
    schema = T.StructType(FORM_FIELDS)
    reader = spark.readStream.schema(schema).option("header", True).option("escape", '"')
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return (reader.csv(source_dir)
            .withColumn("_file", F.col("_metadata.file_path"))
            .withColumn("_block", F.col("_metadata.file_block_start")))


def start(spark: SparkSession, source_dir: str, published_orders: DataFrame, intake_dir: str,
          checkpoint_dir: str, as_of_date: str, available_now: bool = True,
          customers: DataFrame | None = None, products: DataFrame | None = None,
          strict: bool = False, stream_id: str | None = None, index: IdIndex | None = None) -> StreamingQuery:
    """Start the intake stream; with ``available_now`` it processes what is
    in the folder and stops. ``stream_id`` names the stream's batches; it
    follows from the checkpoint folder unless given. With ``index`` a
    micro-batch reads only the index buckets of its ids."""
    stream = stream_id or hashlib.sha1(checkpoint_dir.rstrip("/").encode()).hexdigest()[:12]

    def process(batch: DataFrame, batch_id: int) -> None:
        # Submission order: file, split, then position within the split.
        ordered = batch.withColumn("seq", F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"),
                                                   F.monotonically_increasing_id().alias("row"))
                                   ).drop("_file", "_block")
        append_batch(batch.sparkSession, ordered, f"{stream}-{batch_id}", published_orders, intake_dir,
                     as_of_date, customers, products, strict, index)

    writer = (intake_stream(spark, source_dir).writeStream.foreachBatch(process)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
