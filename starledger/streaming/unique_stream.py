"""Order intake with uniqueness kept in streaming state.

The folder stream of ``intake_stream`` without a look-up of earlier batches: a
state store keyed by order id remembers which ids had a valid row, so keep-first
holds across micro-batches. State and input offsets are recovered together from
the checkpoint folder and the file sink commits whole micro-batches, so a
stream stopped or killed in mid-stream and started again gives the rows that the
batch job (``intake.validate``) gives over all files in order of arrival.

Ids published before the stream began (``existing``) are joined as a static
table. The state holds one flag for each accepted or repeated id and does not
expire (an order id stays taken); on a cluster, set RocksDB as the session's
state store (``STATE_STORE``) so that it may exceed memory. Rows that fail a
rule are not keyed by their id and leave no state, so blank ids do not gather
in one task; of a repeated id, a task holds one row beside the current chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from starledger.operators.intake import MSG_EXISTS, MSG_REPEATED, with_row_errors
from starledger.streaming.intake_stream import intake_stream

#: Session settings for a state that is larger than memory.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

_PLACE = ["_file", "_block", "_row"]
_JUDGED = "_file string, _block long, _row long, _payload string, _first boolean"


def _numbered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each row's number within its file split; a task reads its splits one
    after the other, each in order."""
    at, n = None, 0
    for frame in frames:
        rows = []
        for split in zip(frame["_file"], frame["_block"]):
            at, n = (split, 0) if split != at else (at, n + 1)
            rows.append(n)
        yield frame.assign(_row=rows)


def _keep_first(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Flags the id's first valid row, unless an earlier micro-batch had one."""
    columns = [*_PLACE, "_payload", "_first"]
    taken, best = state.exists, None
    for frame in frames:
        frame = frame.assign(_first=False).sort_values(_PLACE, kind="stable")
        if taken or not frame["_valid"].iloc[0]:  # a faulty row is keyed by itself
            yield frame[columns]
            continue
        head, rest = frame.iloc[:1], [frame.iloc[1:]]
        if best is None or tuple(head[_PLACE].iloc[0]) < tuple(best[_PLACE].iloc[0]):
            best, head = head, best
        if head is not None:
            rest.append(head)
        yield pd.concat(rest)[columns]
    if best is not None:
        state.update((True,))
        yield best.assign(_first=True)[columns]


def unique_stream(spark: SparkSession, source_dir: str, existing: DataFrame, as_of_date: str,
                  id_types: dict[str, str] | None = None, customers: DataFrame | None = None,
                  products: DataFrame | None = None, strict: bool = False, files_at_once: int | None = None) -> DataFrame:
    """The stream of judged rows: the fact's columns, the row's place (file,
    block, row), estado and errores, as ``intake.validate`` gives them."""
    rows = intake_stream(spark, source_dir, files_at_once)
    rows = rows.select("*", F.lit(0).cast("long").alias("_row"))
    rows = rows.mapInPandas(_numbered, rows.schema)
    rows = rows.withColumn("seq", F.struct("_file", "_block", "_row")).drop(*_PLACE)
    checked = with_row_errors(rows, as_of_date, customers, products, strict, id_types)
    taken = existing.select(F.col("order_id").alias("_eid")).filter(F.col("_eid").isNotNull()).distinct().withColumn("_exists", F.lit(True))
    checked = checked.join(taken, checked["order_id"] == taken["_eid"], "left").drop("_eid")
    payload = [c for c in checked.columns if c != "seq"]
    schema = checked.select(*payload).schema
    valid = F.col("_row_errors") == ""
    own = F.concat_ws("|", F.lit("row"), "seq._file", "seq._block", "seq._row")
    keyed = checked.select("seq._file", "seq._block", "seq._row", valid.alias("_valid"), F.to_json(F.struct(*payload)).alias("_payload"),
                           F.when(valid, F.concat(F.lit("id|"), "order_id")).otherwise(own).alias("_key"))
    judged = keyed.groupBy("_key").applyInPandasWithState(
        _keep_first, _JUDGED, "seen boolean", "append", GroupStateTimeout.NoTimeout)
    out = judged.select(F.from_json("_payload", schema).alias("p"), *_PLACE, "_first").select("p.*", *_PLACE, "_first")
    errores = (F.when(F.col("_row_errors") != "", F.col("_row_errors"))
                .when(~F.col("_first"), F.lit(MSG_REPEATED))
                .when(F.col("_exists"), F.lit(MSG_EXISTS)))
    return out.select("order_id", "customer_id", "sku", "quantity", "price_cents", "order_date", "channel",
                      F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_row").alias("row"),
                      F.when(errores.isNull(), F.lit("aceptado")).otherwise(F.lit("rechazado")).alias("estado"), errores.alias("errores"))


def start(spark: SparkSession, source_dir: str, existing: DataFrame, out_dir: str, checkpoint_dir: str, as_of_date: str,
          available_now: bool = True, **rules) -> StreamingQuery:
    """Judge the folder's files into ``out_dir`` (Parquet, by estado); with
    ``available_now`` what is there now, then stop. ``existing`` may be the rows
    of an ``IdIndex``; ``rules`` go to ``unique_stream``."""
    stream = unique_stream(spark, source_dir, existing, as_of_date, **rules)
    writer = (stream.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint_dir)
              .partitionBy("estado").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
