"""Order intake as a batch append (I6): validate a batch, append accepted
rows to the fact, keep rejects with reasons.

Appended rows live in ``<intake_dir>/accepted/batch_id=<id>`` and rejects in
``<intake_dir>/rejected/batch_id=<id>``; writing a batch replaces both folders,
also when nothing is accepted any more. Uniqueness is checked against the published fact plus every other
appended batch, never the batch's own partition, so re-running a batch id
(after a failure, or a streaming retry) gives the same result instead of
rejecting its own rows.

With an ``IdIndex`` over the published ids, a batch reads only the index
buckets that its ids fall into; the fact and the earlier appends are not
scanned. A batch's accepted ids are stored in the index before its rows are
appended, as a batch of their own, so a run that broke off in between is made
good by the retry.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.functions.text import blank_to_null
from starledger.operators.intake import accepted, rejected, validate
from starledger.plans.id_index import INTAKE, IdIndex
from starledger.session import materialize
from starledger.sources.sinks import write_partition


def appended_orders(spark: SparkSession, intake_dir: str) -> DataFrame | None:
    """All appended rows; None if no batch has been written yet. Any other
    trouble with the folder is an error, not an empty fact."""
    try:
        return spark.read.parquet(f"{intake_dir.rstrip('/')}/accepted").withColumn("batch_id", F.col("batch_id").cast("string"))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current_ids(spark: SparkSession, published_orders: DataFrame, intake_dir: str,
                exclude_batch: str | None = None) -> DataFrame:
    ids = published_orders.select("order_id")
    appended = appended_orders(spark, intake_dir)
    if appended is not None:
        if exclude_batch is not None:
            appended = appended.filter(F.col("batch_id") != exclude_batch)
        ids = ids.unionByName(appended.select("order_id"))
    return ids


def _index_batch(batch_id: str) -> str:
    return f"{INTAKE}{batch_id}"


def append_batch(spark: SparkSession, batch: DataFrame, batch_id: str, published_orders: DataFrame,
                 intake_dir: str, as_of_date: str, customers: DataFrame | None = None,
                 products: DataFrame | None = None, strict: bool = False, index: IdIndex | None = None) -> None:
    if index is None:
        ids = current_ids(spark, published_orders, intake_dir, exclude_batch=batch_id)
    else:
        batch = materialize(batch)
        ids = index.matching(batch.select(blank_to_null(F.col("order_id")).alias("order_id")), without=[_index_batch(batch_id)])
    checked = validate(batch, ids, as_of_date, customers, products, strict, id_types=dict(published_orders.dtypes))
    checked = materialize(checked)  # read by both writes below
    if index is not None:
        index.add(accepted(checked).select("order_id"), _index_batch(batch_id))
    base = intake_dir.rstrip("/")
    for kind, frame in (("accepted", accepted(checked)), ("rejected", rejected(checked))):
        write_partition(frame, f"{base}/{kind}", "batch_id", batch_id)


def fact_with_appends(spark: SparkSession, published_orders: DataFrame, intake_dir: str) -> DataFrame:
    """The fact as queries see it: published rows plus accepted appends."""
    appended = appended_orders(spark, intake_dir)
    if appended is None:
        return published_orders
    return published_orders.unionByName(appended.drop("batch_id"))
