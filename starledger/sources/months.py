"""The fact by month, read newest month first.

``write_by_month`` lays a run's orders out as ``run=<id>/month=<yyyy-MM>``. A
top-k by date then opens months from the newest on and stops as soon as those
opened hold k rows: no older month can matter. The first and last day of the
fact are in the first and last month. Orders without a date are in the month
``none``, which comes last.
"""

from __future__ import annotations

from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NO_MONTH = "none"


def write_by_month(orders: DataFrame, path: str, run_id: str, rows_each: int = 2_000_000) -> None:
    """Write the orders of a run by month, replacing what the run had there;
    a month with more than ``rows_each`` rows is spread over several tasks by a
    hash of the order id, so that a month holding much of the fact is not
    written by one."""
    month = F.coalesce(F.date_format("order_date", "yyyy-MM"), F.lit(NO_MONTH))
    rows = orders.withColumn("month", month)
    most = rows.groupBy("month").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    salt = F.pmod(F.xxhash64("order_id"), F.lit(max(1, -(-most // rows_each))))
    (rows.repartition("month", salt).sortWithinPartitions("month", "order_date").write.mode("overwrite").partitionBy("month")
         .parquet(f"{path.rstrip('/')}/run={quote(run_id, safe='')}"))


def months(spark: SparkSession, path: str, run_id: str) -> list[str]:
    """The months of a run, newest first, from the folder's listing."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/run={quote(run_id, safe='')}")
    names = [f.getPath().getName() for f in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)]
    found = sorted((unquote(n.split("=", 1)[1]) for n in names if n.startswith("month=")), reverse=True)
    return sorted(found, key=lambda m: m == NO_MONTH)


def read_months(spark: SparkSession, path: str, run_id: str, names: list[str]) -> DataFrame:
    """The rows of some months of a run (only their folders are listed and read)."""
    base = f"{path.rstrip('/')}/run={quote(run_id, safe='')}"
    return spark.read.option("basePath", base).parquet(*[f"{base}/month={m}" for m in names]).drop("month")


def newest(spark: SparkSession, path: str, run_id: str, n: int) -> DataFrame:
    """Rows among which the ``n`` latest by date are: whole months from the
    newest on until they hold ``n`` rows. Counting a month reads its
    files' footers only."""
    opened, held = [], 0
    for month in months(spark, path, run_id):
        opened.append(month)
        held += read_months(spark, path, run_id, [month]).count()
        if held >= n:
            break
    if not opened:
        raise FileNotFoundError(f"no run {run_id} in {path}")
    return read_months(spark, path, run_id, opened)


def date_range(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The first and last order date, from the first and last month."""
    found = months(spark, path, run_id)
    dated = [m for m in found if m != NO_MONTH]
    return read_months(spark, path, run_id, sorted({dated[0], dated[-1]}) if dated else found).agg(
        F.min("order_date").alias("fecha_inicio"), F.max("order_date").alias("fecha_fin"))
