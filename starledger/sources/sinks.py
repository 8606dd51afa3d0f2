"""Sinks: raw snapshot (S4), clean CSV export (S5), staged publish.

Every write is safe to retry: a snapshot or a publish replaces its own
partition folder (``snapshot=<id>``, ``run=<id>``) as a whole, also by an
empty frame, and a publish becomes visible only when its run id is appended to the
``_runs`` log after every table is written and checked. Readers take the
latest logged run, so they never see a half-written one.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.operators.checks import constraint_violations
from starledger.session import COMPRESSION

TABLES = ("customers", "products", "orders")


def write_partition(df: DataFrame, path: str, column: str, value: str) -> None:
    """Replace the partition folder ``column=value``; an empty ``df`` leaves
    an empty partition, not the rows of an earlier write."""
    (df.write.option("compression", COMPRESSION).mode("overwrite")
       .parquet(f"{path.rstrip('/')}/{column}={quote(value, safe='')}"))


def snapshot_raw(tables: dict[str, DataFrame], archive_dir: str, snapshot_id: str) -> None:
    """Keep an immutable copy of the raw rows as read (text columns and
    source position), under ``<archive>/<table>/snapshot=<id>``. The sources
    are only read."""
    for name, df in tables.items():
        write_partition(df, f"{archive_dir.rstrip('/')}/{name}", "snapshot", snapshot_id)


def export_csv(tables: dict[str, DataFrame], out_dir: str) -> None:
    """Clean tables as header CSV folders (``<out>/<table>_clean``),
    replacing the previous export; texts keep their outer spaces."""
    for name, df in tables.items():
        (df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd")
           .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
           .csv(f"{out_dir.rstrip('/')}/{name}_clean"))


class ConstraintError(RuntimeError):
    """A fatal table constraint is violated; nothing was published."""


def publish(spark: SparkSession, tables: dict[str, DataFrame], out_dir: str, run_id: str) -> DataFrame:
    """Write the clean tables as run ``run_id``, check constraints on what
    was written, and log the run as published only if no fatal rule fails.

    Returns the violations table (read back from the written run)."""
    out = out_dir.rstrip("/")
    for name in TABLES:
        write_partition(tables[name], f"{out}/{name}", "run", run_id)
    staged = {name: read_run(spark, out, name, run_id) for name in TABLES}
    violations = constraint_violations(staged["customers"], staged["products"], staged["orders"])
    failed = violations.filter(F.col("fatal") & (F.col("violaciones") > 0)).collect()
    if failed:
        rules = ", ".join(f"{r['tabla']}: {r['regla']} ({r['violaciones']})" for r in failed)
        raise ConstraintError(f"run {run_id} not published, constraint violations: {rules}")
    (spark.createDataFrame([(run_id,)], "run string")
          .withColumn("published_at", F.current_timestamp())
          .write.mode("append").parquet(f"{out}/_runs"))
    return violations


def current_run(spark: SparkSession, out_dir: str) -> str:
    """The run published last (by time, not by the order of the ids)."""
    runs = spark.read.parquet(f"{out_dir.rstrip('/')}/_runs")
    row = runs.agg(F.max_by(F.col("run").cast("string"), "published_at").alias("run")).first()
    if row is None or row["run"] is None:
        raise FileNotFoundError(f"no published run in {out_dir}")
    return row["run"]


def read_run(spark: SparkSession, out_dir: str, name: str, run_id: str) -> DataFrame:
    """One table of one run (partition-pruned read)."""
    return (spark.read.parquet(f"{out_dir.rstrip('/')}/{name}")
            .filter(F.col("run") == run_id).drop("run"))


def read_published(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The three tables of the latest published run."""
    run = current_run(spark, out_dir)
    return {name: read_run(spark, out_dir, name, run) for name in TABLES}
