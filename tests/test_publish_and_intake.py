"""Publishing, re-runs and separate streams; repeated order ids in KPIs."""

import datetime
import os
import types

import pytest
from pyspark.sql import functions as F

from starledger.operators import kpis
from starledger.plans import intake_job
from starledger.session import ensure_checkpoint_dir
from starledger.sources import sinks


def test_latest_run_is_by_time(spark, tmp_dir):
    for i, run in enumerate(("r9", "r10")):
        (spark.createDataFrame([(run, datetime.datetime(2026, 1, 1 + i))], "run string, published_at timestamp")
         .write.mode("append").parquet(f"{tmp_dir}/_runs"))
    assert sinks.current_run(spark, tmp_dir) == "r10"


def test_empty_rewrite_replaces(spark, tmp_dir):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    sinks.write_partition(df, tmp_dir, "batch_id", "a/b")
    assert spark.read.parquet(tmp_dir).count() == 2
    sinks.write_partition(df.limit(0), tmp_dir, "batch_id", "a/b")
    sinks.write_partition(df.limit(1), tmp_dir, "batch_id", "c")
    rows = spark.read.parquet(tmp_dir).collect()
    assert [r.batch_id for r in rows] == ["c"]


def test_unreadable_appends_are_an_error(spark, tmp_dir):
    assert intake_job.appended_orders(spark, tmp_dir) is None
    os.makedirs(f"{tmp_dir}/accepted/batch_id=1")
    with open(f"{tmp_dir}/accepted/batch_id=1/part-0.parquet", "wb") as f:
        f.write(b"not parquet at all")
    with pytest.raises(Exception):
        intake_job.appended_orders(spark, tmp_dir).count()


def test_repeated_order_id_counts_once(spark):
    rows = spark.createDataFrame([("o1", 1, 100), ("o1", 1, 100), ("o2", 1, 100)], "order_id string, quantity int, price_cents long")
    assert kpis.kpi_order_count(rows).first()[0] == 2


def test_shared_folder_is_required_on_a_cluster(spark):
    conf = types.SimpleNamespace(get=lambda *a: None, set=lambda *a: None)
    sc = types.SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(types.SimpleNamespace(conf=conf, sparkContext=sc))
