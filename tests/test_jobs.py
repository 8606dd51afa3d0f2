"""Write paths: CSV scan, missing input, snapshot, export, publish, intake."""

import os

import pytest
from pyspark.sql import functions as F

from oracle_compare import SF_SMALL
from starledger.plans import etl
from starledger.plans.intake_job import append_batch, current_ids, fact_with_appends
from starledger.sources import csv as S
from starledger.sources.fixtures import INTAKE_AS_OF, raw_tables
from starledger.sources.sinks import ConstraintError, publish, read_published
from starledger.streaming import intake_stream


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_missing_inputs_reported_together(spark, tmp_dir):
    _write(f"{tmp_dir}/customers.csv", "customer_id,name,country,segment,created_at\n")
    with pytest.raises(S.MissingInputError) as err:
        S.load_raw_csv(spark, tmp_dir)
    assert "products.csv" in str(err.value) and "orders.csv" in str(err.value)


def test_csv_scan_tokens_types_and_file_order(spark, tmp_dir):
    _write(f"{tmp_dir}/customers.csv", "customer_id,name,country,segment,created_at\n"
                                       "C1,Ana,NA,Retail,2024-01-01\nC2,Luz,,N/A,2024-01-02\n")
    _write(f"{tmp_dir}/products.csv", "sku,category,cost,active\nS1,a,-6.94,True\nS2,,1.5,False\n")
    rows = "".join(f"O{i:06d},C1,S1,1,1.25,2024-01-01,retail\n" for i in range(2000))
    _write(f"{tmp_dir}/orders.csv", "order_id,customer_id,sku,quantity,unit_price,order_date,channel\n"
                                    + rows + "O000001,C1,S1,7,9.99,2024-01-02,retail\n")
    raw = S.load_raw_csv(spark, tmp_dir)
    c = {r["customer_id"]: r for r in raw.customers.collect()}
    assert c["C1"]["country"] is None and c["C2"]["segment"] is None
    p = {r["sku"]: r for r in raw.products.collect()}
    assert p["S1"]["cost_cents"] == -694 and p["S2"]["active"] is False
    from starledger.operators.clean import dedup_orders
    first = dedup_orders(raw.orders.repartition(4)).filter(F.col("order_id") == "O000001").first()
    assert first["quantity"] == 1 and first["price_cents"] == 125


def test_csv_keep_first_across_two_files(spark, tmp_dir):
    header = "order_id,customer_id,sku,quantity,unit_price,order_date,channel\n"
    big = "".join(f"O{i:06d},C1,S1,1,1.00,2024-01-01,retail\n" for i in range(3000))
    _write(f"{tmp_dir}/in/a.csv", header + "O999999,C1,S1,5,1.00,2024-01-01,retail\n")
    _write(f"{tmp_dir}/in/b.csv", header + big + "O999999,C1,S1,6,1.00,2024-01-01,retail\n")
    df = S.typed_orders(S.read_text_csv(spark, f"{tmp_dir}/in", S.ORDERS_CSV))
    from starledger.operators.clean import dedup_orders
    assert dedup_orders(df).filter(F.col("order_id") == "O999999").first()["quantity"] == 5


def test_pipeline_run_publish_idempotent_and_snapshot(spark, tmp_dir):
    raw = raw_tables(spark, SF_SMALL)
    s1 = etl.run(spark, raw, tmp_dir, "r1")
    s2 = etl.run(spark, raw, tmp_dir, "r2")
    assert s1.counts == s2.counts and s1.kpis == s2.kpis
    assert s1.counts["orders"] == s1.kpis["orders"]
    pub = read_published(spark, f"{tmp_dir}/warehouse")
    r1 = spark.read.parquet(f"{tmp_dir}/warehouse/orders").filter(F.col("run") == "r1").drop("run")
    assert pub["orders"].exceptAll(r1).count() == 0 and r1.exceptAll(pub["orders"]).count() == 0
    snap = spark.read.parquet(f"{tmp_dir}/archive/orders")
    assert snap.filter(F.col("snapshot") == "r1").count() == raw.orders.count()
    exported = spark.read.option("header", True).csv(f"{tmp_dir}/processed/orders_clean")
    assert exported.count() == s1.counts["orders"]
    assert spark.sql("select count(*) n from v_orders_enriched").first()["n"] == s1.counts["orders"]
    # rerunning the same run id replaces its partition instead of doubling it
    etl.run(spark, raw, tmp_dir, "r1", archive=True, export=False)
    assert spark.read.parquet(f"{tmp_dir}/archive/orders").filter(F.col("snapshot") == "r1").count() \
        == raw.orders.count()


def test_publish_blocked_by_fatal_violation(spark, tmp_dir):
    raw = raw_tables(spark, SF_SMALL)
    from starledger.plans.model import clean_model
    m = clean_model(raw)
    bad_orders = m.orders.withColumn("quantity", F.lit(-1))
    with pytest.raises(ConstraintError):
        publish(spark, {"customers": m.customers, "products": m.products, "orders": bad_orders},
                tmp_dir, "bad")
    assert not os.path.exists(f"{tmp_dir}/_runs")


def _intake_rows(spark):
    return spark.createDataFrame(
        [("O900001", "1", "2", "3", "10.50", "2024-05-01", "retail", 1),
         ("O900001", "1", "2", "4", "10.50", "2024-05-01", "retail", 2),   # repeated
         ("O900002", "1", "2", "x", "0", "2030-01-01", "retail", 3),       # three errors
         (" ", "1", "2", "1", "1", "", "retail", 4)],                        # id + date
        "order_id string, customer_id string, sku string, quantity string, unit_price string, "
        "order_date string, channel string, seq long")


def test_intake_append_is_retry_safe(spark, tmp_dir):
    published = spark.createDataFrame([("O000001",)], "order_id string")
    batch = _intake_rows(spark)
    append_batch(spark, batch, "b1", published, tmp_dir, INTAKE_AS_OF)
    append_batch(spark, batch, "b1", published, tmp_dir, INTAKE_AS_OF)  # retry
    acc = spark.read.parquet(f"{tmp_dir}/accepted").collect()
    assert [r["order_id"] for r in acc] == ["O900001"] and acc[0]["quantity"] == 3
    rej = {r["seq"]: r["errores"] for r in spark.read.parquet(f"{tmp_dir}/rejected").collect()}
    assert rej[2] == "Order ID repetido en el lote"
    assert rej[3] == ("Cantidad inválida | Precio unitario debe ser mayor a 0 | "
                      "La fecha no puede ser futura")
    assert rej[4] == "Order ID es requerido | Fecha es requerida"
    # a second batch with the same id is rejected as existing
    append_batch(spark, batch.limit(1), "b2", published, tmp_dir, INTAKE_AS_OF)
    rej2 = spark.read.parquet(f"{tmp_dir}/rejected").filter(F.col("batch_id") == "b2").collect()
    assert rej2[0]["errores"] == "Order ID ya existe"
    assert current_ids(spark, published, tmp_dir).count() == 2
    full = spark.read.parquet(f"{tmp_dir}/accepted").drop("batch_id").limit(0)
    assert fact_with_appends(spark, full, tmp_dir).count() == 1


def test_intake_stream_available_now(spark, tmp_dir):
    src = f"{tmp_dir}/incoming"
    _write(f"{src}/f1.csv", "order_id,customer_id,sku,quantity,unit_price,order_date,channel\n"
                            "O900010,1,2,3,10.50,2024-05-01,retail\n"
                            "O900010,1,2,3,10.50,2024-05-01,retail\n"
                            "O000001,1,2,3,10.50,2024-05-01,retail\n")
    published = spark.createDataFrame([("O000001",)], "order_id string")
    q = intake_stream.start(spark, src, published, f"{tmp_dir}/intake", f"{tmp_dir}/ckpt",
                            INTAKE_AS_OF)
    q.awaitTermination(120)
    acc = spark.read.parquet(f"{tmp_dir}/intake/accepted").collect()
    assert [r["order_id"] for r in acc] == ["O900010"]
    rej = sorted(r["errores"] for r in spark.read.parquet(f"{tmp_dir}/intake/rejected").collect())
    assert rej == ["Order ID repetido en el lote", "Order ID ya existe"]
