"""Reconciliation and invariance checks on the driver tables."""

from pyspark.sql import functions as F

from oracle_compare import SF_SMALL
from starledger.operators import kpis as K
from starledger.operators import profile as P
from starledger.plans.model import clean_model
from starledger.sources.fixtures import RawTables, raw_tables


def test_breakdowns_sum_to_total(spark):
    m = clean_model(raw_tables(spark, SF_SMALL))
    total = K.kpi_total_sales(m.orders).first()["ventas_totales"]
    for df in (K.sales_by_month(m.orders), K.sales_by_channel(m.orders),
               K.margin_by_category(m.orders, m.products)):
        assert round(sum(r["ventas"] for r in df.collect()), 2) == round(total, 2)
    panel = K.kpi_panel(m.orders).first()
    assert panel["ventas_totales"] == total
    assert panel["num_pedidos"] == K.kpi_order_count(m.orders).first()["numero_pedidos"]


def test_order_ids_unique_after_clean(spark):
    m = clean_model(raw_tables(spark, SF_SMALL))
    row = m.orders.agg(F.count("order_id").alias("n"), F.countDistinct("order_id").alias("d")).first()
    assert row["n"] == row["d"]


def test_drop_impact_matches_clean_without_null_quantities(spark):
    raw = raw_tables(spark, SF_SMALL)
    assert raw.orders.filter(F.col("quantity").isNull()).count() == 0
    impact = P.drop_impact(raw.orders).first()
    assert impact["filas_resultantes"] == clean_model(raw).orders.count()


def test_result_independent_of_input_partitioning(spark):
    raw = raw_tables(spark, SF_SMALL)
    shuffled = RawTables(raw.customers.repartition(7), raw.products.repartition(5),
                         raw.orders.repartition(11, "sku"))
    a = clean_model(raw).orders.collect()
    b = clean_model(shuffled).orders.collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
