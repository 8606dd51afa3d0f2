"""Plan properties that matter at scale, checked on the physical plans."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from oracle_compare import SF_SMALL
from starledger.plans import catalog
from starledger.operators.clean import dedup_customers, dedup_orders
from starledger.sources.fixtures import raw_tables


def plan_text(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(catalog.registry()))
def test_no_cross_join_no_python_udf(spark, name):
    text = plan_text(catalog.registry()[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in text, f"{name} plans {bad}"


def test_keep_first_limits_before_the_shuffle(spark):
    text = plan_text(dedup_customers(raw_tables(spark, SF_SMALL).customers))
    partial = text.index("row_number(), 1, Partial")
    final = text.index("row_number(), 1, Final")
    exchange = text.index("Exchange hashpartitioning(customer_id")
    # printed top-down: Final above the exchange, Partial below it
    assert final < exchange < partial


def test_fixture_dedup_reuses_the_line_partitioning(spark):
    text = plan_text(dedup_orders(raw_tables(spark, SF_SMALL).orders))
    assert text.count("Exchange hashpartitioning") == 1


def test_top_customers_aggregates_before_joining(spark):
    text = plan_text(catalog.registry()["top_customers"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text
    join = text.index("Join")
    assert "HashAggregate(keys=[customer_id" in text[join:]


def test_recent_orders_limits_before_joining(spark):
    text = plan_text(catalog.registry()["recent_orders"](spark, SF_SMALL))
    join = text.index("Join")
    assert "TakeOrderedAndProject" in text[join:]


def test_scans_read_only_needed_columns(spark):
    text = plan_text(catalog.registry()["margin_by_category"](spark, SF_SMALL))
    part_scan = [line for line in text.splitlines() if "part.parquet" in line]
    assert part_scan and all("p_name" not in line and "p_brand" not in line for line in part_scan)


def test_broadcast_only_under_the_checked_size(spark):
    from starledger.operators.joins import broadcast_if_small
    fact = spark.range(100000).selectExpr("id % 50 AS k", "id AS v")
    dim = spark.range(50).selectExpr("id AS k2", "CAST(id AS STRING) AS name")
    joined = fact.join(broadcast_if_small(dim), fact["k"] == F.col("k2"), "left")
    assert "BroadcastHashJoin" in plan_text(joined)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = fact.join(broadcast_if_small(dim), fact["k"] == F.col("k2"), "left")
        assert "BroadcastHashJoin" not in plan_text(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_broadcast_side_is_measured(spark):
    from starledger.operators import joins
    ids = spark.range(10).selectExpr("CAST(id AS STRING) AS k")
    assert joins.measured_bytes(ids) == 10 * (16 + 16 + 1) and joins.fits_broadcast(ids)
    long = spark.range(10).select(F.repeat(F.lit("x"), 1 << 20).alias("k"))
    assert not joins.fits_broadcast(long)


@pytest.mark.parametrize("name", ["kpi_total_sales", "kpi_total_margin", "kpi_order_count", "kpi_avg_ticket",
                                  "kpi_panel", "sales_by_month", "sales_by_channel", "margin_by_category",
                                  "dim_channels", "dim_date_range", "next_order_id", "load_counts",
                                  "kpi_panel_display", "impute_sku_mean", "impute_global_mean"])
def test_reports_read_the_tables_themselves(spark, name):
    text = plan_text(catalog.registry()[name](spark, SF_SMALL))
    assert "ExistingRDD" not in text and "/written/" not in text and text.count("lineitem.parquet") == 1


def test_written_rows_are_read_by_column(spark):
    """Each consumer of a written intermediate reads its own columns, and the
    folder survives as long as the frame's session."""
    from starledger.session import materialize
    kept = materialize(spark.range(100).selectExpr("id AS a", "id % 7 AS b", "struct(id AS k, 'x' AS s) AS seq"))
    text = plan_text(kept.groupBy("b").count(), "formatted")
    assert "/written/" in text and "ReadSchema: struct<b:bigint>" in text
    assert kept.count() == 100 and kept.where("seq.k = 5").first()["a"] == 5


def test_top_products_writes_only_sums(spark):
    text = plan_text(catalog.registry()["top_products"](spark, SF_SMALL), "formatted")
    assert "TakeOrderedAndProject" in text and "lineitem.parquet" not in text and "customer_id" not in text
