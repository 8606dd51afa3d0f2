"""Serving queries (A1-A7): the dashboard's lookups, recent orders, the KPI
panel and the next free order id, as DataFrames over the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.functions.money import to_money
from starledger.operators.ids import order_id_of, order_number
from starledger.operators.kpis import kpi_panel, kpi_total_margin


def customer_lookup(customers: DataFrame) -> DataFrame:
    """A1: customer_id, name ordered by name (then id)."""
    return customers.select("customer_id", "name").orderBy(
        F.col("name").asc_nulls_first(), F.col("customer_id").asc_nulls_first())


def customer_list(customers: DataFrame) -> DataFrame:
    """A2: customer_id, name, country, segment ordered by name (then id)."""
    return customers.select("customer_id", "name", "country", "segment").orderBy(
        F.col("name").asc_nulls_first(), F.col("customer_id").asc_nulls_first())


def active_products(products: DataFrame) -> DataFrame:
    """A3: sku, category, cost of the active products, by sku."""
    return (products.filter(F.col("active"))
            .select("sku", "category", to_money(F.col("cost_cents")).alias("cost"))
            .orderBy(F.col("sku").asc_nulls_first()))


def recent_orders(orders: DataFrame, customers: DataFrame, products: DataFrame,
                  n: int = 20) -> DataFrame:
    """A4: the ``n`` latest orders (date desc, id desc) with customer name and
    category (LEFT joins) and the line total.

    The top-n is taken on the fact first (a bounded top-k per task, no full
    sort) and only those rows are joined: the dimensions have unique keys, so
    a left join neither adds nor drops rows and commutes with the limit.
    """
    latest = orders.orderBy(F.col("order_date").desc_nulls_last(),
                            F.col("order_id").desc_nulls_last()).limit(n)
    c = customers.select(F.col("customer_id").alias("_c_id"), F.col("name").alias("customer_name"))
    p = products.select(F.col("sku").alias("_p_sku"), "category")
    j = (latest.join(c, latest["customer_id"] == c["_c_id"], "left")
               .join(p, latest["sku"] == p["_p_sku"], "left"))
    return j.select("order_id", "customer_id", "customer_name", "sku", "category", "quantity",
                    to_money(F.col("price_cents")).alias("unit_price"),
                    to_money(F.col("quantity").cast("bigint") * F.col("price_cents")).alias("total"),
                    "order_date", "channel").orderBy(
        F.col("order_date").desc_nulls_last(), F.col("order_id").desc_nulls_last())


def recent_orders_display(recent: DataFrame) -> DataFrame:
    """A5: display fallbacks: name or id, category or '-', date as yyyy-MM-dd."""
    def blank_null(c):
        return F.when(F.col(c) == "", F.lit(None)).otherwise(F.col(c))
    return recent.select(
        "order_id",
        F.coalesce(blank_null("customer_name"), F.col("customer_id").cast("string")).alias("cliente"),
        "sku",
        F.coalesce(blank_null("category"), F.lit("-")).alias("categoria"),
        F.col("quantity").alias("cantidad"), F.col("unit_price").alias("precio"), "total",
        F.substring(F.date_format("order_date", "yyyy-MM-dd"), 1, 10).alias("fecha"),
        F.col("channel").alias("canal"))


def kpi_panel_display(orders: DataFrame, products: DataFrame) -> DataFrame:
    """The four panel figures with NULL shown as 0."""
    panel = kpi_panel(orders)
    margin = kpi_total_margin(orders, products).select("margen_total").scalar()
    return panel.select(
        F.coalesce("ventas_totales", F.lit(0.0)).alias("ventas_totales"),
        F.coalesce(margin, F.lit(0.0)).alias("margen"),
        F.coalesce("num_pedidos", F.lit(0)).cast("bigint").alias("num_pedidos"),
        F.coalesce("ticket_promedio", F.lit(0.0)).alias("ticket_promedio"))


def next_order_id(orders: DataFrame) -> DataFrame:
    """A7: 'O' + zero-padded (6) numeric maximum + 1, or O000001.

    Takes the numeric maximum of ids shaped ``O<digits>`` (a lexical maximum
    goes wrong past O999999)."""
    return orders.agg(F.max(order_number(F.col("order_id"))).alias("_m")).select(
        order_id_of(F.coalesce(F.col("_m"), F.lit(0)) + 1).alias("next_order_id"))
