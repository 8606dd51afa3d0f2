"""KPI cards (K1-K5), breakdowns and top-k (G1-G5), filter lists.

Inputs are the clean tables (money in cents). Plans aggregate the fact by the
join key first and join the per-key aggregate (one row per sku / customer) to
the dimension, so the fact is never shuffled for a dimension join and a hot
key is combined map-side. Margins use
``sum(q * (p - c)) = sum(q * p) - c * sum(q)`` per sku, exact in integers.

``order_id`` is unique in the clean fact (keep-first dedup; checked by the
primary-key constraint job, and kept by the intake job), so the reports'
``COUNT(DISTINCT order_id)`` is computed as written: a fact whose ids repeat
counts each id once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.functions.money import div_half_away, line_amount, to_money
from starledger.schemas import NO_CATEGORY_LABEL


def _line() -> F.Column:
    return line_amount(F.col("quantity"), F.col("price_cents"))


def wide(c: F.Column) -> F.Column:
    """A whole number as a decimal: sums of cents go beyond 64 bits."""
    return c.cast("decimal(20,0)")


def _sales() -> F.Column:
    return F.sum(wide(_line()))


def _orders_count() -> F.Column:
    return F.count_distinct("order_id").cast("bigint")


def ticket(sales_cents: F.Column, orders: F.Column) -> F.Column:
    return to_money(div_half_away(sales_cents, orders))


def pct_one_decimal(part_cents: F.Column, whole_cents: F.Column) -> F.Column:
    """``round(CASE WHEN whole = 0 THEN 0 ELSE part * 100 / whole END, 1)``."""
    return F.when(whole_cents == 0, F.lit(0.0)).otherwise(
        div_half_away(part_cents.cast("decimal(38,0)") * F.lit(1000), whole_cents)
        .cast("double") / F.lit(10.0))


def sku_sales(orders: DataFrame) -> DataFrame:
    """Per sku: units (coalesced) and sales cents."""
    return orders.groupBy("sku").agg(
        F.sum(F.coalesce(F.col("quantity"), F.lit(0))).cast("bigint").alias("units"),
        _sales().alias("sales_cents"))


def _with_product_cost(per_sku: DataFrame, products: DataFrame, how: str) -> DataFrame:
    p = products.select(F.col("sku").alias("_p_sku"), "category", "cost_cents")
    joined = per_sku.join(p, per_sku["sku"] == p["_p_sku"], how).drop("_p_sku")
    return joined.withColumn(
        "margin_cents",
        F.col("sales_cents") - wide(F.col("units")) * F.coalesce(F.col("cost_cents"), F.lit(0)))


# -------------------------------------------------------------------- cards
def kpi_total_sales(orders: DataFrame) -> DataFrame:
    """K1: ventas_totales."""
    return orders.agg(to_money(_sales()).alias("ventas_totales"))


def kpi_total_margin(orders: DataFrame, products: DataFrame) -> DataFrame:
    """K2: margen_total over orders LEFT JOIN products, missing cost = 0."""
    per_sku = _with_product_cost(sku_sales(orders), products, "left")
    return per_sku.agg(to_money(F.sum("margin_cents")).alias("margen_total"))


def kpi_order_count(orders: DataFrame) -> DataFrame:
    """K3: numero_pedidos."""
    return orders.agg(_orders_count().alias("numero_pedidos"))


def kpi_avg_ticket(orders: DataFrame) -> DataFrame:
    """K4: ventas_totales, numero_pedidos, ticket_promedio (rounded total /
    orders, NULL when there are no orders)."""
    agg = orders.agg(_sales().alias("_s"), _orders_count().alias("numero_pedidos"))
    return agg.select(to_money(F.col("_s")).alias("ventas_totales"), "numero_pedidos",
                      ticket(F.col("_s"), F.col("numero_pedidos")).alias("ticket_promedio"))


def kpi_panel(orders: DataFrame) -> DataFrame:
    """K5: validation panel, no coalesce: ventas_totales, num_pedidos,
    ticket_promedio (unrounded total / orders)."""
    raw_line = F.col("quantity").cast("bigint") * F.col("price_cents")
    agg = orders.agg(F.sum(wide(raw_line)).alias("_s"), _orders_count().alias("num_pedidos"))
    return agg.select(to_money(F.col("_s")).alias("ventas_totales"), "num_pedidos",
                      ticket(F.col("_s"), F.col("num_pedidos")).alias("ticket_promedio"))


# ------------------------------------------------------------- breakdowns
def sales_by_month(orders: DataFrame) -> DataFrame:
    """G1: mes (yyyy-MM), ventas, pedidos; ascending by month."""
    return (orders.groupBy(F.date_format("order_date", "yyyy-MM").alias("mes"))
            .agg(_sales().alias("_s"), _orders_count().alias("pedidos"))
            .select("mes", to_money(F.col("_s")).alias("ventas"), "pedidos")
            .orderBy(F.col("mes").asc_nulls_first()))


def sales_by_channel(orders: DataFrame) -> DataFrame:
    """Canal, ventas, pedidos, ticket_promedio (mean per line)."""
    return (orders.groupBy(F.col("channel").alias("canal"))
            .agg(_sales().alias("_s"), _orders_count().alias("pedidos"),
                 F.count(F.lit(1)).alias("_lines"))
            .select("canal", to_money(F.col("_s")).alias("ventas"), "pedidos",
                    ticket(F.col("_s"), F.col("_lines")).alias("ticket_promedio"))
            .orderBy(F.col("ventas").desc(), F.col("canal").asc_nulls_first()))


def margin_by_category(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Categoria, ventas, margen, pct_margen. Grouped on the raw category
    (NULL = product not in the catalogue), labelled after grouping."""
    per_sku = _with_product_cost(sku_sales(orders), products, "left")
    return (per_sku.groupBy("category")
            .agg(F.sum("sales_cents").alias("_s"), F.sum("margin_cents").alias("_m"))
            .select(F.coalesce(F.col("category"), F.lit(NO_CATEGORY_LABEL)).alias("categoria"),
                    to_money(F.col("_s")).alias("ventas"),
                    to_money(F.col("_m")).alias("margen"),
                    pct_one_decimal(F.col("_m"), F.col("_s")).alias("pct_margen"))
            .orderBy(F.col("margen").desc(), F.col("categoria").asc_nulls_first()))


def top_customers(orders: DataFrame, customers: DataFrame, k: int = 10) -> DataFrame:
    """Top-k customers by revenue (inner join): customer_id, cliente,
    pais, segmento, ingresos, pedidos, ticket_promedio. Ties broken by id."""
    per_customer = orders.groupBy("customer_id").agg(
        _sales().alias("_s"), _orders_count().alias("pedidos"))
    c = customers.select(F.col("customer_id").alias("_c_id"), "name", "country", "segment")
    joined = per_customer.join(c, per_customer["customer_id"] == c["_c_id"], "inner")
    return (joined.select(
                "customer_id", F.col("name").alias("cliente"), F.col("country").alias("pais"),
                F.col("segment").alias("segmento"), to_money(F.col("_s")).alias("ingresos"),
                "pedidos", ticket(F.col("_s"), F.col("pedidos")).alias("ticket_promedio"))
            .orderBy(F.col("ingresos").desc(), F.col("customer_id").asc())
            .limit(k))


def top_products(orders: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """Top-k products by revenue (inner join): sku, categoria,
    unidades_vendidas, ingresos, margen, costo_unitario. Ties broken by sku."""
    per_sku = _with_product_cost(sku_sales(orders), products, "inner")
    return (per_sku.select(
                "sku", F.coalesce(F.col("category"), F.lit(NO_CATEGORY_LABEL)).alias("categoria"),
                F.col("units").alias("unidades_vendidas"),
                to_money(F.col("sales_cents")).alias("ingresos"),
                to_money(F.col("margin_cents")).alias("margen"),
                to_money(F.col("cost_cents")).alias("costo_unitario"))
            .orderBy(F.col("ingresos").desc(), F.col("sku").asc())
            .limit(k))


# ------------------------------------------------------------ filter lists
def dim_channels(orders: DataFrame) -> DataFrame:
    """Distinct channels, sorted."""
    return orders.select(F.col("channel").alias("canal")).distinct().orderBy(
        F.col("canal").asc_nulls_first())


def dim_categories(products: DataFrame) -> DataFrame:
    """Distinct categories, sorted."""
    return products.select(F.col("category").alias("categoria")).distinct().orderBy(
        F.col("categoria").asc_nulls_first())


def dim_countries(customers: DataFrame) -> DataFrame:
    """D3: distinct countries, sorted."""
    return customers.select(F.col("country").alias("pais")).distinct().orderBy(
        F.col("pais").asc_nulls_first())


def dim_date_range(orders: DataFrame) -> DataFrame:
    """fecha_inicio, fecha_fin."""
    return orders.agg(F.min("order_date").alias("fecha_inicio"),
                      F.max("order_date").alias("fecha_fin"))
