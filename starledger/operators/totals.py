"""Report totals straight from the surviving orders, without filling prices
row by row.

An unpriced row's price depends only on its sku (the sku mean, else the mean
of all), so sales are additive over per-sku sums: known sales, plus unpriced
units times the sku's rounded mean, plus the units of skus without a mean
times the rounded mean of all, which is known once every sku has been summed.
One aggregation of the fact answers each report; nothing is written.

Each report takes the surviving rows or the stored ``states`` of any number of
disjoint parts of them (``plans/refresh.py``).

``order_survivors`` keeps one row per order id, so a plain count of ids equals
``COUNT(DISTINCT order_id)`` (a NULL id is not counted by either).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starledger.functions.money import to_money
from starledger.functions.text import normalize_channel
from starledger.operators.clean import exact_price, global_mean
from starledger.operators.kpis import pct_one_decimal, ticket, wide
from starledger.schemas import NO_CATEGORY_LABEL
from starledger.session import materialize


#: Additive columns of ``partial_sums``: states of disjoint rows merge by sum.
SUMS = ["rows", "priced", "orders", "price_sum", "units", "unpriced_units", "known_sales"]


def _sum_units(units: Column, digits: int) -> Column:
    """Units of int quantities add up within 64 bits (9e18 of them), a quarter
    of a decimal's buffer in the shuffle; they are held as decimals."""
    return F.sum(units.cast("bigint")).cast(f"decimal({digits},0)")


def partial_sums(survivors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per sku (and ``by``): counts, units and sums."""
    units, unpriced = F.col("quantity"), F.col("price_cents").isNull()
    return survivors.groupBy("sku", *by).agg(
        F.count(F.lit(1)).alias("rows"), F.count("price_cents").alias("priced"),
        F.count("order_id").alias("orders"), F.sum(exact_price(survivors)).alias("price_sum"),
        _sum_units(units, 30).alias("units"), _sum_units(F.when(unpriced, units), 30).alias("unpriced_units"),
        F.sum(wide(F.col("quantity").cast("bigint") * F.rint("price_cents").cast("bigint"))).alias("known_sales"))


def merge_sums(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of disjoint rows as one state per sku (and ``by``)."""
    return states.groupBy("sku", *by).agg(*[
        (_sum_units(F.col(c), 38) if c in ("units", "unpriced_units") else F.sum(c)).alias(c) for c in SUMS])


def with_month(survivors: DataFrame) -> DataFrame:
    return survivors.withColumn("mes", F.date_format("order_date", "yyyy-MM"))


def with_channel(survivors: DataFrame) -> DataFrame:
    return survivors.withColumn("canal", normalize_channel(F.col("channel")))


def states(survivors: DataFrame) -> DataFrame:
    """The mergeable state that answers every report of this module: sums per
    sku, month and channel."""
    return partial_sums(with_channel(with_month(survivors)), ["mes", "canal"])


def _per_sku(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``partial_sums`` of survivors, or of stored ``states`` merged, with the
    sku's mean. With ``by`` the mean is summed over the sku's groups: as many
    rows as ``by`` has values, whatever the sku's share of the fact."""
    stats = merge_sums(rows, by) if "known_sales" in rows.columns else partial_sums(rows, by)
    total, priced = F.sum("price_sum"), F.sum("priced")
    if by:
        w = Window.partitionBy("sku")
        mean = total.over(w).cast("double") / F.nullif(priced.over(w), F.lit(0))
    else:
        mean = F.col("price_sum").cast("double") / F.nullif(F.col("priced"), F.lit(0))
    return stats.withColumn("sku_mean", F.when(F.col("sku").isNotNull(), mean))


def _summed(per_sku: DataFrame, by: Sequence[str] = (), cost: Column | None = None) -> DataFrame:
    """Additive parts per ``by`` (one row without): see ``_close``."""
    mean = F.col("sku_mean")
    zero = F.lit(0).cast("decimal(38,0)")
    filled = F.coalesce(wide(F.col("unpriced_units")) * wide(F.rint(mean)), zero)
    groups = per_sku.groupBy(*by) if by else per_sku
    return groups.agg(
        F.sum("rows").alias("rows"), F.sum("priced").alias("priced"), F.sum("orders").alias("orders"),
        F.sum(F.coalesce(F.col("known_sales"), zero) + filled).alias("sales"),
        F.sum(F.when(mean.isNull(), F.col("unpriced_units"))).alias("open_units"),
        F.sum(F.col("units") * wide(F.coalesce(cost, F.lit(0)) if cost is not None else F.lit(0))).alias("cost"),
        F.sum("price_sum").alias("known_sum"),
        F.sum(((F.col("rows") - F.col("priced")) * mean).cast("decimal(28,8)")).alias("filled_sum"),
        F.sum(F.when(mean.isNotNull(), F.col("rows")).otherwise(F.col("priced"))).alias("mean_rows"))


def _close(parts: DataFrame) -> DataFrame:
    """Sales and margin in cents. The mean of all is taken over the report's
    own rows (its groups, not the fact's)."""
    w = Window.partitionBy()

    def all_of(name: str) -> Column:
        return F.coalesce(F.sum(name).over(w).cast("double"), F.lit(0.0))
    overall = F.rint((all_of("known_sum") + all_of("filled_sum")) / F.nullif(all_of("mean_rows"), F.lit(0.0)))
    zero = F.lit(0).cast("decimal(38,0)")
    sales = F.col("sales") + F.coalesce(wide(F.col("open_units")) * wide(overall), zero)
    return parts.withColumn("sales_cents", sales).withColumn(
        "margin_cents", F.col("sales_cents") - F.col("cost"))


def _totals(survivors: DataFrame) -> DataFrame:
    return _close(_summed(_per_sku(survivors)))


def _with_products(survivors: DataFrame, products: DataFrame) -> DataFrame:
    p = products.select(F.col("sku").alias("_p_sku"), "category", "cost_cents")
    per_sku = _per_sku(survivors)
    return per_sku.join(p, per_sku["sku"] == p["_p_sku"], "left")


def order_count(survivors: DataFrame) -> DataFrame:
    """K3."""
    return _summed(_per_sku(survivors)).select(F.coalesce(F.col("orders"), F.lit(0)).cast("bigint").alias("numero_pedidos"))


def total_sales(survivors: DataFrame) -> DataFrame:
    """K1."""
    return _totals(survivors).select(to_money(F.col("sales_cents")).alias("ventas_totales"))


def total_margin(survivors: DataFrame, products: DataFrame) -> DataFrame:
    """K2."""
    parts = _summed(_with_products(survivors, products), cost=F.col("cost_cents"))
    return _close(parts).select(to_money(F.col("margin_cents")).alias("margen_total"))


def average_ticket(survivors: DataFrame) -> DataFrame:
    """K4."""
    orders = F.coalesce(F.col("orders"), F.lit(0)).cast("bigint")
    return _totals(survivors).select(
        to_money(F.col("sales_cents")).alias("ventas_totales"), orders.alias("numero_pedidos"),
        ticket(F.col("sales_cents"), orders).alias("ticket_promedio"))


def _panel(totals: DataFrame, *more: Column) -> DataFrame:
    sales = F.when(F.col("priced") > 0, F.col("sales_cents"))
    orders = F.coalesce(F.col("orders"), F.lit(0)).cast("bigint")
    return totals.select(to_money(sales).alias("ventas_totales"), orders.alias("num_pedidos"),
                         ticket(sales, orders).alias("ticket_promedio"), *more)


def panel(survivors: DataFrame) -> DataFrame:
    """K5: no coalesce, so without any price sales are NULL."""
    return _panel(_totals(survivors))


def panel_display(survivors: DataFrame, products: DataFrame) -> DataFrame:
    """The four panel figures with NULL shown as 0, in the same pass."""
    closed = _close(_summed(_with_products(survivors, products), cost=F.col("cost_cents")))
    shown = _panel(closed, to_money(F.col("margin_cents")).alias("margen"))
    return shown.select(*[F.coalesce(F.col(c), F.lit(0)).cast(t).alias(c) for c, t in (
        ("ventas_totales", "double"), ("margen", "double"), ("num_pedidos", "bigint"),
        ("ticket_promedio", "double"))])


def by_month(survivors: DataFrame) -> DataFrame:
    """G1."""
    months = survivors if "mes" in survivors.columns else with_month(survivors)
    return _close(_summed(_per_sku(months, ["mes"]), ["mes"])).select(
        "mes", to_money(F.col("sales_cents")).alias("ventas"), F.col("orders").alias("pedidos")).orderBy(
        F.col("mes").asc_nulls_first())


def by_channel(survivors: DataFrame) -> DataFrame:
    """Ticket per line."""
    channels = survivors if "canal" in survivors.columns else with_channel(survivors)
    return _close(_summed(_per_sku(channels, ["canal"]), ["canal"])).select(
        "canal", to_money(F.col("sales_cents")).alias("ventas"), F.col("orders").alias("pedidos"),
        ticket(F.col("sales_cents"), F.col("rows")).alias("ticket_promedio")).orderBy(
        F.col("ventas").desc(), F.col("canal").asc_nulls_first())


def by_category(survivors: DataFrame, products: DataFrame) -> DataFrame:
    """Grouped on the raw category, labelled after grouping."""
    parts = _summed(_with_products(survivors, products), ["category"], F.col("cost_cents"))
    return _close(parts).select(
        F.coalesce(F.col("category"), F.lit(NO_CATEGORY_LABEL)).alias("categoria"),
        to_money(F.col("sales_cents")).alias("ventas"), to_money(F.col("margin_cents")).alias("margen"),
        pct_one_decimal(F.col("margin_cents"), F.col("sales_cents")).alias("pct_margen")).orderBy(
        F.col("margen").desc(), F.col("categoria").asc_nulls_first())


def top_products(survivors: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """Top-k products by revenue (inner join), ties broken by sku. Only
    the per-sku sums are written, for the mean of all skus."""
    per_sku = materialize(_per_sku(survivors))
    overall = per_sku.agg(global_mean().alias("mean")).scalar()
    zero = F.lit(0).cast("decimal(38,0)")
    filled = wide(F.col("unpriced_units")) * wide(F.rint(F.coalesce(F.col("sku_mean"), overall)))
    sums = per_sku.select("sku", "units", (F.coalesce(F.col("known_sales"), zero) + F.coalesce(filled, zero)).alias("sales_cents"))
    p = products.select(F.col("sku").alias("_p_sku"), "category", "cost_cents")
    joined = sums.join(p, sums["sku"] == p["_p_sku"], "inner")
    margin = F.col("sales_cents") - wide(F.col("units")) * F.coalesce(F.col("cost_cents"), F.lit(0))
    return joined.select(
        "sku", F.coalesce(F.col("category"), F.lit(NO_CATEGORY_LABEL)).alias("categoria"),
        F.col("units").cast("bigint").alias("unidades_vendidas"), to_money(F.col("sales_cents")).alias("ingresos"),
        to_money(margin).alias("margen"), to_money(F.col("cost_cents")).alias("costo_unitario")).orderBy(
        F.col("ingresos").desc(), F.col("sku").asc()).limit(k)


_CUSTOMER_SET, _SKU_SET = 1, 6  # grouping_id of the two sets below


def top_customers(survivors: DataFrame, customers: DataFrame, k: int = 10) -> DataFrame:
    """Top-k customers by revenue (inner join), ties broken by id.

    A customer's sales are its known sales plus, for each sku it bought
    without a price, the units times the sku's rounded mean. One pass sums
    the fact per (customer, sku without price) and per sku; only these sums
    are written, and the customers' are added up before the join."""
    unpriced, units = F.col("price_cents").isNull(), wide(F.col("quantity"))
    rows = survivors.withColumn("open", F.when(unpriced, F.struct(F.col("sku").alias("sku"))))
    sums = materialize(rows.groupingSets([["customer_id", "open"], ["sku"]], "customer_id", "open", "sku").agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("rows"), F.count("price_cents").alias("priced"),
        F.count("order_id").alias("orders"), F.sum(exact_price(survivors)).alias("price_sum"),
        F.sum(F.when(unpriced, units)).alias("open_units"),
        F.sum(wide(F.col("quantity").cast("bigint") * F.rint("price_cents").cast("bigint"))).alias("known_sales")))
    stats = sums.filter(F.col("gid") == _SKU_SET).select("sku", "rows", "priced", "price_sum").withColumn(
        "sku_mean", F.when(F.col("sku").isNotNull(), F.col("price_sum").cast("double") / F.nullif(F.col("priced"), F.lit(0))))
    overall = stats.agg(global_mean().alias("mean")).scalar()
    means = stats.filter(F.col("sku_mean").isNotNull()).select(F.col("sku").alias("_m_sku"), F.col("sku_mean"))
    bought = sums.filter(F.col("gid") == _CUSTOMER_SET).join(means, F.col("open.sku") == F.col("_m_sku"), "left")
    zero = F.lit(0).cast("decimal(38,0)")
    filled = wide(F.col("open_units")) * wide(F.rint(F.coalesce(F.col("sku_mean"), overall)))
    per_customer = bought.groupBy("customer_id").agg(
        F.sum(F.coalesce(F.col("known_sales"), zero) + F.coalesce(filled, zero)).alias("sales_cents"), F.sum("orders").alias("pedidos"))
    c = customers.select(F.col("customer_id").alias("_c_id"), "name", "country", "segment")
    joined = per_customer.join(c, per_customer["customer_id"] == c["_c_id"], "inner")
    return joined.select(
        "customer_id", F.col("name").alias("cliente"), F.col("country").alias("pais"), F.col("segment").alias("segmento"),
        to_money(F.col("sales_cents")).alias("ingresos"), "pedidos", ticket(F.col("sales_cents"), F.col("pedidos")).alias("ticket_promedio")).orderBy(
        F.col("ingresos").desc(), F.col("customer_id").asc()).limit(k)
