"""The clean star model, the enriched order view (S7) and load counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.functions.money import to_money
from starledger.operators.joins import broadcast_if_small
from starledger.operators.clean import (
    clean_customers, clean_orders, clean_products, order_survivors, unpriced_orders,
)
from starledger.sources.fixtures import RawTables


@dataclass
class CleanModel:
    customers: DataFrame   # customer_id, name, country, segment, created_at
    products: DataFrame    # sku, category, cost_cents, active
    orders: DataFrame      # order_id, customer_id, sku, quantity, price_cents, order_date, channel


class LazyCleanModel:
    """The clean model, each table built on first use (cleaning the orders
    writes their survivors once, so it is not done for queries that only
    need a dimension)."""

    def __init__(self, raw: RawTables, order_cols=("seq",)):
        self._raw, self._order_cols, self._built = raw, order_cols, {}

    def _get(self, name, build):
        if name not in self._built:
            self._built[name] = build(getattr(self._raw, name), self._order_cols)
        return self._built[name]

    @property
    def customers(self) -> DataFrame:
        return self._get("customers", clean_customers)

    @property
    def products(self) -> DataFrame:
        return self._get("products", clean_products)

    @property
    def orders(self) -> DataFrame:
        return self._get("orders", clean_orders)

    def priced_orders(self, *columns: str) -> DataFrame:
        """Only these columns of the clean orders."""
        return clean_orders(self._raw.orders, self._order_cols, columns=columns)

    @property
    def unpriced_orders(self) -> DataFrame:
        return unpriced_orders(self._raw.orders, self._order_cols)

    @property
    def survivors(self) -> DataFrame:
        return order_survivors(self._raw.orders, self._order_cols)


def clean_model(raw: RawTables, order_cols=("seq",)) -> LazyCleanModel:
    return LazyCleanModel(raw, order_cols)


def present_orders(orders: DataFrame) -> DataFrame:
    """Clean orders with money in currency units (unit_price)."""
    return orders.select("order_id", "customer_id", "sku", "quantity",
                         to_money(F.col("price_cents")).alias("unit_price"),
                         "order_date", "channel")


def present_products(products: DataFrame) -> DataFrame:
    return products.select("sku", "category", to_money(F.col("cost_cents")).alias("cost"), "active")


def orders_enriched(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Every order with its customer and product (LEFT joins), revenue
    and margin per line (margin NULL when the product is unknown).

    A dimension is broadcast only when its exact size is under the broadcast
    threshold (``broadcast_if_small``), so the fact is not shuffled for it;
    otherwise the planner sort-merges with AQE splitting skewed partitions.
    """
    c = broadcast_if_small(customers.select(F.col("customer_id").alias("_c_id"),
                                            F.col("name").alias("customer_name"), "country", "segment"))
    p = broadcast_if_small(products.select(F.col("sku").alias("_p_sku"), "category",
                                           F.col("cost_cents").alias("_cost"),
                                           F.col("active").alias("product_active")))
    j = (orders.join(c, orders["customer_id"] == c["_c_id"], "left")
               .join(p, orders["sku"] == p["_p_sku"], "left"))
    q = F.col("quantity").cast("bigint")
    return j.select(
        "order_id", "customer_id", "customer_name", "country", "segment", "sku", "category",
        to_money(F.col("_cost")).alias("product_cost"), "product_active", "quantity",
        to_money(F.col("price_cents")).alias("unit_price"),
        to_money(q * F.col("price_cents")).alias("revenue"),
        to_money(q * (F.col("price_cents") - F.col("_cost"))).alias("margin"),
        "order_date", "channel")


def load_counts(model: CleanModel) -> DataFrame:
    """Tabla, registros for the three published tables."""
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).cast("bigint").alias("registros")).select(
            F.lit(name).alias("tabla"), "registros")
    return one(model.customers, "customers").unionByName(
        one(model.products, "products")).unionByName(one(model.orders, "orders"))
