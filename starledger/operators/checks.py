"""Table constraints as a check job (V1-V4).

One output row per (tabla, regla, violaciones, fatal). Each table is read in
one pass: NOT NULL and CHECK counters ride on a partially aggregated group-by
of the primary key, and a table's foreign keys are further grouping sets of the
same group-by, looked up in the dimensions' keys. CHECK follows SQL: a NULL
operand does not violate it. Foreign keys are reported, not fatal, and a NULL
foreign key is allowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.operators.joins import broadcast_if_small

# The declared constraints of the published tables.
NOT_NULL = {
    "customers": ["name", "country", "segment", "created_at"],
    "products": ["category", "cost_cents", "active"],
    "orders": ["customer_id", "sku", "quantity", "price_cents", "order_date", "channel"],
}
CHECKS = {
    "products": ["cost_cents >= 0"],
    "orders": ["quantity > 0", "price_cents > 0"],
}
PRIMARY_KEYS = {"customers": "customer_id", "products": "sku", "orders": "order_id"}
FOREIGN_KEYS = [("orders", "customer_id", "customers"), ("orders", "sku", "products")]


def _checks_only(name: str) -> list:
    return [(label, F.expr(label)) for label in CHECKS.get(name, [])]


def table_violations(df: DataFrame, name: str, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """V1-V4 for one table in one pass.

    Rows are grouped by the primary key with every NOT NULL / CHECK counter
    carried along (map-side partial aggregation), then summed. Key
    duplicates are ``sum(rows - 1)`` over non-NULL keys: like the reference's
    SQL store, a NULL key is not a duplicate. Of each foreign key whose parent
    is among ``parents``, a grouping set counts the rows per value; those
    counts, not the rows, meet the parents' keys (broadcast when they fit),
    and counts of non-NULL values without a parent are violations."""
    key = PRIMARY_KEYS[name]
    foreign = [(column, parent) for child, column, parent in FOREIGN_KEYS if child == name and parent in (parents or {})]
    keys = [key, *[column for column, _ in foreign]]
    counters = [(f"not null {c}", F.col(c).isNull()) for c in NOT_NULL.get(name, [])]
    counters += [(f"check {label}", ~F.coalesce(cond, F.lit(True))) for label, cond in _checks_only(name)]
    flagged = df.select(*keys, *[F.when(cond, 1).otherwise(0).alias(f"_c{i}") for i, (_, cond) in enumerate(counters)])
    sets = flagged.groupingSets([[k] for k in keys], *keys).agg(
        F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("_n"), *[F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(counters))])
    every = (1 << len(keys)) - 1  # grouping_id has a bit for each column that is not in the set
    gid = [every ^ (1 << (len(keys) - 1 - i)) for i in range(len(keys))]
    # The primary key's groups become one row; one row per foreign key value stays.
    value = F.lit(None).cast("string")
    for i, (column, _) in enumerate(foreign, 1):
        value = F.when(F.col("_gid") == gid[i], F.col(column).cast("string")).otherwise(value)
    extra = F.when(F.col(key).isNotNull(), F.col("_n") - 1)
    small = sets.groupBy("_gid", value.alias("_value")).agg(
        F.sum("_n").alias("_n"), F.sum(extra).alias("_extra"), *[F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(counters))])
    own = F.col("_gid") == gid[0]
    sums = [F.sum(F.when(own, F.col(f"_c{i}"))).alias(label) for i, (label, _) in enumerate(counters)]
    sums.append(F.sum(F.when(own, F.col("_extra"))).alias(f"primary key {key}"))
    labels = [label for label, _ in counters] + [f"primary key {key}"]
    known = None
    for i, (column, parent) in enumerate(foreign, 1):
        pk = F.col(PRIMARY_KEYS[parent])
        part = parents[parent].filter(pk.isNotNull()).select(F.lit(gid[i]).cast("bigint").alias("_kgid"), pk.cast("string").alias("_known")).distinct()
        known = part if known is None else known.unionByName(part)
        labels.append(f"foreign key {column} -> {parent}")
        sums.append(F.sum(F.when((F.col("_gid") == gid[i]) & F.col("_value").isNotNull() & F.col("_known").isNull(), F.col("_n"))).alias(labels[-1]))
    if known is not None:
        small = small.join(broadcast_if_small(known), (F.col("_gid") == F.col("_kgid")) & (F.col("_value") == F.col("_known")), "left")
    return small.agg(*sums).unpivot([], labels, "regla", "violaciones").select(
        F.lit(name).alias("tabla"), "regla",
        F.coalesce(F.col("violaciones"), F.lit(0)).cast("bigint").alias("violaciones"),
        (~F.startswith(F.col("regla"), F.lit("foreign key"))).alias("fatal"))


def constraint_violations(customers: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """V1-V4 over the three tables to publish."""
    tables = {"customers": customers, "products": products, "orders": orders}
    out = None
    for name, df in tables.items():
        part = table_violations(df, name, tables)
        out = part if out is None else out.unionByName(part)
    return out
