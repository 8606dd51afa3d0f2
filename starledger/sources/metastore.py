"""Named tables and the enriched view in the session catalogue.

A run's tables are saved as ``<table>__<run>_<attempt>``, so no attempt writes
where the views point. After the constraint checks on
what was written, the views ``customers``, ``products``, ``orders_fact`` and
``v_orders_enriched`` are pointed at them; each is replaced in one step, so a
reader sees the old run or the new one. If a check fails the run's tables are
dropped and the views stay as they were. Any session of the application
(with a shared metastore: of any application) reads them by name.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.operators.checks import constraint_violations
from starledger.sources.sinks import TABLES, ConstraintError

VIEW_OF = {"customers": "customers", "products": "products", "orders": "orders_fact"}

ENRICHED = """
SELECT o.order_id, o.customer_id, c.name AS customer_name, c.country, c.segment, o.sku, p.category,
       CAST(p.cost_cents AS DOUBLE) / 100.0D AS product_cost, p.active AS product_active, o.quantity,
       CAST(o.price_cents AS DOUBLE) / 100.0D AS unit_price,
       CAST(CAST(o.quantity AS BIGINT) * o.price_cents AS DOUBLE) / 100.0D AS revenue,
       CAST(CAST(o.quantity AS BIGINT) * (o.price_cents - p.cost_cents) AS DOUBLE) / 100.0D AS margin,
       o.order_date, o.channel
FROM {orders} AS o LEFT JOIN {customers} AS c ON o.customer_id = c.customer_id LEFT JOIN {products} AS p ON o.sku = p.sku"""


def _tag(run_id: str) -> str:
    """A run id, made fit for a table's name, and a new attempt."""
    return re.sub(r"[^a-z0-9]", "_", run_id.lower()) + "_" + uuid.uuid4().hex[:8]


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = "" if location is None else " LOCATION '" + location.replace("'", r"\'") + "'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def publish_tables(spark: SparkSession, tables: dict[str, DataFrame], database: str, run_id: str) -> DataFrame:
    """S6 + S7: save the clean tables as run ``run_id``, check them, and point
    the views at them. Returns the violations table of the saved run."""
    tag = _tag(run_id)
    names = {name: f"`{database}`.`{name}__{tag}`" for name in TABLES}
    for name in TABLES:
        tables[name].write.mode("overwrite").format("parquet").saveAsTable(names[name])
    violations = constraint_violations(*[spark.table(names[n]) for n in TABLES])
    failed = violations.filter(F.col("fatal") & (F.col("violaciones") > 0)).collect()
    if failed:
        for name in TABLES:
            spark.sql(f"DROP TABLE IF EXISTS {names[name]}")
        rules = ", ".join(f"{r['tabla']}: {r['regla']} ({r['violaciones']})" for r in failed)
        raise ConstraintError(f"run {run_id} not published, constraint violations: {rules}")
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.v_orders_enriched AS {ENRICHED.format(**names)}")
    for name, view in VIEW_OF.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{view}` AS SELECT * FROM {names[name]}")
    return violations


def current_tag(spark: SparkSession, database: str) -> str | None:
    """The run and attempt that the views show; None before the first."""
    if not spark.catalog.tableExists(f"`{database}`.`orders_fact`"):
        return None
    text = spark.sql(f"SHOW CREATE TABLE `{database}`.`orders_fact`").first()[0]
    found = re.search(r"orders__([a-z0-9_]+)", text)
    return found.group(1) if found else None


def drop_old_runs(spark: SparkSession, database: str) -> list[str]:
    """Drop the tables of every attempt but the one that the views show."""
    current, dropped = current_tag(spark, database), []
    for row in spark.sql(f"SHOW TABLES IN `{database}`").collect():
        name, _, tag = row["tableName"].partition("__")
        if name in TABLES and tag and current is not None and tag != current:
            spark.sql(f"DROP TABLE `{database}`.`{row['tableName']}`")
            dropped.append(row["tableName"])
    return sorted(dropped)
