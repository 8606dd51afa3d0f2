"""The batch run (E1): snapshot -> scan -> profile -> clean -> publish
(checked) -> export -> validate, as Spark jobs.

Nothing row-level reaches the driver: the only collected results are
one-row counters for the run summary.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.operators.kpis import kpi_panel, kpi_total_margin
from starledger.operators.profile import profile_counters
from starledger.plans.id_index import IdIndex, index_published, open_index
from starledger.plans.intake_job import appended_orders, fact_with_appends
from starledger.plans.model import (
    CleanModel, clean_model, load_counts, orders_enriched, present_orders, present_products,
)
from starledger.sources.fixtures import RawTables
from starledger.sources.sinks import current_run, export_csv, publish, read_published, snapshot_raw


@dataclass
class RunSummary:
    run_id: str
    profile: dict = field(default_factory=dict)
    counts: dict = field(default_factory=dict)
    kpis: dict = field(default_factory=dict)


def published_model(spark: SparkSession, out_dir: str, intake_dir: str | None = None) -> CleanModel:
    """The published tables; with ``intake_dir`` the fact includes the orders
    accepted there, so every KPI and serving query sees them."""
    t = read_published(spark, out_dir)
    orders = fact_with_appends(spark, t["orders"], intake_dir) if intake_dir else t["orders"]
    return CleanModel(t["customers"], t["products"], orders)


def published_index(spark: SparkSession, out_dir: str, intake_dir: str | None = None) -> IdIndex:
    """The id index of the latest published run, built on first use: its ids
    and those of the intake batches accepted so far. Intake jobs given this
    index read only the buckets of their ids."""
    folder = f"{out_dir.rstrip('/')}/_ids/run={quote(current_run(spark, out_dir), safe='')}"
    try:
        return open_index(spark, folder)
    except FileNotFoundError:
        appended = appended_orders(spark, intake_dir) if intake_dir else None
        return index_published(spark, read_published(spark, out_dir)["orders"], folder, current_run(spark, out_dir), appended)


def register_views(spark: SparkSession, model: CleanModel) -> None:
    """Temp views of the published tables plus ``v_orders_enriched``."""
    model.customers.createOrReplaceTempView("customers")
    model.products.createOrReplaceTempView("products")
    model.orders.createOrReplaceTempView("orders_fact")
    orders_enriched(model.orders, model.customers, model.products).createOrReplaceTempView(
        "v_orders_enriched")


def validate_published(model) -> DataFrame:
    """Post-load validation (one row): table counts, sales, orders, ticket,
    margin. One-row results are combined by a union and a ``max`` per
    column (branches run in one job)."""
    names = ["customers", "products", "orders", "ventas_totales", "num_pedidos", "ticket_promedio",
             "margen_total"]
    parts = [
        model.customers.agg(F.count(F.lit(1)).alias("customers")),
        model.products.agg(F.count(F.lit(1)).alias("products")),
        model.orders.agg(F.count(F.lit(1)).alias("orders")),
        kpi_panel(model.orders),
        kpi_total_margin(model.orders, model.products),
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged.agg(*[F.max(n).alias(n) for n in names])


def run(spark: SparkSession, raw: RawTables, out_dir: str, run_id: str,
        archive: bool = True, export: bool = True) -> RunSummary:
    """Run the whole pipeline for one set of raw tables."""
    out = out_dir.rstrip("/")
    tables = {"customers": raw.customers, "products": raw.products, "orders": raw.orders}
    if archive:
        snapshot_raw(raw.text or tables, f"{out}/archive", run_id)
    summary = RunSummary(run_id)
    summary.profile = profile_counters(raw.customers, raw.products, raw.orders).first().asDict()
    model = clean_model(raw)
    clean = {"customers": model.customers, "products": model.products, "orders": model.orders}
    publish(spark, clean, f"{out}/warehouse", run_id)
    published = published_model(spark, f"{out}/warehouse")
    if export:  # what was checked and published, never what failed the checks
        export_csv({"customers": published.customers, "products": present_products(published.products),
                    "orders": present_orders(published.orders)}, f"{out}/processed")
    register_views(spark, published)
    summary.counts = {r["tabla"]: r["registros"] for r in load_counts(published).collect()}
    summary.kpis = validate_published(published).first().asDict()
    return summary
