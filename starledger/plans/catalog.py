"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

Raw tables come from the driver's parquet files (``sources.fixtures``); the
clean model is derived from them in the same plan, so every query's work
grows with the input tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.functions.money import to_money
from starledger.functions.text import blank_to_null, normalize_channel
from starledger.operators import clean as C
from starledger.operators import kpis as K
from starledger.operators import totals as S
from starledger.plans import model as M
from starledger.plans import refresh as R
from starledger.session import materialize, scratch_path
from starledger.sources.fixtures import RawTables, customers_raw, orders_raw_to_write, products_raw, raw_tables

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn
    return register


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _model(spark: SparkSession, sf_dir: str) -> M.LazyCleanModel:
    return M.clean_model(raw_tables(spark, sf_dir))


def _written_raw(spark: SparkSession, sf_dir: str) -> RawTables:
    """The raw tables, the orders written once: for queries that read them more
    than once."""
    return RawTables(customers_raw(spark, sf_dir), products_raw(spark, sf_dir),
                     materialize(orders_raw_to_write(spark, sf_dir)))


# ---------------------------------------------------------------- cleaning
@query("clean_customers")
def q_clean_customers(spark, sf_dir):
    return _model(spark, sf_dir).customers


@query("clean_products")
def q_clean_products(spark, sf_dir):
    return M.present_products(_model(spark, sf_dir).products)


@query("clean_orders")
def q_clean_orders(spark, sf_dir):
    return M.present_orders(_model(spark, sf_dir).orders)


@query("dedup_customers")
def q_dedup_customers(spark, sf_dir):
    return C.dedup_customers(raw_tables(spark, sf_dir).customers)


@query("dedup_products")
def q_dedup_products(spark, sf_dir):
    return C.dedup_products(raw_tables(spark, sf_dir).products)


@query("dedup_orders")
def q_dedup_orders(spark, sf_dir):
    return C.dedup_orders(raw_tables(spark, sf_dir).orders)


@query("valid_dates")
def q_valid_dates(spark, sf_dir):
    return C.valid_dates(C.dedup_orders(raw_tables(spark, sf_dir).orders)).drop("seq")


@query("valid_quantity")
def q_valid_quantity(spark, sf_dir):
    return C.valid_quantity(C.valid_dates(C.dedup_orders(raw_tables(spark, sf_dir).orders))).drop("seq")


def _survivors(spark, sf_dir):
    return C.order_survivors(raw_tables(spark, sf_dir).orders)


@query("impute_sku_mean")
def q_impute_sku_mean(spark, sf_dir):
    """Per sku with a missing price among the survivors: rows without a
    price, rows with one, and the sku mean (currency units, unrounded)."""
    stats = C.sku_price_stats(_survivors(spark, sf_dir)).filter(F.col("rows") > F.col("priced"))
    keyed = F.col("sku").isNotNull()
    return stats.select(
        "sku", (F.col("rows") - F.col("priced")).alias("filas_sin_precio"),
        F.when(keyed, F.col("priced")).otherwise(F.lit(0)).alias("filas_con_precio"),
        F.when(keyed, F.col("sku_mean") / F.lit(100.0)).alias("precio_medio"))


@query("impute_global_mean")
def q_impute_global_mean(spark, sf_dir):
    """Rows that fall back to the global mean and the price they get."""
    stats = C.sku_price_stats(_survivors(spark, sf_dir))
    no_history = (F.col("priced") == 0) | F.col("sku").isNull()
    one = stats.agg(
        F.coalesce(F.sum(F.when(no_history, F.col("rows") - F.col("priced"))), F.lit(0)).cast("bigint")
         .alias("filas_precio_global"),
        C.global_mean().alias("_mean"))
    return one.select("filas_precio_global", F.when(
        F.col("filas_precio_global") > 0, to_money(F.rint("_mean").cast("bigint"))).alias("precio_global"))


@query("normalize_channel")
def q_normalize_channel(spark, sf_dir):
    """Raw channel label -> normalised label, with row counts."""
    o = raw_tables(spark, sf_dir).orders
    return o.groupBy(F.col("channel").alias("canal_original")).agg(
        F.count(F.lit(1)).cast("bigint").alias("filas")).select(
        "canal_original", normalize_channel(F.col("canal_original")).alias("canal_normalizado"), "filas")


@query("clean_audit")
def q_clean_audit(spark, sf_dir):
    r = raw_tables(spark, sf_dir)
    return C.clean_audit(r.customers, r.products, r.orders)


def _csv_roundtrip(spark, name, df):
    """Export a clean table as header CSV to a new folder below the shared
    checkpoint folder, read it back with its schema and return it."""
    from starledger.sources.sinks import export_csv
    path = scratch_path(spark, f"csv_roundtrip/{uuid.uuid4().hex}")
    export_csv({name: df}, path)
    return (spark.read.schema(df.schema).option("header", True).option("dateFormat", "yyyy-MM-dd")
            .option("escape", '"').csv(f"{path}/{name}_clean"))


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    return _csv_roundtrip(spark, "orders", M.present_orders(_model(spark, sf_dir).orders))


@query("csv_roundtrip_customers")
def q_csv_roundtrip_customers(spark, sf_dir):
    return _csv_roundtrip(spark, "customers", _model(spark, sf_dir).customers)


@query("csv_roundtrip_products")
def q_csv_roundtrip_products(spark, sf_dir):
    return _csv_roundtrip(spark, "products", M.present_products(_model(spark, sf_dir).products))


# Fixed value: rows of one compressed source file (a task numbers its files with
# three digits, so that their paths are in order up to 1,000 of them).
CSV_FILE_ROWS = 100_000


@query("csv_clean_orders")
def q_csv_clean_orders(spark, sf_dir):
    """The raw orders as a source file (text, prices in tenths of a cent),
    scanned from CSV and cleaned: only C14 rounds, half-even."""
    from starledger.schemas import ORDERS_CSV
    from starledger.sources.csv import read_text_csv, typed_orders
    o = orders_raw_to_write(spark, sf_dir)
    tenths = F.col("price_cents") * 10 + F.substring("order_id", 2, 20).cast("bigint") % 10
    price = F.concat(F.call_function("div", tenths, F.lit(1000)).cast("string"), F.lit("."),
                     F.lpad((tenths % 1000).cast("string"), 3, "0"))
    # an id's copies share a partition of the raw orders: file order keeps their order
    rows = o.withColumn("unit_price", price).sortWithinPartitions("order_id", "seq").select(
        *[F.col(f.name).cast("string").alias(f.name) for f in ORDERS_CSV.fields])
    path = scratch_path(spark, f"csv_clean_orders/{uuid.uuid4().hex}")
    # a gzip file is not split: short ones keep the reading tasks small
    (rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).option("compression", "gzip")
         .option("maxRecordsPerFile", CSV_FILE_ROWS).csv(path))
    return M.present_orders(C.clean_orders(typed_orders(read_text_csv(spark, path, ORDERS_CSV, number_files=True))))


# ------------------------------------------------------------------- model
@query("orders_enriched")
def q_orders_enriched(spark, sf_dir):
    m = _model(spark, sf_dir)
    return M.orders_enriched(m.orders, m.customers, m.products)


@query("load_counts")
def q_load_counts(spark, sf_dir):
    m = _model(spark, sf_dir)
    return M.load_counts(M.CleanModel(m.customers, m.products, m.unpriced_orders))


# -------------------------------------------------------------------- KPIs
@query("kpi_total_sales")
def q_k1(spark, sf_dir):
    return S.total_sales(_model(spark, sf_dir).survivors)


@query("kpi_total_margin")
def q_k2(spark, sf_dir):
    m = _model(spark, sf_dir)
    return S.total_margin(m.survivors, m.products)


@query("kpi_order_count")
def q_k3(spark, sf_dir):
    return K.kpi_order_count(_model(spark, sf_dir).unpriced_orders)


@query("kpi_avg_ticket")
def q_k4(spark, sf_dir):
    return S.average_ticket(_model(spark, sf_dir).survivors)


@query("kpi_panel")
def q_k5(spark, sf_dir):
    return S.panel(_model(spark, sf_dir).survivors)


@query("sales_by_month")
def q_g1(spark, sf_dir):
    return S.by_month(_model(spark, sf_dir).survivors)


@query("sales_by_channel")
def q_g2(spark, sf_dir):
    return S.by_channel(_model(spark, sf_dir).survivors)


@query("margin_by_category")
def q_g3(spark, sf_dir):
    m = _model(spark, sf_dir)
    return S.by_category(m.survivors, m.products)


@query("top_customers")
def q_g4(spark, sf_dir):
    m = _model(spark, sf_dir)
    return S.top_customers(m.survivors, m.customers)


@query("top_products")
def q_g5(spark, sf_dir):
    m = _model(spark, sf_dir)
    return S.top_products(m.survivors, m.products)


@query("dim_channels")
def q_d1(spark, sf_dir):
    return K.dim_channels(_model(spark, sf_dir).unpriced_orders)


@query("dim_categories")
def q_d2(spark, sf_dir):
    return K.dim_categories(_model(spark, sf_dir).products)


@query("dim_countries")
def q_d3(spark, sf_dir):
    return K.dim_countries(_model(spark, sf_dir).customers)


@query("dim_date_range")
def q_d4(spark, sf_dir):
    return K.dim_date_range(_model(spark, sf_dir).unpriced_orders)


# ----------------------------------------------------------------- refresh
def _arrived(spark, sf_dir):
    """The raw orders as three files that arrive one after the other (an
    order id's copies in different files), taken into a new state; the
    states of the first two are merged before the third arrives."""
    raw = _written_raw(spark, sf_dir).orders
    state = scratch_path(spark, f"refresh/{uuid.uuid4().hex}")
    arrival = (F.substring("order_id", 2, 20).cast("bigint") + F.col("seq")) % 3
    for i in range(3):
        if i == 2:
            R.compact(spark, state)
        R.arrive(spark, raw.filter(arrival == i), state, f"file-{i}")
    return state


@query("refreshed_orders")
def q_refreshed_orders(spark, sf_dir):
    return M.present_orders(R.refreshed_orders(spark, _arrived(spark, sf_dir)))


@query("refreshed_kpis")
def q_refreshed_kpis(spark, sf_dir):
    """K1-K5 from the stored states (added up by sku once, for all five), one row."""
    state = materialize(S.merge_sums(R.totals_state(spark, _arrived(spark, sf_dir))))
    products = _model(spark, sf_dir).products
    parts = [S.total_sales(state), S.total_margin(state, products), S.order_count(state), S.average_ticket(state).select("ticket_promedio"),
             S.panel(state).select(F.col("ventas_totales").alias("panel_ventas"), F.col("num_pedidos").alias("panel_pedidos"),
                                   F.col("ticket_promedio").alias("panel_ticket"))]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


@query("refreshed_by_month")
def q_refreshed_by_month(spark, sf_dir):
    return S.by_month(R.totals_state(spark, _arrived(spark, sf_dir)))


@query("refreshed_by_channel")
def q_refreshed_by_channel(spark, sf_dir):
    return S.by_channel(R.totals_state(spark, _arrived(spark, sf_dir)))


@query("refreshed_by_category")
def q_refreshed_by_category(spark, sf_dir):
    return S.by_category(R.totals_state(spark, _arrived(spark, sf_dir)), _model(spark, sf_dir).products)


# ----------------------------------------------------------------- profile
from starledger.operators import profile as P  # noqa: E402

RAW_NUMERIC = {"orders": ["quantity", "price_cents"], "products": ["cost_cents"]}
CUSTOMER_TEXT = ["customer_id", "name", "country", "segment", "created_at"]
VALUE_COUNT_COLS = {"customers": ["country", "segment"], "products": ["category", "active"],
                    "orders": ["channel"]}


def _raw_by_name(spark, sf_dir):
    r = raw_tables(spark, sf_dir)
    return {"customers": r.customers, "products": r.products, "orders": r.orders}


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query("scan_shape")
def q_scan_shape(spark, sf_dir):
    return P.scan_shape(_raw_by_name(spark, sf_dir))


@query("profile_nulls")
def q_profile_nulls(spark, sf_dir):
    return _union([P.null_profile(_shown(df), t) for t, df in _raw_by_name(spark, sf_dir).items()])


MONEY_NAMES = {"price_cents": "unit_price", "cost_cents": "cost"}


def _shown(df):
    """A raw table with money in currency units under the source's names."""
    return df.select(*[to_money(F.col(c)).alias(MONEY_NAMES[c]) if c in MONEY_NAMES else F.col(c) for c in df.columns])


@query("profile_info")
def q_profile_info(spark, sf_dir):
    return _union([P.info(_shown(df), t) for t, df in _raw_by_name(spark, sf_dir).items()])


@query("profile_null_rows")
def q_profile_null_rows(spark, sf_dir):
    return P.null_rows(_shown(raw_tables(spark, sf_dir).orders), "unit_price",
                       ["order_id", "customer_id", "sku", "quantity", "unit_price", "order_date"])


@query("profile_null_country_rows")
def q_profile_null_country_rows(spark, sf_dir):
    return P.null_rows(raw_tables(spark, sf_dir).customers, "country")


@query("profile_null_segment_rows")
def q_profile_null_segment_rows(spark, sf_dir):
    return P.null_rows(raw_tables(spark, sf_dir).customers, "segment")


@query("profile_null_category_rows")
def q_profile_null_category_rows(spark, sf_dir):
    return P.null_rows(_shown(raw_tables(spark, sf_dir).products), "category")


@query("profile_dup_customer_rows")
def q_profile_dup_customer_rows(spark, sf_dir):
    return P.duplicate_rows(raw_tables(spark, sf_dir).customers, "customer_id")


@query("profile_dup_product_rows")
def q_profile_dup_product_rows(spark, sf_dir):
    return P.duplicate_rows(_shown(raw_tables(spark, sf_dir).products), "sku")


@query("profile_bad_created_rows")
def q_profile_bad_created_rows(spark, sf_dir):
    return P.bad_date_rows(raw_tables(spark, sf_dir).customers, "created_at")


@query("profile_bad_created_dirty")
def q_profile_bad_created_dirty(spark, sf_dir):
    """P6 on customers with impossible creation dates (their own would stop
    the cleaning): every 37th customer's month becomes 13."""
    c = raw_tables(spark, sf_dir).customers
    dirty = F.when(F.col("customer_id") % 37 == 5, F.concat(F.substring("created_at", 1, 5), F.lit("13"), F.substring("created_at", 8, 3)))
    return P.bad_date_rows(c.withColumn("created_at", F.coalesce(dirty, F.col("created_at"))), "created_at")


@query("profile_negative_quantity_rows")
def q_profile_negative_quantity_rows(spark, sf_dir):
    return _shown(raw_tables(spark, sf_dir).orders).filter(F.col("quantity") < 0)


@query("profile_head_customers")
def q_profile_head_customers(spark, sf_dir):
    return P.head(raw_tables(spark, sf_dir).customers, ["customer_id", "seq"], 5)


@query("profile_head_products")
def q_profile_head_products(spark, sf_dir):
    return P.head(_shown(raw_tables(spark, sf_dir).products), ["sku", "seq"], 5)


@query("profile_dup_counts")
def q_profile_dup_counts(spark, sf_dir):
    r = raw_tables(spark, sf_dir)
    return _union([P.duplicate_profile(r.customers, "customers", "customer_id"),
                   P.duplicate_profile(r.products, "products", "sku"),
                   P.duplicate_profile(r.orders, "orders", "order_id")])


@query("profile_dup_rows")
def q_profile_dup_rows(spark, sf_dir):
    return P.duplicate_rows(_shown(raw_tables(spark, sf_dir).orders), "order_id")


@query("profile_bad_dates")
def q_profile_bad_dates(spark, sf_dir):
    r = raw_tables(spark, sf_dir)
    return _union([P.bad_date_profile(r.customers, "customers", "created_at"),
                   P.bad_date_profile(r.orders, "orders", "order_date")])


@query("profile_bad_date_rows")
def q_profile_bad_date_rows(spark, sf_dir):
    return P.bad_date_rows(raw_tables(spark, sf_dir).orders, "order_date",
                           ["order_id", "customer_id", "sku", "order_date", "channel"])


@query("profile_date_range")
def q_profile_date_range(spark, sf_dir):
    r = raw_tables(spark, sf_dir)
    return _union([P.date_range(r.customers, "customers", "created_at"),
                   P.date_range(r.orders, "orders", "order_date")])


@query("profile_value_counts")
def q_profile_value_counts(spark, sf_dir):
    raw = _raw_by_name(spark, sf_dir)
    return _union([P.value_counts(raw[t], t, cols) for t, cols in VALUE_COUNT_COLS.items()])


@query("profile_describe_num")
def q_profile_describe_num(spark, sf_dir):
    raw = _raw_by_name(spark, sf_dir)
    return P.in_currency(_union([P.describe_numeric(raw[t], t, cols) for t, cols in RAW_NUMERIC.items()]), MONEY_NAMES)


@query("profile_describe_positive_cost")
def q_profile_describe_positive_cost(spark, sf_dir):
    positive = raw_tables(spark, sf_dir).products.filter(F.col("cost_cents") > 0)
    return P.in_currency(P.describe_numeric(positive, "products", ["cost_cents"]), MONEY_NAMES)


@query("profile_describe_text")
def q_profile_describe_text(spark, sf_dir):
    return P.describe_text(raw_tables(spark, sf_dir).customers, "customers", CUSTOMER_TEXT)


@query("profile_describe_approx")
def q_profile_describe_approx(spark, sf_dir):
    """P9 with the digest: whether each quartile is within the stated rank error."""
    raw = _raw_by_name(spark, sf_dir)
    found = _union([P.approximate_quantiles(raw[t], t, cols) for t, cols in RAW_NUMERIC.items()])
    return found.select("tabla", "campo", "q", "filas", (F.col("error_rango") <= F.col("limite_rango")).alias("dentro_del_limite"))


@query("profile_inferred_types")
def q_profile_inferred_types(spark, sf_dir):
    """P11 over the raw tables as text, as a reader without types sees them."""
    from starledger.operators.infer import infer_types
    shown = {t: _shown(df).drop("seq") for t, df in _raw_by_name(spark, sf_dir).items()}
    return _union([infer_types(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]), t) for t, df in shown.items()])


@query("profile_head")
def q_profile_head(spark, sf_dir):
    return P.head(_shown(raw_tables(spark, sf_dir).orders), ["order_id", "seq"], 5)


@query("profile_negative")
def q_profile_negative(spark, sf_dir):
    r = raw_tables(spark, sf_dir)
    return _union([P.negative_profile(_shown(r.products), "products", "cost"),
                   P.negative_profile(r.orders, "orders", "quantity")])


@query("profile_negative_rows")
def q_profile_negative_rows(spark, sf_dir):
    return _shown(raw_tables(spark, sf_dir).products).filter(F.col("cost") < 0)


@query("profile_zero")
def q_profile_zero(spark, sf_dir):
    return P.zero_profile(raw_tables(spark, sf_dir).orders, "orders", "quantity")


@query("profile_abs_in_range")
def q_profile_abs_in_range(spark, sf_dir):
    return P.abs_in_range(_shown(raw_tables(spark, sf_dir).products), "sku", "cost")


@query("profile_inactive")
def q_profile_inactive(spark, sf_dir):
    return P.inactive_products(raw_tables(spark, sf_dir).products)


@query("orphan_customers")
def q_orphan_customers(spark, sf_dir):
    r = raw_tables(spark, sf_dir)
    return P.orphans(r.orders, r.customers, "customer_id", ["order_id", "customer_id", "sku"])


@query("orphan_skus")
def q_orphan_skus(spark, sf_dir):
    r = raw_tables(spark, sf_dir)
    return P.orphans(r.orders, r.products, "sku", ["order_id", "customer_id", "sku"])


@query("orders_with_inactive")
def q_orders_with_inactive(spark, sf_dir):
    r = raw_tables(spark, sf_dir)
    return P.orders_on_inactive(r.orders, r.products)


@query("price_history_for_nulls")
def q_price_history(spark, sf_dir):
    return P.price_history_for_nulls(raw_tables(spark, sf_dir).orders)


@query("raw_mean_price")
def q_raw_mean_price(spark, sf_dir):
    return P.raw_mean_price(raw_tables(spark, sf_dir).orders)


@query("channel_normalization")
def q_channel_normalization(spark, sf_dir):
    return P.channel_normalization(raw_tables(spark, sf_dir).orders)


@query("quality_findings")
def q_quality_findings(spark, sf_dir):
    r = raw_tables(spark, sf_dir)
    return P.quality_findings(r.customers, r.products, r.orders)


@query("drop_impact")
def q_drop_impact(spark, sf_dir):
    return P.drop_impact(raw_tables(spark, sf_dir).orders)


@query("profile_counters")
def q_profile_counters(spark, sf_dir):
    r = raw_tables(spark, sf_dir)
    return P.profile_counters(r.customers, r.products, r.orders)


# ------------------------------------------------------------------ checks
from starledger.operators import checks as V  # noqa: E402
from starledger.operators import intake as I  # noqa: E402
from starledger.operators import serving as A  # noqa: E402
from starledger.sources.fixtures import INTAKE_AS_OF, intake_batch  # noqa: E402


@query("constraint_violations")
def q_constraint_violations(spark, sf_dir):
    m = _model(spark, sf_dir)
    return V.constraint_violations(m.customers, m.products, m.orders)  # each table is read once


# ----------------------------------------------------------------- serving
@query("customer_lookup")
def q_customer_lookup(spark, sf_dir):
    return A.customer_lookup(_model(spark, sf_dir).customers)


@query("customer_list")
def q_customer_list(spark, sf_dir):
    return A.customer_list(_model(spark, sf_dir).customers)


@query("active_products")
def q_active_products(spark, sf_dir):
    return A.active_products(_model(spark, sf_dir).products)


@query("recent_orders")
def q_recent_orders(spark, sf_dir):
    m = _model(spark, sf_dir)
    return A.recent_orders(m.orders, m.customers, m.products)


@query("recent_orders_display")
def q_recent_orders_display(spark, sf_dir):
    m = _model(spark, sf_dir)
    return A.recent_orders_display(A.recent_orders(m.orders, m.customers, m.products))


@query("kpi_panel_display")
def q_kpi_panel_display(spark, sf_dir):
    m = _model(spark, sf_dir)
    return S.panel_display(m.survivors, m.products)


def _by_month(spark, sf_dir):
    """The clean orders published by month; the folder of the run."""
    from starledger.sources.months import write_by_month
    path = scratch_path(spark, f"months/{uuid.uuid4().hex}")
    write_by_month(_model(spark, sf_dir).orders, path, "r1")
    return path


@query("recent_orders_by_month")
def q_recent_orders_by_month(spark, sf_dir):
    """A4 from the newest months alone."""
    from starledger.sources.months import newest
    m = _model(spark, sf_dir)
    return A.recent_orders(newest(spark, _by_month(spark, sf_dir), "r1", 20), m.customers, m.products)


@query("dim_date_range_by_month")
def q_dim_date_range_by_month(spark, sf_dir):
    """D4 from the first and the last month."""
    from starledger.sources.months import date_range
    return date_range(spark, _by_month(spark, sf_dir), "r1")


@query("published_enriched")
def q_published_enriched(spark, sf_dir):
    """S6 + S7: the run's tables saved in the catalogue, the view read by name."""
    from starledger.sources.metastore import create_database, publish_tables
    m, database = _model(spark, sf_dir), f"starledger_{uuid.uuid4().hex[:12]}"
    create_database(spark, database, scratch_path(spark, f"catalogue/{database}"))
    publish_tables(spark, {"customers": m.customers, "products": m.products, "orders": m.orders}, database, "r1")
    return spark.table(f"{database}.v_orders_enriched")


@query("bulk_order_ids")
def q_bulk_order_ids(spark, sf_dir):
    """A7 for a whole batch: every submitted row gets the next free id, in
    submission order."""
    from starledger.operators.ids import allocate_order_ids
    raw = _written_raw(spark, sf_dir)
    rows = intake_batch(spark, sf_dir, raw.orders).select(F.col("seq.k").alias("clave"), F.col("seq.s").alias("copia"))
    return allocate_order_ids(rows, M.clean_model(raw).unpriced_orders, ["clave", "copia"])


@query("next_order_id")
def q_next_order_id(spark, sf_dir):
    return A.next_order_id(_model(spark, sf_dir).unpriced_orders)


# ------------------------------------------------------------------ intake
def _present_validated(v):
    from starledger.functions.money import line_amount
    return v.select("order_id", "customer_id", "sku", "quantity",
                    to_money(F.col("price_cents")).alias("unit_price"),
                    to_money(line_amount(F.col("quantity"), F.col("price_cents"))).alias("total"),
                    "order_date", "channel",
                    F.col("seq.k").alias("clave"), F.col("seq.s").alias("copia"), "estado", "errores")


def _validated(spark, sf_dir, strict=False):
    raw = _written_raw(spark, sf_dir)
    m = M.clean_model(raw)
    return I.validate(intake_batch(spark, sf_dir, raw.orders), m.unpriced_orders, INTAKE_AS_OF,
                      m.customers, m.products, strict=strict)


@query("intake_validated")
def q_intake_validated(spark, sf_dir):
    return _present_validated(_validated(spark, sf_dir))


@query("intake_indexed")
def q_intake_indexed(spark, sf_dir):
    """I6 against the bucketed id index: half of the ids indexed by the
    published run, half by an earlier intake batch."""
    from starledger.plans.id_index import index_published
    raw = _written_raw(spark, sf_dir)
    fact, batch = M.clean_model(raw).unpriced_orders, intake_batch(spark, sf_dir, raw.orders)
    ids = materialize(fact.select("order_id"))  # counted and stored by halves
    half = F.pmod(F.xxhash64("order_id", F.lit(1)), F.lit(2))
    index = index_published(spark, ids.filter(half == 0), scratch_path(spark, f"ids/{uuid.uuid4().hex}"), "r1")
    index.add(ids.filter(half == 1), "intake-b0")
    found = index.matching(batch.select(blank_to_null(F.col("order_id")).alias("order_id")))
    return _present_validated(I.validate(batch, found, INTAKE_AS_OF, id_types=dict(fact.dtypes)))


@query("intake_accepted")
def q_intake_accepted(spark, sf_dir):
    return M.present_orders(I.accepted(_validated(spark, sf_dir)))


@query("intake_rejects")
def q_intake_rejects(spark, sf_dir):
    return I.rejected(_validated(spark, sf_dir)).select(
        "order_id", F.col("seq.k").alias("clave"), F.col("seq.s").alias("copia"), "errores")


@query("intake_strict")
def q_intake_strict(spark, sf_dir):
    return _present_validated(_validated(spark, sf_dir, strict=True))


@query("orders_with_appends")
def q_orders_with_appends(spark, sf_dir):
    """The fact as queries see it after the batch has been appended."""
    from starledger.plans.intake_job import append_batch, fact_with_appends
    raw = _written_raw(spark, sf_dir)
    fact = materialize(M.clean_model(raw).orders)
    folder = scratch_path(spark, f"intake/{uuid.uuid4().hex}")
    append_batch(spark, intake_batch(spark, sf_dir, raw.orders), "b1", fact, folder, INTAKE_AS_OF)
    return M.present_orders(fact_with_appends(spark, fact, folder))
