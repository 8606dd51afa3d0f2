"""Data-quality profile of the raw tables.

Each profile is one aggregate per table (all counters of a table in a single
pass), reshaped with ``unpivot``/``stack``; none issues an action per counter.
Duplicate counts are ``rows - groups`` from a partially aggregated group-by,
so a hot key is combined map-side. Listings (rows with a null, duplicated or
bad value) are plain filters or semi/anti joins and stay distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.functions.dates import parse_day
from starledger.functions.text import normalize_channel
from starledger.operators.dedup import all_copies
from starledger.operators.joins import broadcast_if_small
from starledger.session import materialize

# Labels and decisions of the findings table.
FINDINGS = [
    ("customers", "country", "nulos", "fillna Unknown"),
    ("customers", "segment", "nulos", "fillna Unknown"),
    ("customers", "customer_id", "duplicados", "keep first"),
    ("products", "category", "nulos", "fillna Uncategorized"),
    ("products", "cost", "negativos", "abs()"),
    ("products", "sku", "duplicados", "keep first"),
    ("orders", "unit_price", "nulos", "promedio del SKU"),
    ("orders", "quantity", "negativos/cero", "eliminar"),
    ("orders", "order_date", "fechas invalidas", "eliminar"),
    ("orders", "order_id", "duplicados", "keep first"),
    ("orders", "channel", "formato", "lower + strip"),
    ("orders", "customer_id", "FK sin match", "revisar"),
    ("orders", "sku", "FK sin match", "revisar"),
]


def _data_cols(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "seq"]


def _count() -> F.Column:
    return F.count(F.lit(1)).cast("bigint")


def _long(row: DataFrame, id_cols: Sequence[str], names: Sequence[str],
          var: str, val: str) -> DataFrame:
    return row.unpivot(list(id_cols), list(names), var, val)


# ------------------------------------------------------------- P1, P2, S3
def null_profile(df: DataFrame, table: str) -> DataFrame:
    """P1 for one table: tabla, campo, nulos, pct (2 decimals, half-even)."""
    cols = _data_cols(df)
    row = df.agg(_count().alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])
    long = _long(row, ["_rows"], cols, "campo", "nulos")
    pct = F.rint(F.col("nulos").cast("double") / F.col("_rows") * 100.0 * 100.0) / 100.0
    return long.select(F.lit(table).alias("tabla"), "campo", "nulos",
                       F.when(F.col("_rows") > 0, pct).alias("pct"))


def null_rows(df: DataFrame, column: str, cols: Sequence[str] | None = None) -> DataFrame:
    """The rows where ``column`` is NULL."""
    out = df.filter(F.col(column).isNull())
    return out.select(*cols) if cols else out


def scan_shape(tables: dict[str, DataFrame]) -> DataFrame:
    """S3: tabla, filas, columnas per raw table."""
    frames = [df.agg(_count().alias("filas")).select(
        F.lit(name).alias("tabla"), "filas", F.lit(len(_data_cols(df))).alias("columnas"))
        for name, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ------------------------------------------------------------- P3, P4
def duplicate_profile(df: DataFrame, table: str, key: str) -> DataFrame:
    """Tabla, campo, duplicados (extra copies beyond the first; NULL is a
    key)."""
    groups = df.groupBy(key).agg(_count().alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicados")) \
                 .select(F.lit(table).alias("tabla"), F.lit(key).alias("campo"), "duplicados")


def duplicate_rows(df: DataFrame, key: str, order_cols: Sequence[str] = ("seq",)) -> DataFrame:
    """Every copy of a duplicated key, sorted by key then position.

    The global sort is range-partitioned on (key, position), so a key with
    many copies is split over several tasks."""
    return all_copies(df, [key]).orderBy(F.col(key).asc_nulls_first(), *order_cols)


# ------------------------------------------------------------- P5-P7
def bad_date_profile(df: DataFrame, table: str, column: str) -> DataFrame:
    """P5: tabla, campo, fechas_invalidas (unparseable or missing)."""
    return df.agg(F.count_if(parse_day(F.col(column)).isNull()).cast("bigint").alias("fechas_invalidas")) \
             .select(F.lit(table).alias("tabla"), F.lit(column).alias("campo"), "fechas_invalidas")


def bad_date_rows(df: DataFrame, column: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows whose date does not parse."""
    out = df.filter(parse_day(F.col(column)).isNull())
    return out.select(*cols) if cols else out


def date_range(df: DataFrame, table: str, column: str) -> DataFrame:
    """Tabla, campo, fecha_min, fecha_max over the parseable dates."""
    d = parse_day(F.col(column))
    return df.agg(F.min(d).alias("fecha_min"), F.max(d).alias("fecha_max")) \
             .select(F.lit(table).alias("tabla"), F.lit(column).alias("campo"), "fecha_min", "fecha_max")


# ------------------------------------------------------------- P8-P11
def value_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Tabla, campo, valor, filas; NULL is a value (pandas dropna=False)."""
    as_text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = _long(as_text, [], columns, "campo", "valor")
    return (long.groupBy("campo", "valor").agg(_count().alias("filas"))
                .select(F.lit(table).alias("tabla"), "campo", "valor", "filas")
                .orderBy("campo", F.col("filas").desc(), F.col("valor").asc_nulls_first()))


def _placed_values(long: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rank spans of the values of several columns at once.

    ``long`` has (campo, v). Values are counted per (campo, value) with
    partial aggregation and the frequency table (bounded by the distinct
    values, not the rows) is range-partitioned on (campo, v) and written once
    with each row's partition number, so that both branches below see the same
    partitions; it is prefix-summed per partition, and partition offsets
    come from a table with one row per (campo, partition). Returns
    (campo, v, f, _before, _upto, n): value ``v`` holds ranks
    ``[_before, _upto)`` among the ``n`` non-NULL values of its column. No
    task holds more than one range partition of the distinct values.
    """
    parts = partitions or int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    freq = long.filter(F.col("v").isNotNull()).groupBy("campo", "v").agg(F.count(F.lit(1)).alias("f"))
    ranged = materialize(freq.repartitionByRange(parts, "campo", "v").withColumn("_p", F.spark_partition_id()))
    local = ranged.withColumn("_cum", F.sum("f").over(
        Window.partitionBy("campo", "_p").orderBy("v")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    totals = ranged.groupBy("campo", "_p").agg(F.sum("f").alias("_tot"))
    offsets = totals.select(
        "campo", "_p",
        (F.sum("_tot").over(Window.partitionBy("campo").orderBy("_p")
                            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
         - F.col("_tot")).alias("_off"),
        F.sum("_tot").over(Window.partitionBy("campo")).alias("n"))
    # one row per (column, range partition): a proven size bound to broadcast
    return local.join(F.broadcast(offsets), ["campo", "_p"]).select(
        "campo", "v", "f", "n",
        (F.col("_cum") + F.col("_off") - F.col("f")).alias("_before"),
        (F.col("_cum") + F.col("_off")).alias("_upto"))


def _quantile_columns(probs: Sequence[float]):
    """Aggregates picking the rank neighbours of each quantile (grouped by
    campo and n), and the interpolations over them (the formula of Spark's
    ``percentile``)."""
    n = F.col("n")
    picks, outs = [], []
    for i, q in enumerate(probs):
        pos = (n - 1).cast("double") * F.lit(float(q))
        lo, hi = F.floor(pos), F.ceil(pos)
        for side, rank in (("lo", lo), ("hi", hi)):
            picks.append(F.min(F.when((F.col("_before") <= rank) & (rank < F.col("_upto")),
                                      F.col("v").cast("double"))).alias(f"_{side}{i}"))
        lo_v, hi_v = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        outs.append(F.when((hi == lo) | (lo_v == hi_v), lo_v)
                     .otherwise((hi.cast("double") - pos) * lo_v + (pos - lo.cast("double")) * hi_v))
    return picks, outs


def _long_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    typed = df.select(*[F.col(c).cast("bigint").alias(c) for c in columns])
    return typed.unpivot([], list(columns), "campo", "v")


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float],
                    partitions: int | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles of an integral column, one row
    with columns ``q0, q1, ...``; equal to Spark's ``percentile``, computed
    without gathering the distinct values in one task."""
    placed = _placed_values(_long_numeric(df, [column]), partitions)
    picks, outs = _quantile_columns(probs)
    empty = [F.lit(None).cast("double").alias(f"q{i}") for i in range(len(probs))]
    got = placed.groupBy("campo", "n").agg(*picks).select(*[o.alias(f"q{i}") for i, o in enumerate(outs)])
    # no non-NULL values: one row of NULLs, as percentile gives
    return got.unionByName(df.sparkSession.range(1).select(*empty)).agg(
        *[F.max(f"q{i}").alias(f"q{i}") for i in range(len(probs))])


def describe_numeric(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, 25%, 50%, 75%, max of integral columns.

    One pass over the table for all columns (unpivot, then a frequency table
    per column). From it, one aggregate per column: exact integer moments
    (n, sum x, sum x^2; mean and sample std from one final division, so
    independent of how rows are split over tasks), min, max and the rank
    neighbours of the quartiles (exact, linearly interpolated).
    """
    placed = _placed_values(_long_numeric(df, columns))
    picks, outs = _quantile_columns([0.25, 0.5, 0.75])
    x = F.col("v").cast("decimal(38,0)")
    fx = F.col("f").cast("decimal(38,0)") * x
    agg = placed.groupBy("campo", "n").agg(
        F.sum(fx).alias("_s"), F.sum(fx * x).alias("_ss"),
        F.min("v").cast("double").alias("min"), F.max("v").cast("double").alias("max"), *picks)
    n = F.col("n").cast("bigint")
    var_num = F.col("_ss") * n - F.col("_s") * F.col("_s")
    stats = agg.select(
        "campo", n.alias("count"),
        (F.col("_s").cast("double") / n).alias("mean"),
        F.when(n > 1, F.sqrt(var_num.cast("double") / (n * (n - 1)).cast("double"))).alias("std"),
        "min", outs[0].alias("p25"), outs[1].alias("p50"), outs[2].alias("p75"), "max")
    # a column without any value still gets its row (count 0), as in pandas
    named = df.sparkSession.createDataFrame([(c,) for c in columns], "campo string").select(
        "campo", F.lit(0).cast("bigint").alias("count"))
    merged = stats.unionByName(named, allowMissingColumns=True)
    value_cols = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return merged.groupBy("campo").agg(
        F.max("count").alias("count"), *[F.max(c).alias(c) for c in value_cols]).select(
        F.lit(table).alias("tabla"), "campo", "count", *value_cols)


def approximate_quantiles(df: DataFrame, table: str, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75),
                          accuracy: int = 10_000) -> DataFrame:
    """P9's option for columns whose distinct values are too many to count:
    tabla, campo, q, valor, filas, error_rango, limite_rango.

    ``percentile_approx`` keeps a digest of about ``accuracy`` entries a column
    (merged over tasks) and states a rank error of at most rows / accuracy
    (plus one, for whole ranks). A second pass counts the rows below and up to each
    value, so ``error_rango`` is the true distance of q * rows from the ranks
    that the value holds.
    """
    probs = list(probs)
    digest = df.agg(F.struct(*[F.percentile_approx(F.col(c).cast("bigint"), probs, accuracy).alias(c) for c in columns]).alias("v")).scalar()
    at = [(c, i, digest.getField(c).getItem(i)) for c in columns for i in range(len(probs))]
    counted = df.agg(*[F.count(c).alias(f"n_{c}") for c in columns],
                     *[F.count_if(F.col(c) < v).alias(f"below_{c}_{i}") for c, i, v in at],
                     *[F.count_if(F.col(c) <= v).alias(f"upto_{c}_{i}") for c, i, v in at],
                     *[F.max(v).alias(f"v_{c}_{i}") for c, i, v in at])
    rows = F.array(*[F.struct(F.lit(c).alias("campo"), F.lit(float(probs[i])).alias("q"), F.col(f"v_{c}_{i}").alias("valor"),
                              F.col(f"n_{c}").alias("filas"), F.col(f"below_{c}_{i}").alias("below"), F.col(f"upto_{c}_{i}").alias("upto"))
                     for c, i, _ in at])
    rank = F.col("q") * F.col("filas")
    return counted.select(F.inline(rows)).select(
        F.lit(table).alias("tabla"), "campo", "q", "valor", "filas",
        F.greatest(F.col("below") - rank, rank - F.col("upto"), F.lit(0.0)).alias("error_rango"),
        (F.col("filas") / F.lit(accuracy) + 1).alias("limite_rango"))


def describe_text(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """P10: count, unique, top, freq of text columns (top ties: smallest value).

    Value counts are partially aggregated; the top value per column is a
    ``min_by`` aggregate, so no column's values meet in one window task."""
    as_text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = _long(as_text, [], columns, "campo", "valor").filter(F.col("valor").isNotNull())
    freq = long.groupBy("campo", "valor").agg(_count().alias("_f"))
    return freq.groupBy("campo").agg(
        F.sum("_f").cast("bigint").alias("count"),
        _count().alias("unique"),
        F.min_by("valor", F.struct((-F.col("_f")).alias("nf"), F.col("valor").alias("v"))).alias("top"),
        F.max("_f").alias("freq")).select(F.lit(table).alias("tabla"), "campo", "count", "unique", "top", "freq")


def head(df: DataFrame, order_cols: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in source order (a top-k, not a full sort)."""
    return df.orderBy(*order_cols).limit(n)


def info(df: DataFrame, table: str) -> DataFrame:
    """Tabla, campo, tipo, no_nulos: type and non-null values per column."""
    cols = _data_cols(df)
    types = F.create_map(*[F.lit(x) for c, t in df.dtypes if c in cols for x in (c, t)])
    row = df.agg(*[F.count(c).cast("bigint").alias(c) for c in cols])
    return _long(row, [], cols, "campo", "no_nulos").select(
        F.lit(table).alias("tabla"), "campo", types[F.col("campo")].alias("tipo"), "no_nulos")


def schema_listing(df: DataFrame, table: str):
    """(tabla, campo, tipo) of a table's columns, as plain tuples (the
    schema is metadata held by the driver, not data)."""
    return [(table, name, dtype) for name, dtype in df.dtypes if name != "seq"]


# ------------------------------------------------------------- P12-P15
def negative_profile(df: DataFrame, table: str, column: str) -> DataFrame:
    """Tabla, campo, negativos."""
    return df.agg(F.count_if(F.col(column) < 0).cast("bigint").alias("negativos")) \
             .select(F.lit(table).alias("tabla"), F.lit(column).alias("campo"), "negativos")


def zero_profile(df: DataFrame, table: str, column: str) -> DataFrame:
    """Tabla, campo, ceros, no_positivos."""
    return df.agg(F.count_if(F.col(column) == 0).cast("bigint").alias("ceros"),
                  F.count_if(F.col(column) <= 0).cast("bigint").alias("no_positivos")) \
             .select(F.lit(table).alias("tabla"), F.lit(column).alias("campo"), "ceros", "no_positivos")


def in_currency(described: DataFrame, names: dict[str, str]) -> DataFrame:
    """A ``describe_numeric`` result whose columns of cents (the keys of
    ``names``) are shown in currency units under the source's names."""
    cents = F.col("campo").isin(*names)
    shown = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    values = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return described.select("tabla", F.when(cents, shown[F.col("campo")]).otherwise(F.col("campo")).alias("campo"), "count",
                            *[F.when(cents, F.col(c) / 100.0).otherwise(F.col(c)).alias(c) for c in values])


def abs_in_range(df: DataFrame, key: str, column: str) -> DataFrame:
    """Each negative value, its absolute value and whether that lies
    within [min, max] of the positive values (sign-error plausibility)."""
    pos = df.filter(F.col(column) > 0)
    lo = pos.agg(F.min(column)).scalar()
    hi = pos.agg(F.max(column)).scalar()
    a = F.abs(F.col(column))
    return df.filter(F.col(column) < 0).select(
        key, a.alias("valor_abs"), lo.alias("min_positivo"), hi.alias("max_positivo"),
        F.coalesce((a >= lo) & (a <= hi), F.lit(False)).alias("en_rango"))


def inactive_products(products: DataFrame) -> DataFrame:
    """The inactive products."""
    return products.filter(~F.col("active"))


# ------------------------------------------------------------- P16-P21
def orphans(facts: DataFrame, dim: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Facts whose key is not among the dimension's keys (a NULL key
    is an orphan too). Left anti join against the dimension's distinct keys,
    broadcast when their checked size allows (then the fact is not
    shuffled)."""
    keys = broadcast_if_small(
        dim.select(F.col(key).alias("_dim_key")).filter(F.col("_dim_key").isNotNull()).distinct())
    return facts.join(keys, facts[key] == keys["_dim_key"], "left_anti").select(*cols)


def orders_on_inactive(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Sku, filas for facts on inactive products. Facts are counted per
    sku first, then semi-joined to the inactive skus."""
    per_sku = orders.groupBy("sku").agg(_count().alias("filas"))
    inactive = products.filter(~F.col("active")).select(F.col("sku").alias("_i")).distinct()
    return per_sku.join(inactive, per_sku["sku"] == inactive["_i"], "left_semi")


def price_history_for_nulls(orders: DataFrame) -> DataFrame:
    """For each sku with a missing price in the raw facts, how many known
    prices it has and their mean, or 'sin historial'. Replaces a Python loop
    over skus with one grouped aggregate."""
    stats = orders.groupBy("sku").agg(
        F.count_if(F.col("price_cents").isNull()).cast("bigint").alias("precios_nulos"),
        F.count("price_cents").cast("bigint").alias("n_precios"),
        F.sum(F.col("price_cents").cast("decimal(28,8)")).alias("_s"))
    return stats.filter(F.col("precios_nulos") > 0).select(
        "sku", "precios_nulos", "n_precios",
        F.when(F.col("n_precios") > 0, F.col("_s").cast("double") / F.col("n_precios") / 100.0)
         .alias("precio_medio"),
        F.when(F.col("n_precios") > 0, F.lit("historial")).otherwise(F.lit("sin historial"))
         .alias("estado"))


def raw_mean_price(orders: DataFrame) -> DataFrame:
    """P20: mean of the known raw prices (currency units)."""
    return orders.agg((F.sum(F.col("price_cents").cast("decimal(28,8)")).cast("double") / F.count("price_cents") / 100.0)
                      .alias("precio_medio_global"))


def channel_normalization(orders: DataFrame) -> DataFrame:
    """Canal, filas_antes, filas_despues: the distribution by raw label
    and by normalised label, both from one count by raw label."""
    none = F.lit(0).cast("bigint")
    per_label = orders.groupBy("channel").agg(_count().alias("_n"))
    both = per_label.select(F.inline(F.array(
        F.struct(F.col("channel").alias("canal"), F.col("_n").alias("_before"), none.alias("_after")),
        F.struct(normalize_channel(F.col("channel")).alias("canal"), none.alias("_before"), F.col("_n").alias("_after")))))
    return both.groupBy("canal").agg(F.sum("_before").alias("filas_antes"), F.sum("_after").alias("filas_despues"))


# ------------------------------------------------------------- P22-P24
def _flag(cond: F.Column) -> F.Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


# grouping_id of each grouping set of (order_id, customer_id, sku)
_BY_ORDER, _BY_CUSTOMER, _BY_SKU = 3, 5, 6


def orders_profile_pass(orders: DataFrame) -> DataFrame:
    """One scan of the raw fact for every order counter of the profile.

    ``groupingSets`` over (order_id), (customer_id), (sku): row counts per
    order id carry the row-level counters (for duplicates and totals), and
    per-customer / per-sku counts (collapsed map-side) feed the orphan
    checks. A small summary of it is written once and read by each
    consumer, instead of each consumer scanning the raw fact again.
    """
    flagged = orders.select(
        "order_id", "customer_id", "sku",
        _flag(F.col("price_cents").isNull()).alias("_null_price"),
        _flag(F.col("quantity") <= 0).alias("_qty_le0"),
        _flag(F.col("quantity") < 0).alias("_qty_lt0"),
        _flag(parse_day(F.col("order_date")).isNull()).alias("_bad_date"),
        _flag(~F.col("channel").eqNullSafe(normalize_channel(F.col("channel")))).alias("_channel"))
    counters = ["_null_price", "_qty_le0", "_qty_lt0", "_bad_date", "_channel"]
    sets = flagged.groupingSets([["order_id"], ["customer_id"], ["sku"]], "order_id", "customer_id", "sku")
    per_key = sets.agg(F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("_n"),
                       *[F.sum(c).alias(c) for c in counters])
    # Collapse the per-order groups into one totals row (map-side partial
    # aggregation does most of it); keep per-customer and per-sku counts.
    # What is written is small: one row per customer and per sku, plus one.
    small = per_key.groupBy(
        "_gid",
        F.when(F.col("_gid") == _BY_CUSTOMER, F.col("customer_id")).alias("customer_id"),
        F.when(F.col("_gid") == _BY_SKU, F.col("sku")).alias("sku"),
    ).agg(F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_extra"),
          *[F.sum(c).alias(c) for c in counters])
    return materialize(small)


def _order_totals(per: DataFrame) -> DataFrame:
    return per.filter(F.col("_gid") == _BY_ORDER).agg(
        F.coalesce(F.sum("_extra"), F.lit(0)).alias("dups"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c)
          for c in ["_null_price", "_qty_le0", "_qty_lt0", "_bad_date", "_channel"]])


def _key_counters(df: DataFrame, key: str, counters: dict) -> DataFrame:
    """One row: extra copies per key (``dups``) and each counter, from one
    group-by that carries the counters (one pass over the table)."""
    per_key = df.groupBy(key).agg(_count().alias("_n"),
                                  *[F.count_if(cond).alias(name) for name, cond in counters.items()])
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("dups"),
                       *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in counters])


def _rows(frame: DataFrame, specs) -> DataFrame:
    """Finding rows (tabla, campo, problema, filas_afectadas, decision) from
    one-row ``frame``; ``specs`` pairs a FINDINGS entry with a column."""
    args = []
    for (tabla, campo, problema, decision), col in specs:
        args += [F.lit(tabla), F.lit(campo), F.lit(problema), F.col(col).cast("bigint"), F.lit(decision)]
    return frame.select(F.stack(F.lit(len(specs)), *args).alias(
        "tabla", "campo", "problema", "filas_afectadas", "decision"))


def _orphan_total(per: DataFrame, gid: int, key: str, dim: DataFrame) -> DataFrame:
    keys = dim.select(F.col(key).alias("_dim_key")).filter(F.col("_dim_key").isNotNull()).distinct()
    groups = per.filter(F.col("_gid") == gid)
    return groups.join(keys, groups[key] == keys["_dim_key"], "left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans"))


def quality_findings(customers: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """Tabla, campo, problema, filas_afectadas, decision (13 rows).

    One pass per table: the dimensions' counters ride on their key group-by,
    the fact's on ``orders_profile_pass``; the per-table rows are combined
    with a union (one job, branches in parallel), not scalar subqueries. The
    channel row counts the rows whose label changes under lower + strip.
    """
    f = FINDINGS
    c = _key_counters(customers, "customer_id", {"country": F.col("country").isNull(),
                                                  "segment": F.col("segment").isNull()})
    p = _key_counters(products, "sku", {"category": F.col("category").isNull(),
                                        "cost": F.col("cost_cents") < 0})
    per = orders_profile_pass(orders)
    o = _order_totals(per)
    return (_rows(c, [(f[0], "country"), (f[1], "segment"), (f[2], "dups")])
            .unionByName(_rows(p, [(f[3], "category"), (f[4], "cost"), (f[5], "dups")]))
            .unionByName(_rows(o, [(f[6], "_null_price"), (f[7], "_qty_le0"), (f[8], "_bad_date"),
                                   (f[9], "dups"), (f[10], "_channel")]))
            .unionByName(_rows(_orphan_total(per, _BY_CUSTOMER, "customer_id", customers),
                               [(f[11], "orphans")]))
            .unionByName(_rows(_orphan_total(per, _BY_SKU, "sku", products), [(f[12], "orphans")])))


def drop_impact(orders: DataFrame, order_col: str = "seq") -> DataFrame:
    """Rows each removal rule hits on the raw facts, their union,
    original and remaining rows, and retention % (one decimal).

    A row is removed if its date does not parse, its quantity is <= 0 (a NULL
    quantity is not), or it is not the first copy of its id. One pass: rows
    are grouped by id carrying the per-rule counts, and whether the first
    copy is kept comes from ``min_by(kept, position)`` (partially aggregated,
    so a hot id is combined map-side). ``order_col`` is unique within an id.
    """
    bad_date = parse_day(F.col("order_date")).isNull()
    bad_qty = F.coalesce(F.col("quantity") <= 0, F.lit(False))
    per_id = orders.select(
        "order_id", F.col(order_col).alias("_pos"), bad_date.alias("_bd"), bad_qty.alias("_bq")
    ).groupBy("order_id").agg(
        _count().alias("_n"), F.count_if("_bd").alias("_bd"), F.count_if("_bq").alias("_bq"),
        F.min_by(~F.col("_bd") & ~F.col("_bq"), F.col("_pos")).alias("_first_kept"))
    out = per_id.agg(
        F.coalesce(F.sum("_bd"), F.lit(0)).cast("bigint").alias("fechas_invalidas"),
        F.coalesce(F.sum("_bq"), F.lit(0)).cast("bigint").alias("cantidades_invalidas"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicados"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("filas_originales"),
        F.count_if("_first_kept").cast("bigint").alias("filas_resultantes"))
    return out.select(
        "fechas_invalidas", "cantidades_invalidas", "duplicados",
        (F.col("filas_originales") - F.col("filas_resultantes")).alias("total_eliminar"),
        "filas_originales", "filas_resultantes",
        F.when(F.col("filas_originales") > 0,
               F.rint(F.col("filas_resultantes").cast("double") / F.col("filas_originales") * 1000.0)
               / 10.0).alias("retencion_pct"))


def profile_counters(customers: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """The nine pipeline counters as one record.

    One aggregate per table (the fact's duplicate count carries its other
    counters through the order-id group-by); the one-row results are
    combined by a union and a ``max`` per column, not by joins."""
    c = customers.agg(F.count_if(F.col("country").isNull()).cast("bigint").alias("null_country"),
                      F.count_if(F.col("segment").isNull()).cast("bigint").alias("null_segment"))
    p = products.agg(F.count_if(F.col("cost_cents") < 0).cast("bigint").alias("negative_cost"),
                     F.count_if(F.col("category").isNull()).cast("bigint").alias("null_category"),
                     F.count_if(F.col("active") == F.lit(False)).cast("bigint").alias("inactive"))
    o = _key_counters(orders, "order_id", {
        "null_price": F.col("price_cents").isNull(), "negative_qty": F.col("quantity") < 0,
        "invalid_dates": parse_day(F.col("order_date")).isNull()}).withColumnRenamed("dups", "duplicate_ids")
    names = ["null_country", "null_segment", "negative_cost", "null_category", "inactive",
             "null_price", "negative_qty", "duplicate_ids", "invalid_dates"]
    merged = c.unionByName(p, allowMissingColumns=True).unionByName(o, allowMissingColumns=True)
    return merged.agg(*[F.max(n).cast("bigint").alias(n) for n in names])
