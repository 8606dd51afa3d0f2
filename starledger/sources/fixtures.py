"""Conformed raw tables derived from the driver's TPC-H-like parquet tables.

The reference's raw orders file is not available, so raw customers, products
and orders are derived from ``customer``/``nation``, ``part`` and
``lineitem``/``orders`` by fixed arithmetic rules that put in the same kinds of
dirt the reference cleans: missing values, duplicate keys, impossible dates,
signs, orphans, inactive products and messy channel labels. The rules are
plain column expressions so that an independent SQL text derives the same
rows, and every row of the source tables is used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _zero_padded(prefix: str, number: F.Column, width: int = 9) -> F.Column:
    """``prefix`` + number zero-padded to ``width`` digits; wider numbers keep
    every digit (``printf('%09d')``), unlike a bare ``lpad``, which cuts."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= width, digits)
                                    .otherwise(F.lpad(digits, width, "0")))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The dirt rules (moduli, offsets and the bad date).
ORPHAN_CUSTOMER_MOD = 211
ORPHAN_SKU_MOD = 193
ORPHAN_OFFSET = 1_000_000
NULL_PRICE_DISCOUNT = 0.1
NULL_PRICE_SKU_MOD = 97
BAD_DATE_TAX = 0.08
BAD_DATE_TEXT = "2025-13-40"
NULL_COUNTRY_MOD = 40
NULL_SEGMENT_MOD = 50
CREATED_BASE_DATE = "2022-01-01"
CREATED_SPAN_DAYS = 900
NULL_CATEGORY_MOD = 30
NEGATIVE_COST_MOD = 20
COST_FACTOR = 60
ACTIVE_MIN_SIZE = 9
DIM_DUPLICATE_MOD = 100


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with its order."""
    li = _table(spark, sf_dir, "lineitem")
    od = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return li.join(od, li["l_orderkey"] == od["o_orderkey"], "inner")


def _order_columns() -> list[F.Column]:
    """The raw order columns of ``_order_lines``, without ``seq``."""
    priority = F.substring("o_orderpriority", 1, 1)
    return [
        _zero_padded("O", F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
        (F.col("o_custkey") + F.when(F.col("l_orderkey") % ORPHAN_CUSTOMER_MOD == 0,
                                     F.lit(ORPHAN_OFFSET)).otherwise(F.lit(0))).alias("customer_id"),
        (F.col("l_partkey") + F.when(F.col("l_partkey") % ORPHAN_SKU_MOD == 0,
                                     F.lit(ORPHAN_OFFSET)).otherwise(F.lit(0))).alias("sku"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7), -F.col("l_quantity"))
         .when(F.col("l_quantity") == 50, F.lit(0.0))
         .otherwise(F.col("l_quantity")).cast("int").alias("quantity"),
        F.when((F.col("l_discount") == F.lit(NULL_PRICE_DISCOUNT))
               | (F.col("l_partkey") % NULL_PRICE_SKU_MOD == 0), F.lit(None).cast("bigint"))
         .otherwise(F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100).cast("bigint"))
         .alias("price_cents"),
        F.when((F.col("l_tax") == F.lit(BAD_DATE_TAX)) & (F.col("l_linenumber") == 1),
               F.lit(BAD_DATE_TEXT))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
        F.when(priority == "1", F.lit(" Retail "))
         .when(priority == "2", F.lit("ECOMMERCE"))
         .when(priority == "3", F.lit("wholesale"))
         .when(priority == "5", F.lit("Export"))
         .otherwise(F.lit("retail")).alias("channel")]


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw order lines: (order_id, customer_id, sku, quantity, price_cents,
    order_date text, channel text, seq)."""
    lines = _order_lines(spark, sf_dir).select(*_order_columns(), *_SEQ_ORDER)
    # seq stands for file order within a line (l_orderkey, l_linenumber);
    # keep-first takes seq = 1. order_id is a one-to-one function of that
    # pair, so the window is partitioned by order_id: the same groups, and
    # the dedup on order_id then reuses this partitioning (no second shuffle).
    within_line = Window.partitionBy("order_id").orderBy(*_SEQ_ORDER)
    return lines.select(
        "order_id", "customer_id", "sku", "quantity", "price_cents", "order_date", "channel",
        F.row_number().over(within_line).cast("bigint").alias("seq"))


def orders_raw_to_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``orders_raw`` for a consumer that writes them: numbered on
    the partitioning of the join (all lines of an order), so the lines are
    shuffled once, before their texts are made. The copies of an id share a
    partition here, too.

    That takes line numbers of one digit: others (or NULL) could give lines of
    different orders the same id, so then the window runs over the id."""
    one_digit = F.coalesce(F.col("l_linenumber").between(0, 9), F.lit(False))
    if _table(spark, sf_dir, "lineitem").filter(~one_digit).limit(1).count():
        return orders_raw(spark, sf_dir)
    within_line = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*_SEQ_ORDER)
    numbered = _order_lines(spark, sf_dir).withColumn("seq", F.row_number().over(within_line).cast("bigint"))
    return numbered.select(*_order_columns(), "seq")


_SEQ_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def _with_dim_duplicates(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """Original rows get seq 1; rows with key % 100 = 0 get a second copy
    (text column suffixed) with seq 2."""
    first = df.withColumn("seq", F.lit(1).cast("bigint"))
    second = (df.filter(F.col(key) % DIM_DUPLICATE_MOD == 0)
              .withColumn(text_col, F.concat(F.col(text_col), F.lit("-dup")))
              .withColumn("seq", F.lit(2).cast("bigint")))
    return first.unionByName(second)


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customers: (customer_id, name, country, segment, created_at text, seq)."""
    c = _table(spark, sf_dir, "customer")
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % NULL_COUNTRY_MOD == 0, F.lit(None).cast("string"))
         .otherwise(F.col("n_name")).alias("country"),
        F.when(F.col("c_custkey") % NULL_SEGMENT_MOD == 1, F.lit(None).cast("string"))
         .otherwise(F.col("c_mktsegment")).alias("segment"),
        F.date_format(F.date_add(F.lit(CREATED_BASE_DATE).cast("date"),
                                 (F.col("c_custkey") % CREATED_SPAN_DAYS).cast("int")),
                      "yyyy-MM-dd").alias("created_at"),
    )
    return _with_dim_duplicates(base, "customer_id", "name")


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw products: (sku, category, cost_cents, active, seq)."""
    p = _table(spark, sf_dir, "part")
    cost = F.floor(F.col("p_retailprice") * COST_FACTOR).cast("bigint")
    base = p.select(
        F.col("p_partkey").alias("sku"),
        F.when(F.col("p_partkey") % NULL_CATEGORY_MOD == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_type")).alias("category"),
        F.when(F.col("p_partkey") % NEGATIVE_COST_MOD == 3, -cost).otherwise(cost).alias("cost_cents"),
        (F.col("p_size") > ACTIVE_MIN_SIZE).alias("active"),
    )
    return _with_dim_duplicates(base, "sku", "category")


@dataclass
class RawTables:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    text: dict[str, DataFrame] | None = None  # the rows as read, where the source is text


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(customers_raw(spark, sf_dir), products_raw(spark, sf_dir),
                     orders_raw(spark, sf_dir))


# The intake batch rules (by order key % 10) and the date the
# batch is validated against.
INTAKE_AS_OF = "2026-06-01"
INTAKE_FUTURE_DATE = "2027-01-15"


def intake_batch(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """A batch of submitted orders as text, one per raw order line (``orders``:
    the raw orders, where they are written already).

    By ``order key % 10``: 0 blank id, 1 quantity 'x', 2 quantity '0',
    3 price '0', 4 blank date, 5 a future date, 6 the line's existing fact
    id; other rows get a new id ``W<9 digits>``. Raw duplicates of a line
    share its id, so ids repeat within the batch. ``seq`` = (line number
    key, raw position) orders the submissions.
    """
    o = orders_raw(spark, sf_dir) if orders is None else orders
    k = F.substring(F.col("order_id"), 2, 20).cast("bigint")
    rule = F.call_function("div", k, F.lit(10)) % 10
    cents = F.col("price_cents")
    price_text = F.concat(F.call_function("div", cents, F.lit(100)).cast("string"), F.lit("."),
                          F.lpad((cents % 100).cast("string"), 2, "0"))
    return o.select(
        F.when(rule == 0, F.lit("  "))
         .when(rule == 6, F.col("order_id"))
         .otherwise(_zero_padded("W", k)).alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("sku").cast("string").alias("sku"),
        F.when(rule == 1, F.lit("x")).when(rule == 2, F.lit("0"))
         .otherwise(F.col("quantity").cast("string")).alias("quantity"),
        F.when(rule == 3, F.lit("0")).when(cents.isNull(), F.lit(""))
         .otherwise(price_text).alias("unit_price"),
        F.when(rule == 4, F.lit("")).when(rule == 5, F.lit(INTAKE_FUTURE_DATE))
         .otherwise(F.col("order_date")).alias("order_date"),
        F.col("channel"),
        F.struct(k.alias("k"), F.col("seq").alias("s")).alias("seq"),
    )
