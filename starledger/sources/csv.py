"""CSV sources (S1, S2): header CSV files read with an explicit text schema.

* No schema inference: every column is read as text, the pandas missing-value
  tokens are mapped to NULL, then columns are typed with ``try_cast``.
* ``seq`` records source order as (file path, split start, row id). Within a
  split ``monotonically_increasing_id`` follows the file, and splits of a
  file are ordered by their start offset, so ordering by ``seq`` is file
  order even though Spark packs splits into tasks by size.
* Columns are found by the header's names (files of one folder share one
  header); a missing column is an error, further columns are left out.
* Doubled quotes are a quote. A row with more fields than the header, or a
  number that cannot be read, stops the run; a row with fewer is NULL there.
* Prices become cents without rounding (``double``); the cleaning step rounds
  them (C14). Costs are held as whole cents.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.functions.text import na_tokens_to_null
from starledger.schemas import CUSTOMERS_CSV, ORDERS_CSV, PRODUCTS_CSV

TABLE_SCHEMAS = {"customers": CUSTOMERS_CSV, "products": PRODUCTS_CSV, "orders": ORDERS_CSV}

# Spellings of a boolean cell.
TRUE_TOKENS = ["True", "true", "TRUE", "1"]
FALSE_TOKENS = ["False", "false", "FALSE", "0"]


class MissingInputError(FileNotFoundError):
    """Raised when required source files are absent (all names at once)."""


class MissingColumnError(ValueError):
    """Raised when a source file's header lacks required columns."""


def read_text_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False,
                  number_files: bool = False) -> DataFrame:
    """Header CSV as text columns, as read, plus ``seq`` (file order).
    ``multi_line`` lets quoted cells hold line ends (such files are not split).
    ``number_files``: ``seq`` holds each file's number in path order for its
    path, which would take most of a row in a sort; rows of different reads
    cannot be ordered by it."""
    def reader():
        return (spark.read.option("header", True).option("encoding", "UTF-8").option("escape", '"')
                .option("multiLine", multi_line))
    header = reader().csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise MissingColumnError(f"{path} lacks the columns: {', '.join(missing)}")
    # One field beyond the header takes what a too long row has there. The
    # last one is never read: with a column pruned, the parser fills short
    # rows with NULL instead of handling each as malformed.
    fields = [T.StructField(c, T.StringType()) for c in [*header, "_beyond", "_unread"]]
    df = reader().schema(T.StructType(fields)).option("mode", "PERMISSIVE").csv(path)
    df = df.filter(F.when(F.col("_beyond").isNull(), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("row with too many fields in "), F.col("_metadata.file_path"),
                               F.lit(": "), F.col("_beyond"))).cast("boolean")))
    names = [f.name for f in schema.fields]
    block, row = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    if not number_files:
        seq = F.struct(F.col("_metadata.file_path").alias("file"), block.alias("block"), row.alias("row"))
        return df.select(*names, seq.alias("seq"))
    placed = df.select(*names, F.col("_metadata.file_path").alias("_path"), block.alias("_block"), row.alias("_row"))
    number = F.coalesce("_number", F.raise_error(F.concat(F.lit("file not listed: "), F.col("_path"))).cast("int"))
    seq = F.struct(number.alias("file"), F.col("_block").alias("block"), F.col("_row").alias("row"))
    return (placed.join(F.broadcast(_file_numbers(spark, path)), F.col("_path") == F.col("_file"), "left")
            .select(*names, seq.alias("seq")))


def _file_numbers(spark: SparkSession, path) -> DataFrame:
    """The files of ``path`` numbered in the order of their paths, one row a
    file; their content is not read."""
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("_file")).distinct()
    return files.withColumn("_number", F.row_number().over(Window.orderBy("_file")))


def _cells(df: DataFrame) -> DataFrame:
    return df.select(*[na_tokens_to_null(F.col(c)).alias(c) for c in df.columns if c != "seq"], "seq")


def _number(name: str) -> F.Column:
    """A text cell as double; NULL stays NULL, unreadable text is an error."""
    text, value = F.col(name), F.col(name).try_cast("double")
    return F.when(text.isNotNull() & value.isNull(),
                  F.raise_error(F.concat(F.lit(f"unreadable number in {name}: "), text)).cast("double")
                  ).otherwise(value)


def _whole(name: str) -> F.Column:
    """A whole number as int; ``2.0`` is 2, a fraction is an error."""
    value = _number(name)
    return F.when(value != F.floor(value),
                  F.raise_error(F.concat(F.lit(f"fraction in {name}: "), F.col(name))).cast("int")
                  ).otherwise(value.cast("int"))


def _bool(c: F.Column) -> F.Column:
    return (F.when(c.isin(TRUE_TOKENS), F.lit(True))
             .when(c.isin(FALSE_TOKENS), F.lit(False)))


def typed_customers(df: DataFrame) -> DataFrame:
    return _cells(df).select("customer_id", "name", "country", "segment", "created_at", "seq")


def typed_products(df: DataFrame) -> DataFrame:
    return _cells(df).select("sku", "category", F.rint(_number("cost") * 100).cast("bigint").alias("cost_cents"),
                     _bool(F.col("active")).alias("active"), "seq")


def typed_orders(df: DataFrame) -> DataFrame:
    return _cells(df).select("order_id", "customer_id", "sku", _whole("quantity").alias("quantity"),
                     (_number("unit_price") * 100).alias("price_cents"),
                     "order_date", "channel", "seq")


TYPERS = {"customers": typed_customers, "products": typed_products, "orders": typed_orders}


def require_inputs(spark: SparkSession, raw_dir: str, names=("customers", "products", "orders")) -> dict:
    """Open every required ``<name>.csv``; if any is missing, raise one
    error naming all of them (before any work starts)."""
    frames, missing = {}, []
    for name in names:
        path = f"{raw_dir.rstrip('/')}/{name}.csv"
        try:
            frames[name] = read_text_csv(spark, path, TABLE_SCHEMAS[name])
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
                missing.append(f"{name}.csv")
            else:
                raise
    if missing:
        raise MissingInputError(f"missing input files in {raw_dir}: {', '.join(missing)}")
    return frames


def load_raw_csv(spark: SparkSession, raw_dir: str):
    """The three raw tables, typed, with ``seq`` (see module doc)."""
    from starledger.sources.fixtures import RawTables
    text = require_inputs(spark, raw_dir)
    return RawTables(customers=TYPERS["customers"](text["customers"]),
                     products=TYPERS["products"](text["products"]),
                     orders=TYPERS["orders"](text["orders"]), text=text)
