"""Refresh after new order files, without reading the old ones again.

Files arrive one after the other; the state below ``<state>`` holds, for each
arrival, what later ones need of it:

* ``ids``: the order ids it brought first (a bucketed ``IdIndex``). Keep-first
  runs over all files in order of arrival, before every filter: a row counts
  only if its id is in no earlier arrival, also if the earlier row was then
  dropped for its date or quantity. Of a new file, only its own buckets are
  looked up.
* ``survivors``: its rows that stay, prices not filled (the fill depends on
  the mean prices of all arrivals, so it belongs to reading, not to arriving).
* ``states``: the additive sums of ``totals.states`` per sku, month and
  channel. Every report of ``operators/totals.py`` takes the states of all
  arrivals; they are as many rows as sku, month and channel combine.

An arrival becomes visible when it is logged, after all of its parts are
written. It has a name (a file's path, size and time); arriving again under the
same name rewrites the same parts from the ids of earlier arrivals alone, so
a repeated or retried run changes nothing. Arrivals are taken by one writer at
a time. ``compact`` merges the states of all arrivals so far into one part.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.operators.clean import impute_prices, normalize_channels, valid_dates, valid_quantity
from starledger.operators.dedup import keep_first
from starledger.operators.totals import SUMS, merge_sums, states
from starledger.plans.id_index import IDS_EACH, IdIndex, buckets_for
from starledger.schemas import ORDER_COLS, ORDERS_CSV
from starledger.session import materialize
from starledger.sources.csv import read_text_csv, typed_orders
from starledger.sources.sinks import write_partition

_LOG = "arrival int, name string, buckets int"
_MERGED = "upto int"


def _log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def arrivals(spark: SparkSession, state: str) -> DataFrame:
    """The logged arrivals: arrival (from 1), name, buckets."""
    return _log(spark, f"{state.rstrip('/')}/_arrivals", _LOG).distinct()


def _part(arrival: int) -> str:
    return f"{arrival:09d}"


def arrive(spark: SparkSession, raw_orders: DataFrame, state: str, name: str, ids_each: int = IDS_EACH) -> int:
    """Take in the raw order rows (with ``seq``) of one arrival; its number.
    The rows are read more than once: they should be written ones."""
    state = state.rstrip("/")
    known = arrivals(spark, state)
    row = known.agg(F.max("arrival").alias("last"), F.max("buckets").alias("buckets"),
                    F.max(F.when(F.col("name") == name, F.col("arrival"))).alias("mine")).first()
    number = row["mine"] or (row["last"] or 0) + 1
    ids = raw_orders.select("order_id")
    firsts = keep_first(raw_orders.select(*ORDER_COLS, "seq"), ["order_id"])
    index = IdIndex(spark, f"{state}/ids", row["buckets"] or buckets_for(ids.distinct().count(), ids_each))
    new = materialize(index.unseen(firsts, before=_part(number), ids=ids).drop("seq"))
    index.add(new.select("order_id"), _part(number))
    write_partition(valid_quantity(valid_dates(new)), f"{state}/survivors", "arrival", _part(number))
    mine = spark.read.parquet(f"{state}/survivors/arrival={_part(number)}")
    write_partition(states(mine), f"{state}/states", "arrival", _part(number))
    if row["mine"] is None:
        spark.createDataFrame([(number, name, index.buckets)], _LOG).coalesce(1).write.mode("append").parquet(f"{state}/_arrivals")
    return number


def new_files(spark: SparkSession, folder: str, state: str) -> list[tuple[str, str]]:
    """(path, name) of the folder's CSV files that have not arrived, oldest
    first; file contents are not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
             .select("path", "modificationTime", F.concat_ws("|", "path", F.col("length").cast("string"),
                                                              F.unix_micros("modificationTime").cast("string")).alias("name")))
    fresh = files.join(arrivals(spark, state).select("name"), "name", "left_anti")
    return [(r["path"], r["name"]) for r in fresh.orderBy("modificationTime", "path").collect()]


def refresh_folder(spark: SparkSession, folder: str, state: str) -> list[int]:
    """Take in every new orders file of a folder, each as one arrival."""
    return [arrive(spark, materialize(typed_orders(read_text_csv(spark, path, ORDERS_CSV))), state, name)
            for path, name in new_files(spark, folder, state)]


def _last(spark: SparkSession, state: str) -> int:
    return arrivals(spark, state).agg(F.max("arrival").alias("last")).first()["last"] or 0


def _parts(spark: SparkSession, path: str, after: int, upto: int) -> DataFrame:
    """The parts of the arrivals ``after`` < arrival <= ``upto``."""
    part = F.col("arrival").cast("int")
    return spark.read.parquet(path).filter((part > after) & (part <= upto)).drop("arrival")


def survivors(spark: SparkSession, state: str) -> DataFrame:
    """Keep-first, dated and positive rows of all arrivals, prices not filled."""
    return _parts(spark, f"{state.rstrip('/')}/survivors", 0, _last(spark, state))


def refreshed_orders(spark: SparkSession, state: str) -> DataFrame:
    """The clean orders of all arrivals."""
    return normalize_channels(impute_prices(survivors(spark, state))).select(*ORDER_COLS)


def totals_state(spark: SparkSession, state: str) -> DataFrame:
    """The stored states of all arrivals, for ``operators/totals.py``: the
    last merged part and those after it."""
    state = state.rstrip("/")
    upto = _log(spark, f"{state}/_merged", _MERGED).agg(F.max("upto").alias("u")).first()["u"] or 0
    last = _last(spark, state)
    if last == 0:
        raise FileNotFoundError(f"no arrival in {state}")
    parts = [] if upto == last else [_parts(spark, f"{state}/states", upto, last)]
    if upto:
        parts.append(spark.read.parquet(f"{state}/merged/upto={_part(upto)}"))
    columns = ["sku", "mes", "canal", *SUMS]
    out = parts[0].select(*columns)
    for part in parts[1:]:
        out = out.unionByName(part.select(*columns))
    return out


def compact(spark: SparkSession, state: str) -> int:
    """Merge the states of all arrivals so far into one part."""
    state, upto = state.rstrip("/"), _last(spark, state)
    if _log(spark, f"{state}/_merged", _MERGED).filter(F.col("upto") == upto).limit(1).count():
        return upto
    write_partition(merge_sums(totals_state(spark, state), ["mes", "canal"]), f"{state}/merged", "upto", _part(upto))
    spark.createDataFrame([(upto,)], _MERGED).coalesce(1).write.mode("append").parquet(f"{state}/_merged")
    return upto
