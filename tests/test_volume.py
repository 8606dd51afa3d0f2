"""What a query shuffles, writes and reads over: rows are shuffled once where
one partitioning serves, and tables derived once. Rows are compared, too."""

import datetime as dt
import glob
import gzip

import pytest
from pyspark.sql import functions as F

from oracle_compare import SF_SMALL
from starledger.functions.text import blank_to_null, strip_space
from starledger.operators import clean as C
from starledger.operators import intake as I
from starledger.operators import totals as S
from starledger.operators.dedup import keep_first
from starledger.plans import catalog
from starledger.plans.id_index import IdIndex
from starledger.schemas import INTAKE_TEXT, ORDERS_CSV
from starledger.session import materialize, scratch_path
from starledger.sources.csv import read_text_csv, typed_orders
from starledger.sources.fixtures import orders_raw, orders_raw_to_write
from test_plans import plan_text

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def unbroadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def tables(spark, folder, numbers):
    """Three orders, one of them twice, and lines with these line numbers."""
    at = dt.datetime(2024, 5, 1)
    lines = [(k, 10 + j % 3, j, n, float(j + 1), 100.0, 0.1 if j % 2 else 0.0, 0.08, "R", "O", at + dt.timedelta(days=j % 4))
             for k in (1, 2, 3, None) for j, n in enumerate(numbers)]
    spark.createDataFrame(lines, LINE).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(k, 5, at, "1-URGENT") for k in (1, 2, 2, 3)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string"
                          ).write.parquet(f"{folder}/orders.parquet")
    return folder


@pytest.mark.parametrize("numbers, by_id", [([1, 1, 2, 9, 0], False), ([1, 1, None, None], True), ([1, 11, 0, 10, -9], True)])
def test_written_orders_are_the_raw_orders_with_one_shuffle(unbroadcast, tmp_dir, numbers, by_id):
    folder = tables(unbroadcast, tmp_dir, numbers)
    got, want = orders_raw_to_write(unbroadcast, folder), orders_raw(unbroadcast, folder)
    # both sides of the join, and a shuffle by id only where line numbers need it
    assert plan_text(got).count("Exchange hashpartitioning") == (3 if by_id else 2)
    assert got.columns == want.columns and got.dtypes == want.dtypes and rows(got) == rows(want)


@pytest.mark.parametrize("name", ["intake_validated", "intake_strict", "intake_accepted", "intake_rejects", "bulk_order_ids"])
def test_intake_derives_the_orders_once(spark, name):
    assert "lineitem.parquet" not in plan_text(catalog.registry()[name](spark, SF_SMALL))


def test_rows_with_errors_of_their_own_are_not_shuffled(unbroadcast):
    spark = unbroadcast
    batch = spark.createDataFrame([(f"W{i % 5}" if i % 7 else " ", "1", "2", "3" if i % 3 else "x", "1.5", "2024-01-01", "retail", i)
                                   for i in range(60)], INTAKE_TEXT)
    facts = spark.createDataFrame([("W3", 1, 1)], "order_id string, customer_id long, sku long")
    got = I.validate(batch, facts, "2026-06-01")
    text = plan_text(got)
    assert "Union" in text
    said = [(r["order_id"], r["seq"], r["errores"]) for r in got.collect()]
    seen = set()
    for i in range(60):  # in order of submission
        text_id = f"W{i % 5}" if i % 7 else None
        errors = ([I.MSG_ID_REQUIRED] if text_id is None else []) + ([] if i % 3 else [I.MSG_QTY_INVALID])
        if not errors:
            errors = [I.MSG_REPEATED] if text_id in seen else [I.MSG_EXISTS] if text_id == "W3" else []
            seen.add(text_id)
        assert (text_id, i, " | ".join(errors) or None) in said
    assert len(said) == 60


def test_new_rows_are_shuffled_once_for_keep_first_and_look_up(unbroadcast, tmp_dir):
    spark = unbroadcast
    raw = materialize(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5), ("c", 6)], "order_id string, seq long"))
    for stored, left in ((["b", "z"], ["a", "c", None]), (["b", None], ["a", "c"])):
        index = IdIndex(spark, f"{tmp_dir}/{len(left)}", 4)
        firsts = keep_first(raw, ["order_id"])
        assert rows(index.unseen(firsts, ids=raw)) == rows(firsts)  # nothing stored yet
        index.add(spark.createDataFrame([(x,) for x in stored], "order_id string"), "p")
        new = index.unseen(firsts, ids=raw)
        assert plan_text(new).count("Exchange hashpartitioning") == 2  # the rows, the stored ids
        assert sorted(map(str, (r["order_id"] for r in new.collect()))) == sorted(map(str, left))


def test_the_five_kpis_read_sums_by_sku(spark):
    assert "/refresh/" not in plan_text(catalog.registry()["refreshed_kpis"](spark, SF_SMALL), "formatted")


def test_units_keep_the_type_of_stored_states(spark):
    one = S.states(spark.createDataFrame([("O1", 1, "s", 2**31 - 1, None, dt.date(2024, 1, 1), "x")] * 3,
                                         "order_id string, customer_id long, sku string, quantity int, price_cents long, order_date date, channel string"))
    assert dict(one.dtypes)["units"] == dict(one.dtypes)["unpriced_units"] == "decimal(30,0)"
    two = S.merge_sums(one.unionByName(one), ["mes", "canal"])
    assert dict(two.dtypes)["units"] == "decimal(38,0)" and int(two.first()["units"]) == 6 * (2**31 - 1)


def test_strip_equals_the_regular_expression(spark):
    edge = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
    texts = [chr(i) + "a" + chr(i) + "b" + chr(i) + "\n" + chr(i) for i in range(0x10000) if not 0xD800 <= i <= 0xDFFF]
    df = spark.createDataFrame([(t,) for t in [*texts, "", " \n ", "a\r\n", None]], "t string")
    assert df.filter(~strip_space(F.col("t")).eqNullSafe(F.regexp_replace("t", edge, ""))).count() == 0
    assert "regexp" not in plan_text(df.select(blank_to_null(F.col("t"))))


def test_csv_source_is_written_compressed_in_short_files(unbroadcast, tmp_dir, monkeypatch):
    spark, query = unbroadcast, catalog.registry()["csv_clean_orders"]
    folder = tables(spark, tmp_dir, [1, 1, 2, 9, 0, 1, 1])
    lines = orders_raw(spark, folder).count()
    whole = query(spark, folder)
    monkeypatch.setattr(catalog, "CSV_FILE_ROWS", 2)  # an id's copies in different files
    before = set(glob.glob(scratch_path(spark, "csv_clean_orders/*")))
    assert rows(query(spark, folder)) == rows(whole)
    (new,) = set(glob.glob(scratch_path(spark, "csv_clean_orders/*"))) - before
    held = [len(gzip.open(f).readlines()) - 1 for f in glob.glob(f"{new}/part-*.csv.gz")]
    assert max(held) <= 2 and sum(held) == lines and not glob.glob(f"{new}/part-*.csv")


def test_numbered_files_keep_the_order_of_their_paths(spark, tmp_dir):
    ids = ["O1,C", "O2,C", "O1,C", ",C", "O3,C"]
    for k, name in enumerate(["c 10%.csv", "b.csv", "c 9.csv", "empty.csv"]):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write("order_id,customer_id,sku,quantity,unit_price,order_date,channel\n" + "".join(
                f"{i}{k}{j},s,{j + 1},1.5,2024-01-01,x\n" for j, i in enumerate(ids) if name != "empty.csv"))
    for path in (tmp_dir, sorted(glob.glob(f"{tmp_dir}/*.csv")), f"{tmp_dir}/c*.csv"):
        named, numbered = (typed_orders(read_text_csv(spark, path, ORDERS_CSV, number_files=n)) for n in (False, True))
        assert dict(numbered.dtypes)["seq"] == "struct<file:int,block:bigint,row:bigint>"
        assert rows(numbered.drop("seq")) == rows(named.drop("seq"))
        assert rows(C.dedup_orders(numbered).drop("seq")) == rows(C.dedup_orders(named).drop("seq"))


def test_dates_are_parsed_before_the_shuffle_and_judged_after(unbroadcast):
    raw = materialize(unbroadcast.createDataFrame(
        [("a", "c", "s", 1, 5, "2024-13-01", "x", 1), ("a", "c", "s", 1, 5, "2024-01-01", "x", 2),
         ("b", "c", "s", 1, 5, "2024-01-02", "x", 1), ("c", "c", "s", 1, 5, None, "x", 1), (None, "c", "s", 1, 5, "2024-01-03", "x", 1)],
        "order_id string, customer_id string, sku string, quantity int, price_cents long, order_date string, channel string, seq long"))
    got = C.order_survivors(raw)
    assert sorted(map(str, (r["order_id"] for r in got.collect()))) == ["None", "b"]  # a's first row has no day
    text = plan_text(got)
    above, below = text.split("Exchange hashpartitioning(order_id", 1)
    assert "gettimestamp" in below and "gettimestamp" not in above


@pytest.mark.parametrize("price", ["long", "double"])
def test_both_means_share_one_shuffle_of_the_statistics(unbroadcast, price):
    spark = unbroadcast
    raw = materialize(spark.createDataFrame(
        [("a", "s", 100), ("b", "s", None), ("c", "t", None), ("d", None, 300), ("e", None, None), ("f", "u", 7), ("g", "v", 8)],
        "order_id string, sku string, price_cents long").withColumn("price_cents", F.col("price_cents").cast(price)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan shows shared shuffles before it runs
    try:
        filled = C.impute_prices(raw)
        assert "ReusedExchange" in plan_text(filled)
        got = {r["order_id"]: r["price_cents"] for r in filled.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # known 100 + 300 + 7 + 8, and s filled with 100, over 5 rows with a price after that
    assert got == {"a": 100, "b": 100, "c": 103, "d": 300, "e": 103, "f": 7, "g": 8}
