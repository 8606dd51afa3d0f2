"""Files that arrive one after the other: keep-first, totals, retries."""

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from starledger.operators import totals as S
from starledger.operators.clean import clean_orders, order_survivors
from starledger.plans import refresh as R
from starledger.plans.id_index import IdIndex, index_published, open_index
from starledger.sources.csv import read_text_csv, typed_orders
from starledger.schemas import ORDERS_CSV

HEADER = "order_id,customer_id,sku,quantity,unit_price,order_date,channel\n"


def csv_rows(seed, n=160, ids=70):
    """Rows with copies of ids in several files, blank ids, bad dates and
    quantities, missing prices and skus without any price."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        i = r.randrange(ids)
        out.append(",".join([r.choice([f"O{i:06d}"] * 12 + [""]), f"C{i % 7}", r.choice([f"S{i % 9}"] * 9 + [""]),
                             str(r.choice([1, 2, 3, 4, -1, 0, ""])), r.choice(["", f"{r.randrange(100, 9999) / 100}"]) if i % 9 else "",
                             r.choice(["2024-01-15", "2024-02-29", "2025-13-40", "2025-03-01"]), r.choice([" Retail ", "export", "EXPORT"])]))
    return HEADER + "\n".join(out) + "\n"


def write(path, text, at):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    os.utime(path, (at, at))


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def files(tmp_dir):
    for i, name in enumerate(("z.csv", "a.csv", "m.csv")):  # arrival by time, not by name
        write(f"{tmp_dir}/all/{i}.csv", csv_rows(i), 1_700_000_000 + i)
        write(f"{tmp_dir}/named/{name}", csv_rows(i), 1_700_000_000 + i)
    return tmp_dir


def whole(spark, tmp_dir, upto=3):
    return typed_orders(read_text_csv(spark, [f"{tmp_dir}/all/{i}.csv" for i in range(upto)], ORDERS_CSV))


def reports(rows_or_state, products):
    return [rows(f) for f in (S.total_sales(rows_or_state), S.total_margin(rows_or_state, products), S.order_count(rows_or_state),
                              S.average_ticket(rows_or_state), S.panel(rows_or_state), S.by_month(rows_or_state), S.by_channel(rows_or_state),
                              S.by_category(rows_or_state, products), S.top_products(rows_or_state, products))]


def test_three_arrivals_equal_one_batch(spark, files):
    products = spark.createDataFrame([(f"S{i}", f"cat{i % 2}" if i else None, 100 * i, True) for i in range(8)],
                                     "sku string, category string, cost_cents long, active boolean")
    state, incoming = f"{files}/state", f"{files}/incoming"
    os.makedirs(incoming)
    for k, name in enumerate(("z.csv", "a.csv", "m.csv"), 1):
        shutil.copy2(f"{files}/named/{name}", f"{incoming}/{name}")
        assert R.refresh_folder(spark, incoming, state) == [k]
        os.remove(f"{incoming}/{name}")  # an old file that is read again would fail below
        batch = whole(spark, files, k)
        assert rows(R.survivors(spark, state)) == rows(order_survivors(batch).select(*R.ORDER_COLS))
        assert rows(R.refreshed_orders(spark, state)) == rows(clean_orders(batch))
    want = reports(order_survivors(whole(spark, files)), products)
    assert reports(R.totals_state(spark, state), products) == want
    assert R.compact(spark, state) == 3 and R.compact(spark, state) == 3
    assert reports(R.totals_state(spark, state), products) == want
    assert R.refresh_folder(spark, incoming, state) == []


def test_an_arrival_again_changes_nothing(spark, files):
    state = f"{files}/state"
    parts = [typed_orders(read_text_csv(spark, f"{files}/all/{i}.csv", ORDERS_CSV)) for i in range(3)]
    for i in range(3):
        assert R.arrive(spark, parts[i], state, f"file-{i}", ids_each=10) == i + 1
    before, sums = rows(R.survivors(spark, state)), rows(R.totals_state(spark, state))
    assert R.arrive(spark, parts[0], state, "file-0") == 1
    assert R.arrive(spark, parts[1], state, "file-1") == 2
    assert rows(R.survivors(spark, state)) == before and rows(R.totals_state(spark, state)) == sums
    assert rows(R.arrivals(spark, state).select("arrival", "name")) == rows(
        spark.createDataFrame([(i + 1, f"file-{i}") for i in range(3)], "arrival int, name string"))


def test_an_arrival_broken_off_is_not_seen(spark, files, monkeypatch):
    state = f"{files}/state"
    parts = [typed_orders(read_text_csv(spark, f"{files}/all/{i}.csv", ORDERS_CSV)) for i in range(2)]
    R.arrive(spark, parts[0], state, "file-0")
    before = rows(R.survivors(spark, state))

    def broken(*a, **k):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(R, "states", broken)
        with pytest.raises(RuntimeError):
            R.arrive(spark, parts[1], state, "file-1")
    assert rows(R.survivors(spark, state)) == before
    assert R.arrive(spark, parts[1], state, "file-1") == 2
    assert rows(R.survivors(spark, state)) == rows(order_survivors(whole(spark, files, 2)).select(*R.ORDER_COLS))


def test_empty_arrival_and_no_arrival(spark, files):
    state = f"{files}/state"
    with pytest.raises(FileNotFoundError):
        R.totals_state(spark, state)
    part = typed_orders(read_text_csv(spark, f"{files}/all/0.csv", ORDERS_CSV))
    R.arrive(spark, part.limit(0), state, "nothing")
    none = order_survivors(part.limit(0))
    assert R.survivors(spark, state).count() == 0 and rows(S.panel(R.totals_state(spark, state))) == rows(S.panel(none))
    R.arrive(spark, part, state, "something")
    assert rows(R.survivors(spark, state)) == rows(order_survivors(part).select(*R.ORDER_COLS))


# ------------------------------------------------------------------ id index
def test_index_reads_only_the_buckets_of_a_batch(spark, tmp_dir):
    ids = spark.range(5000).select(F.format_string("O%06d", "id").alias("order_id"))
    index = IdIndex(spark, tmp_dir, 32)
    assert index.ids() is None and index.matching(ids).count() == 0
    index.add(ids, "run-1")
    batch = spark.createDataFrame([("O000007",), ("O004999",), ("X1",), (None,), ("O000007",)], "order_id string")
    found = index.matching(batch)
    assert sorted(r[0] for r in found.collect()) == ["O000007", "O004999"]
    touched = index.touched(batch)
    assert 1 <= len(touched) <= 4
    plan = found._jdf.queryExecution().explainString(found._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line and "bucket" in line]
    assert filters and all(str(b) in filters[0] for b in touched)
    assert open_index(spark, tmp_dir).buckets == 32
    with pytest.raises(FileNotFoundError):
        open_index(spark, f"{tmp_dir}/nowhere")


def test_index_batches_replace_and_are_left_out(spark, tmp_dir):
    def frame(*ids):
        return spark.createDataFrame([(i,) for i in ids], "order_id string")

    def found(index, ids, **kw):
        return sorted(map(str, (r[0] for r in index.matching(ids, **kw).collect())))
    index = IdIndex(spark, tmp_dir, 4)
    index.add(frame("a", "b"), "001")
    index.add(frame("c", None), "002")
    everything = frame("a", "b", "c", "d", None)
    assert found(index, everything) == ["None", "a", "b", "c"]
    assert found(index, everything, without=["001"]) == ["None", "c"] and found(index, everything, before="002") == ["a", "b"]
    index.add(frame("a"), "001")
    assert found(index, everything) == ["None", "a", "c"]
    index.add(frame("a").limit(0), "001")
    assert found(index, everything) == ["None", "c"]
    index.add_batches(spark.createDataFrame([("x", "003"), ("y", "004")], "order_id string, batch string"))
    assert found(index, frame("x", "y", "c")) == ["c", "x", "y"]
    assert rows(index.unseen(frame("x", "q", None))) == rows(frame("q"))


def test_index_of_a_published_fact_with_appends(spark, tmp_dir):
    fact = spark.range(100).select(F.format_string("O%06d", "id").alias("order_id"))
    appended = spark.createDataFrame([("W1", "b1"), ("W2", "b2")], "order_id string, batch_id string")
    index = index_published(spark, fact, tmp_dir, "r1", appended, ids_each=1)
    assert index.buckets == 100
    got = index.matching(spark.createDataFrame([("O000042",), ("W1",), ("W2",), ("W3",)], "order_id string"), without=["intake-b2"])
    assert sorted(r[0] for r in got.collect()) == ["O000042", "W1"]
