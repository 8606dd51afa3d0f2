"""Published layouts: months, catalogue, ids, archive; inferred types."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from starledger.operators import serving as A
from starledger.operators.ids import allocate_order_ids, dense_numbers
from starledger.operators.infer import infer_types
from starledger.operators.profile import approximate_quantiles
from starledger.plans import etl
from starledger.sources import archive, metastore, months
from starledger.sources.sinks import ConstraintError, publish

ORDERS = "order_id string, customer_id long, sku long, quantity int, price_cents long, order_date date, channel string"


def orders(spark, n, seed=1, last="2024-06-30"):
    return spark.range(n).select(
        F.format_string("O%06d", "id").alias("order_id"), (F.col("id") % 9 + 1).alias("customer_id"), (F.col("id") % 5 + 1).alias("sku"),
        (F.col("id") % 4 + 1).cast("int").alias("quantity"), (F.col("id") * 7 % 1000 + 1).alias("price_cents"),
        F.date_sub(F.lit(last).cast("date"), (F.col("id") * 31 % 200).cast("int")).alias("order_date"), F.lit("retail").alias("channel"))


def dimensions(spark):
    customers = spark.createDataFrame([(i, f"n{i}", "ES", "x") for i in range(1, 9)], "customer_id long, name string, country string, segment string").withColumn(
        "created_at", F.lit("2024-01-01").cast("date"))
    products = spark.createDataFrame([(i, f"cat{i}", 10 * i, True) for i in range(1, 5)], "sku long, category string, cost_cents long, active boolean")
    return customers, products


# ------------------------------------------------------------------- months
@pytest.mark.parametrize("rows_each", [1_000_000, 40])
def test_newest_months_hold_the_latest_orders(spark, tmp_dir, rows_each):
    df, (customers, products) = orders(spark, 500), dimensions(spark)
    months.write_by_month(df, tmp_dir, "r/1", rows_each)
    assert months.months(spark, tmp_dir, "r/1") == ["2024-06", "2024-05", "2024-04", "2024-03", "2024-02", "2024-01", "2023-12"]
    for n in (1, 20, 100, 499, 2000):
        got = A.recent_orders(months.newest(spark, tmp_dir, "r/1", n), customers, products, n).collect()
        assert got == A.recent_orders(df, customers, products, n).collect()
    opened = {f.split("month=")[1][:7] for f in months.newest(spark, tmp_dir, "r/1", 20).inputFiles()}
    assert opened == {"2024-06"}
    assert months.date_range(spark, tmp_dir, "r/1").collect() == df.agg(F.min("order_date"), F.max("order_date")).collect()


def test_orders_without_a_date_and_reruns(spark, tmp_dir):
    df = orders(spark, 30).withColumn("order_date", F.when(F.col("quantity") > 1, F.col("order_date")))
    months.write_by_month(df, tmp_dir, "r1")
    months.write_by_month(df, tmp_dir, "r1")
    assert months.months(spark, tmp_dir, "r1")[-1] == months.NO_MONTH
    assert months.newest(spark, tmp_dir, "r1", 10_000).count() == 30
    none = df.filter("order_date is null")
    months.write_by_month(none, tmp_dir, "r2")
    assert months.date_range(spark, tmp_dir, "r2").first()[0] is None and months.newest(spark, tmp_dir, "r2", 3).count() == none.count()
    months.write_by_month(df.limit(0), tmp_dir, "r3")
    with pytest.raises(FileNotFoundError):
        months.newest(spark, tmp_dir, "r3", 3)


# ---------------------------------------------------------------- catalogue
def test_catalogue_publish_and_a_failed_check(spark, tmp_dir):
    customers, products = dimensions(spark)
    db, other = "retail_" + os.path.basename(tmp_dir).replace("-", "_"), spark.newSession()
    metastore.create_database(spark, db, tmp_dir)
    assert metastore.current_tag(spark, db) is None
    metastore.publish_tables(spark, {"customers": customers, "products": products, "orders": orders(spark, 50)}, db, "run 1")
    first = other.table(f"{db}.v_orders_enriched")
    from starledger.plans.model import orders_enriched
    want = orders_enriched(orders(spark, 50), customers, products)
    assert first.schema.names == want.schema.names and first.dtypes == want.dtypes
    assert sorted(map(str, first.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ConstraintError):
        metastore.publish_tables(spark, {"customers": customers, "products": products, "orders": orders(spark, 60).withColumn("quantity", F.lit(0))}, db, "run 1")
    assert other.table(f"{db}.orders_fact").count() == 50
    metastore.publish_tables(spark, {"customers": customers, "products": products, "orders": orders(spark, 70)}, db, "run 1")
    other.catalog.refreshTable(f"{db}.orders_fact")
    assert other.table(f"{db}.orders_fact").count() == 70 and other.table(f"{db}.v_orders_enriched").count() == 70
    assert len(metastore.drop_old_runs(spark, db)) == 3 and metastore.drop_old_runs(spark, db) == []
    assert other.table(f"{db}.customers").count() == 8
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_index_of_the_published_run(spark, tmp_dir):
    customers, products = dimensions(spark)
    publish(spark, {"customers": customers, "products": products, "orders": orders(spark, 40)}, tmp_dir, "r1")
    index = etl.published_index(spark, tmp_dir)
    assert index.ids().count() == 40 and etl.published_index(spark, tmp_dir).path == index.path


# ----------------------------------------------------------------- bulk ids
def test_dense_numbers_over_many_partitions(spark):
    r = random.Random(3)
    keys = r.sample(range(100_000), 3000)
    df = spark.createDataFrame([(k, k % 3) for k in keys], "k long, number int").repartition(7)
    got = {x.k: x.nth for x in dense_numbers(df, ["k"], "nth").collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}
    assert dense_numbers(df.limit(0), ["k"]).count() == 0


def test_bulk_ids_follow_the_largest(spark):
    rows = spark.createDataFrame([("b", 2), ("a", 1), ("c", 9)], "who string, seq long")
    for held, first in ((["O000007", "O1000041", "X9", None], 1000042), ([], 1)):
        have = spark.createDataFrame([(i,) for i in held], "order_id string")
        got = {x.who: x.order_id for x in allocate_order_ids(rows, have, ["seq"]).collect()}
        assert got == {w: f"O{first + i:06d}" for i, w in enumerate("abc")}


# ------------------------------------------------------------ inferred types
def test_types_and_one_bad_cell(spark):
    cells = {"i": ["1", "-20", None, "+3"], "f": ["1", "2.5", "1e3", ".5"], "b": ["True", "false", None, "TRUE"], "d": ["2024-02-29", None, "2025-01-01", "NA"],
             "t": ["x", "1", "2024-01-01", ""], "none": [None, "", "NaN", "null"], "bad_date": ["2024-02-30", "2024-01-01", None, None], "mixed": ["1", "true", None, None]}
    df = spark.createDataFrame(list(zip(*cells.values())), ", ".join(f"{c} string" for c in cells))
    want = {"i": "integer", "f": "float", "b": "boolean", "d": "date", "t": "text", "none": "all-null", "bad_date": "text", "mixed": "text"}
    assert {r.columna: r.tipo for r in infer_types(df.repartition(3), "t").collect()} == want
    wider = df.unionByName(spark.createDataFrame([("1.0", "z", "2", "2024-1-1", "t", "0", None, None)], df.schema))
    got = {r.columna: (r.tipo, r.filas_con_valor) for r in infer_types(wider, "t").collect()}
    assert (got["i"], got["f"], got["b"], got["d"], got["none"]) == (("float", 4), ("text", 5), ("text", 4), ("text", 3), ("integer", 1))
    assert {r.tipo for r in infer_types(df.limit(0), "t").collect()} == {"all-null"}


@pytest.mark.parametrize("accuracy", [10, 100, 10_000])
def test_approximate_quartiles_keep_their_bound(spark, accuracy):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("x"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("y"))
    got = approximate_quantiles(df, "t", ["x", "y"], accuracy=accuracy).collect()
    assert len(got) == 6 and all(0 <= r.error_rango <= r.limite_rango for r in got)
    assert all(r.limite_rango == r.filas / accuracy + 1 for r in got)


# ------------------------------------------------------------------ archive
FILES = {"a.csv": b"id,x\r\n1,2\r\n3,4", "empty.csv": b"", "mark.csv": b"\xef\xbb\xbfid\n" + b"\xff\xfe not utf-8 \x00\n" * 400, "big.csv": b"".join(b"%d,row\n" % i for i in range(3000)),
         "unended.csv": b"line\n" * 700 + b"last", "blank.csv": b"\n\n\n" * 300, "other.txt": b"not taken"}


@pytest.mark.parametrize("whole_bytes", [64 << 20, 100])
def test_archive_is_byte_identical(spark, tmp_dir, whole_bytes):
    src, out = f"{tmp_dir}/raw", f"{tmp_dir}/archive"
    os.makedirs(src)
    for name, data in FILES.items():
        with open(f"{src}/{name}", "wb") as f:
            f.write(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        for _ in range(2):  # a retry replaces the snapshot
            found = archive.archive(spark, src, out, "s1", whole_bytes=whole_bytes, piece_bytes=1000)
        pieces = archive.copied(spark, out, "s1").orderBy("name", "block", "piece").collect()
        for name, data in FILES.items():
            copy = b"".join(bytes(p.content) for p in pieces if p.name == name)
            assert copy == (data if name.endswith(".csv") else b"")
        digests = {(r.name, r.block, r.piece): (r.n_bytes, r.sha256) for r in found.collect()}
        assert digests == {(p.name, p.block, p.piece): (len(p.content), hashlib.sha256(p.content).hexdigest()) for p in pieces}
        if whole_bytes == 100:
            assert sum(p.name == "big.csv" for p in pieces) > 8
        assert archive.verify(spark, out, "s1", src, whole_bytes=whole_bytes, piece_bytes=1000).count() == 0
        with open(f"{src}/big.csv", "r+b") as f:
            f.write(b"9")
        assert archive.verify(spark, out, "s1", src, whole_bytes=whole_bytes, piece_bytes=1000).count() == 2
        assert archive.verify(spark, out, "s1").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
