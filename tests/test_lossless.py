"""Inputs as the source writes them: text ids, fractions of a cent, quotes,
reordered headers; sums beyond 64 bits; accepted orders in every report."""

import os

import pytest
from pyspark.sql import functions as F

from starledger.operators import clean, kpis, profile, serving, totals
from starledger.plans import etl
from starledger.plans.intake_job import append_batch
from starledger.sources import csv as S
from starledger.sources.fixtures import INTAKE_AS_OF
from starledger.sources.sinks import ConstraintError
from starledger.streaming import intake_stream

ORDERS = "order_id string, customer_id string, sku string, quantity int, price_cents bigint, order_date date, channel string"
FORM = ("order_id string, customer_id string, sku string, quantity string, unit_price string, order_date string, "
        "channel string, seq long")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


def _orders_csv(folder, rows, header="order_id,customer_id,sku,quantity,unit_price,order_date,channel"):
    _write(f"{folder}/orders.csv", "\n".join([header, *rows]) + "\n")
    return f"{folder}/orders.csv"


def _scan(spark, path):
    return S.typed_orders(S.read_text_csv(spark, path, S.ORDERS_CSV))


def test_prices_are_rounded_half_even_once(spark, tmp_dir):
    path = _orders_csv(tmp_dir, [f"O{i},C1,S{i},2.0,{p},2024-01-01,retail"
                                 for i, p in enumerate(["0.125", "1.005", "0.285", "2.5"])])
    got = {r["order_id"]: (r["quantity"], r["price_cents"]) for r in clean.clean_orders(_scan(spark, path)).collect()}
    assert got == {"O0": (2, 12), "O1": (2, 100), "O2": (2, 28), "O3": (2, 250)}


def test_mean_uses_unrounded_prices(spark, tmp_dir):
    path = _orders_csv(tmp_dir, ["O1,C1,S1,1,0.004,2024-01-01,retail", "O2,C1,S1,1,0.012,2024-01-01,retail",
                                 "O3,C1,S1,1,,2024-01-01,retail"])
    out = {r["order_id"]: r["price_cents"] for r in clean.clean_orders(_scan(spark, path)).collect()}
    assert out == {"O1": 0, "O2": 1, "O3": 1}


@pytest.mark.parametrize("cell", ['O1,C1,S1,1,"1,50",2024-01-01,retail', "O1,C1,S1,x,1.50,2024-01-01,retail",
                                  "O1,C1,S1,1.5,1.50,2024-01-01,retail", "O1,C1,S1,1,1.50,2024-01-01,retail,more"])
def test_unreadable_cells_stop_the_run(spark, tmp_dir, cell):
    with pytest.raises(Exception, match="unreadable number|fraction in|too many fields"):
        _scan(spark, _orders_csv(tmp_dir, [cell])).collect()


def test_columns_by_name_quotes_and_short_rows(spark, tmp_dir):
    path = _orders_csv(tmp_dir, ['7,"a ""b"", c",C1,S1,O1,9.99,2024-01-01,z', "8,retail,C2,S2,O2"],
                       "quantity,channel,customer_id,sku,order_id,unit_price,order_date,extra")
    got = {r["order_id"]: r for r in _scan(spark, path).collect()}
    assert got["O1"]["channel"] == 'a "b", c' and got["O1"]["quantity"] == 7 and got["O1"]["customer_id"] == "C1"
    assert got["O2"]["price_cents"] is None and got["O2"]["quantity"] == 8
    with pytest.raises(S.MissingColumnError, match="sku"):
        S.read_text_csv(spark, _orders_csv(tmp_dir, [], "order_id,quantity"), S.ORDERS_CSV)


def _raw_files(folder, order_rows):
    _write(f"{folder}/customers.csv", 'customer_id,name,country,segment,created_at\nC0001," Ana x",,Retail,2024-01-01\n')
    _write(f"{folder}/products.csv", "sku,category,cost,active\nSKU0001,a,-0.50,True\n")
    _orders_csv(folder, order_rows)


def test_run_archives_text_exports_currency_and_keeps_spaces(spark, tmp_dir):
    _raw_files(f"{tmp_dir}/in", ["O000001,C0001,SKU0001,2,1.005,2024-01-01, Retail "])
    etl.run(spark, S.load_raw_csv(spark, f"{tmp_dir}/in"), f"{tmp_dir}/out", "r9")
    archived = spark.read.parquet(f"{tmp_dir}/out/archive/orders").first()
    assert archived["unit_price"] == "1.005" and archived["channel"] == " Retail "
    read = lambda t: spark.read.option("header", True).csv(f"{tmp_dir}/out/processed/{t}_clean").first().asDict()
    assert read("customers")["name"] == " Ana x" and read("products")["cost"] == "0.5"
    assert read("orders")["unit_price"] == "1.0"
    # a run that fails its checks leaves the export and the published run alone
    _raw_files(f"{tmp_dir}/bad", ["O000001,C0001,SKU0001,2,0,2024-01-01,retail"])
    with pytest.raises(ConstraintError):
        etl.run(spark, S.load_raw_csv(spark, f"{tmp_dir}/bad"), f"{tmp_dir}/out", "r10")
    assert read("orders")["unit_price"] == "1.0"
    assert etl.published_model(spark, f"{tmp_dir}/out/warehouse").orders.first()["price_cents"] == 100


def _form(spark, *rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], FORM)


def test_text_ids_survive_batch_strict_and_reports(spark, tmp_dir):
    _raw_files(f"{tmp_dir}/in", ["O000001,C0001,SKU0001,2,1.50,2024-01-01,retail"])
    etl.run(spark, S.load_raw_csv(spark, f"{tmp_dir}/in"), f"{tmp_dir}/out", "r1", archive=False, export=False)
    m = etl.published_model(spark, f"{tmp_dir}/out/warehouse")
    good = ("O000007", "C0001", "SKU0001", "1", "2.00", "2024-5-1", "retail")
    append_batch(spark, _form(spark, good, ("O000008", "C9", "SKU0001", "1", "2.00", "2024-05-01", "retail")), "b1",
                 m.orders, f"{tmp_dir}/intake", INTAKE_AS_OF, m.customers, m.products, strict=True)
    live = etl.published_model(spark, f"{tmp_dir}/out/warehouse", f"{tmp_dir}/intake")
    row = live.orders.filter("order_id = 'O000007'").first()
    assert (row["customer_id"], row["sku"], str(row["order_date"])) == ("C0001", "SKU0001", "2024-05-01")
    assert serving.next_order_id(live.orders).first()[0] == "O000008"
    assert kpis.kpi_panel(live.orders).first()["ventas_totales"] == 5.0
    assert spark.read.parquet(f"{tmp_dir}/intake/rejected").first()["errores"] == "Cliente inexistente"


def test_id_that_the_fact_cannot_hold_is_rejected(spark, tmp_dir):
    published = spark.createDataFrame([], "order_id string, customer_id bigint, sku bigint")
    append_batch(spark, _form(spark, ("O1", "C0001", "2", "1", "1", "2024-05-01", "retail"),
                              ("O2", "1", "2", "1", "1", "2024-05-01", "retail")), "b", published, tmp_dir, INTAKE_AS_OF)
    assert [r["customer_id"] for r in spark.read.parquet(f"{tmp_dir}/accepted").collect()] == [1]
    assert spark.read.parquet(f"{tmp_dir}/rejected").first()["errores"] == "Cliente inválido"


def test_two_streams_and_an_emptied_batch(spark, tmp_dir):
    published = spark.createDataFrame([], "order_id string, customer_id string, sku string")
    header = "order_id,customer_id,sku,quantity,unit_price,order_date,channel\n"
    for i in (1, 2):
        _write(f"{tmp_dir}/in{i}/f.csv", header + f"O00010{i},C0001,SKU0001,1,2.00,2024-05-01,retail\n")
        intake_stream.start(spark, f"{tmp_dir}/in{i}", published, f"{tmp_dir}/intake", f"{tmp_dir}/ckpt{i}",
                            INTAKE_AS_OF).awaitTermination(120)
    got = spark.read.parquet(f"{tmp_dir}/intake/accepted")
    assert sorted(r["order_id"] for r in got.collect()) == ["O000101", "O000102"]
    good = ("O5", "C1", "S1", "1", "1", "2024-05-01", "retail")
    append_batch(spark, _form(spark, good), "b1", published, tmp_dir, INTAKE_AS_OF)
    append_batch(spark, _form(spark, (*good[:3], "0", *good[4:])), "b1", published, tmp_dir, INTAKE_AS_OF)
    assert spark.read.parquet(f"{tmp_dir}/accepted").count() == 0


def test_sums_beyond_64_bits(spark):
    line = spark.range(4).selectExpr(
        "CAST(id AS STRING) AS order_id", "'C' AS customer_id", "'S' AS sku", "2000000000 AS quantity",
        "4000000000L AS price_cents", "DATE'2024-01-01' AS order_date", "'retail' AS channel")
    products = spark.sql("SELECT 'S' AS sku, 'a' AS category, 4000000000L AS cost_cents, true AS active")
    want = 4 * 2e9 * 4e9 / 100
    assert kpis.kpi_total_sales(line).first()[0] == want == totals.total_sales(line).first()[0]
    assert kpis.kpi_total_margin(line, products).first()[0] == 0.0 == totals.total_margin(line, products).first()[0]
    assert kpis.sales_by_month(line).first()["ventas"] == want == totals.by_month(line).first()["ventas"]


def test_totals_equal_the_filled_rows(spark):
    """NULL skus, a sku without any price, ties, NULL ids and an empty table."""
    rows = [(f"O{i}", f"C{i % 3}", [None, "S1", "S2", "S3"][i % 4], 1 + i % 5,
             None if i % 4 == 3 or i % 3 == 0 else 7 * i, None, ["retail", "export"][i % 2]) for i in range(40)]
    s = spark.createDataFrame([*rows, (None, "C1", "S1", 2, None, None, None)], ORDERS).withColumn(
        "order_date", F.date_add(F.lit("2024-01-20").cast("date"), (F.col("quantity") * 9).cast("int")))
    products = spark.createDataFrame([("S1", "a", 5, True), ("S2", "b", None, True)],
                                     "sku string, category string, cost_cents bigint, active boolean")
    for frame in (s, s.limit(0)):
        filled = clean.impute_prices(frame)
        for slow, fast in ((kpis.kpi_total_sales(filled), totals.total_sales(frame)),
                           (kpis.kpi_total_margin(filled, products), totals.total_margin(frame, products)),
                           (kpis.kpi_avg_ticket(filled), totals.average_ticket(frame)),
                           (kpis.kpi_panel(filled), totals.panel(frame)),
                           (serving.kpi_panel_display(filled, products), totals.panel_display(frame, products)),
                           (kpis.sales_by_month(filled), totals.by_month(frame)),
                           (kpis.sales_by_channel(filled), totals.by_channel(frame)),
                           (kpis.margin_by_category(filled, products), totals.by_category(frame, products))):
            assert slow.collect() == fast.select(*slow.columns).collect()


def test_quartiles_do_not_hang_on_exchange_reuse(spark):
    df = spark.range(20000).selectExpr("(id * 7919) % 10007 AS v")
    want = tuple(df.selectExpr("percentile(v, array(0.25, 0.5, 0.75)) AS p").first()["p"])
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        for _ in range(2):
            assert tuple(profile.exact_quantiles(df, "v", [0.25, 0.5, 0.75], 16).first()) == want
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
