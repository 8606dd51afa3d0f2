"""Hand-made rows, one per semantic trap of the cleaning and reports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starledger.operators import clean as C
from starledger.operators import kpis as K
from starledger.operators import profile as P
from starledger.operators import serving as A
from starledger.operators.dedup import first_flag, keep_first

ORDERS_SCHEMA = ("order_id string, customer_id bigint, sku bigint, quantity int, price_cents bigint, "
                 "order_date string, channel string, seq bigint")


def orders(spark, rows):
    return spark.createDataFrame(rows, ORDERS_SCHEMA)


def by_id(df):
    return {r["order_id"]: r for r in df.collect()}


def test_dedup_runs_before_filters_bad_first_copy_wins(spark):
    # The first copy has a bad date; the later good copy must not survive.
    df = orders(spark, [("O1", 1, 1, 2, 100, "2025-13-40", "retail", 1),
                        ("O1", 1, 1, 2, 100, "2024-01-02", "retail", 2),
                        ("O2", 1, 1, 3, 100, "2024-01-02", "retail", 1)])
    out = by_id(C.clean_orders(df))
    assert set(out) == {"O2"}


def test_keep_first_follows_order_not_arrival(spark):
    df = orders(spark, [("O1", 1, 1, 9, 100, "2024-01-02", "x", 2),
                        ("O1", 1, 1, 1, 100, "2024-01-02", "x", 1)]).repartition(3)
    assert keep_first(df, ["order_id"]).first()["quantity"] == 1


def test_null_keys_are_one_group(spark):
    df = orders(spark, [(None, 1, 1, 1, 100, "2024-01-02", "x", 1),
                        (None, 1, 1, 2, 100, "2024-01-02", "x", 2)])
    assert C.dedup_orders(df).count() == 1
    assert P.duplicate_profile(df, "orders", "order_id").first()["duplicados"] == 1


def test_channel_strip_handles_tab_and_nbsp(spark):
    df = orders(spark, [("O1", 1, 1, 1, 100, "2024-01-02", "\tRetail ", 1),
                        ("O2", 1, 1, 1, 100, "2024-01-02", " ECOMMERCE ", 1)])
    assert {r["channel"] for r in C.clean_orders(df).collect()} == {"retail", "ecommerce"}


def test_null_quantity_dropped_by_clean_but_kept_by_drop_impact(spark):
    df = orders(spark, [("O1", 1, 1, None, 100, "2024-01-02", "x", 1),
                        ("O2", 1, 1, 1, 100, "2024-01-02", "x", 1)])
    assert C.clean_orders(df).count() == 1
    assert P.drop_impact(df).first()["filas_resultantes"] == 2


def test_sku_mean_over_survivors_then_global_mean(spark):
    # sku 1: known 100 and 103 among survivors (the 1000 row is dropped by
    # its date) -> mean 101.5 -> half-even 102. sku 2 has no known price ->
    # global mean of the filled column (100 + 103 + 101.5) / 3 = 101.5 -> 102.
    df = orders(spark, [("O1", 1, 1, 1, 100, "2024-01-02", "x", 1),
                        ("O2", 1, 1, 1, 103, "2024-01-02", "x", 1),
                        ("O3", 1, 1, 1, None, "2024-01-02", "x", 1),
                        ("O4", 1, 1, 1, 1000, "bad", "x", 1),
                        ("O5", 1, 2, 1, None, "2024-01-02", "x", 1)])
    out = by_id(C.clean_orders(df))
    assert out["O3"]["price_cents"] == 102
    assert out["O5"]["price_cents"] == 102


def test_half_even_rounding_of_the_mean(spark):
    # 12 and 13 -> 12.5 -> 12 (even); 13 and 14 -> 13.5 -> 14.
    df = orders(spark, [("A1", 1, 1, 1, 12, "2024-01-02", "x", 1),
                        ("A2", 1, 1, 1, 13, "2024-01-02", "x", 1),
                        ("A3", 1, 1, 1, None, "2024-01-02", "x", 1),
                        ("B1", 1, 2, 1, 13, "2024-01-02", "x", 1),
                        ("B2", 1, 2, 1, 14, "2024-01-02", "x", 1),
                        ("B3", 1, 2, 1, None, "2024-01-02", "x", 1)])
    out = by_id(C.clean_orders(df))
    assert out["A3"]["price_cents"] == 12
    assert out["B3"]["price_cents"] == 14


def test_null_sku_is_not_a_price_group(spark):
    df = orders(spark, [("O1", 1, None, 1, 500, "2024-01-02", "x", 1),
                        ("O2", 1, None, 1, None, "2024-01-02", "x", 1),
                        ("O3", 1, 7, 1, 100, "2024-01-02", "x", 1)])
    out = by_id(C.clean_orders(df))
    assert out["O2"]["price_cents"] == 300  # global mean (500 + 100) / 2


def test_unpadded_date_is_invalid(spark):
    df = orders(spark, [("O1", 1, 1, 1, 100, "2025-1-5", "x", 1)])
    assert C.clean_orders(df).count() == 0


def test_empty_tables(spark):
    df = orders(spark, [])
    assert C.clean_orders(df).count() == 0
    k = K.kpi_avg_ticket(df).first()
    assert k["ventas_totales"] is None and k["numero_pedidos"] == 0 and k["ticket_promedio"] is None
    panel = A.kpi_panel_display(df, spark.createDataFrame([], "sku bigint, category string, "
                                                             "cost_cents bigint, active boolean")).first()
    assert panel["ventas_totales"] == 0.0 and panel["num_pedidos"] == 0


def test_ticket_rounds_half_away_from_zero(spark):
    # 1 order of 1 x 0.05 and 1 order of 1 x 0.00 -> 0.025 -> 0.03
    df = spark.createDataFrame([("O1", 1, 1, 1, 5, dt.date(2024, 1, 1), "retail"),
                                ("O2", 1, 1, 1, 0, dt.date(2024, 1, 1), "retail")],
                               "order_id string, customer_id bigint, sku bigint, quantity int, "
                               "price_cents bigint, order_date date, channel string")
    assert K.kpi_avg_ticket(df).first()["ticket_promedio"] == 0.03


def test_category_label_after_grouping(spark):
    # An orphan sku (NULL category) and a real 'Sin Categoría' stay two rows.
    o = spark.createDataFrame([("O1", 1, 1, 1, 100, dt.date(2024, 1, 1), "retail"),
                               ("O2", 1, 9, 1, 100, dt.date(2024, 1, 1), "retail")],
                              "order_id string, customer_id bigint, sku bigint, quantity int, "
                              "price_cents bigint, order_date date, channel string")
    p = spark.createDataFrame([(1, "Sin Categoría", 50, True)],
                              "sku bigint, category string, cost_cents bigint, active boolean")
    rows = K.margin_by_category(o, p).collect()
    assert [r["categoria"] for r in rows].count("Sin Categoría") == 2
    assert sorted(r["pct_margen"] for r in rows) == [50.0, 100.0]


def test_next_order_id_is_numeric_past_six_digits(spark):
    o = spark.createDataFrame([("O999999",), ("O1000000",), ("X5",)], "order_id string")
    assert A.next_order_id(o).first()["next_order_id"] == "O1000001"


def test_first_flag_keeps_every_row(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5), (None, 3), (None, 4)], "k string, seq int")
    out = {(r["k"], r["seq"]): r["is_first"] for r in first_flag(df, ["k"]).collect()}
    assert out == {("a", 1): True, ("a", 2): False, ("b", 5): True, (None, 3): True, (None, 4): False}


def test_strict_customer_date_aborts(spark):
    df = spark.createDataFrame([("C1", "n", None, None, "2024-02-30", 1)],
                               "customer_id string, name string, country string, segment string, "
                               "created_at string, seq bigint")
    with pytest.raises(Exception):
        C.clean_customers(df).collect()


def test_customer_defaults_and_product_sign(spark):
    c = spark.createDataFrame([("C1", "n", None, None, "2024-02-03", 1)],
                              "customer_id string, name string, country string, segment string, "
                              "created_at string, seq bigint")
    r = C.clean_customers(c).first()
    assert (r["country"], r["segment"], r["created_at"]) == ("Unknown", "Unknown", dt.date(2024, 2, 3))
    p = spark.createDataFrame([(1, None, -694, False, 1)],
                              "sku bigint, category string, cost_cents bigint, active boolean, seq bigint")
    r = C.clean_products(p).first()
    assert (r["category"], r["cost_cents"], r["active"]) == ("Uncategorized", 694, False)


def test_clean_is_idempotent(spark):
    df = orders(spark, [("O1", 1, 1, 2, 150, "2024-01-02", " Retail ", 1),
                        ("O2", 1, 2, 3, None, "2024-01-03", "EXPORT", 1)])
    once = C.clean_orders(df)
    again = C.clean_orders(once.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))
                               .withColumn("seq", F.lit(1).cast("bigint")))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))


def test_distributed_quantiles_equal_percentile(spark):
    import random
    from starledger.operators.profile import exact_quantiles
    rnd = random.Random(7)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    for n in (1, 2, 9, 300):
        vals = [(rnd.choice([rnd.randint(-3, 3), rnd.randint(0, 10 ** 6)]),) for _ in range(n)] + [(None,)]
        df = spark.createDataFrame(vals, "x long")
        mine = exact_quantiles(df, "x", probs, partitions=5).first()
        ref = df.agg(F.percentile("x", probs)).first()[0]
        assert [mine[f"q{i}"] for i in range(len(probs))] == ref
    empty = spark.createDataFrame([(None,)], "x long")
    assert exact_quantiles(empty, "x", [0.5]).first()["q0"] is None


def test_zero_padding_never_truncates(spark):
    from starledger.sources.fixtures import _zero_padded
    df = spark.createDataFrame([(7,), (123456789,), (98765432101,)], "k long")
    got = [r[0] for r in df.select(_zero_padded("O", F.col("k"))).collect()]
    assert got == ["O000000007", "O123456789", "O98765432101"]


def test_describe_keeps_a_column_without_values(spark):
    df = spark.createDataFrame([(1, None), (3, None)], "a long, b long")
    rows = {r["campo"]: r for r in P.describe_numeric(df, "t", ["a", "b"]).collect()}
    assert rows["b"]["count"] == 0 and rows["b"]["mean"] is None
    assert rows["a"]["count"] == 2 and rows["a"]["mean"] == 2.0 and rows["a"]["p50"] == 2.0


def test_schema_listing_and_head(spark):
    df = spark.createDataFrame([("b", 2, 1), ("a", 1, 2)], "k string, v int, seq long")
    assert P.schema_listing(df, "t") == [("t", "k", "string"), ("t", "v", "int")]
    assert [r["k"] for r in P.head(df, ["seq"], 1).collect()] == ["b"]
