"""The CSV path (text scan, NA tokens, cents, file-order keep-first) gives the
same clean tables as the fixture path on the same rows."""

from pyspark.sql import functions as F

from oracle_compare import SF_SMALL
from starledger.plans.model import clean_model
from starledger.sources.csv import load_raw_csv
from starledger.sources.fixtures import raw_tables


def _money_text(cents):
    return F.when(cents.isNull(), F.lit("")).otherwise(
        F.concat(F.when(cents < 0, F.lit("-")).otherwise(F.lit("")),
                 F.call_function("div", F.abs(cents), F.lit(100)).cast("string"), F.lit("."),
                 F.lpad((F.abs(cents) % 100).cast("string"), 2, "0")))


def _write(df, path, order):
    (df.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("emptyValue", "").csv(path))


def test_csv_source_matches_fixture_path(spark, tmp_dir):
    raw = raw_tables(spark, SF_SMALL)
    _write(raw.customers.select(F.col("customer_id").cast("string"), "name", "country", "segment",
                                "created_at", "seq"), f"{tmp_dir}/c", ["customer_id", "seq"])
    _write(raw.products.select(F.col("sku").cast("string"), "category",
                               _money_text(F.col("cost_cents")).alias("cost"),
                               F.when(F.col("active"), "True").otherwise("False").alias("active"), "seq"),
           f"{tmp_dir}/p", ["sku", "seq"])
    _write(raw.orders.select("order_id", F.col("customer_id").cast("string"), F.col("sku").cast("string"),
                             F.col("quantity").cast("string"),
                             _money_text(F.col("price_cents")).alias("unit_price"),
                             "order_date", "channel", "seq"), f"{tmp_dir}/o", ["order_id", "seq"])
    # one CSV file per table, named as the source expects (without the seq column)
    import glob
    import shutil
    for short, name in (("c", "customers"), ("p", "products"), ("o", "orders")):
        part = glob.glob(f"{tmp_dir}/{short}/part-*.csv")[0]
        with open(part, encoding="utf-8") as src, open(f"{tmp_dir}/{name}.csv", "w", encoding="utf-8") as dst:
            for line in src:
                dst.write(line.rstrip("\n").rsplit(",", 1)[0] + "\n")
        shutil.rmtree(f"{tmp_dir}/{short}")
    via_csv = clean_model(load_raw_csv(spark, tmp_dir))
    via_fixture = clean_model(raw)

    def same(a, b):
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    ids = {"customer_id": "string", "sku": "string"}
    fx_orders = via_fixture.orders.withColumns({k: F.col(k).cast(v) for k, v in ids.items()})
    assert same(via_csv.orders, fx_orders.select(*via_csv.orders.columns))
    fx_customers = via_fixture.customers.withColumn("customer_id", F.col("customer_id").cast("string"))
    assert same(via_csv.customers, fx_customers)
    fx_products = via_fixture.products.withColumn("sku", F.col("sku").cast("string"))
    assert same(via_csv.products, fx_products)
