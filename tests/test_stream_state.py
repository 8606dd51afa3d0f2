"""Uniqueness in streaming state: restarts in mid-stream against the batch job."""

import os

from pyspark.sql import functions as F

from starledger.operators.intake import validate
from starledger.plans.id_index import index_published
from starledger.plans.intake_job import append_batch
from starledger.schemas import INTAKE_TEXT
from starledger.sources.fixtures import INTAKE_AS_OF
from starledger.streaming import intake_stream, unique_stream

HEADER = "order_id,customer_id,sku,quantity,unit_price,order_date,channel\n"
FILES = [
    ["O1,1,2,x,10.50,2024-05-01,retail", "O1,1,2,3,10.50,2024-05-01,retail", "O1,1,2,4,10.50,2024-05-01,retail", "P1,1,2,3,1,2024-05-01,retail"],
    ["O1,1,2,5,10.50,2024-05-01,retail", "O2,1,9,5,10.50,2024-05-01,\" say \"\"hi\"\" \"", ",1,2,5,0,,retail", " ,1,2,5,0,,retail"],
    ["O3,1,2,5,10.50,2024-5-1,retail", "O2,1,2,6,1,2024-05-01,retail", "P1,1,2,7,1,2024-05-01,retail", "O4,abc,2,7,1,2024-05-01,retail"],
    ["O4,1,2,7,1,2024-05-01,retail", "O3,1,2,7,1,2030-05-01,retail", "O5,1,,9000000,1.005,2024-05-01,"] + [f"H,1,2,{i},1,2024-05-01,retail" for i in range(40)],
]
TYPES = {"customer_id": "bigint", "sku": "bigint"}
SHOWN = ["order_id", "customer_id", "sku", "quantity", "price_cents", "order_date", "channel", "estado", "errores"]


def write(folder, i):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/f{i}.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEADER + "\n".join(FILES[i]) + "\n")
    os.utime(path, (1_700_000_000 + i,) * 2)


def batch_rows(spark, folder, existing):
    fields = [f for f in INTAKE_TEXT.fields if f.name != "seq"]
    df = (spark.read.schema(type(INTAKE_TEXT)(fields)).option("header", True).option("escape", '"').csv(folder)
          .withColumn("seq", F.struct(F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("r"))))
    return sorted(map(str, validate(df.coalesce(1), existing, INTAKE_AS_OF, id_types=TYPES).select(*SHOWN).collect()))


def stream_rows(spark, out):
    return sorted(map(str, spark.read.parquet(out).select(*SHOWN).collect()))


def test_a_stream_restarted_between_files_equals_the_batch(spark, tmp_dir):
    existing = spark.createDataFrame([("P1",), (None,)], "order_id string")
    src, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    for i in range(len(FILES)):  # each start recovers state and offsets from the checkpoint
        write(src, i)
        unique_stream.start(spark, src, existing, out, ckpt, INTAKE_AS_OF, id_types=TYPES).awaitTermination(120)
        assert stream_rows(spark, out) == batch_rows(spark, src, existing)
    accepted = spark.read.parquet(out).filter("estado = 'aceptado'")
    assert sorted(r.order_id for r in accepted.collect()) == ["H", "O1", "O2", "O3", "O4", "O5"]
    assert accepted.filter("order_id = 'H'").first().quantity == 1  # the row with quantity 0 is faulty


def test_a_stream_killed_in_mid_stream_equals_the_batch(spark, tmp_dir):
    existing = spark.createDataFrame([("P1",)], "order_id string")
    src, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    for i in range(len(FILES)):
        write(src, i)
    query = unique_stream.start(spark, src, existing, out, ckpt, INTAKE_AS_OF, id_types=TYPES, files_at_once=1)
    while query.isActive and not query.recentProgress:
        query.awaitTermination(1)
    query.stop()
    assert os.path.exists(f"{ckpt}/offsets/0")
    # a micro-batch that was planned but not committed is run again
    commits = sorted((c for c in os.listdir(f"{ckpt}/commits") if c.isdigit()), key=int)
    if commits:
        os.remove(f"{ckpt}/commits/{commits[-1]}")
        for name in os.listdir(f"{ckpt}/commits"):
            if name.startswith(f".{commits[-1]}."):
                os.remove(f"{ckpt}/commits/{name}")
    unique_stream.start(spark, src, existing, out, ckpt, INTAKE_AS_OF, id_types=TYPES, files_at_once=1).awaitTermination(120)
    assert stream_rows(spark, out) == batch_rows(spark, src, existing)


def test_indexed_intake_equals_the_scan_and_survives_retries(spark, tmp_dir):
    fact = spark.createDataFrame([("O000001", 1, 2)], "order_id string, customer_id bigint, sku bigint")
    index = index_published(spark, fact, f"{tmp_dir}/ids", "r1")
    schema = "order_id string, customer_id string, sku string, quantity string, unit_price string, order_date string, channel string, seq long"
    first = spark.createDataFrame([(i, "1", "2", "3", "1.5", "2024-05-01", "retail", n) for n, i in enumerate(["O000001", " A ", "A", "", "B"])], schema)
    second = spark.createDataFrame([(i, "1", "2", "3", "1.5", "2024-05-01", "retail", n) for n, i in enumerate(["B", "C", "O000001"])], schema)
    for batch, name in ((first, "b1"), (first, "b1"), (second, "b2"), (second, "b2"), (first, "b1")):
        append_batch(spark, batch, name, fact, f"{tmp_dir}/scan", INTAKE_AS_OF)
        append_batch(spark, batch, name, fact, f"{tmp_dir}/indexed", INTAKE_AS_OF, index=index)
        for kind in ("accepted", "rejected"):
            a, b = (sorted(map(str, spark.read.parquet(f"{tmp_dir}/{way}/{kind}").collect())) for way in ("scan", "indexed"))
            assert a == b
    assert sorted(r.order_id for r in spark.read.parquet(f"{tmp_dir}/indexed/accepted").collect()) == ["A", "B", "C"]


def test_folder_stream_with_index(spark, tmp_dir):
    fact = spark.createDataFrame([("P1", 1, 2)], "order_id string, customer_id bigint, sku bigint")
    index = index_published(spark, fact, f"{tmp_dir}/ids", "r1")
    for i in range(2):
        write(f"{tmp_dir}/in", i)
        intake_stream.start(spark, f"{tmp_dir}/in", fact, f"{tmp_dir}/intake", f"{tmp_dir}/ckpt", INTAKE_AS_OF, index=index).awaitTermination(120)
    assert sorted((r.order_id, r.quantity) for r in spark.read.parquet(f"{tmp_dir}/intake/accepted").collect()) == [("O1", 3), ("O2", 5)]
    errors = [r.errores for r in spark.read.parquet(f"{tmp_dir}/intake/rejected").collect() if r.order_id in ("P1", "O1")]
    assert sorted(errors) == ["Cantidad inválida", "Order ID repetido en el lote", "Order ID ya existe", "Order ID ya existe"]
