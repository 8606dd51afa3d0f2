"""A hot key (a third of all rows) gives the same result as a brute-force
pandas implementation of the cleaning steps."""

import numpy as np
import pandas as pd

from starledger.operators import clean as C
from starledger.operators import kpis as K


def _raw(n=30000, seed=3):
    rng = np.random.default_rng(seed)
    i = np.arange(n)
    sku = np.where(i % 3 == 0, 1, rng.integers(2, 400, n))            # sku 1: a third of rows
    price = rng.integers(100, 5000, n).astype("float64")
    price[rng.random(n) < 0.15] = np.nan
    price[(sku >= 390)] = np.nan                                          # skus without any price
    qty = rng.integers(-2, 20, n)
    day = rng.integers(1, 32, n)
    date = np.where(day > 28, "2024-02-" + day.astype(str), "2024-01-" + np.char.zfill(day.astype(str), 2))
    order = np.where(i % 5 == 0, "O000007", np.char.add("O", np.char.zfill((i % 9000).astype(str), 6)))
    chan = rng.choice([" Retail", "retail ", "EXPORT", "\tWholesale"], n)
    return pd.DataFrame({"order_id": order, "customer_id": rng.integers(1, 50, n), "sku": sku,
                         "quantity": qty.astype("int32"), "price_cents": price, "order_date": date,
                         "channel": chan, "seq": rng.permutation(n)})


def _brute(df):
    d = df.sort_values("seq").drop_duplicates("order_id", keep="first").copy()
    d["order_date"] = pd.to_datetime(d["order_date"], format="%Y-%m-%d", errors="coerce")
    d = d.dropna(subset=["order_date"])
    d = d[d["quantity"] > 0].copy()
    d["price_cents"] = d["price_cents"].fillna(d.groupby("sku")["price_cents"].transform("mean"))
    d["price_cents"] = d["price_cents"].fillna(d["price_cents"].mean())
    d["price_cents"] = np.rint(d["price_cents"]).astype("int64")
    d["channel"] = d["channel"].str.lower().str.strip()
    d["order_date"] = d["order_date"].dt.date
    return d[["order_id", "customer_id", "sku", "quantity", "price_cents", "order_date", "channel"]]


def test_clean_orders_with_hot_keys_matches_brute_force(spark):
    raw = _raw()
    rows = [(r.order_id, int(r.customer_id), int(r.sku), int(r.quantity),
             None if np.isnan(r.price_cents) else int(r.price_cents), r.order_date, r.channel, int(r.seq))
            for r in raw.itertuples(index=False)]
    sdf = spark.createDataFrame(rows,
                                "order_id string, customer_id long, sku long, quantity int, "
                                "price_cents long, order_date string, channel string, seq long")
    got = C.clean_orders(sdf.repartition(6)).toPandas().sort_values("order_id").reset_index(drop=True)
    want = _brute(raw).sort_values("order_id").reset_index(drop=True)
    assert len(got) == len(want)
    for col in want.columns:
        assert list(got[col]) == list(want[col]), col
    total = K.kpi_total_sales(C.clean_orders(sdf)).first()["ventas_totales"]
    assert total == float((want["quantity"].astype("int64") * want["price_cents"]).sum()) / 100.0
