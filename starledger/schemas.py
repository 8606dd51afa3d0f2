"""Column lists and schemas of the raw and clean tables.

Raw tables carry ``seq``: the position of a row in its source, used by the
keep-first deduplication (a CSV scan fills it with (file, split, row); the
fixture with a row number per key). Money is integer cents.
"""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMER_COLS = ["customer_id", "name", "country", "segment", "created_at"]
PRODUCT_COLS = ["sku", "category", "cost_cents", "active"]
ORDER_COLS = ["order_id", "customer_id", "sku", "quantity", "price_cents",
              "order_date", "channel"]

# The defaults the cleaning step writes into missing cells.
UNKNOWN = "Unknown"
UNCATEGORIZED = "Uncategorized"
# Fixed value: report label for facts whose product is not in the catalogue.
NO_CATEGORY_LABEL = "Sin Categoría"
# The channel domain of the order form.
CHANNELS = ["retail", "ecommerce", "wholesale", "export"]

# Text schemas of the CSV sources (every column read as text, typed after
# missing-value tokens are mapped; never schema inference).
CUSTOMERS_CSV = T.StructType([T.StructField(c, T.StringType()) for c in
                              ["customer_id", "name", "country", "segment", "created_at"]])
PRODUCTS_CSV = T.StructType([T.StructField(c, T.StringType()) for c in
                             ["sku", "category", "cost", "active"]])
ORDERS_CSV = T.StructType([T.StructField(c, T.StringType()) for c in
                           ["order_id", "customer_id", "sku", "quantity", "unit_price",
                            "order_date", "channel"]])
# Intake batches arrive as text, like a submitted form.
INTAKE_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in
                            ["order_id", "customer_id", "sku", "quantity", "unit_price",
                             "order_date", "channel"]] + [T.StructField("seq", T.LongType())])
