"""Order intake (I1-I6, I8): validate submitted order rows, reject with every
reason joined by ' | ', accept the rest once per order id, never an id that
the fact table already has.

A batch is text columns like a submitted form (order_id, customer_id, sku,
quantity, unit_price, order_date, channel) plus ``seq``, the submission
order (any orderable column, unique within an order id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.functions.text import blank_to_null
from starledger.operators.dedup import keep_first
from starledger.operators.joins import broadcast_if_small, fits_broadcast
from starledger.schemas import CHANNELS
from starledger.session import materialize

# Rejection messages, in rule order. The first six are the
# order form's own texts; the cast and format messages name the failing
# field, where the form showed the parser's exception text.
MSG_ID_REQUIRED = "Order ID es requerido"
MSG_QTY_INVALID = "Cantidad inválida"
MSG_QTY_POSITIVE = "Cantidad debe ser mayor a 0"
MSG_PRICE_INVALID = "Precio unitario inválido"
MSG_PRICE_POSITIVE = "Precio unitario debe ser mayor a 0"
MSG_DATE_REQUIRED = "Fecha es requerida"
MSG_DATE_INVALID = "Fecha inválida"
MSG_DATE_FUTURE = "La fecha no puede ser futura"
MSG_CUSTOMER_ID = "Cliente inválido"
MSG_SKU = "Producto inválido"
MSG_EXISTS = "Order ID ya existe"
MSG_REPEATED = "Order ID repetido en el lote"
# Strict (form-side) rules.
MSG_ID_FORMAT = "Formato de Order ID inválido"
MSG_CUSTOMER = "Cliente inexistente"
MSG_PRODUCT = "Producto inexistente o inactivo"
MSG_CHANNEL = "Canal inválido"
ORDER_ID_PATTERN = r"^O[0-9]{6}$"


def form_day(c: Column) -> Column:
    """A submitted date: year, month and day, the last two with or without a
    leading zero."""
    return F.when(c.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"),
                  F.try_to_timestamp(c, F.lit("yyyy-M-d")).cast("date"))


def typed(batch: DataFrame, id_types: dict[str, str] | None = None) -> DataFrame:
    """Trimmed id and typed values (NULL where a cast fails; the rules
    reject such rows). ``id_types`` are the fact's types of customer_id and
    sku; text where it has none.

    Keeps the trimmed texts (blank as NULL) that the rules need."""
    types = id_types or {}
    texts = ["order_id", "customer_id", "sku", "quantity", "unit_price", "order_date"]
    # Two steps: each text is trimmed once, however often it is looked at.
    t = batch.select(*[blank_to_null(F.col(c)).alias(c) for c in texts], "channel", "seq")
    return t.select(
        "order_id", F.col("customer_id").alias("_customer_text"), F.col("sku").alias("_sku_text"),
        F.col("customer_id").try_cast(types.get("customer_id", "string")).alias("customer_id"),
        F.col("sku").try_cast(types.get("sku", "string")).alias("sku"),
        F.col("quantity").try_cast("int").alias("quantity"),
        F.rint(F.col("unit_price").try_cast("double") * 100).try_cast("bigint").alias("price_cents"),
        F.col("order_date").alias("_date_text"), form_day(F.col("order_date")).alias("order_date"),
        "channel", "seq")


def row_errors(as_of_date: str) -> list[Column]:
    """I1, I3, I4 on a ``typed`` frame: one nullable message per rule."""
    return [
        F.when(F.col("order_id").isNull(), F.lit(MSG_ID_REQUIRED)),
        F.when(F.col("_customer_text").isNotNull() & F.col("customer_id").isNull(), F.lit(MSG_CUSTOMER_ID)),
        F.when(F.col("_sku_text").isNotNull() & F.col("sku").isNull(), F.lit(MSG_SKU)),
        F.when(F.col("quantity").isNull(), F.lit(MSG_QTY_INVALID))
         .when(F.col("quantity") <= 0, F.lit(MSG_QTY_POSITIVE)),
        F.when(F.col("price_cents").isNull(), F.lit(MSG_PRICE_INVALID))
         .when(F.col("price_cents") <= 0, F.lit(MSG_PRICE_POSITIVE)),
        F.when(F.col("_date_text").isNull(), F.lit(MSG_DATE_REQUIRED))
         .when(F.col("order_date").isNull(), F.lit(MSG_DATE_INVALID))
         .when(F.col("order_date") > F.lit(as_of_date).cast("date"), F.lit(MSG_DATE_FUTURE)),
    ]


def strict_errors(customers: DataFrame, products: DataFrame) -> tuple[list[Column], list]:
    """I8: form-side rules (id pattern, known customer, active product,
    channel domain). Returns the rule columns and the lookups to join."""
    rules = [
        F.when(F.col("order_id").isNotNull() & ~F.col("order_id").rlike(ORDER_ID_PATTERN),
               F.lit(MSG_ID_FORMAT)),
        F.when(F.col("_known_customer").isNull(), F.lit(MSG_CUSTOMER)),
        F.when(F.col("_active_product").isNull(), F.lit(MSG_PRODUCT)),
        F.when(~F.coalesce(F.col("channel").isin(CHANNELS), F.lit(False)), F.lit(MSG_CHANNEL)),
    ]
    known = customers.select(F.col("customer_id").alias("_kc_id")).distinct() \
                     .withColumn("_known_customer", F.lit(True))
    active = products.filter(F.col("active")).select(F.col("sku").alias("_ap_sku")).distinct() \
                     .withColumn("_active_product", F.lit(True))
    return rules, [(known, "customer_id", "_kc_id"), (active, "sku", "_ap_sku")]


def with_row_errors(batch: DataFrame, as_of_date: str, customers: DataFrame | None = None, products: DataFrame | None = None,
                    strict: bool = False, id_types: dict[str, str] | None = None) -> DataFrame:
    """The typed rows with ``_row_errors``, the messages of all
    rules that look at one row alone ('' if none). Works on a stream too."""
    t = typed(batch, id_types)
    rules = row_errors(as_of_date)
    if strict:
        if customers is None or products is None:
            raise ValueError("strict intake needs customers and products")
        extra, lookups = strict_errors(customers, products)
        # The joins carry whether a text was there, not the text.
        t = t.withColumns({c: F.when(F.col(c).isNotNull(), F.lit("")) for c in ("_customer_text", "_sku_text", "_date_text")})
        for lookup, col, key in lookups:
            lookup = broadcast_if_small(lookup)
            t = t.join(lookup, t[col] == lookup[key].cast(t.schema[col].dataType), "left").drop(key)
        rules = rules[:1] + extra + rules[1:]
    return t.select("order_id", "customer_id", "sku", "quantity", "price_cents", "order_date",
                    "channel", "seq", F.concat_ws(" | ", *rules).alias("_row_errors"))


def validate(batch: DataFrame, facts: DataFrame, as_of_date: str,
             customers: DataFrame | None = None, products: DataFrame | None = None,
             strict: bool = False, id_types: dict[str, str] | None = None) -> DataFrame:
    """I5 + I6: every batch row with ``estado`` ('aceptado' / 'rechazado') and
    ``errores`` (all messages of the row, ' | '-joined, in rule order).

    A row without row errors is accepted if it is the first such row of its
    order id in the batch and the id is not in ``facts``. Customer and product
    ids keep the fact's types (``id_types``, else those of ``facts``). The
    first position per id (limited before the shuffle) is joined back on
    (id, seq), so a hot id never lands in a single task.
    """
    types = id_types if id_types is not None else dict(facts.dtypes)
    # The typed batch feeds two branches (first positions, join back); it is
    # written once to the checkpoint folder instead of derived twice.
    t = materialize(with_row_errors(batch, as_of_date, customers, products, strict, types))
    good = t.filter(F.col("_row_errors") == "")
    # First submission of each id among the rows without errors, flagged when
    # the fact already has the id.
    firsts = keep_first(good.select("order_id", "seq"), ["order_id"]).select(
        "order_id", F.col("seq").alias("_fseq"))
    # A batch whose measured ids are small enough to broadcast looks up only
    # its own ids: the fact's id column is scanned and
    # semi-joined, not shuffled. A larger batch joins the fact's distinct ids.
    fact_ids = facts.select(F.col("order_id").alias("_eid"))
    batch_ids = firsts.select(F.col("order_id").alias("_bid"))
    if fits_broadcast(t.select("order_id")):
        fact_ids = fact_ids.join(F.broadcast(batch_ids), F.col("_eid") == F.col("_bid"), "left_semi")
    existing = fact_ids.distinct().withColumn("_exists", F.lit(True))
    firsts = firsts.join(existing, firsts["order_id"] == existing["_eid"], "left").select(
        F.col("order_id").alias("_fid"), "_fseq", F.coalesce("_exists", F.lit(False)).alias("_exists"))
    # Joined back on (id, position): a hot id spreads over many tasks. Rows
    # with errors of their own need no look-up and are not shuffled.
    looked_up = good.join(firsts, (good["order_id"] == firsts["_fid"]) & (good["seq"] == firsts["_fseq"]), "left")
    columns = ["order_id", "customer_id", "sku", "quantity", "price_cents", "order_date", "channel", "seq"]
    errores = F.when(F.col("_fid").isNull(), F.lit(MSG_REPEATED)).when(F.col("_exists"), F.lit(MSG_EXISTS))
    checked = looked_up.select(*columns, errores.alias("errores")).unionByName(
        t.filter(F.col("_row_errors") != "").select(*columns, F.col("_row_errors").alias("errores")))
    return checked.select(
        *columns, F.when(F.col("errores").isNull(), F.lit("aceptado")).otherwise(F.lit("rechazado")).alias("estado"), "errores")


def accepted(validated: DataFrame) -> DataFrame:
    """Rows to append to the fact (fact columns)."""
    return validated.filter(F.col("estado") == "aceptado").select(
        "order_id", "customer_id", "sku", "quantity", "price_cents", "order_date", "channel")


def rejected(validated: DataFrame) -> DataFrame:
    """Rejected rows with their reasons."""
    return validated.filter(F.col("estado") == "rechazado").select("order_id", "seq", "errores")
