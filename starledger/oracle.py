"""Independent SQL formulation of every checked query, for DuckDB.

The driver registers the parquet tables as views (lineitem, orders, customer,
nation, part, ...). Each text below rebuilds the raw tables by the same
fixture rules, cleans them and answers the query in plain SQL, so a Spark
result can be compared against it. Texts are assembled from named common
table expressions; only the ones a query needs are included.
"""

from __future__ import annotations

import re


def money(x: str) -> str:
    return f"(CAST({x} AS DOUBLE) / CAST(100 AS DOUBLE))"


def div_half_away(num: str, den: str) -> str:
    """Integer quotient rounded half away from zero; NULL for a zero divisor."""
    n = f"CAST({num} AS HUGEINT)"
    d = f"CAST({den} AS HUGEINT)"
    return (f"(CASE WHEN {d} IS NULL OR {d} = 0 THEN NULL "
            f"WHEN ({n} < 0) <> ({d} < 0) THEN -((2 * abs({n}) + abs({d})) // (2 * abs({d}))) "
            f"ELSE (2 * abs({n}) + abs({d})) // (2 * abs({d})) END)")


LINE = "(CAST(coalesce(quantity, 0) AS BIGINT) * coalesce(price_cents, 0))"

CTES: dict[str, str] = {}

CTES["orders_raw"] = r"""
SELECT printf('O%09d', l.l_orderkey * 10 + l.l_linenumber) AS order_id,
       o.o_custkey + CASE WHEN l.l_orderkey % 211 = 0 THEN 1000000 ELSE 0 END AS customer_id,
       l.l_partkey + CASE WHEN l.l_partkey % 193 = 0 THEN 1000000 ELSE 0 END AS sku,
       CAST(CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 7 THEN -l.l_quantity
                 WHEN l.l_quantity = 50 THEN 0 ELSE l.l_quantity END AS INTEGER) AS quantity,
       CASE WHEN l.l_discount = CAST(0.1 AS DOUBLE) OR l.l_partkey % 97 = 0 THEN NULL
            ELSE CAST(floor(l.l_extendedprice / l.l_quantity * 100) AS BIGINT) END AS price_cents,
       CASE WHEN l.l_tax = CAST(0.08 AS DOUBLE) AND l.l_linenumber = 1 THEN '2025-13-40'
            ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS order_date,
       CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN ' Retail ' WHEN '2' THEN 'ECOMMERCE'
            WHEN '3' THEN 'wholesale' WHEN '5' THEN 'Export' ELSE 'retail' END AS channel,
       CAST(row_number() OVER (PARTITION BY l.l_orderkey, l.l_linenumber
            ORDER BY l.l_shipdate, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_quantity,
                     l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus) AS BIGINT) AS seq
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

CTES["customers_base"] = r"""
SELECT c.c_custkey AS customer_id, c.c_name AS name,
       CASE WHEN c.c_custkey % 40 = 0 THEN NULL ELSE n.n_name END AS country,
       CASE WHEN c.c_custkey % 50 = 1 THEN NULL ELSE c.c_mktsegment END AS segment,
       strftime(CAST(DATE '2022-01-01' + CAST(c.c_custkey % 900 AS INTEGER) AS DATE), '%Y-%m-%d') AS created_at
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

CTES["customers_raw"] = r"""
SELECT customer_id, name, country, segment, created_at, CAST(1 AS BIGINT) AS seq FROM customers_base
UNION ALL
SELECT customer_id, name || '-dup', country, segment, created_at, CAST(2 AS BIGINT) FROM customers_base
WHERE customer_id % 100 = 0
"""

CTES["products_base"] = r"""
SELECT p_partkey AS sku,
       CASE WHEN p_partkey % 30 = 0 THEN NULL ELSE p_type END AS category,
       CASE WHEN p_partkey % 20 = 3 THEN -CAST(floor(p_retailprice * 60) AS BIGINT)
            ELSE CAST(floor(p_retailprice * 60) AS BIGINT) END AS cost_cents,
       p_size > 9 AS active
FROM part
"""

CTES["products_raw"] = r"""
SELECT sku, category, cost_cents, active, CAST(1 AS BIGINT) AS seq FROM products_base
UNION ALL
SELECT sku, category || '-dup', cost_cents, active, CAST(2 AS BIGINT) FROM products_base
WHERE sku % 100 = 0
"""

CTES["orders_dedup"] = r"""
SELECT * FROM orders_raw QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq) = 1
"""

CTES["orders_dated"] = r"""
SELECT order_id, customer_id, sku, quantity, price_cents,
       CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS order_date, channel
FROM orders_dedup WHERE try_strptime(order_date, '%Y-%m-%d') IS NOT NULL
"""

CTES["orders_valid"] = "SELECT * FROM orders_dated WHERE quantity > 0"

CTES["sku_mean"] = r"""
SELECT sku, count(*) AS n_rows, count(price_cents) AS n_priced,
       CAST(sum(price_cents) AS DOUBLE) / count(price_cents) AS m
FROM orders_valid WHERE sku IS NOT NULL GROUP BY sku HAVING count(price_cents) > 0
"""

CTES["orders_filled"] = r"""
SELECT v.*, coalesce(CAST(v.price_cents AS DOUBLE), s.m) AS p1
FROM orders_valid v LEFT JOIN sku_mean s ON v.sku = s.sku
"""

CTES["orders_clean"] = r"""
SELECT order_id, customer_id, sku, quantity,
       CAST(round_even(coalesce(p1, (SELECT avg(p1) FROM orders_filled)), 0) AS BIGINT) AS price_cents,
       order_date,
       regexp_replace(lower(channel), '^\s+|\s+$', '', 'g') AS channel
FROM orders_filled
"""

# the same orders as a CSV source with prices in tenths of a cent
CTES["csv_valid"] = r"""
SELECT order_id, customer_id, sku, quantity, order_date, channel,
       CAST(CAST(t // 1000 AS VARCHAR) || '.' || lpad(CAST(t % 1000 AS VARCHAR), 3, '0') AS DOUBLE) * 100 AS price
FROM (SELECT *, price_cents * 10 + CAST(substr(order_id, 2) AS BIGINT) % 10 AS t FROM orders_valid)
"""

CTES["csv_filled"] = r"""
SELECT v.*, coalesce(v.price, s.m) AS p1 FROM csv_valid v LEFT JOIN (
  SELECT sku, CAST(sum(CAST(price AS DECIMAL(28,8))) AS DOUBLE) / count(price) AS m
  FROM csv_valid WHERE sku IS NOT NULL GROUP BY sku HAVING count(price) > 0) s ON v.sku = s.sku
"""

CTES["customers_clean"] = r"""
SELECT customer_id, name, coalesce(country, 'Unknown') AS country,
       coalesce(segment, 'Unknown') AS segment,
       CAST(strptime(created_at, '%Y-%m-%d') AS DATE) AS created_at
FROM customers_raw QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY seq) = 1
"""

CTES["products_clean"] = r"""
SELECT sku, coalesce(category, 'Uncategorized') AS category, abs(cost_cents) AS cost_cents, active
FROM products_raw QUALIFY row_number() OVER (PARTITION BY sku ORDER BY seq) = 1
"""

CTES["sku_sales"] = f"""
SELECT sku, CAST(sum(coalesce(quantity, 0)) AS BIGINT) AS units, sum({LINE}) AS sales_cents
FROM orders_clean GROUP BY sku
"""

CTES["sku_margin_left"] = r"""
SELECT s.sku, s.units, s.sales_cents, p.category, p.cost_cents,
       s.sales_cents - s.units * coalesce(p.cost_cents, 0) AS margin_cents
FROM sku_sales s LEFT JOIN products_clean p ON s.sku = p.sku
"""


def _deps(text: str) -> list[str]:
    found = []
    for name in CTES:
        if re.search(rf"\b{name}\b", text):
            found.append(name)
    return found


def with_ctes(select: str) -> str:
    """Prefix ``select`` with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(name: str, seen: set[str]) -> None:
        if name in order or name in seen:
            return
        seen = seen | {name}
        for dep in _deps(CTES[name]):
            if dep != name:
                visit(dep, seen)
        order.append(name)

    for name in _deps(select):
        visit(name, set())
    if not order:
        return select.strip()
    body = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in order)
    return f"WITH {body}\n{select.strip()}"


ORACLE: dict[str, str] = {}


def oracle(name: str, select: str) -> None:
    ORACLE[name] = with_ctes(select)


# ---------------------------------------------------------------- cleaning
oracle("clean_customers", "SELECT * FROM customers_clean")
oracle("clean_products", f"SELECT sku, category, {money('cost_cents')} AS cost, active FROM products_clean")
oracle("clean_orders", f"""SELECT order_id, customer_id, sku, quantity, {money('price_cents')} AS unit_price,
                                  order_date, channel FROM orders_clean""")
oracle("csv_roundtrip", f"""SELECT order_id, customer_id, sku, quantity, {money('price_cents')} AS unit_price,
                                   order_date, channel FROM orders_clean""")
oracle("csv_clean_orders", rf"""
SELECT order_id, CAST(customer_id AS VARCHAR) AS customer_id, CAST(sku AS VARCHAR) AS sku, quantity,
       {money('CAST(round_even(coalesce(p1, (SELECT avg(p1) FROM csv_filled)), 0) AS BIGINT)')} AS unit_price,
       order_date, regexp_replace(lower(channel), '^\s+|\s+$', '', 'g') AS channel
FROM csv_filled""")
oracle("csv_roundtrip_customers", "SELECT * FROM customers_clean")
oracle("csv_roundtrip_products", f"SELECT sku, category, {money('cost_cents')} AS cost, active FROM products_clean")
oracle("dedup_customers",
       "SELECT * FROM customers_raw QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY seq) = 1")
oracle("dedup_products",
       "SELECT * FROM products_raw QUALIFY row_number() OVER (PARTITION BY sku ORDER BY seq) = 1")
oracle("dedup_orders", "SELECT * FROM orders_dedup")
oracle("valid_dates", "SELECT * FROM orders_dated")
oracle("valid_quantity", "SELECT * FROM orders_valid")
oracle("impute_sku_mean", """
SELECT m.sku, m.filas_sin_precio, CAST(coalesce(s.n_priced, 0) AS BIGINT) AS filas_con_precio,
       s.m / CAST(100 AS DOUBLE) AS precio_medio
FROM (SELECT sku, count(*) AS filas_sin_precio FROM orders_valid WHERE price_cents IS NULL GROUP BY sku) m
LEFT JOIN (SELECT sku, count(price_cents) AS n_priced,
                  CAST(sum(price_cents) AS DOUBLE) / count(price_cents) AS m
           FROM orders_valid GROUP BY sku HAVING count(price_cents) > 0) s
  ON m.sku = s.sku
""")
oracle("impute_global_mean", f"""
SELECT CAST(count(*) AS BIGINT) AS filas_precio_global, {money('max(c.price_cents)')} AS precio_global
FROM orders_clean c JOIN orders_valid v ON c.order_id = v.order_id
WHERE v.price_cents IS NULL AND (v.sku IS NULL OR v.sku NOT IN (SELECT sku FROM sku_mean))
""")
oracle("normalize_channel", r"""
SELECT channel AS canal_original, regexp_replace(lower(channel), '^\s+|\s+$', '', 'g') AS canal_normalizado,
       CAST(count(*) AS BIGINT) AS filas
FROM orders_raw GROUP BY channel
""")
oracle("clean_audit", r"""
SELECT 'customers' AS tabla, paso, CAST(filas AS BIGINT) AS filas FROM (
  SELECT 'original' AS paso, (SELECT count(*) FROM customers_raw) AS filas
  UNION ALL SELECT 'duplicados_eliminados', (SELECT count(*) FROM customers_raw) - (SELECT count(*) FROM customers_clean)
  UNION ALL SELECT 'pais_unknown', (SELECT count(*) FROM (SELECT * FROM customers_raw
       QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY seq) = 1) WHERE country IS NULL)
  UNION ALL SELECT 'segmento_unknown', (SELECT count(*) FROM (SELECT * FROM customers_raw
       QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY seq) = 1) WHERE segment IS NULL)
  UNION ALL SELECT 'final', (SELECT count(*) FROM customers_clean))
UNION ALL
SELECT 'products', paso, CAST(filas AS BIGINT) FROM (
  SELECT 'original' AS paso, (SELECT count(*) FROM products_raw) AS filas
  UNION ALL SELECT 'costos_negativos_corregidos', (SELECT count(*) FROM products_raw WHERE cost_cents < 0)
  UNION ALL SELECT 'categoria_uncategorized', (SELECT count(*) FROM (SELECT * FROM products_raw
       QUALIFY row_number() OVER (PARTITION BY sku ORDER BY seq) = 1) WHERE category IS NULL)
  UNION ALL SELECT 'duplicados_eliminados', (SELECT count(*) FROM products_raw) - (SELECT count(*) FROM products_clean)
  UNION ALL SELECT 'final', (SELECT count(*) FROM products_clean))
UNION ALL
SELECT 'orders', paso, CAST(filas AS BIGINT) FROM (
  SELECT 'original' AS paso, (SELECT count(*) FROM orders_raw) AS filas
  UNION ALL SELECT 'duplicados_eliminados', (SELECT count(*) FROM orders_raw) - (SELECT count(*) FROM orders_dedup)
  UNION ALL SELECT 'fechas_invalidas_eliminadas', (SELECT count(*) FROM orders_dedup) - (SELECT count(*) FROM orders_dated)
  UNION ALL SELECT 'cantidad_negativa', (SELECT count(*) FROM orders_dated WHERE quantity < 0)
  UNION ALL SELECT 'cantidad_cero', (SELECT count(*) FROM orders_dated WHERE quantity = 0)
  UNION ALL SELECT 'cantidad_eliminadas', (SELECT count(*) FROM orders_dated) - (SELECT count(*) FROM orders_valid)
  UNION ALL SELECT 'precios_imputados', (SELECT count(*) FROM orders_valid WHERE price_cents IS NULL)
  UNION ALL SELECT 'final', (SELECT count(*) FROM orders_valid))
""")

# ------------------------------------------------------------------- model
oracle("orders_enriched", f"""
SELECT o.order_id, o.customer_id, c.name AS customer_name, c.country, c.segment, o.sku, p.category,
       {money('p.cost_cents')} AS product_cost, p.active AS product_active, o.quantity,
       {money('o.price_cents')} AS unit_price,
       {money('CAST(o.quantity AS BIGINT) * o.price_cents')} AS revenue,
       {money('CAST(o.quantity AS BIGINT) * (o.price_cents - p.cost_cents)')} AS margin,
       o.order_date, o.channel
FROM orders_clean o LEFT JOIN customers_clean c ON o.customer_id = c.customer_id
LEFT JOIN products_clean p ON o.sku = p.sku
""")
oracle("load_counts", """
SELECT 'customers' AS tabla, CAST(count(*) AS BIGINT) AS registros FROM customers_clean
UNION ALL SELECT 'products', CAST(count(*) AS BIGINT) FROM products_clean
UNION ALL SELECT 'orders', CAST(count(*) AS BIGINT) FROM orders_clean
""")

# -------------------------------------------------------------------- KPIs
oracle("kpi_total_sales", f"SELECT {money(f'sum({LINE})')} AS ventas_totales FROM orders_clean")
oracle("kpi_total_margin", f"""
SELECT {money('sum(coalesce(o.quantity, 0) * (coalesce(o.price_cents, 0) - coalesce(p.cost_cents, 0)))')}
       AS margen_total
FROM orders_clean o LEFT JOIN products_clean p ON o.sku = p.sku
""")
oracle("kpi_order_count", "SELECT CAST(count(DISTINCT order_id) AS BIGINT) AS numero_pedidos FROM orders_clean")
oracle("kpi_avg_ticket", f"""
SELECT {money('s')} AS ventas_totales, CAST(n AS BIGINT) AS numero_pedidos,
       {money(div_half_away('s', 'n'))} AS ticket_promedio
FROM (SELECT sum({LINE}) AS s, count(DISTINCT order_id) AS n FROM orders_clean) metricas
""")
oracle("kpi_panel", f"""
SELECT {money('s')} AS ventas_totales, CAST(n AS BIGINT) AS num_pedidos,
       {money(div_half_away('s', 'n'))} AS ticket_promedio
FROM (SELECT sum(CAST(quantity AS BIGINT) * price_cents) AS s, count(DISTINCT order_id) AS n
      FROM orders_clean) m
""")
oracle("sales_by_month", f"""
SELECT strftime(order_date, '%Y-%m') AS mes, {money(f'sum({LINE})')} AS ventas,
       CAST(count(DISTINCT order_id) AS BIGINT) AS pedidos
FROM orders_clean GROUP BY 1 ORDER BY mes NULLS FIRST
""")
oracle("sales_by_channel", f"""
SELECT channel AS canal, {money(f'sum({LINE})')} AS ventas, CAST(count(DISTINCT order_id) AS BIGINT) AS pedidos,
       {money(div_half_away(f'sum({LINE})', 'count(*)'))} AS ticket_promedio
FROM orders_clean GROUP BY channel ORDER BY ventas DESC, canal NULLS FIRST
""")
oracle("margin_by_category", f"""
SELECT coalesce(p.category, 'Sin Categoría') AS categoria,
       {money(f'sum({LINE})')} AS ventas,
       {money('sum(coalesce(o.quantity, 0) * (coalesce(o.price_cents, 0) - coalesce(p.cost_cents, 0)))')} AS margen,
       CASE WHEN sum({LINE}) = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST({div_half_away('sum(coalesce(o.quantity, 0) * (coalesce(o.price_cents, 0) - coalesce(p.cost_cents, 0))) * 1000', f'sum({LINE})')} AS DOUBLE) / CAST(10 AS DOUBLE)
       END AS pct_margen
FROM orders_clean o LEFT JOIN products_clean p ON o.sku = p.sku
GROUP BY p.category ORDER BY margen DESC, categoria NULLS FIRST
""")
CTES["customer_sums"] = f"""
SELECT customer_id, sum({LINE}) AS cents, CAST(count(DISTINCT order_id) AS BIGINT) AS pedidos FROM orders_clean GROUP BY customer_id
"""
oracle("top_customers", f"""
SELECT customer_id, name AS cliente, country AS pais, segment AS segmento, {money('cents')} AS ingresos, pedidos,
       {money(div_half_away('cents', 'pedidos'))} AS ticket_promedio
FROM customers_clean JOIN customer_sums USING (customer_id)
ORDER BY cents DESC, customer_id LIMIT 10
""")
oracle("top_products", f"""
SELECT sku, coalesce(category, 'Sin Categoría') AS categoria, units AS unidades_vendidas, {money('sales_cents')} AS ingresos,
       {money('sales_cents - units * coalesce(cost_cents, 0)')} AS margen, {money('cost_cents')} AS costo_unitario
FROM products_clean JOIN sku_sales USING (sku)
ORDER BY sales_cents DESC, sku LIMIT 10
""")
oracle("dim_channels", "SELECT DISTINCT channel AS canal FROM orders_clean ORDER BY canal NULLS FIRST")
oracle("dim_categories", "SELECT DISTINCT category AS categoria FROM products_clean ORDER BY categoria NULLS FIRST")
oracle("dim_countries", "SELECT DISTINCT country AS pais FROM customers_clean ORDER BY pais NULLS FIRST")
oracle("dim_date_range",
       "SELECT min(order_date) AS fecha_inicio, max(order_date) AS fecha_fin FROM orders_clean")


# ----------------------------------------------------------------- profile
RAW_COLS = {
    "customers": ["customer_id", "name", "country", "segment", "created_at"],
    "products": ["sku", "category", "cost_cents", "active"],
    "orders": ["order_id", "customer_id", "sku", "quantity", "price_cents", "order_date", "channel"],
}
# Money columns are held in cents and shown in currency units by the source's name.
SHOWN = {"price_cents": "unit_price", "cost_cents": "cost"}
DAY = "try_strptime({c}, '%Y-%m-%d')"


def _raw(t: str) -> str:
    return f"{t}_raw"


def _union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _is_null_count(c: str) -> str:
    return f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"


oracle("scan_shape", _union_all([
    f"SELECT '{t}' AS tabla, CAST(count(*) AS BIGINT) AS filas, {len(cols)} AS columnas FROM {_raw(t)}"
    for t, cols in RAW_COLS.items()]))

oracle("profile_nulls", _union_all([
    f"SELECT '{t}' AS tabla, '{SHOWN.get(c, c)}' AS campo, CAST({_is_null_count(c)} AS BIGINT) AS nulos, "
    f"round_even(CAST({_is_null_count(c)} AS DOUBLE) / count(*) * 100 * 100, 0) / 100 AS pct FROM {_raw(t)}"
    for t, cols in RAW_COLS.items() for c in cols]))

SHOWN_ORDERS = f"(SELECT * EXCLUDE (price_cents), {money('price_cents')} AS unit_price FROM orders_raw)"
SHOWN_PRODUCTS = f"(SELECT * EXCLUDE (cost_cents), {money('cost_cents')} AS cost FROM products_raw)"

oracle("profile_null_rows", f"""
SELECT order_id, customer_id, sku, quantity, unit_price, order_date FROM {SHOWN_ORDERS} WHERE unit_price IS NULL
""")
oracle("profile_null_country_rows", "SELECT * FROM customers_raw WHERE country IS NULL")
oracle("profile_null_segment_rows", "SELECT * FROM customers_raw WHERE segment IS NULL")
oracle("profile_null_category_rows", f"SELECT * FROM {SHOWN_PRODUCTS} WHERE category IS NULL")
oracle("profile_dup_customer_rows", """
SELECT * FROM customers_raw WHERE customer_id IN (
  SELECT customer_id FROM customers_raw GROUP BY customer_id HAVING count(*) > 1)
""")
oracle("profile_dup_product_rows", f"""
SELECT * FROM {SHOWN_PRODUCTS} WHERE sku IN (SELECT sku FROM products_raw GROUP BY sku HAVING count(*) > 1)
""")
oracle("profile_bad_created_rows", f"SELECT * FROM customers_raw WHERE {DAY.format(c='created_at')} IS NULL")
oracle("profile_bad_created_dirty", """
SELECT customer_id, name, country, segment, substr(created_at, 1, 5) || '13' || substr(created_at, 8, 3) AS created_at, seq
FROM customers_raw WHERE customer_id % 37 = 5
""")
oracle("profile_negative_quantity_rows", f"SELECT * FROM {SHOWN_ORDERS} WHERE quantity < 0")
oracle("profile_head_customers", "SELECT * FROM customers_raw ORDER BY customer_id, seq LIMIT 5")
oracle("profile_head_products", f"SELECT * FROM {SHOWN_PRODUCTS} ORDER BY sku, seq LIMIT 5")


def _dup_sql(t: str, key: str) -> str:
    return (f"((SELECT count(*) FROM {_raw(t)}) - "
            f"(SELECT count(*) FROM (SELECT DISTINCT {key} FROM {_raw(t)})))")


oracle("profile_dup_counts", _union_all([
    f"SELECT '{t}' AS tabla, '{k}' AS campo, CAST({_dup_sql(t, k)} AS BIGINT) AS duplicados"
    for t, k in [("customers", "customer_id"), ("products", "sku"), ("orders", "order_id")]]))

oracle("profile_dup_rows", f"""
SELECT * FROM {SHOWN_ORDERS} WHERE order_id IN (
  SELECT order_id FROM orders_raw GROUP BY order_id HAVING count(*) > 1)
""")

oracle("profile_bad_dates", _union_all([
    f"SELECT '{t}' AS tabla, '{c}' AS campo, "
    f"CAST(sum(CASE WHEN {DAY.format(c=c)} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS fechas_invalidas "
    f"FROM {_raw(t)}" for t, c in [("customers", "created_at"), ("orders", "order_date")]]))

oracle("profile_bad_date_rows", f"""
SELECT order_id, customer_id, sku, order_date, channel FROM orders_raw
WHERE {DAY.format(c='order_date')} IS NULL
""")

oracle("profile_date_range", _union_all([
    f"SELECT '{t}' AS tabla, '{c}' AS campo, CAST(min({DAY.format(c=c)}) AS DATE) AS fecha_min, "
    f"CAST(max({DAY.format(c=c)}) AS DATE) AS fecha_max FROM {_raw(t)}"
    for t, c in [("customers", "created_at"), ("orders", "order_date")]]))

oracle("profile_value_counts", _union_all([
    f"SELECT '{t}' AS tabla, '{c}' AS campo, CAST({c} AS VARCHAR) AS valor, CAST(count(*) AS BIGINT) AS filas "
    f"FROM {_raw(t)} GROUP BY {c}"
    for t, cols in [("customers", ["country", "segment"]), ("products", ["category", "active"]),
                    ("orders", ["channel"])] for c in cols]))

CTES["positive_raw"] = "SELECT * FROM products_raw WHERE cost_cents > 0"
for _t, _c in [("orders", "quantity"), ("orders", "price_cents"), ("products", "cost_cents"), ("positive", "cost_cents")]:
    CTES[f"ranked_{_t}_{_c}"] = (f"SELECT {_c} AS v, row_number() OVER (ORDER BY {_c}) - 1 AS i "
                                 f"FROM {_raw(_t)} WHERE {_c} IS NOT NULL")


def _quantile(t: str, c: str, q: str) -> str:
    r = f"ranked_{t}_{c}"
    pos = f"(CAST((SELECT count(*) FROM {r}) - 1 AS DOUBLE) * CAST({q} AS DOUBLE))"
    lo = f"(SELECT CAST(v AS DOUBLE) FROM {r} WHERE i = floor({pos}))"
    hi = f"(SELECT CAST(v AS DOUBLE) FROM {r} WHERE i = ceil({pos}))"
    return (f"(CASE WHEN ceil({pos}) = floor({pos}) OR {lo} = {hi} THEN {lo} "
            f"ELSE (ceil({pos}) - {pos}) * {lo} + ({pos} - floor({pos})) * {hi} END)")


def _describe(t: str, c: str, label: str) -> str:
    unit = 100 if c in SHOWN else 1
    return f"""SELECT '{label}' AS tabla, '{SHOWN.get(c, c)}' AS campo, count,
       {', '.join(f'{x} / CAST({unit} AS DOUBLE) AS {x}' for x in ('mean', 'std', 'min', 'p25', 'p50', 'p75', 'max'))}
FROM (SELECT CAST(count({c}) AS BIGINT) AS count,
       CAST(sum(CAST({c} AS HUGEINT)) AS DOUBLE) / count({c}) AS mean,
       CASE WHEN count({c}) > 1 THEN sqrt(CAST(sum(CAST({c} AS HUGEINT) * {c}) * count({c})
            - sum(CAST({c} AS HUGEINT)) * sum(CAST({c} AS HUGEINT)) AS DOUBLE)
            / CAST(count({c}) * (count({c}) - 1) AS DOUBLE)) END AS std,
       CAST(min({c}) AS DOUBLE) AS min, {_quantile(t, c, '0.25')} AS p25, {_quantile(t, c, '0.5')} AS p50,
       {_quantile(t, c, '0.75')} AS p75, CAST(max({c}) AS DOUBLE) AS max
FROM {_raw(t)})"""


oracle("profile_describe_num", _union_all([
    _describe("orders", "quantity", "orders"), _describe("orders", "price_cents", "orders"),
    _describe("products", "cost_cents", "products")]))
oracle("profile_describe_positive_cost", _describe("positive", "cost_cents", "products"))

oracle("profile_info", _union_all([
    f"SELECT '{t}' AS tabla, '{SHOWN.get(c, c)}' AS campo, "
    f"'{ {'quantity': 'int', 'active': 'boolean', 'price_cents': 'double', 'cost_cents': 'double', 'customer_id': 'bigint', 'sku': 'bigint'}.get(c, 'string')}' AS tipo, "
    f"CAST(count({c}) AS BIGINT) AS no_nulos FROM {_raw(t)}" for t, cols in RAW_COLS.items() for c in cols]))

CTES["customers_text_long"] = _union_all([
    f"SELECT '{c}' AS campo, CAST({c} AS VARCHAR) AS valor FROM customers_raw WHERE {c} IS NOT NULL"
    for c in RAW_COLS["customers"]])

oracle("profile_describe_text", """
SELECT 'customers' AS tabla, campo, CAST(sum(f) AS BIGINT) AS count, CAST(count(*) AS BIGINT) AS unique,
       arg_min(valor, (-f, valor)) AS top, max(f) AS freq
FROM (SELECT campo, valor, CAST(count(*) AS BIGINT) AS f FROM customers_text_long GROUP BY campo, valor)
GROUP BY campo
""")

oracle("profile_head", f"SELECT * FROM {SHOWN_ORDERS} ORDER BY order_id, seq LIMIT 5")

oracle("profile_negative", _union_all([
    f"SELECT '{t}' AS tabla, '{SHOWN.get(c, c)}' AS campo, CAST(sum(CASE WHEN {c} < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negativos "
    f"FROM {_raw(t)}" for t, c in [("products", "cost_cents"), ("orders", "quantity")]]))

oracle("profile_negative_rows", f"SELECT * FROM {SHOWN_PRODUCTS} WHERE cost < 0")

oracle("profile_zero", """
SELECT 'orders' AS tabla, 'quantity' AS campo,
       CAST(sum(CASE WHEN quantity = 0 THEN 1 ELSE 0 END) AS BIGINT) AS ceros,
       CAST(sum(CASE WHEN quantity <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS no_positivos
FROM orders_raw
""")

oracle("profile_abs_in_range", f"""
SELECT sku, {money('abs(cost_cents)')} AS valor_abs,
       (SELECT {money('min(cost_cents)')} FROM products_raw WHERE cost_cents > 0) AS min_positivo,
       (SELECT {money('max(cost_cents)')} FROM products_raw WHERE cost_cents > 0) AS max_positivo,
       coalesce(abs(cost_cents) >= (SELECT min(cost_cents) FROM products_raw WHERE cost_cents > 0)
            AND abs(cost_cents) <= (SELECT max(cost_cents) FROM products_raw WHERE cost_cents > 0), false) AS en_rango
FROM products_raw WHERE cost_cents < 0
""")

oracle("profile_inactive", "SELECT * FROM products_raw WHERE NOT active")

oracle("orphan_customers", """
SELECT order_id, customer_id, sku FROM orders_raw
WHERE customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM customers_raw WHERE customer_id IS NOT NULL)
""")
oracle("orphan_skus", """
SELECT order_id, customer_id, sku FROM orders_raw
WHERE sku IS NULL OR sku NOT IN (SELECT sku FROM products_raw WHERE sku IS NOT NULL)
""")
oracle("orders_with_inactive", """
SELECT sku, CAST(count(*) AS BIGINT) AS filas FROM orders_raw
WHERE sku IN (SELECT sku FROM products_raw WHERE NOT active) GROUP BY sku
""")
oracle("price_history_for_nulls", """
SELECT sku, CAST(sum(CASE WHEN price_cents IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS precios_nulos,
       CAST(count(price_cents) AS BIGINT) AS n_precios,
       CASE WHEN count(price_cents) > 0 THEN CAST(sum(price_cents) AS DOUBLE) / count(price_cents) / CAST(100 AS DOUBLE) END
         AS precio_medio,
       CASE WHEN count(price_cents) > 0 THEN 'historial' ELSE 'sin historial' END AS estado
FROM orders_raw GROUP BY sku HAVING sum(CASE WHEN price_cents IS NULL THEN 1 ELSE 0 END) > 0
""")
oracle("raw_mean_price", """
SELECT CAST(sum(price_cents) AS DOUBLE) / count(price_cents) / CAST(100 AS DOUBLE) AS precio_medio_global FROM orders_raw
""")
NORM = r"regexp_replace(lower(channel), '^\s+|\s+$', '', 'g')"
oracle("channel_normalization", f"""
SELECT coalesce(b.canal, a.canal) AS canal, CAST(coalesce(b.n, 0) AS BIGINT) AS filas_antes,
       CAST(coalesce(a.n, 0) AS BIGINT) AS filas_despues
FROM (SELECT channel AS canal, count(*) AS n FROM orders_raw GROUP BY channel) b
FULL OUTER JOIN (SELECT {NORM} AS canal, count(*) AS n FROM orders_raw GROUP BY 1) a
  ON b.canal IS NOT DISTINCT FROM a.canal
""")


def _finding(t, campo, problema, count_sql, decision):
    return (f"SELECT '{t}' AS tabla, '{campo}' AS campo, '{problema}' AS problema, "
            f"CAST(({count_sql}) AS BIGINT) AS filas_afectadas, '{decision}' AS decision")


def _count_where(t, cond):
    return f"SELECT count(*) FROM {_raw(t)} WHERE {cond}"


oracle("quality_findings", _union_all([
    _finding("customers", "country", "nulos", _count_where("customers", "country IS NULL"), "fillna Unknown"),
    _finding("customers", "segment", "nulos", _count_where("customers", "segment IS NULL"), "fillna Unknown"),
    _finding("customers", "customer_id", "duplicados", _dup_sql("customers", "customer_id"), "keep first"),
    _finding("products", "category", "nulos", _count_where("products", "category IS NULL"), "fillna Uncategorized"),
    _finding("products", "cost", "negativos", _count_where("products", "cost_cents < 0"), "abs()"),
    _finding("products", "sku", "duplicados", _dup_sql("products", "sku"), "keep first"),
    _finding("orders", "unit_price", "nulos", _count_where("orders", "price_cents IS NULL"), "promedio del SKU"),
    _finding("orders", "quantity", "negativos/cero", _count_where("orders", "quantity <= 0"), "eliminar"),
    _finding("orders", "order_date", "fechas invalidas", _count_where("orders", f"{DAY.format(c='order_date')} IS NULL"),
             "eliminar"),
    _finding("orders", "order_id", "duplicados", _dup_sql("orders", "order_id"), "keep first"),
    _finding("orders", "channel", "formato", _count_where("orders", f"channel IS DISTINCT FROM {NORM}"),
             "lower + strip"),
    _finding("orders", "customer_id", "FK sin match", _count_where(
        "orders", "customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM customers_raw "
                  "WHERE customer_id IS NOT NULL)"), "revisar"),
    _finding("orders", "sku", "FK sin match", _count_where(
        "orders", "sku IS NULL OR sku NOT IN (SELECT sku FROM products_raw WHERE sku IS NOT NULL)"), "revisar"),
]))

oracle("drop_impact", f"""
SELECT CAST(sum(CASE WHEN bd THEN 1 ELSE 0 END) AS BIGINT) AS fechas_invalidas,
       CAST(sum(CASE WHEN bq THEN 1 ELSE 0 END) AS BIGINT) AS cantidades_invalidas,
       CAST(sum(CASE WHEN rn > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicados,
       CAST(sum(CASE WHEN bd OR bq OR rn > 1 THEN 1 ELSE 0 END) AS BIGINT) AS total_eliminar,
       CAST(count(*) AS BIGINT) AS filas_originales,
       CAST(count(*) - sum(CASE WHEN bd OR bq OR rn > 1 THEN 1 ELSE 0 END) AS BIGINT) AS filas_resultantes,
       round_even(CAST(count(*) - sum(CASE WHEN bd OR bq OR rn > 1 THEN 1 ELSE 0 END) AS DOUBLE)
                  / count(*) * 1000, 0) / 10 AS retencion_pct
FROM (SELECT {DAY.format(c='order_date')} IS NULL AS bd, coalesce(quantity <= 0, false) AS bq,
             row_number() OVER (PARTITION BY order_id ORDER BY seq) AS rn FROM orders_raw) t
""")

oracle("profile_counters", f"""
SELECT CAST(({_count_where('customers', 'country IS NULL')}) AS BIGINT) AS null_country,
       CAST(({_count_where('customers', 'segment IS NULL')}) AS BIGINT) AS null_segment,
       CAST(({_count_where('products', 'cost_cents < 0')}) AS BIGINT) AS negative_cost,
       CAST(({_count_where('products', 'category IS NULL')}) AS BIGINT) AS null_category,
       CAST(({_count_where('products', 'active = false')}) AS BIGINT) AS inactive,
       CAST(({_count_where('orders', 'price_cents IS NULL')}) AS BIGINT) AS null_price,
       CAST(({_count_where('orders', 'quantity < 0')}) AS BIGINT) AS negative_qty,
       CAST({_dup_sql('orders', 'order_id')} AS BIGINT) AS duplicate_ids,
       CAST(({_count_where('orders', DAY.format(c='order_date') + ' IS NULL')}) AS BIGINT) AS invalid_dates
""")


# ------------------------------------------------------------------ checks
def _v(t, regla, count_sql, fatal=True):
    return (f"SELECT '{t}' AS tabla, '{regla}' AS regla, CAST(({count_sql}) AS BIGINT) AS violaciones, "
            f"{'true' if fatal else 'false'} AS fatal")


def _cw(t, cond):
    return f"SELECT count(*) FROM {t}_clean WHERE {cond}"


def _pk(t, key):
    return (f"(SELECT count({key}) FROM {t}_clean) - "
            f"(SELECT count(DISTINCT {key}) FROM {t}_clean)")


oracle("constraint_violations", _union_all(
    [_v("customers", f"not null {c}", _cw("customers", f"{c} IS NULL"))
     for c in ["name", "country", "segment", "created_at"]]
    + [_v("customers", "primary key customer_id", _pk("customers", "customer_id"))]
    + [_v("products", f"not null {c}", _cw("products", f"{c} IS NULL"))
       for c in ["category", "cost_cents", "active"]]
    + [_v("products", "check cost_cents >= 0", _cw("products", "NOT (cost_cents >= 0)")),
       _v("products", "primary key sku", _pk("products", "sku"))]
    + [_v("orders", f"not null {c}", _cw("orders", f"{c} IS NULL"))
       for c in ["customer_id", "sku", "quantity", "price_cents", "order_date", "channel"]]
    + [_v("orders", "check quantity > 0", _cw("orders", "NOT (quantity > 0)")),
       _v("orders", "check price_cents > 0", _cw("orders", "NOT (price_cents > 0)")),
       _v("orders", "primary key order_id", _pk("orders", "order_id")),
       _v("orders", "foreign key customer_id -> customers", _cw(
           "orders", "customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM customers_clean "
                     "WHERE customer_id IS NOT NULL)"), fatal=False),
       _v("orders", "foreign key sku -> products", _cw(
           "orders", "sku IS NOT NULL AND sku NOT IN (SELECT sku FROM products_clean WHERE sku IS NOT NULL)"),
          fatal=False)]))

# ----------------------------------------------------------------- serving
oracle("customer_lookup", "SELECT customer_id, name FROM customers_clean ORDER BY name NULLS FIRST, customer_id")
oracle("customer_list",
       "SELECT customer_id, name, country, segment FROM customers_clean ORDER BY name NULLS FIRST, customer_id")
oracle("active_products",
       f"SELECT sku, category, {money('cost_cents')} AS cost FROM products_clean WHERE active ORDER BY sku")
CTES["recent"] = f"""
SELECT o.order_id, o.customer_id, c.name AS customer_name, o.sku, p.category, o.quantity,
       {money('o.price_cents')} AS unit_price, {money('CAST(o.quantity AS BIGINT) * o.price_cents')} AS total,
       o.order_date, o.channel
FROM orders_clean o LEFT JOIN customers_clean c ON o.customer_id = c.customer_id
LEFT JOIN products_clean p ON o.sku = p.sku
ORDER BY o.order_date DESC NULLS LAST, o.order_id DESC NULLS LAST LIMIT 20
"""
oracle("recent_orders", "SELECT * FROM recent")
oracle("recent_orders_display", """
SELECT order_id, coalesce(nullif(customer_name, ''), CAST(customer_id AS VARCHAR)) AS cliente, sku,
       coalesce(nullif(category, ''), '-') AS categoria, quantity AS cantidad, unit_price AS precio, total,
       substr(strftime(order_date, '%Y-%m-%d'), 1, 10) AS fecha, channel AS canal
FROM recent
""")
oracle("kpi_panel_display", f"""
SELECT coalesce({money('sum(CAST(quantity AS BIGINT) * price_cents)')}, 0) AS ventas_totales,
       coalesce((SELECT {money('sum(coalesce(o.quantity, 0) * (coalesce(o.price_cents, 0) - coalesce(p.cost_cents, 0)))')}
                 FROM orders_clean o LEFT JOIN products_clean p ON o.sku = p.sku), 0) AS margen,
       CAST(coalesce(count(DISTINCT order_id), 0) AS BIGINT) AS num_pedidos,
       coalesce({money(div_half_away('sum(CAST(quantity AS BIGINT) * price_cents)', 'count(DISTINCT order_id)'))}, 0)
         AS ticket_promedio
FROM orders_clean
""")
oracle("next_order_id", """
SELECT printf('O%06d', coalesce(max(TRY_CAST(regexp_extract(order_id, '^O([0-9]+)$', 1) AS BIGINT)), 0) + 1)
       AS next_order_id
FROM orders_clean
""")

# ------------------------------------------------------------------ intake
STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _blank(x):
    return f"nullif({STRIP.format(x=x)}, '')"


CTES["intake_batch"] = r"""
SELECT CASE WHEN r = 0 THEN '  ' WHEN r = 6 THEN order_id ELSE printf('W%09d', k) END AS order_id,
       CAST(customer_id AS VARCHAR) AS customer_id, CAST(sku AS VARCHAR) AS sku,
       CASE WHEN r = 1 THEN 'x' WHEN r = 2 THEN '0' ELSE CAST(quantity AS VARCHAR) END AS quantity,
       CASE WHEN r = 3 THEN '0' WHEN price_cents IS NULL THEN ''
            ELSE CAST(price_cents // 100 AS VARCHAR) || '.' || lpad(CAST(price_cents % 100 AS VARCHAR), 2, '0') END
         AS unit_price,
       CASE WHEN r = 4 THEN '' WHEN r = 5 THEN '2027-01-15' ELSE order_date END AS order_date,
       channel, k AS clave, seq AS copia
FROM (SELECT *, CAST(substr(order_id, 2) AS BIGINT) AS k, (CAST(substr(order_id, 2) AS BIGINT) // 10) % 10 AS r
      FROM orders_raw) b
"""

CTES["intake_typed"] = f"""
SELECT {_blank('order_id')} AS order_id,
       TRY_CAST({_blank('customer_id')} AS BIGINT) AS customer_id, TRY_CAST({_blank('sku')} AS BIGINT) AS sku,
       {_blank('quantity')} AS q_text, TRY_CAST({_blank('quantity')} AS INTEGER) AS quantity,
       CAST(TRY_CAST({_blank('unit_price')} AS DECIMAL(20,2)) * 100 AS BIGINT) AS price_cents,
       {_blank('order_date')} AS d_text,
       CAST(try_strptime({_blank('order_date')}, '%Y-%m-%d') AS DATE) AS order_date,
       channel, clave, copia
FROM intake_batch
"""

_ROW_RULES = [
    "CASE WHEN order_id IS NULL THEN 'Order ID es requerido' END",
    "CASE WHEN quantity IS NULL THEN 'Cantidad inválida' WHEN quantity <= 0 THEN 'Cantidad debe ser mayor a 0' END",
    "CASE WHEN price_cents IS NULL THEN 'Precio unitario inválido' "
    "WHEN price_cents <= 0 THEN 'Precio unitario debe ser mayor a 0' END",
    "CASE WHEN d_text IS NULL THEN 'Fecha es requerida' WHEN order_date IS NULL THEN 'Fecha inválida' "
    "WHEN order_date > DATE '2026-06-01' THEN 'La fecha no puede ser futura' END",
]
_STRICT_RULES = [
    "CASE WHEN order_id IS NOT NULL AND NOT regexp_matches(order_id, '^O[0-9]{6}$') "
    "THEN 'Formato de Order ID inválido' END",
    "CASE WHEN customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM customers_clean "
    "WHERE customer_id IS NOT NULL) THEN 'Cliente inexistente' END",
    "CASE WHEN sku IS NULL OR sku NOT IN (SELECT sku FROM products_clean WHERE active AND sku IS NOT NULL) "
    "THEN 'Producto inexistente o inactivo' END",
    "CASE WHEN channel IS NULL OR channel NOT IN ('retail', 'ecommerce', 'wholesale', 'export') "
    "THEN 'Canal inválido' END",
]


def _validated_sql(rules):
    errs = f"concat_ws(' | ', {', '.join(rules)})"
    return f"""
SELECT order_id, customer_id, sku, quantity, {money('price_cents')} AS unit_price,
       {money('CAST(coalesce(quantity, 0) AS BIGINT) * coalesce(price_cents, 0)')} AS total, order_date, channel,
       clave, copia,
       CASE WHEN errores IS NULL THEN 'aceptado' ELSE 'rechazado' END AS estado, errores
FROM (
  SELECT *, CASE WHEN e <> '' THEN e WHEN rn > 1 THEN 'Order ID repetido en el lote'
                 WHEN order_id IN (SELECT order_id FROM orders_clean) THEN 'Order ID ya existe' END AS errores
  FROM (SELECT *, CASE WHEN e = '' THEN row_number() OVER (PARTITION BY order_id, e = ''
                  ORDER BY clave, copia) END AS rn
        FROM (SELECT *, {errs} AS e FROM intake_typed) t1) t2) t3
"""


CTES["intake_validated_v"] = _validated_sql(_ROW_RULES)
oracle("intake_validated", "SELECT * FROM intake_validated_v")
oracle("intake_indexed", "SELECT * FROM intake_validated_v")
oracle("intake_accepted", """
SELECT order_id, customer_id, sku, quantity, unit_price, order_date, channel FROM intake_validated_v
WHERE estado = 'aceptado'
""")
oracle("orders_with_appends", f"""
SELECT order_id, customer_id, sku, quantity, {money('price_cents')} AS unit_price, order_date, channel FROM orders_clean
UNION ALL
SELECT order_id, customer_id, sku, quantity, unit_price, order_date, channel FROM intake_validated_v
WHERE estado = 'aceptado'
""")
oracle("intake_rejects", "SELECT order_id, clave, copia, errores FROM intake_validated_v WHERE estado = 'rechazado'")
oracle("intake_strict", _validated_sql(_ROW_RULES[:1] + _STRICT_RULES + _ROW_RULES[1:]))


# ----------------------------------------------------------------- refresh
def _arriving(sql: str) -> str:
    """A query over the orders of three files in order of arrival."""
    first = "PARTITION BY order_id ORDER BY seq) = 1"
    assert first in sql
    return sql.replace(first, "PARTITION BY order_id ORDER BY (CAST(substr(order_id, 2) AS BIGINT) + seq) % 3, seq) = 1")


ORACLE["refreshed_orders"] = _arriving(ORACLE["clean_orders"])
ORACLE["refreshed_by_month"] = _arriving(ORACLE["sales_by_month"])
ORACLE["refreshed_by_channel"] = _arriving(ORACLE["sales_by_channel"])
ORACLE["refreshed_by_category"] = _arriving(ORACLE["margin_by_category"])
ORACLE["refreshed_kpis"] = _arriving(f"""
SELECT a.ventas_totales, b.margen_total, c.numero_pedidos, d.ticket_promedio,
       e.ventas_totales AS panel_ventas, e.num_pedidos AS panel_pedidos, e.ticket_promedio AS panel_ticket
FROM ({ORACLE['kpi_total_sales']}) a, ({ORACLE['kpi_total_margin']}) b, ({ORACLE['kpi_order_count']}) c,
     ({ORACLE['kpi_avg_ticket']}) d, ({ORACLE['kpi_panel']}) e
""")

# ----------------------------------------------- by month, catalogue, bulk ids
ORACLE["recent_orders_by_month"] = ORACLE["recent_orders"]
ORACLE["dim_date_range_by_month"] = ORACLE["dim_date_range"]
ORACLE["published_enriched"] = ORACLE["orders_enriched"]
oracle("bulk_order_ids", """
SELECT printf('O%06d', (SELECT coalesce(max(TRY_CAST(regexp_extract(order_id, '^O([0-9]+)$', 1) AS BIGINT)), 0) FROM orders_clean)
                       + row_number() OVER (ORDER BY clave, copia)) AS order_id, clave, copia
FROM intake_batch
""")

# ------------------------------------------------- inferred types, approximate
_NUMERIC = {"orders": ["quantity", "price_cents"], "products": ["cost_cents"]}
oracle("profile_describe_approx", " UNION ALL ".join(
    f"SELECT '{t}' AS tabla, '{c}' AS campo, CAST({q} AS DOUBLE) AS q, count({c}) AS filas, true AS dentro_del_limite FROM {t}_raw"
    for t, cols in _NUMERIC.items() for c in cols for q in (0.25, 0.5, 0.75)))


def _inferred(table: str, column: str, shown: str) -> str:
    tests = [("integer", "regexp_full_match(x, '[+-]?[0-9]+')"),
             ("float", r"regexp_full_match(x, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')"),
             ("boolean", "x IN ('true', 'True', 'TRUE', 'false', 'False', 'FALSE')"),
             ("date", "regexp_full_match(x, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_strptime(x, '%Y-%m-%d') IS NOT NULL")]
    cases = " ".join(f"WHEN bool_and({test}) THEN '{name}'" for name, test in tests)
    return (f"SELECT '{table}' AS tabla, '{column}' AS columna, CASE WHEN count(x) = 0 THEN 'all-null' {cases} ELSE 'text' END AS tipo, "
            f"count(x) AS filas_con_valor FROM (SELECT CAST({shown} AS VARCHAR) AS x FROM {table}_raw)")


_SHOWN = {"customers": ["customer_id", "name", "country", "segment", "created_at"], "products": ["sku", "category", "cost_cents", "active"],
          "orders": ["order_id", "customer_id", "sku", "quantity", "price_cents", "order_date", "channel"]}
_MONEY = {"price_cents": "unit_price", "cost_cents": "cost"}
oracle("profile_inferred_types", " UNION ALL ".join(
    _inferred(t, _MONEY.get(c, c), money(c) if c in _MONEY else c) for t, cols in _SHOWN.items() for c in cols))
