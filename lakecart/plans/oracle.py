"""Independent DuckDB SQL for every registered query key.

means) over the FIXTURES.md mapping views (``m_*``): marts are put together
from one aggregate per entity, checks from the rule lists below, which repeat
the source's constraints and not the library's.  ``s_*`` CTEs are the silver
tables the mapping implies (all columns, text rules applied, ``dt``), ``f_*``
the same with the planted faults.  Money is summed as DECIMAL(18,2).
"""

from __future__ import annotations

# --- fixed values: the FIXTURES.md section B mapping (DuckDB dialect) ---
M_VIEWS: dict[str, str] = {
    "m_users": """
select c_custkey as user_id, substring(c_name,1,8) as first_name, substring(c_name,10,9) as last_name,
  concat('user_', substring(c_name,10,9), '@example.com') as email, n_name as country,
  cast('2020-01-01 00:00:00' as timestamp) as created_at
from customer join nation on c_nationkey = n_nationkey""",
    "m_categories": """
select cast(row_number() over (order by p_type) as bigint) as category_id, p_type as name
from (select distinct p_type from part) x""",
    "m_products": """
select p_partkey as product_id, category_id, p_name as name, p_retailprice as price,
  concat('SKU-', lpad(cast(p_partkey as string), 8, '0')) as sku, p_size as inventory_quantity
from part join m_categories on p_type = m_categories.name""",
    "m_orders": """
select o_orderkey as order_id, o_custkey as user_id, cast(o_orderdate as date) as order_date,
  case when o_orderstatus = 'F' then 'delivered'
       when o_orderstatus = 'O' and o_orderpriority = '1-URGENT' then 'shipped'
       when o_orderstatus = 'O' then 'confirmed'
       when o_orderpriority = '5-LOW' then 'cancelled'
       when o_orderpriority = '2-HIGH' then 'returned' else 'pending' end as status,
  'USD' as currency,
  cast(cast(o_totalprice as decimal(18,2)) - round(cast(o_totalprice as decimal(18,2)) * 0.08, 2) - 5.00 as double) as subtotal,
  cast(round(cast(o_totalprice as decimal(18,2)) * 0.08, 2) as double) as tax,
  cast(5.00 as double) as shipping_cost, o_totalprice as total_amount, o_orderdate as created_at
from orders""",
    "m_order_items": """
select cast(row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) as bigint) as order_item_id,
  l_orderkey as order_id, l_partkey as product_id, cast(l_quantity as int) as quantity, l_extendedprice as unit_price,
  cast(cast(l_quantity as decimal(10,0)) * cast(l_extendedprice as decimal(12,2)) as double) as total_price, l_shipdate as created_at
from lineitem""",
    "m_payments": """
select o_orderkey as payment_id, o_orderkey as order_id,
  case o_orderpriority when '1-URGENT' then 'credit_card' when '2-HIGH' then 'debit_card' when '3-MEDIUM' then 'paypal'
       when '4-NOT SPECIFIED' then 'bank_transfer' else 'gift_card' end as payment_method,
  case o_orderstatus when 'F' then 'completed' when 'O' then 'pending' else 'failed' end as payment_status,
  o_totalprice as amount, 'USD' as currency, o_orderdate as processed_at
from orders""",
    "m_shipping_events": """
select cast(row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) as bigint) as shipping_event_id,
  l_orderkey as order_id,
  case concat(l_returnflag, l_linestatus) when 'AF' then 'delivered' when 'AO' then 'in_transit' when 'NF' then 'picked_up'
       when 'NO' then 'label_created' when 'RF' then 'returned' else 'delivery_failed' end as event_type,
  l_shipdate as event_timestamp,
  case l_suppkey % 5 when 0 then 'UPS' when 1 then 'FedEx' when 2 then 'DHL' when 3 then 'USPS' else 'Amazon Logistics' end as carrier
from lineitem""",
    "m_product_reviews": """
select doc_id as review_id, doc_id % 197 as product_id, doc_id % 149 as user_id, cast(1 + doc_id % 5 as int) as rating,
  source as title, text as body, cast('2024-01-01' as date) as review_date
from documents""",
    "m_inventory_logs": """
select event_id as inventory_log_id, event_id % 197 as product_id,
  case event_type when 'purchase' then 'sold' when 'signup' then 'received' when 'click' then 'returned' else 'adjusted' end as event_type,
  cast(floor(value) as int) as quantity, 100 as previous_quantity,
  case when event_type in ('signup', 'click') then cast(100 + floor(value) as int)
       else greatest(cast(100 - floor(value) as int), 0) end as new_quantity, ts as event_timestamp
from events""",
    "m_cart_events": """
select event_id as cart_event_id, user_id, event_id % 197 as product_id,
  case event_type when 'purchase' then 'removed' when 'view' then 'updated' when 'error' then 'abandoned' else 'added' end as event_type,
  cast(event_id % 4 as int) as quantity, ts as event_timestamp
from events""",
}

TRIM_SET = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
EPOCH = "TIMESTAMP '2020-01-01 00:00:00'"


def _trim(c: str) -> str:
    return f"trim({c}, {TRIM_SET})"


def _text(c: str) -> str:
    return f"trim(regexp_replace({c}, '[\\r\\n\\t]+', ' ', 'g'), {TRIM_SET})"


NULL_TEXT = "CAST(NULL AS VARCHAR)"

# Source tables implied by the mapping: (column, kind, DuckDB expression over m_*).
# Kinds follow the warehouse DDL: id / int / double / str (TRIM) / text (free
# text) / ts (timestamp text) / date (timestamp text used as a day).
SOURCE_COLUMNS: dict[str, list[tuple[str, str, str]]] = {
    "users": [
        ("user_id", "id", "user_id"), ("first_name", "str", "first_name"), ("last_name", "str", "last_name"),
        ("email", "str", "email"), ("phone", "str", NULL_TEXT), ("address", "str", NULL_TEXT),
        ("city", "str", NULL_TEXT), ("state", "str", NULL_TEXT), ("country", "str", "country"),
        ("postal_code", "str", NULL_TEXT), ("created_at", "ts", "created_at"), ("updated_at", "ts", "created_at")],
    "products": [
        ("product_id", "id", "product_id"), ("category_id", "id", "category_id"), ("name", "text", "name"),
        ("description", "text", NULL_TEXT), ("price", "double", "price"), ("sku", "str", "sku"),
        ("inventory_quantity", "int", "inventory_quantity"), ("created_at", "ts", EPOCH), ("updated_at", "ts", EPOCH)],
    "categories": [
        ("category_id", "id", "category_id"), ("name", "str", "name"), ("description", "str", NULL_TEXT),
        ("created_at", "ts", EPOCH), ("updated_at", "ts", EPOCH)],
    "orders": [
        ("order_id", "id", "order_id"), ("user_id", "id", "user_id"), ("order_date", "date", "order_date"),
        ("status", "str", "status"), ("currency", "str", "currency"), ("subtotal", "double", "subtotal"),
        ("tax", "double", "tax"), ("shipping_cost", "double", "shipping_cost"),
        ("total_amount", "double", "total_amount"), ("shipping_address", "str", NULL_TEXT),
        ("billing_address", "str", NULL_TEXT), ("created_at", "ts", "created_at"), ("updated_at", "ts", "created_at")],
    "order_items": [
        ("order_item_id", "id", "order_item_id"), ("order_id", "id", "order_id"), ("product_id", "id", "product_id"),
        ("quantity", "int", "quantity"), ("unit_price", "double", "unit_price"),
        ("total_price", "double", "total_price"), ("created_at", "ts", "created_at"), ("updated_at", "ts", "created_at")],
    "payments": [
        ("payment_id", "id", "payment_id"), ("order_id", "id", "order_id"),
        ("payment_method", "str", "payment_method"), ("payment_status", "str", "payment_status"),
        ("amount", "double", "amount"), ("currency", "str", "currency"), ("transaction_id", "str", NULL_TEXT),
        ("processed_at", "ts", "processed_at"), ("created_at", "ts", "processed_at"),
        ("updated_at", "ts", "processed_at")],
    "shipping_events": [
        ("shipping_event_id", "id", "shipping_event_id"), ("order_id", "id", "order_id"),
        ("event_type", "str", "event_type"), ("event_timestamp", "ts", "event_timestamp"),
        ("carrier", "str", "carrier"), ("tracking_number", "str", NULL_TEXT), ("location", "str", NULL_TEXT),
        ("created_at", "ts", "event_timestamp"), ("updated_at", "ts", "event_timestamp")],
    "product_reviews": [
        ("review_id", "id", "review_id"), ("product_id", "id", "product_id"), ("user_id", "id", "user_id"),
        ("rating", "int", "rating"), ("title", "text", "title"), ("body", "text", "body"),
        ("review_date", "date", "review_date"), ("created_at", "ts", "CAST(review_date AS TIMESTAMP)"),
        ("updated_at", "ts", "CAST(review_date AS TIMESTAMP)")],
    "inventory_logs": [
        ("inventory_log_id", "id", "inventory_log_id"), ("product_id", "id", "product_id"),
        ("event_type", "str", "event_type"), ("quantity", "int", "quantity"),
        ("previous_quantity", "int", "previous_quantity"), ("new_quantity", "int", "new_quantity"),
        ("event_timestamp", "ts", "event_timestamp"), ("notes", "str", NULL_TEXT),
        ("created_at", "ts", "event_timestamp"), ("updated_at", "ts", "event_timestamp")],
    "cart_events": [
        ("cart_event_id", "id", "cart_event_id"), ("user_id", "id", "user_id"), ("product_id", "id", "product_id"),
        ("event_type", "str", "event_type"), ("quantity", "int", "quantity"),
        ("event_timestamp", "ts", "event_timestamp"), ("session_id", "str", NULL_TEXT),
        ("created_at", "ts", "event_timestamp"), ("updated_at", "ts", "event_timestamp")],
}

_SQL_TYPE = {"id": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}


def silver_expr(kind: str, expr: str) -> str:
    if kind in _SQL_TYPE:
        return f"CAST({expr} AS {_SQL_TYPE[kind]})"
    if kind == "str":
        return _trim(expr)
    if kind == "text":
        return _text(expr)
    if kind == "ts":
        return f"CAST({expr} AS TIMESTAMP)"
    return f"CAST({expr} AS DATE)"


def ts_text(expr: str) -> str:
    """Extract text of a timestamp: 'YYYY-MM-DD HH:MM:SS[.ffffff]+00', fraction only when non-zero."""
    micros = f"(microsecond({expr}) % 1000000)"
    frac = (f"CASE WHEN {micros} = 0 THEN '' ELSE '.' || rtrim(lpad(CAST({micros} AS VARCHAR), 6, '0'), '0') END")
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') || {frac} || '+00'"


def bronze_expr(kind: str, expr: str) -> str:
    if kind in _SQL_TYPE:
        return f"CAST({expr} AS {_SQL_TYPE[kind]})"
    if kind in ("str", "text"):
        return f"' ' || {expr} || ' '"
    return ts_text(f"CAST({expr} AS TIMESTAMP)")


TABLES = list(SOURCE_COLUMNS)


def s_view(table: str) -> str:
    cols = ",\n  ".join(f"{silver_expr(k, e)} AS {n}" for n, k, e in SOURCE_COLUMNS[table])
    return f"SELECT\n  {cols},\n  '2024-01-01' AS dt\nFROM m_{table}"


def b_view(table: str) -> str:
    """The bronze table as landed: raw text of the source columns plus ``dt``."""
    cols = ",\n  ".join(f"{bronze_expr(k, e)} AS {n}" for n, k, e in SOURCE_COLUMNS[table])
    return f"SELECT\n  {cols},\n  '2024-01-01' AS dt\nFROM m_{table}"


def with_tables(body: str, *tables: str) -> str:
    """Prefix ``body`` with the m_* and s_* CTEs it needs."""
    m_needed: list[str] = []
    for t in tables:
        if t == "products" and "m_categories" not in m_needed:
            m_needed.append("m_categories")
        if f"m_{t}" not in m_needed:
            m_needed.append(f"m_{t}")
    ctes = [f"{m} AS ({M_VIEWS[m]}\n)" for m in m_needed]
    ctes += [f"s_{t} AS ({s_view(t)}\n)" for t in tables]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def dsum(c: str) -> str:
    return f"SUM(CAST({c} AS DECIMAL(18,2)))"


def davg(c: str) -> str:
    return f"CAST({dsum(c)} AS DOUBLE) / COUNT({c})"


# --- gold marts: one aggregate per entity, then joined ---
SALE = "status IN ('delivered', 'shipped', 'processing')"
GOLD_SQL: dict[str, tuple[str, tuple[str, ...]]] = {
    # Day totals of sale orders; an order or a customer counts once a day.
    "daily_sales": (f"""
SELECT t.sale_date, ids.total_orders, who.unique_customers, t.subtotal, t.total_tax, t.total_shipping, t.total_revenue,
  t.total_revenue / t.n_amounts AS avg_order_value
FROM (SELECT order_date AS sale_date, COUNT(total_amount) AS n_amounts,
        CAST({dsum('subtotal')} AS DOUBLE) AS subtotal, CAST({dsum('tax')} AS DOUBLE) AS total_tax,
        CAST({dsum('shipping_cost')} AS DOUBLE) AS total_shipping, CAST({dsum('total_amount')} AS DOUBLE) AS total_revenue
      FROM s_orders WHERE {SALE} GROUP BY ALL) t
JOIN (SELECT order_date, COUNT(order_id) AS total_orders
      FROM (SELECT DISTINCT order_date, order_id FROM s_orders WHERE {SALE}) x GROUP BY ALL) ids
  ON ids.order_date IS NOT DISTINCT FROM t.sale_date
JOIN (SELECT order_date, COUNT(user_id) AS unique_customers
      FROM (SELECT DISTINCT order_date, user_id FROM s_orders WHERE {SALE}) x GROUP BY ALL) who
  ON who.order_date IS NOT DISTINCT FROM t.sale_date""", ("orders",)),
    # Every user, with the totals of their sale orders where they have any.
    "customer_lifetime_value": (f"""
SELECT who.user_id, who.first_name, who.last_name, who.email, who.country,
  CASE WHEN spent.user_id IS NULL THEN 0 ELSE spent.n_orders END AS total_orders,
  CAST(spent.amount AS DOUBLE) AS lifetime_value, CAST(spent.amount AS DOUBLE) / spent.n_amounts AS avg_order_value,
  spent.earliest AS first_order_date, spent.latest AS last_order_date,
  CAST(spent.latest - spent.earliest AS BIGINT) AS customer_lifespan_days
FROM (SELECT DISTINCT user_id, first_name, last_name, email, country FROM s_users) who
LEFT JOIN (SELECT user_id, COUNT(DISTINCT order_id) AS n_orders, COUNT(total_amount) AS n_amounts,
             {dsum('total_amount')} AS amount, MIN(order_date) AS earliest, MAX(order_date) AS latest
           FROM s_orders WHERE {SALE} GROUP BY user_id) spent USING (user_id)""", ("users", "orders")),
    # Sales of a product are counted once for each of its reviews (the definition's fan-out).
    "top_products": (f"""
SELECT p.product_id, p.name AS product_name, p.sku, label.name AS category_name, p.price AS unit_price,
  CAST(sold.units * COALESCE(said.n_rows, 1) AS BIGINT) AS total_units_sold, COALESCE(sold.n_orders, 0) AS total_orders,
  CAST(sold.revenue * COALESCE(said.n_rows, 1) AS DOUBLE) AS total_revenue,
  said.mean AS avg_rating, COALESCE(said.n_reviews, 0) AS total_reviews
FROM s_products p
LEFT JOIN s_categories label USING (category_id)
LEFT JOIN (SELECT product_id, SUM(quantity) AS units, {dsum('total_price')} AS revenue, COUNT(DISTINCT order_id) AS n_orders
           FROM s_order_items GROUP BY product_id) sold USING (product_id)
LEFT JOIN (SELECT product_id, COUNT(*) AS n_rows, COUNT(DISTINCT review_id) AS n_reviews, AVG(rating) AS mean
           FROM s_product_reviews GROUP BY product_id) said USING (product_id)""",
                     ("products", "categories", "order_items", "product_reviews")),
    "inventory_movement": ("""
SELECT moved.product_id, p.name AS product_name, p.sku, moved.event_type, moved.event_date, moved.event_count,
  moved.total_quantity_moved, moved.avg_stock_after_event
FROM (SELECT product_id, event_type, event_timestamp::DATE AS event_date, COUNT(*) AS event_count,
        CAST(SUM(quantity) AS BIGINT) AS total_quantity_moved, AVG(new_quantity) AS avg_stock_after_event
      FROM s_inventory_logs GROUP BY ALL) moved
LEFT JOIN s_products p USING (product_id)""", ("inventory_logs", "products")),
    "payment_success_rates": (f"""
SELECT one.payment_method, one.payment_status, one.n AS transaction_count, CAST(one.amount AS DOUBLE) AS total_amount,
  CAST(one.amount AS DOUBLE) / one.n_amounts AS avg_amount, ROUND(one.n * 100.0 / whole.n, 2) AS pct_of_method
FROM (SELECT payment_method, payment_status, COUNT(*) AS n, {dsum('amount')} AS amount, COUNT(amount) AS n_amounts
      FROM s_payments GROUP BY ALL) one
JOIN (SELECT payment_method, COUNT(*) AS n FROM s_payments GROUP BY ALL) whole
  ON one.payment_method IS NOT DISTINCT FROM whole.payment_method""", ("payments",)),
    "shipping_performance": ("""
SELECT k.*, o.orders_affected
FROM (SELECT carrier, event_type, event_timestamp::DATE AS event_date, COUNT(*) AS event_count
      FROM s_shipping_events GROUP BY ALL) k
JOIN (SELECT carrier, event_type, day, COUNT(order_id) AS orders_affected
      FROM (SELECT DISTINCT carrier, event_type, event_timestamp::DATE AS day, order_id FROM s_shipping_events) x GROUP BY ALL) o
  ON (k.carrier, k.event_type, k.event_date) IS NOT DISTINCT FROM (o.carrier, o.event_type, o.day)""", ("shipping_events",)),
}

# The same mart with every sale counted once.
TOP_PRODUCTS_EXACT = (GOLD_SQL["top_products"][0].replace(" * COALESCE(said.n_rows, 1)", ""), GOLD_SQL["top_products"][1])


def gold_cte(mart: str) -> str:
    body, _ = GOLD_SQL[mart] if mart != "top_products_exact" else TOP_PRODUCTS_EXACT
    return body


def gold_tables(mart: str) -> tuple[str, ...]:
    return (GOLD_SQL[mart] if mart != "top_products_exact" else TOP_PRODUCTS_EXACT)[1]


def gold_query(mart: str) -> str:
    return with_tables(gold_cte(mart), *gold_tables(mart))


def over_marts(body: str, *marts: str) -> str:
    """``body`` reading gold marts ``g_<mart>`` built from the mapping."""
    tables: list[str] = []
    for m in marts:
        for t in gold_tables(m):
            if t not in tables:
                tables.append(t)
    prefix = with_tables("", *tables).rstrip()
    gold_ctes = ",\n".join(f"g_{m} AS ({gold_cte(m)}\n)" for m in marts)
    return f"{prefix},\n{gold_ctes}\n{body}"


def silver_query(table: str) -> str:
    return with_tables(f"SELECT * FROM s_{table}", table)


ORACLE: dict[str, str] = {}
for _m in GOLD_SQL:
    ORACLE[f"gold_{_m}"] = gold_query(_m)
ORACLE["gold_top_products_exact"] = gold_query("top_products_exact")
for _t in TABLES:
    ORACLE[f"silver_{_t}"] = silver_query(_t)
    ORACLE[f"bronze_scan_{_t}"] = with_tables(b_view(_t), _t)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# ------------------------------------------------------------ more keys
def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _plain(expr: str, kind: str) -> str:
    """Text of a time value: fraction only where there is one, without trailing zeros."""
    return f"CAST({expr} AS VARCHAR)" if kind == "date" else f"replace({ts_text(expr)}, '+00', '')"


_COUNTS = _union([f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM m_{t}" for t in TABLES])
_COUNTS_DT = _union([f"SELECT '{t}' AS table_name, '2024-01-01' AS dt, COUNT(*) AS row_count FROM m_{t}"
                     for t in TABLES])
_PARITY = "SELECT *, CASE WHEN bronze_rows = silver_rows THEN 'OK' ELSE 'MISMATCH' END AS status FROM (" + _union(
    [f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM m_{t}) AS bronze_rows, (SELECT COUNT(*) FROM s_{t}) AS silver_rows"
     for t in TABLES]) + ") counted"
# On a later day one table was landed empty.
_EMPTY_DAY = "\nUNION ALL\nSELECT 'cart_events', '2024-01-02', CAST(0 AS BIGINT)"

ORACLE["extract_row_counts"] = with_tables(_COUNTS, *TABLES)
ORACLE["extract_typed_roundtrip"] = with_tables(_union([
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT({c}) AS n_values, "
    + ", ".join(f"{_plain(f'{f}({c})', kind)} AS {n}" for n, f in (("least", "MIN"), ("greatest", "MAX"))) + f" FROM s_{t}"
    for t, cols in SOURCE_COLUMNS.items() for c, kind, _ in cols if kind in ("ts", "date")]), *TABLES)
ORACLE["bronze_row_counts"] = with_tables(_COUNTS, *TABLES)
ORACLE["load_row_counts"] = with_tables(_COUNTS, *TABLES)
ORACLE["bronze_partitions"] = with_tables(_COUNTS_DT + _EMPTY_DAY, *TABLES)
ORACLE["raw_file_inventory"] = with_tables(_COUNTS_DT + _EMPTY_DAY, *TABLES)
ORACLE["silver_row_parity"] = with_tables(_PARITY, *TABLES)
ORACLE["bronze_external_table"] = with_tables(b_view("orders"), "orders")
ORACLE["bronze_csv_roundtrip"] = with_tables(
    "SELECT review_id, title, body FROM (" + b_view("product_reviews") + ") b", "product_reviews")
ORACLE["bronze_partition_overwrite"] = with_tables("""
SELECT '2024-01-01' AS dt, COUNT(*) AS row_count FROM m_orders
UNION ALL
SELECT '2024-01-02' AS dt, COUNT(*) AS row_count FROM m_orders WHERE status = 'delivered'""", "orders")
ORACLE["bronze_empty_extract"] = with_tables("""
SELECT '2024-01-01' AS dt, COUNT(*) AS row_count, CAST(1 AS BIGINT) AS header_lines
FROM m_orders WHERE status = 'processing'""", "orders")
ORACLE["rebuild_idempotent"] = silver_query("orders")
ORACLE["dump_csv"] = with_tables(_COUNTS, *TABLES)

# Python's whitespace class in RE2 syntax (RE2's \s is ASCII-only and lacks VT).
PY_WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _ws(c: str) -> str:
    return f"trim(regexp_replace({c}, '{PY_WS}', ' ', 'g'), ' ')"


ORACLE["raw_clean_rewrite"] = with_tables(
    f"SELECT CAST({_ws('CAST(review_id AS VARCHAR)')} AS BIGINT) AS review_id, {_ws('title')} AS title, "
    f"{_ws('body')} AS body FROM (" + b_view("product_reviews") + ") b", "product_reviews")
ORACLE["gold_row_counts"] = over_marts(
    _union([f"SELECT '{m}' AS table_name, COUNT(*) AS row_count FROM g_{m}" for m in GOLD_SQL]), *GOLD_SQL)

# --- fixed values: the constraints of the source schema ---
PRIMARY_KEYS = {
    "users": "user_id", "products": "product_id", "categories": "category_id", "orders": "order_id",
    "order_items": "order_item_id", "payments": "payment_id", "shipping_events": "shipping_event_id",
    "product_reviews": "review_id", "inventory_logs": "inventory_log_id", "cart_events": "cart_event_id"}
UNIQUE_COLUMNS = (("users", "email"), ("products", "sku"), ("categories", "name"))
# Columns that may be missing; every other one is declared NOT NULL.
OPTIONAL = {
    "users": ("phone", "address", "city", "state", "country", "postal_code"), "products": ("description",),
    "categories": ("description",), "orders": ("shipping_address", "billing_address"), "payments": ("transaction_id",),
    "shipping_events": ("carrier", "tracking_number", "location"), "product_reviews": ("title", "body"),
    "inventory_logs": ("notes",), "cart_events": ("session_id",)}
ACCEPTED = (
    ("orders", "status", "'pending', 'confirmed', 'shipped', 'delivered', 'cancelled', 'returned'"),
    ("payments", "payment_method", "'credit_card', 'debit_card', 'paypal', 'bank_transfer', 'gift_card'"),
    ("payments", "payment_status", "'pending', 'completed', 'failed', 'refunded'"),
    ("shipping_events", "event_type", "'label_created', 'picked_up', 'in_transit', 'out_for_delivery', 'delivered', "
                                      "'delivery_failed', 'returned'"),
    ("inventory_logs", "event_type", "'received', 'sold', 'adjusted', 'returned'"),
    ("cart_events", "event_type", "'added', 'removed', 'updated', 'abandoned'"))
RANGES = (
    ("products", "price", "price < 0"), ("products", "inventory_quantity", "inventory_quantity < 0"),
    ("order_items", "quantity", "quantity <= 0"), ("order_items", "unit_price", "unit_price < 0"),
    ("order_items", "total_price", "total_price < 0"), ("product_reviews", "rating", "rating < 1 OR rating > 5"),
    ("cart_events", "quantity", "quantity < 0"))
REFERENCES = (
    ("products", "category_id", "categories"), ("orders", "user_id", "users"), ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"), ("payments", "order_id", "orders"), ("shipping_events", "order_id", "orders"),
    ("product_reviews", "product_id", "products"), ("product_reviews", "user_id", "users"),
    ("inventory_logs", "product_id", "products"), ("cart_events", "user_id", "users"), ("cart_events", "product_id", "products"))
AMOUNTS = (("products", "price"), ("orders", "subtotal"), ("orders", "tax"), ("orders", "shipping_cost"),
           ("orders", "total_amount"), ("order_items", "unit_price"), ("order_items", "total_price"), ("payments", "amount"))
# Faults: rows whose key is divisible by these numbers.
REPEAT, MISSING, VALUE, RANGE, ORPHAN, SUM_ONE, CENTS = 11, 13, 17, 19, 23, 29, 31


def faulty(table: str) -> str:
    """``s_<table>`` with the planted faults; later ones win, as on the other side."""
    pk = PRIMARY_KEYS[table]
    new: dict[str, str] = {"updated_at": f"CASE WHEN {pk} % {MISSING} <> 0 THEN updated_at END"}
    for c in {"orders": ("tax",), "payments": ("amount",), "products": ("price",)}.get(table, ()):
        new[c] = f"CASE WHEN {pk} % {CENTS} = 0 THEN floor({c}) + 0.125 ELSE {c} END"
    for c in {"orders": ("total_amount",), "order_items": ("total_price",), "inventory_logs": ("new_quantity",)}.get(table, ()):
        new[c] = f"CASE WHEN {pk} % {SUM_ONE} = 0 THEN {c} + 1 ELSE {c} END"
    for c in [c for t, c, _ in ACCEPTED if t == table]:
        new[c] = f"CASE WHEN {pk} % {VALUE} = 0 THEN 'bogus' ELSE {c} END"
    for c in [c for t, c, _ in RANGES if t == table]:
        new[c] = f"CASE WHEN {pk} % {RANGE} = 0 THEN -1 ELSE {new.get(c, c)} END"
    for c in [c for t, c, _ in REFERENCES if t == table]:
        new[c] = f"CASE WHEN {pk} % {ORPHAN} = 0 THEN -1 ELSE {c} END"
    once = f"SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in new.items())}) FROM s_{table}"
    return f"{once} UNION ALL {once} WHERE {pk} % {REPEAT} = 0"


def with_faults(body: str) -> str:
    return with_tables("", *TABLES).rstrip() + ",\n" + ",\n".join(f"f_{t} AS ({faulty(t)}\n)" for t in TABLES) + "\n" + body


def _check_unique() -> str:
    parts = []
    for t, c in [*PRIMARY_KEYS.items(), *UNIQUE_COLUMNS]:
        parts.append(f"SELECT '{t}' AS table_name, 'unique({c})' AS rule, COUNT({c}) - COUNT(DISTINCT {c}) AS violations FROM f_{t}")
    return _union(parts)


def _violations(t: str, rule: str, pred: str) -> str:
    return f"SELECT '{t}' AS table_name, '{rule}' AS rule, (SELECT COUNT(*) FROM f_{t} WHERE {pred}) AS violations"


def _check_not_null() -> str:
    return _union([_violations(t, f"not_null({c})", f"{c} IS NULL") for t, cols in SOURCE_COLUMNS.items()
                   for c, _, _ in cols if c not in OPTIONAL.get(t, ())])


def _check_accepted() -> str:
    return _union([_violations(t, f"accepted({c})", f"{c} NOT IN ({values})") for t, c, values in ACCEPTED])


def _check_ranges() -> str:
    return _union([_violations(t, f"range({c})", pred) for t, c, pred in RANGES])


def _check_money() -> str:
    return _union([_violations(t, f"money({c})", f"abs({c}) >= 1e16 OR round({c}, 2) <> {c}") for t, c in AMOUNTS])


def _check_referential() -> str:
    return _union([_violations(t, f"fk({c}->{parent}.{PRIMARY_KEYS[parent]})",
                               f"{c} NOT IN (SELECT {PRIMARY_KEYS[parent]} FROM f_{parent} WHERE {PRIMARY_KEYS[parent]} IS NOT NULL)")
                   for t, c, parent in REFERENCES])


def _dec(c: str) -> str:
    return f"CAST({c} AS DECIMAL(18,2))"


_CONSISTENCY = _union([
    _violations("orders", "total_amount=subtotal+tax+shipping_cost",
                f"{_dec('total_amount')} - {_dec('shipping_cost')} - {_dec('tax')} <> {_dec('subtotal')}"),
    _violations("order_items", "total_price=quantity*unit_price",
                f"{_dec('total_price')} <> quantity::DECIMAL(10,0) * {_dec('unit_price')}"),
    _violations("inventory_logs", "new_quantity=max(previous+-quantity,0)",
                "new_quantity <> CASE WHEN event_type = 'received' OR event_type = 'returned' "
                "THEN previous_quantity + quantity WHEN previous_quantity > quantity THEN previous_quantity - quantity ELSE 0 END"),
])

ORACLE["check_unique"] = with_faults(_check_unique())
ORACLE["check_not_null"] = with_faults(_check_not_null())
ORACLE["check_accepted_values"] = with_faults(_check_accepted())
ORACLE["check_ranges"] = with_faults(_check_ranges())
ORACLE["check_referential"] = with_faults(_check_referential())
ORACLE["check_consistency"] = with_faults(_CONSISTENCY)
ORACLE["check_money"] = with_faults(_check_money())

# --- losses of the casts: every non-blank value of four damaged tables that is no value of its type ---
DAMAGED = ("orders", "products", "product_reviews", "inventory_logs")
DAMAGE = {"int": VALUE, "double": RANGE, "ts": MISSING, "date": ORPHAN}


def _check_cast_loss() -> str:
    parts = []
    for t, cols in SOURCE_COLUMNS.items():
        pk = PRIMARY_KEYS[t]
        for c, kind, expr in cols:
            if kind in ("str", "text"):
                continue
            bad = f"{pk} % {DAMAGE[kind]} = 0 AND {c} IS NOT NULL" if t in DAMAGED and kind in DAMAGE else "FALSE"
            # Short records hold no number as their key.
            extra = " + (SELECT COUNT(*) FROM s_orders WHERE order_id % 37 = 0)" if (t, c) == ("orders", "order_id") else ""
            parts.append(f"SELECT '{t}' AS table_name, 'cast_loss({c})' AS rule, "
                         f"(SELECT COUNT(*) FROM s_{t} WHERE {bad}){extra} AS violations")
        torn = ("(SELECT COUNT(*) FROM s_orders WHERE order_id % 37 = 0) + (SELECT COUNT(*) FROM s_orders WHERE order_id % 41 = 0)"
                if t == "orders" else "CAST(0 AS BIGINT)")
        parts.append(f"SELECT '{t}' AS table_name, 'field_count' AS rule, {torn} AS violations")
    return _union(parts)


ORACLE["check_cast_loss"] = with_tables(_check_cast_loss(), *TABLES)


def _silver_quarantine() -> str:
    def row(t: str, key: str, reasons: str, where: str) -> str:
        user = "COALESCE(CAST(user_id AS VARCHAR), '')" if t == "orders" else "CAST(NULL AS VARCHAR)"
        return (f"SELECT '{t}' AS table_name, '2024-01-01' AS dt, '{t}/dt=2024-01-01' AS folder, {key} AS record_key, "
                f"{user} AS order_user, {reasons} AS reasons FROM s_{t} WHERE {where}")

    parts = [row("orders", "'no number'", "'cast_loss(order_id),field_count'", "order_id % 37 = 0"),
             row("orders", "CAST(order_id AS VARCHAR)", "'field_count'", "order_id % 41 = 0")]
    for t in DAMAGED:
        pk = PRIMARY_KEYS[t]
        lost = {c: f"({pk} % {DAMAGE[kind]} = 0 AND {c} IS NOT NULL)" for c, kind, _ in SOURCE_COLUMNS[t] if kind in DAMAGE}
        # A damaged key can't be read back from its record.
        key = f"CASE WHEN {lost[pk]} THEN 'oops' ELSE CAST({pk} AS VARCHAR) END" if pk in lost else f"CAST({pk} AS VARCHAR)"
        reasons = ", ".join(f"CASE WHEN {bad} THEN 'cast_loss({c})' END" for c, bad in lost.items())
        parts.append(row(t, key, f"concat_ws(',', {reasons})", " OR ".join(lost.values())))
    return " UNION ALL ".join(parts)


ORACLE["silver_quarantine"] = with_tables(_silver_quarantine(), *DAMAGED)

# --- reports over the marts: ranked, then cut at the rank ---
def _first(n: int, columns: str, source: str, order: str) -> str:
    return f"SELECT {columns} FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM {source}) ranked WHERE place <= {n}"


def _cents(c: str) -> str:
    return f"ROUND({c}, 2) AS {c}"


ORACLE["report_silver_types"] = with_tables(_first(
    5, "user_id, first_name, last_name, email, created_at, 'timestamp' AS created_at_type", "s_users", "user_id NULLS LAST"), "users")
ORACLE["report_daily_revenue"] = over_marts(_first(
    10, f"sale_date, total_orders, unique_customers, {_cents('total_revenue')}, {_cents('avg_order_value')}",
    "g_daily_sales", "sale_date DESC NULLS LAST"), "daily_sales")
ORACLE["report_top_customers"] = over_marts(_first(
    5, f"user_id, concat_ws(' ', first_name, last_name) AS full_name, country, total_orders, {_cents('lifetime_value')}, "
       "first_order_date, last_order_date", "g_customer_lifetime_value", "lifetime_value DESC NULLS LAST, user_id"),
    "customer_lifetime_value")
ORACLE["report_best_sellers"] = over_marts(_first(
    10, f"product_name, category_name, sku, total_units_sold, total_orders, {_cents('total_revenue')}, {_cents('avg_rating')}, "
        "total_reviews", "g_top_products", "total_revenue DESC NULLS LAST, product_id"), "top_products")
# The layout of a mart doesn't change its reports.
ORACLE["report_top_customers_ranged"] = ORACLE["report_top_customers"]
ORACLE["report_best_sellers_ranged"] = ORACLE["report_best_sellers"]
ORACLE["report_payment_rates"] = over_marts(
    f"SELECT payment_method, payment_status, transaction_count, {_cents('total_amount')}, {_cents('pct_of_method')} "
    "FROM g_payment_success_rates", "payment_success_rates")
# An order counts once for each carrier, event type and day.
ORACLE["report_carrier_performance"] = with_tables("""
SELECT * FROM (SELECT carrier, event_type, COUNT(*) AS total_events FROM s_shipping_events GROUP BY ALL) n
JOIN (SELECT carrier, event_type, COUNT(order_id) AS total_orders_affected
      FROM (SELECT DISTINCT carrier, event_type, event_timestamp::DATE, order_id FROM s_shipping_events) x GROUP BY ALL) o
USING (carrier, event_type)""", "shipping_events")
ORACLE["report_low_stock"] = with_tables(
    "SELECT product_id, name, sku, inventory_quantity FROM s_products WHERE inventory_quantity BETWEEN -2147483648 AND 19", "products")

# --- keys ---
ORACLE["remap_foreign_keys"] = with_tables("""
SELECT o.o_orderkey AS order_id, o.o_custkey + 1 AS position, u.user_id
FROM orders o JOIN (SELECT user_id, row_number() OVER (ORDER BY user_id) AS pos FROM m_users) u
  ON o.o_custkey + 1 = u.pos""", "users")
_TAG = "substr(sha256('manual__2024-01-01T00:00:00+00:00'), 1, 16)"
ORACLE["append_suffix_keys"] = with_tables(f"""
SELECT 'categories' AS table_name, category_id AS key_id, name || ' ' || {_TAG} AS key_value FROM m_categories
UNION ALL
SELECT 'products', product_id, sku || '-' || {_TAG} FROM m_products
UNION ALL
SELECT 'users', user_id, regexp_replace(email, '@([^@]*)$', '') || '+' || {_TAG} || '@' || regexp_extract(email, '@([^@]*)$', 1)
FROM m_users""", "categories", "products", "users")
ORACLE["append_load"] = with_tables(f"""
, c AS (SELECT *, 1000000 + row_number() OVER (ORDER BY category_id) AS n FROM m_categories),
p AS (SELECT *, 2000000 + row_number() OVER (ORDER BY product_id) AS n FROM m_products),
u AS (SELECT *, 3000000 + row_number() OVER (ORDER BY user_id) AS n FROM m_users),
o AS (SELECT *, 4000000 + row_number() OVER (ORDER BY order_id) AS n FROM m_orders),
y AS (SELECT *, 5000000 + row_number() OVER (ORDER BY payment_id) AS n FROM m_payments)
SELECT 'categories' AS table_name, n AS key_id, CAST(NULL AS BIGINT) AS parent_id, name || ' ' || {_TAG} AS key_value FROM c
UNION ALL SELECT 'products', p.n, c.n, sku || '-' || {_TAG} FROM p JOIN c USING (category_id)
UNION ALL SELECT 'users', n, NULL, regexp_replace(email, '@([^@]*)$', '') || '+' || {_TAG} || '@' || regexp_extract(email, '@([^@]*)$', 1) FROM u
UNION ALL SELECT 'orders', o.n, u.n, NULL FROM o JOIN u USING (user_id)
UNION ALL SELECT 'payments', y.n, o.n, NULL FROM y JOIN o USING (order_id)""", "categories", "products", "users", "orders", "payments")

_LOADS = ("categories", "products", "users", "orders", "order_items", "payments", "shipping_events", "product_reviews",
          "inventory_logs", "cart_events")


def _append_load_all() -> str:
    """Rows whose parents are all there, numbered after 1, 2, .. million in the order of their old key."""
    ctes, out = [], []
    for k, t in enumerate(_LOADS):
        refs = [(c, parent) for child, c, parent in REFERENCES if child == t]
        joins = " ".join(f"JOIN l_{p} p{i} ON m.{c} = p{i}.old" for i, (c, p) in enumerate(refs))
        ids = [f"p{i}.new AS r{i}" for i in range(len(refs))] + [f"CAST(NULL AS BIGINT) AS r{i}" for i in range(len(refs), 2)]
        pk = PRIMARY_KEYS[t]
        ctes.append(f"l_{t} AS (SELECT m.{pk} AS old, {k + 1} * 1000000 + row_number() OVER (ORDER BY m.{pk}) AS new, "
                    f"{', '.join(ids)} FROM m_{t} m {joins})")
        out.append(f"SELECT '{t}' AS table_name, CAST(new AS BIGINT) AS key_id, CAST(r0 AS BIGINT) AS first_parent, "
                   f"CAST(r1 AS BIGINT) AS second_parent FROM l_{t}")
    return ", " + ",\n".join(ctes) + "\n" + _union(out)


ORACLE["append_load_all"] = with_tables(_append_load_all(), *TABLES)

# --- several snapshots ---
ORACLE["silver_latest_per_key"] = with_tables("""
, days AS (
  SELECT * FROM s_orders
  UNION ALL SELECT * REPLACE (CASE WHEN order_id % 2 = 0 THEN 'returned' ELSE status END AS status, '2024-01-02' AS dt)
    FROM s_orders WHERE order_id % 3 = 0
  UNION ALL SELECT * REPLACE ('cancelled' AS status, TIMESTAMP '2030-01-01' AS updated_at, '2024-01-02' AS dt)
    FROM s_orders WHERE order_id % 12 = 0)
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY dt DESC, updated_at DESC) AS place FROM days) WHERE place = 1""", "orders")
ORACLE["report_freshness"] = """
WITH landed AS (
  SELECT 'cart_events' AS t, CAST(ts AS DATE) AS d, CAST(count(*) AS BIGINT) AS n FROM events
  WHERE CAST(ts AS DATE) NOT IN (DATE '2024-01-10', DATE '2024-01-20') AND (CAST(ts AS DATE) <> DATE '2024-01-15' OR event_id % 10 = 0)
  GROUP BY ALL
  UNION ALL SELECT 'cart_events', DATE '2024-01-20', 0
  UNION ALL SELECT 'inventory_logs', d, n * CASE WHEN d = DATE '2024-01-05' THEN 4 ELSE 1 END
  FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-26' GROUP BY ALL) x),
days AS (
  SELECT t, CAST(unnest(generate_series(CAST(f AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT t, min(d) AS f, (SELECT max(d) FROM landed) AS e FROM landed GROUP BY t)),
seen AS (
  SELECT days.t, days.d, n, (SELECT arg_max(b.n, b.d) FROM landed b WHERE b.t = days.t AND b.d < days.d AND b.n > 0) AS p
  FROM days LEFT JOIN landed USING (t, d))
SELECT t AS table_name, strftime(d, '%Y-%m-%d') AS dt, n AS row_count, p AS previous_rows, n - p AS change,
  CASE WHEN n IS NULL THEN 'missing' WHEN n = 0 THEN 'empty' WHEN n < 0.5 * p THEN 'drop' WHEN n > 2 * p THEN 'jump' ELSE 'ok' END AS status
FROM seen"""
ORACLE["gold_daily_sales_incremental"] = with_tables(
    ", d_orders AS (SELECT * FROM s_orders WHERE order_id % 5 <> 0 UNION ALL SELECT * FROM s_orders WHERE order_id % 3 = 0)"
    + GOLD_SQL["daily_sales"][0].replace("s_orders", "d_orders"), "orders")
ORACLE["gold_sales_by_category"] = with_tables("""
, facts AS (
  SELECT c.name AS category_name, o.order_date AS sale_date, i.quantity, CAST(i.total_price AS DECIMAL(18,2)) AS paid
  FROM s_order_items i JOIN s_orders o USING (order_id) LEFT JOIN s_products p ON p.product_id = i.product_id
  LEFT JOIN s_categories c ON c.category_id = p.category_id WHERE o.status IN ('delivered', 'shipped', 'processing'))
SELECT 'category_day' AS level, category_name, sale_date, count(*) AS order_lines, CAST(sum(quantity) AS BIGINT) AS units,
  CAST(sum(paid) AS DOUBLE) AS revenue FROM facts GROUP BY category_name, sale_date
UNION ALL SELECT 'category', category_name, NULL, count(*), CAST(sum(quantity) AS BIGINT), CAST(sum(paid) AS DOUBLE) FROM facts GROUP BY category_name
UNION ALL SELECT 'day', NULL, sale_date, count(*), CAST(sum(quantity) AS BIGINT), CAST(sum(paid) AS DOUBLE) FROM facts GROUP BY sale_date
UNION ALL SELECT 'total', NULL, NULL, count(*), CAST(sum(quantity) AS BIGINT), CAST(sum(paid) AS DOUBLE) FROM facts HAVING count(*) > 0""",
                                               "orders", "order_items", "products", "categories")


def _content_parity() -> str:
    """Where the planted faults change the multiset of a column's values, or of whole rows."""
    has_tenth = "(SELECT count(*) FROM m_categories WHERE category_id % 10 = 0)"
    landed = {("categories", "name"): has_tenth, ("categories", "*"): has_tenth}
    cleaned = dict(landed)
    cleaned |= {("orders", c): "(SELECT count(*) FROM m_orders WHERE order_id % 17 = 0)" for c in ("currency", "*")}
    cleaned[("products", "*")] = ("(SELECT count(*) FROM m_products a JOIN m_products b ON b.product_id = xor(a.product_id, 1) "
                                  "WHERE a.price <> b.price)")
    for c, _, _ in SOURCE_COLUMNS["users"]:
        cleaned[("users", c)] = f"(SELECT count(*) FROM s_users a, s_users b WHERE a.user_id = 1 AND b.user_id = 2 AND a.{c} IS DISTINCT FROM b.{c})"
    cleaned[("users", "*")] = "(SELECT count(*) FROM s_users WHERE user_id = 1)"
    verdict = lambda found: f"CASE WHEN {found} > 0 THEN 'MISMATCH' ELSE 'OK' END"
    return _union([f"SELECT '{t}' AS table_name, '{c}' AS column_name, {verdict(landed.get((t, c), '0'))} AS landed, "
                   f"{verdict(cleaned.get((t, c), '0'))} AS cleaned"
                   for t, cols in SOURCE_COLUMNS.items() for c in [*(n for n, _, _ in cols), "*"]])


ORACLE["silver_content_parity"] = with_tables(_content_parity(), *TABLES)


def _contents(text) -> str:
    """Sums of MD5-derived integers of every column; ``text`` turns a text column into what the files hold."""
    parts = []
    for t, cols in SOURCE_COLUMNS.items():
        for c, kind, _ in cols:
            value = (f"CAST(CAST(round({c} * 100) AS BIGINT) AS VARCHAR)" if kind == "double"
                     else f"CAST({c} AS VARCHAR)" if kind in ("id", "int") else text(c))
            digest = f"CAST('0x' || substr(md5(coalesce('1' || {value}, '0')), 1, 15) AS BIGINT)"
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, "
                         f"CAST(coalesce(sum({digest}), 0) AS VARCHAR) AS fingerprint FROM b_{t}")
    return "".join(f", b_{t} AS ({b_view(t)})" for t in SOURCE_COLUMNS) + "\n" + _union(parts)


ORACLE["bronze_content"] = with_tables(_contents(lambda c: c), *TABLES)
ORACLE["raw_clean_content"] = with_tables(_contents(_ws), *TABLES)

# --- column functions ---
ORACLE["cast_bigint"] = """
SELECT o_orderkey AS order_id, TRY_CAST(CAST(o_custkey AS VARCHAR) AS BIGINT) AS user_id_cast,
  TRY_CAST(o_orderstatus AS BIGINT) AS status_cast FROM orders"""
ORACLE["cast_int"] = """
SELECT l_orderkey AS order_id, TRY_CAST(CAST(l_linenumber AS VARCHAR) AS INTEGER) AS line_cast,
  TRY_CAST(l_returnflag AS INTEGER) AS flag_cast FROM lineitem"""
ORACLE["cast_double"] = """
SELECT o_orderkey AS order_id, TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS price_cast,
  TRY_CAST(o_orderpriority AS DOUBLE) AS priority_cast FROM orders"""
_TS_TEXT = """CASE event_id % 6
    WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '+00'
    WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '+00'
    WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '+08'
    WHEN 3 THEN strftime(ts, '%Y-%m-%d')
    WHEN 4 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
    ELSE event_type END"""
_TS_EXPECTED = """CASE event_id % 6
    WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN ts WHEN 2 THEN NULL
    WHEN 3 THEN date_trunc('day', ts) WHEN 4 THEN date_trunc('second', ts) ELSE NULL END"""
ORACLE["clean_ts"] = f"SELECT event_id, {_TS_TEXT} AS raw, CAST({_TS_EXPECTED} AS TIMESTAMP) AS cleaned FROM events"
ORACLE["clean_date"] = f"SELECT event_id, {_TS_TEXT} AS raw, CAST({_TS_EXPECTED} AS DATE) AS cleaned FROM events"
ORACLE["clean_trim"] = f"""
SELECT doc_id, raw, {_trim('raw')} AS cleaned FROM (
  SELECT doc_id, CASE doc_id % 4
      WHEN 0 THEN ' ' || source || ' '
      WHEN 1 THEN chr(9) || source || chr(9) || ' '
      WHEN 2 THEN chr(13) || chr(10) || source || chr(13) || chr(10)
      ELSE chr(11) || chr(12) || ' ' || source END AS raw
  FROM documents) d"""
ORACLE["clean_text"] = f"SELECT doc_id, {_text('text')} AS cleaned FROM documents"
ORACLE["clean_whitespace_all"] = f"SELECT doc_id, {_ws('text')} AS cleaned, {_ws('source')} AS source FROM documents"
ORACLE["date_trunc_day"] = "SELECT event_id, CAST(ts AS DATE) AS event_date FROM events"
