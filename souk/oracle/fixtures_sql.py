"""The fixture mapping of ``souk.sources.fixtures`` written as DuckDB SQL.

Each entry is the body of one CTE over the driver's pre-registered views.
Variant rows are added with UNION ALL instead of an exploded tag array.
"""

DAYS = "to_days(CAST({} AS INTEGER))"
HOURS = "to_hours(CAST({} AS INTEGER))"


def _d(expr: str) -> str:
    return DAYS.format(expr)


def _h(expr: str) -> str:
    return HOURS.format(expr)


RAW = {}

RAW["raw_customers"] = """
WITH b AS (
  SELECT o.o_orderkey AS k, o.o_custkey, c.c_custkey, c.c_mktsegment, n.n_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
), v AS (
  SELECT *, 0 AS v FROM b
  UNION ALL SELECT *, 1 FROM b WHERE k % 500 = 1
  UNION ALL SELECT *, 2 FROM b WHERE k % 1500 = 1
  UNION ALL SELECT *, 3 FROM b WHERE k % 701 = 2
)
SELECT
  CASE WHEN k % 983 = 0 THEN NULL ELSE 'C' || k END AS customer_id,
  CASE WHEN o_custkey % 3 = 0 THEN 'S' || k ELSE 'U' || o_custkey END AS customer_unique_id,
  CAST(CASE WHEN k % 811 = 0 THEN 99 ELSE 1000 + (c_custkey * 37) % 98000 END AS INTEGER) AS customer_zip_code_prefix,
  CASE WHEN v = 3 THEN 'other' ELSE '  ' || c_mktsegment || ' ' END AS customer_city,
  ' ' || lower(n_name) AS customer_state
FROM v
"""

RAW["raw_orders"] = f"""
WITH b AS (
  SELECT o_orderkey AS k,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
      ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'cancelled' ELSE 'processing' END END AS status,
    CAST(o_orderdate AS TIMESTAMP) + {_h('o_orderkey % 24')} AS ts
  FROM orders
), v AS (
  SELECT *, 0 AS v FROM b
  UNION ALL SELECT *, 1 FROM b WHERE k % 750 = 3
  UNION ALL SELECT *, 2 FROM b WHERE k % 1500 = 3
  UNION ALL SELECT *, 3 FROM b WHERE k % 900 = 4
)
SELECT
  CASE WHEN k % 997 = 0 THEN NULL ELSE 'O' || k END AS order_id,
  'C' || k AS customer_id,
  CASE WHEN v = 3 THEN 'processing' ELSE status END AS order_status,
  ts AS order_purchase_timestamp,
  CASE WHEN k % 53 = 0 THEN NULL WHEN k % 211 = 0 THEN ts - {_d('1')}
       ELSE ts + {_d('k % 12')} END AS order_approved_at,
  CASE WHEN status IN ('delivered', 'shipped') THEN ts + {_d('8 + k % 9')} END AS order_delivered_carrier_date,
  CASE WHEN status = 'delivered' THEN ts + {_d('5 + k % 60')} + {_h('5')} END AS order_delivered_customer_date,
  ts + {_d('25')} AS order_estimated_delivery_date
FROM v
"""

RAW["raw_order_items"] = """
WITH b AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_tax, l_shipdate FROM lineitem
), v AS (
  SELECT * FROM b UNION ALL SELECT * FROM b WHERE l_orderkey % 700 = 1
)
SELECT
  CASE WHEN l_orderkey % 997 = 0 THEN NULL WHEN l_orderkey % 613 = 5 THEN 'X' || l_orderkey
       ELSE 'O' || l_orderkey END AS order_id,
  CAST(l_linenumber AS INTEGER) AS order_item_id,
  'P' || l_partkey AS product_id,
  'V' || l_suppkey AS seller_id,
  CAST(l_shipdate AS TIMESTAMP) AS shipping_limit_date,
  CASE (l_orderkey + l_partkey) % 499 WHEN 0 THEN NULL
       WHEN 1 THEN -CAST(l_extendedprice AS DECIMAL(12,2)) WHEN 2 THEN CAST(0 AS DECIMAL(12,2))
       ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS price,
  CASE l_partkey % 333 WHEN 5 THEN CAST(-1 AS DECIMAL(12,2)) WHEN 6 THEN NULL
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2))
       END AS freight_value
FROM v
"""

RAW["raw_payments"] = """
WITH b AS (
  SELECT o_orderkey AS k, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 50 <> 7
), v AS (
  SELECT *, 0 AS v FROM b
  UNION ALL SELECT *, 1 FROM b WHERE k % 7 = 0
  UNION ALL SELECT *, 2 FROM b WHERE k % 800 = 9
)
SELECT
  CASE WHEN k % 997 = 0 THEN NULL WHEN k % 613 = 6 THEN 'X' || k ELSE 'O' || k END AS order_id,
  CAST(CASE WHEN v = 1 THEN 2 ELSE 1 END AS INTEGER) AS payment_sequential,
  CASE WHEN v = 1 THEN 'voucher' WHEN k % 401 = 0 THEN 'crypto' WHEN k % 401 = 1 THEN NULL
       WHEN o_orderpriority = '1-URGENT' THEN 'credit_card' WHEN o_orderpriority = '2-HIGH' THEN 'boleto'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'voucher' ELSE 'debit_card' END AS payment_type,
  CAST(CASE WHEN k % 307 = 0 THEN 0 ELSE 1 + k % 10 END AS INTEGER) AS payment_installments,
  CASE WHEN v = 1 THEN CAST(10.00 AS DECIMAL(12,2)) WHEN k % 601 = 0 THEN CAST(0 AS DECIMAL(12,2))
       WHEN k % 601 = 1 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS payment_value
FROM v
"""

RAW["raw_products"] = """
WITH b AS (SELECT p_partkey, p_name, p_type, p_size FROM part),
v AS (
  SELECT *, 0 AS v FROM b
  UNION ALL SELECT *, 1 FROM b WHERE p_partkey % 400 = 1
  UNION ALL SELECT *, 2 FROM b WHERE p_partkey % 450 = 2
)
SELECT
  CASE WHEN p_partkey % 997 = 0 THEN NULL ELSE 'P' || p_partkey END AS product_id,
  CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE '  ' || p_type || ' ' END AS product_category_name,
  CAST(length(p_name) AS INTEGER) AS product_name_length,
  CAST(10 * p_size AS INTEGER) AS product_description_length,
  CAST(1 + p_partkey % 6 AS INTEGER) AS product_photos_qty,
  CAST(CASE WHEN p_partkey % 101 = 0 THEN NULL
       ELSE p_size * 100 + CASE WHEN v = 2 THEN 1 ELSE 0 END END AS DECIMAL(12,2)) AS product_weight_g,
  CAST(p_size AS DECIMAL(10,2)) AS product_length_cm,
  CAST(1 + p_partkey % 20 AS DECIMAL(10,2)) AS product_height_cm,
  CAST(1 + p_partkey % 30 AS DECIMAL(10,2)) AS product_width_cm
FROM v
"""

RAW["raw_sellers"] = """
WITH b AS (
  SELECT s_suppkey, s_nationkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
), v AS (
  SELECT *, 0 AS v FROM b
  UNION ALL SELECT *, 1 FROM b WHERE s_suppkey % 50 = 1
  UNION ALL SELECT *, 2 FROM b WHERE s_suppkey % 60 = 2
)
SELECT
  CASE WHEN s_suppkey % 97 = 0 THEN NULL ELSE 'V' || s_suppkey END AS seller_id,
  CAST(1000 + (s_suppkey * 41) % 98000 AS INTEGER) AS seller_zip_code_prefix,
  CASE WHEN v = 2 THEN 'other' ELSE ' City' || s_nationkey END AS seller_city,
  ' ' || lower(n_name) AS seller_state
FROM v
"""

RAW["raw_reviews"] = f"""
WITH b AS (
  SELECT o_orderkey AS k, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate,
    CASE WHEN o_orderkey % 419 = 0 THEN 9 WHEN o_orderkey % 419 = 1 THEN NULL
         ELSE 1 + (o_orderkey * 7) % 5 END AS score
  FROM orders WHERE o_orderkey % 3 <> 0
), v AS (
  SELECT *, 0 AS v FROM b
  UNION ALL SELECT *, 1 FROM b WHERE k % 800 = 5
  UNION ALL SELECT *, 2 FROM b WHERE k % 650 = 7
)
SELECT
  CASE WHEN k % 991 = 0 THEN NULL ELSE 'R' || (k - k % 2) END AS review_id,
  'O' || k AS order_id,
  CAST(CASE WHEN v = 2 THEN CASE WHEN score = 1 THEN 2 ELSE 1 END ELSE score END AS INTEGER) AS review_score,
  CASE WHEN k % 2 = 0 THEN NULL ELSE ' t ' END AS review_comment_title,
  ' msg ' AS review_comment_message,
  o_orderdate + {_d('30')} AS review_creation_date,
  o_orderdate + {_d('32')} AS review_answer_timestamp
FROM v
"""

RAW["raw_geolocation"] = """
WITH b AS (SELECT c_custkey, c_nationkey, c_mktsegment FROM customer),
v AS (
  SELECT *, 0 AS v FROM b
  UNION ALL SELECT *, 1 FROM b WHERE c_custkey % 100 = 1
  UNION ALL SELECT *, 2 FROM b WHERE c_custkey % 120 = 2
)
SELECT
  CAST(1000 + (c_custkey * 37) % 98000 AS INTEGER) AS geolocation_zip_code_prefix,
  CAST(CASE WHEN c_custkey % 89 = 0 THEN NULL WHEN c_custkey % 83 = 0 THEN 12.5
       ELSE -33 + CAST(c_custkey * 13 % 380 AS DECIMAL(18,1)) / 10 END AS DECIMAL(18,8)) AS geolocation_lat,
  CAST(-73 + CAST(c_custkey * 17 % 380 AS DECIMAL(18,1)) / 10 AS DECIMAL(18,8)) AS geolocation_lng,
  CASE WHEN v = 2 THEN upper(c_mktsegment) ELSE lower(c_mktsegment) END AS geolocation_city,
  'n' || c_nationkey AS geolocation_state
FROM v
"""

RAW["raw_category_translation"] = """
WITH t AS (
  SELECT DISTINCT p_type AS product_category_name, 'en_' || lower(p_type) AS product_category_name_english
  FROM part WHERE p_type <> 'PROMO'
)
SELECT * FROM t
UNION ALL SELECT * FROM t WHERE product_category_name = 'SMALL'
UNION ALL SELECT CAST(NULL AS VARCHAR), 'none'
UNION ALL SELECT ' large ', 'en_big'
"""
