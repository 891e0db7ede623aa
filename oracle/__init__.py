"""DuckDB oracle SQL for every registered query.

Each statement starts from the pre-registered supplied tables, rebuilds the
raw shop tables with the same mapping as ``tillroll.sources.tpch`` and then
states the staging, mart and metric rules in its own SQL.  Where the rules' double arithmetic is not reproducible (ratios of sums, moving
averages) the oracle uses the same exact-cents formulation as the Spark code.
"""

from __future__ import annotations

RAW = """
r_customers AS (
  SELECT c.c_custkey AS customer_id,
         fo.signup_date,
         ' ' || lower(n.n_name) || ' ' AS country,
         CASE WHEN c.c_custkey % 100 = 0 THEN NULL
              WHEN c.c_custkey % 100 = 50 THEN '  '
              ELSE ' ' || c.c_name || '@Example.com' END AS email
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS signup_date
             FROM orders GROUP BY o_custkey) fo ON fo.o_custkey = c.c_custkey
),
r_products AS (
  SELECT p_partkey AS product_id, p_type || ' ' AS category,
         (SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders) AS created_at
  FROM part
),
r_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         CASE WHEN o_orderstatus = 'F' THEN ' PAID '
              WHEN o_orderstatus = 'O' THEN 'paid'
              WHEN o_orderkey % 10 <= 3 THEN 'cancelled'
              WHEN o_orderkey % 10 <= 6 THEN 'Canceled'
              WHEN o_orderkey % 10 <= 8 THEN 'REFUNDED'
              ELSE 'pending' END AS status,
         o_totalprice AS total_amount
  FROM orders
),
r_order_items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 AS unit_price
  FROM lineitem
)"""

STAGING = """
stg_customers AS (
  SELECT customer_id::BIGINT AS customer_id, signup_date, upper(trim(country)) AS country,
         CASE WHEN trim(email) <> '' THEN lower(trim(email)) END AS email
  FROM r_customers
),
stg_products AS (SELECT product_id::BIGINT AS product_id, trim(category) AS category, created_at FROM r_products),
spellings(spelling, meaning) AS (
  VALUES ('paid', 'paid'), ('canceled', 'canceled'), ('cancelled', 'canceled'), ('refunded', 'refunded')
),
stg_orders AS (
  SELECT r.order_id::BIGINT AS order_id, r.customer_id::BIGINT AS customer_id, r.order_date,
         coalesce(s.meaning, 'unknown') AS order_status, r.total_amount::DOUBLE AS total_amount
  FROM r_orders r LEFT JOIN spellings s ON s.spelling = lower(trim(r.status))
),
stg_order_items AS (
  SELECT order_id::BIGINT AS order_id, product_id::BIGINT AS product_id, quantity::INTEGER AS quantity,
         unit_price::DOUBLE AS unit_price
  FROM r_order_items
)"""

# item sums per order come from a window over the items; an order keeps one of its items' rows
MARTS = """
dim_customers AS (FROM stg_customers),
dim_products AS (FROM stg_products),
fct_order_items AS (SELECT *, round(unit_price * quantity, 2) AS item_total FROM stg_order_items),
amounts AS (
  SELECT DISTINCT order_id, round(sum(item_total) OVER o, 2) AS amount, count(*) OVER o AS lines
  FROM fct_order_items WINDOW o AS (PARTITION BY order_id)
),
fct_orders AS (
  SELECT s.order_id, s.customer_id, s.order_date, s.order_status, t.total AS order_total_amount,
         t.items AS order_amount_from_items, round(t.total - t.items, 2) AS reconciliation_delta,
         ifnull(a.lines, 0) AS item_lines
  FROM stg_orders s LEFT JOIN amounts a ON a.order_id = s.order_id,
       LATERAL (SELECT round(s.total_amount, 2) AS total, ifnull(a.amount, 0.0) AS items) t
)"""


def with_warehouse(body: str, *ctes: str) -> str:
    """``WITH <raw, staging, marts>[, extra CTEs] <body>``."""
    parts = [RAW, STAGING, MARTS, *ctes]
    return "WITH " + ",".join(parts) + "\n" + body
