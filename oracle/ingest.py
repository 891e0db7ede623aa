"""Oracle SQL for the open retail ingest over the flat-line mapping of the supplied tables."""

from __future__ import annotations

LINES = r"""
lines AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS InvoiceNo, CAST(p.p_partkey AS VARCHAR) AS StockCode,
         upper(p.p_name) AS Description, l.l_quantity AS Quantity, o.o_orderdate AS InvoiceDate,
         floor(l.l_extendedprice / l.l_quantity * 100 + 0.5) / 100 AS UnitPrice,
         CAST(o.o_custkey AS DOUBLE) AS CustomerID, n.n_name AS Country,
         (l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_extendedprice,
          l.l_quantity) AS line_no
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
typed AS (
  SELECT regexp_replace(COALESCE(CAST(InvoiceNo AS VARCHAR), 'nan'), '^\s+|\s+$', '', 'g') AS InvoiceNo,
         regexp_replace(COALESCE(CAST(StockCode AS VARCHAR), 'nan'), '^\s+|\s+$', '', 'g') AS StockCode,
         CAST(Description AS VARCHAR) AS Description,
         TRY_CAST(Quantity AS DOUBLE) AS Quantity, TRY_CAST(InvoiceDate AS TIMESTAMP) AS InvoiceDate,
         TRY_CAST(UnitPrice AS DOUBLE) AS UnitPrice, TRY_CAST(CustomerID AS DOUBLE) AS CustomerID,
         CAST(Country AS VARCHAR) AS Country, line_no
  FROM lines
),
clean AS (
  SELECT *, CAST(trunc(CustomerID) AS BIGINT) AS customer_id, CAST(InvoiceDate AS DATE) AS order_date,
         InvoiceNo || '::' || CAST(CAST(trunc(CustomerID) AS BIGINT) AS VARCHAR) AS order_key
  FROM typed
  WHERE CustomerID IS NOT NULL AND Quantity IS NOT NULL AND UnitPrice IS NOT NULL AND InvoiceDate IS NOT NULL
    AND InvoiceNo IS NOT NULL AND StockCode IS NOT NULL AND Quantity > 0 AND UnitPrice > 0
),
order_ids AS (
  SELECT order_key, CAST(dense_rank() OVER (ORDER BY order_key) AS BIGINT) AS order_id
  FROM (SELECT DISTINCT order_key FROM clean) k
),
product_ids AS (
  SELECT StockCode, CAST(dense_rank() OVER (ORDER BY StockCode) AS BIGINT) AS product_id
  FROM (SELECT DISTINCT StockCode FROM clean) k
),
items AS (
  SELECT oi.order_id, pi.product_id, CAST(trunc(c.Quantity) AS BIGINT) AS quantity,
         round_even(c.UnitPrice * 100, 0) / 100 AS unit_price, c.order_date, c.customer_id
  FROM clean c JOIN order_ids oi USING (order_key) JOIN product_ids pi USING (StockCode)
)"""

# the supplied names hold ASCII letters only, so letter runs are cased runs
CATEGORY = r"""
CASE WHEN tok = '' THEN 'General'
     ELSE array_to_string(list_transform(regexp_extract_all(lower(tok), '[a-z]+|[^a-z]+'),
                                         lambda x: upper(x[1]) || x[2:]), '') END"""

STATEMENTS = {
    "retail_clean_lines": "SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, "
                          "Country, customer_id, order_date, order_key FROM clean",
    "retail_text_lines": """
SELECT InvoiceNo, StockCode, Quantity, d + if(k % 4 = 1, INTERVAL '8 hours 26 minutes', INTERVAL 0 minutes) AS InvoiceDate,
       UnitPrice, CAST(CustomerID AS BIGINT) AS customer_id, CAST(d AS DATE) AS order_date,
       InvoiceNo || '::' || CAST(CustomerID AS BIGINT) AS order_key
FROM (SELECT *, (CAST(InvoiceNo AS BIGINT) * 7 + CAST(StockCode AS BIGINT)) % 12 AS k,
             CAST(CAST(InvoiceDate AS DATE) AS TIMESTAMP) AS d FROM lines) t
WHERE k < 5 AND Quantity > 0 AND UnitPrice > 0""",
    "retail_order_ids": "SELECT order_key, order_id FROM order_ids",
    "retail_product_ids": "SELECT StockCode, product_id FROM product_ids",
    "retail_order_items": "SELECT order_id, product_id, quantity, unit_price FROM items",
    "retail_orders": """
SELECT order_id, MIN(customer_id) AS customer_id, MIN(order_date) AS order_date, 'paid' AS status,
       ROUND(SUM(quantity * unit_price), 2) AS total_amount
FROM items GROUP BY order_id""",
    "retail_customers": """
SELECT customer_id, MIN(order_date) AS signup_date,
       first(Country ORDER BY line_no) FILTER (WHERE Country IS NOT NULL) AS country,
       printf('cust%07d@open-data.local', customer_id) AS email
FROM clean GROUP BY customer_id""",
    "retail_products": f"""
SELECT product_id, {CATEGORY} AS category, (SELECT MIN(order_date) FROM clean) AS created_at
FROM (
  SELECT StockCode,
         trim(regexp_extract(regexp_replace(COALESCE(d, 'nan'), '^\\s+|\\s+$', '', 'g'), '^(\\S+)', 1),
              '.,;:-_') AS tok
  FROM (SELECT StockCode, first(Description ORDER BY line_no) AS d FROM clean GROUP BY StockCode) f
) t JOIN product_ids USING (StockCode)""",
}


def statement(name: str) -> str:
    return "WITH " + LINES + "\n" + STATEMENTS[name]
