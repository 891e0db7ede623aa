"""Oracle statements, one per registered query name."""

from __future__ import annotations

from oracle import ingest as _ingest
from oracle import quality as _q
from oracle import with_warehouse

ORACLE: dict[str, str] = {}

ORACLE["raw_row_counts"] = with_warehouse("""
SELECT 'customers' AS "table", CAST(COUNT(*) AS BIGINT) AS rows FROM r_customers
UNION ALL SELECT 'products', COUNT(*) FROM r_products
UNION ALL SELECT 'orders', COUNT(*) FROM r_orders
UNION ALL SELECT 'order_items', COUNT(*) FROM r_order_items""")

for _name in ("stg_customers", "stg_products", "stg_orders", "stg_order_items",
              "dim_customers", "dim_products", "fct_order_items", "fct_orders"):
    ORACLE[_name] = with_warehouse(f"SELECT * FROM {_name}")

# every amount as whole cents; a day's sums are exact
_CENTS = """
amounts_in_cents AS (SELECT *, CAST(round(100 * order_amount_from_items) AS BIGINT) AS cents FROM fct_orders),
paid AS (FROM amounts_in_cents WHERE order_status = 'paid')"""


def _total(cents: str, condition: str = "true") -> str:
    return f"CAST(coalesce(sum({cents}) FILTER ({condition}), 0) AS BIGINT)"


_NET = f"({_total('cents', condition="order_status = 'paid'")} - {_total('cents', condition="order_status = 'refunded'")})"
# a ratio of whole cents, rounded half away from zero
_MEAN = "CAST(sign({c}) * ((2 * abs({c}) + {n}) // (2 * {n})) AS BIGINT) / 100"

ORACLE["m_gmv_daily"] = with_warehouse(
    f"SELECT order_date AS metric_date, {_total('cents')} / 100 AS gmv FROM paid GROUP BY order_date ORDER BY metric_date", _CENTS)
ORACLE["m_orders_daily"] = with_warehouse(
    "SELECT order_date AS metric_date, count(*) AS orders FROM paid GROUP BY order_date ORDER BY metric_date", _CENTS)
ORACLE["m_aov_daily"] = with_warehouse(f"""
SELECT order_date AS metric_date, c / 100 AS gmv, n AS orders, {_MEAN.format(c="c", n="n")} AS aov
FROM (SELECT order_date, {_total('cents')} AS c, count(*) AS n FROM paid GROUP BY order_date) ORDER BY metric_date""", _CENTS)
ORACLE["m_active_customers_daily"] = with_warehouse("""
SELECT order_date AS metric_date, count(customer_id) AS active_customers
FROM (SELECT DISTINCT order_date, customer_id FROM paid) GROUP BY order_date ORDER BY metric_date""", _CENTS)
ORACLE["m_net_gmv_daily"] = with_warehouse(f"""
SELECT order_date AS metric_date, {_NET} / 100 AS net_gmv FROM amounts_in_cents GROUP BY order_date ORDER BY metric_date""", _CENTS)

# a customer's cohort is the first month of its paid orders, by a window; sizes are the cells of month 0
def _retention(orders: str) -> str:
    return f"""
months AS (
  SELECT DISTINCT customer_id, date_trunc('month', order_date)::DATE AS m
  FROM {orders} WHERE order_status = 'paid' AND customer_id IS NOT NULL
),
placed AS (SELECT *, min(m) OVER (PARTITION BY customer_id) AS cohort_month FROM months),
cells AS (
  SELECT cohort_month, (year(m) - year(cohort_month)) * 12 + month(m) - month(cohort_month) AS month_n,
         count(*) AS retained_customers
  FROM placed WHERE cohort_month IS NOT NULL GROUP BY ALL
),
retention AS (
  SELECT *, max(retained_customers) FILTER (month_n = 0) OVER (PARTITION BY cohort_month) AS cohort_size,
         retained_customers::DOUBLE / cohort_size AS rate
  FROM cells
)"""


RETENTION_CTES = _retention("fct_orders")

ORACLE["m_retention_cohort"] = with_warehouse("""
SELECT cohort_month, month_n, retained_customers, cohort_size, ROUND(rate, 4) AS retention_rate
FROM retention ORDER BY 1, 2""", RETENTION_CTES)

# --- explore ---------------------------------------------------------------------------------

# orders in scope by their dates, countries and categories; without a choice, from the first paid day to the last
_PAID_DAYS = """order_date BETWEEN (SELECT ifnull(min(order_date), current_date) FROM fct_orders WHERE order_status = 'paid')
                AND (SELECT ifnull(max(order_date), current_date) FROM fct_orders WHERE order_status = 'paid')"""
_YEARS = "order_date >= DATE '1996-01-01' AND order_date < DATE '2001-01-01'"
_FOUR_NATIONS = "regexp_matches(country, '^NATION_(1|7|13|21)$')"
_TWO_CATEGORIES = """EXISTS (FROM fct_order_items JOIN dim_products USING (product_id)
          WHERE order_id = amounts_in_cents.order_id AND (category = 'PROMO' OR category = 'SMALL'))"""


def _scope(days: str, buyers: str = "true", orders: str = "true") -> str:
    return f"""{_CENTS},
buyers AS (SELECT customer_id FROM dim_customers WHERE {buyers}),
scoped AS (FROM amounts_in_cents SEMI JOIN buyers USING (customer_id) WHERE {days} AND {orders})"""


_ALL, _SAMPLE = _scope(_PAID_DAYS), _scope(_YEARS, _FOUR_NATIONS, _TWO_CATEGORIES)
_SERIES = f"""
SELECT order_date AS metric_date, {_total('cents')} / 100 AS gmv, count(*) AS orders
FROM scoped WHERE order_status = 'paid' GROUP BY order_date"""
_NET_SERIES = f"""
SELECT order_date AS metric_date, {_NET} / 100 AS net_gmv
FROM scoped WHERE order_status = 'paid' OR order_status = 'refunded' GROUP BY order_date"""

ORACLE["daily_series"] = with_warehouse(_SERIES + " ORDER BY metric_date", _ALL)
ORACLE["daily_series_filtered"] = with_warehouse(_SERIES + " ORDER BY metric_date", _SAMPLE)
ORACLE["filtered_orders"] = with_warehouse("SELECT * EXCLUDE (cents) FROM scoped WHERE order_status = 'paid'", _SAMPLE)
ORACLE["net_series"] = with_warehouse(_NET_SERIES + " ORDER BY metric_date", _ALL)
ORACLE["net_series_filtered"] = with_warehouse(_NET_SERIES + " ORDER BY metric_date", _SAMPLE)

# lines are summed per order and category first, then over the orders in scope
_SOLD = """
sold AS (
  SELECT order_id, category, sum(CAST(round(100 * item_total) AS BIGINT)) AS line_cents
  FROM dim_products JOIN fct_order_items USING (product_id) GROUP BY order_id, category
)"""


def _top(categories: str = "true") -> str:
    return f"""
SELECT category, {_total('line_cents')} / 100 AS gmv
FROM sold SEMI JOIN (FROM scoped WHERE order_status = 'paid') USING (order_id)
WHERE {categories} GROUP BY category ORDER BY gmv DESC, category LIMIT 10"""


ORACLE["top_categories"] = with_warehouse(_top(), _ALL, _SOLD)
ORACLE["top_categories_filtered"] = with_warehouse(
    _top("regexp_matches(category, '^(PROMO|SMALL|LARGE)$')"), _scope(_YEARS, _FOUR_NATIONS), _SOLD)

_RECENT = """
recent AS (
  SELECT metric_date, orders, CAST(round(100 * gmv) AS BIGINT) AS c, max(metric_date) OVER () - metric_date AS age FROM series
)"""
ORACLE["kpi_windows"] = with_warehouse(f"""
SELECT c30 / 100 AS gmv_30d, n30 AS orders_30d, c90 / 100 AS gmv_90d, n90 AS orders_90d,
       if(n90 = 0, 0, {_MEAN.format(c="c90", n="n90")}) AS aov_90d, start_30d, end_30d, start_90d, end_90d
FROM (
  SELECT {_total('c', 'age < 30')} AS c30, {_total('orders', 'age < 30')} AS n30,
         {_total('c', 'age < 90')} AS c90, {_total('orders', 'age < 90')} AS n90,
         min(metric_date) FILTER (age < 30) AS start_30d, max(metric_date) FILTER (age < 30) AS end_30d,
         min(metric_date) FILTER (age < 90) AS start_90d, max(metric_date) FILTER (age < 90) AS end_90d
  FROM recent)""", _ALL, f"series AS ({_SERIES})", _RECENT)

ORACLE["net_gmv_30d"] = with_warehouse(f"""
SELECT {_total('CAST(round(100 * net_gmv) AS BIGINT)', 'age < 30')} / 100 AS net_gmv_30d
FROM (SELECT net_gmv, max(metric_date) OVER () - metric_date AS age FROM net)""", _ALL, f"net AS ({_NET_SERIES})")

ORACLE["daily_ma7"] = with_warehouse("""
SELECT metric_date, c / 100.0 AS gmv,
       CAST(SUM(c) OVER w AS DOUBLE) / (CAST(COUNT(*) OVER w AS DOUBLE) * 100.0) AS gmv_ma7,
       n AS orders,
       CAST(SUM(n) OVER w AS DOUBLE) / COUNT(*) OVER w AS orders_ma7
FROM dense
WINDOW w AS (ORDER BY metric_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
ORDER BY metric_date""",
    _ALL, f"series AS ({_SERIES})",
    """
spine AS (
  SELECT CAST(unnest(generate_series(CAST(MIN(metric_date) AS TIMESTAMP), CAST(MAX(metric_date) AS TIMESTAMP),
                                     INTERVAL 1 DAY)) AS DATE) AS metric_date
  FROM series
),
dense AS (
  SELECT sp.metric_date, COALESCE(CAST(ROUND(s.gmv * 100) AS BIGINT), 0) AS c, COALESCE(s.orders, 0) AS n
  FROM spine sp LEFT JOIN series s USING (metric_date)
)""")

# months 0 to 78: the offsets of the supplied orders at the comparison scale (a view needs fixed columns)
ORACLE["cohort_matrix"] = with_warehouse(
    "SELECT cohort_month, cohort_size, "
    + ", ".join(f'max(rate) FILTER (month_n = {n}) AS "{n}"' for n in range(79))
    + " FROM retention GROUP BY cohort_month, cohort_size ORDER BY cohort_month", RETENTION_CTES)

ORACLE["filter_bounds"] = with_warehouse("""
SELECT if(first IS NULL OR last IS NULL, DATE '2001-08-15', first) AS min_date,
       if(first IS NULL OR last IS NULL, DATE '2001-08-15', last) AS max_date
FROM (SELECT min(order_date) AS first, max(order_date) AS last FROM paid)""", _CENTS)

ORACLE["filter_options"] = with_warehouse("""
SELECT 'country' AS option, country AS value FROM dim_customers SEMI JOIN paid USING (customer_id) WHERE country IS NOT NULL
UNION
SELECT 'category', category FROM dim_products
WHERE category IS NOT NULL AND product_id IN (SELECT product_id FROM fct_order_items SEMI JOIN paid USING (order_id))
ORDER BY option, value""", _CENTS)

_WINDOW = "order_date >= DATE '2001-05-03'"  # 90 days before 2001-08-01
ORACLE["metrics_eval_window"] = with_warehouse(f"""
SELECT order_date AS metric_date, {_total('cents')} / 100 AS gmv FROM paid WHERE {_WINDOW}
GROUP BY order_date ORDER BY metric_date""", _CENTS)

ORACLE["metrics_manifest"] = with_warehouse(f"""
SELECT unnest(['m_gmv_daily', 'm_orders_daily', 'm_aov_daily', 'm_active_customers_daily']) AS metric, paid_days AS rows
FROM (SELECT count(DISTINCT order_date) AS paid_days FROM paid WHERE {_WINDOW})
UNION ALL SELECT 'm_net_gmv_daily', count(DISTINCT order_date) FROM fct_orders WHERE {_WINDOW}
UNION ALL SELECT 'm_retention_cohort', count(*) FROM retention WHERE cohort_month >= DATE '2001-05-03'""", _CENTS, RETENTION_CTES)

# --- quality -------------------------------------------------------------------


# fixed values, stated here so that a wrong constant of the library shows: rules, family order, as-of date
_AS_OF = "2001-08-15"
_CONFIG = {
    "null_rate_thresholds": {
        "customers.email": {"warn": 0.01, "fail": 0.03},
        "orders.status": {"warn": 0.00, "fail": 0.01},
    },
    "pk_uniqueness": ["customers.customer_id", "products.product_id", "orders.order_id"],
    "ranges": {
        "orders.total_amount": {"min": 0, "max": 200000, "severity": "fail"},
        "order_items.quantity": {"min": 1, "max": 50, "severity": "fail"},
        "order_items.unit_price": {"min": 0.01, "max": 50000, "severity": "fail"},
    },
    "freshness": {"orders.order_date_max_age_days": {"warn": 7, "fail": 30}},
}
_FAMILIES = ["freshness", "null_rate", "numeric_ranges", "pk_uniqueness", "referential_integrity", "schema_existence"]
_RELATIONS = ["customers", "products", "orders", "order_items", "stg_customers", "stg_products", "stg_orders",
              "stg_order_items", "dim_customers", "dim_products", "fct_orders", "fct_order_items"]
_REFERENCES = ["orders.customer_id -> customers.customer_id", "order_items.order_id -> orders.order_id",
               "order_items.product_id -> products.product_id", "orders.order_id -> order_items.order_id"]
_B = {family: 100_000 * i for i, family in enumerate(_FAMILIES)}
_fresh = _q.freshness(_CONFIG["freshness"], _AS_OF, _B["freshness"])
_nulls = _q.null_rate(_CONFIG["null_rate_thresholds"], _B["null_rate"])
_ranges = _q.ranges(_CONFIG["ranges"], _B["numeric_ranges"])
_pks = _q.pk(_CONFIG["pk_uniqueness"], _B["pk_uniqueness"])
_ris = _q.ri(_REFERENCES, _B["referential_integrity"])
_schema = _q.schema(_RELATIONS, _B["schema_existence"])
_all = _fresh + _nulls + _ranges + _pks + _ris + _schema

ORACLE["dq_null_rate"] = _q.checks(_nulls)
ORACLE["dq_pk_uniqueness"] = _q.checks(_pks)
ORACLE["dq_numeric_range"] = _q.checks(_ranges)
ORACLE["dq_freshness"] = _q.checks(_fresh)
ORACLE["dq_referential_integrity"] = _q.checks(_ris)
ORACLE["dq_report"] = _q.checks(_all)
ORACLE["dq_summary"] = with_warehouse(f"""
SELECT status, CAST(SUM(c) AS BIGINT) AS count FROM (
  SELECT status, 1 AS c FROM ({_q.union(_all)}) u
  UNION ALL SELECT 'pass', 0 UNION ALL SELECT 'warn', 0 UNION ALL SELECT 'fail', 0
) s GROUP BY status""")
ORACLE["dq_failed"] = with_warehouse(f"""
SELECT check_type AS check_name,
       CASE WHEN instr(target, '.') > 0 THEN substr(target, instr(target, '.') + 1) ELSE '' END AS "column",
       status, message
FROM ({_q.union(_all)}) u WHERE lower(status) = 'fail' ORDER BY _o LIMIT 20""")

ORACLE["dq_warned"] = with_warehouse(f"""
SELECT check_type AS check_name,
       CASE WHEN instr(target, '.') > 0 THEN substr(target, instr(target, '.') + 1) ELSE '' END AS "column",
       status, message
FROM ({_q.union(_all)}) u WHERE lower(status) = 'warn' ORDER BY _o LIMIT 20""")


# --- open retail ingest ---------------------------------------------------------------------


for _name in _ingest.STATEMENTS:
    ORACLE[_name] = _ingest.statement(_name)

# --- sources and sinks round trips: same rows as the in-memory relations -------------------------

ORACLE["raw_csv_row_counts"] = ORACLE["raw_row_counts"]
ORACLE["stored_fct_orders"] = ORACLE["fct_orders"]

_AWKWARD_CUSTOMERS = """
odd AS (
  SELECT customer_id, signup_date,
         if(customer_id % 3 = 0, ' the "' || country || '", north ', country) AS country,
         if(customer_id % 3 = 1, '"' || email || '", x@Y.z', email) AS email
  FROM r_customers
)"""
ORACLE["csv_stg_customers"] = with_warehouse("""
SELECT customer_id::BIGINT AS customer_id, signup_date, upper(trim(country)) AS country,
       nullif(lower(trim(email)), '') AS email FROM odd""", _AWKWARD_CUSTOMERS)
ORACLE["csv_stg_products"] = with_warehouse("""
SELECT product_id, trim('  "' || p.category || ', "" a,b  ') AS category, created_at FROM r_products p""")
ORACLE["csv_stg_orders"] = ORACLE["stg_orders"]
ORACLE["csv_stg_order_items"] = ORACLE["stg_order_items"]
ORACLE["export_roundtrip"] = with_warehouse("""
SELECT customer_id || '.0' AS id, country AS label, email AS note FROM odd""", _AWKWARD_CUSTOMERS)

ORACLE["user_sql_metric"] = with_warehouse("""
SELECT country, count(*) AS orders, count(DISTINCT customer_id) AS customers
FROM fct_orders JOIN dim_customers USING (customer_id) GROUP BY country""")
ORACLE["m_retention_null_dates"] = with_warehouse("""
SELECT cohort_month, month_n, retained_customers, cohort_size, round(rate, 4) AS retention_rate FROM retention""", """
blanked AS (
  SELECT * REPLACE (if(order_id % 7 = 0 OR customer_id % 5 = 0, NULL, order_date) AS order_date) FROM fct_orders
)""", _retention("blanked"))
ORACLE["stg_half_quantities"] = with_warehouse("""
SELECT order_id, product_id, CAST(quantity / 2 AS INTEGER) AS quantity, unit_price FROM r_order_items""")

ORACLE["csv_line_breaks"] = with_warehouse("""
SELECT customer_id::BIGINT AS customer_id, signup_date,
       upper(trim(country || if(customer_id % 3 = 0, chr(10) || chr(10) || '"north", ' || chr(10) || 'or south', ''))) AS country,
       nullif(lower(trim(if(customer_id % 4 = 1, '"' || chr(10) || email || chr(13) || chr(10) || 'x', email))), '') AS email
FROM r_customers""")
ORACLE["csv_column_types"] = with_warehouse("""
SELECT order_id::BIGINT AS order_id, order_date, total_amount::DOUBLE AS total_amount, order_id % 2 = 0 AS even,
       if(order_id % 5 <> 0, customer_id, NULL)::BIGINT AS customer,
       if(order_id % 997 = 1, 'none', customer_id::VARCHAR) AS mostly_number,
       if(order_id % 997 = 1, total_amount, customer_id)::DOUBLE AS mostly_whole,
       order_date + if(order_id % 997 = 1, INTERVAL '750 minutes', INTERVAL '0 minutes') AS moment,
       NULL::VARCHAR AS nothing,
       'bigint, date, double, boolean, bigint, string, double, timestamp_ntz, string' AS types
FROM r_orders""")
_HOT_ITEMS = """
hot_items AS (SELECT * REPLACE (if(product_id % 3 = 0, 1, order_id) AS order_id) FROM fct_order_items)"""
ORACLE["stored_hot_orders"] = with_warehouse("""
SELECT order_id, product_id, quantity, unit_price, item_total, order_status, order_date
FROM hot_items LEFT JOIN stg_orders USING (order_id)""", _HOT_ITEMS)
ORACLE["stored_hot_order_totals"] = with_warehouse("""
SELECT order_id, customer_id, order_date, order_status, round(total_amount, 2) AS order_total_amount,
       ifnull(cents, 0) / 100 AS order_amount_from_items,
       (CAST(round(total_amount * 100) AS BIGINT) - ifnull(cents, 0)) / 100 AS reconciliation_delta, ifnull(n, 0) AS item_lines
FROM stg_orders LEFT JOIN (
  SELECT order_id, CAST(sum(CAST(round(item_total * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) AS n FROM hot_items GROUP BY order_id)
  USING (order_id)""", _HOT_ITEMS)
ORACLE["filtered_orders_by_bits"] = ORACLE["filtered_orders"]
ORACLE["daily_ma7_by_country"] = with_warehouse("""
SELECT country, metric_date, c / 100.0 AS gmv,
       CAST(sum(c) OVER w AS DOUBLE) / (CAST(count(*) OVER w AS DOUBLE) * 100.0) AS gmv_ma7,
       n AS orders, CAST(sum(n) OVER w AS DOUBLE) / count(*) OVER w AS orders_ma7
FROM spine LEFT JOIN sold USING (country, metric_date), LATERAL (SELECT coalesce(cents, 0) AS c, coalesce(orders, 0) AS n) z
WINDOW w AS (PARTITION BY country ORDER BY metric_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""", """
sold AS (
  SELECT country, order_date AS metric_date, CAST(sum(CAST(round(order_amount_from_items * 100) AS BIGINT)) AS BIGINT) AS cents,
         count(*) AS orders
  FROM fct_orders JOIN dim_customers USING (customer_id) WHERE order_status = 'paid' AND order_date IS NOT NULL GROUP BY ALL),
spine AS (
  SELECT country, CAST(unnest(generate_series(CAST(min(metric_date) AS TIMESTAMP), CAST(max(metric_date) AS TIMESTAMP),
                                              INTERVAL 1 DAY)) AS DATE) AS metric_date
  FROM sold GROUP BY country)""")
