"""Independent SQL (DuckDB dialect) for every registered query.

Each string runs on the driver's views (``lineitem``, ``orders`` …): the
Bronze derivation, the cleaning and the metrics are written once more here
as plain SQL windows and aggregates, so the Spark plans are checked against
a second formulation, not against themselves.
"""

from __future__ import annotations

# Bronze order lines and options from the star schema (same rules as sources.star).
BRONZE = """
f_items AS (
  SELECT o_orderpriority AS app_name,
         concat('R', CAST(l_suppkey % 20 AS VARCHAR)) AS restaurant_id,
         CAST(o_orderdate AS TIMESTAMP) AS creation_time_utc,
         CAST(l_orderkey AS VARCHAR) AS order_id,
         CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
         CASE WHEN c_mktsegment IN ('BUILDING','HOUSEHOLD') THEN c_name END AS printed_card_number,
         (c_mktsegment IN ('BUILDING','HOUSEHOLD')) AS is_loyalty,
         'USD' AS currency,
         CAST(l_linenumber AS VARCHAR) AS lineitem_id,
         p_type AS item_category, p_name AS item_name,
         CAST(CASE WHEN p_name LIKE 'small%' OR l_discount = 0 THEN 0 ELSE p_retailprice END
              AS DECIMAL(12,2)) AS item_price,
         CAST(l_quantity AS INT) AS item_quantity,
         l_partkey, l_suppkey, l_extendedprice, l_shipdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
),
f_opts AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS lineitem_id,
         l_returnflag AS option_group_name,
         concat(l_returnflag, '-', l_linestatus, '-', CAST(k AS VARCHAR)) AS option_name,
         CAST(CASE WHEN l_tax = 0 THEN 0 ELSE round(l_tax * 100, 2) END AS DECIMAL(12,2)) AS option_price,
         k AS option_quantity
  FROM lineitem JOIN (SELECT 1 AS k UNION ALL SELECT 2) ks ON k <= CAST(l_quantity AS INT) % 3
),
f_days AS (
  SELECT CAST(d AS DATE) AS d FROM (
    SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                                  INTERVAL 1 DAY)) AS d FROM orders)
),
f_dates AS (
  SELECT strftime(d, '%d-%m-%Y') AS date_key, dayname(d) AS day_of_week, CAST(weekofyear(d) AS INT) AS week,
         monthname(d) AS month, CAST(year(d) AS INT) AS year, dayofweek(d) IN (0, 6) AS is_weekend,
         CASE strftime(d, '%m-%d') WHEN '01-01' THEN 'New Year''s Day' WHEN '07-04' THEN 'Independence Day'
              WHEN '12-25' THEN 'Christmas Day' END AS holiday_name
  FROM f_days
),
raw_dates AS (
  SELECT date_key, day_of_week, week, month, year, is_weekend, holiday_name IS NOT NULL AS is_holiday,
         holiday_name FROM f_dates
)"""

SILVER = """
items AS (
  SELECT * EXCLUDE (l_partkey, l_suppkey, l_extendedprice, l_shipdate, rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, lineitem_id
                                 ORDER BY l_partkey, l_suppkey, item_quantity, l_extendedprice, l_shipdate) AS rn
    FROM f_items) WHERE rn = 1
),
c_items AS (
  SELECT app_name, restaurant_id, creation_time_utc, order_id, coalesce(user_id, 'GUEST') AS user_id,
         printed_card_number, is_loyalty, currency, lineitem_id, item_category, item_name, item_price,
         item_quantity, CAST(creation_time_utc AS DATE) AS order_date, item_price * item_quantity AS item_total
  FROM items
),
c_opts AS (SELECT *, option_price * option_quantity AS option_total FROM f_opts),
sales AS (
  SELECT i.*, o.option_group_name, o.option_name, coalesce(o.option_price, 0) AS option_price,
         o.option_quantity, coalesce(o.option_total, 0) AS option_total,
         i.item_total + coalesce(o.option_total, 0) AS total_line_item_revenue
  FROM c_items i LEFT JOIN c_opts o ON i.order_id = o.order_id AND i.lineitem_id = o.lineitem_id
),
dates AS (
  SELECT try_strptime(date_key, '%d-%m-%Y')::DATE AS date_key, day_of_week, week, month, year, is_weekend,
         is_holiday, holiday_name FROM raw_dates
)"""

GOLD = """
order_summary AS (
  SELECT user_id, order_id, order_date, sum(total_line_item_revenue) AS order_revenue,
         bool_or(is_loyalty) AS is_loyalty
  FROM sales WHERE user_id <> 'GUEST' GROUP BY user_id, order_id, order_date
),
order_metrics AS (
  SELECT *, datediff('day', prev_order_date, order_date) AS days_since_prev_order,
         CASE WHEN prev_order_revenue IS NOT NULL
              THEN CAST(order_revenue - prev_order_revenue AS DOUBLE)
                   / nullif(CAST(prev_order_revenue AS DOUBLE), 0) * 100
              ELSE 0 END AS spend_change_pct
  FROM (SELECT *, lag(order_date) OVER w AS prev_order_date, lag(order_revenue) OVER w AS prev_order_revenue,
               sum(order_revenue) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_clv
        FROM order_summary WINDOW w AS (PARTITION BY user_id ORDER BY order_date ASC NULLS FIRST, order_id))
),
ref AS (SELECT max(order_date) AS ref_date FROM sales),
customer_base AS (
  SELECT user_id, max(order_date) AS last_purchase_date,
         coalesce(sum(order_revenue), 0) AS current_clv,
         count(CASE WHEN order_date >= CAST(ref_date - INTERVAL 6 MONTH AS DATE) THEN order_id END) AS frequency,
         coalesce(sum(CASE WHEN order_date >= CAST(ref_date - INTERVAL 6 MONTH AS DATE) THEN order_revenue END), 0)
           AS monetary_value,
         avg(days_since_prev_order) AS avg_gap_between_orders,
         avg(spend_change_pct) AS avg_spend_change_pct,
         datediff('day', max(order_date), any_value(ref_date)) AS recency
  FROM order_metrics, ref GROUP BY user_id
),
scored AS (
  SELECT *,
    ntile(5) OVER (ORDER BY recency DESC NULLS LAST, user_id) AS r_score,
    ntile(5) OVER (ORDER BY frequency ASC NULLS FIRST, user_id) AS f_score,
    ntile(5) OVER (ORDER BY monetary_value ASC NULLS FIRST, user_id) AS m_score,
    ntile(5) OVER (ORDER BY current_clv ASC NULLS FIRST, user_id) AS clv_score
  FROM customer_base
),
intel AS (
  SELECT *,
    CASE WHEN clv_score = 5 THEN 'High' WHEN clv_score >= 2 THEN 'Medium' ELSE 'Low' END AS clv_tier,
    CASE WHEN recency > 45 THEN 'At Risk' ELSE 'Active' END AS churn_status,
    CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'VIP'
         WHEN f_score <= 2 AND r_score >= 4 THEN 'New Customer'
         WHEN recency > 45 THEN 'Churn Risk' ELSE 'Standard' END AS segment
  FROM scored
),
trends AS (
  SELECT order_date, restaurant_id, item_category, sum(total_line_item_revenue) AS daily_revenue,
         count(DISTINCT order_id) AS daily_order_count
  FROM sales GROUP BY order_date, restaurant_id, item_category
),
loyalty AS (
  SELECT is_loyalty, count(DISTINCT user_id) AS total_customers,
         CAST(sum(order_revenue) AS DOUBLE) / nullif(count(order_revenue), 0) AS avg_order_value,
         CAST(count(order_id) AS DOUBLE) / nullif(count(DISTINCT user_id), 0) AS repeat_order_rate,
         sum(order_revenue) AS total_lifetime_value
  FROM order_summary GROUP BY is_loyalty
),
flags AS (
  SELECT *, CASE WHEN (item_price = 0 AND max_item_price_ever > 0)
                   OR (option_price = 0 AND max_option_price_ever > 0) THEN 1 ELSE 0 END AS is_true_discount
  FROM (SELECT *, max(item_price) OVER (PARTITION BY item_name) AS max_item_price_ever,
               max(option_price) OVER (PARTITION BY option_name) AS max_option_price_ever FROM sales)
),
order_flags AS (
  SELECT *, max(is_true_discount) OVER (PARTITION BY order_id) AS is_discounted FROM flags
),
discount AS (
  SELECT is_discounted, count(DISTINCT order_id) AS order_count, sum(total_line_item_revenue) AS total_revenue,
         CAST(sum(total_line_item_revenue) AS DOUBLE) / nullif(count(total_line_item_revenue), 0) AS avg_order_value
  FROM order_flags GROUP BY is_discounted
)"""


# Defective order lines (same rules as sources.star).
NULL_ORDERS = "SELECT * REPLACE (CASE WHEN CAST(order_id AS BIGINT) % 499 <> 0 THEN order_id END AS order_id) FROM f_items0"
RAW_ITEMS = """SELECT * REPLACE (
    CASE WHEN CAST(order_id AS BIGINT) % 499 <> 0 THEN order_id END AS order_id,
    CASE WHEN CAST(order_id AS BIGINT) % 97 <> 0 THEN creation_time_utc END AS creation_time_utc,
    CAST(CASE WHEN l_partkey % 101 = 0 THEN -item_price - 1 ELSE item_price END AS DECIMAL(12,2)) AS item_price,
    CASE WHEN l_suppkey % 89 = 0 THEN 0 ELSE item_quantity END AS item_quantity) FROM f_items0"""
NEWCOMERS = """SELECT * EXCLUDE (last, age) REPLACE (CASE
    WHEN CAST(user_id AS BIGINT) % 3 <> 0 THEN last - to_days(CAST(age % 180 AS INT))
    WHEN CAST(user_id AS BIGINT) % 3 = 0 AND CAST(order_id AS BIGINT) % 10 = 0 THEN last - to_days(CAST(age % 30 AS INT))
    ELSE creation_time_utc END AS creation_time_utc) FROM (
    SELECT *, max(creation_time_utc) OVER () AS last,
           datediff('day', CAST(creation_time_utc AS DATE), CAST(max(creation_time_utc) OVER () AS DATE)) AS age FROM f_items0)"""
COMPED = """SELECT * REPLACE (CAST(CASE WHEN option_group_name = 'A' AND option_quantity = 2 THEN 0 ELSE option_price END
    AS DECIMAL(12,2)) AS option_price) FROM f_opts0"""
OUTCOME = """CASE WHEN order_id IS NULL OR lineitem_id IS NULL THEN 'missing_key'
    WHEN creation_time_utc IS NULL THEN 'missing_timestamp'
    WHEN item_price IS NULL OR item_price < 0 THEN 'bad_price'
    WHEN item_quantity IS NULL OR item_quantity <= 0 THEN 'bad_quantity' ELSE 'valid' END"""


def with_ctes(body: str, *extra: str, items: str | None = None, options: str | None = None) -> str:
    """The shared tables and ``body``; ``items`` and ``options`` derive other Bronze rows from the usual ones
    (``f_items0``, ``f_opts0``)."""
    bronze = BRONZE
    for name, derived in (("f_items", items), ("f_opts", options)):
        if derived is not None:
            bronze = bronze.replace(f"{name} AS (", f"{name}0 AS (", 1) + f",\n{name} AS ({derived})"
    ctes = ",".join([bronze, SILVER, GOLD, *extra])
    return f"WITH {ctes}\n{body}"
