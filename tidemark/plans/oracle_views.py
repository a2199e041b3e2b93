"""DuckDB text of the business views (independent of the Spark code).

Each constant is a comma-joinable CTE body: ``WITH `` + ", ".join(parts).
The tables ``lineitem``, ``orders`` ... are the pre-registered DuckDB views.
"""

V_ITEMS = """
v_items AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS order_id,
         CAST(l.l_linenumber AS VARCHAR) AS lineitem_id,
         CASE WHEN l.l_orderkey % 211 = 0 THEN ''
              WHEN l.l_orderkey % 223 = 0 THEN NULL
              WHEN l.l_orderkey % 227 = 0 THEN '  '
              ELSE CAST(o.o_custkey AS VARCHAR) END AS user_id,
         CAST(l.l_suppkey AS VARCHAR) AS restaurant_id,
         o.o_orderdate AS creation_time_utc,
         p.p_type AS item_category,
         p.p_name AS item_name,
         CAST(p.p_retailprice AS DECIMAL(10,2)) AS item_price,
         CAST(l.l_quantity AS INTEGER) AS item_quantity,
         o.o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_loyalty
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_returnflag <> 'A')"""

V_OPTS = """
v_opts AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_linenumber AS VARCHAR) AS lineitem_id,
         CASE WHEN l_discount > 0.085
              THEN -CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2))
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2))
         END AS option_price,
         CAST(l_linenumber % 2 + 1 AS INTEGER) AS option_quantity
  FROM lineitem WHERE l_returnflag = 'A')"""

V_CAL = """
v_cal AS (
  SELECT d AS cal_date,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         CAST(week(d) AS INTEGER) AS week, dayname(d) AS day_of_week,
         dayofweek(d) IN (0, 6) AS is_weekend,
         (month(d) = 1 AND day(d) = 1) OR (month(d) = 7 AND day(d) = 4)
           OR (month(d) = 12 AND day(d) = 25) AS is_holiday,
         CASE WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year''s Day'
              WHEN month(d) = 7 AND day(d) = 4 THEN 'Independence Day'
              WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas Day' END AS holiday_name
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) t
  WHERE year(d) = 1998)"""

# Cleaned items -> options (fan-out) -> calendar, with fallback attributes.
V_SALES_FACT = """
v_fact_base AS (
  SELECT i.order_id, i.lineitem_id, i.user_id, i.restaurant_id, i.creation_time_utc,
         i.item_category, i.item_name, COALESCE(i.item_price, CAST(0 AS DECIMAL(10,2))) AS item_price,
         COALESCE(i.item_quantity, CAST(0 AS INTEGER)) AS item_quantity, i.is_loyalty,
         CAST(i.creation_time_utc AS DATE) AS date_key,
         COALESCE(o.option_price, CAST(0 AS DECIMAL(10,2))) AS option_price,
         COALESCE(o.option_quantity, CAST(0 AS INTEGER)) AS option_quantity,
         COALESCE(c.year, CAST(year(i.creation_time_utc) AS INTEGER)) AS year,
         COALESCE(c.month, CAST(month(i.creation_time_utc) AS INTEGER)) AS month,
         COALESCE(c.week, CAST(week(i.creation_time_utc) AS INTEGER)) AS week,
         COALESCE(c.day_of_week, dayname(i.creation_time_utc)) AS day_of_week,
         COALESCE(c.is_weekend, dayofweek(i.creation_time_utc) IN (0, 6)) AS is_weekend,
         COALESCE(c.is_holiday, FALSE) AS is_holiday,
         c.holiday_name,
         CAST(day(i.creation_time_utc) AS INTEGER) AS day
  FROM v_items i
  LEFT JOIN v_opts o ON i.order_id = o.order_id AND i.lineitem_id = o.lineitem_id
  LEFT JOIN v_cal c ON CAST(i.creation_time_utc AS DATE) = c.cal_date
  WHERE i.restaurant_id IS NOT NULL AND trim(i.restaurant_id) <> ''
    AND i.user_id IS NOT NULL AND trim(i.user_id) <> ''
    AND i.order_id IS NOT NULL AND trim(i.order_id) <> ''
    AND i.lineitem_id IS NOT NULL AND trim(i.lineitem_id) <> ''
    AND i.creation_time_utc IS NOT NULL),
v_order_rev AS (
  SELECT order_id, user_id, creation_time_utc,
         SUM(item_price * item_quantity) AS base_revenue,
         SUM(option_price * option_quantity) AS options_revenue,
         SUM(item_price * item_quantity) + SUM(option_price * option_quantity) AS total_revenue
  FROM v_fact_base GROUP BY order_id, user_id, creation_time_utc),
v_hist AS (
  SELECT user_id, CAST(SUM(total_revenue) AS DOUBLE) AS historical_user_revenue,
         COUNT(DISTINCT order_id) AS total_user_orders,
         MIN(creation_time_utc) AS first_order_date, MAX(creation_time_utc) AS last_order_date,
         CAST(SUM(total_revenue) AS DOUBLE) / COUNT(DISTINCT order_id) AS avg_user_order_value
  FROM v_order_rev GROUP BY user_id),
v_glob AS (
  SELECT AVG(total_user_orders) AS avg_orders_per_user,
         ROUND(AVG(avg_user_order_value), 6) AS avg_order_value_per_user,
         AVG(CAST(date_diff('day', CAST(first_order_date AS DATE), CAST(last_order_date AS DATE)) AS DOUBLE))
           AS avg_customer_lifespan_days
  FROM v_hist),
v_clv AS (
  SELECT h.*, g.*,
         h.avg_user_order_value * h.total_user_orders * g.avg_customer_lifespan_days
           AS customer_lifetime_value
  FROM v_hist h CROSS JOIN v_glob g),
v_clv_seg AS (
  SELECT * EXCLUDE (t),
         CASE WHEN t = 1 THEN 'Low Value' WHEN t = 5 THEN 'High Value' ELSE 'Medium Value' END
           AS clv_segment_label
  FROM (SELECT *, NTILE(5) OVER (ORDER BY customer_lifetime_value ASC NULLS FIRST, user_id) AS t
        FROM v_clv)),
v_recency AS (
  SELECT user_id,
         CAST(date_diff('day', CAST(MAX(creation_time_utc) AS DATE),
                        CAST((SELECT MAX(creation_time_utc) FROM v_fact_base) AS DATE)) AS INTEGER)
           AS days_since_last_order
  FROM v_fact_base GROUP BY user_id),
v_month_stats AS (
  SELECT user_id, year, month, COUNT(order_id) AS monthly_order_count,
         CAST(SUM(item_price * item_quantity + option_price * option_quantity) AS DOUBLE) AS monthly_revenue
  FROM v_fact_base GROUP BY user_id, year, month),
v_rfm_tiles AS (
  SELECT m.*, r.days_since_last_order,
    NTILE(2) OVER (ORDER BY r.days_since_last_order DESC NULLS LAST, m.user_id, m.year, m.month) AS tr,
    NTILE(2) OVER (ORDER BY m.monthly_order_count ASC NULLS FIRST, m.user_id, m.year, m.month) AS tf,
    NTILE(2) OVER (ORDER BY m.monthly_revenue ASC NULLS FIRST, m.user_id, m.year, m.month) AS tm
  FROM v_month_stats m LEFT JOIN v_recency r ON m.user_id = r.user_id),
v_rfm AS (
  SELECT user_id, year, month, monthly_order_count, monthly_revenue, days_since_last_order,
         CASE WHEN tr = 1 THEN 'Low' ELSE 'High' END AS monthly_recency_score,
         CASE WHEN tf = 1 THEN 'Low' ELSE 'High' END AS monthly_frequency_score,
         CASE WHEN tm = 1 THEN 'Low' ELSE 'High' END AS monthly_monetary_score,
         (tr = 2 AND tf = 2 AND tm = 2) AS monthly_vip_status,
         (tr = 2 AND tf = 1 AND tm = 1) AS monthly_new_customer_status,
         (tr = 1 AND tf = 1 AND tm = 1) AS monthly_churn_risk_status
  FROM v_rfm_tiles),
v_fact AS (
  SELECT f.*, c.* EXCLUDE (user_id), r.* EXCLUDE (user_id, year, month)
  FROM v_fact_base f
  JOIN v_clv_seg c ON f.user_id = c.user_id
  JOIN v_rfm r ON f.user_id = r.user_id AND f.year = r.year AND f.month = r.month)"""

RESTAURANT = [V_ITEMS, V_OPTS, V_CAL, V_SALES_FACT]


def with_views(parts, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select
