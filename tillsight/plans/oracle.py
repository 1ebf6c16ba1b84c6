"""Oracle SQL (DuckDB dialect) for every registered query.

Each statement rebuilds the retail model from the warehouse tables with the
same fixed mapping as ``sources/adapter.py`` (as CTEs) and then states the
query in plain SQL from its definition. Money stays
DECIMAL until the final cast to DOUBLE; DuckDB divides decimals in DOUBLE, so
ratios are cast back to DECIMAL(38,6) before a half-away-from-zero ROUND.
"""

from __future__ import annotations

ADAPTER = """
WITH RECURSIVE rc_customers AS (
  SELECT c.c_custkey AS customer_id,
         (DATE '1995-01-01' + CAST((c.c_custkey * 37) % 2000 AS INTEGER)) AS signup_date,
         r.r_name AS region, c.c_mktsegment AS acquisition_channel
  FROM customer c
  LEFT JOIN (SELECT n_nationkey, MIN(n_regionkey) AS n_regionkey FROM nation GROUP BY n_nationkey) n
         ON n.n_nationkey = c.c_nationkey
  LEFT JOIN (SELECT r_regionkey, MIN(r_name) AS r_name FROM region GROUP BY r_regionkey) r
         ON r.r_regionkey = n.n_regionkey),
rc_products AS (
  SELECT p_partkey AS product_id, p_type AS category,
         CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
         CAST(ROUND(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(40 + p_partkey % 26 AS DECIMAL(4,0))
                    * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS unit_cost,
         p_name AS product_name
  FROM part),
rc_orders AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date,
         CASE o.o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'returned' ELSE 'cancelled' END AS status,
         c.region, c.acquisition_channel
  FROM orders o
  LEFT JOIN (SELECT customer_id, MIN(region) AS region, MIN(acquisition_channel) AS acquisition_channel
             FROM rc_customers GROUP BY customer_id) c ON c.customer_id = o.o_custkey),
rc_items AS (
  SELECT order_id, product_id, quantity, CAST(CAST(cents AS DECIMAL(12,0)) * 0.01 AS DECIMAL(12,2)) AS unit_price,
         CAST(CAST((2 * cents * (40 + product_id % 26) + 100) // 200 AS DECIMAL(12,0)) * 0.01 AS DECIMAL(12,2)) AS unit_cost
  FROM (SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(round(l_quantity, 3) AS DECIMAL(12,3)) AS quantity,
               (2000 * CAST(ROUND(l_extendedprice * 100) AS BIGINT) + CAST(round(l_quantity * 1000) AS BIGINT))
                 // NULLIF(2 * CAST(round(l_quantity * 1000) AS BIGINT), 0) AS cents
        FROM lineitem)),
rc_order_level AS (
  SELECT o.order_id, o.customer_id, o.order_date, o.region, o.acquisition_channel,
         SUM(i.quantity * i.unit_price) AS order_revenue
  FROM rc_orders o JOIN rc_items i ON i.order_id = o.order_id
  WHERE o.status = 'completed'
  GROUP BY o.order_id, o.customer_id, o.order_date, o.region, o.acquisition_channel),
rc_campaign AS (
  SELECT c.customer_id,
         CASE WHEN substr(md5(CAST(c.customer_id AS VARCHAR) || ':arm'), 1, 1) < '8'
              THEN 'control' ELSE 'variant' END AS grp,
         CASE WHEN w.v IS NULL THEN 0 ELSE 1 END AS converted,
         COALESCE(w.v, CAST(0 AS DECIMAL(12,2))) AS order_value
  FROM rc_customers c
  LEFT JOIN (SELECT customer_id, SUM(order_revenue) AS v FROM rc_order_level
             WHERE order_date >= DATE '2000-01-01' AND order_date < DATE '2000-03-01'
             GROUP BY customer_id) w ON w.customer_id = c.customer_id)"""


def _sql(body: str) -> str:
    return ADAPTER + "\n" + body.strip()


def _r(expr: str, digits: int) -> str:
    """Half-away ROUND of a DOUBLE-valued ratio, via DECIMAL(38,6), as DOUBLE."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


def _mean(column: str, digits: int, scale: int) -> str:
    """Mean of a decimal column of ``scale`` digits, rounded once, half away from zero, as DOUBLE."""
    by = f"(CAST(COUNT({column}) AS HUGEINT) * {10 ** (scale - digits)})"
    total = f"CAST(SUM({column}) * {10 ** scale} AS HUGEINT)"
    return f"(sign({total}) * ((2 * abs({total}) + {by}) // NULLIF(2 * {by}, 0)) / {10 ** digits}.0::DOUBLE)"


def _re(expr: str, digits: int) -> str:
    """numpy-style round (half to even on the scaled double)."""
    scale = f"{10 ** digits}.0"
    return f"(round_even(CAST({expr} AS DOUBLE) * {scale}, 0) / {scale})"


CHANNELS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

_MONTHLY_FILLED = """
, m AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, SUM(order_revenue) AS revenue
        FROM rc_order_level GROUP BY 1),
b AS (SELECT MIN(month) AS lo, MAX(month) AS hi FROM m),
cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM b),
filled AS (SELECT cal.month, COALESCE(m.revenue, 0) AS revenue FROM cal LEFT JOIN m ON m.month = cal.month)"""

_CELLS = """
, cells AS (SELECT region, acquisition_channel, SUM(order_revenue) AS revenue
            FROM rc_order_level GROUP BY region, acquisition_channel)"""

_RFM = """
, base AS (
    SELECT customer_id,
           (SELECT MAX(order_date) + 1 FROM rc_order_level) - MAX(order_date) AS recency,
           COUNT(DISTINCT order_id) AS frequency, SUM(order_revenue) AS monetary
    FROM rc_order_level GROUP BY customer_id),
ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY frequency, customer_id) AS f_rank FROM base),
edges AS (SELECT quantile_cont(CAST(recency AS DOUBLE), [0.25, 0.5, 0.75]) AS re,
                 quantile_cont(CAST(monetary AS DOUBLE), [0.25, 0.5, 0.75]) AS me,
                 COUNT(*) AS n FROM base),
scored AS (
    SELECT r.customer_id, CAST(r.recency AS BIGINT) AS recency, CAST(r.frequency AS BIGINT) AS frequency, r.monetary,
           CAST(4 - (CASE WHEN r.recency > e.re[1] THEN 1 ELSE 0 END)
                   - (CASE WHEN r.recency > e.re[2] THEN 1 ELSE 0 END)
                   - (CASE WHEN r.recency > e.re[3] THEN 1 ELSE 0 END) AS BIGINT) AS r_score,
           CAST(1 + (CASE WHEN r.f_rank > 1 + (e.n - 1) * 0.25 THEN 1 ELSE 0 END)
                   + (CASE WHEN r.f_rank > 1 + (e.n - 1) * 0.5 THEN 1 ELSE 0 END)
                   + (CASE WHEN r.f_rank > 1 + (e.n - 1) * 0.75 THEN 1 ELSE 0 END) AS BIGINT) AS f_score,
           CAST(1 + (CASE WHEN CAST(r.monetary AS DOUBLE) > e.me[1] THEN 1 ELSE 0 END)
                   + (CASE WHEN CAST(r.monetary AS DOUBLE) > e.me[2] THEN 1 ELSE 0 END)
                   + (CASE WHEN CAST(r.monetary AS DOUBLE) > e.me[3] THEN 1 ELSE 0 END) AS BIGINT) AS m_score
    FROM ranked r, edges e),
scores AS (
    SELECT *, r_score + f_score + m_score AS rfm_sum,
           CASE WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Champions'
                WHEN r_score >= 3 AND f_score >= 2 THEN 'Loyal Customers'
                WHEN r_score >= 3 AND f_score <= 2 THEN 'Promising / New'
                WHEN r_score = 2 AND f_score >= 2 THEN 'Needs Attention'
                WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
                WHEN r_score <= 1 AND f_score <= 2 THEN 'Hibernating / Lost'
                ELSE 'Other' END AS segment
    FROM scored)"""

_SEGMENTS = f"""
, seg AS (
    SELECT segment, COUNT(*) AS customers,
           {_re("AVG(recency)", 1)} AS avg_recency_days,
           {_re("AVG(frequency)", 1)} AS avg_frequency,
           {_re("AVG(monetary)", 1)} AS avg_monetary,
           {_re("SUM(monetary)", 1)} AS total_revenue
    FROM scores GROUP BY segment),
seg_summary AS (
    SELECT *, {_re("CAST(customers AS DOUBLE) / SUM(customers) OVER () * 100.0", 1)} AS pct_of_customers,
              {_re("total_revenue / SUM(total_revenue) OVER () * 100.0", 1)} AS pct_of_revenue
    FROM seg)"""

_COHORTS = f"""
, cm AS (SELECT DISTINCT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS order_month
         FROM rc_order_level),
fc AS (SELECT customer_id, MIN(order_month) AS cohort_month FROM cm GROUP BY customer_id),
counts AS (
    SELECT fc.cohort_month,
           CAST((year(cm.order_month) - year(fc.cohort_month)) * 12
                + (month(cm.order_month) - month(fc.cohort_month)) AS BIGINT) AS period,
           COUNT(DISTINCT cm.customer_id) AS customers
    FROM cm JOIN fc ON fc.customer_id = cm.customer_id GROUP BY 1, 2),
ret AS (
    SELECT c.cohort_month, c.period, c.customers, c0.customers AS cohort_size,
           {_re("CAST(c.customers AS DOUBLE) / c0.customers", 3)} AS retention
    FROM counts c JOIN counts c0 ON c0.cohort_month = c.cohort_month AND c0.period = 0)"""

_CURVE = """
, curve0 AS (SELECT period, COUNT(*) AS cohorts, SUM(CAST(round(retention * 1000) AS BIGINT)) * 10 AS num
             FROM ret GROUP BY period),
curve AS (SELECT period, cohorts,
                 CAST(num // cohorts + CASE WHEN 2 * (num % cohorts) > cohorts
                                             OR (2 * (num % cohorts) = cohorts AND (num // cohorts) % 2 = 1)
                                            THEN 1 ELSE 0 END AS DOUBLE) / 100.0 AS avg_retention_pct
          FROM curve0)"""

_AB_COUNTS = """
, ab_counts AS (
    SELECT COUNT(*) FILTER (WHERE grp = 'control') AS n1, COUNT(*) FILTER (WHERE grp = 'variant') AS n2,
           COALESCE(SUM(converted) FILTER (WHERE grp = 'control'), 0) AS x1,
           COALESCE(SUM(converted) FILTER (WHERE grp = 'variant'), 0) AS x2,
           CAST(SUM(order_value) FILTER (WHERE converted = 1) AS DOUBLE)
             / COUNT(*) FILTER (WHERE converted = 1) AS vconv
    FROM rc_campaign),
ab_rates AS (SELECT *, CAST(x1 AS DOUBLE) / n1 AS p1, CAST(x2 AS DOUBLE) / n2 AS p2,
             (SELECT COUNT(*) FROM rc_customers) AS base FROM ab_counts)"""

_AB = _AB_COUNTS + """,
c AS (SELECT *, (p2 - p1) / sqrt(CAST(x1 + x2 AS DOUBLE) / (n1 + n2) * (1.0 - CAST(x1 + x2 AS DOUBLE) / (n1 + n2))
                                 * (1.0 / CAST(n1 AS DOUBLE) + 1.0 / CAST(n2 AS DOUBLE))) AS z,
             sqrt(p1 * (1.0 - p1) / n1 + p2 * (1.0 - p2) / n2) AS se FROM ab_rates),
ex AS (SELECT abs(z) / sqrt(2.0::DOUBLE) AS x FROM c),
series(k, t, s) AS (
    SELECT 0, x, x FROM ex
    UNION ALL
    SELECT k + 1, t * 2.0 * x * x / (2.0 * (k + 1) + 1.0), s + t * 2.0 * x * x / (2.0 * (k + 1) + 1.0)
    FROM series, ex WHERE k < 300),
erfv AS (SELECT CASE WHEN ex.x > 8.0 THEN 1.0::DOUBLE ELSE 2.0 / sqrt(pi()) * exp(-ex.x * ex.x) * s END AS erf
         FROM series, ex WHERE k = 300),
final AS (SELECT c.*, 2.0 * (1.0 - 0.5 * (1.0 + sign(abs(c.z)) * erfv.erf)) AS p_value FROM c, erfv)"""


def _profile(name: str, rel: str, cols: list[str]) -> str:
    nulls = " + ".join(f"(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in cols)
    col_list = ", ".join(cols)
    return f"""SELECT '{name}' AS table_name, CAST(COALESCE(SUM(k), 0) AS BIGINT) AS rows,
       CAST(COALESCE(SUM(k * ({nulls})), 0) AS BIGINT) AS null_cells,
       CAST(COALESCE(SUM(k - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT {col_list}, COUNT(*) AS k FROM {rel} GROUP BY {col_list})"""


def _types(name: str, rel: str, cols: dict[str, str]) -> str:
    """Counts of what the columns' texts look like, and the type that all of them pass; ``cols``: column and its text."""
    parts = []
    for c, text in cols.items():
        full = "x IS NOT NULL AND x <> ''"
        parts.append(f"""SELECT '{name}' AS table_name, '{c}' AS column_name, COUNT(*) AS rows, COUNT(*) FILTER (WHERE x IS NULL OR x = '') AS nulls,
       COUNT(*) FILTER (WHERE regexp_matches(x, '^[+-]?(0|[1-9][0-9]{{0,17}})$')) AS integers,
       COUNT(*) FILTER (WHERE regexp_matches(x, '^[+-]?(0|[1-9][0-9]*)([.][0-9]+)?$')) AS decimals,
       COUNT(*) FILTER (WHERE regexp_matches(x, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') AND TRY_CAST(x AS DATE) IS NOT NULL) AS dates,
       MAX(length(regexp_extract(x, '([0-9]+)', 1))) FILTER (WHERE regexp_matches(x, '^[+-]?(0|[1-9][0-9]*)([.][0-9]+)?$')) AS whole,
       MAX(length(regexp_extract(x, '[.]([0-9]+)', 1))) FILTER (WHERE regexp_matches(x, '^[+-]?(0|[1-9][0-9]*)([.][0-9]+)?$')) AS fraction,
       COUNT(*) FILTER (WHERE {full}) AS filled FROM (SELECT {text} AS x FROM {rel})""")
    return " UNION ALL ".join(parts)


def _texts(*cols: str, **spelled: str) -> dict[str, str]:
    return {c: spelled.get(c, f"CAST({c} AS VARCHAR)") for c in cols}


_VALUES = """
, v AS (SELECT l.customer_id, c.region, SUM(order_revenue) AS monetary
        FROM rc_order_level l JOIN rc_customers c ON c.customer_id = l.customer_id GROUP BY 1, 2),
o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY region ORDER BY monetary) AS i, COUNT(*) OVER (PARTITION BY region) AS n FROM v),
q AS (SELECT region, MAX(n) AS customers, MIN(monetary) FILTER (WHERE i >= n * 0.25) AS q25,
             MIN(monetary) FILTER (WHERE i >= n * 0.5) AS q50, MIN(monetary) FILTER (WHERE i >= n * 0.75) AS q75 FROM o GROUP BY region)"""

_AB_NAMES = ["control_n", "variant_n", "control_conv_rate", "variant_conv_rate", "absolute_lift", "relative_lift_pct", "z_stat", "p_value",
             "ci_95_low", "ci_95_high", "significant_at_05", "projected_incremental_revenue"]
_AB_ROW = f"""
SELECT n1 AS control_n, n2 AS variant_n,
       {_re("p1", 4)} AS control_conv_rate, {_re("p2", 4)} AS variant_conv_rate, {_re("p2 - p1", 4)} AS absolute_lift,
       {_re("(p2 / p1 - 1.0) * 100.0", 2)} AS relative_lift_pct, {_re("z", 3)} AS z_stat, {_re("p_value", 4)} AS p_value,
       {_re("(p2 - p1) - 1.96 * se", 4)} AS ci_95_low, {_re("(p2 - p1) + 1.96 * se", 4)} AS ci_95_high, p_value < 0.05 AS significant_at_05,
       {_re("(p2 - p1) * base * vconv", 0)} AS projected_incremental_revenue
FROM final"""


def _long(section: str, source: str, names: list[str], row: str, position: str) -> str:
    """A row of ``source`` per name: the section's long form."""
    return " UNION ALL ".join(
        f"SELECT '{section}', CAST({position} AS BIGINT), {row}, '{n}', CAST({n} AS DOUBLE), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE) FROM {source}" for n in names)


ORACLE: dict[str, str] = {
    "monthly_revenue_growth": _sql(f"""
, totals AS (SELECT date_trunc('month', order_date) AS at, SUM(order_revenue) AS amount FROM rc_order_level GROUP BY ALL)
SELECT strftime(t.at, '%Y-%m') AS order_month, CAST(t.amount AS DOUBLE) AS revenue,
       CAST(t.amount - p.amount AS DOUBLE) AS revenue_change,
       {_r("(t.amount - p.amount) * 100.0 / NULLIF(p.amount, 0)", 1)} AS pct_change
FROM totals t LEFT JOIN totals p ON p.at = (SELECT MAX(e.at) FROM totals e WHERE e.at < t.at)"""),

    "category_margin": _sql(f"""
, sold AS (
    SELECT product_id, order_id, SUM(quantity) AS units, SUM(quantity * unit_price) AS income, SUM(quantity * unit_cost) AS spent
    FROM rc_items SEMI JOIN (SELECT order_id FROM rc_orders WHERE status = 'completed') USING (order_id) GROUP BY ALL),
by_category AS (
    SELECT category, COUNT(DISTINCT order_id) AS baskets, SUM(units) AS units, SUM(income) AS income, SUM(spent) AS spent
    FROM rc_products JOIN sold USING (product_id) GROUP BY ALL)
SELECT category, baskets AS orders_containing_category, CAST(units AS DOUBLE) AS units_sold, CAST(income AS DOUBLE) AS revenue,
       CAST(income - spent AS DOUBLE) AS gross_profit, {_r("(income - spent) * 100.0 / NULLIF(income, 0)", 1)} AS margin_pct
FROM by_category"""),

    "order_level": _sql("""
SELECT order_id, customer_id, strftime(order_date, '%Y-%m-%d') AS order_date, region, acquisition_channel,
       CAST(order_revenue AS DOUBLE) AS order_revenue
FROM rc_order_level"""),

    "order_level_refreshed": _sql("""
, lined AS (SELECT o.order_id, o.order_date FROM rc_orders o SEMI JOIN rc_items i ON i.order_id = o.order_id WHERE o.status = 'completed'),
touched AS (
  SELECT order_date FROM rc_orders WHERE order_id % 97 = 0 AND year(order_date) = 2001
  UNION ALL SELECT order_date FROM rc_orders WHERE order_id % 89 = 0 AND year(order_date) = 2000
  UNION ALL SELECT order_date - 40 FROM rc_orders WHERE order_id % 89 = 0 AND year(order_date) = 2000
  UNION ALL SELECT order_date FROM lined WHERE order_id % 83 = 0 AND year(order_date) = 1999)
SELECT strftime(order_date, '%Y-%m') AS order_month, COUNT(*) AS orders, CAST(SUM(order_revenue) AS DOUBLE) AS revenue,
       strftime(order_date, '%Y-%m') IN (SELECT strftime(order_date, '%Y-%m') FROM touched) AS rewritten
FROM rc_order_level GROUP BY 1"""),

    "kpis": _sql(f"""
SELECT CAST(ROUND(SUM(order_revenue), 2) AS DOUBLE) AS total_revenue,
       COUNT(*) AS total_orders,
       COUNT(DISTINCT customer_id) AS total_customers,
       {_mean("order_revenue", 2, 5)} AS aov,
       ROUND((SELECT CAST(COUNT(*) FILTER (WHERE status = 'completed') AS DOUBLE) / COUNT(*) FROM rc_orders), 4)
         AS completion_rate
FROM rc_order_level"""),

    "monthly_revenue_filled": _sql(_MONTHLY_FILLED + """
SELECT strftime(month, '%Y-%m-%d') AS month, CAST(revenue AS DOUBLE) AS revenue FROM filled ORDER BY 1"""),

    "monthly_revenue_filled_by_cell": _sql("""
, m AS (SELECT region, acquisition_channel, CAST(date_trunc('month', order_date) AS DATE) AS month,
               SUM(order_revenue) AS revenue
        FROM rc_order_level GROUP BY 1, 2, 3),
b AS (SELECT region, acquisition_channel, MIN(month) AS lo, MAX(month) AS hi FROM m GROUP BY 1, 2),
cal AS (SELECT region, acquisition_channel,
               CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM b)
SELECT cal.region, cal.acquisition_channel, strftime(cal.month, '%Y-%m-%d') AS month,
       CAST(COALESCE(m.revenue, 0) AS DOUBLE) AS revenue
FROM cal LEFT JOIN m ON m.region = cal.region AND m.acquisition_channel = cal.acquisition_channel
                    AND m.month = cal.month
ORDER BY 1, 2, 3"""),

    "category_revenue": _sql("""
, line_level AS (
    SELECT o.order_id, oi.quantity * oi.unit_price AS line_revenue, p.category
    FROM rc_orders o JOIN rc_items oi ON oi.order_id = o.order_id
    JOIN rc_products p ON p.product_id = oi.product_id
    WHERE o.status = 'completed')
SELECT category, CAST(SUM(line_revenue) AS DOUBLE) AS revenue FROM line_level GROUP BY category ORDER BY revenue"""),

    "region_channel_long": _sql(_CELLS + """
SELECT region, acquisition_channel, CAST(revenue AS DOUBLE) AS revenue FROM cells ORDER BY 1, 2"""),

    "region_channel_matrix": _sql("SELECT region, " + ", ".join(
        f"CAST(SUM(CASE WHEN acquisition_channel = '{c}' THEN order_revenue END) AS DOUBLE) AS \"{c}\""
        for c in CHANNELS) + ", CAST(SUM(CASE WHEN acquisition_channel IS NULL OR acquisition_channel NOT IN (" + ", ".join(f"'{c}'" for c in CHANNELS)
        + ") THEN order_revenue END) AS DOUBLE) AS other FROM rc_order_level GROUP BY region ORDER BY region"),

    "channel_rank_by_region": _sql(_CELLS + """
SELECT region, acquisition_channel, CAST(revenue AS DOUBLE) AS revenue,
       RANK() OVER (PARTITION BY region ORDER BY revenue DESC) AS channel_rank,
       RANK() OVER (PARTITION BY region ORDER BY revenue ASC) = 1 AS is_weakest
FROM cells ORDER BY region, channel_rank"""),

    "revenue_share_of_max": _sql(_CELLS + """
SELECT region, acquisition_channel, CAST(revenue AS DOUBLE) AS revenue,
       ROUND(CAST(revenue AS DOUBLE) / NULLIF(MAX(CAST(revenue AS DOUBLE)) OVER (), 0), 6) AS share_of_max
FROM cells"""),

    "trend_insight": _sql(_MONTHLY_FILLED + """
, s AS (SELECT month, CAST(revenue AS DOUBLE) AS rev FROM filled),
peak AS (SELECT month, rev FROM s ORDER BY rev DESC, month ASC LIMIT 1)
SELECT strftime((SELECT month FROM peak), '%b %Y') AS peak_month_label,
       ROUND((SELECT rev FROM peak), 2) AS peak_revenue,
       month((SELECT month FROM peak)) IN (11, 12) AS peak_in_holiday,
       ROUND(arg_max(rev, month) / NULLIF(arg_min(rev, month), 0), 4) AS growth_multiple,
       ROUND((AVG(rev) FILTER (WHERE month(month) IN (11, 12))
              / NULLIF(AVG(rev) FILTER (WHERE month(month) NOT IN (11, 12)), 0) - 1) * 100, 4)
         AS holiday_uplift_pct
FROM s"""),

    "month_labels": _sql("""
, months AS (SELECT DISTINCT CAST(date_trunc('month', order_date) AS DATE) AS month FROM rc_order_level)
SELECT strftime(month, '%Y-%m') AS order_month, strftime(month, '%b %Y') AS label,
       strftime(month, '%b %y') AS short_label
FROM months ORDER BY 1"""),

    "product_codes": _sql("""
SELECT product_id, category,
       upper(substr(category, 1, 4)) || '-' || lpad(right(CAST(product_id AS VARCHAR), 4), 4, '0') AS product_code
FROM rc_products"""),

    "rfm_inputs": _sql("""
SELECT customer_id, MIN(date_diff('day', order_date, newest)) AS recency_days,
       COUNT(DISTINCT order_id) AS frequency, CAST(SUM(order_revenue) AS DOUBLE) AS monetary
FROM rc_order_level CROSS JOIN (SELECT MAX(order_date) AS newest FROM rc_order_level) GROUP BY customer_id"""),

    "top_customers_by_region": _sql("""
, spend AS (
    SELECT customer_id, c.region, v FROM rc_customers c
    JOIN (SELECT customer_id, SUM(order_revenue) AS v FROM rc_order_level GROUP BY ALL) USING (customer_id)),
richer AS (  -- the rank is one more than the customers of the region with a higher value
    SELECT s.customer_id, COUNT(o.customer_id) AS n FROM spend s
    LEFT JOIN spend o ON o.region IS NOT DISTINCT FROM s.region AND o.v > s.v GROUP BY ALL)
SELECT customer_id, region, CAST(v AS DOUBLE) AS lifetime_value, n + 1 AS region_rank
FROM spend JOIN richer USING (customer_id) WHERE n < 5"""),

    "churn_candidates": _sql("""
, bought AS (
    SELECT customer_id, list(DISTINCT year(order_date)) AS years FROM rc_orders WHERE status = 'completed' GROUP BY ALL)
SELECT customer_id, region, acquisition_channel
FROM rc_customers JOIN bought USING (customer_id) WHERE list_contains(years, 2000) AND NOT list_contains(years, 2001)"""),

    "rfm_scores": _sql(_RFM + """
SELECT customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary, r_score, f_score, m_score,
       rfm_sum, segment
FROM scores"""),

    "rfm_quartile_edges": _sql(_RFM + """
SELECT 'recency' AS metric, ROUND(re[1], 6) AS q25, ROUND(re[2], 6) AS q50, ROUND(re[3], 6) AS q75 FROM edges
UNION ALL
SELECT 'frequency_rank', ROUND(CAST(1 + (n - 1) * 0.25 AS DOUBLE), 6), ROUND(CAST(1 + (n - 1) * 0.5 AS DOUBLE), 6),
       ROUND(CAST(1 + (n - 1) * 0.75 AS DOUBLE), 6) FROM edges
UNION ALL
SELECT 'monetary', ROUND(me[1], 6), ROUND(me[2], 6), ROUND(me[3], 6) FROM edges"""),

    "rfm_segment_summary": _sql(_RFM + _SEGMENTS + """
SELECT * FROM seg_summary ORDER BY total_revenue DESC"""),

    "rfm_top_segment": _sql(_RFM + _SEGMENTS + """
SELECT segment, pct_of_customers, pct_of_revenue FROM seg_summary
ORDER BY pct_of_revenue DESC, total_revenue DESC LIMIT 1"""),

    "signup_cohort_activity": _sql("""
, seen AS (  -- an order counts from the signup month on, so if its month ends on or after the signup day
    SELECT DISTINCT customer_id, date_trunc('month', signup_date) AS joined, date_trunc('month', order_date) AS active
    FROM rc_orders JOIN (SELECT customer_id, signup_date FROM rc_customers) USING (customer_id)
    WHERE status = 'completed' AND last_day(order_date) >= signup_date)
SELECT strftime(joined, '%Y-%m') AS cohort_month, strftime(active, '%Y-%m') AS activity_month, COUNT(*) AS active_customers
FROM seen GROUP BY ALL"""),

    "purchase_cohort_counts": _sql(_COHORTS + """
SELECT strftime(cohort_month, '%Y-%m-%d') AS cohort_month, period, customers FROM counts"""),

    "purchase_cohort_retention": _sql(_COHORTS + """
SELECT strftime(cohort_month, '%Y-%m-%d') AS cohort_month, period, customers, cohort_size, retention
FROM ret ORDER BY 1, 2"""),

    "purchase_cohort_matrix": _sql(_COHORTS + "\nSELECT strftime(cohort_month, '%Y-%m-%d') AS cohort_month, " + ", ".join(
        f"MAX(retention) FILTER (WHERE period = {p}) AS m{p}" for p in range(80))
        + ", COUNT(*) FILTER (WHERE period >= 80) AS later_periods FROM ret GROUP BY 1"),

    "cohort_heatmap": _sql(_COHORTS + "\nSELECT strftime(cohort_month, '%Y-%m-%d') AS cohort_month, " + ", ".join(
        f"{_re(f'MAX(retention) FILTER (WHERE period = {p}) * 100.0', 1)} AS m{p}_pct" for p in range(12)) + " FROM ret GROUP BY 1"),

    "retention_curve_head": _sql(_COHORTS + _CURVE + """
SELECT period, CAST(cents // 10 + CASE WHEN cents % 10 > 5 OR (cents % 10 = 5 AND (cents // 10) % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) / 10.0 AS avg_retention_pct
FROM (SELECT period, CAST(round(avg_retention_pct * 100) AS BIGINT) AS cents FROM curve WHERE period < 6)"""),

    "avg_retention_curve": _sql(_COHORTS + _CURVE + """
SELECT * FROM curve ORDER BY period"""),

    "retention_m1_m3": _sql(_COHORTS + _CURVE + """
SELECT MAX(CASE WHEN period = 1 THEN avg_retention_pct END) AS m1_retention_pct,
       MAX(CASE WHEN period = 3 THEN avg_retention_pct END) AS m3_retention_pct
FROM curve"""),

    "ab_summary": _sql(f"""
SELECT grp, COUNT(*) AS n, CAST(SUM(converted) AS BIGINT) AS conversions,
       {_r("100.0 * SUM(converted) / COUNT(*)", 2)} AS conversion_rate_pct,
       {_mean("order_value", 2, 5)} AS avg_order_value_incl_zero
FROM rc_campaign GROUP BY grp"""),

    "ab_test_result": _sql(_AB + f"""
SELECT n1 AS control_n, n2 AS variant_n,
       {_re("p1", 4)} AS control_conv_rate, {_re("p2", 4)} AS variant_conv_rate,
       {_re("p2 - p1", 4)} AS absolute_lift,
       {_re("(p2 / p1 - 1.0) * 100.0", 2)} AS relative_lift_pct,
       {_re("z", 3)} AS z_stat,
       {_re("p_value", 4)} AS p_value,
       {_re("(p2 - p1) - 1.96 * se", 4)} AS ci_95_low,
       {_re("(p2 - p1) + 1.96 * se", 4)} AS ci_95_high,
       p_value < 0.05 AS significant_at_05,
       {_re("(p2 - p1) * base * vconv", 0)} AS projected_incremental_revenue
FROM final"""),

    "ab_decision": _sql(_AB + f"""
SELECT CAST(0.05 AS DOUBLE) AS alpha, {_re("p_value", 4)} AS p_value, p_value < 0.05 AS significant,
       CASE WHEN p_value < 0.05 THEN 'statistically significant' WHEN p_value >= 0.05 THEN 'not statistically significant' END AS result
FROM final"""),

    "ab_arm_intervals": _sql(f"""
, per_arm AS (SELECT grp, COUNT(*) AS n, CAST(SUM(converted) AS BIGINT) AS conversions FROM rc_campaign GROUP BY grp),
w AS (SELECT *, CAST(conversions AS DOUBLE) / n AS p FROM per_arm),
h AS (SELECT *, CAST(1.96 AS DOUBLE) * sqrt(p * (1.0 - p) / n) AS hw FROM w)
SELECT grp, n, conversions, {_re("p", 4)} AS conv_rate, {_re("hw", 4)} AS half_width,
       {_re("p - hw", 4)} AS ci_low, {_re("p + hw", 4)} AS ci_high
FROM h"""),

    "ab_projection": _sql(_AB_COUNTS + f"""
SELECT {_re("vconv", 2)} AS avg_value_when_converted,
       {_re("(p2 - p1) * 1000.0", 1)} AS incremental_conversions_per_1000,
       base AS full_base,
       {_re("(p2 - p1) * base * vconv", 0)} AS projected_incremental_revenue
FROM ab_rates"""),

    "ab_sample_size": _sql(_AB_COUNTS + """
, v AS (SELECT p1 * (1.0 - p1) + p2 * (1.0 - p2) AS var, (p2 - p1) * (p2 - p1) AS diff2 FROM ab_rates),
powers AS (SELECT * FROM (VALUES (0.8, 0.8416212335729143), (0.9, 1.2815515655446004)) AS t(power, z_beta))
SELECT CAST(power AS DOUBLE) AS power,
       CAST(ceil((1.96::DOUBLE + z_beta::DOUBLE) * (1.96::DOUBLE + z_beta::DOUBLE) * var / NULLIF(diff2, 0)) AS BIGINT)
         AS needed_per_arm
FROM v, powers"""),

    "dq_table_profile": _sql(" UNION ALL ".join(
        _profile(name, rel, cols) for name, rel, cols in (
            ("orders", "rc_orders",
             ["order_id", "customer_id", "order_date", "status", "region", "acquisition_channel"]),
            ("order_items", "rc_items", ["order_id", "product_id", "quantity", "unit_price", "unit_cost"]),
            ("products", "rc_products", ["product_id", "category", "unit_price", "unit_cost", "product_name"]),
            ("customers", "rc_customers", ["customer_id", "signup_date", "region", "acquisition_channel"]),
        ))),

    "dq_invalid_values": _sql("""
SELECT CAST(COUNT(*) FILTER (WHERE unit_price <= 0) AS BIGINT) AS invalid_prices,
       CAST(COUNT(*) FILTER (WHERE quantity <= 0) AS BIGINT) AS invalid_quantities
FROM rc_items"""),

    "dq_primary_keys": _sql(" UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, '{key}' AS key_columns,
       CAST(COUNT(*) FILTER (WHERE n > 1) AS BIGINT) AS duplicated_keys,
       CAST(COALESCE(SUM(CASE WHEN {key} IS NULL THEN n END), 0) AS BIGINT) AS null_keys
FROM (SELECT {key}, COUNT(*) AS n FROM {rel} GROUP BY {key})"""
        for name, rel, key in (("customers", "rc_customers", "customer_id"),
                               ("products", "rc_products", "product_id"),
                               ("orders", "rc_orders", "order_id")))),

    "dq_foreign_keys": _sql(" UNION ALL ".join(
        f"""SELECT '{child}' AS child_table, '{fk}' AS child_column, '{parent}' AS parent_table,
       COUNT(*) AS orphan_rows
FROM {crel} x WHERE x.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {prel} p WHERE p.{pk} = x.{fk})"""
        for child, crel, fk, parent, prel, pk in (
            ("orders", "rc_orders", "customer_id", "customers", "rc_customers", "customer_id"),
            ("order_items", "rc_items", "order_id", "orders", "rc_orders", "order_id"),
            ("order_items", "rc_items", "product_id", "products", "rc_products", "product_id"),
            ("ab_test_campaign", "rc_campaign", "customer_id", "customers", "rc_customers", "customer_id"),
        ))),

    "sample_customers": _sql("""
SELECT customer_id, region, acquisition_channel FROM rc_customers
ORDER BY md5(CAST(customer_id AS VARCHAR) || ':7'), customer_id LIMIT 1500"""),

    "ab_assignment": _sql("""
SELECT customer_id,
       CASE WHEN substr(md5(CAST(customer_id AS VARCHAR) || ':arm'), 1, 1) < '8' THEN 'control' ELSE 'variant' END
         AS grp
FROM rc_customers"""),

    "customers_by_quarter_region": _sql("""
, l AS (SELECT *, year(order_date) * 4 + quarter(order_date) AS qtr FROM rc_order_level),
c AS (SELECT DISTINCT qtr, region, customer_id FROM l),
k AS (SELECT c.qtr, c.region, COUNT(*) AS customers, COUNT(b.customer_id) AS returning_customers
      FROM c LEFT JOIN c b ON b.customer_id = c.customer_id AND b.region IS NOT DISTINCT FROM c.region AND b.qtr = c.qtr - 1 GROUP BY 1, 2),
s AS (SELECT qtr, region, COUNT(*) AS orders, SUM(order_revenue) AS revenue FROM l GROUP BY 1, 2)
SELECT ((qtr - 1) // 4) || '-Q' || ((qtr - 1) % 4 + 1) AS order_quarter, region, orders, CAST(revenue AS DOUBLE) AS revenue, customers, returning_customers
FROM s JOIN k USING (qtr, region)"""),

    "value_quartiles_by_region": _sql(_VALUES + """
SELECT region, customers, CAST(q25 AS DOUBLE) AS q25, CAST(q50 AS DOUBLE) AS q50, CAST(q75 AS DOUBLE) AS q75 FROM q"""),

    "value_scores_by_region": _sql(_VALUES + """
SELECT customer_id, v.region, CAST(monetary AS DOUBLE) AS monetary,
       CAST(1 + (monetary > q25)::INT + (monetary > q50)::INT + (monetary > q75)::INT AS BIGINT) AS value_score
FROM v JOIN q ON q.region IS NOT DISTINCT FROM v.region"""),

    "dashboard_sections": _sql("".join((
        _MONTHLY_FILLED, _CELLS, _RFM + _SEGMENTS, _COHORTS, _AB, f""",
ab AS ({_AB_ROW}),
cat AS (SELECT category, SUM(oi.quantity * oi.unit_price) AS revenue FROM rc_items oi
        SEMI JOIN (SELECT order_id FROM rc_orders WHERE status = 'completed') o ON o.order_id = oi.order_id
        JOIN rc_products p ON p.product_id = oi.product_id GROUP BY category),
cat_placed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY revenue DESC, category) - 1 AS p FROM cat),
seg_placed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY total_revenue DESC, segment) - 1 AS p FROM seg_summary),
filled_placed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY month) - 1 AS p FROM filled),
shares AS (SELECT *, {_re("retention * 100.0", 1)} AS share FROM ret),
kpi AS (SELECT ROUND(SUM(order_revenue), 0) AS total_revenue, COUNT(*) AS total_orders, COUNT(DISTINCT customer_id) AS total_customers,
               {_mean("order_revenue", 2, 5)} AS aov FROM rc_order_level),
sections(section, position, row_label, column_label, value, display, heat) AS (
SELECT 'monthly', CAST(p AS BIGINT), strftime(month, '%b %Y'), 'revenue', CAST(ROUND(revenue, 2) AS DOUBLE), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE) FROM filled_placed
UNION ALL SELECT 'category', CAST(p AS BIGINT), category, 'revenue', CAST(ROUND(revenue, 2) AS DOUBLE), NULL, NULL FROM cat_placed
UNION ALL SELECT 'region_channel', 0, region, acquisition_channel, CAST(ROUND(revenue, 0) AS DOUBLE), NULL, NULL FROM cells
UNION ALL SELECT 'region_channel_k', 0, region, acquisition_channel, CAST((CAST(revenue * 100 AS BIGINT) + 50000) // 100000 AS DOUBLE),
                 '$' || format('{{:,}}', (CAST(revenue * 100 AS BIGINT) + 50000) // 100000) || 'K', NULL FROM cells
UNION ALL SELECT 'cohort', period, strftime(cohort_month, '%Y-%m-%d'), 'M+' || period, share, CAST(CAST(round_even(share, 0) AS BIGINT) AS VARCHAR) || '%',
                 least(greatest(share / 100.0, 0.0), 1.0) FROM shares
UNION ALL {_long("rfm", "seg_placed", ["customers", "avg_recency_days", "avg_frequency", "avg_monetary", "total_revenue", "pct_of_customers", "pct_of_revenue"], "segment", "p")}
UNION ALL {_long("ab_test", "ab", _AB_NAMES, "'total'", "0")}
UNION ALL {_long("kpis", "kpi", ["total_revenue", "total_orders", "total_customers", "aov"], "'total'", "0")})
SELECT * FROM sections"""))),

    "best_customer_month": _sql("""
, cm AS (SELECT customer_id, date_trunc('month', order_date) AS m, SUM(order_revenue) AS v FROM rc_order_level
         WHERE customer_id IS NOT NULL AND order_date IS NOT NULL GROUP BY 1, 2),
top AS (SELECT customer_id, m FROM cm ORDER BY v DESC, customer_id, m LIMIT 1)
SELECT order_id, l.customer_id, strftime(order_date, '%Y-%m-%d') AS order_date, region, acquisition_channel, CAST(order_revenue AS DOUBLE) AS order_revenue
FROM rc_order_level l JOIN top ON top.customer_id = l.customer_id AND top.m = date_trunc('month', l.order_date)"""),

    "csv_types": _sql(", s AS (" + " UNION ALL ".join((
        _types("customers", "rc_customers", _texts("customer_id", "signup_date", "region", "acquisition_channel")),
        _types("products", "rc_products", _texts("product_id", "category", "unit_price", "unit_cost", "product_name")),
        _types("orders", "rc_orders", _texts("order_id", "customer_id", "order_date", "status", "region", "acquisition_channel")),
        _types("order_items", "rc_items", _texts("order_id", "product_id", "quantity", "unit_price", "unit_cost")),
        _types("ab_test_campaign", "rc_campaign", _texts("customer_id", "grp", "converted", "order_value", order_value="CAST(CAST(order_value AS DECIMAL(38,5)) AS VARCHAR)")))) + """)
SELECT table_name, column_name,
       CASE WHEN filled > 0 AND integers = filled THEN CASE WHEN whole <= 9 THEN 'int' ELSE 'bigint' END WHEN filled > 0 AND dates = filled THEN 'date'
            WHEN filled > 0 AND decimals = filled THEN CASE WHEN fraction <= 2 THEN 'decimal(' || greatest(whole + 2, 12) || ',2)' ELSE 'double' END ELSE 'string' END AS type,
       rows, nulls, CAST(0 AS BIGINT) AS failures, integers, decimals, dates
FROM s"""),

    "published_tables": _sql(" UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, CAST(1 AS BIGINT) AS version, COUNT(*) AS rows, COUNT(DISTINCT {key}) AS distinct_keys, true AS refused FROM {rel}"""
        for name, rel, key in (("customers", "rc_customers", "customer_id"), ("products", "rc_products", "product_id"), ("orders", "rc_orders", "order_id")))),

    "eda_key_figures": _sql(f"""
, c AS (SELECT COUNT(*) AS total_orders, COUNT(*) FILTER (WHERE status = 'completed') AS completed_orders
        FROM rc_orders),
r AS (SELECT CAST(ROUND(SUM(order_revenue), 2) AS DOUBLE) AS total, {_mean("order_revenue", 2, 5)} AS aov
      FROM rc_order_level)
SELECT 'total_orders' AS metric, CAST(total_orders AS DOUBLE) AS value FROM c
UNION ALL SELECT 'completed_orders', CAST(completed_orders AS DOUBLE) FROM c
UNION ALL SELECT 'completion_rate', ROUND(CAST(completed_orders AS DOUBLE) / total_orders, 4) FROM c
UNION ALL SELECT 'total_revenue', total FROM r
UNION ALL SELECT 'average_order_value', aov FROM r"""),

    "kpi_strip": _sql(f"""
, k AS (SELECT ROUND(SUM(order_revenue), 2) AS total_revenue, COUNT(*) AS total_orders,
               COUNT(DISTINCT customer_id) AS total_customers, {_mean("order_revenue", 2, 5)} AS aov
        FROM rc_order_level)
SELECT '$' || format('{{:,.2f}}', {_r("total_revenue / 1000000", 2)}) || 'M' AS total_revenue_text,
       format('{{:,}}', total_orders) AS total_orders_text,
       format('{{:,}}', total_customers) AS total_customers_text,
       '$' || format('{{:,.2f}}', aov) AS aov_text
FROM k"""),

    "customers_by_signup": _sql("""
SELECT ROW_NUMBER() OVER (ORDER BY signup_date, customer_id) - 1 AS row_index, customer_id,
       strftime(signup_date, '%Y-%m-%d') AS signup_date, region, acquisition_channel
FROM rc_customers"""),

    "customer_codes": _sql("""
SELECT customer_id, printf('CUST%05d', customer_id) AS customer_code FROM rc_customers"""),
}
