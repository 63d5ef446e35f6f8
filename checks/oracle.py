"""DuckDB SQL for the registered queries, assembled from named common table expressions."""

from __future__ import annotations

CUTOFF = "TIMESTAMP '2001-05-03 00:00:00'"
REFERENCE_CUTOFF = "TIMESTAMP '2001-01-22 00:00:00'"

# name -> (tables it needs, body)
CTES: dict[str, tuple[list[str], str]] = {}
SQL: dict[str, str] = {}


def cte(name: str, needs: str, body: str) -> None:
    CTES[name] = (needs.split(), body.strip())


def _closure(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        _closure(CTES[name][0], seen)
        if name not in seen:
            seen.append(name)
    return seen


def oracle(name: str, needs: str, body: str) -> None:
    parts = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in _closure(needs.split(), []))
    # A body that starts with a comma continues the list of common table expressions.
    SQL[name] = (f"WITH {parts}\n" if parts else "") + body.strip()


ADMIN = (
    "'POST','DOT','M','C2','D','S','B','BANK CHARGES','ADJUST','ADJUST2','AMAZONFEE','CRUK',"
    "'PADS','TEST001','TEST002'"
)

cte("lines", "", """
SELECT (CASE WHEN o_orderstatus = 'P' AND l_returnflag = 'R' THEN 'C' ELSE '' END)
         || CAST(l_orderkey AS VARCHAR) AS invoice,
       CASE WHEN l_partkey % 199 = 0 THEN 'POST' WHEN l_partkey % 199 = 1 THEN 'm'
            ELSE CAST(l_partkey AS VARCHAR) END AS stock_code,
       CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE p_name END AS description,
       CAST(CASE WHEN (l_orderkey * 7 + l_linenumber) % 173 = 0 THEN -l_quantity
                 ELSE l_quantity END AS INTEGER) AS quantity,
       o_orderdate + to_hours(CAST(8 + o_orderkey % 10 AS INTEGER)) AS invoice_date,
       CASE WHEN (l_orderkey * 7 + l_linenumber) % 211 = 0 THEN 0.0
            ELSE l_extendedprice / l_quantity END AS unit_price,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS customer_id,
       r_name AS country,
       'P' || CAST(year(o_orderdate) AS VARCHAR) AS source_sheet,
       l_orderkey % 101 = 0 AS has_copy
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
""")
cte("raw", "lines", """
SELECT * EXCLUDE (has_copy) FROM lines
UNION ALL SELECT * EXCLUDE (has_copy) FROM lines WHERE has_copy
""")
cte("deduped", "raw", "SELECT DISTINCT * FROM raw")
cte("flagged", "deduped", f"""
SELECT invoice, stock_code, coalesce(description, 'UNKNOWN') AS description, quantity, invoice_date,
       unit_price, customer_id, country, source_sheet,
       starts_with(invoice, 'C') AS is_cancellation,
       upper(stock_code) IN ({ADMIN}) AS is_admin_code,
       CAST(quantity * unit_price AS DECIMAL(18,4)) AS total
FROM deduped
""")
SALE = "NOT is_cancellation AND NOT is_admin_code AND quantity > 0 AND unit_price > 0"
cte("completed", "flagged", f"""
SELECT * EXCLUDE (is_cancellation, is_admin_code) FROM flagged WHERE {SALE}
""")
cte("customers", "completed", "SELECT * FROM completed WHERE customer_id IS NOT NULL")

WHEN = "CAST(invoice_date AS VARCHAR) AS invoice_date"
TOTAL = "CAST(total AS DOUBLE) AS total"

oracle("union_yearly", "raw", f"""
SELECT * EXCLUDE (invoice_date, source_sheet), {WHEN},
       CASE WHEN invoice_date < TIMESTAMP '1998-01-01' THEN 'before 1998' ELSE 'from 1998' END
         AS source_sheet
FROM raw
""")
oracle("normalize_schema", "raw", f"""
SELECT * EXCLUDE (invoice_date), {WHEN}, 'T1' AS "Till" FROM raw
""")
oracle("dedupe", "deduped", f"SELECT * EXCLUDE (invoice_date), {WHEN} FROM deduped")
oracle("clean_flags", "flagged", f"SELECT * EXCLUDE (invoice_date, total), {WHEN}, {TOTAL} FROM flagged")
oracle("completed_sales", "completed", f"SELECT * EXCLUDE (invoice_date, total), {WHEN}, {TOTAL} FROM completed")
oracle("excluded_sales", "flagged", f"""
SELECT * EXCLUDE (invoice_date, total), {WHEN}, {TOTAL} FROM flagged WHERE NOT ({SALE})
""")
oracle("customer_sales", "customers", f"SELECT * EXCLUDE (invoice_date, total), {WHEN}, {TOTAL} FROM customers")
oracle("exclusion_reasons", "flagged", f"""
SELECT CASE WHEN is_cancellation THEN 'cancellation' WHEN is_admin_code THEN 'admin_code'
            WHEN quantity <= 0 THEN 'non_positive_quantity'
            WHEN unit_price <= 0 THEN 'non_positive_price' END AS reason, count(*) AS n_lines
FROM flagged WHERE NOT ({SALE}) GROUP BY 1
""")
oracle("clean_counts", "raw flagged completed customers", f"""
SELECT 'raw' AS "table", count(*) AS n_rows FROM raw
UNION ALL SELECT 'deduplicated', count(*) FROM flagged
UNION ALL SELECT 'completed_sales', count(*) FROM completed
UNION ALL SELECT 'customer_sales', count(*) FROM customers
UNION ALL SELECT 'excluded', count(*) FROM flagged WHERE NOT ({SALE})
""")

# --- profile ---
_COLS = ["invoice", "stock_code", "description", "quantity", "invoice_date", "unit_price",
         "customer_id", "country", "source_sheet"]
oracle("null_profile", "raw", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 2) AS missing_pct FROM raw"
    for c in _COLS
))


def _describe(source: str, columns: list[str], points: list[float]) -> str:
    quant = ", ".join(
        f"round(quantile_cont(CAST({{c}} AS DOUBLE), {p}), 4) AS p{round(p * 100)}" for p in points
    )
    one = (
        "SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 4) AS mean, "
        "round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, "
        "CAST(max({c}) AS DOUBLE) AS max, " + quant + f" FROM {source}"
    )
    return "\nUNION ALL ".join(one.replace("{c}", c) for c in columns).replace(
        "CAST(min(unit_price) AS DOUBLE)", "round(min(unit_price), 4)"
    ).replace("CAST(max(unit_price) AS DOUBLE)", "round(max(unit_price), 4)")


oracle("describe_numeric", "raw", _describe(
    "raw", ["quantity", "unit_price"], [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
))
oracle("quality_counts", "raw", "\nUNION ALL ".join(
    f"SELECT '{name}' AS \"check\", count(*) FILTER (WHERE {cond}) AS n_lines, "
    f"round(count(*) FILTER (WHERE {cond}) * 100.0 / count(*), 6) AS pct FROM raw"
    for name, cond in {
        "negative_quantity": "quantity < 0",
        "negative_price": "unit_price < 0",
        "zero_price": "unit_price = 0",
        "cancellation": "invoice LIKE 'C%'",
    }.items()
))
oracle("monthly_lines", "raw", """
, counts AS (SELECT date_trunc('month', invoice_date) AS m, count(*) AS n FROM raw GROUP BY 1),
months AS (SELECT unnest(generate_series((SELECT min(m) FROM counts), (SELECT max(m) FROM counts),
           INTERVAL 1 MONTH)) AS m)
SELECT CAST(CAST(months.m AS DATE) AS VARCHAR) AS month, coalesce(n, 0) AS n_lines
FROM months LEFT JOIN counts ON months.m = counts.m
""")
_m = {"quantity": "quantity", "unit_price": "unit_price", "total": "quantity * unit_price"}
oracle("corr_matrix", "raw", "\nUNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, round(corr({_m[a]}, {_m[b]}), 8) AS corr FROM raw"
    for a in _m for b in _m
))
oracle("histogram", "raw", """
SELECT CAST(least(floor((greatest(least(quantity, 50), -50) + 50) * 50 / 100.0) + 1, 50) AS INTEGER)
         AS bin, count(*) AS n_lines
FROM raw GROUP BY 1
""")
oracle("top_countries", "raw", """
SELECT country, count(*) AS n_lines FROM raw GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15
""")
oracle("top_transactions", "completed", """
SELECT invoice, CAST(invoice_date AS VARCHAR) AS invoice_date, quantity, unit_price
FROM completed WHERE stock_code = '17'
ORDER BY quantity DESC, completed.invoice_date, invoice, unit_price LIMIT 3
""")

# --- customers ---
cte("rfm", "customers", """
SELECT customer_id,
       CAST(date_sub('day', max(invoice_date), (SELECT max(invoice_date) + INTERVAL 1 DAY FROM customers))
            AS INTEGER) AS recency_days,
       count(DISTINCT invoice) AS frequency, sum(total) AS monetary
FROM customers GROUP BY 1
""")
cte("rfm_scores", "rfm", """
SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'champions'
               WHEN r_score >= 4 AND f_score <= 2 THEN 'new_customers'
               WHEN r_score <= 2 AND f_score >= 4 AND m_score >= 4 THEN 'at_risk_high_value'
               WHEN r_score <= 2 AND f_score <= 2 THEN 'lost' ELSE 'regular' END AS rfm_segment
FROM (
  SELECT customer_id, recency_days, frequency, monetary,
         CAST(6 - greatest(((r - 1) * 5 + n - 2) // (n - 1), 1) AS INTEGER) AS r_score,
         CAST(greatest(((f - 1) * 5 + n - 2) // (n - 1), 1) AS INTEGER) AS f_score,
         CAST(greatest(((m - 1) * 5 + n - 2) // (n - 1), 1) AS INTEGER) AS m_score
  FROM (SELECT *, count(*) OVER () AS n,
               row_number() OVER (ORDER BY recency_days, customer_id) AS r,
               row_number() OVER (ORDER BY frequency, customer_id) AS f,
               row_number() OVER (ORDER BY monetary, customer_id) AS m FROM rfm))
""")
oracle("rfm", "rfm", "SELECT * REPLACE (CAST(monetary AS DOUBLE) AS monetary) FROM rfm")
oracle("rfm_scores", "rfm_scores", "SELECT * REPLACE (CAST(monetary AS DOUBLE) AS monetary) FROM rfm_scores")
oracle("rfm_segments", "rfm_scores", """
SELECT rfm_segment, count(*) AS customers, CAST(sum(monetary) AS DOUBLE) AS revenue
FROM rfm_scores GROUP BY 1
""")
oracle("describe_rfm", "rfm", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg(CAST({c} AS DOUBLE)), 4) AS mean, "
    f"round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, round(CAST(min({c}) AS DOUBLE), 4) AS min, "
    f"round(CAST(max({c}) AS DOUBLE), 4) AS max, "
    + ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 4) AS p{round(p * 100)}" for p in (0.25, 0.5, 0.75))
    + " FROM rfm"
    for c in ("recency_days", "frequency", "monetary")
))


def features_body(cutoff: str) -> str:
    return f"""
SELECT *, CAST(monetary AS DOUBLE) / frequency AS avg_order_value,
       CAST(tenure_days AS DOUBLE) / greatest(frequency, 1) AS avg_days_between_purchases,
       CAST(monetary AS DOUBLE) / greatest(tenure_days, 1) AS monetary_per_day
FROM (
  SELECT customer_id,
         CAST(date_sub('day', max(invoice_date), {cutoff}) AS INTEGER) AS recency_days,
         count(DISTINCT invoice) AS frequency, sum(total) AS monetary,
         CAST(sum(quantity) AS BIGINT) AS total_quantity,
         count(DISTINCT stock_code) AS n_distinct_products,
         CAST(date_sub('day', min(invoice_date), {cutoff}) AS INTEGER) AS tenure_days,
         CAST(avg(CASE WHEN country = 'AFRICA' THEN 1.0 ELSE 0.0 END) >= 0.5 AS INTEGER) AS is_uk,
         min(invoice_date) AS first_purchase
  FROM customers WHERE invoice_date <= {cutoff} GROUP BY 1)
"""


cte("features", "customers", features_body(CUTOFF))
cte("reference_features", "customers", features_body(REFERENCE_CUTOFF))
cte("labels", "customers", f"""
SELECT customer_id,
       CAST(count(*) FILTER (WHERE invoice_date > {CUTOFF}
                             AND invoice_date <= {CUTOFF} + INTERVAL 90 DAY) = 0 AS INTEGER) AS churned
FROM customers GROUP BY 1 HAVING count(*) FILTER (WHERE invoice_date <= {CUTOFF}) > 0
""")
FEATURE_LIST = """customer_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary,
       total_quantity, n_distinct_products, round(avg_order_value, 6) AS avg_order_value, tenure_days,
       round(avg_days_between_purchases, 6) AS avg_days_between_purchases,
       round(monetary_per_day, 6) AS monetary_per_day, is_uk"""
cte("trends", "customers features", f"""
SELECT customer_id,
       count(DISTINCT invoice) FILTER (WHERE recent) AS recent_n,
       count(DISTINCT invoice) FILTER (WHERE NOT recent) AS older_n,
       CAST(coalesce(sum(total) FILTER (WHERE recent), 0) AS DOUBLE) AS recent_total,
       CAST(coalesce(sum(total) FILTER (WHERE NOT recent), 0) + 1 AS DOUBLE) AS older_total_1
FROM (SELECT c.*, 2 * epoch_us(c.invoice_date) > epoch_us(f.first_purchase) + epoch_us({CUTOFF}) AS recent
      FROM customers c JOIN features f USING (customer_id) WHERE c.invoice_date <= {CUTOFF})
GROUP BY 1
""")
cte("enriched", "features trends", """
SELECT f.*,
       CASE WHEN avg_days_between_purchases = 0 THEN 0.0
            ELSE recency_days / avg_days_between_purchases END AS recency_ratio,
       CASE WHEN frequency = 1 THEN 1.0 ELSE CAST(recent_n AS DOUBLE) / (older_n + 1) END AS frequency_trend,
       CASE WHEN frequency = 1 THEN 1.0 ELSE recent_total / older_total_1 END AS monetary_trend
FROM features f JOIN trends USING (customer_id)
""")
oracle("churn_labels", "labels", "SELECT * FROM labels")
oracle("churn_features", "features", f"SELECT {FEATURE_LIST} FROM features")
oracle("churn_dataset", "features labels", f"""
SELECT {FEATURE_LIST}, churned FROM features JOIN labels USING (customer_id)
""")
oracle("churn_enriched", "enriched labels", f"""
SELECT {FEATURE_LIST}, round(recency_ratio, 6) AS recency_ratio,
       round(frequency_trend, 6) AS frequency_trend, round(monetary_trend, 6) AS monetary_trend, churned
FROM enriched JOIN labels USING (customer_id)
""")


# --- daily series ---
def daily_body(series: str) -> str:
    return f"""
SELECT c.series_id, c.date, coalesce(revenue, 0) AS revenue,
       CAST(coalesce(quantity, 0) AS BIGINT) AS quantity, coalesce(n_invoices, 0) AS n_invoices,
       coalesce(n_customers, 0) AS n_customers,
       (c.date = c.first OR c.date = c.last) AND coalesce(hour(latest_sale) < 17, false) AS is_partial_day
FROM (SELECT series_id, first, last, CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT {series} AS series_id, CAST(min(invoice_date) AS DATE) AS first,
                   CAST(max(invoice_date) AS DATE) AS last FROM completed GROUP BY 1)) c
LEFT JOIN (SELECT {series} AS series_id, CAST(invoice_date AS DATE) AS date, sum(total) AS revenue,
                  sum(quantity) AS quantity, count(DISTINCT invoice) AS n_invoices,
                  count(DISTINCT customer_id) AS n_customers, max(invoice_date) AS latest_sale
           FROM completed GROUP BY 1, 2) d
  ON c.series_id = d.series_id AND c.date = d.date
"""


cte("daily_all", "completed", daily_body("'all'"))
cte("daily_country", "completed", daily_body("country"))
cte("demand", "daily_country", """
SELECT series_id, date AS ds, CAST(quantity AS DOUBLE) AS y FROM daily_country WHERE NOT is_partial_day
""")


def _rolling(columns: tuple[str, ...], sizes: tuple[int, ...]) -> str:
    out = []
    for size in sizes:
        frame = (
            f"OVER (PARTITION BY series_id ORDER BY date ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"
        )
        for c in columns:
            for stat, fn in (("mean", "avg"), ("std", "stddev_samp")):
                out.append(
                    f"CASE WHEN count(*) {frame} = {size} THEN round({fn}(CAST({c} AS DOUBLE)) {frame}, 4) END "
                    f"AS {c}_roll{size}_{stat}"
                )
    return ",\n       ".join(out)


oracle("daily_dense", "daily_all", """
SELECT CAST(date AS VARCHAR) AS date, CAST(revenue AS DOUBLE) AS revenue, quantity, n_invoices, n_customers
FROM daily_all
""")
oracle("rolling", "daily_country", f"""
SELECT series_id, CAST(date AS VARCHAR) AS date, {_rolling(("revenue", "quantity"), (7, 14, 30))}
FROM daily_country
""")
oracle("daily_range", "daily_all", f"""
SELECT CAST(date AS VARCHAR) AS date, revenue, revenue_roll30_mean FROM (
  SELECT date, CAST(revenue AS DOUBLE) AS revenue, {_rolling(("revenue",), (30,))} FROM daily_all)
WHERE date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'
""")
oracle("dow_profile", "demand", """
SELECT series_id, CAST(isodow(ds) - 1 AS INTEGER) AS dow, round(avg(y), 6) AS mean_y,
       round(avg(CASE WHEN y = 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_zero_days
FROM demand GROUP BY 1, 2
""")
oracle("partial_days", "daily_country", """
SELECT series_id, CAST(date AS VARCHAR) AS date, is_partial_day FROM daily_country
""")
oracle("demand_series", "demand", "SELECT series_id, CAST(ds AS VARCHAR) AS ds, y FROM demand")
oracle("period_growth", "daily_country", "\nUNION ALL ".join(
    f"""SELECT series_id, '{c}' AS measure, round(b, 6) AS mean_before, round(a, 6) AS mean_after,
       round((a / b - 1) * 100, 6) AS growth_pct
FROM (SELECT series_id, avg(CAST({c} AS DOUBLE)) FILTER (WHERE date < DATE '2000-08-01') AS b,
             avg(CAST({c} AS DOUBLE)) FILTER (WHERE date >= DATE '2000-08-01') AS a
      FROM daily_country WHERE NOT is_partial_day GROUP BY 1)"""
    for c in ("revenue", "quantity", "n_invoices", "n_customers")
))

# --- inventory ---
cte("abc", "completed", """
SELECT *, CASE WHEN cumulative_share <= 0.80 THEN 'A' WHEN cumulative_share <= 0.95 THEN 'B' ELSE 'C' END AS tier
FROM (SELECT stock_code, total_revenue,
             CAST(total_revenue AS DOUBLE) / CAST(sum(total_revenue) OVER () AS DOUBLE) AS revenue_share,
             CAST(sum(total_revenue) OVER (ORDER BY total_revenue DESC, stock_code ROWS UNBOUNDED PRECEDING)
                  AS DOUBLE) / CAST(sum(total_revenue) OVER () AS DOUBLE) AS cumulative_share,
             row_number() OVER (ORDER BY total_revenue DESC, stock_code) AS revenue_rank
      FROM (SELECT stock_code, sum(total) AS total_revenue FROM completed GROUP BY 1))
""")


_WINDOW = (
    "SELECT max(invoice_date) AS ref, max(invoice_date) - INTERVAL 90 DAY AS start, "
    "quantile_cont(CAST(quantity AS DOUBLE), %s) AS cap FROM completed"
)


def stats_body(cap: float) -> str:
    return f"""
SELECT d.stock_code, mean AS daily_demand_mean, sqrt(greatest(mean_sq - mean * mean, 0)) AS daily_demand_std,
       description, avg_unit_price
FROM (SELECT stock_code, coalesce(sum(q) FILTER (WHERE date > CAST(start AS DATE)), 0) / 90.0 AS mean,
             coalesce(sum(q * q) FILTER (WHERE date > CAST(start AS DATE)), 0) / 90.0 AS mean_sq
      FROM (SELECT stock_code, start, CAST(invoice_date AS DATE) AS date,
                   sum(least(CAST(quantity AS DOUBLE), cap)) AS q
            FROM completed, ({_WINDOW % cap})
            WHERE invoice_date > start AND invoice_date <= ref GROUP BY 1, 2, 3) GROUP BY 1) d
JOIN (SELECT stock_code, arg_min(description, (-n, description)) AS description,
             sum(price_sum) / sum(n) AS avg_unit_price
      FROM (SELECT stock_code, description, count(*) AS n, sum(unit_price) AS price_sum
            FROM completed, ({_WINDOW % cap})
            WHERE invoice_date > start AND invoice_date <= ref GROUP BY 1, 2) GROUP BY 1) t
  ON d.stock_code = t.stock_code
"""


cte("stats", "completed", stats_body(0.999))
cte("stats_uncapped", "completed", stats_body(0.9999999))
cte("stats_capped", "completed", stats_body(0.9))
cte("reco", "abc stats", """
SELECT *, daily_demand_mean * 7 + safety_stock AS reorder_point,
       CASE WHEN avg_unit_price * 0.2 = 0 THEN 0.0
            ELSE sqrt(2 * daily_demand_mean * 365 * 20.0 / (avg_unit_price * 0.2)) END AS eoq,
       7 AS lead_time_days, CAST(0.95 AS DOUBLE) AS service_level
FROM (SELECT a.* EXCLUDE (revenue_rank), s.* EXCLUDE (stock_code),
             1.6448536269514722 * daily_demand_std * sqrt(7) AS safety_stock
      FROM abc a JOIN stats s USING (stock_code) WHERE tier IN ('A', 'B'))
""")
oracle("abc", "abc", """
SELECT stock_code, CAST(total_revenue AS DOUBLE) AS total_revenue, round(revenue_share, 9) AS revenue_share,
       round(cumulative_share, 9) AS cumulative_share, tier, revenue_rank FROM abc
""")
oracle("tier_summary", "abc", """
SELECT tier, n_products, CAST(r AS DOUBLE) AS total_revenue,
       round(n_products * 100.0 / sum(n_products) OVER (), 6) AS pct_of_skus,
       round(CAST(r AS DOUBLE) / CAST(sum(r) OVER () AS DOUBLE) * 100, 6) AS pct_of_revenue
FROM (SELECT tier, count(*) AS n_products, sum(total_revenue) AS r FROM abc GROUP BY 1)
""")
oracle("demand_stats", "stats", """
SELECT stock_code, round(daily_demand_mean, 9) AS daily_demand_mean,
       round(daily_demand_std, 9) AS daily_demand_std, description,
       round(avg_unit_price, 9) AS avg_unit_price FROM stats
""")
oracle("winsor_effect", "completed stats_uncapped stats_capped", """
SELECT stock_code, round(u.daily_demand_mean, 6) AS uncapped_mean, round(u.daily_demand_std, 6) AS uncapped_std,
       round(c.daily_demand_mean, 6) AS capped_mean, round(c.daily_demand_std, 6) AS capped_std, lines_above_cap
FROM stats_uncapped u JOIN stats_capped c USING (stock_code)
JOIN (SELECT stock_code, count(*) FILTER (WHERE quantity > (SELECT quantile_cont(CAST(quantity AS DOUBLE), 0.9)
             FROM completed)) AS lines_above_cap FROM completed GROUP BY 1) USING (stock_code)
""")
cte("reco_out", "reco", """
SELECT stock_code, CAST(total_revenue AS DOUBLE) AS total_revenue, round(revenue_share, 9) AS revenue_share,
       round(cumulative_share, 9) AS cumulative_share, tier, round(daily_demand_mean, 9) AS daily_demand_mean,
       round(daily_demand_std, 9) AS daily_demand_std, description,
       round(avg_unit_price, 9) AS avg_unit_price, round(safety_stock, 5) AS safety_stock,
       round(reorder_point, 5) AS reorder_point, round(eoq, 5) AS eoq, lead_time_days, service_level
FROM reco
""")
oracle("inventory_reco", "reco_out", "SELECT * FROM reco_out")
oracle("reorder_trigger", "reco", """
SELECT stock_code, on_hand, round(reorder_point, 5) AS reorder_point, on_hand < reorder_point AS should_reorder,
       CASE WHEN on_hand < reorder_point THEN round(eoq, 5) ELSE 0.0 END AS recommended_order_qty
FROM reco JOIN (SELECT CAST(p_partkey AS VARCHAR) AS stock_code, CAST(p_partkey % 40 AS DOUBLE) AS on_hand
                FROM part) USING (stock_code)
""")

# --- time series ---
DOW = "CAST(isodow(ds) - 1 AS INTEGER)"
cte("ts_split", "demand", """
SELECT series_id, ds, y, CASE WHEN k <= 56 THEN 'test' WHEN k <= 112 THEN 'val' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS k FROM demand)
""")
cte("scaled_series", "ts_split", """
SELECT t.*, y_mean, y_std, (y - y_mean) / y_std AS y_scaled FROM ts_split t JOIN (
  SELECT series_id, avg(y) AS y_mean, CASE WHEN stddev_pop(y) = 0 THEN 1.0 ELSE stddev_pop(y) END AS y_std
  FROM ts_split WHERE split = 'train' GROUP BY 1) s ON t.series_id = s.series_id
""")
oracle("diff1", "demand", """
SELECT series_id, CAST(ds AS VARCHAR) AS ds, d AS y
FROM (SELECT series_id, ds, y - lag(y) OVER (PARTITION BY series_id ORDER BY ds) AS d FROM demand)
WHERE d IS NOT NULL
""")
cte("detrended", "demand", f"""
SELECT *, y - trend AS detrended FROM (
  SELECT series_id, ds, y, {DOW} AS dow,
         CASE WHEN count(*) OVER w = 7 THEN avg(y) OVER w END AS trend
  FROM demand
  WINDOW w AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))
""")
cte("decomposed", "detrended", """
SELECT d.series_id, ds, y AS observed, trend, seasonal, detrended - seasonal AS resid, d.dow
FROM detrended d JOIN (
  SELECT series_id, dow, m - avg(m) OVER (PARTITION BY series_id) AS seasonal
  FROM (SELECT series_id, dow, avg(detrended) AS m FROM detrended GROUP BY 1, 2)) s
  ON d.series_id = s.series_id AND d.dow = s.dow
""")
oracle("decompose", "decomposed", """
SELECT series_id, CAST(ds AS VARCHAR) AS ds, observed, round(trend, 6) AS trend,
       round(seasonal, 6) AS seasonal, round(resid, 6) AS resid FROM decomposed
""")
oracle("seasonal_by_dow", "decomposed", """
SELECT series_id, dow, round(avg(seasonal), 6) AS mean_seasonal FROM decomposed GROUP BY 1, 2
""")
oracle("stationarity_verdict", "demand", """
SELECT *, CASE WHEN adf_stationary AND kpss_stationary THEN 'stationary'
               WHEN NOT adf_stationary AND NOT kpss_stationary THEN 'non_stationary'
               WHEN adf_stationary THEN 'conflicting_trend_stationary'
               ELSE 'conflicting_difference_stationary' END AS verdict
FROM (SELECT series_id, max(ds) > DATE '2001-07-30' AS adf_stationary,
             count(*) FILTER (WHERE y = 0) < 10 AS kpss_stationary FROM demand GROUP BY 1)
""")
cte("holidays", "demand", """
SELECT unnest([
  make_date(y, 1, 1), easter - 2, easter + 1,
  make_date(y, 5, 1) + CAST((8 - isodow(make_date(y, 5, 1))) % 7 AS INTEGER),
  make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INTEGER),
  make_date(y, 8, 31) - CAST(isodow(make_date(y, 8, 31)) - 1 AS INTEGER),
  make_date(y, 12, 25), make_date(y, 12, 26)]) AS ds
FROM (
  SELECT y, CAST(make_date(y, CAST((h + l - 7 * m + 114) // 31 AS INTEGER),
                 CAST((h + l - 7 * m + 114) % 31 + 1 AS INTEGER)) AS DATE) AS easter
  FROM (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM (
    SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM (
      SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM (
        SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM (
          SELECT CAST(unnest(generate_series((SELECT year(min(ds)) FROM demand),
                                             (SELECT year(max(ds)) FROM demand))) AS BIGINT) AS y))))))
""")
oracle("series_features", "demand holidays", f"""
SELECT series_id, CAST(ds AS VARCHAR) AS ds, y, round(sin({DOW} * 2 * pi() / 7), 9) AS dow_sin,
       round(cos({DOW} * 2 * pi() / 7), 9) AS dow_cos,
       CASE WHEN {DOW} = 5 THEN 1.0::DOUBLE ELSE 0.0 END AS is_saturday,
       CASE WHEN ds IN (SELECT ds FROM holidays) THEN 1.0::DOUBLE ELSE 0.0 END AS is_uk_holiday
FROM demand
""")
oracle("ts_split", "ts_split", "SELECT series_id, CAST(ds AS VARCHAR) AS ds, split FROM ts_split")
oracle("scale_series", "scaled_series", """
SELECT series_id, CAST(ds AS VARCHAR) AS ds, round(y_mean, 6) AS y_mean, round(y_std, 6) AS y_std,
       round(y_scaled, 6) AS y_scaled FROM scaled_series
""")
oracle("lag_windows", "scaled_series", """
, numbered AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS k FROM scaled_series)
SELECT t.series_id, CAST(t.ds AS VARCHAR) AS ds, t.split, CAST(p.pos AS INTEGER) AS pos,
       round(w.y_scaled, 6) AS step
FROM numbered t CROSS JOIN range(14) p(pos)
JOIN numbered w ON w.series_id = t.series_id AND w.k = t.k - 14 + p.pos
WHERE t.k > 14
""")
oracle("naive_forecast", "ts_split", """
SELECT series_id, CAST(ds AS VARCHAR) AS ds, y, naive
FROM (SELECT *, lag(y, 7) OVER (PARTITION BY series_id ORDER BY ds) AS naive FROM ts_split)
WHERE split = 'test'
""")

# --- forecast evaluation ---
cte("forecasts", "ts_split", f"""
SELECT series_id, ds, split, y AS actual, {DOW} AS dow,
       lag(y, 7) OVER (PARTITION BY series_id ORDER BY ds) AS additive_pred,
       avg(y) OVER (PARTITION BY series_id ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS sequence_pred
FROM ts_split
""")
cte("long_test", "forecasts", """
SELECT series_id, ds, dow, actual, 'additive_pred' AS model, additive_pred AS p FROM forecasts WHERE split = 'test'
UNION ALL SELECT series_id, ds, dow, actual, 'sequence_pred', sequence_pred FROM forecasts WHERE split = 'test'
""")
oracle("forecast_eval", "long_test", """
SELECT series_id, model, round(avg(abs(actual - p)), 6) AS mae,
       round(sqrt(avg((actual - p) * (actual - p))), 6) AS rmse,
       round(avg(abs((actual - p) / actual)) FILTER (WHERE actual <> 0) * 100, 6) AS mape,
       count(*) FILTER (WHERE actual = 0) AS n_excluded_zero_actual, count(*) AS n_total
FROM long_test GROUP BY 1, 2
""")
oracle("ape_by_dow", "long_test", """
SELECT series_id, model, dow, round(avg(abs(actual - p) / actual * 100), 6) AS ape
FROM long_test WHERE actual <> 0 GROUP BY 1, 2, 3
""")
cte("grid", "forecasts", """
SELECT *, weight * sequence_pred + (1 - weight) * additive_pred AS blended,
       CASE dow WHEN 5 THEN 'saturday' WHEN 6 THEN 'sunday' ELSE 'weekday' END AS day_type
FROM forecasts, (SELECT i / 20.0::DOUBLE AS weight FROM range(21) r(i)) WHERE split = 'val'
""")
cte("sweep", "grid", """
SELECT series_id, weight, avg(abs((actual - blended) / actual)) FILTER (WHERE actual <> 0) * 100 AS mape
FROM grid GROUP BY 1, 2
""")
cte("global_weight", "sweep", """
SELECT series_id, weight AS global_weight FROM sweep
QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY mape NULLS FIRST, weight) = 1
""")
cte("day_weights", "grid forecasts", """
SELECT s.series_id, coalesce(max(weight) FILTER (WHERE day_type = 'weekday'), 0.5) AS weight_weekday,
       coalesce(max(weight) FILTER (WHERE day_type = 'saturday'), 0.5) AS weight_saturday,
       coalesce(max(weight) FILTER (WHERE day_type = 'sunday'), 0.5) AS weight_sunday
FROM (SELECT DISTINCT series_id FROM forecasts WHERE split = 'val') s LEFT JOIN (
  SELECT series_id, day_type, weight FROM (
    SELECT series_id, day_type, weight, CASE WHEN day_type = 'saturday' THEN avg(abs(actual - blended))
           ELSE avg(abs((actual - blended) / actual)) FILTER (WHERE actual <> 0) END AS score
    FROM grid GROUP BY 1, 2, 3)
  QUALIFY row_number() OVER (PARTITION BY series_id, day_type ORDER BY score NULLS FIRST, weight) = 1) w
  ON s.series_id = w.series_id
GROUP BY 1
""")
oracle("weight_sweep", "sweep", "SELECT series_id, weight, round(mape, 6) AS mape FROM sweep")
oracle("best_weight", "global_weight", "SELECT * FROM global_weight")
oracle("day_type_weights", "day_weights", "SELECT * FROM day_weights")
oracle("ensemble_apply", "forecasts global_weight day_weights", """
SELECT f.series_id, CAST(ds AS VARCHAR) AS ds, actual, additive_pred, round(sequence_pred, 6) AS sequence_pred,
       round(global_weight * sequence_pred + (1 - global_weight) * additive_pred, 6) AS ensemble_global,
       round(w * sequence_pred + (1 - w) * additive_pred, 6) AS ensemble_day_type
FROM (SELECT f.*, g.global_weight, CASE dow WHEN 5 THEN weight_saturday WHEN 6 THEN weight_sunday
             ELSE weight_weekday END AS w
      FROM forecasts f JOIN global_weight g USING (series_id) JOIN day_weights d USING (series_id)
      WHERE split = 'test') f
""")

# --- segments and risk ---
cte("scaled_rfm", "rfm", """
SELECT *, (lr - avg(lr) OVER ()) / stddev_pop(lr) OVER () AS recency_days_scaled,
       (lf - avg(lf) OVER ()) / stddev_pop(lf) OVER () AS frequency_scaled,
       (lm - avg(lm) OVER ()) / stddev_pop(lm) OVER () AS monetary_scaled
FROM (SELECT customer_id, ln(1 + recency_days) AS lr, ln(1 + frequency) AS lf,
             ln(1 + CAST(monetary AS DOUBLE)) AS lm FROM rfm)
""")
CLUSTER = "CAST(CASE WHEN customer_id % 50 = 0 THEN -1 ELSE customer_id % 6 END AS INTEGER)"
cte("names", "rfm", f"""
SELECT cluster, CASE WHEN same = 1 THEN base ELSE base || '_' || CASE rk WHEN 1 THEN 'premium' WHEN 2 THEN 'core'
       WHEN 3 THEN 'emerging' WHEN 4 THEN 'marginal' ELSE 'tier' || CAST(rk AS VARCHAR) END END AS segment_name
FROM (SELECT *, count(*) OVER (PARTITION BY base) AS same,
             row_number() OVER (PARTITION BY base ORDER BY m DESC, cluster) AS rk
  FROM (SELECT *, CASE
      WHEN r <= mr AND f >= mf AND m >= mm THEN 'champions' WHEN r <= mr AND f >= mf THEN 'loyal_low_spend'
      WHEN r <= mr AND m >= mm THEN 'promising_big_spenders' WHEN r <= mr THEN 'new_or_occasional'
      WHEN f >= mf AND m >= mm THEN 'at_risk_high_value' WHEN f >= mf THEN 'at_risk_low_spend'
      WHEN m >= mm THEN 'hibernating_high_value' ELSE 'lost' END AS base
    FROM (SELECT *, median(r) OVER () AS mr, median(f) OVER () AS mf, median(m) OVER () AS mm
      FROM (SELECT {CLUSTER} AS cluster, avg(recency_days) AS r, avg(frequency) AS f,
                   avg(CAST(monetary AS DOUBLE)) AS m FROM rfm WHERE {CLUSTER} <> -1 GROUP BY 1))))
""")
_scaled = ("recency_days_scaled", "frequency_scaled", "monetary_scaled")
oracle("scaled_rfm", "scaled_rfm", "SELECT customer_id, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in _scaled) + " FROM scaled_rfm")
oracle("label_segments", "rfm names", f"""
SELECT customer_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary, r.cluster,
       CASE WHEN r.cluster = -1 THEN 'noise' ELSE segment_name END AS segment_name
FROM (SELECT *, {CLUSTER} AS cluster FROM rfm) r LEFT JOIN names n ON r.cluster = n.cluster
""")
cte("spread", "scaled_rfm", f"""
SELECT cluster, any_value(a) AS a, any_value(b) AS b, any_value(c) AS c,
       avg(sqrt((recency_days_scaled - a) ** 2 + (frequency_scaled - b) ** 2 + (monetary_scaled - c) ** 2)) AS s
FROM (SELECT *, avg(recency_days_scaled) OVER (PARTITION BY cluster) AS a,
             avg(frequency_scaled) OVER (PARTITION BY cluster) AS b,
             avg(monetary_scaled) OVER (PARTITION BY cluster) AS c
      FROM (SELECT *, {CLUSTER} AS cluster FROM scaled_rfm) WHERE cluster <> -1) GROUP BY 1
""")
oracle("davies_bouldin", "spread", """
SELECT round(avg(worst), 6) AS davies_bouldin FROM (
  SELECT x.cluster, max((x.s + y.s) / sqrt((x.a - y.a) ** 2 + (x.b - y.b) ** 2 + (x.c - y.c) ** 2)) AS worst
  FROM spread x JOIN spread y ON x.cluster <> y.cluster GROUP BY 1)
""")
cte("risk", "features labels", """
SELECT *, ((customer_id * 37 + recency_days) % 1000) / 1000.0::DOUBLE AS churn_probability
FROM features JOIN labels USING (customer_id)
""")
cte("scored", "risk", """
SELECT customer_id, ((customer_id * 37 + recency_days) % 1000) // 10 / 100.0::DOUBLE AS score, churned AS label FROM risk
""")
oracle("segment_profile", "rfm_scores", """
SELECT rfm_segment AS segment_name, count(*) AS customers, round(avg(recency_days), 1) AS recency_days,
       round(avg(frequency), 1) AS frequency, round(avg(CAST(monetary AS DOUBLE)), 1) AS monetary
FROM rfm_scores GROUP BY 1
""")
oracle("risk_by_segment", "rfm_scores risk", """
SELECT rfm_segment AS segment_name, round(avg(churn_probability), 6) AS churn_probability, count(*) AS customers
FROM rfm_scores JOIN risk USING (customer_id) GROUP BY 1
""")
oracle("risk_list", "rfm_scores risk", """
SELECT s.customer_id, rfm_segment AS segment_name, churn_probability, s.recency_days, s.frequency,
       CAST(s.monetary AS DOUBLE) AS monetary
FROM rfm_scores s JOIN risk r ON s.customer_id = r.customer_id
WHERE churn_probability >= 0.5 AND rfm_segment IN ('champions', 'lost', 'regular')
ORDER BY churn_probability DESC, s.customer_id LIMIT 200
""")
oracle("kpis", "daily_all rfm risk", """
SELECT (SELECT CAST(sum(revenue) AS DOUBLE) FROM daily_all) AS total_revenue,
       (SELECT '£' || format('{:,.0f}', CAST(sum(revenue) AS DOUBLE)) FROM daily_all) AS total_revenue_text,
       (SELECT count(*) FROM rfm) AS customers_segmented,
       (SELECT count(*) FROM risk WHERE churn_probability >= 0.5) AS customers_at_risk
""")
oracle("inventory_search", "reco", """
SELECT stock_code, description, tier, round(daily_demand_mean, 4) AS daily_demand_mean,
       round(safety_stock, 4) AS safety_stock, round(r.reorder_point, 4) AS reorder_point, round(eoq, 4) AS eoq,
       stock_code || ' — ' || description AS label
FROM reco r WHERE contains(lower(description), 'ring') OR contains(lower(stock_code), 'ring')
ORDER BY r.reorder_point DESC, stock_code LIMIT 200
""")
oracle("report_top10", "risk reco", """
SELECT 'risk' AS list, CAST(customer_id AS VARCHAR) AS item,
       format('{:,.1f}%', churn_probability * 100) AS value,
       '£' || format('{:,.0f}', CAST(monetary AS DOUBLE)) AS detail
FROM (SELECT * FROM risk ORDER BY churn_probability DESC, customer_id LIMIT 10)
UNION ALL
SELECT 'reorder', stock_code, format('{:,.0f}', reorder_point), substr(description, 1, 30)
FROM (SELECT * FROM reco ORDER BY reorder_point DESC, stock_code LIMIT 10)
""")
cte("ranked", "scored", """
SELECT *, row_number() OVER w AS k, sum(label) OVER w AS hits, count(*) OVER () AS n FROM scored
WINDOW w AS (ORDER BY score DESC, customer_id ROWS UNBOUNDED PRECEDING)
""")
oracle("precision_at_k", "ranked", """
SELECT CAST(0.2 AS DOUBLE) AS k_frac, k, round(hits / k, 6) AS precision FROM ranked
WHERE k = greatest(1, ceil(n * CAST(0.2 AS DOUBLE)))
""")
oracle("precision_curve", "ranked", """
SELECT k_frac, k, round(hits / k, 6) AS precision
FROM ranked JOIN (SELECT i / 20.0::DOUBLE AS k_frac FROM range(1, 21) r(i))
  ON k = greatest(1, ceil(n * k_frac))
""")
cte("score_counts", "scored", """
SELECT score AS threshold, sum(label) AS pos, count(*) - sum(label) AS neg,
       sum(sum(label)) OVER w AS pos_run, sum(count(*) - sum(label)) OVER w AS neg_run,
       sum(sum(label)) OVER () AS pos_all, sum(count(*) - sum(label)) OVER () AS neg_all
FROM scored GROUP BY 1 WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
""")
oracle("roc_curve", "score_counts", """
SELECT threshold, round(neg_run / CAST(neg_all AS DOUBLE), 9) AS fpr, round(pos_run / CAST(pos_all AS DOUBLE), 9) AS tpr
FROM score_counts
""")
oracle("churn_eval", "score_counts scored ranked", """
SELECT (SELECT round(CAST(sum(neg * (2 * pos_run - pos)) AS DOUBLE) / (2.0 * any_value(pos_all) * any_value(neg_all)), 9)
        FROM score_counts) AS auc_roc,
       (SELECT round(hits / k, 9) FROM ranked WHERE k = greatest(1, ceil(n * CAST(0.2 AS DOUBLE)))) AS precision_at_top20pct,
       (SELECT round(sum(label) / count(*), 9) FROM scored WHERE score >= 0.5) AS precision_at_threshold,
       (SELECT round(sum(label) FILTER (WHERE score >= 0.5) / sum(label), 9) FROM scored) AS recall_at_threshold
""")

# --- drift ---
_churn_columns = ["recency_days", "frequency", "monetary", "avg_order_value", "tenure_days",
                  "monetary_per_day", "n_distinct_products"]
_demand_columns = ["revenue", "quantity", "n_invoices", "n_customers"]
cte("churn_values", "features reference_features", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value, {ref} AS ref FROM {t}"
    for c in _churn_columns for t, ref in (("reference_features", 1), ("features", 0))
))
cte("demand_values", "daily_all", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value, "
    f"CAST(date < DATE '2000-08-01' AS INTEGER) AS ref FROM daily_all "
    "WHERE NOT is_partial_day"
    for c in _demand_columns
))


def distances_body(values: str) -> str:
    return f"""
SELECT "column", n_reference, n_current, ks_distance,
       CASE WHEN x2 < 0.04 THEN 1.0 ELSE least(greatest(list_sum([
         CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * j * j * x2) FOR j IN range(1, 101)]), 0), 1)
         END AS ks_p_asymptotic,
       area / greatest(sqrt(greatest(sq / n_reference - (s / n_reference) ** 2, 0)), 0.001) AS wasserstein_normed
FROM (
  SELECT *, ks_distance * ks_distance * n_reference * n_current / (n_reference + n_current) AS x2 FROM (
    SELECT "column", CAST(max(ref_all) AS BIGINT) AS n_reference, CAST(max(cur_all) AS BIGINT) AS n_current,
           max(gap) AS ks_distance, coalesce(sum(gap * (next - value)), 0) AS area, sum(value * r) AS s,
           sum(value * value * r) AS sq
    FROM (SELECT *, abs(ref_run / ref_all - cur_run / cur_all) AS gap FROM (
      SELECT "column", value, r, CAST(sum(r) OVER w AS DOUBLE) AS ref_run, CAST(sum(c) OVER w AS DOUBLE) AS cur_run,
             CAST(sum(r) OVER (PARTITION BY "column") AS DOUBLE) AS ref_all,
             CAST(sum(c) OVER (PARTITION BY "column") AS DOUBLE) AS cur_all, lead(value) OVER o AS next
      FROM (SELECT "column", value, sum(ref) AS r, sum(1 - ref) AS c FROM {values} GROUP BY 1, 2)
      WINDOW w AS (PARTITION BY "column" ORDER BY value ROWS UNBOUNDED PRECEDING),
             o AS (PARTITION BY "column" ORDER BY value)))
    GROUP BY 1))
"""


def summary_body(distances: str, by_test: bool) -> str:
    method, value, drifted = (
        ("K-S p_value", "ks_p_asymptotic", "ks_p_asymptotic < 0.05")
        if by_test
        else ("Wasserstein distance (normed)", "wasserstein_normed", "wasserstein_normed > 0.1")
    )
    return f"""SELECT "column", '{method}' AS method, {value} AS value, {drifted} AS drifted FROM {distances}"""


cte("churn_distances", "churn_values", distances_body("churn_values"))
cte("demand_distances", "demand_values", distances_body("demand_values"))
cte("churn_summary", "churn_distances", summary_body("churn_distances", False))
cte("demand_summary", "demand_distances", summary_body("demand_distances", True))
cte("checked", "churn_summary demand_summary", "\nUNION ALL ".join(
    f"""SELECT '{m}' AS model, count(*) FILTER (WHERE drifted) AS n_drifted,
       avg(CAST(drifted AS INTEGER)) AS drifted_share, avg(CAST(drifted AS INTEGER)) >= 0.5 AS retrain_recommended
FROM {t}""" for m, t in (("churn", "churn_summary"), ("forecast", "demand_summary"))
))
oracle("drift_ks", "demand_distances", """
SELECT "column", n_reference, n_current, round(ks_distance, 6) AS ks_distance, round(ks_p_asymptotic, 6) AS ks_p_asymptotic
FROM demand_distances
""")
oracle("drift_wasserstein", "churn_distances", """
SELECT "column", n_reference, n_current, round(wasserstein_normed, 6) AS wasserstein_normed FROM churn_distances
""")
oracle("drift_churn", "churn_summary", "SELECT * REPLACE (round(value, 6) AS value) FROM churn_summary")
oracle("drift_demand", "demand_summary", "SELECT * REPLACE (round(value, 6) AS value) FROM demand_summary")
oracle("drift_share", "checked", "SELECT * REPLACE (round(drifted_share, 6) AS drifted_share) FROM checked")
oracle("retrain_targets", "checked", "SELECT model FROM checked WHERE retrain_recommended")

oracle("monitoring", "checked", """
SELECT (SELECT round(drifted_share, 6) FROM checked WHERE model = 'churn') AS drifted_share,
       (SELECT retrain_recommended FROM checked WHERE model = 'churn') AS retrain_recommended,
       (SELECT round(drifted_share, 6) FROM checked WHERE model = 'forecast') AS demand_drifted_share,
       (SELECT coalesce(string_agg(model, ',' ORDER BY model), '') FROM checked WHERE retrain_recommended) AS retrain_targets,
       true AS mape_known, true AS churn_without_run
""")

oracle("audit_log", "checked", """
SELECT 'daily_batch' AS dag, 2 AS n_entries,
       (SELECT round(drifted_share, 6) FROM checked WHERE model = 'churn') AS churn_share,
       (SELECT round(drifted_share, 6) FROM checked WHERE model = 'forecast') AS demand_share
""")
oracle("csv_roundtrip", "raw", f"SELECT * EXCLUDE (invoice_date), {WHEN} FROM raw")
oracle("cleaned_tables", "completed customers flagged", f"""
SELECT 'completed_sales' AS "table", count(*) AS n_rows, sum(quantity) AS quantity FROM completed
UNION ALL SELECT 'customer_sales', count(*), sum(quantity) FROM customers
UNION ALL SELECT 'excluded', count(*), sum(quantity) FROM flagged WHERE NOT ({SALE})
""")
oracle("artifact_status", "", "\nUNION ALL ".join(
    [f"SELECT '{t}' AS artifact, true AS ready, count(*) AS n_rows FROM {t}" for t in ("customer", "lineitem", "orders", "events")]
    + ["SELECT 'nothing_here', false, NULL"]
))
oracle("product_labels", "reco", """
SELECT stock_code, concat_ws(' — ', stock_code, description) AS label, stock_code AS code FROM reco
""")

# --- runs ---
cte("runs", "", """
SELECT event_type || '-' || CAST(user_id AS VARCHAR) AS run_id, event_type AS experiment,
       'run_' || CAST(user_id % 7 AS VARCHAR) AS run_name, min(ts) AS start_time, min(value) AS mape,
       max(value) / 500 AS auc, max(value) / 400 AS precision
FROM events GROUP BY event_type, user_id
""")
cte("latest", "runs", """
SELECT * FROM runs
QUALIFY row_number() OVER (PARTITION BY experiment, run_name ORDER BY start_time DESC, run_id DESC) = 1
""")
oracle("latest_run", "latest", "SELECT * EXCLUDE (start_time) FROM latest")
oracle("best_run", "runs", """
SELECT experiment, run_id, run_name, mape AS value FROM runs
QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY mape, run_id) = 1
""")
oracle("constraints", "latest", """
SELECT 'churn' AS model, 'auc' AS metric, auc AS value, 0.88::DOUBLE AS target, auc >= 0.88 AS meets_target
FROM latest WHERE experiment = 'signup' AND run_name = 'run_1'
UNION ALL SELECT 'churn', 'precision', precision, 0.75, precision >= 0.75
FROM latest WHERE experiment = 'signup' AND run_name = 'run_1'
UNION ALL SELECT 'forecast', 'mape', mape, 12.0, mape <= 12.0
FROM latest WHERE experiment = 'purchase' AND run_name = 'run_2'
""")
oracle("model_evolution", "latest", "\nUNION ALL ".join(
    f"SELECT '{stage}' AS stage, '{metric}' AS metric, {metric} AS value FROM latest "
    f"WHERE experiment = '{exp}' AND run_name = '{run}'"
    for stage, exp, run, metric in (
        ("manual sweep", "signup", "run_1", "auc"), ("search", "signup", "run_3", "auc"),
        ("additive", "purchase", "run_2", "mape"), ("sequence", "purchase", "run_4", "mape"),
        ("ensemble", "purchase", "run_5", "mape"),
    )
))

# --- clustering and split ---
oracle("strat_split", "labels", """
SELECT customer_id, churned, k <= ceil(n * CAST(0.2 AS DOUBLE)) AS is_test FROM (
  SELECT *, row_number() OVER (PARTITION BY churned ORDER BY md5(customer_id || '|42'), customer_id) AS k,
         count(*) OVER (PARTITION BY churned) AS n FROM labels)
""")
cte("near", "scaled_rfm", """
SELECT a.customer_id AS a, b.customer_id AS b FROM scaled_rfm a JOIN scaled_rfm b
  ON (a.recency_days_scaled - b.recency_days_scaled) ** 2 + (a.frequency_scaled - b.frequency_scaled) ** 2
   + (a.monetary_scaled - b.monetary_scaled) ** 2 <= CAST(0.3 AS DOUBLE) ** 2
""")
cte("core", "near", "SELECT a AS id FROM near GROUP BY 1 HAVING count(*) >= 10")
cte("core_edges", "near core", """
SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)
""")
cte("reach", "core core_edges", """
SELECT id AS root, id FROM core
UNION SELECT r.root, e.b FROM reach r JOIN core_edges e ON e.a = r.id WHERE r.root < e.b
""")
cte("component", "reach", """
SELECT id, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster
FROM (SELECT id, min(root) AS root FROM reach GROUP BY 1)
""")
oracle("dbscan", "near core component scaled_rfm", """
SELECT p.customer_id, coalesce(min(cluster), -1) AS cluster FROM scaled_rfm p
LEFT JOIN (SELECT n.a, c.cluster FROM near n JOIN component c ON n.b = c.id
           WHERE n.a = n.b OR n.a NOT IN (SELECT id FROM core)) m ON m.a = p.customer_id
GROUP BY 1
""")
SQL["dbscan"] = SQL["dbscan"].replace("WITH ", "WITH RECURSIVE ", 1)


# --- sketches, state, checked input ---
_POINTS = "unnest([0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99])"
oracle("quantile_bounds", "completed", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({_POINTS} AS DOUBLE) AS probability, n, low, high, true AS within
FROM (SELECT count({c}) AS n, round(CAST(min({c}) AS DOUBLE), 6) AS low, round(CAST(max({c}) AS DOUBLE), 6) AS high FROM completed)"""
    for c in ("quantity", "unit_price")
))
oracle("customer_movements", "customers", """
, active AS (SELECT DISTINCT date_trunc('month', invoice_date) AS m, customer_id FROM customers),
months AS (SELECT m, lag(m) OVER (ORDER BY m) AS p FROM (SELECT DISTINCT m FROM active)),
firsts AS (SELECT customer_id, min(m) AS m FROM active GROUP BY 1)
SELECT CAST(CAST(months.m AS DATE) AS VARCHAR) AS month,
       (SELECT count(*) FROM active a WHERE a.m = months.m) AS active,
       (SELECT count(*) FROM firsts f WHERE f.m = months.m) AS first_seen,
       (SELECT count(*) FROM active a JOIN active b USING (customer_id) WHERE a.m = months.m AND b.m = months.p) AS retained,
       (SELECT count(*) FROM active b WHERE b.m = months.p
        AND NOT EXISTS (SELECT 1 FROM active a WHERE a.m = months.m AND a.customer_id = b.customer_id)) AS lost
FROM months
""")
oracle("drift_interval", "churn_distances demand_distances", "\nUNION ALL ".join(
    f"""SELECT '{m}' AS model, "column", n_reference, n_current, round(ks_distance, 6) AS ks_distance, true AS covered FROM {t}"""
    for m, t in (("churn", "churn_distances"), ("forecast", "demand_distances"))
))
oracle("customer_state_rfm", "rfm", """
SELECT customer_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary FROM rfm
""")
oracle("csv_quarantine", "raw", """
SELECT part, count(*) AS n_rows, CAST(CASE WHEN part = 'good' THEN sum(quantity) END AS BIGINT) AS quantity
FROM (SELECT quantity, CASE WHEN quantity % 11 = 0 AND quantity % 13 = 0 THEN 'invoice_date,unit_price'
                            WHEN quantity % 11 = 0 THEN 'unit_price' WHEN quantity % 13 = 0 THEN 'invoice_date'
                            ELSE 'good' END AS part FROM raw)
GROUP BY 1
""")

# --- tests and models ---
oracle("level_stationarity", "daily_country", """
, long AS (
  SELECT series_id, 'quantity' AS "column", date AS ds, CAST(quantity AS DOUBLE) AS y FROM daily_country WHERE NOT is_partial_day
  UNION ALL SELECT series_id, 'revenue', date, CAST(revenue AS DOUBLE) FROM daily_country WHERE NOT is_partial_day
), forms AS (
  SELECT *, 'level' AS form FROM long
  UNION ALL SELECT series_id, "column", ds, d, 'diff1'
  FROM (SELECT *, y - lag(y) OVER (PARTITION BY series_id, "column" ORDER BY ds) AS d FROM long) WHERE d IS NOT NULL
), centred AS (
  SELECT series_id, "column", form, count(*) OVER g AS n, y - avg(y) OVER g AS e,
         row_number() OVER (PARTITION BY series_id, "column", form ORDER BY ds) AS i
  FROM forms WINDOW g AS (PARTITION BY series_id, "column", form)
), acov AS (
  SELECT a.series_id, a."column", a.form, a.n, a.i - b.i AS k, sum(a.e * b.e) / a.n AS c
  FROM centred a JOIN centred b ON a.series_id = b.series_id AND a."column" = b."column" AND a.form = b.form
       AND b.i BETWEEN a.i - 10 AND a.i
  GROUP BY 1, 2, 3, 4, 5
), pilot AS (
  SELECT series_id, "column", form, n, 2 * sum(c) - max(c) FILTER (WHERE k = 0) AS s0, 2 * sum(k * c) AS s1
  FROM acov WHERE k <= floor(pow(n, 2.0 / 9)) GROUP BY 1, 2, 3, 4
), widths AS (
  SELECT *, CAST(least(floor(1.1447 * pow(pow(s1 / s0, 2), 1.0 / 3) * pow(n, 1.0 / 3)), n - 1) AS INTEGER) AS lags FROM pilot
), spread AS (
  SELECT w.series_id, w."column", w.form, w.n, lags,
         sum(CASE WHEN a.i = b.i THEN 1 ELSE 2 * (1 - (a.i - b.i) / (lags + 1.0)) END * a.e * b.e) / w.n AS long_run
  FROM widths w JOIN centred a ON w.series_id = a.series_id AND w."column" = a."column" AND w.form = a.form
  JOIN centred b ON a.series_id = b.series_id AND a."column" = b."column" AND a.form = b.form AND b.i <= a.i AND a.i - b.i <= lags
  GROUP BY 1, 2, 3, 4, 5
), partial AS (
  SELECT series_id, "column", form, sum(s * s) AS squares FROM (
    SELECT *, sum(e) OVER (PARTITION BY series_id, "column", form ORDER BY i) AS s FROM centred) GROUP BY 1, 2, 3
), tested AS (
  SELECT s.*, squares / (CAST(n AS DOUBLE) * n * long_run) AS eta FROM spread s JOIN partial p
    ON s.series_id = p.series_id AND s."column" = p."column" AND s.form = p.form
)
SELECT series_id, "column", form, n AS n_observations, round(eta, 6) AS kpss_statistic, lags AS kpss_n_lags,
       round(CASE WHEN eta <= 0.347 THEN 0.10 WHEN eta < 0.463 THEN 0.10 - (eta - 0.347) * 0.05 / 0.116
                  WHEN eta < 0.574 THEN 0.05 - (eta - 0.463) * 0.025 / 0.111
                  WHEN eta < 0.739 THEN 0.025 - (eta - 0.574) * 0.015 / 0.165 ELSE 0.01 END, 6) AS kpss_p_value
FROM tested
""")


def _robust_rounds(rounds: int) -> str:
    parts = []
    weighted = "sum(weight * (observed - trend)) / nullif(sum(weight) FILTER (WHERE trend IS NOT NULL), 0)"
    for j in range(rounds + 1):
        before = f"s{j}" if j else "s0"
        parts.append(f"""t{j} AS (
  SELECT *, CASE WHEN count(*) OVER w = 7 THEN sum(weight * (observed - seasonal)) OVER w / nullif(sum(weight) OVER w, 0) END AS trend
  FROM {before} WINDOW w AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)
), m{j} AS (
  SELECT series_id, season, coalesce(m - avg(m) OVER (PARTITION BY series_id), 0) AS seasonal FROM (
    SELECT series_id, season, {weighted if j else "median(observed - trend)"} AS m
    FROM t{j} GROUP BY 1, 2)
), p{j} AS (
  SELECT t.series_id, t.ds, t.observed, t.season, t.weight, t.trend, m.seasonal, t.observed - t.trend - m.seasonal AS resid
  FROM t{j} t JOIN m{j} m ON t.series_id = m.series_id AND t.season = m.season
), s{j + 1} AS (
  SELECT series_id, ds, observed, season, seasonal, CASE WHEN resid IS NULL THEN weight WHEN share < 1 THEN pow(1 - share * share, 2) ELSE 0 END AS weight
  FROM (SELECT *, coalesce(abs(resid) / nullif(6 * median(abs(resid)) OVER (PARTITION BY series_id), 0), 0) AS share FROM p{j})
)""")
    return ",\n".join(parts)


oracle("decompose_robust", "demand", f"""
, s0 AS (SELECT series_id, ds, y AS observed, date_diff('day', DATE '1970-01-05', ds) % 7 AS season, 0.0::DOUBLE AS seasonal, 1.0::DOUBLE AS weight FROM demand),
{_robust_rounds(4)}
SELECT series_id, CAST(ds AS VARCHAR) AS ds, observed, round(trend, 5) AS trend, round(seasonal, 5) AS seasonal,
       round(resid, 5) AS resid, round(weight, 5) AS weight FROM p4
""")
oracle("nearest_centers", "scaled_rfm", """
, means AS (SELECT customer_id % 5 AS g, avg(recency_days_scaled) AS r, avg(frequency_scaled) AS f, avg(monetary_scaled) AS m
            FROM scaled_rfm GROUP BY 1),
squared AS (SELECT customer_id, g, (recency_days_scaled - r) ** 2 + (frequency_scaled - f) ** 2 + (monetary_scaled - m) ** 2 AS d
            FROM scaled_rfm, means),
nearest AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY d, g) AS k FROM squared)
SELECT CAST(g AS INTEGER) AS cluster, count(*) AS n_rows, round(sum(d), 4) AS inertia FROM nearest WHERE k = 1 GROUP BY 1
""")
