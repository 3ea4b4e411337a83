"""SQL that rebuilds every query of ``retail_queries.py`` on the same tables.

Written from the definitions, not from the Spark code: keep-first is a
``row_number``, modes are ranked counts, percentages are exact integer
arithmetic rounded half up.
"""

from __future__ import annotations


def pct(part: str, whole: str, digits: int = 2) -> str:
    """Percentage rounded half up, by integers."""
    scale = 10**digits
    return (
        f"CAST(((({part}) * {200 * scale} + ({whole})) // (2 * ({whole}))) AS DOUBLE)"
        f" / {scale}.0::DOUBLE"
    )


def ratio_half_up(cents: str, rows: str) -> str:
    """Non-negative cents / rows, rounded half up to cents."""
    return f"CAST(((2 * ({cents}) + ({rows})) // (2 * ({rows}))) AS DOUBLE) / 100.0::DOUBLE"


CTES = {
    "raw": """
  SELECT l_orderkey AS src_order, l_linenumber AS src_line, l_partkey AS src_part,
         l_suppkey AS src_supp,
         CASE WHEN l_returnflag = 'R' AND l_orderkey % 7 = 0 THEN 'C' ELSE '' END
           || CAST(l_orderkey AS VARCHAR) AS invoice,
         CASE WHEN l_partkey % 211 = 0 THEN NULL
              WHEN l_partkey % 97 = 0 THEN 'P' || CAST(l_partkey % 10 AS VARCHAR)
              ELSE 'P' || printf('%06d', l_partkey) END AS stock_code,
         CASE WHEN l_partkey % 53 = 0 THEN NULL
              WHEN l_partkey % 59 = 0 THEN ''
              WHEN (l_orderkey + l_linenumber) % 2 = 0 THEN upper(p_name)
              ELSE p_name END AS description,
         CAST(l_quantity AS INTEGER)
           * CASE WHEN l_linenumber = 7 AND l_orderkey % 23 = 0 THEN 100 ELSE 1 END
           * CASE WHEN l_returnflag = 'R' AND l_orderkey % 7 = 1 THEN -1 ELSE 1 END AS quantity,
         CASE WHEN l_orderkey % 401 = 0 THEN NULL
              ELSE o_orderdate + (l_linenumber % 3) * INTERVAL '1' HOUR END AS invoice_date,
         CASE WHEN (l_partkey + l_orderkey) % 89 = 0 THEN CAST(0 AS DECIMAL(10,2))
              ELSE CAST(p_retailprice AS DECIMAL(10,2)) END AS price,
         CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS customer_id,
         CASE WHEN o_custkey % 499 = 0 THEN NULL ELSE n_name END AS country
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey""",
    "kept": """
  SELECT * FROM raw
  WHERE customer_id IS NOT NULL AND stock_code IS NOT NULL AND invoice_date IS NOT NULL""",
    "clean": """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY invoice, stock_code, invoice_date
      ORDER BY src_order, src_line, src_part, src_supp, description NULLS FIRST, quantity,
               price, customer_id, country NULLS FIRST) AS rn
    FROM kept) WHERE rn = 1""",
    "dim_time": """
  SELECT row_number() OVER (ORDER BY d) AS time_key, d AS date_value,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS day_of_week,
         dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
  FROM (SELECT DISTINCT CAST(invoice_date AS DATE) AS d FROM clean)""",
    "dim_country": """
  SELECT row_number() OVER (ORDER BY country) AS country_key, country AS country_name
  FROM (SELECT DISTINCT country FROM clean WHERE country IS NOT NULL)""",
    "dim_product": """
  SELECT row_number() OVER (ORDER BY stock_code) AS product_key, stock_code, description
  FROM (
    SELECT stock_code, description, row_number() OVER (
             PARTITION BY stock_code
             ORDER BY description IS NULL, uses DESC, description) AS rn
    FROM (SELECT stock_code, description, count(*) AS uses FROM clean
          GROUP BY stock_code, description))
  WHERE rn = 1""",
    "dim_customer": """
  SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id, country_key
  FROM (
    SELECT customer_id, country, row_number() OVER (
             PARTITION BY customer_id
             ORDER BY invoice_date, invoice, stock_code, description NULLS FIRST, quantity,
                      price, country NULLS FIRST) AS rn
    FROM clean)
  LEFT JOIN dim_country ON country = country_name
  WHERE rn = 1""",
    "day_first": """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY invoice, stock_code, CAST(invoice_date AS DATE)
      ORDER BY invoice_date, description NULLS FIRST, quantity, price, customer_id,
               country NULLS FIRST) AS rn
    FROM clean) WHERE rn = 1""",
    "fact": """
  SELECT invoice AS invoice_no, product_key, customer_key, time_key, f.country_key, quantity,
         price AS unit_price, CAST(quantity * price AS DECIMAL(15,2)) AS total_amount,
         (starts_with(invoice, 'C') OR quantity < 0) AS is_return
  FROM (SELECT d.*, c.country_key FROM day_first d
        LEFT JOIN dim_country c ON d.country = c.country_name) f
  JOIN dim_product p ON f.stock_code = p.stock_code
  JOIN dim_customer u ON f.customer_id = u.customer_id
  JOIN dim_time t ON CAST(f.invoice_date AS DATE) = t.date_value""",
    "daily": """
  SELECT t.date_value, t.year, t.month, t.day_name, t.is_weekend,
         count(*) AS total_transactions, count(DISTINCT f.customer_key) AS unique_customers,
         count(*) FILTER (is_return) AS return_transactions,
         coalesce(sum(total_amount) FILTER (NOT is_return), 0) AS daily_sales,
         coalesce(sum(total_amount) FILTER (is_return), 0) AS daily_returns,
         coalesce(sum(abs(total_amount)) FILTER (is_return), 0) AS return_amount
  FROM fact f JOIN dim_time t USING (time_key)
  GROUP BY ALL""",
    "fences": """
  SELECT q25, q75, q75 - q25 AS iqr, q25 - 1.5 * (q75 - q25) AS lower_bound,
         q75 + 1.5 * (q75 - q25) AS upper_bound, mean_sales, std_sales
  FROM (SELECT quantile_cont(s, 0.25) AS q25, quantile_cont(s, 0.75) AS q75,
               avg(s) AS mean_sales, stddev_samp(s) AS std_sales
        FROM (SELECT CAST(daily_sales AS DOUBLE) AS s FROM daily))""",
    "sales_range": """
  SELECT date_value, year, month, day_name, is_weekend, daily_sales, total_transactions,
         unique_customers, daily_returns, return_transactions,
         (s < lower_bound OR s > upper_bound) AS is_outlier,
         CASE WHEN s < lower_bound THEN 'Low' WHEN s > upper_bound THEN 'High'
              ELSE 'Normal' END AS outlier_type,
         CAST(CASE WHEN s < lower_bound OR s > upper_bound THEN 85 ELSE 100 END AS INTEGER)
           AS quality_score,
         mean_sales, std_sales, (s - mean_sales) / std_sales AS z_score
  FROM (SELECT *, CAST(daily_sales AS DOUBLE) AS s FROM daily), fences""",
    "missing": f"""
  SELECT date_value, CAST(year(date_value) AS INTEGER) AS year,
         CAST(month(date_value) AS INTEGER) AS month, total_transactions,
         transactions_with_customer, missing_customers, rate AS missing_customer_rate,
         CASE WHEN rate <= 5 THEN 'Good' WHEN rate <= 10 THEN 'Warning' ELSE 'Critical' END
           AS quality_status,
         CASE WHEN rate <= 5 THEN 100.0::DOUBLE
              ELSE greatest(50.0::DOUBLE, 100 - (rate - 5.0::DOUBLE) * 10) END AS quality_score
  FROM (SELECT *, {pct("missing_customers", "total_transactions")} AS rate FROM (
    SELECT CAST(invoice_date AS DATE) AS date_value, count(*) AS total_transactions,
           count(customer_id) AS transactions_with_customer,
           count(*) - count(customer_id) AS missing_customers
    FROM raw WHERE invoice_date IS NOT NULL GROUP BY 1))""",
    "return_rates": f"""
  SELECT date_value, year, month, total_transactions, return_transactions, return_rate,
         sales_amount, return_amount, (return_rate - centre) / spread AS return_rate_z_score,
         coalesce(abs((return_rate - centre) / spread) > 2, false) AS is_return_anomaly,
         CASE WHEN return_rate < centre - spread THEN 'Low'
              WHEN return_rate > centre + spread THEN 'High' ELSE 'Normal' END AS return_status
  FROM (SELECT *, avg(return_rate) OVER () AS centre, stddev_samp(return_rate) OVER () AS spread
        FROM (SELECT date_value, year, month, total_transactions, return_transactions,
                     {pct("return_transactions", "total_transactions")} AS return_rate,
                     daily_sales AS sales_amount, return_amount
              FROM daily))""",
    "products": """
  SELECT stock_code, description, transaction_count, total_revenue, missing_description,
         invalid_stock_code, missing_description + invalid_stock_code AS quality_issues,
         CAST(CASE missing_description + invalid_stock_code WHEN 0 THEN 100 WHEN 1 THEN 75
              ELSE 50 END AS INTEGER) AS quality_score
  FROM (
    SELECT p.stock_code, p.description, count(f.product_key) AS transaction_count,
           sum(f.total_amount) AS total_revenue,
           CAST(p.description IS NULL OR p.description = '' AS INTEGER) AS missing_description,
           CAST(length(p.stock_code) < 3 AS INTEGER) AS invalid_stock_code
    FROM dim_product p LEFT JOIN fact f ON p.product_key = f.product_key
    GROUP BY p.stock_code, p.description)""",
    "anomalies": """
  SELECT date_value AS "Date", 'Sales Outlier' AS "Issue_Type",
         CASE outlier_type WHEN 'Low' THEN 'Medium' ELSE 'High' END AS "Severity",
         CAST(daily_sales AS DOUBLE) AS "Value",
         outlier_type || ' sales day: $' || format('{:,.2f}', CAST(daily_sales AS DOUBLE))
           AS "Description"
  FROM sales_range WHERE is_outlier
  UNION ALL
  SELECT date_value, 'Return Rate Anomaly', 'Medium', return_rate,
         'Unusual return rate: ' || CAST(return_rate AS VARCHAR) || '%'
  FROM return_rates WHERE is_return_anomaly""",
    "cleaning": f"""
  SELECT i - k AS null_drops, bad_price AS invalid_price_count,
         high_quantity AS high_quantity_count, returned AS return_count,
         k - n AS duplicates_removed, i AS initial_rows, n AS final_rows, i - n AS rows_dropped,
         {pct("i - n", "i")} AS drop_rate
  FROM (SELECT (SELECT count(*) FROM raw) AS i, (SELECT count(*) FROM kept) AS k,
               (SELECT count(*) FROM clean) AS n,
               (SELECT count(*) FROM kept WHERE price <= 0 OR price IS NULL) AS bad_price,
               (SELECT count(*) FROM kept WHERE quantity > 1000) AS high_quantity,
               (SELECT count(*) FROM kept WHERE starts_with(invoice, 'C') OR quantity < 0)
                 AS returned)""",
    "orphan_row": """
  SELECT
    (SELECT count(*) FROM fact f WHERE NOT EXISTS
       (SELECT 1 FROM dim_product d WHERE d.product_key = f.product_key)) AS orphaned_products,
    (SELECT count(*) FROM fact f WHERE NOT EXISTS
       (SELECT 1 FROM dim_customer d WHERE d.customer_key = f.customer_key)) AS orphaned_customers,
    (SELECT count(*) FROM fact f WHERE NOT EXISTS
       (SELECT 1 FROM dim_time d WHERE d.time_key = f.time_key)) AS orphaned_times,
    (SELECT count(*) FROM fact f WHERE NOT EXISTS
       (SELECT 1 FROM dim_country d WHERE d.country_key = f.country_key)) AS orphaned_countries""",
    "rules_row": """
  SELECT count(*) FILTER (abs(total_amount - quantity * unit_price) > 0.01) AS calculation_errors,
         count(*) FILTER (quantity < 0 AND NOT is_return) AS negative_quantities_non_returns,
         count(*) FILTER (unit_price <= 0) AS zero_unit_price,
         count(*) FILTER (abs(quantity) > 10000) AS extreme_quantities,
         count(*) FILTER (date_value > DATE '2002-01-01') AS future_dates,
         coalesce(CAST(sum(total_amount) FILTER (NOT is_return) AS DOUBLE), 0)
           AS total_sales_amount,
         coalesce(CAST(sum(abs(total_amount)) FILTER (is_return) AS DOUBLE), 0)
           AS total_returns_amount
  FROM fact LEFT JOIN dim_time USING (time_key)""",
    "gate": """
  SELECT integrity_issues, business_issues,
         CASE WHEN integrity_issues > 0 OR business_issues > 0 THEN 'FAIL' ELSE 'PASS' END
           AS overall_status
  FROM (SELECT orphaned_products + orphaned_customers + orphaned_times + orphaned_countries
                 AS integrity_issues,
               calculation_errors + negative_quantities_non_returns + future_dates
                 AS business_issues
        FROM orphan_row, rules_row)""",
    "summary": f"""
  SELECT total_transactions, total_revenue, total_returns, return_rate,
         (SELECT count(*) FROM dim_customer) AS unique_customers,
         (SELECT count(*) FROM dim_product) AS unique_products,
         (SELECT count(*) FROM dim_country) AS unique_countries,
         (SELECT CAST(min(date_value) AS VARCHAR) FROM dim_time) AS date_range_start,
         (SELECT CAST(max(date_value) AS VARCHAR) FROM dim_time) AS date_range_end
  FROM (SELECT count(*) AS total_transactions,
               CAST(sum(total_amount) FILTER (NOT is_return) AS DOUBLE) AS total_revenue,
               CAST(sum(abs(total_amount)) FILTER (is_return) AS DOUBLE) AS total_returns,
               {pct("count(*) FILTER (is_return)", "count(*)")} AS return_rate
        FROM fact)""",
    "country_revenue": """
  SELECT country_name, CAST(sum(total_amount) AS DOUBLE) AS revenue
  FROM fact JOIN dim_country USING (country_key)
  WHERE NOT is_return GROUP BY country_name""",
    "c1": """
  SELECT total_rows, null_customer_id, null_stock_code, null_invoice_date,
         CAST(null_customer_id + null_stock_code + null_invoice_date AS DOUBLE)
           / CAST(total_rows * 3 AS DOUBLE) <= 0.05 AS passed
  FROM (SELECT count(*) AS total_rows,
               count(*) - count(customer_id) AS null_customer_id,
               count(*) - count(stock_code) AS null_stock_code,
               count(*) - count(invoice_date) AS null_invoice_date FROM raw)""",
    "unique_rows": "SELECT DISTINCT invoice, stock_code, invoice_date FROM raw",
    "c2": """
  SELECT total_records, unique_combinations,
         CAST(total_records - unique_combinations AS DOUBLE) / total_records <= 0.01 AS passed
  FROM (SELECT (SELECT count(*) FROM raw) AS total_records,
               (SELECT count(*) FROM unique_rows) AS unique_combinations)""",
    "c3": """
  SELECT total_rows, invalid_price, suspicious_quantity, zero_quantity,
         CAST(invalid_price + suspicious_quantity AS DOUBLE) / total_rows <= 0.1 AS passed
  FROM (SELECT count(*) AS total_rows, count(*) FILTER (price <= 0) AS invalid_price,
               count(*) FILTER (quantity > 1000) AS suspicious_quantity,
               count(*) FILTER (quantity = 0) AS zero_quantity FROM raw)""",
    "c4": """
  SELECT orphaned_products, orphaned_customers, orphaned_times,
         orphaned_products = 0 AND orphaned_customers = 0 AND orphaned_times = 0 AS passed
  FROM orphan_row""",
    "c5": """
  SELECT total_sales, calculation_errors, avg_transaction_value, negative_non_returns,
         calculation_errors = 0 AND negative_non_returns = 0 AS passed
  FROM (SELECT count(*) AS total_sales,
               count(*) FILTER (abs(total_amount - quantity * unit_price) > 0.01)
                 AS calculation_errors,
               CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_transaction_value,
               count(*) FILTER (total_amount < 0 AND NOT is_return) AS negative_non_returns
        FROM fact)""",
    "c6": """
  SELECT last_loaded, hours_since_last_load, hours_since_last_load <= 48 AS passed
  FROM (SELECT max(invoice_date) AS last_loaded,
               floor(epoch(TIMESTAMP '2001-08-03 00:00:00' - max(invoice_date))) / 3600.0::DOUBLE
                 AS hours_since_last_load FROM raw)""",
    "c7": """
  SELECT raw_count, fact_count, customer_count, product_count,
         CAST(fact_count AS DOUBLE) / raw_count >= 0.95 AS passed
  FROM (SELECT (SELECT count(*) FROM raw) AS raw_count,
               (SELECT count(*) FROM fact) AS fact_count,
               (SELECT count(*) FROM dim_customer) AS customer_count,
               (SELECT count(*) FROM dim_product) AS product_count)""",
    "checks": """
  SELECT 'raw_data_checks' AS category, 'null_critical_fields' AS check_name,
         'Check for nulls in critical fields' AS description, passed, true AS critical,
         CAST(0.05 AS DOUBLE) AS threshold FROM c1
  UNION ALL SELECT 'raw_data_checks', 'duplicate_records', 'Check for duplicate records',
         passed, false, 0.01 FROM c2
  UNION ALL SELECT 'raw_data_checks', 'data_range_validation', 'Validate data ranges',
         passed, false, 0.1 FROM c3
  UNION ALL SELECT 'warehouse_checks', 'referential_integrity', 'Check referential integrity',
         passed, true, 0 FROM c4
  UNION ALL SELECT 'warehouse_checks', 'business_logic', 'Validate business calculations',
         passed, true, 0 FROM c5
  UNION ALL SELECT 'performance_checks', 'data_freshness', 'Check data freshness',
         passed, false, 48 FROM c6
  UNION ALL SELECT 'performance_checks', 'row_count_validation',
         'Validate expected row counts', passed, true, 0.95 FROM c7""",
    "check_totals": """
  SELECT total_checks, passed_checks, total_checks - passed_checks AS failed_checks,
         critical_failures,
         CASE WHEN critical_failures > 0 THEN 'CRITICAL_FAILURE'
              WHEN passed_checks < total_checks THEN 'WARNING' ELSE 'PASS' END AS overall_status
  FROM (SELECT count(*) AS total_checks, count(*) FILTER (passed) AS passed_checks,
               count(*) FILTER (NOT passed AND critical) AS critical_failures FROM checks)""",
    "metrics": f"""
  SELECT (SELECT count(*) FROM raw) AS raw_data_count,
         (SELECT count(DISTINCT customer_id) FROM raw) AS unique_customers_raw,
         count(*) AS fact_sales_count, count(*) FILTER (is_return) AS return_transactions,
         {ratio_half_up("CAST(100 * sum(total_amount) FILTER (NOT is_return) AS HUGEINT)",
                        "count(*) FILTER (NOT is_return)")} AS avg_transaction_value,
         CAST(sum(total_amount) FILTER (NOT is_return) AS DOUBLE) AS total_revenue,
         (SELECT count(*) FROM dim_customer) AS dim_customers_count,
         (SELECT count(*) FROM dim_product) AS dim_products_count,
         (SELECT count(*) FROM dim_country) AS dim_countries_count
  FROM fact""",
    "months": f"""
  SELECT year, month, CAST(sum(daily_sales) AS DOUBLE) AS "Total_Sales",
         {ratio_half_up("CAST(100 * sum(daily_sales) AS HUGEINT)", "count(*)")}
           AS "Avg_Daily_Sales",
         count(*) AS "Days_Count",
         {ratio_half_up("CAST(100 * sum(quality_score) AS HUGEINT)", "count(*)")}
           AS "Avg_Quality_Score",
         CAST(sum(total_transactions) AS BIGINT) AS "Total_Transactions"
  FROM sales_range GROUP BY year, month""",
}

LINE = "src_order, src_line, src_part, src_supp"
STAGED = (
    "invoice, stock_code, description, quantity, CAST(invoice_date AS VARCHAR) AS invoice_date,"
    " CAST(price AS DOUBLE) AS price, customer_id, country"
)
CANONICAL = (
    'invoice AS "InvoiceNo", stock_code AS "StockCode", description AS "Description",'
    ' quantity AS "Quantity", CAST(invoice_date AS VARCHAR) AS "InvoiceDate",'
    ' CAST(price AS DOUBLE) AS "UnitPrice", customer_id AS "CustomerID", country AS "Country"'
)
LANDED = (
    CANONICAL.replace("InvoiceNo", "Invoice")
    .replace("UnitPrice", "Price")
    .replace("CustomerID", "Customer ID")
)
FACT = (
    "invoice_no, product_key, customer_key, time_key, country_key, quantity,"
    " CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_amount AS DOUBLE) AS total_amount,"
    " is_return"
)
SALES_SHEET = (
    "CAST(date_value AS VARCHAR) AS date_value, CAST(daily_sales AS DOUBLE) AS daily_sales,"
    " total_transactions, unique_customers, is_outlier, outlier_type, quality_score,"
    " round(z_score, 6) AS z_score"
)


def _orphan(name: str) -> str:
    return f"SELECT {name} FROM orphan_row"


def _check(cte: str, name: str, measures: str, critical: str, threshold: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, {measures}, passed, {critical} AS critical,"
        f" CAST({threshold} AS DOUBLE) AS threshold FROM {cte}"
    )


FRESH = """SELECT last_loaded, floor(epoch(TIMESTAMP '2024-02-01 00:00:00' - last_loaded))
  / 3600.0::DOUBLE AS hours FROM (SELECT max(ts) AS last_loaded FROM events)"""

def _measures(cte: str, name: str, *columns: str) -> str:
    told = " || ', ' || ".join(f"'{c}=' || CAST({c} AS VARCHAR)" for c in sorted(columns))
    return f"SELECT '{name}' AS check_name, {told} AS results FROM {cte}"


MEASURES = " UNION ALL ".join(
    [
        _measures("c1", "null_critical_fields", "total_rows", "null_customer_id", "null_stock_code", "null_invoice_date"),
        _measures("c2", "duplicate_records", "total_records", "unique_combinations"),
        _measures("c3", "data_range_validation", "total_rows", "invalid_price", "suspicious_quantity", "zero_quantity"),
        _measures("c4", "referential_integrity", "orphaned_products", "orphaned_customers", "orphaned_times"),
        _measures("c5", "business_logic", "total_sales", "calculation_errors", "avg_transaction_value", "negative_non_returns"),
        _measures("c6", "data_freshness", "last_loaded", "hours_since_last_load"),
        _measures("c7", "row_count_validation", "raw_count", "fact_count", "customer_count", "product_count"),
    ]
)

BODIES = {
    # scans, sources, sinks, contracts
    "scan_raw": f"SELECT {LANDED}, {LINE} FROM raw",
    "scan_raw_csv": f"SELECT {LANDED}, {LINE} FROM raw",
    "canonical_columns": f"SELECT {CANONICAL}, {LINE} FROM raw",
    "stage_projection": f"SELECT {STAGED} FROM raw",
    "stage_roundtrip": f"SELECT {STAGED} FROM clean",
    "staging_valid_rows": f"SELECT {STAGED} FROM kept",
    "dim_roundtrip": "SELECT product_key, stock_code, description FROM dim_product",
    "fact_roundtrip": f"SELECT {FACT} FROM fact",
    "scan_raw_reordered": f"SELECT {LANDED}, {LINE} FROM raw",
    "dim_append": """SELECT count(*) AS row_count, count(*) AS distinct_keys, count(*) AS distinct_products,
  count(*)::BIGINT AS last_key, count(*) FILTER (product_key % 2 = 1) AS rows_loaded FROM dim_product""",
    "fact_append": """SELECT count(*) AS row_count, count(*) AS distinct_ids,
  count(*) FILTER (product_key % 2 = 1) AS rows_loaded FROM fact""",
    "retention_rows": """SELECT invoice_date IS NULL AS no_stamp, stock_code, count(*) AS row_count,
  sum(quantity)::BIGINT AS quantity FROM raw
WHERE NOT coalesce(invoice_date < TIMESTAMP '2002-01-01' - INTERVAL 365 DAY, false) GROUP BY 1, 2""",
    "fact_month_refresh": """SELECT year, month, count(*) AS row_count, count(*) AS distinct_ids,
  sum(quantity)::BIGINT AS quantity FROM fact JOIN dim_time USING (time_key)
WHERE year <> 1998 OR product_key % 2 = 0 GROUP BY year, month""",
    "load_quarantine": """SELECT CASE WHEN own = '' AND n > 1 THEN 'invoice_no, product_key, time_key repeats'
         ELSE own END AS reasons, count(*) AS row_count, sum(quantity)::BIGINT AS quantity
FROM (SELECT *, row_number() OVER (PARTITION BY own = '', invoice_no, product, time_key) AS n FROM (
  SELECT *, concat_ws('; ', CASE WHEN product_key % 97 = 0 THEN 'unit_price is null' END,
                      CASE WHEN length(invoice_no) > 20 THEN 'invoice_no is longer than 20' END,
                      CASE WHEN product_key % 83 = 0 THEN 'product_key is not in dim_product' END) AS own
  FROM (SELECT CASE WHEN customer_key % 89 = 0 THEN 'invoice with number ' || invoice_no
                    ELSE invoice_no END AS invoice_no,
               product_key, CASE WHEN product_key % 83 = 0 THEN product_key + 1000000 ELSE product_key END AS product,
               time_key, quantity
        FROM fact, (SELECT unnest([1, 2]) AS turn)
        WHERE turn = 1 OR (CASE WHEN product_key % 83 = 0 THEN product_key + 1000000 ELSE product_key END) % 50 = 0)))
GROUP BY 1""",
    "staging_retention": """SELECT count(*) FILTER (expired) AS rows_deleted,
  count(*) FILTER (NOT expired) AS rows_kept
FROM (SELECT coalesce(invoice_date < TIMESTAMP '2002-01-01' - INTERVAL 365 DAY, false) AS expired
      FROM raw)""",
    "table_row_counts": """SELECT 'fact_sales' AS table_name, count(*) AS row_count FROM fact
UNION ALL SELECT 'dim_customer', count(*) FROM dim_customer
UNION ALL SELECT 'dim_product', count(*) FROM dim_product""",
    "report_manifest": """SELECT 'Daily_Quality_Metrics' AS sheet, count(*) AS rows FROM daily
UNION ALL SELECT 'Customer_Data_Quality', count(*) FROM daily
UNION ALL SELECT 'Return_Rate_Analysis', count(*) FROM daily
UNION ALL SELECT 'Product_Quality', count(*) FROM dim_product
UNION ALL SELECT 'Overall_Summary', 1
UNION ALL SELECT 'Anomaly_Details', count(*) FROM anomalies
UNION ALL SELECT 'Monthly_Trends', count(*) FROM months""",
    "utc8_stamp": """SELECT event_id,
  CAST(date_trunc('second', ts) + INTERVAL 8 HOUR AS VARCHAR) AS stamp FROM events""",
    "assert_not_null": """SELECT 'dim_time' AS table_name, 'date_value' AS column_name,
  count(*) - count(date_value) AS null_count FROM dim_time
UNION ALL SELECT 'dim_country', 'country_name', count(*) - count(country_name) FROM dim_country
UNION ALL SELECT 'dim_product', 'stock_code', count(*) - count(stock_code) FROM dim_product
UNION ALL SELECT 'dim_customer', 'customer_id', count(*) - count(customer_id) FROM dim_customer
UNION ALL SELECT 'fact_sales', 'invoice_no', count(*) - count(invoice_no) FROM fact
UNION ALL SELECT 'fact_sales', 'quantity', count(*) - count(quantity) FROM fact
UNION ALL SELECT 'fact_sales', 'unit_price', count(*) - count(unit_price) FROM fact
UNION ALL SELECT 'fact_sales', 'total_amount', count(*) - count(total_amount) FROM fact""",
    "assert_unique": """SELECT table_name, key_columns, count(*) FILTER (n > 1) AS repeated_keys,
  CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows
FROM (
  SELECT 'dim_time' AS table_name, 'date_value' AS key_columns, count(*) AS n
    FROM dim_time GROUP BY date_value
  UNION ALL SELECT 'dim_country', 'country_name', count(*) FROM dim_country GROUP BY country_name
  UNION ALL SELECT 'dim_product', 'stock_code', count(*) FROM dim_product GROUP BY stock_code
  UNION ALL SELECT 'dim_customer', 'customer_id', count(*) FROM dim_customer GROUP BY customer_id
  UNION ALL SELECT 'fact_sales', 'invoice_no, product_key, time_key', count(*)
    FROM fact GROUP BY invoice_no, product_key, time_key)
GROUP BY table_name, key_columns""",
    "assert_foreign_keys": """SELECT 'dim_customer' AS table_name, 'country_key' AS column_name,
  'dim_country' AS references_table, count(*) AS violations FROM dim_customer
  WHERE country_key NOT IN (SELECT country_key FROM dim_country)
UNION ALL SELECT 'fact_sales', 'product_key', 'dim_product', count(*) FROM fact
  WHERE product_key NOT IN (SELECT product_key FROM dim_product)
UNION ALL SELECT 'fact_sales', 'customer_key', 'dim_customer', count(*) FROM fact
  WHERE customer_key NOT IN (SELECT customer_key FROM dim_customer)
UNION ALL SELECT 'fact_sales', 'time_key', 'dim_time', count(*) FROM fact
  WHERE time_key NOT IN (SELECT time_key FROM dim_time)
UNION ALL SELECT 'fact_sales', 'country_key', 'dim_country', count(*) FROM fact
  WHERE country_key NOT IN (SELECT country_key FROM dim_country)""",
    "assert_widths": """SELECT 'raw_retail_data' AS table_name, 'invoice' AS column_name,
  count(*) FILTER (length(invoice) > 20) AS too_long FROM raw
UNION ALL SELECT 'raw_retail_data', 'stock_code', count(*) FILTER (length(stock_code) > 20) FROM raw
UNION ALL SELECT 'raw_retail_data', 'country', count(*) FILTER (length(country) > 50) FROM raw
UNION ALL SELECT 'dim_time', 'month_name', count(*) FILTER (length(month_name) > 20) FROM dim_time
UNION ALL SELECT 'dim_time', 'day_name', count(*) FILTER (length(day_name) > 20) FROM dim_time
UNION ALL SELECT 'dim_country', 'country_name', count(*) FILTER (length(country_name) > 50)
  FROM dim_country
UNION ALL SELECT 'dim_product', 'stock_code', count(*) FILTER (length(stock_code) > 20)
  FROM dim_product
UNION ALL SELECT 'fact_sales', 'invoice_no', count(*) FILTER (length(invoice_no) > 20)
  FROM fact""",
    # cleaning
    "clean_drop_nulls": f"SELECT {CANONICAL}, {LINE} FROM kept",
    "clean_rows": f"""SELECT {CANONICAL}, {LINE}, (price <= 0) AS price_flag,
  quantity > 1000 AS quantity_flag, starts_with(invoice, 'C') OR quantity < 0 AS is_return,
  CAST(quantity * price AS DOUBLE) AS "TotalAmount" FROM clean""",
    "flag_price": f"""SELECT {LINE}, CAST(price AS DOUBLE) AS "UnitPrice",
  coalesce(price <= 0, true) AS price_flag FROM raw""",
    "flag_quantity": f"""SELECT {LINE}, quantity AS "Quantity",
  coalesce(quantity > 1000, false) AS quantity_flag FROM raw""",
    "flag_returns": f"""SELECT {LINE}, invoice AS "InvoiceNo", quantity AS "Quantity",
  coalesce(starts_with(invoice, 'C'), false) OR coalesce(quantity < 0, false) AS is_return
  FROM raw""",
    "line_amount": f"""SELECT {LINE}, CAST(quantity * price AS DOUBLE) AS "TotalAmount" FROM raw""",
    "rules_apply": f"""SELECT {LANDED}, {LINE}, NOT (price > 0) AS price_flag,
  NOT (quantity < 1000) AS quantity_flag
  FROM raw WHERE customer_id IS NOT NULL AND stock_code IS NOT NULL""",
    "rules_violations": """SELECT 'Customer ID' AS field, 'not_null' AS type,
  CAST(NULL AS DOUBLE) AS value, 'drop' AS action, count(*) AS violations
  FROM raw WHERE customer_id IS NULL
UNION ALL SELECT 'Price', 'greater_than', 0, 'flag', count(*) FROM raw WHERE NOT (price > 0)
UNION ALL SELECT 'Quantity', 'less_than', 1000, 'flag', count(*) FROM raw
  WHERE NOT (quantity < 1000)
UNION ALL SELECT 'StockCode', 'not_null', NULL, 'drop', count(*) FROM raw
  WHERE stock_code IS NULL""",
    "dedup_source": f"SELECT {CANONICAL}, {LINE} FROM clean",
    "dedup_fact": f"SELECT {STAGED} FROM day_first",
    "dedup_fact_bucketed": f"SELECT {STAGED} FROM day_first",
    "cleaning_stats": "SELECT * FROM cleaning",
    "extraction_summary": """SELECT count(*) AS total_rows,
  CAST(min(invoice_date) AS VARCHAR) AS earliest_date,
  CAST(max(invoice_date) AS VARCHAR) AS latest_date,
  '2002-01-01 00:00:00' AS last_load_time, count(DISTINCT customer_id) AS unique_customers,
  count(DISTINCT stock_code) AS unique_products, count(DISTINCT country) AS unique_countries
  FROM clean""",
    # star schema
    "dim_time": "SELECT * REPLACE (CAST(date_value AS VARCHAR) AS date_value) FROM dim_time",
    "dim_country": "SELECT * FROM dim_country",
    "dim_product": "SELECT * FROM dim_product",
    "dim_customer": "SELECT * FROM dim_customer",
    "fact_sales": f"SELECT {FACT} FROM fact",
    "surrogate_keys": """SELECT 'dim_time' AS dimension, CAST(date_value AS VARCHAR) AS natural_key,
  time_key AS surrogate_key FROM dim_time
UNION ALL SELECT 'dim_country', country_name, country_key FROM dim_country
UNION ALL SELECT 'dim_product', stock_code, product_key FROM dim_product
UNION ALL SELECT 'dim_customer', CAST(customer_id AS VARCHAR), customer_key FROM dim_customer""",
    "build_stats": """SELECT (SELECT count(*) FROM clean) AS staging_rows,
  (SELECT count(*) FROM dim_time) AS dim_time_rows,
  (SELECT count(*) FROM dim_country) AS dim_country_rows,
  (SELECT count(*) FROM dim_product) AS dim_product_rows,
  (SELECT count(*) FROM dim_customer) AS dim_customer_rows,
  (SELECT count(*) FROM fact) AS fact_rows""",
    "join_fact_product": """SELECT invoice, c.stock_code,
  CAST(invoice_date AS VARCHAR) AS invoice_date, product_key
  FROM clean c JOIN dim_product p ON c.stock_code = p.stock_code""",
    "join_fact_customer": """SELECT invoice, stock_code,
  CAST(invoice_date AS VARCHAR) AS invoice_date, customer_key
  FROM clean c JOIN dim_customer u ON c.customer_id = u.customer_id""",
    "join_fact_country": """SELECT invoice, stock_code,
  CAST(invoice_date AS VARCHAR) AS invoice_date, country_key
  FROM clean LEFT JOIN dim_country ON country = country_name""",
    "join_fact_time": """SELECT invoice, stock_code,
  CAST(invoice_date AS VARCHAR) AS invoice_date, time_key
  FROM clean JOIN dim_time ON CAST(invoice_date AS DATE) = date_value""",
    "orphaned_products": _orphan("orphaned_products"),
    "orphaned_customers": _orphan("orphaned_customers"),
    "orphaned_times": _orphan("orphaned_times"),
    "orphaned_countries": _orphan("orphaned_countries"),
    # business aggregates and verdicts
    "business_rules": "SELECT * FROM rules_row",
    "data_summary": "SELECT * FROM summary",
    "top_countries": """SELECT * FROM country_revenue
  ORDER BY revenue DESC, country_name LIMIT 5""",
    "top_products": """SELECT stock_code, description, CAST(sum(quantity) AS BIGINT)
  AS total_quantity FROM fact JOIN dim_product USING (product_key) WHERE NOT is_return
  GROUP BY stock_code, description ORDER BY total_quantity DESC, stock_code LIMIT 10""",
    "monthly_revenue": """SELECT year, month, CAST(sum(total_amount) AS DOUBLE) AS monthly_revenue
  FROM fact JOIN dim_time USING (time_key) WHERE NOT is_return GROUP BY year, month""",
    "quality_metrics": "SELECT * FROM metrics",
    "load_gate": "SELECT * FROM gate",
    "load_warnings": """SELECT * FROM (
  SELECT 'orphaned_products' AS check_name, orphaned_products AS row_count FROM orphan_row
  UNION ALL SELECT 'orphaned_customers', orphaned_customers FROM orphan_row
  UNION ALL SELECT 'orphaned_times', orphaned_times FROM orphan_row
  UNION ALL SELECT 'orphaned_countries', orphaned_countries FROM orphan_row
  UNION ALL SELECT 'zero_unit_price', zero_unit_price FROM rules_row
  UNION ALL SELECT 'extreme_quantities', extreme_quantities FROM rules_row)
  WHERE row_count > 0""",
    "run_summary": f"""SELECT final_rows AS rows_processed, rows_dropped AS rows_rejected, drop_rate,
  total_transactions AS fact_rows, CAST(4 AS INTEGER) AS dimension_tables, date_range_start,
  date_range_end, total_revenue, return_rate, unique_customers, unique_products,
  unique_countries, overall_status,
  (SELECT {pct("passed_checks", "total_checks", 1)} FROM check_totals) AS data_quality_score,
  country_name AS best_country, revenue AS best_country_revenue
FROM cleaning, summary, gate,
  (SELECT * FROM country_revenue ORDER BY revenue DESC, country_name LIMIT 1)""",
    # threshold checks
    "check_null_critical_fields": _check(
        "c1",
        "null_critical_fields",
        "total_rows, null_customer_id, null_stock_code, null_invoice_date",
        "true",
        "0.05",
    ),
    "check_duplicate_records": _check(
        "c2", "duplicate_records", "total_records, unique_combinations", "false", "0.01"
    ),
    "check_data_range": _check(
        "c3",
        "data_range_validation",
        "total_rows, invalid_price, suspicious_quantity, zero_quantity",
        "false",
        "0.1",
    ),
    "check_referential_integrity": _check(
        "c4",
        "referential_integrity",
        "orphaned_products, orphaned_customers, orphaned_times",
        "true",
        "0",
    ),
    "check_business_logic": _check(
        "c5",
        "business_logic",
        "total_sales, calculation_errors, avg_transaction_value, negative_non_returns",
        "true",
        "0",
    ),
    "check_data_freshness": f"""SELECT 'data_freshness' AS check_name,
  CAST(last_loaded AS VARCHAR) AS last_loaded, hours AS hours_since_last_load,
  hours <= 48 AS passed, false AS critical, CAST(48 AS DOUBLE) AS threshold FROM ({FRESH})""",
    "check_row_counts": _check(
        "c7",
        "row_count_validation",
        "raw_count, fact_count, customer_count, product_count",
        "true",
        "0.95",
    ),
    "checks_report": f"""SELECT category, check_name, description, results, passed, critical, threshold,
  CAST(NULL AS VARCHAR) AS error FROM checks JOIN ({MEASURES}) USING (check_name)""",
    "checks_summary": "SELECT * FROM check_totals",
    "quality_dashboard": f"""SELECT {pct("passed_checks", "total_checks", 1)} AS quality_score, *
  FROM check_totals, metrics""",
    "failed_checks": """SELECT category, check_name AS name, description, critical
  FROM checks WHERE NOT passed""",
    # script checks
    "dq_critical_nulls": f"""SELECT count(*) AS total_rows,
  count(*) - count(customer_id) AS null_customer_id,
  count(*) - count(stock_code) AS null_stock_code,
  count(*) - count(invoice_date) AS null_invoice_date, count(*) - count(price) AS null_price,
  {pct("count(*) - count(customer_id)", "count(*)")} AS null_customer_pct FROM raw""",
    "dq_duplicates": """SELECT total_records, unique_combinations,
  total_records - unique_combinations AS duplicates FROM c2""",
    "dq_ranges": """SELECT count(*) AS total_rows, count(*) FILTER (price <= 0) AS invalid_price,
  count(*) FILTER (quantity > 1000) AS suspicious_quantity,
  count(*) FILTER (quantity < 0) AS negative_quantity,
  count(*) FILTER (length(stock_code) > 20) AS long_stock_code FROM raw""",
    "dq_returns": f"""SELECT count(*) AS total_transactions,
  count(*) FILTER (invoice LIKE 'C%') AS return_invoices,
  count(*) FILTER (quantity < 0) AS negative_quantity,
  {pct("count(*) FILTER (invoice LIKE 'C%')", "count(*)")} AS return_percentage FROM raw""",
    "dq_date_range": """SELECT CAST(min(invoice_date) AS VARCHAR) AS earliest_date,
  CAST(max(invoice_date) AS VARCHAR) AS latest_date,
  count(*) FILTER (invoice_date < TIMESTAMP '1996-01-01' OR invoice_date > TIMESTAMP '2001-01-01')
    AS out_of_range_dates FROM raw""",
    "dq_country": f"""SELECT count(DISTINCT country) AS unique_countries,
  count(*) FILTER (country IS NULL OR country = '') AS null_empty_country,
  count(*) AS total_records,
  {pct("count(*) FILTER (country IS NULL OR country = '')", "count(*)")} AS null_empty_percentage
  FROM raw""",
    "dq_top_countries_share": f"""SELECT country, n AS transaction_count,
  {pct("n", "total")} AS percentage
FROM (SELECT country, count(*) AS n, (SELECT count(country) FROM raw) AS total
      FROM raw WHERE country IS NOT NULL GROUP BY country)
ORDER BY n DESC, country LIMIT 10""",
    "dq_referential_integrity": """SELECT (SELECT count(*) FROM fact) AS fact_records,
  orphaned_products, orphaned_customers, orphaned_times FROM orphan_row""",
    "dq_business_logic": """SELECT count(*) AS total_sales,
  count(*) FILTER (total_amount <> quantity * unit_price) AS calculation_errors,
  CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_transaction_value,
  CAST(max(total_amount) AS DOUBLE) AS max_transaction_value,
  CAST(min(total_amount) AS DOUBLE) AS min_transaction_value FROM fact""",
    "dq_freshness": f"""SELECT CAST(last_loaded AS VARCHAR) AS last_loaded,
  hours AS hours_since_last_load FROM ({FRESH})""",
    # monitoring
    "data_date_range": """SELECT CAST(min(date_value) AS VARCHAR) AS min_date,
  CAST(max(date_value) AS VARCHAR) AS max_date, count(DISTINCT date_value) AS total_days
  FROM fact JOIN dim_time USING (time_key)""",
    "iqr_fences": """SELECT round(q25, 4) AS q25, round(q75, 4) AS q75, round(iqr, 4) AS iqr,
  round(lower_bound, 4) AS lower_bound, round(upper_bound, 4) AS upper_bound,
  round(mean_sales, 4) AS mean_sales, round(std_sales, 4) AS std_sales FROM fences""",
    "daily_sales_range": """SELECT CAST(date_value AS VARCHAR) AS date_value, year, month, day_name,
  is_weekend, CAST(daily_sales AS DOUBLE) AS daily_sales, total_transactions, unique_customers,
  CAST(daily_returns AS DOUBLE) AS daily_returns, return_transactions, is_outlier, outlier_type,
  quality_score, round(mean_sales, 4) AS mean_sales, round(std_sales, 4) AS std_sales,
  round(z_score, 6) AS z_score FROM sales_range""",
    "missing_customer_rate": """SELECT * REPLACE (CAST(date_value AS VARCHAR) AS date_value,
  round(quality_score, 4) AS quality_score) FROM missing""",
    "return_rate_analysis": """SELECT * REPLACE (CAST(date_value AS VARCHAR) AS date_value,
  CAST(sales_amount AS DOUBLE) AS sales_amount, CAST(return_amount AS DOUBLE) AS return_amount,
  round(return_rate_z_score, 6) AS return_rate_z_score) FROM return_rates""",
    "product_quality": """SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue)
  FROM products""",
    "overall_summary": f"""SELECT CAST(min(date_value) AS VARCHAR) AS min_date,
  CAST(max(date_value) AS VARCHAR) AS max_date, count(DISTINCT date_value) AS total_days,
  count(*) AS total_records,
  CAST(coalesce(sum(total_amount) FILTER (NOT is_return), 0) AS DOUBLE) AS total_sales,
  CAST(coalesce(sum(abs(total_amount)) FILTER (is_return), 0) AS DOUBLE) AS total_returns,
  {pct("count(*) FILTER (is_return)", "count(*)")} AS overall_return_rate,
  count(DISTINCT customer_key) AS unique_customers,
  count(DISTINCT product_key) AS unique_products, count(DISTINCT time_key) AS unique_dates
  FROM fact LEFT JOIN dim_time USING (time_key)""",
    "anomaly_details": 'SELECT * REPLACE (CAST("Date" AS VARCHAR) AS "Date") FROM anomalies',
    "monthly_trends": "SELECT * FROM months",
    "monitoring_counters": """SELECT
  (SELECT count(*) FROM sales_range WHERE is_outlier) AS outlier_days,
  (SELECT count(*) FROM missing WHERE quality_status = 'Critical') AS critical_days,
  (SELECT count(*) FROM return_rates WHERE is_return_anomaly) AS return_anomaly_days,
  (SELECT count(*) FROM products WHERE quality_score < 100) AS products_with_issues""",
    "sheet_daily_quality_metrics": f"SELECT {SALES_SHEET} FROM sales_range",
    "sheet_customer_data_quality": """SELECT CAST(date_value AS VARCHAR) AS date_value,
  total_transactions, missing_customers, missing_customer_rate, quality_status,
  round(quality_score, 4) AS quality_score FROM missing""",
    "sheet_return_rate_analysis": """SELECT CAST(date_value AS VARCHAR) AS date_value,
  total_transactions, return_transactions, return_rate,
  round(return_rate_z_score, 6) AS return_rate_z_score, is_return_anomaly, return_status
  FROM return_rates""",
    "sheet_product_quality": """SELECT stock_code, description, transaction_count,
  CAST(total_revenue AS DOUBLE) AS total_revenue, missing_description, invalid_stock_code,
  quality_score FROM products""",
}

_WITH = "WITH " + ",\n".join(f"{name} AS ({body.strip()})" for name, body in CTES.items())


def oracle_sql() -> dict[str, str]:
    return {name: f"{_WITH}\n{body.strip()}" for name, body in BODIES.items()}
