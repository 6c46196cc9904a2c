"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written against the raw star tables (views ``region nation customer part
orders lineitem``).  Money is carried as integer cents and every rounded
figure is an integral half-up division, so the oracle does not depend on
either engine's floating-point rounding.
"""

from __future__ import annotations

from fractions import Fraction

AS_OF = "DATE '2002-01-01'"


def hu(num: str, den: str, scale: int = 2, mult: int = 1, num_scale: int = 0) -> str:
    """round(mult * num / 10^num_scale / den, scale), half away from zero, as DOUBLE."""
    k = mult * 10 ** (scale - num_scale)
    n = f"(CAST({num} AS HUGEINT) * {k})"
    d = f"CAST({den} AS HUGEINT)"
    q = f"((2 * ABS({n}) + {d}) // (2 * {d}))"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL "
        f"WHEN {n} < 0 THEN CAST(-{q} AS DOUBLE) / {10**scale}.0 "
        f"ELSE CAST({q} AS DOUBLE) / {10**scale}.0 END)"
    )


def dollars(cents_expr: str) -> str:
    return f"(CAST({cents_expr} AS DOUBLE) / 100.0)"


def stddev_cents(c: str) -> str:
    n = f"CAST(COUNT({c}) AS HUGEINT)"
    s1 = f"SUM(CAST({c} AS HUGEINT))"
    s2 = f"SUM(CAST({c} AS HUGEINT) * CAST({c} AS HUGEINT))"
    return (
        f"(CASE WHEN COUNT({c}) > 1 THEN ROUND(SQRT(CAST({n} * {s2} - {s1} * {s1} AS DOUBLE) "
        f"/ CAST({n} * ({n} - 1) AS DOUBLE)) / 100.0, 2) END)"
    )


BRONZE = """
bronze AS (
  SELECT
    concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, CAST(l.l_quantity AS BIGINT),
      strftime(l.l_shipdate, '%Y%m%d')) AS order_id,
    CAST(c.c_custkey AS VARCHAR) AS customer_id,
    p.p_name AS product_name,
    p.p_type AS category,
    CAST(l.l_quantity AS BIGINT) AS quantity,
    p.p_retailprice AS unit_price,
    o.o_orderdate AS order_date,
    r.r_name AS region,
    o.o_orderpriority AS payment_method,
    CAST(1 + ((date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) % 30) + 30) % 30 AS BIGINT)
      AS delivery_days,
    CAST(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS is_returned
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

SURVIVOR = (
    "customer_id, product_name, category, quantity, unit_price, order_amount, order_date, "
    "region, payment_method, delivery_days, is_returned"
)

SILVER = (
    BRONZE
    + """,
typed AS (
  SELECT order_id, customer_id, product_name, category,
    CAST(quantity AS INTEGER) AS quantity,
    ROUND(unit_price, 2) AS unit_price,
    CAST(order_date AS DATE) AS order_date,
    region, payment_method,
    CAST(delivery_days AS INTEGER) AS delivery_days,
    CAST(is_returned AS INTEGER) AS is_returned,
    ROUND(quantity * unit_price, 2) AS order_amount
  FROM bronze
),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY """
    + ", ".join(f"{c} ASC NULLS FIRST" for c in SURVIVOR.split(", "))
    + """) AS rn
  FROM typed
  WHERE unit_price > 0 AND quantity > 0 AND order_amount > 0
),
silver AS (
  SELECT order_id, customer_id, product_name, category, quantity, unit_price, order_date,
    region, payment_method, delivery_days, is_returned, order_amount,
    CAST(year(order_date) AS INTEGER) AS order_year,
    CAST(month(order_date) AS INTEGER) AS order_month,
    CAST(dayofweek(order_date) + 1 AS INTEGER) AS day_of_week,
    CAST(weekofyear(order_date) AS INTEGER) AS week_of_year,
    CASE WHEN quantity > 3 THEN 'High' ELSE 'Normal' END AS order_size,
    CASE WHEN order_amount > 50000 THEN 'Premium' WHEN order_amount > 10000 THEN 'Standard'
         ELSE 'Budget' END AS order_value_segment,
    CASE WHEN delivery_days <= 3 THEN 'Express' WHEN delivery_days <= 7 THEN 'Fast'
         ELSE 'Standard' END AS delivery_type,
    """
    + AS_OF
    + """ AS processing_date,
    CAST(ROUND(order_amount * 100) AS BIGINT) AS cents
  FROM ranked WHERE rn = 1
)"""
)

SILVER_COLS = (
    "order_id, customer_id, product_name, category, quantity, unit_price, order_date, region, "
    "payment_method, delivery_days, is_returned, order_amount, order_year, order_month, day_of_week, "
    "week_of_year, order_size, order_value_segment, delivery_type, processing_date"
)

RETURNS = "COUNT(*) FILTER (WHERE is_returned = 1)"
RATE = hu(RETURNS, "COUNT(*)", 2, 100)
AVG_AMOUNT = hu("SUM(cents)", "COUNT(cents)", 2, 1, 2)


def with_silver(body: str) -> str:
    """Prefix the silver CTE chain; a body starting with ',' adds further CTEs."""
    body = body.lstrip()
    if body.startswith(","):
        return f"WITH {SILVER}{body}"
    return f"WITH {SILVER}\n{body}"


Q: dict[str, str] = {}

Q["silver_orders"] = with_silver(f"SELECT {SILVER_COLS} FROM silver")

Q["daily_sales_summary"] = with_silver(
    f"""
SELECT order_date, region, category,
  COUNT(*) AS total_orders,
  COUNT(DISTINCT customer_id) AS unique_customers,
  {dollars('SUM(cents)')} AS total_revenue,
  {AVG_AMOUNT} AS avg_order_value,
  MIN(order_amount) AS min_order_value,
  MAX(order_amount) AS max_order_value,
  CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
  {dollars('SUM(CASE WHEN is_returned = 1 THEN cents ELSE 0 END)')} AS returned_amount,
  {RATE} AS return_rate_pct
FROM silver GROUP BY order_date, region, category"""
)

CUSTOMER_METRICS_BODY = f"""
SELECT customer_id,
  COUNT(*) AS total_purchases,
  MAX(order_date) AS last_purchase_date,
  CAST(date_diff('day', MAX(order_date), {AS_OF}) AS INTEGER) AS days_since_purchase,
  {dollars('SUM(cents)')} AS lifetime_value,
  {AVG_AMOUNT} AS avg_order_value,
  {stddev_cents('cents')} AS order_value_stddev,
  CAST(SUM(quantity) AS BIGINT) AS total_items,
  MIN(order_date) AS first_purchase_date,
  CAST(date_diff('day', MIN(order_date), MAX(order_date)) AS INTEGER) AS customer_tenure_days,
  {RATE} AS return_rate_pct
FROM silver GROUP BY customer_id"""

Q["customer_metrics"] = with_silver(CUSTOMER_METRICS_BODY)

PRODUCT_BODY = f"""
SELECT product_name, category,
  COUNT(*) AS times_purchased,
  COUNT(DISTINCT customer_id) AS unique_customers,
  CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
  {dollars('SUM(cents)')} AS total_revenue,
  {AVG_AMOUNT} AS avg_order_value,
  {hu('SUM(quantity)', 'COUNT(quantity)', 2)} AS avg_units_per_order,
  MIN(order_amount) AS min_order_value,
  MAX(order_amount) AS max_order_value,
  {RATE} AS return_rate_pct,
  {hu('SUM(cents)', 'SUM(quantity)', 2, 1, 2)} AS revenue_per_unit,
  CAST(ROW_NUMBER() OVER (ORDER BY SUM(cents) DESC, product_name ASC NULLS FIRST, category ASC NULLS FIRST)
    AS INTEGER) AS revenue_rank
FROM silver GROUP BY product_name, category"""

Q["product_performance"] = with_silver(PRODUCT_BODY)

REGIONAL_BODY = f"""
SELECT region,
  COUNT(*) AS total_orders,
  COUNT(DISTINCT customer_id) AS unique_customers,
  {dollars('SUM(cents)')} AS total_revenue,
  {AVG_AMOUNT} AS avg_order_value,
  {hu('SUM(delivery_days)', 'COUNT(delivery_days)', 1)} AS avg_delivery_days,
  {hu('SUM(cents)', 'COUNT(DISTINCT customer_id)', 2, 1, 2)} AS revenue_per_customer,
  {RATE} AS return_rate_pct,
  CAST(SUM(quantity) AS BIGINT) AS total_units_sold
FROM silver GROUP BY region"""

Q["regional_analysis"] = with_silver(REGIONAL_BODY)

Q["category_trends"] = with_silver(
    f"""
SELECT order_month, category,
  COUNT(*) AS order_count,
  COUNT(DISTINCT customer_id) AS unique_customers,
  {dollars('SUM(cents)')} AS monthly_revenue,
  {AVG_AMOUNT} AS avg_order_value,
  CAST(ROW_NUMBER() OVER (PARTITION BY category ORDER BY order_month DESC) AS INTEGER) AS month_rank
FROM silver GROUP BY order_month, category"""
)

Q["category_trends_by_year"] = with_silver(
    f"""
SELECT order_year, order_month, category,
  COUNT(*) AS order_count,
  COUNT(DISTINCT customer_id) AS unique_customers,
  {dollars('SUM(cents)')} AS monthly_revenue,
  {AVG_AMOUNT} AS avg_order_value,
  CAST(ROW_NUMBER() OVER (PARTITION BY category ORDER BY order_year DESC, order_month DESC) AS INTEGER)
    AS month_rank
FROM silver GROUP BY order_year, order_month, category"""
)

SEGMENTATION = f""",
metrics AS ({CUSTOMER_METRICS_BODY}),
scores AS (
  SELECT customer_id, total_purchases, days_since_purchase, lifetime_value,
    CAST(NTILE(5) OVER (ORDER BY days_since_purchase DESC NULLS LAST, customer_id ASC NULLS FIRST) AS INTEGER)
      AS recency_score,
    CAST(NTILE(5) OVER (ORDER BY total_purchases ASC NULLS FIRST, customer_id ASC NULLS FIRST) AS INTEGER)
      AS frequency_score,
    CAST(NTILE(5) OVER (ORDER BY lifetime_value ASC NULLS FIRST, customer_id ASC NULLS FIRST) AS INTEGER)
      AS monetary_score
  FROM metrics
),
segmentation AS (
  SELECT customer_id, recency_score, frequency_score, monetary_score,
    CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR) || CAST(monetary_score AS VARCHAR)
      AS rfm_segment,
    CASE
      WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'VIP'
      WHEN recency_score >= 3 AND frequency_score >= 3 AND monetary_score >= 3 THEN 'High Value'
      WHEN recency_score >= 3 AND frequency_score >= 3 THEN 'Loyal'
      WHEN recency_score <= 2 THEN 'At Risk'
      WHEN monetary_score >= 4 THEN 'Big Spender'
      ELSE 'Standard'
    END AS customer_segment,
    total_purchases, days_since_purchase, lifetime_value
  FROM scores
)"""

Q["rfm_segmentation"] = f"WITH {SILVER}{SEGMENTATION}\nSELECT * FROM segmentation"

Q["revenue_trends"] = with_silver(
    f""",
daily AS (SELECT order_date, region, SUM(cents) AS d FROM silver GROUP BY order_date, region),
win AS (
  SELECT order_date, region, d,
    SUM(d) OVER (PARTITION BY region ORDER BY order_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
    LAG(d) OVER (PARTITION BY region ORDER BY order_date) AS prev,
    SUM(d) OVER (PARTITION BY region ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS s7,
    COUNT(d) OVER (PARTITION BY region ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS n7
  FROM daily
)
SELECT order_date, region,
  {dollars('d')} AS daily_revenue,
  {dollars('cum')} AS cumulative_revenue,
  {dollars('prev')} AS prev_day_revenue,
  {hu('d - prev', 'prev', 2, 100)} AS revenue_growth_pct,
  {hu('s7', 'n7', 6, 1, 2)} AS moving_avg_7day
FROM win"""
)

Q["top_products_by_region"] = with_silver(
    """,
grouped AS (
  SELECT region, product_name, category, SUM(cents) AS rc, CAST(SUM(quantity) AS BIGINT) AS total_units,
    COUNT(*) AS order_count,
    CAST(ROW_NUMBER() OVER (PARTITION BY region ORDER BY SUM(cents) DESC, product_name ASC NULLS FIRST,
      category ASC NULLS FIRST) AS INTEGER) AS rank_in_region
  FROM silver GROUP BY region, product_name, category
)
SELECT region, product_name, category, CAST(rc AS DOUBLE) / 100.0 AS total_revenue, total_units, order_count,
  rank_in_region
FROM grouped WHERE rank_in_region <= 5"""
)

Q["cohort_retention"] = with_silver(
    f""",
per_month AS (
  SELECT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS order_month, COUNT(*) AS n
  FROM silver WHERE customer_id IS NOT NULL GROUP BY ALL
),
tagged AS (
  SELECT *, MIN(order_month) OVER (PARTITION BY customer_id) AS cohort_month FROM per_month
),
grid AS (
  SELECT cohort_month,
    CAST((year(order_month) - year(cohort_month)) * 12 + month(order_month) - month(cohort_month) AS INTEGER)
      AS months_since_cohort,
    COUNT(*) AS cohort_size, CAST(SUM(n) AS BIGINT) AS repeat_purchases
  FROM tagged GROUP BY ALL
)
SELECT cohort_month, months_since_cohort, cohort_size, repeat_purchases,
  {hu('cohort_size', 'FIRST_VALUE(cohort_size) OVER (PARTITION BY cohort_month ORDER BY months_since_cohort ASC NULLS LAST)', 2, 100)}
    AS retention_rate_pct
FROM grid"""
)


def _pct_sql(name: str, p: float) -> tuple[str, str]:
    fr = Fraction(str(p))
    k, d = fr.numerator, fr.denominator
    pos = f"((n - 1) * {k})"
    lo = f"({pos} // {d})"
    rem = f"({pos} % {d})"
    hi = f"({lo} + CASE WHEN {rem} > 0 THEN 1 ELSE 0 END)"
    a = f"MAX(CASE WHEN cum - c <= {lo} AND {lo} < cum THEN v END)"
    b = f"MAX(CASE WHEN cum - c <= {hi} AND {hi} < cum THEN v END)"
    r = f"MAX({rem})"
    return name, hu(f"({d} * {a} + {r} * ({b} - {a}))", str(d), 1)


_PCTS = [_pct_sql(n, p) for n, p in (("median_delivery_days", 0.5), ("p75_delivery_days", 0.75), ("p95_delivery_days", 0.95))]

Q["delivery_performance"] = with_silver(
    f""",
hist AS (
  SELECT region, delivery_type, delivery_days AS v, COUNT(*) AS c, SUM(cents) AS rc
  FROM silver GROUP BY region, delivery_type, delivery_days
),
cumh AS (
  SELECT *, SUM(c) OVER (PARTITION BY region, delivery_type ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      AS cum,
    SUM(c) OVER (PARTITION BY region, delivery_type) AS n
  FROM hist WHERE v IS NOT NULL
),
pcts AS (
  SELECT region, delivery_type, {', '.join(f'{expr} AS {name}' for name, expr in _PCTS)}
  FROM cumh GROUP BY region, delivery_type
),
totals AS (
  SELECT region, delivery_type,
    CAST(SUM(c) AS BIGINT) AS order_count,
    {hu('SUM(v * c)', 'SUM(CASE WHEN v IS NOT NULL THEN c END)', 1)} AS avg_delivery_days,
    MIN(v) AS min_delivery_days, MAX(v) AS max_delivery_days,
    {dollars('SUM(rc)')} AS total_revenue
  FROM hist GROUP BY region, delivery_type
)
SELECT t.region, t.delivery_type, order_count, avg_delivery_days, min_delivery_days, max_delivery_days,
  median_delivery_days, p75_delivery_days, p95_delivery_days, total_revenue
FROM totals t LEFT JOIN pcts p ON t.region = p.region AND t.delivery_type = p.delivery_type"""
)

Q["payment_analysis"] = with_silver(
    f"""
SELECT payment_method,
  COUNT(*) AS transaction_count,
  COUNT(DISTINCT customer_id) AS unique_users,
  {dollars('SUM(cents)')} AS total_revenue,
  {AVG_AMOUNT} AS avg_transaction_value,
  {RATE} AS return_rate_pct,
  {hu('SUM(delivery_days)', 'COUNT(delivery_days)', 1)} AS avg_delivery_days,
  {hu('SUM(cents)', 'COUNT(DISTINCT customer_id)', 2, 1, 2)} AS revenue_per_customer,
  {hu('SUM(cents)', 'SUM(SUM(cents)) OVER ()', 2, 100)} AS pct_of_total_revenue
FROM silver GROUP BY payment_method"""
)

ORACLE_SQL = Q


# ---------------------------------------------------------------- quality ---

SILVER_COLUMN_LIST = [c.strip() for c in SILVER_COLS.split(",")]
BRONZE_COLUMN_LIST = [
    "order_id", "customer_id", "product_name", "category", "quantity", "unit_price", "order_date",
    "region", "payment_method", "delivery_days", "is_returned",
]
STAR_REGIONS = "'AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'"
STAR_PAYMENTS = "'1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'"


def distinct_null(c: str) -> str:
    return f"(COUNT(DISTINCT {c}) + COALESCE(MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0))"


def _nulls(c: str) -> str:
    return f"COUNT(*) FILTER (WHERE {c} IS NULL)"


QUALITY_AGG = f""",
qa AS (
  SELECT COUNT(*) AS total,
    {distinct_null('order_id')} AS keys,
    {distinct_null('customer_id')} AS customers,
    {', '.join(f"{_nulls(c)} AS nulls__{c}" for c in SILVER_COLUMN_LIST)},
    COUNT(*) FILTER (WHERE order_amount < 0) AS neg_amount,
    COUNT(*) FILTER (WHERE quantity < 1 OR quantity > 10) AS bad_qty,
    COUNT(*) FILTER (WHERE 2 * ABS(cents - CAST(quantity AS BIGINT) * CAST(ROUND(unit_price * 100) AS BIGINT))
                     > CAST(quantity AS BIGINT) + 1) AS mismatch,
    COUNT(*) FILTER (WHERE region NOT IN ({STAR_REGIONS})) AS bad_region,
    COUNT(*) FILTER (WHERE payment_method NOT IN ({STAR_PAYMENTS})) AS bad_payment,
    MIN(order_date) AS min_date, MAX(order_date) AS max_date,
    MIN(unit_price) AS min_price, MAX(unit_price) AS max_price,
    COUNT(*) FILTER (WHERE unit_price < 0) AS low_price,
    COUNT(*) FILTER (WHERE unit_price > 200000) AS high_price,
    MIN(delivery_days) AS min_delivery, MAX(delivery_days) AS max_delivery,
    COUNT(*) FILTER (WHERE delivery_days < 1) AS low_delivery,
    COUNT(*) FILTER (WHERE delivery_days > 90) AS high_delivery,
    MIN(order_amount) AS min_amount, MAX(order_amount) AS max_amount,
    {AVG_AMOUNT} AS avg_amount,
    {stddev_cents('cents')} AS stddev_amount,
    {dollars('SUM(cents)')} AS sum_amount,
    MIN(quantity) AS min_qty, MAX(quantity) AS max_qty,
    {hu('SUM(quantity)', 'COUNT(quantity)', 2)} AS avg_qty,
    {hu('SUM(delivery_days)', 'COUNT(delivery_days)', 2)} AS avg_delivery
  FROM silver
)"""


def _qrow(dim, name, column, metric, viol="NULL", total="total", passed="NULL") -> str:
    col = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return (
        f"SELECT '{dim}' AS dimension, '{name}' AS check_name, {col} AS column_name, "
        f"CAST({metric} AS DOUBLE) AS metric_value, CAST({viol} AS BIGINT) AS violations, "
        f"CAST({total} AS BIGINT) AS total, CAST({passed} AS BOOLEAN) AS passed FROM qa"
    )


def _counted(dim, name, column, viol) -> str:
    return _qrow(dim, name, column, hu(viol, "total", 2, 100), viol, "total", f"{viol} = 0")


_QROWS = [
    _qrow("volume", "total_records", None, "total", "NULL", "total", "total > 0"),
    _qrow("volume", "unique_orders", "order_id", "keys"),
    _qrow("volume", "unique_customers", "customer_id", "customers"),
    *[_counted("completeness", "null_count", c, f"nulls__{c}") for c in SILVER_COLUMN_LIST],
    _counted("accuracy", "negative_amount", "order_amount", "neg_amount"),
    _counted("accuracy", "quantity_out_of_range", "quantity", "bad_qty"),
    _counted("accuracy", "amount_mismatch", "order_amount", "mismatch"),
    _counted("consistency", "duplicate_key", "order_id", "(total - keys)"),
    _counted("consistency", "invalid_region", "region", "bad_region"),
    _counted("consistency", "invalid_payment_method", "payment_method", "bad_payment"),
    _qrow("timeliness", "date_span_days", "order_date", "date_diff('day', min_date, max_date)"),
    _qrow("timeliness", "data_freshness_days", "order_date", f"date_diff('day', max_date, {AS_OF})"),
    _qrow("validity", "min_unit_price", "unit_price", "min_price", "low_price", "total", "low_price = 0"),
    _qrow("validity", "max_unit_price", "unit_price", "max_price", "high_price", "total", "high_price = 0"),
    _qrow("validity", "min_delivery_days", "delivery_days", "min_delivery", "low_delivery", "total", "low_delivery = 0"),
    _qrow("validity", "max_delivery_days", "delivery_days", "max_delivery", "high_delivery", "total", "high_delivery = 0"),
    *[
        _qrow("statistics", name, column, src)
        for name, column, src in (
            ("min_amount", "order_amount", "min_amount"),
            ("max_amount", "order_amount", "max_amount"),
            ("avg_amount", "order_amount", "avg_amount"),
            ("stddev_amount", "order_amount", "stddev_amount"),
            ("total_revenue", "order_amount", "sum_amount"),
            ("min_quantity", "quantity", "min_qty"),
            ("max_quantity", "quantity", "max_qty"),
            ("avg_quantity", "quantity", "avg_qty"),
            ("min_delivery", "delivery_days", "min_delivery"),
            ("max_delivery", "delivery_days", "max_delivery"),
            ("avg_delivery", "delivery_days", "avg_delivery"),
        )
    ],
]

REPORT = QUALITY_AGG + ",\nreport AS (\n" + "\nUNION ALL\n".join(_QROWS) + "\n)"

Q["quality_report"] = with_silver(REPORT + "\nSELECT * FROM report")

Q["quality_metrics_row"] = with_silver(
    REPORT
    + f"""
SELECT TIMESTAMP '2002-01-01 00:00:00' AS check_date,
  CAST(MAX(CASE WHEN check_name = 'total_records' THEN metric_value END) AS BIGINT) AS total_records,
  CAST(MAX(CASE WHEN check_name = 'unique_customers' THEN metric_value END) AS BIGINT) AS unique_customers,
  MAX(CASE WHEN check_name = 'null_count' AND column_name = 'order_id' THEN violations END) AS null_count,
  MAX(CASE WHEN check_name = 'duplicate_key' THEN violations END) AS duplicate_count,
  CAST(MAX(CASE WHEN check_name = 'data_freshness_days' THEN metric_value END) AS BIGINT) AS data_freshness_days,
  {hu('COUNT(*) FILTER (WHERE passed)', 'COUNT(passed)', 2, 100)} AS quality_score_pct
FROM report"""
)


def _null_profile(source: str, cols: list[str]) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, {_nulls(c)} AS null_count, COUNT(*) AS total_records, "
        f"{hu(_nulls(c), 'COUNT(*)', 2, 100)} AS null_pct FROM {source}"
        for c in cols
    ]
    return "\nUNION ALL\n".join(parts)


Q["null_profile"] = with_silver(_null_profile("silver", SILVER_COLUMN_LIST))
Q["bronze_null_profile"] = f"WITH {BRONZE}\n" + _null_profile("bronze", BRONZE_COLUMN_LIST)

Q["duplicate_count"] = f"""WITH {BRONZE}
SELECT COUNT(*) AS total_rows, {distinct_null('order_id')} AS distinct_keys,
  COUNT(*) - {distinct_null('order_id')} AS duplicate_count
FROM bronze"""


Q["cleaning_summary"] = with_silver(
    "SELECT (SELECT COUNT(*) FROM bronze) AS bronze_rows, (SELECT COUNT(*) FROM silver) AS silver_rows, "
    "(SELECT COUNT(*) FROM bronze) - (SELECT COUNT(*) FROM silver) AS rows_removed"
)


# Spark's names of DuckDB's types (fixed values).
_SPARK_TYPES = {"VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "DATE": "date",
                "TIMESTAMP": "timestamp_ntz", "TIMESTAMP WITH TIME ZONE": "timestamp"}


def type_name(c: str) -> str:
    """The stored type of column ``c``, by Spark's name."""
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _SPARK_TYPES.items())
    return f"CASE ANY_VALUE(typeof({c})) {cases} ELSE ANY_VALUE(typeof({c})) END"


def _profile(source: str, cols: list[str], negatives=(), ranges=(), amount=None) -> str:
    total_nulls = " + ".join(_nulls(c) for c in cols)
    sel = [
        "COUNT(*) AS record_count",
        *[f"{distinct_null(c)} AS distinct_{c}" for c in ("order_id", "customer_id", "product_name", "category", "region")],
        f"CAST({total_nulls} AS BIGINT) AS null_total",
        *[f"{_nulls(c)} AS nulls__{c}" for c in cols],
        "MIN(unit_price) AS min_unit_price",
        "MAX(unit_price) AS max_unit_price",
        f"{hu('SUM(CAST(ROUND(unit_price * 100) AS BIGINT))', 'COUNT(unit_price)', 2, 1, 2)} AS avg_unit_price",
        "MIN(CAST(order_date AS DATE)) AS min_order_date",
        "MAX(CAST(order_date AS DATE)) AS max_order_date",
        *[f"{type_name(c)} AS type__{c}" for c in cols],
        *([f"{dollars(f'SUM({amount})')} AS total_revenue", f"{AVG_AMOUNT} AS avg_order_value"] if amount else []),
        *[f"COUNT(*) FILTER (WHERE {c} < 0) AS negative_{c}" for c in negatives],
        *[f"COUNT(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS out_of_range_{c}" for c, lo, hi in ranges],
        f"COUNT(*) - {distinct_null('order_id')} AS duplicate_order_id",
    ]
    return f"SELECT {', '.join(sel)} FROM {source}"


Q["raw_profile"] = f"WITH {BRONZE}\n" + _profile("bronze", BRONZE_COLUMN_LIST)
Q["clean_profile"] = with_silver(
    _profile(
        "silver",
        SILVER_COLUMN_LIST,
        negatives=("order_amount", "unit_price", "quantity"),
        ranges=(("delivery_days", 0, 90), ("quantity", 1, 10)),
        amount="cents",
    )
)

# -------------------------------------------------------------- dashboard ---

Q["kpi_summary"] = with_silver(
    f"""
SELECT COUNT(DISTINCT customer_id) AS total_customers, COUNT(*) AS total_orders,
  {dollars('SUM(cents)')} AS total_revenue, {AVG_AMOUNT} AS avg_order_value, {RATE} AS return_rate_pct
FROM silver"""
)
Q["revenue_by_region"] = with_silver(f"SELECT region, {dollars('SUM(cents)')} AS total_revenue FROM silver GROUP BY region")
Q["daily_revenue_trend"] = with_silver(
    f"SELECT order_date, {dollars('SUM(cents)')} AS revenue FROM silver GROUP BY order_date"
)
Q["top_products"] = with_silver(
    f""",
pp AS ({PRODUCT_BODY})
SELECT revenue_rank, product_name, category, total_revenue FROM pp WHERE revenue_rank <= 10"""
)
Q["category_distribution"] = with_silver(
    f"""
SELECT category, COUNT(*) AS orders, {dollars('SUM(cents)')} AS revenue,
  {hu('SUM(cents)', 'SUM(SUM(cents)) OVER ()', 2, 100)} AS pct_of_total_revenue
FROM silver GROUP BY category"""
)
Q["customer_segments"] = (
    f"WITH {SILVER}{SEGMENTATION}\n"
    "SELECT customer_segment, COUNT(*) AS customers, "
    "CAST(SUM(CAST(ROUND(lifetime_value * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS revenue "
    "FROM segmentation GROUP BY customer_segment"
)

# ------------------------------------------------------- acceptance suite ---


def _arow(test, check, actual, lower=None, upper=None, detail=None, source="") -> str:
    lo = "NULL" if lower is None else str(lower)
    hi = "NULL" if upper is None else str(upper)
    det = "CAST(NULL AS VARCHAR)" if detail is None else detail
    a = f"CAST({actual} AS DOUBLE)"
    cond = [f"{a} IS NOT NULL"]
    if lower is not None:
        cond.append(f"{a} >= {lo}")
    if upper is not None:
        cond.append(f"{a} <= {hi}")
    return (
        f"SELECT '{test}' AS test, '{check}' AS check_name, {det} AS detail, {a} AS actual, "
        f"CAST({lo} AS DOUBLE) AS lower, CAST({hi} AS DOUBLE) AS upper, "
        f"COALESCE({' AND '.join(cond)}, false) AS passed {source}"
    )


_COUNTS = {
    "ecommerce_bronze": "(SELECT COUNT(*) FROM bronze)",
    "ecommerce_silver": "(SELECT COUNT(*) FROM silver)",
    "daily_sales_summary": "(SELECT COUNT(*) FROM (SELECT DISTINCT order_date, region, category FROM silver))",
    "customer_metrics": "(SELECT COUNT(*) FROM (SELECT DISTINCT customer_id FROM silver))",
    "product_performance": "(SELECT COUNT(*) FROM (SELECT DISTINCT product_name, category FROM silver))",
    "regional_analysis": "(SELECT COUNT(*) FROM (SELECT DISTINCT region FROM silver))",
    "customer_segmentation": "(SELECT COUNT(*) FROM (SELECT DISTINCT customer_id FROM silver))",
    "delivery_performance": "(SELECT COUNT(*) FROM (SELECT DISTINCT region, delivery_type FROM silver))",
    "category_trends": "(SELECT COUNT(*) FROM (SELECT DISTINCT order_month, category FROM silver))",
}
_TYPES = [
    ("order_id", "string"), ("customer_id", "string"), ("product_name", "string"), ("category", "string"),
    ("quantity", "int"), ("unit_price", "double"), ("order_amount", "double"), ("order_date", "date"),
    ("region", "string"), ("payment_method", "string"),
]
_silver_nulls = " + ".join(_nulls(c) for c in SILVER_COLUMN_LIST)
_AROWS = [
    *[_arow("table_exists", t, n, 0) for t, n in _COUNTS.items()],
    *[_arow("gold_non_empty", t, _COUNTS[t], 1) for t in ("daily_sales_summary", "customer_metrics", "product_performance")],
    _arow("gold_row_count", "regional_analysis", _COUNTS["regional_analysis"], 5, 5),
    _arow("row_count", "ecommerce_bronze", _COUNTS["ecommerce_bronze"], 1),
    _arow("row_count", "ecommerce_silver", "COUNT(*)", 1, source="FROM silver"),
    _arow("no_nulls", "ecommerce_silver", _silver_nulls, 0, 0, source="FROM silver"),
    _arow("no_duplicates", "order_id", f"COUNT(*) - {distinct_null('order_id')}", 0, 0, source="FROM silver"),
    _arow("value_range", "unit_price_min", "MIN(unit_price)", 0.0, source="FROM silver"),
    _arow("value_range", "unit_price_max", "MAX(unit_price)", None, 200000.0, source="FROM silver"),
    _arow("value_range", "quantity_min", "MIN(quantity)", 1, source="FROM silver"),
    _arow("value_range", "quantity_max", "MAX(quantity)", None, 10, source="FROM silver"),
    _arow("value_range", "delivery_days_min", "MIN(delivery_days)", 1, source="FROM silver"),
    _arow("value_range", "delivery_days_max", "MAX(delivery_days)", None, 90, source="FROM silver"),
    *[_arow("column_type", c, f"{type_name(c)} = '{t}'", 1, 1, detail=type_name(c), source="FROM silver") for c, t in _TYPES],
]
Q["acceptance_suite"] = with_silver("\nUNION ALL\n".join(_AROWS))

# ------------------------------------- stored tables, history and displays ---

_AUDITED = {
    "ecommerce_bronze": ("WITH " + BRONZE + " SELECT * FROM bronze", None),
    "ecommerce_silver": (Q["silver_orders"], "order_amount"),
    "customer_metrics": (Q["customer_metrics"], "lifetime_value"),
    "customer_segmentation": (Q["rfm_segmentation"], "lifetime_value"),
    "daily_sales_summary": (Q["daily_sales_summary"], "total_revenue"),
    "product_performance": (Q["product_performance"], "total_revenue"),
    "regional_analysis": (Q["regional_analysis"], "total_revenue"),
    "category_trends": (Q["category_trends"], None),
    "delivery_performance": (Q["delivery_performance"], "total_revenue"),
    "revenue_trends": (Q["revenue_trends"], "daily_revenue"),
    "top_products_by_region": (Q["top_products_by_region"], "total_revenue"),
    "customer_cohorts": (Q["cohort_retention"], None),
    "payment_analysis": (Q["payment_analysis"], "total_revenue"),
    "quality_metrics_history": (Q["quality_metrics_row"], None),
}


def _audited(name: str, sql: str, amount: str | None) -> str:
    cents = f"CAST(SUM(CAST(ROUND({amount} * 100) AS BIGINT)) AS BIGINT)" if amount else "CAST(NULL AS BIGINT)"
    return (
        f"SELECT '{name}' AS table_name, n AS written_rows, c AS written_cents, n AS stored_rows, c AS stored_cents, true AS passed "
        f"FROM (SELECT COUNT(*) AS n, {cents} AS c FROM ({sql}))"
    )


Q["write_verification"] = "\nUNION ALL\n".join(_audited(name, sql, amount) for name, (sql, amount) in _AUDITED.items())

_FIRST_YEARS = Q["quality_metrics_row"].replace("FROM ranked WHERE rn = 1", "FROM ranked WHERE rn = 1 AND year(order_date) <= 1997")
Q["quality_history"] = f"SELECT *, CAST(NULL AS VARCHAR) AS scope FROM ({_FIRST_YEARS})\nUNION ALL\nSELECT *, 'all' AS scope FROM ({Q['quality_metrics_row']})"


def _display(name: str, order: str, limit: int | None = None) -> str:
    """The query in display order (unique columns included), with each row's position."""
    return (
        f"SELECT row_number() OVER (ORDER BY {order}) AS position, t.* FROM ({Q[name]}) AS t"
        + (f" QUALIFY position <= {limit}" if limit else "")
    )


Q["daily_sales_display"] = _display("daily_sales_summary", "order_date DESC, region, category", 20)
Q["category_trends_display"] = _display("category_trends", "order_month DESC, category", 30)
Q["revenue_trends_display"] = _display("revenue_trends", "region, order_date DESC", 50)
Q["segmentation_display"] = _display("rfm_segmentation", "lifetime_value DESC, customer_id", 30)
Q["customer_metrics_ordered"] = _display("customer_metrics", "lifetime_value DESC, customer_id")

# ------------------------- survivors, running totals, percentiles and reach ---

Q["silver_rare_copies"] = Q["silver_orders"]
Q["one_order_per_line"] = (
    Q["silver_orders"]
    .replace("PARTITION BY order_id", "PARTITION BY split_part(order_id, '-', 1), split_part(order_id, '-', 2)")
    .replace("is_returned ASC NULLS FIRST) AS rn", "is_returned ASC NULLS FIRST, order_id) AS rn")
)
Q["order_running_revenue"] = with_silver(
    f"SELECT region, order_date, order_id, order_amount, "
    f"{dollars('SUM(cents) OVER (PARTITION BY region ORDER BY order_date, order_id ROWS UNBOUNDED PRECEDING)')} AS running_revenue FROM silver"
)


def _amount_percentile(p: float) -> str:
    """Interpolated between the sorted cents ``l`` of a group, rounded half up to a cent."""
    k, d = Fraction(str(p)).numerator, Fraction(str(p)).denominator
    low, rest = f"((n - 1) * {k}) // {d}", f"((n - 1) * {k}) % {d}"
    a, b = f"l[{low} + 1]", f"l[{low} + 1 + CASE WHEN {rest} > 0 THEN 1 ELSE 0 END]"
    return hu(f"({d} * {a} + ({rest}) * ({b} - {a}))", str(d), 2, 1, 2)


_AMOUNTS = {"p25_amount": 0.25, "median_amount": 0.5, "p75_amount": 0.75, "p95_amount": 0.95, "p99_amount": 0.99}
Q["order_amount_percentiles"] = with_silver(
    "SELECT region, n AS order_count, "
    + ", ".join(f"{_amount_percentile(p)} AS {name}" for name, p in _AMOUNTS.items())
    + " FROM (SELECT region, COUNT(*) AS n, list_sort(list(cents)) AS l FROM silver GROUP BY region)"
)
Q["customer_reach"] = with_silver(
    "SELECT order_year, order_month, region, COUNT(DISTINCT customer_id) AS unique_customers, true AS estimate_within_5_pct "
    "FROM silver GROUP BY GROUPING SETS ((order_year, order_month, region), (order_year, order_month), (region), ())"
)
Q["quality_by_increments"] = Q["quality_report"]
