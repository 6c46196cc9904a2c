"""Customer-grain gold tables: metrics, RFM segmentation, cohort retention."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.dates import month_start, whole_months_between
from cartwheel.functions.money import money_avg_sql, money_total_sql, pct_sql, sample_stddev_money_sql
from cartwheel.operators.cleaning import as_of_sql
from cartwheel.operators.ranking import exact_ntiles
from cartwheel.operators.sales import exprs


def customer_metrics(silver: DataFrame, as_of: _dt.date | str | None = None) -> DataFrame:
    """One row per customer: recency, frequency, monetary value and spread.

    ``days_since_purchase`` is measured from ``as_of`` (default: today), so a
    fixed ``as_of`` gives reproducible recency.  Single-order customers get a
    NULL standard deviation and a tenure of 0.
    """
    return silver.groupBy("customer_id").agg(
        *exprs(
            "count(1) AS total_purchases",
            "max(order_date) AS last_purchase_date",
            f"datediff({as_of_sql(as_of)}, max(order_date)) AS days_since_purchase",
            f"{money_total_sql('order_amount')} AS lifetime_value",
            f"{money_avg_sql('order_amount')} AS avg_order_value",
            f"{sample_stddev_money_sql('order_amount')} AS order_value_stddev",
            "sum(quantity) AS total_items",
            "min(order_date) AS first_purchase_date",
            "datediff(max(order_date), min(order_date)) AS customer_tenure_days",
            f"{pct_sql('count_if(is_returned = 1)', 'count(1)')} AS return_rate_pct",
        )
    )


# Segment rules, checked in this order; the first match wins (fixed values).
SEGMENT_RULES: Sequence[tuple[str, str]] = (
    ("VIP", "recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4"),
    ("High Value", "recency_score >= 3 AND frequency_score >= 3 AND monetary_score >= 3"),
    ("Loyal", "recency_score >= 3 AND frequency_score >= 3"),
    ("At Risk", "recency_score <= 2"),
    ("Big Spender", "monetary_score >= 4"),
)
DEFAULT_SEGMENT = "Standard"


def customer_segment_sql() -> str:
    branches = " ".join(f"WHEN {cond} THEN '{name}'" for name, cond in SEGMENT_RULES)
    return f"CASE {branches} ELSE '{DEFAULT_SEGMENT}' END"


def rfm_segmentation(
    metrics: DataFrame,
    n: int = 5,
    num_partitions: int | None = None,
) -> DataFrame:
    """RFM scores (NTILE ``n``) and segments from :func:`customer_metrics`.

    Recency: most recent = highest score (ordered by days since purchase,
    descending); frequency and monetary: ascending.  Ties are broken by
    ``customer_id`` so scores are reproducible; each NTILE is computed by the
    distributed scheme of :mod:`cartwheel.operators.ranking`.
    """
    base = metrics.select("customer_id", "total_purchases", "days_since_purchase", "lifetime_value")
    orders = {
        "recency_score": ["-days_since_purchase", "customer_id"],
        "frequency_score": ["total_purchases", "customer_id"],
        "monetary_score": ["lifetime_value", "customer_id"],
    }
    scored = exact_ntiles(base, n, orders, num_partitions)
    return scored.selectExpr(
        "customer_id",
        "recency_score",
        "frequency_score",
        "monetary_score",
        "concat(CAST(recency_score AS STRING), CAST(frequency_score AS STRING), CAST(monetary_score AS STRING))"
        " AS rfm_segment",
        f"{customer_segment_sql()} AS customer_segment",
        "total_purchases",
        "days_since_purchase",
        "lifetime_value",
    )


def cohort_retention(silver: DataFrame, limit: int | None = None) -> DataFrame:
    """Retention by first-purchase month.

    Per (cohort_month, months_since_cohort): ``cohort_size`` = customers active
    at that offset, ``repeat_purchases`` = their orders (the first included),
    ``retention_rate_pct`` = cohort_size / size at offset 0 x 100.

    Plan: orders are first pre-aggregated to one row per (customer, month) —
    partial aggregation collapses even a customer holding a third of all
    orders — and each customer's cohort is the minimum month over *those*
    rows (a window whose groups are bounded by the number of months).  This
    replaces the reference's join of customer metrics back to every order and
    its COUNT(DISTINCT): a customer appears once per active month, so counting
    rows counts distinct customers.  Customers with a NULL id are excluded, as
    the reference's inner join drops them.
    """
    per_month = (
        silver.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id", month_start("order_date").alias("order_month"))
        .agg(F.count(F.lit(1)).alias("__orders"))
    )
    tagged = per_month.withColumn("cohort_month", F.min("order_month").over(Window.partitionBy("customer_id")))
    grid = tagged.groupBy(
        "cohort_month", whole_months_between("cohort_month", "order_month").alias("months_since_cohort")
    ).agg(*exprs("count(1) AS cohort_size", "sum(__orders) AS repeat_purchases"))
    # Offset 0 exists for every cohort (the first purchase is in it); the window
    # holds one row per month offset of one cohort.
    first = "first(cohort_size) OVER (PARTITION BY cohort_month ORDER BY months_since_cohort ASC NULLS LAST)"
    out = grid.withColumn("retention_rate_pct", F.expr(pct_sql("cohort_size", first)))
    if limit is not None:
        out = out.orderBy(F.col("cohort_month").desc(), F.col("months_since_cohort").asc()).limit(limit)
    return out
