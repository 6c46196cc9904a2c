"""Gold sales tables over the silver order table.

Every money total is an exact decimal sum; every rounded figure is an exact
half-up quotient (``cartwheel.functions.money``).  Aggregates are written as
Spark SQL expressions (one JVM call each).  No operator sorts its output:
``ORDER BY`` inside a table creation fixes no stored order, so callers sort
on read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.money import cents_sql, dollars_sql, half_up_ratio_sql, money_avg_sql, pct_sql, sum_cents_sql
from cartwheel.operators.ranking import global_row_number
from cartwheel.operators.stats import percentile_columns
from cartwheel.session import shuffle_partitions

ORDERS = "count(1)"
RETURNED = "count_if(is_returned = 1)"
RATE = pct_sql(RETURNED, ORDERS)
AMOUNT_CENTS = cents_sql("order_amount")
REVENUE_CENTS = sum_cents_sql("order_amount")
RETURNED_CENTS = f"sum(CASE WHEN is_returned = 1 THEN {AMOUNT_CENTS} ELSE 0 END)"
REVENUE = dollars_sql(REVENUE_CENTS)
AVG_AMOUNT = money_avg_sql("order_amount")


def distinct_customers(approx: bool = False, rsd: float = 0.05) -> str:
    """Distinct customers of a group: exact by default; HyperLogLog (relative
    standard deviation ``rsd``) when ``approx`` — one fixed-size sketch per
    group instead of a (group, customer) shuffle.  Worth it for few groups
    with very many customers each (regions, payment methods); with many small
    groups the per-group sketch costs more than the exact plan."""
    return f"approx_count_distinct(customer_id, {rsd})" if approx else "count(DISTINCT customer_id)"


def exprs(*sql: str) -> list[Column]:
    """SQL expression strings (``expr AS name``) as Columns."""
    return [F.expr(s) for s in sql]


def with_customers(silver: DataFrame, group: Sequence[str], sql: Sequence[str], approx: bool = False, crowded: bool = False) -> DataFrame:
    """One row per ``group``: the aggregates ``sql`` and ``__customers``, its distinct customers.

    Exact counts are taken apart from the other aggregates, which collapse map-side to a row per group: only
    (group, customer) pairs are shuffled, without a buffer for each of the other aggregates.  ``crowded``: a customer
    comes many times to a group (few groups), so pairs collapse map-side too; else most pairs are new, and a map-side
    hash map of a whole file split would only spill.  NULL keys are a group; ``silver`` is read twice."""
    if approx:
        return silver.groupBy(*group).agg(*exprs(*sql, f"{distinct_customers(True)} AS __customers"))
    return _join_customers(silver.groupBy(*group).agg(*exprs(*sql)), silver, group, crowded)


def _join_customers(grouped: DataFrame, silver: DataFrame, group: Sequence[str], crowded: bool) -> DataFrame:
    pairs = silver.where("customer_id IS NOT NULL").select(*group, "customer_id")
    if not crowded:
        pairs = pairs.repartition(shuffle_partitions(silver.sparkSession), *group, "customer_id")
    counts = pairs.distinct().groupBy(*(F.col(g).alias(f"__{g}") for g in group)).agg(F.count(F.lit(1)).alias("__n"))
    same = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group]
    out = grouped.join(counts, same, "left").withColumn("__customers", F.coalesce("__n", F.lit(0).cast("long")))
    return out.select(*grouped.columns, "__customers")


def daily_sales_summary(silver: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """One row per (order_date, region, category)."""
    group = ["order_date", "region", "category"]
    found = with_customers(
        silver,
        group,
        [
            f"{ORDERS} AS total_orders",
            f"{REVENUE} AS total_revenue",
            f"{AVG_AMOUNT} AS avg_order_value",
            "min(order_amount) AS min_order_value",
            "max(order_amount) AS max_order_value",
            "sum(quantity) AS total_units_sold",
            f"{dollars_sql(RETURNED_CENTS)} AS returned_amount",
            f"{RATE} AS return_rate_pct",
        ],
        approx_distinct,
    )
    return found.selectExpr(
        *group,
        "total_orders",
        "__customers AS unique_customers",
        "total_revenue",
        "avg_order_value",
        "min_order_value",
        "max_order_value",
        "total_units_sold",
        "returned_amount",
        "return_rate_pct",
    )


def product_performance(
    silver: DataFrame, num_partitions: int | None = None, approx_distinct: bool = False
) -> DataFrame:
    """One row per (product_name, category) with a global revenue rank.

    ``revenue_rank`` orders by the exact (unrounded) revenue, ties broken by
    product then category, and is computed without a single-partition window.
    """
    group = ["product_name", "category"]
    sql = [
        f"{ORDERS} AS times_purchased",
        "sum(quantity) AS total_units_sold",
        f"{REVENUE_CENTS} AS __revenue",
        f"{AVG_AMOUNT} AS avg_order_value",
        f"{half_up_ratio_sql('sum(quantity)', 'count(quantity)', 2)} AS avg_units_per_order",
        "min(order_amount) AS min_order_value",
        "max(order_amount) AS max_order_value",
        f"{RATE} AS return_rate_pct",
        f"{half_up_ratio_sql(REVENUE_CENTS, 'sum(quantity)', 2, num_scale=2)} AS revenue_per_unit",
    ]
    if approx_distinct:
        agg = with_customers(silver, group, sql, True)
    else:
        agg = silver.groupBy(*group).agg(*exprs(*sql))
    ranked = global_row_number(
        agg,
        ["-__revenue", "product_name", "category"],
        "revenue_rank",
        num_partitions=num_partitions,
    )
    if not approx_distinct:  # after the ranks, which read their input three times
        ranked = _join_customers(ranked, silver, group, crowded=False)
    return ranked.selectExpr(
        "product_name",
        "category",
        "times_purchased",
        "__customers AS unique_customers",
        "total_units_sold",
        f"{dollars_sql('__revenue')} AS total_revenue",
        "avg_order_value",
        "avg_units_per_order",
        "min_order_value",
        "max_order_value",
        "return_rate_pct",
        "revenue_per_unit",
        "revenue_rank",
    )


def regional_analysis(silver: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """One row per region."""
    found = with_customers(
        silver,
        ["region"],
        [
            f"{ORDERS} AS total_orders",
            f"{REVENUE_CENTS} AS __cents",
            f"{AVG_AMOUNT} AS avg_order_value",
            f"{half_up_ratio_sql('sum(delivery_days)', 'count(delivery_days)', 1)} AS avg_delivery_days",
            f"{RATE} AS return_rate_pct",
            "sum(quantity) AS total_units_sold",
        ],
        approx_distinct,
        crowded=True,
    )
    return found.selectExpr(
        "region",
        "total_orders",
        "__customers AS unique_customers",
        f"{dollars_sql('__cents')} AS total_revenue",
        "avg_order_value",
        "avg_delivery_days",
        f"{half_up_ratio_sql('__cents', '__customers', 2, num_scale=2)} AS revenue_per_customer",
        "return_rate_pct",
        "total_units_sold",
    )


def category_trends(silver: DataFrame, by_year: bool = False, approx_distinct: bool = False) -> DataFrame:
    """One row per (order_month, category); ``month_rank`` 1 = latest month.

    As in the reference, ``order_month`` carries no year, so the same month of
    different years is merged; ``by_year=True`` keeps years apart (adds
    ``order_year`` and ranks by year, then month).
    """
    keys = (["order_year"] if by_year else []) + ["order_month", "category"]
    found = with_customers(
        silver,
        keys,
        [f"{ORDERS} AS order_count", f"{REVENUE} AS monthly_revenue", f"{AVG_AMOUNT} AS avg_order_value"],
        approx_distinct,
    )
    agg = found.selectExpr(*keys, "order_count", "__customers AS unique_customers", "monthly_revenue", "avg_order_value")
    # One row per month (x year) per category: a bounded window partition.
    order = ([F.col("order_year").desc()] if by_year else []) + [F.col("order_month").desc()]
    return agg.withColumn("month_rank", F.row_number().over(Window.partitionBy("category").orderBy(*order)))


def delivery_performance(silver: DataFrame) -> DataFrame:
    """One row per (region, delivery_type) with exact delivery-day percentiles.

    Everything is computed from a (group, delivery_days) histogram, which is
    partial-aggregated before its shuffle: its size is groups x distinct day
    values, whatever the row count or skew.
    """
    group = ["region", "delivery_type"]
    hist = silver.groupBy(*group, "delivery_days").agg(
        *exprs("count(1) AS __rows", f"{REVENUE_CENTS} AS __revenue")
    )
    out = percentile_columns(
        hist,
        group,
        "delivery_days",
        "__rows",
        {"median_delivery_days": 0.5, "p75_delivery_days": 0.75, "p95_delivery_days": 0.95},
        scale=1,
        extra=[
            "sum(__rows) AS order_count",
            half_up_ratio_sql("sum(delivery_days * __rows)", "sum(CASE WHEN delivery_days IS NOT NULL THEN __rows END)", 1)
            + " AS avg_delivery_days",
            "min(delivery_days) AS min_delivery_days",
            "max(delivery_days) AS max_delivery_days",
            f"{dollars_sql('sum(__revenue)')} AS total_revenue",
        ],
    )
    return out.select(
        *group,
        "order_count",
        "avg_delivery_days",
        "min_delivery_days",
        "max_delivery_days",
        "median_delivery_days",
        "p75_delivery_days",
        "p95_delivery_days",
        "total_revenue",
    )


def share_of_total(grouped: DataFrame, part_cents: str, out_col: str, scale: int = 2) -> DataFrame:
    """``part * 100 / sum(part)`` over a grouped frame (one row per group).

    The grand total is a window over the *group rows* — no second scan of the
    detail table as a scalar subquery would do."""
    return grouped.withColumn(out_col, F.expr(pct_sql(part_cents, f"sum({part_cents}) OVER ()", scale)))


def payment_analysis(silver: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """One row per payment method, with its share of total revenue."""
    found = with_customers(
        silver,
        ["payment_method"],
        [
            f"{ORDERS} AS transaction_count",
            f"{AVG_AMOUNT} AS avg_transaction_value",
            f"{RATE} AS return_rate_pct",
            f"{half_up_ratio_sql('sum(delivery_days)', 'count(delivery_days)', 1)} AS avg_delivery_days",
            f"{REVENUE_CENTS} AS __cents",
        ],
        approx_distinct,
        crowded=True,
    )
    agg = found.selectExpr(
        "payment_method",
        "transaction_count",
        "__customers AS unique_users",
        f"{dollars_sql('__cents')} AS total_revenue",
        "avg_transaction_value",
        "return_rate_pct",
        "avg_delivery_days",
        f"{half_up_ratio_sql('__cents', '__customers', 2, num_scale=2)} AS revenue_per_customer",
        "__cents",
    )
    return share_of_total(agg, "__cents", "pct_of_total_revenue").drop("__cents")
