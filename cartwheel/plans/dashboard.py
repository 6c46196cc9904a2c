"""Dashboard datasets (the six tiles the reference names without queries)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.money import money_total_sql
from cartwheel.operators.sales import (
    AVG_AMOUNT,
    RATE,
    REVENUE,
    REVENUE_CENTS,
    exprs,
    product_performance,
    regional_analysis,
    share_of_total,
)


def kpi_summary(silver: DataFrame) -> DataFrame:
    """One row: customers, orders, revenue, average order value, return rate."""
    return silver.agg(
        *exprs(
            "count(DISTINCT customer_id) AS total_customers",
            "count(1) AS total_orders",
            f"{REVENUE} AS total_revenue",
            f"{AVG_AMOUNT} AS avg_order_value",
            f"{RATE} AS return_rate_pct",
        )
    )


def revenue_by_region(silver: DataFrame) -> DataFrame:
    return regional_analysis(silver).select("region", "total_revenue")


def daily_revenue_trend(silver: DataFrame) -> DataFrame:
    return silver.groupBy("order_date").agg(F.expr(f"{REVENUE} AS revenue"))


def top_products(silver: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` products of the revenue ranking: a top-k, then numbered."""
    revenue = silver.groupBy("product_name", "category").agg(*exprs(f"{REVENUE_CENTS} AS __revenue", f"{REVENUE} AS total_revenue"))
    order = [F.col("__revenue").desc(), F.col("product_name").asc_nulls_first(), F.col("category").asc_nulls_first()]
    top = revenue.orderBy(*order).limit(n)
    rank = F.row_number().over(Window.orderBy(*order)).alias("revenue_rank")  # n rows
    return top.select(rank, "product_name", "category", "total_revenue")


def category_distribution(silver: DataFrame) -> DataFrame:
    grouped = silver.groupBy("category").agg(
        *exprs(
            "count(1) AS orders",
            f"{REVENUE} AS revenue",
            f"{REVENUE_CENTS} AS __cents",
        )
    )
    return share_of_total(grouped, "__cents", "pct_of_total_revenue").drop("__cents")


def customer_segments(segmentation: DataFrame) -> DataFrame:
    """Customers and revenue per RFM segment."""
    return segmentation.groupBy("customer_segment").agg(
        *exprs("count(1) AS customers", f"{money_total_sql('lifetime_value')} AS revenue")
    )
