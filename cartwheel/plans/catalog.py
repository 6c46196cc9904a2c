"""Registered queries over the TPC-H-style test tables.

Every query reads the star tables of a scale-factor directory: the star is
mapped to bronze and cleaned to silver, each written once as a layer (see
``plans.pipeline.materialize``), and the query runs its operator on them — so
its work grows with the tables.  ``silver_orders`` itself always rebuilds
silver from the raw tables.  The clock is fixed (``AS_OF``) for reproducible
recency.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.money import cents_sql, dollars_sql
from cartwheel.operators import quality as Q
from cartwheel.operators.cleaning import clean_transactions
from cartwheel.operators.customers import cohort_retention, customer_metrics, rfm_segmentation
from cartwheel.operators.prefix import group_percentiles, running_total
from cartwheel.operators.reach import daily_sketches, measured_rollup
from cartwheel.operators.sales import (
    category_trends,
    daily_sales_summary,
    delivery_performance,
    payment_analysis,
    product_performance,
    regional_analysis,
)
from cartwheel.operators.trends import revenue_trends, top_products_by_group
from cartwheel.plans import dashboard as D
from cartwheel.plans.increments import add_increment, report_of_increments
from cartwheel.plans.pipeline import bronze_layer, layer_root, silver_from_star, silver_layer, stored_pipeline
from cartwheel.plans.presentation import positioned
from cartwheel.plans.validate import REQUIRED_TABLES, acceptance_suite, stored_tables
from cartwheel.sources.tables import append_table, read_table
from cartwheel.sources.verify import AUDIT, write_verification

AS_OF = _dt.date(2002, 1, 1)

# Domains of the star mapping's stand-in columns (fixed values): region is the
# TPC-H region name, payment method the order priority.
STAR_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
STAR_PAYMENT_METHODS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STAR_RULES = Q.QualityRules(valid_regions=STAR_REGIONS, valid_payment_methods=STAR_PAYMENT_METHODS)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written bronze layer (the star mapped to the raw transaction layout)."""
    return bronze_layer(spark, sf_dir)


def silver_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver computed from the raw star tables: joined, typed, filtered and
    de-duplicated on ``order_id`` (no written layer involved)."""
    return silver_from_star(spark, sf_dir, AS_OF)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written silver layer (built once per input and code version), which
    the gold queries scan — as the reference's gold SQL reads its silver table."""
    return silver_layer(spark, sf_dir, AS_OF)


def _on_silver(fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(silver(spark, sf_dir))


def _segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm_segmentation(customer_metrics(silver(spark, sf_dir), AS_OF))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "silver_orders": silver_build,
    "daily_sales_summary": _on_silver(daily_sales_summary),
    "customer_metrics": _on_silver(lambda s: customer_metrics(s, AS_OF)),
    "product_performance": _on_silver(product_performance),
    "regional_analysis": _on_silver(regional_analysis),
    "category_trends": _on_silver(category_trends),
    "category_trends_by_year": _on_silver(lambda s: category_trends(s, by_year=True)),
    "rfm_segmentation": _segmentation,
    "revenue_trends": _on_silver(revenue_trends),
    "top_products_by_region": _on_silver(top_products_by_group),
    "cohort_retention": _on_silver(cohort_retention),
    "delivery_performance": _on_silver(delivery_performance),
    "payment_analysis": _on_silver(payment_analysis),
    "quality_report": _on_silver(lambda s: Q.quality_report(s, STAR_RULES, AS_OF)),
    "quality_metrics_row": _on_silver(lambda s: Q.quality_metrics_row(s, AS_OF, STAR_RULES)),
    "null_profile": _on_silver(Q.null_profile),
    "bronze_null_profile": lambda spark, d: Q.null_profile(bronze(spark, d)),
    "duplicate_count": lambda spark, d: Q.duplicate_count(bronze(spark, d), "order_id"),
    "cleaning_summary": lambda spark, d: Q.cleaning_summary(bronze(spark, d), silver(spark, d)),
    "raw_profile": lambda spark, d: Q.profile(bronze(spark, d)),
    "clean_profile": _on_silver(
        lambda s: Q.profile(
            s,
            non_negative=("order_amount", "unit_price", "quantity"),
            ranges={"delivery_days": (0, 90), "quantity": (1, 10)},
            amount="order_amount",
        )
    ),
    "kpi_summary": _on_silver(D.kpi_summary),
    "revenue_by_region": _on_silver(D.revenue_by_region),
    "daily_revenue_trend": _on_silver(D.daily_revenue_trend),
    "top_products": _on_silver(D.top_products),
    "category_distribution": _on_silver(D.category_distribution),
    "customer_segments": lambda spark, d: D.customer_segments(_segmentation(spark, d)),
    "acceptance_suite": lambda spark, d: acceptance_suite(_pipeline_tables(spark, d)),
    "write_verification": lambda spark, d: _verification(spark, d),
    "quality_history": lambda spark, d: _history(spark, d),
    "daily_sales_display": _on_silver(lambda s: positioned("daily_sales_summary", daily_sales_summary(s), "display")),
    "category_trends_display": _on_silver(lambda s: positioned("category_trends", category_trends(s), "display")),
    "revenue_trends_display": _on_silver(lambda s: positioned("revenue_trends", revenue_trends(s), "display")),
    "segmentation_display": lambda spark, d: positioned("customer_segmentation", _segmentation(spark, d), "display"),
    "quality_by_increments": lambda spark, d: _by_increments(spark, d),
    "silver_rare_copies": lambda spark, d: clean_transactions(bronze(spark, d), AS_OF, rare_copies=True),
    "one_order_per_line": lambda spark, d: _one_per_line(bronze(spark, d)),
    "order_running_revenue": _on_silver(lambda s: _order_running_revenue(s)),
    "order_amount_percentiles": _on_silver(lambda s: _order_amount_percentiles(s)),
    "customer_reach": lambda spark, d: _customer_reach(spark, d),
    "customer_metrics_ordered": _on_silver(lambda s: positioned("customer_metrics", customer_metrics(s, AS_OF))),
}


def _pipeline_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    at = stored_pipeline(spark, sf_dir, AS_OF, STAR_RULES)
    return stored_tables(spark, {name: at[name] for name in REQUIRED_TABLES})


def _verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored tables against the counts that were taken while ``run_pipeline`` wrote them."""
    at = stored_pipeline(spark, sf_dir, AS_OF, STAR_RULES)
    audit = read_table(spark, at[AUDIT])
    return write_verification(audit, stored_tables(spark, {name: where for name, where in at.items() if name != AUDIT}))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality history after two appends to a new table: the first three years of orders, then all of them, the
    second with one more column."""
    s, path = silver(spark, sf_dir), f"{layer_root(spark)}/history-{uuid.uuid4().hex}"
    append_table(Q.quality_metrics_row(s.where("order_year <= 1997"), AS_OF, STAR_RULES), path)
    append_table(Q.quality_metrics_row(s, AS_OF, STAR_RULES).withColumn("scope", F.lit("all")), path)
    return read_table(spark, path, merge_schema=True)


def _one_per_line(bronze: DataFrame) -> DataFrame:
    """Silver with one order per (order key, line number), which repeat in the star with different content."""
    keyed = bronze.withColumn("line_key", F.expr("substring_index(order_id, '-', 2)"))
    return clean_transactions(keyed, AS_OF, dedup_keys=("line_key",), rare_copies=True)


def _order_running_revenue(silver: DataFrame) -> DataFrame:
    """Every order with its region's revenue up to it: groups of a fifth of all rows."""
    total = running_total(silver, ["region"], ["order_date", "order_id"], cents_sql("order_amount"), "__cents")
    return total.selectExpr("region", "order_date", "order_id", "order_amount", f"{dollars_sql('__cents')} AS running_revenue")


def _order_amount_percentiles(silver: DataFrame) -> DataFrame:
    wanted = {"p25_amount": 0.25, "median_amount": 0.5, "p75_amount": 0.75, "p95_amount": 0.95, "p99_amount": 0.99}
    return group_percentiles(silver, ["region"], cents_sql("order_amount"), wanted, scale=2, num_scale=2, count_col="order_count")


def _customer_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers per month and region, month, region and in all: exact, and whether the counts
    rolled up from stored daily sketches come within 5 %."""
    s, path = silver(spark, sf_dir), f"{layer_root(spark)}/reach-{uuid.uuid4().hex}"
    daily_sketches(s).write.parquet(path)
    month = {"order_year": F.year("order_date"), "order_month": F.month("order_date")}
    sets = [["order_year", "order_month", "region"], ["order_year", "order_month"], ["region"], []]
    found = measured_rollup(s, spark.read.parquet(path).withColumns(month), sets)
    return found.select("order_year", "order_month", "region", F.col("exact").alias("unique_customers"), F.col("within").alias("estimate_within_5_pct"))


def _by_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report merged from the stored states of three spans of years, each checked on its own."""
    s, root = silver(spark, sf_dir), f"{layer_root(spark)}/increments-{uuid.uuid4().hex}"
    for name, span in {"a": "order_year <= 1996", "b": "order_year BETWEEN 1997 AND 1999", "c": "order_year >= 2000 OR order_year IS NULL"}.items():
        add_increment(s.where(span), root, name, STAR_RULES)
    return report_of_increments(spark, root, STAR_RULES, AS_OF)
