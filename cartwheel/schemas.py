"""Declared schemas of the layers (no inference from driver-side records)."""

from __future__ import annotations

from pyspark.sql import types as T

BRONZE = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("order_date", T.TimestampType()),
        T.StructField("region", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("delivery_days", T.LongType()),
        T.StructField("is_returned", T.LongType()),
    ]
)

BRONZE_COLUMNS = [f.name for f in BRONZE.fields]

SILVER_COLUMNS = [
    "order_id",
    "customer_id",
    "product_name",
    "category",
    "quantity",
    "unit_price",
    "order_date",
    "region",
    "payment_method",
    "delivery_days",
    "is_returned",
    "order_amount",
    "order_year",
    "order_month",
    "day_of_week",
    "week_of_year",
    "order_size",
    "order_value_segment",
    "delivery_type",
    "processing_date",
]

# Silver content columns in the order that decides which duplicate survives:
# the first row by this order (NULLs first) is kept.  Every silver column is a
# function of these, so ties are identical rows.
SURVIVOR_ORDER = [
    "customer_id",
    "product_name",
    "category",
    "quantity",
    "unit_price",
    "order_amount",
    "order_date",
    "region",
    "payment_method",
    "delivery_days",
    "is_returned",
]

QUALITY_HISTORY = T.StructType(
    [
        T.StructField("check_date", T.TimestampNTZType()),
        T.StructField("total_records", T.LongType()),
        T.StructField("unique_customers", T.LongType()),
        T.StructField("null_count", T.LongType()),
        T.StructField("duplicate_count", T.LongType()),
        T.StructField("data_freshness_days", T.LongType()),
        T.StructField("quality_score_pct", T.DoubleType()),
    ]
)

QUALITY_REPORT = T.StructType(
    [
        T.StructField("dimension", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("violations", T.LongType()),
        T.StructField("total", T.LongType()),
        T.StructField("passed", T.BooleanType()),
    ]
)
