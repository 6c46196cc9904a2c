"""Distributed synthetic transaction source (the reference's generator, re-aimed).

The reference builds 50,000 dicts in a driver loop and ships them with
``createDataFrame``.  Here rows are a projection of ``spark.range(n)``: every
random draw is a hash of ``(id, seed, draw)``, so a row's values depend only
on its id — the same table for any partitioning, and a lost partition is
recomputed identically.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Reference data pools (fixed values).
PRODUCTS = (
    "Laptop", "Desktop", "Monitor", "Keyboard", "Mouse",
    "Headphones", "Speaker", "Webcam", "Phone", "Tablet",
    "Charger", "Cable", "Dock", "Stand", "Mousepad",
)
CATEGORY_OF = {
    "Laptop": "Computers", "Desktop": "Computers", "Monitor": "Computers",
    "Phone": "Mobile", "Tablet": "Mobile",
    "Keyboard": "Peripherals", "Mouse": "Peripherals", "Headphones": "Peripherals",
    "Speaker": "Peripherals", "Webcam": "Peripherals",
    "Charger": "Accessories", "Cable": "Accessories", "Dock": "Accessories",
    "Stand": "Accessories", "Mousepad": "Accessories",
}
PRICE_RANGE = {
    "Computers": (15000.0, 150000.0),
    "Mobile": (10000.0, 80000.0),
    "Peripherals": (1000.0, 10000.0),
    "Accessories": (100.0, 5000.0),
}
REGIONS = ("North", "South", "East", "West", "Central")
PAYMENT_METHODS = ("Credit Card", "Debit Card", "UPI", "Wallet", "Net Banking")
RETURN_PROBABILITY = 0.25
MAX_QUANTITY = 5
MAX_DELIVERY_DAYS = 30
DAYS_BACK = 90
CUSTOMERS = 5000

_TWO53 = float(2**53)


def _uniform(seed: int, draw: int) -> Column:
    """U[0,1) from a hash of (id, seed, draw)."""
    h = F.xxhash64(F.col("id"), F.lit(seed), F.lit(draw))
    return F.pmod(h, F.lit(2**53)).cast("double") / _TWO53


def _pick(values, u: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(u * len(values)) + 1).cast("int"))


def generate_transactions(
    spark: SparkSession,
    n: int = 50_000,
    seed: int = 42,
    as_of: _dt.datetime | None = None,
    customers: int = CUSTOMERS,
    num_partitions: int | None = None,
) -> DataFrame:
    """Bronze-layout transactions: ``order_id`` ORD_0000000…, uniform customers,
    product -> category -> price band, 1–5 units, date within ``DAYS_BACK`` days
    before ``as_of``, 1–30 delivery days, returned with probability 0.25."""
    as_of = as_of or _dt.datetime.combine(_dt.date.today(), _dt.time())
    base = spark.range(0, n, 1, num_partitions) if num_partitions else spark.range(n)
    product = _pick(PRODUCTS, _uniform(seed, 1))
    category = F.create_map(*[F.lit(x) for kv in CATEGORY_OF.items() for x in kv])[product]
    lo = F.create_map(*[F.lit(x) for c, (a, _) in PRICE_RANGE.items() for x in (c, a)])
    hi = F.create_map(*[F.lit(x) for c, (_, b) in PRICE_RANGE.items() for x in (c, b)])
    with_cat = base.withColumn("product_name", product).withColumn("category", category)
    price = F.round(lo[F.col("category")] + _uniform(seed, 2) * (hi[F.col("category")] - lo[F.col("category")]), 2)
    days_back = F.floor(_uniform(seed, 3) * (DAYS_BACK + 1)).cast("int")
    return with_cat.select(
        F.format_string("ORD_%07d", F.col("id")).alias("order_id"),
        F.format_string("CUST_%05d", (F.floor(_uniform(seed, 4) * customers) + 1).cast("long")).alias("customer_id"),
        "product_name",
        "category",
        (F.floor(_uniform(seed, 5) * MAX_QUANTITY) + 1).cast("long").alias("quantity"),
        price.alias("unit_price"),
        (F.lit(as_of).cast("timestamp") - F.make_dt_interval(days_back)).alias("order_date"),
        _pick(REGIONS, _uniform(seed, 6)).alias("region"),
        _pick(PAYMENT_METHODS, _uniform(seed, 7)).alias("payment_method"),
        (F.floor(_uniform(seed, 8) * MAX_DELIVERY_DAYS) + 1).cast("long").alias("delivery_days"),
        F.when(_uniform(seed, 9) < RETURN_PROBABILITY, 1).otherwise(0).cast("long").alias("is_returned"),
    )
