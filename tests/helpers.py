"""Constants and row builders that the tests share."""

import datetime as dt

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def bronze_rows(spark, rows):
    """Bronze frame from partial dicts (missing fields get defaults)."""
    from cartwheel.schemas import BRONZE

    base = dict(
        order_id="ORD_0000000",
        customer_id="CUST_00001",
        product_name="Laptop",
        category="Computers",
        quantity=1,
        unit_price=100.0,
        order_date=dt.datetime(2024, 1, 10, 12, 0),
        region="North",
        payment_method="UPI",
        delivery_days=5,
        is_returned=0,
    )
    full = []
    for i, r in enumerate(rows):
        d = dict(base, order_id=f"ORD_{i:07d}")
        d.update(r)
        full.append(tuple(d[f.name] for f in BRONZE.fields))
    return spark.createDataFrame(full, BRONZE)


def silver_rows(spark, rows, as_of="2024-03-01"):
    from cartwheel.operators.cleaning import clean_transactions

    return clean_transactions(bronze_rows(spark, rows), as_of=as_of)
