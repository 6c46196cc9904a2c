"""Hot keys: one order copied into a third of all rows, one customer holding a
third of all orders.  Results are checked against a brute-force pandas
computation on the same small fixture."""

import datetime as dt

import pandas as pd
from helpers import bronze_rows

from cartwheel.operators.cleaning import clean_transactions
from cartwheel.operators.customers import customer_metrics
from cartwheel.operators.sales import regional_analysis


def _fixture(spark):
    rows = []
    for i in range(900):
        if i % 3 == 0:  # copies of one order with varying content
            rows.append({"order_id": "HOT", "product_name": f"P{i % 7}", "quantity": 1 + i % 5,
                         "unit_price": 10.0 + i % 11, "customer_id": "C_HOT"})
        elif i % 3 == 1:  # one customer with many orders
            rows.append({"order_id": f"O{i}", "customer_id": "C_HOT", "unit_price": 5.0 + i % 13,
                         "order_date": dt.datetime(2024, 1, 1 + i % 28)})
        else:
            rows.append({"order_id": f"O{i}", "customer_id": f"C{i % 37}", "unit_price": 1.0 + i % 17})
    return bronze_rows(spark, rows).repartition(6)


def test_hot_order_copies_collapse_to_the_first_survivor(spark):
    b = _fixture(spark)
    silver = clean_transactions(b, as_of="2024-03-01")
    pdf = b.toPandas()
    pdf["unit_price_r"] = pdf.unit_price.round(2)
    pdf["amount"] = (pdf.quantity * pdf.unit_price).round(2)
    hot = pdf[pdf.order_id == "HOT"].sort_values(
        ["customer_id", "product_name", "category", "quantity", "unit_price_r", "amount"]
    ).iloc[0]
    got = silver.filter("order_id = 'HOT'").collect()
    assert len(got) == 1
    assert (got[0].product_name, got[0].quantity, got[0].unit_price) == (hot.product_name, hot.quantity, hot.unit_price_r)
    assert silver.count() == pdf.order_id.nunique()
    # the partial (map-side) limit precedes the exchange on order_id
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_customer_metrics_match_brute_force(spark):
    silver = clean_transactions(_fixture(spark), as_of="2024-03-01")
    m = {r.customer_id: r for r in customer_metrics(silver, "2024-03-01").collect()}
    pdf = silver.toPandas()
    for cid, g in pdf.groupby("customer_id"):
        cents = (g.order_amount * 100).round().astype("int64")
        assert m[cid].total_purchases == len(g)
        assert m[cid].lifetime_value == cents.sum() / 100.0
    reg = regional_analysis(silver).collect()[0]
    assert reg.total_orders == len(pdf) and reg.unique_customers == pdf.customer_id.nunique()
