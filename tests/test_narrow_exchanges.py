"""What is shuffled for the stored pipeline: hashes of keys, (group, customer) pairs and narrow line items."""

import pytest
from helpers import SF001, bronze_rows, silver_rows
from pyspark.sql import functions as F

from cartwheel.operators import cleaning
from cartwheel.operators.cleaning import clean_transactions, dedup_by_key, dedup_measured, surplus_rows
from cartwheel.operators.quality import quality_metrics_row, quality_report
from cartwheel.operators.sales import category_trends, daily_sales_summary, payment_analysis, product_performance, regional_analysis
from cartwheel.sources.star import load_star, transactions_from_star

TABLES = (daily_sales_summary, product_performance, category_trends, regional_analysis, payment_analysis)
ROWS = [
    {"customer_id": c, "category": g, "product_name": p, "region": r, "payment_method": m, "unit_price": price}
    for i, price in enumerate((3.0, 11.5, 7.25))
    for c in ("C1", "C2", None)
    for g, p in (("A", "x"), ("A", None), (None, "x"))
    for r, m in (("N", "UPI"), (None, None))
    if (i, c) != (1, "C2")
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("make", TABLES)
def test_customers_are_shuffled_apart_from_the_aggregates(spark, make):
    keyed = [line for line in plan(make(silver_rows(spark, ROWS))).splitlines() if "HashAggregate(keys=[" in line and "customer_id" in line.split("functions=")[0]]
    assert keyed and all("functions=[]" in line for line in keyed)


@pytest.mark.parametrize("make", TABLES)
def test_distinct_customers_with_null_groups(spark, make):
    s = silver_rows(spark, ROWS).persist()
    got = make(s).collect()
    name = "unique_users" if "unique_users" in make(s).columns else "unique_customers"
    group = {daily_sales_summary: ["order_date", "region", "category"], product_performance: ["product_name", "category"], category_trends: ["order_month", "category"], regional_analysis: ["region"], payment_analysis: ["payment_method"]}[make]
    want = {}
    for r in s.collect():
        want.setdefault(tuple(r[g] for g in group), set()).add(r.customer_id)
    assert {tuple(r[g] for g in group): r[name] for r in got} == {k: len(v - {None}) for k, v in want.items()}
    assert len(got) == len(want)
    none = make(s.where("customer_id IS NULL")).collect()
    assert none and all(r[name] == 0 for r in none)


@pytest.mark.parametrize("shared", [False, True])
def test_keys_that_share_a_hash_stay_apart(spark, monkeypatch, shared):
    if shared:  # all keys of one length get one hash
        monkeypatch.setattr(cleaning.F, "xxhash64", lambda *c: F.coalesce(F.length(c[0]), F.lit(-1)).cast("long"))
    b = bronze_rows(spark, [{"order_id": k, "quantity": q} for k, q in (("A", 2), ("B", 3), ("A", 1), ("CC", 1), (None, 5), (None, 4), ("DDD", 1))])
    got, want = dedup_measured(b, ["order_id"], ["quantity"]), dedup_by_key(b, ["order_id"], ["quantity"])
    assert got.count() == want.count() == 5 and got.exceptAll(want).count() == 0
    assert surplus_rows(b, ["order_id"]) == 2
    once = b.where("quantity <> 2 AND quantity <> 5")
    assert surplus_rows(once, ["order_id"]) == 0 and dedup_measured(once, ["order_id"], ["quantity"]).count() == 5


def test_no_wide_key_is_shuffled_to_find_copies(spark, monkeypatch):
    kind = type(spark.range(1))
    seen, counted = [], kind.persist
    monkeypatch.setattr(kind, "persist", lambda df, *a: (seen.append(plan(df)), counted(df, *a))[1])
    b = bronze_rows(spark, [{} for _ in range(4)])
    assert clean_transactions(b, as_of="2024-03-01", rare_copies=None).count() == 4
    exchanges = [line for line in seen[0].splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("order_id" in line for line in exchanges)


@pytest.mark.parametrize("most", [100_000, 1])
def test_measured_report_is_the_report(spark, monkeypatch, most):
    monkeypatch.setattr(cleaning, "RARE_KEYS", most)
    s = silver_rows(spark, ROWS)
    k = "CASE WHEN unit_price > 11 THEN NULL WHEN unit_price > 7 THEN region ELSE order_id END AS order_id"
    s = s.selectExpr(k, *s.columns[1:])
    want, got = quality_report(s, as_of="2024-03-01"), quality_report(s, as_of="2024-03-01", measured=True)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    row = quality_metrics_row(s, "2024-03-01", measured=True).first()
    assert row == quality_metrics_row(s, "2024-03-01").first() and row.duplicate_count == s.count() - s.select("order_id").distinct().count() > 0


def test_line_items_are_narrow_before_the_exchange(spark):
    text = plan(transactions_from_star(load_star(spark, SF001)))
    wide = [line for line in text.splitlines() if "l_returnflag" in line or "l_shipdate" in line]
    assert wide and all("__returned" in line or "Scan" in line or "Filter" in line for line in wide)
    joins = [line for line in text.splitlines() if "Project" in line and "o_orderdate" in line and "l_linenumber" in line]
    assert joins and not any("l_shipdate" in line for line in joins)
