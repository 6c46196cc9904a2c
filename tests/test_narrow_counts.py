"""Distinct counts hold, shuffle and store one narrow column at a time."""

from helpers import silver_rows
from pyspark.sql import functions as F

from cartwheel.operators.quality import merged_report, partial_checks, partial_keys, profile, quality_report

ROWS = [{}, {"order_id": "A"}, {"order_id": "A", "customer_id": "C9"}, {"order_id": None}, {"order_id": None, "customer_id": None}, {"region": None}]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_profile_counts_columns_apart(spark):
    s = silver_rows(spark, ROWS).withColumn("order_id", F.when(F.col("unit_price") > 0, F.col("order_id")))
    got, rows = profile(s), s.collect()
    assert "Expand" not in plan(got)
    r = got.first()
    for c in ("order_id", "customer_id", "product_name", "category", "region"):
        assert r[f"distinct_{c}"] == len({x[c] for x in rows}), c
    assert r.duplicate_order_id == len(rows) - r.distinct_order_id
    none = profile(s.where("false")).first()
    assert none.distinct_order_id == none.distinct_region == none.duplicate_order_id == 0
    assert "Expand" not in plan(quality_report(s))


def test_increment_keys_come_from_narrow_distincts(spark):
    s = silver_rows(spark, ROWS)
    keys = partial_keys(s)
    assert "Generate" not in plan(keys)  # no row per column before the grouping
    want = {(c, x[c]) for c in ("order_id", "customer_id") for x in s.collect()}
    got = [tuple(r) for r in keys.collect()]
    assert len(got) == len(want) and set(got) == want
    # two increments with common keys give the report of all rows
    state, both = partial_checks(s).union(partial_checks(s)), keys.union(partial_keys(s))
    whole = quality_report(s.union(s), as_of="2024-03-01")
    assert merged_report(state, both, as_of="2024-03-01").exceptAll(whole).count() == 0
