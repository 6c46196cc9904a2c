import datetime as dt

from helpers import bronze_rows, silver_rows
from pyspark.sql import functions as F

from cartwheel.operators.quality import QualityRules, duplicate_count, null_profile, profile, quality_metrics_row, quality_report


def test_null_profile_counts_every_row(spark):
    # null_second_row: only row 2 has a NULL; the reference's first-row check missed it
    b = bronze_rows(spark, [{}, {"region": None}, {}])
    prof = {r.column_name: r for r in null_profile(b).collect()}
    assert prof["region"].null_count == 1 and prof["region"].null_pct == 33.33
    assert prof["order_id"].null_count == 0 and prof["order_id"].total_records == 3


def test_duplicate_count_counts_null_key_once(spark):
    b = bronze_rows(spark, [{"order_id": "A"}, {"order_id": "A"}, {"order_id": None}, {"order_id": None}])
    r = duplicate_count(b).collect()[0]
    assert (r.total_rows, r.distinct_keys, r.duplicate_count) == (4, 2, 2)


def _bad_silver(spark):
    # dq_bad: one violation per rule on top of a clean row
    good = {}
    bad = [
        {"quantity": 11},  # quantity out of range
        {"region": "Nowhere"},
        {"payment_method": "Cash"},
        {"unit_price": 250000.0},
        {"delivery_days": 95},
    ]
    s = silver_rows(spark, [good, *bad])
    # negative amount and amount mismatch cannot pass cleaning: inject them directly
    s = s.withColumn(
        "order_amount",
        F.when(F.col("order_id") == "ORD_0000000", -1.0).otherwise(F.col("order_amount")),
    )
    extra = silver_rows(spark, [{"unit_price": 10.0}]).withColumn("order_id", F.lit("MISMATCH")).withColumn(
        "order_amount", F.lit(99.0)
    )
    dup = silver_rows(spark, [{}]).withColumn("order_id", F.lit("ORD_0000001"))
    return s.unionByName(extra).unionByName(dup)


def test_report_counts_each_violation_once(spark):
    rep = {(r.check_name, r.column_name): r for r in quality_report(_bad_silver(spark), QualityRules(), "2024-03-01").collect()}
    expect_one = [
        ("negative_amount", "order_amount"),
        ("quantity_out_of_range", "quantity"),
        ("invalid_region", "region"),
        ("invalid_payment_method", "payment_method"),
        ("max_unit_price", "unit_price"),
        ("max_delivery_days", "delivery_days"),
        ("duplicate_key", "order_id"),
    ]
    for key in expect_one:
        assert rep[key].violations == 1, key
        assert rep[key].passed is False
    # the negative-amount row also mismatches quantity x price
    assert rep[("amount_mismatch", "order_amount")].violations == 2
    assert rep[("total_records", None)].metric_value == 8.0
    assert rep[("null_count", "region")].violations == 0 and rep[("null_count", "region")].passed is True
    assert rep[("data_freshness_days", "order_date")].metric_value == 51.0


def test_amount_check_allows_rounding(spark):
    s = silver_rows(spark, [{"quantity": 3, "unit_price": 0.105}])  # amount 0.32 vs 3 x 0.11
    rep = {r.check_name: r for r in quality_report(s).collect()}
    assert rep["amount_mismatch"].violations == 0


def test_metrics_row(spark):
    s = silver_rows(spark, [{}, {}, {"customer_id": "CUST_00002"}])
    r = quality_metrics_row(s, as_of="2024-03-01").collect()[0]
    assert (r.total_records, r.unique_customers, r.null_count, r.duplicate_count) == (3, 2, 0, 0)
    assert r.data_freshness_days == 51 and r.check_date == dt.datetime(2024, 3, 1)
    assert 0 < r.quality_score_pct <= 100


def test_profile_one_row(spark):
    b = bronze_rows(spark, [{"unit_price": 1.0}, {"unit_price": 3.0, "region": None}])
    r = profile(b).collect()[0]
    assert r.record_count == 2 and r.null_total == 1 and r.avg_unit_price == 2.0
    assert r.distinct_region == 2  # NULL counts as a value, as distinct().count() does


def test_cleaning_summary(spark):
    from cartwheel.operators.cleaning import clean_transactions
    from cartwheel.operators.quality import cleaning_summary
    from cartwheel.sources.tables import records_to_frame

    b = records_to_frame(spark, [
        {"order_id": "A", "quantity": 1, "unit_price": 5.0},
        {"order_id": "A", "quantity": 2, "unit_price": 5.0},
        {"order_id": "B", "quantity": 0, "unit_price": 5.0},
    ])
    r = cleaning_summary(b, clean_transactions(b)).collect()[0]
    assert (r.bronze_rows, r.silver_rows, r.rows_removed) == (3, 1, 2)
