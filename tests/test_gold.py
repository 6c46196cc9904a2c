import datetime as dt

from helpers import silver_rows
from pyspark.sql import functions as F

from cartwheel.operators.customers import SEGMENT_RULES, cohort_retention, customer_metrics, customer_segment_sql, rfm_segmentation
from cartwheel.operators.sales import category_trends, delivery_performance, payment_analysis, product_performance
from cartwheel.operators.trends import revenue_trends, top_products_by_group

D = dt.datetime


def test_one_purchase_customer(spark):
    # one_purchase: stddev NULL, tenure 0
    m = customer_metrics(silver_rows(spark, [{"unit_price": 12.5}]), as_of="2024-03-01").collect()[0]
    assert m.order_value_stddev is None and m.customer_tenure_days == 0
    assert m.total_purchases == 1 and m.lifetime_value == 12.5 and m.days_since_purchase == 51


def test_stddev_and_averages_exact(spark):
    s = silver_rows(spark, [{"unit_price": 1.00}, {"unit_price": 1.01}, {"unit_price": 1.02}])
    m = customer_metrics(s, as_of="2024-03-01").collect()[0]
    assert m.avg_order_value == 1.01 and m.order_value_stddev == 0.01 and m.lifetime_value == 3.03


def test_segment_rules_first_match(spark):
    # rfm_grid: every (R, F, M) in 1..5^3 gets the first matching rule
    rows = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(rows, "recency_score int, frequency_score int, monetary_score int")
    got = {(r.recency_score, r.frequency_score, r.monetary_score): r.seg
           for r in df.withColumn("seg", F.expr(customer_segment_sql())).collect()}

    def expected(r, f, m):
        if r >= 4 and f >= 4 and m >= 4:
            return "VIP"
        if r >= 3 and f >= 3 and m >= 3:
            return "High Value"
        if r >= 3 and f >= 3:
            return "Loyal"
        if r <= 2:
            return "At Risk"
        if m >= 4:
            return "Big Spender"
        return "Standard"

    assert all(got[k] == expected(*k) for k in rows)
    assert [name for name, _ in SEGMENT_RULES] == ["VIP", "High Value", "Loyal", "At Risk", "Big Spender"]


def test_rfm_partitions_customers(spark):
    rows = [{"customer_id": f"C{i % 13}", "unit_price": 10.0 + i, "order_date": D(2024, 1, 1 + i % 28)} for i in range(60)]
    metrics = customer_metrics(silver_rows(spark, rows), as_of="2024-03-01")
    seg = rfm_segmentation(metrics, num_partitions=3)
    out = seg.collect()
    assert len(out) == 13 and len({r.customer_id for r in out}) == 13
    assert all(r.rfm_segment == f"{r.recency_score}{r.frequency_score}{r.monetary_score}" for r in out)
    sizes = sorted(r["count"] for r in seg.groupBy("recency_score").count().collect())
    assert max(sizes) - min(sizes) <= 1


def test_revenue_trends_row_frames(spark):
    # gap_days: d, d+1, d+5 in one region; lag is the previous row, frame is rows
    rows = [
        {"order_date": D(2024, 1, 1), "unit_price": 10.0},
        {"order_date": D(2024, 1, 2), "unit_price": 20.0},
        {"order_date": D(2024, 1, 6), "unit_price": 40.0},
    ]
    t = sorted(revenue_trends(silver_rows(spark, rows), window=2).collect(), key=lambda r: r.order_date)
    assert [r.prev_day_revenue for r in t] == [None, 10.0, 20.0]
    assert [r.cumulative_revenue for r in t] == [10.0, 30.0, 70.0]
    assert [r.revenue_growth_pct for r in t] == [None, 100.0, 100.0]
    assert [r.moving_avg_2day for r in t] == [10.0, 15.0, 30.0]


def test_growth_null_on_zero_previous(spark):
    # zero_prev: daily revenue 0 then 5 -> growth NULL, no error (silver-shaped input)
    base = silver_rows(spark, [{"order_date": D(2024, 1, 1)}, {"order_date": D(2024, 1, 2)}])
    s = base.withColumn("order_amount", F.when(F.col("order_date") == dt.date(2024, 1, 1), 0.0).otherwise(5.0))
    t = sorted(revenue_trends(s).collect(), key=lambda r: r.order_date)
    assert t[1].prev_day_revenue == 0.0 and t[1].revenue_growth_pct is None


def test_cohort_retention_with_missing_month(spark):
    # cohort_3: three customers first buying in January; active again in months 1 and 3
    rows = [
        {"customer_id": "A", "order_date": D(2024, 1, 5)},
        {"customer_id": "B", "order_date": D(2024, 1, 9)},
        {"customer_id": "C", "order_date": D(2024, 1, 20)},
        {"customer_id": "A", "order_date": D(2024, 2, 3)},
        {"customer_id": "A", "order_date": D(2024, 2, 4)},
        {"customer_id": "B", "order_date": D(2024, 4, 1)},
    ]
    out = {r.months_since_cohort: r for r in cohort_retention(silver_rows(spark, rows)).collect()}
    assert sorted(out) == [0, 1, 3]
    assert (out[0].cohort_size, out[0].repeat_purchases, out[0].retention_rate_pct) == (3, 3, 100.0)
    assert (out[1].cohort_size, out[1].repeat_purchases, out[1].retention_rate_pct) == (1, 2, 33.33)
    assert (out[3].cohort_size, out[3].retention_rate_pct) == (1, 33.33)
    assert all(r.cohort_month == dt.date(2024, 1, 1) for r in out.values())


def test_category_trends_year_wrap(spark):
    # year_wrap: the same month of two years is merged unless by_year
    rows = [{"order_date": D(2023, 5, 1)}, {"order_date": D(2024, 5, 1)}]
    merged = category_trends(silver_rows(spark, rows)).collect()
    assert len(merged) == 1 and merged[0].order_count == 2 and merged[0].month_rank == 1
    split = category_trends(silver_rows(spark, rows), by_year=True).collect()
    ranks = {r.order_year: r.month_rank for r in split}
    assert ranks == {2024: 1, 2023: 2}


def test_interpolated_percentiles(spark):
    # pct_small: 1,2,3,4 -> median 2.5; p75 3.25 -> 3.3; p95 3.85 -> 3.9
    rows = [{"delivery_days": d} for d in (1, 2, 3, 4)]
    out = delivery_performance(silver_rows(spark, rows)).collect()
    by_type = {r.delivery_type: r for r in out}
    assert by_type["Express"].median_delivery_days == 2.0  # 1,2,3
    rows = [{"delivery_days": d} for d in (8, 9, 10, 11)]
    r = delivery_performance(silver_rows(spark, rows)).collect()[0]
    assert (r.median_delivery_days, r.p75_delivery_days, r.p95_delivery_days) == (9.5, 10.3, 10.9)
    assert (r.min_delivery_days, r.max_delivery_days, r.avg_delivery_days, r.order_count) == (8, 11, 9.5, 4)


def test_percentile_matches_spark_percentile(spark):
    import random

    rnd = random.Random(3)
    rows = [{"delivery_days": rnd.randint(8, 30), "region": rnd.choice("AB")} for _ in range(301)]
    s = silver_rows(spark, rows)
    ours = {r.region: r for r in delivery_performance(s).collect()}
    ref = s.groupBy("region").agg(F.percentile("delivery_days", 0.95).alias("p")).collect()
    for r in ref:
        assert abs(ours[r.region].p95_delivery_days - r.p) <= 0.05 + 1e-9


def test_top_products_exactly_n(spark):
    rows = [{"product_name": f"P{i}", "unit_price": 10.0 + i, "region": "North"} for i in range(8)]
    out = top_products_by_group(silver_rows(spark, rows), n=5).collect()
    assert sorted(r.rank_in_region for r in out) == [1, 2, 3, 4, 5]
    assert max(out, key=lambda r: r.total_revenue).rank_in_region == 1


def test_product_rank_and_payment_share(spark):
    rows = [{"product_name": f"P{i % 4}", "unit_price": 10.0 * (i + 1), "payment_method": "UPI" if i % 3 else "Wallet"}
            for i in range(12)]
    s = silver_rows(spark, rows)
    pp = product_performance(s, num_partitions=3).collect()
    ranks = sorted(pp, key=lambda r: r.revenue_rank)
    assert [r.revenue_rank for r in ranks] == [1, 2, 3, 4]
    assert all(a.total_revenue >= b.total_revenue for a, b in zip(ranks, ranks[1:]))
    share = sum(r.pct_of_total_revenue for r in payment_analysis(s).collect())
    assert abs(share - 100.0) <= 0.01


def test_percentiles_ignore_null_days(spark):
    rows = [{"delivery_days": d} for d in (8, 9, 10, 11, None)]
    out = {r.delivery_type: r for r in delivery_performance(silver_rows(spark, rows)).collect()}
    r = out["Standard"]  # NULL days classify as Standard
    assert r.order_count == 5 and r.median_delivery_days == 9.5 and r.avg_delivery_days == 9.5
    assert (r.min_delivery_days, r.max_delivery_days) == (8, 11)


def test_presentation_order_and_limit(spark):
    from cartwheel.plans.presentation import REFERENCE_ORDER, present
    from cartwheel.operators.sales import daily_sales_summary

    rows = [{"order_date": D(2024, 1, d % 28 + 1), "region": r, "unit_price": 5.0 + d}
            for d in range(40) for r in ("North", "South")]
    daily = daily_sales_summary(silver_rows(spark, rows))
    shown = present("daily_sales_summary", daily, "display").collect()
    assert len(shown) == 20
    keys = [(r.order_date, r.region) for r in shown]
    assert keys == sorted(keys, key=lambda k: (-k[0].toordinal(), k[1]))
    assert present("daily_sales_summary", daily).count() == daily.count()
    assert present("daily_sales_summary", daily, 0).count() == 0
    plan = present("daily_sales_summary", daily, "display")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert set(REFERENCE_ORDER) >= {"payment_analysis", "customer_cohorts", "revenue_trends"}


def test_optional_limits(spark):
    rows = [{"order_date": D(2024, 1 + m % 3, 1 + d), "region": r, "customer_id": f"C{d % 5}"}
            for m in range(3) for d in range(20) for r in ("North", "East")]
    s = silver_rows(spark, rows)
    full = revenue_trends(s).count()
    lim = revenue_trends(s, limit=7).collect()
    assert len(lim) == 7 < full
    assert all(r.region == "East" for r in lim)  # region ascending first
    assert [r.order_date for r in lim] == sorted((r.order_date for r in lim), reverse=True)
    coh = cohort_retention(s, limit=2).collect()
    assert len(coh) == 2 and coh[0].cohort_month == max(r.cohort_month for r in cohort_retention(s).collect())
