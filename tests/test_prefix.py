"""Running totals, percentiles, survivors, rolled-up distinct counts, bucketed facts and merged quality states."""

import os
import random
from fractions import Fraction

import pytest
from helpers import SF001, SF01, bronze_rows, silver_rows
from pyspark.sql import functions as F

from cartwheel.operators.cleaning import clean_transactions, dedup_by_key, dedup_rare_copies
from cartwheel.operators.prefix import group_percentiles, running_total
from cartwheel.operators.quality import QualityRules, quality_report
from cartwheel.operators.reach import daily_sketches, measured_rollup
from cartwheel.plans.catalog import AS_OF, silver
from cartwheel.plans.increments import add_increment, report_of_increments
from cartwheel.sources.layout import CatalogTables
from cartwheel.sources.star import bucketed_fact, load_star, transactions_from_star


def groups(n, seed=3):
    """A group with half of all rows, a NULL group, small ones; NULL values; many ties."""
    rnd = random.Random(seed)
    return [("hot" if i % 2 else rnd.choice([None, "a", "b", f"g{i}"]), i, rnd.choice([None, 5, -7, rnd.randrange(10**9)])) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 900])
@pytest.mark.parametrize("parts", [1, 7, 300])
def test_running_total_equals_the_window(spark, n, parts):
    rows = groups(n)
    df = spark.createDataFrame(random.Random(1).sample(rows, n), "g string, o int, v long").repartition(5)
    got = {r.o: r.t for r in running_total(df, ["g"], ["o"], "v", "t", parts).collect()}
    sums, want = {}, {}
    for g, o, v in rows:
        if v is not None:
            sums[g] = (sums.get(g) or 0) + v
        want[o] = sums.get(g)
    assert got == want


def test_running_total_is_split_inside_a_group(spark):
    df = spark.range(4000).selectExpr("'one' AS g", "id AS o", "1L AS v")
    plan = running_total(df, ["g"], ["o"], "v", "t", 8)
    assert [r.t for r in plan.orderBy("o").collect()] == list(range(1, 4001))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window" in line and "windowspecdefinition" in line]
    assert any("__cw_p_range" in line.split("windowspecdefinition(")[1].split("ASC")[0] for line in windows)


@pytest.mark.parametrize("parts", [1, 5, 64])
def test_percentiles_equal_the_sorted_values(spark, parts):
    rows = groups(1200)
    df = spark.createDataFrame([*rows, ("none", 1, None), ("one", 1, 41)], "g string, o int, v long").repartition(4)
    wanted = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r.g: r for r in group_percentiles(df, ["g"], "v", wanted, scale=3, num_partitions=parts).collect()}
    values = {}
    for g, _, v in [*rows, ("none", 1, None), ("one", 1, 41)]:
        values.setdefault(g, []).extend([] if v is None else [v])
    assert set(got) == set(values)
    for g, vs in values.items():
        vs.sort()
        assert got[g].n == len(vs)
        for name, p in wanted.items():
            if not vs:
                assert got[g][name] is None
                continue
            at = Fraction(str(p)) * (len(vs) - 1)
            low = int(at)
            exact = vs[low] + (at - low) * (vs[min(low + 1, len(vs) - 1)] - vs[low])
            assert abs(Fraction(got[g][name]) - exact) <= Fraction(1, 1000)


def test_percentiles_equal_quantile_cont(spark):
    duckdb = pytest.importorskip("duckdb")
    s = silver(spark, SF001)
    got = {r.region: r.p for r in group_percentiles(s, ["region"], "CAST(round(order_amount * 100) AS BIGINT)", {"p": 0.9}, num_scale=2).collect()}
    amounts = s.select("region", "order_amount").toPandas()  # noqa: F841
    for region, p in duckdb.sql("SELECT region, quantile_cont(order_amount, 0.9) FROM amounts GROUP BY region").fetchall():
        assert abs(got[region] - p) <= 0.0051


def test_rare_copies_keep_the_same_survivors(spark):
    rnd = random.Random(5)
    rows = [(None if i % 11 == 0 else i if i % 3 else 7, rnd.randrange(4), rnd.choice([None, "x", "y"])) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, a int, b string")
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(dedup_rare_copies(df, ["k"], ["a", "b"]).collect(), key=key) == sorted(dedup_by_key(df, ["k"], ["a", "b"]).collect(), key=key)
    empty = dedup_rare_copies(df.limit(0), ["k"], ["a", "b"])
    assert empty.count() == 0 and empty.columns == df.columns


def test_rare_copies_shuffle_no_wide_row(spark, tmp_root):
    bronze_rows(spark, [{"order_id": "same" if i < 3 else f"o{i}"} for i in range(50)]).write.parquet(f"{tmp_root}/b")
    out = clean_transactions(spark.read.parquet(f"{tmp_root}/b"), "2024-03-01", rare_copies=True)
    assert out.count() == 48
    out.collect()
    lines = out._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")).splitlines()
    anti = [i for i, line in enumerate(lines) if "LeftAnti" in line]
    assert anti and all("BroadcastHashJoin" in lines[i] for i in anti)


def test_reach_rolls_up_within_its_error(spark):
    s = silver(spark, SF01)
    month = {"order_year": F.year("order_date"), "order_month": F.month("order_date")}
    sets = [["order_year", "order_month", "region"], ["region"], []]
    found = measured_rollup(s, daily_sketches(s).withColumns(month), sets).collect()
    assert all(r.within for r in found) and sum(r.region is None and r.order_year is None for r in found) == 1
    worst = max(abs(r.estimate - r.exact) / r.exact for r in found)
    assert worst <= 0.03, worst
    small = silver_rows(spark, [{"customer_id": None}, {"customer_id": "a"}])
    assert [(r.exact, r.estimate) for r in measured_rollup(small, daily_sketches(small), [[]]).collect()] == [(1, 1)]


def test_bucketed_fact_needs_no_exchange(spark, tmp_root):
    name = f"fact_{os.path.basename(tmp_root).replace('-', '_')}"
    CatalogTables(spark, name, f"{tmp_root}/db")
    star = load_star(spark, SF001)
    stored = bucketed_fact(star, name, 8, f"{tmp_root}/db")
    build = lambda tables: clean_transactions(transactions_from_star(tables, ("l_orderkey",)), AS_OF, dedup_keys=("l_orderkey", "order_id"))
    plain, bucketed = build(star), build(stored)
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" in text(plain)
    assert "hashpartitioning" not in text(bucketed)
    assert sorted(bucketed.collect()) == sorted(plain.collect())
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def test_merged_states_equal_the_full_report(spark, tmp_root):
    rnd = random.Random(9)
    rows = [{"order_id": None if i % 17 == 0 else f"o{i % 40}-{i}" if i % 5 else "dup", "customer_id": rnd.choice([None, "a", "b"]), "region": rnd.choice(["North", "Moon", None]), "quantity": rnd.randrange(1, 14), "unit_price": rnd.choice([1.5, 250000.0, 99.99])} for i in range(120)]
    whole = bronze_rows(spark, rows).selectExpr("*", "round(quantity * unit_price, 2) AS order_amount")
    cut = F.abs(F.hash("order_id", "quantity", "unit_price")) % 3
    for i in range(3):
        add_increment(whole.where(cut == i), tmp_root, f"2024-0{i + 1}")
        if i == 1:
            add_increment(whole.where(cut == i), tmp_root, "2024-02")  # a repeated run replaces its state
    rules = QualityRules()
    assert sorted(map(str, report_of_increments(spark, tmp_root, rules, AS_OF).collect())) == sorted(map(str, quality_report(whole, rules, AS_OF).collect()))
    add_increment(whole.limit(0), tmp_root, "empty")
    assert sorted(map(str, report_of_increments(spark, tmp_root, rules, AS_OF).collect())) == sorted(map(str, quality_report(whole, rules, AS_OF).collect()))
    with pytest.raises(ValueError):
        add_increment(whole, tmp_root, "../x")
