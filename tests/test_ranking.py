import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators.ranking import exact_ntile, global_row_number, ntile_of_rank, top_n_per_group


KEYS = ["-v", "cid"]


def frame(spark, n, distinct_values, seed=7):
    rnd = random.Random(seed)
    rows = [(f"c{i:05d}", rnd.randrange(distinct_values)) for i in range(n)]
    return spark.createDataFrame(rows, "cid string, v int")


@pytest.mark.parametrize("n", [0, 1, 3, 7, 1503])
@pytest.mark.parametrize("parts", [1, 4, 9])
def test_exact_ntile_matches_spark_ntile(spark, n, parts):
    df = frame(spark, n, distinct_values=5)  # heavy ties: one value holds ~1/5 of rows
    order = [F.col("v").desc(), F.col("cid").asc()]
    ours = exact_ntile(df, 5, KEYS, "b", num_partitions=parts)
    ref = df.withColumn("b", F.ntile(5).over(Window.orderBy(*order)))
    assert sorted(ours.collect()) == sorted(ref.collect())


def test_ntile_uneven_bucket_sizes(spark):
    # ntile_uneven: 7 rows, n=5 -> 2,2,1,1,1
    df = frame(spark, 7, distinct_values=2)
    out = exact_ntile(df, 5, ["v", "cid"], "b", num_partitions=3)
    sizes = sorted(out.groupBy("b").count().collect())
    assert [r["count"] for r in sizes] == [2, 2, 1, 1, 1]


def test_ntile_hot_value(spark):
    # a third of all rows share one value: still split across range partitions
    rows = [(f"c{i:05d}", 0 if i % 3 == 0 else i) for i in range(3000)]
    df = spark.createDataFrame(rows, "cid string, v int")
    order = [F.col("v").asc(), F.col("cid").asc()]
    ours = exact_ntile(df, 5, ["v", "cid"], "b", num_partitions=8)
    ref = df.withColumn("b", F.ntile(5).over(Window.orderBy(*order)))
    assert sorted(ours.collect()) == sorted(ref.collect())


def test_ntile_of_rank_formula(spark):
    df = spark.range(23).withColumn("b", ntile_of_rank(F.col("id"), F.lit(23), 5))
    sizes = [r["count"] for r in sorted(df.groupBy("b").count().collect())]
    assert sizes == [5, 5, 5, 4, 4]


def test_global_row_number(spark):
    df = frame(spark, 500, distinct_values=20)
    order = [F.col("v").desc(), F.col("cid").asc()]
    ours = global_row_number(df, KEYS, "rn", num_partitions=5)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy(*order)))
    assert sorted(ours.collect()) == sorted(ref.collect())


def test_nulls_strings_and_any_layout(spark):
    rows = [(f"c{i:03d}" if i else None, None if i % 4 == 0 else i % 3) for i in range(90)]
    df = spark.createDataFrame(rows, "cid string, v int")
    down = Window.orderBy(F.col("v").desc_nulls_last(), F.col("cid").asc_nulls_first())
    up = Window.orderBy(F.col("v").asc_nulls_first(), F.col("cid").asc_nulls_first())
    for keys, w in ((KEYS, down), (["v", "cid"], up)):
        ref = {r.cid: r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}
        for layout, parts in ((df.repartition(7), 5), (df.coalesce(1), 300)):
            assert {r.cid: r.rn for r in global_row_number(layout, keys, "rn", num_partitions=parts).collect()} == ref


def test_ranking_starts_no_job(spark):
    df = frame(spark, 200, distinct_values=3)
    spark.sparkContext.setJobGroup("ranking", "")
    exact_ntile(exact_ntile(df, 4, KEYS, "a"), 4, ["v", "cid"], "b")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("ranking")


def test_top_n_per_group(spark):
    rows = [("g1", i, f"p{i}") for i in range(10)] + [("g2", 1, "q")]
    df = spark.createDataFrame(rows, "g string, v int, p string")
    out = top_n_per_group(df, ["g"], [F.col("v").desc(), F.col("p").asc()], 3, "rk").collect()
    assert sorted((r.g, r.rk, r.v) for r in out) == [("g1", 1, 9), ("g1", 2, 8), ("g1", 3, 7), ("g2", 1, 1)]


def test_top_n_plan_has_partial_limit(spark):
    df = spark.range(1000).selectExpr("id % 7 AS g", "id AS v")
    out = top_n_per_group(df, ["g"], [F.col("v").desc()], 5, "rk")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
