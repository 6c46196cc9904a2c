"""Line identity, sinks that survive a second run, fresh layers, settings."""

import os
import shutil

import pytest
from helpers import SF001, bronze_rows
from pyspark.sql import functions as F

from cartwheel.functions.money import sample_stddev_money_sql
from cartwheel.plans import catalog
from cartwheel.plans.pipeline import run_pipeline
from cartwheel.session import get_session
from cartwheel.sources.tables import append_table, read_table


def test_no_line_item_is_lost(spark):
    lines = spark.read.parquet(f"{SF001}/lineitem.parquet")
    assert catalog.silver_build(spark, SF001).count() == lines.distinct().count()


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_pipeline_twice(spark, tmp_root, fmt):
    for _ in range(2):
        out = run_pipeline(bronze_rows(spark, [{}, {"region": "South"}]), f"{tmp_root}/shop", as_of="2024-03-01", fmt=fmt)
    assert read_table(spark, out["quality_metrics_history"], fmt, True).count() == 2


def test_append_grows_columns_and_rejects_other_types(spark, tmp_root):
    for target, fmt in ((f"{tmp_root}/t", "orc"), ("round2_append", "parquet")):
        spark.sql("DROP TABLE IF EXISTS round2_append")
        append_table(spark.range(2), target, fmt)
        append_table(spark.range(1).withColumn("x", F.lit("y")), target, fmt)
        got = read_table(spark, target, fmt, True)
        assert got.count() == 3 and got.where("x = 'y'").count() == 1
        with pytest.raises(ValueError):
            append_table(spark.range(1).select(F.col("id").cast("string")), target, fmt)
    spark.sql("DROP TABLE round2_append")


def test_layers_follow_a_changed_input(spark, tmp_root):
    d = f"{tmp_root}/sf"
    shutil.copytree(SF001, d)
    before = catalog.QUERIES["kpi_summary"](spark, f"file://{d}").first()["total_orders"]
    os.remove(f"{d}/lineitem.parquet")
    spark.read.parquet(f"{SF001}/lineitem.parquet").limit(1000).repartition(3).write.parquet(f"{d}/lineitem.parquet")
    after = catalog.QUERIES["kpi_summary"](spark, f"file://{d}").first()["total_orders"]
    assert (before, after) == (6000, 1000)


def test_static_settings_are_accepted(spark):
    assert get_session(conf={"spark.sql.warehouse.dir": "/tmp/other", "spark.sql.ansi.enabled": "true"}) is not None


def test_stddev_of_sums_beyond_38_digits(spark):
    df = spark.sql("SELECT explode(array_repeat(9.0e15D, 3)) AS v UNION ALL SELECT 0.0D")
    assert df.selectExpr(f"{sample_stddev_money_sql('v')} AS s").first()["s"] == pytest.approx(4.5e15)
