"""Table layouts: names and folders, replacement without a gap, changed partitions, read-back verification."""

import glob
import os
import threading

import pytest
from helpers import SF001, silver_rows
from pyspark.sql import functions as F

from cartwheel.plans.catalog import AS_OF, STAR_RULES
from cartwheel.plans.pipeline import run_pipeline
from cartwheel.plans.validate import REQUIRED_TABLES, acceptance_suite, stored_tables
from cartwheel.sources.layout import CatalogTables, PathTables
from cartwheel.sources.star import load_star, transactions_from_star
from cartwheel.sources.tables import input_folders, overwrite_changed, partition_columns, read_table, write_table
from cartwheel.sources.verify import AUDIT, verified, write_verification


@pytest.fixture
def shop(spark, tmp_root):
    name = f"shop_{os.path.basename(tmp_root).replace('-', '_')}"
    yield CatalogTables(spark, name, f"{tmp_root}/shop")
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def test_pipeline_twice_by_name(spark, shop):
    bronze = transactions_from_star(load_star(spark, SF001))
    run_pipeline(bronze, shop, AS_OF, rules=STAR_RULES)
    out = run_pipeline(bronze.where("order_date < '2001-01-01'"), shop, AS_OF, rules=STAR_RULES, silver_partition_by=("order_year",))
    assert shop.read("quality_metrics_history").count() == 2
    assert out["ecommerce_silver"] == shop.target("ecommerce_silver")
    # the second run's rows, and one older version of each
    assert shop.read("ecommerce_silver").agg(F.max("order_year")).first()[0] == 2000
    assert [spark.read.table(shop.target(v)).agg(F.max("order_year")).first()[0] for v in shop.versions("ecommerce_silver")] == [2001, 2000]
    suite = acceptance_suite(stored_tables(spark, {n: out[n] for n in REQUIRED_TABLES})).collect()
    assert all(r.passed for r in suite if r.test in ("table_exists", "no_duplicates", "column_type", "gold_non_empty"))
    assert spark.sql(f"SELECT count(*) AS n FROM {out['regional_analysis']}").first().n == 5
    # what was counted while writing is what is stored
    stored = {n: read_table(spark, at) for n, at in out.items() if n != AUDIT}
    checked = write_verification(shop.read(AUDIT), stored).collect()
    assert len(checked) == 14 and all(r.passed for r in checked)
    assert {r.table_name: r.written_rows for r in checked} == {n: r.stored_rows for n, r in out.reports.items()}


def test_readers_see_no_gap(spark, shop):
    shop.replace("t", spark.range(100).withColumn("v", F.lit(0)))
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                r = shop.read("t").agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).first()
                seen.append((r.n, r.a == r.b))
            except Exception as e:  # a missing table would come here
                seen.append(repr(e))

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 7):
        shop.replace("t", shop.read("t").select("id").withColumn("v", F.lit(v)))
    stop.set()
    reader.join()
    assert len(seen) > 3 and set(seen) == {(100, True)}
    assert shop.read("t").first().v == 6 and len(shop.versions("t")) == 2
    assert len(glob.glob(f"{shop.location}/t__v_*")) == 2


def months(spark, add=0, only=None):
    df = spark.range(60).select((F.col("id") % 6).cast("int").alias("month"), "id", F.lit("x").alias("s"))
    df = df.withColumn("month", F.when(F.col("id") % 6 == 5, F.lit(None).cast("int")).otherwise(F.col("month")))
    df = df.withColumn("id", F.when(F.col("month") == 3, F.col("id") + add).otherwise(F.col("id")))
    return df if only is None else df.where(only)


def stamps(path):
    return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("month=")}


@pytest.mark.parametrize("named", [False, True])
def test_only_changed_partitions_are_rewritten(spark, tmp_root, shop, named):
    path = f"{shop.location}/m" if named else f"{tmp_root}/m"
    target = shop.target("m") if named else path
    rows = lambda: sorted((r.id, r.month is None, r.month or 0) for r in read_table(spark, target).collect())
    want = lambda df: sorted((r.id, r.month is None, r.month or 0) for r in df.collect())
    assert overwrite_changed(months(spark), target, ["month"]) == (6, 0)
    before = stamps(path)
    assert overwrite_changed(months(spark).repartition(3), target, ["month"]) == (0, 0) and stamps(path) == before
    assert overwrite_changed(months(spark, add=1000), target, ["month"]) == (1, 0)
    assert rows() == want(months(spark, add=1000))
    assert {d for d in before if stamps(path)[d] != before[d]} == {"month=3"}
    # a partition that is gone, and rows that come from the target itself
    assert overwrite_changed(months(spark, 1000, "month <> 2 OR month IS NULL"), target, ["month"]) == (0, 1)
    assert rows() == want(months(spark, 1000, "month <> 2 OR month IS NULL")) and "month=2" not in stamps(path)
    own = read_table(spark, target).withColumn("id", F.when(F.col("month") == 1, -F.col("id")).otherwise(F.col("id")))
    assert overwrite_changed(own, target, ["month"]) == (1, 0) and min(rows())[0] == -55
    assert not [d for d in os.listdir(os.path.dirname(path)) if "__stage_" in d]


def test_pipeline_rewrites_one_month(spark, tmp_root):
    from cartwheel.sources import generate_transactions

    bronze = generate_transactions(spark, n=600, seed=2).withColumn("order_date", F.expr("timestamp'2024-01-05' + make_interval(0, CAST(pmod(hash(order_id), 5) AS INT))"))
    by = ("order_year", "order_month")
    run_pipeline(bronze, tmp_root, "2024-09-01", silver_partition_by=by)
    at = lambda: {d: sorted(os.listdir(f"{tmp_root}/ecommerce_silver/order_year=2024/{d}")) for d in os.listdir(f"{tmp_root}/ecommerce_silver/order_year=2024")}
    before = at()
    changed = bronze.withColumn("unit_price", F.when(F.month("order_date") == 3, F.col("unit_price") + 1).otherwise(F.col("unit_price")))
    out = run_pipeline(changed, tmp_root, "2024-09-01", silver_partition_by=by)
    after = at()
    assert len(before) == 5 and {d for d in before if before[d] != after[d]} == {"order_month=3"}
    assert out.reports["ecommerce_silver"].stored_rows == 600


def test_catalog_overwrite_keeps_partitions(spark, shop):
    name = shop.target("kept")
    write_table(months(spark), name, partition_by=["month"])
    write_table(read_table(spark, name).where("id < 30"), name)
    assert partition_columns(spark, name) == ["month"] and read_table(spark, name).count() == 30


def test_inputs_from_the_plan(spark, tmp_root, shop):
    a, b, c = (f"{tmp_root}/{x}" for x in "abc")
    for p in (a, b, c):
        spark.range(3).write.parquet(p)
    spark.read.parquet(b).createOrReplaceTempView("cw_view_b")
    df = spark.sql(f"SELECT id, (SELECT max(id) FROM parquet.`{c}`) AS m FROM cw_view_b").union(spark.read.parquet(a).groupBy("id").agg(F.max("id")))
    assert {x.rsplit("/", 1)[1] for x in input_folders(df)} == {"a", "b", "c"}
    shop.replace("v", spark.range(2))
    assert "v__v_" in input_folders(shop.read("v"))[0]


def test_lost_rows_are_seen(spark, tmp_root):
    tables = PathTables(spark, tmp_root)
    silver = silver_rows(spark, [{}, {"unit_price": 7.5}, {"quantity": 3}])
    report = verified(tables, "ecommerce_silver", silver)
    assert report.passed and report.written_rows == 3 and report.written_cents == 10_000 + 750 + 30_000
    assert verified(tables, "history", spark.range(2), append=True).stored_rows == 2
    assert verified(tables, "history", spark.range(3), append=True).stored_rows == 5

    class Losing(PathTables):
        def replace(self, name, df, partition_by=None):
            super().replace(name, df, partition_by)
            write_table(self.read(name).limit(2), self.target(name))

    with pytest.raises(ValueError, match="does not hold"):
        verified(Losing(spark, tmp_root), "other", silver)
    audit = spark.createDataFrame([("ecommerce_silver", 3, 40_750), ("gone", 5, None)], "table_name string, written_rows long, written_cents long")
    check = lambda: {r.table_name: r.passed for r in write_verification(audit, {"ecommerce_silver": tables.read("ecommerce_silver")}).collect()}
    assert check() == {"ecommerce_silver": True, "gone": False}
    write_table(tables.read("ecommerce_silver").where("quantity = 1"), tables.target("ecommerce_silver"))
    assert check() == {"ecommerce_silver": False, "gone": False}
