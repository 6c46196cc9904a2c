"""Medallion pipeline: bronze -> silver -> gold as written layers.

``materialize`` writes a derived layer once into the cluster's shared
checkpoint folder (``spark.checkpoint.dir``; when unset, a folder under the
warehouse in local mode and an error elsewhere) and reads it back.  A written layer cuts the lineage: gold
queries scan silver's files instead of recomputing the star joins and the
de-duplication, and a lost executor re-reads files instead of re-running the
upstream.  The layer's name carries a fingerprint of its inputs and of the
code that derives it, so a changed input or changed cleaning rule never
reads a stale layer.  Writes go to a unique staging folder first and are
renamed into place (concurrent builders cannot corrupt a layer).

``run_pipeline`` writes the full set of named tables (the reference's eleven
``CREATE OR REPLACE TABLE`` statements plus bronze, silver and the quality
history append).
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import importlib
import inspect
import os
import pkgutil
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from cartwheel.operators import quality as Q
from cartwheel.operators.cleaning import clean_transactions
from cartwheel.operators.customers import cohort_retention, customer_metrics, rfm_segmentation
from cartwheel.operators.sales import (
    category_trends,
    daily_sales_summary,
    delivery_performance,
    payment_analysis,
    product_performance,
    regional_analysis,
)
from cartwheel.operators.trends import revenue_trends, top_products_by_group
from cartwheel.sources import star as star_source
from cartwheel.sources.layout import CatalogTables, PathTables, layout_of
from cartwheel.sources.tables import read_table
from cartwheel.sources.verify import AUDIT, Report, audit_frame, verified


#: What ``run_pipeline`` writes.
PIPELINE_TABLES = (
    "ecommerce_bronze",
    "ecommerce_silver",
    "daily_sales_summary",
    "customer_metrics",
    "customer_segmentation",
    "product_performance",
    "regional_analysis",
    "category_trends",
    "delivery_performance",
    "revenue_trends",
    "top_products_by_region",
    "customer_cohorts",
    "payment_analysis",
    "quality_metrics_history",
    AUDIT,
)


#: Gold tables that ``run_pipeline`` writes at the same time: one job's last tasks leave cores to the next.
GOLD_AT_ONCE = 4


def layer_root(spark: SparkSession) -> str:
    """Shared folder for written layers: ``spark.checkpoint.dir`` when the
    cluster names one, else ``<warehouse>/_cartwheel_checkpoints``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = os.path.dirname(current.get().rstrip("/")) if current.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_cartwheel_checkpoints"
    return base.rstrip("/") + "/cartwheel_layers"


def code_fingerprint(*objs) -> str:
    h = hashlib.sha256()
    for o in objs:
        h.update(inspect.getsource(o).encode())
    return h.hexdigest()[:16]


def _fs_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


_LAYERS: dict[tuple[str, str], DataFrame] = {}


def materialize(spark: SparkSession, name: str, fingerprint: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read layer ``name``/``fingerprint`` if written, else build, write, read.

    A written layer never changes (its name is its content fingerprint), so its
    scan DataFrame is kept per session: later queries skip the file listing
    and footer reads."""
    target = f"{layer_root(spark)}/{name}-{fingerprint}"
    key = (spark.sparkContext.applicationId, target)
    fs, tpath = _fs_path(spark, target)
    done = spark._jvm.org.apache.hadoop.fs.Path(target + "/_SUCCESS")
    if key in _LAYERS and fs.exists(done):
        return _LAYERS[key]
    if not fs.exists(done):
        stage = f"{target}.stage-{uuid.uuid4().hex[:12]}"
        build().write.mode("overwrite").parquet(stage)
        _, spath = _fs_path(spark, stage)
        if not fs.exists(done):
            if fs.exists(tpath):
                fs.delete(tpath, True)
            if not fs.rename(spath, tpath):
                fs.delete(spath, True)
        else:
            fs.delete(spath, True)
    _LAYERS[key] = spark.read.parquet(target)
    return _LAYERS[key]


def silver_from_star(spark: SparkSession, sf_dir: str, as_of: _dt.date) -> DataFrame:
    """Silver computed from the star tables (no materialisation).

    De-duplication runs on ``order_id`` with its own exchange rather than
    reusing the orderkey join's partitioning: the exchange is preceded by a
    partial WindowGroupLimit, so copies of a line collapse in each map task
    (a line copied into a third of all rows ships one row per task), and AQE
    stays free to split a skewed orderkey partition of the join."""
    raw = star_source.transactions_from_star(star_source.load_star(spark, sf_dir))
    return clean_transactions(raw, as_of=as_of)


def bronze_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written bronze layer of ``sf_dir`` (built on first use)."""
    import cartwheel.schemas as schemas_mod

    files = star_source._fingerprint(spark, sf_dir, star_source.STAR_TABLES)
    key = hashlib.sha256(
        repr((os.path.abspath(sf_dir), files)).encode() + code_fingerprint(star_source, schemas_mod).encode()
    ).hexdigest()[:20]
    return materialize(
        spark, "bronze", key, lambda: star_source.transactions_from_star(star_source.load_star(spark, sf_dir))
    )


def silver_layer(spark: SparkSession, sf_dir: str, as_of: _dt.date) -> DataFrame:
    """The written silver layer of ``sf_dir`` (built on first use)."""
    import cartwheel.functions.money as money_mod
    import cartwheel.functions.rules as rules_mod
    import cartwheel.operators.cleaning as cleaning_mod
    import cartwheel.schemas as schemas_mod

    files = star_source._fingerprint(spark, sf_dir, star_source.STAR_TABLES)
    key = hashlib.sha256(
        repr((os.path.abspath(sf_dir), files, as_of.isoformat())).encode()
        + code_fingerprint(star_source, cleaning_mod, rules_mod, schemas_mod, money_mod).encode()
    ).hexdigest()[:20]
    return materialize(spark, "silver", key, lambda: silver_from_star(spark, sf_dir, as_of))


def gold_tables(
    silver: DataFrame, as_of: _dt.date | str | None = None, approx_distinct: bool = False
) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the gold tables, by the reference's table names."""
    a = approx_distinct
    return {
        "daily_sales_summary": lambda: daily_sales_summary(silver, approx_distinct=a),
        "customer_metrics": lambda: customer_metrics(silver, as_of),
        "product_performance": lambda: product_performance(silver, approx_distinct=a),
        "regional_analysis": lambda: regional_analysis(silver, approx_distinct=a),
        "category_trends": lambda: category_trends(silver, approx_distinct=a),
        "delivery_performance": lambda: delivery_performance(silver),
        "revenue_trends": lambda: revenue_trends(silver),
        "top_products_by_region": lambda: top_products_by_group(silver),
        "customer_cohorts": lambda: cohort_retention(silver),
        "payment_analysis": lambda: payment_analysis(silver, approx_distinct=a),
    }


def register_views(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet") -> list[str]:
    """Expose written tables to Spark SQL under their names (temporary views),
    so ``spark.sql("SELECT * FROM daily_sales_summary ORDER BY ...")`` works."""
    for name, location in tables.items():
        read_table(spark, location, fmt, name == "quality_metrics_history").createOrReplaceTempView(name)
    return sorted(tables)


class PipelineRun(dict):
    """Table name -> location (path or catalog name), and ``reports``: what was written and read back."""

    def __init__(self, locations: dict[str, str], reports: list[Report]):
        super().__init__(locations)
        self.reports = {r.table_name: r for r in reports}


def run_pipeline(
    bronze: DataFrame,
    root: str | PathTables | CatalogTables,
    as_of: _dt.date | str | None = None,
    fmt: str = "parquet",
    rules: Q.QualityRules = Q.QualityRules(),
    dedup_keys=("order_id",),
    silver_partition_by: tuple[str, ...] | None = None,
    approx_distinct: bool = False,
) -> PipelineRun:
    """Write bronze, silver, every gold table and append one quality-history row.

    ``root`` is a folder, or a layout of named tables (``CatalogTables``), which replaces each name at once.
    Each table is written once and later tables read it back (silver from its
    files, segmentation from customer_metrics' files), so no stage recomputes
    its upstream; gold tables, which only read silver, are written ``GOLD_AT_ONCE`` at a time.  Every write is read back: rows and cents stored must be those written, else the
    run fails; the written counts stay in the table ``write_audit``.  ``silver_partition_by`` (e.g.
    ``("order_year", "order_month")``) lays silver out for partition pruning of date filters; a later run into
    the same folder rewrites only the partitions that changed.
    """
    tables = layout_of(bronze.sparkSession, root, fmt)
    reports: list[Report] = []

    def put(name: str, df: DataFrame, partition_by=None) -> DataFrame:
        reports.append(verified(tables, name, df, partition_by=partition_by))
        return tables.read(name)

    written_bronze = put("ecommerce_bronze", bronze)
    silver = put(
        "ecommerce_silver",
        clean_transactions(written_bronze, as_of=as_of, dedup_keys=dedup_keys, rare_copies=None),
        silver_partition_by,
    )
    gold = gold_tables(silver, as_of, approx_distinct)

    def customers() -> list[Report]:
        metrics = verified(tables, "customer_metrics", gold["customer_metrics"]())
        return [metrics, verified(tables, "customer_segmentation", rfm_segmentation(tables.read("customer_metrics")))]

    jobs = [customers, *(lambda n=name: [verified(tables, n, gold[n]())] for name in gold if name != "customer_metrics")]
    jobs.append(lambda: [verified(tables, "quality_metrics_history", Q.quality_metrics_row(silver, as_of, rules, measured=True), append=True)])
    with ThreadPoolExecutor(GOLD_AT_ONCE) as pool:
        for found in pool.map(lambda job: job(), jobs):
            reports += found
    tables.replace(AUDIT, audit_frame(bronze.sparkSession, reports))
    return PipelineRun({name: tables.target(name) for name in (*(r.table_name for r in reports), AUDIT)}, reports)


def _modules(*packages) -> list:
    return [importlib.import_module(f"{p.__name__}.{m.name}") for p in packages for m in pkgutil.iter_modules(p.__path__)]


def stored_pipeline(spark: SparkSession, sf_dir: str, as_of: _dt.date, rules: Q.QualityRules) -> dict[str, str]:
    """Locations of the tables that ``run_pipeline`` wrote for ``sf_dir`` in the shared folder, written on first
    use.  A table lost or changed after that is not written again, so that a check of the tables sees it."""
    import cartwheel.functions as functions_mod
    import cartwheel.operators as operators_mod
    import cartwheel.schemas as schemas_mod
    import cartwheel.sources as sources_mod

    files = star_source._fingerprint(spark, sf_dir, star_source.STAR_TABLES)
    code = code_fingerprint(*_modules(functions_mod, operators_mod, sources_mod), schemas_mod, run_pipeline, gold_tables)
    key = hashlib.sha256(repr((os.path.abspath(sf_dir), files, as_of.isoformat(), rules, code)).encode()).hexdigest()[:20]
    target = f"{layer_root(spark)}/pipeline-{key}"
    fs, tpath = _fs_path(spark, target)
    if not fs.exists(tpath):
        stage = f"{target}.stage-{uuid.uuid4().hex[:12]}"
        bronze = star_source.transactions_from_star(star_source.load_star(spark, sf_dir))  # written once, as ecommerce_bronze
        run_pipeline(bronze, stage, as_of, rules=rules)
        _, spath = _fs_path(spark, stage)
        if fs.exists(tpath) or not fs.rename(spath, tpath):
            fs.delete(spath, True)
    return {name: f"{target}/{name}" for name in PIPELINE_TABLES}
