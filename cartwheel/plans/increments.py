"""Quality history by increments: each run checks only what is new and merges the stored states of the rest.

An increment (a day's load, a partition) is scanned once; its merged checks (a row) and its distinct keys are written to
folders of its own, with overwrite, so that a repeated run replaces its state instead of counting it twice.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from cartwheel.operators.quality import QualityRules, merged_report, partial_checks, partial_keys


def add_increment(part: DataFrame, root: str, increment: str, rules: QualityRules = QualityRules()) -> None:
    """Store the quality state of ``part`` below ``root`` under the name ``increment``."""
    if not increment or not all(c.isalnum() or c in "-_." for c in increment):
        raise ValueError("increment: letters, digits, '-', '_' and '.' only")
    partial_keys(part, rules).write.mode("overwrite").parquet(f"{root}/keys/increment={increment}")
    partial_checks(part, rules).write.mode("overwrite").parquet(f"{root}/checks/increment={increment}")  # last: it makes the increment count


def report_of_increments(spark: SparkSession, root: str, rules: QualityRules = QualityRules(), as_of: _dt.date | str | None = None) -> DataFrame:
    """The full report over all stored increments.  Keys of an increment without checks (a run that was lost) are left out."""
    inferred = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    try:
        checks, keys = spark.read.parquet(f"{root}/checks"), spark.read.parquet(f"{root}/keys")
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", inferred)
    return merged_report(checks, keys.join(checks.select("increment"), "increment", "left_semi"), rules, as_of)
