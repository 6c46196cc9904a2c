"""Read-back verification: what a write was given against what the stored table holds.

Rows and the amount in cents are counted while the rows are written (``Observation``: metrics of the
write itself, no second pass over its input) and then counted again in the stored table.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.money import sum_cents_sql

# The money column that identifies a table's content, first found (column names are the contract's).
AMOUNT_COLUMNS = ("order_amount", "total_revenue", "lifetime_value", "revenue", "daily_revenue")
AUDIT = "write_audit"
AUDIT_SCHEMA = "table_name string, written_rows long, written_cents long"


class Report(NamedTuple):
    """Rows and cents (null without a money column) that were written, and that are stored."""

    table_name: str
    written_rows: int
    written_cents: int | None
    stored_rows: int
    stored_cents: int | None

    @property
    def passed(self) -> bool:
        return self[1:3] == self[3:5]


def totals(columns: Sequence[str]) -> list:
    """Aggregates n and cents of a table with these columns."""
    amount = next((c for c in AMOUNT_COLUMNS if c in columns), None)
    cents = F.expr(sum_cents_sql(amount)) if amount else F.max(F.lit(None).cast("long"))
    return [F.count(F.lit(1)).alias("n"), cents.cast("long").alias("cents")]


def verified(tables, name: str, df: DataFrame, append: bool = False, partition_by: Sequence[str] | None = None) -> Report:
    """Replace (or append to) ``name`` and compare; raises if the stored table differs from what was written."""
    n, cents = 0, None
    if append and tables.exists(name):
        before = tables.read(name, True)
        n, cents = before.agg(*totals(before.columns)).first()
    seen = Observation()
    df = df.observe(seen, *totals(df.columns))
    if append:
        tables.append(name, df)
    else:
        tables.replace(name, df, partition_by)
    got = seen.get
    stored = tables.read(name, append)
    there = stored.agg(*totals(stored.columns)).first()
    added = got["cents"] if cents is None else cents + (got["cents"] or 0)
    report = Report(name, n + got["n"], added, there["n"], there["cents"])
    if not report.passed:
        raise ValueError(f"{tables.target(name)} does not hold what was written: {report}")
    return report


def audit_frame(spark: SparkSession, reports: Sequence[Report]) -> DataFrame:
    """The written side of the reports as a table (a row per table of the pipeline)."""
    return spark.createDataFrame([r[:3] for r in reports], AUDIT_SCHEMA).coalesce(1)


def write_verification(audit: DataFrame, stored: dict[str, DataFrame]) -> DataFrame:
    """One row per audited table: what was written, what is stored now, and whether they agree.

    A table that is not among ``stored`` (missing) fails, and so does one that lost or gained rows or cents."""
    spark = audit.sparkSession
    now = spark.createDataFrame([], "table_name string, stored_rows long, stored_cents long")
    for name, df in stored.items():
        now = now.union(df.agg(*totals(df.columns)).select(F.lit(name), "n", "cents"))
    passed = F.col("written_rows").eqNullSafe(F.col("stored_rows")) & F.col("written_cents").eqNullSafe(F.col("stored_cents"))
    return audit.join(now, "table_name", "left").withColumn("passed", passed)
