"""Acceptance suite over the pipeline's tables: one row per assertion.

``test, check_name, detail, actual, lower, upper, passed`` — ``passed`` is the
real outcome of each assertion (the reference printed "all passed"
unconditionally).  Each table is scanned once: all assertions on a table are
fused into one aggregate, unpivoted with ``stack``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from cartwheel.operators.quality import distinct_count
from cartwheel.sources.tables import read_table, table_exists

REQUIRED_TABLES = (
    "ecommerce_bronze",
    "ecommerce_silver",
    "daily_sales_summary",
    "customer_metrics",
    "product_performance",
    "regional_analysis",
    "customer_segmentation",
    "delivery_performance",
    "category_trends",
)

# Silver column types the suite asserts (fixed values).
EXPECTED_TYPES = (
    ("order_id", "string"),
    ("customer_id", "string"),
    ("product_name", "string"),
    ("category", "string"),
    ("quantity", "int"),
    ("unit_price", "double"),
    ("order_amount", "double"),
    ("order_date", "date"),
    ("region", "string"),
    ("payment_method", "string"),
)

COLUMNS = ["test", "check_name", "detail", "actual", "lower", "upper", "passed"]


@dataclass(frozen=True)
class Expectations:
    """Expected row counts (None: only non-empty) and value ranges."""

    bronze_rows: int | None = None
    silver_rows: int | None = None
    price_range: tuple[float, float] = (0.0, 200000.0)
    quantity_range: tuple[int, int] = (1, 10)
    delivery_range: tuple[int, int] = (1, 90)
    regions: int = 5


def _s(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(float(v))


def _row(test: str, check: str, actual: str, lower=None, upper=None, detail: str | None = None) -> str:
    a = f"CAST({actual} AS DOUBLE)"
    cond = [f"{a} IS NOT NULL"]
    if lower is not None:
        cond.append(f"{a} >= {_s(lower)}")
    if upper is not None:
        cond.append(f"{a} <= {_s(upper)}")
    return ", ".join(
        [
            _s(test),
            _s(check),
            f"CAST({_s(detail)} AS STRING)",
            a,
            f"CAST({_s(lower)} AS DOUBLE)",
            f"CAST({_s(upper)} AS DOUBLE)",
            f"coalesce({' AND '.join(cond)}, false)",
        ]
    )


def _stack(df: DataFrame, rows: list[str]) -> DataFrame:
    return df.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS ({', '.join(COLUMNS)})")


def stored_tables(spark: SparkSession, locations: Mapping[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """The written tables among ``locations`` (paths or catalog names), with their stored
    schemas; a table that is not there is left out, so the suite reports it as failed."""
    return {name: read_table(spark, at, fmt) for name, at in locations.items() if table_exists(spark, at)}


def acceptance_suite(tables: Mapping[str, DataFrame], exp: Expectations = Expectations()) -> DataFrame:
    """The seven acceptance tests (existence, row counts, NULLs, duplicates,
    types, value ranges, gold sanity) as rows.

    One job: the silver assertions are one aggregate over silver; every table's
    row count is a scalar subquery attached to it (Spark runs subqueries
    concurrently); a single ``stack`` turns the row into assertions."""
    spark = next(iter(tables.values())).sparkSession
    silver = tables.get("ecommerce_silver")
    cols: list[Column] = []
    rows: list[str] = []

    # Tests 1, 2 (bronze) and 7: one count per table; a missing table fails.
    for i, name in enumerate(REQUIRED_TABLES):
        df = tables.get(name)
        n = f"__n{i}"
        if df is None:
            rows.append(_row("table_exists", name, "NULL", 0))
            continue
        cols.append(df.selectExpr("count(1)").scalar().alias(n))
        rows.append(_row("table_exists", name, n, 0))
        if name in ("daily_sales_summary", "customer_metrics", "product_performance"):
            rows.append(_row("gold_non_empty", name, n, 1))
        if name == "regional_analysis":
            rows.append(_row("gold_row_count", name, n, exp.regions, exp.regions))
        if name == "ecommerce_bronze":
            rows.append(_row("row_count", name, n, exp.bronze_rows or 1, exp.bronze_rows))

    if silver is None:
        return _stack(spark.range(1).select(*cols) if cols else spark.range(1), rows)

    nulls = " + ".join(f"count_if(`{c}` IS NULL)" for c in silver.columns)
    one = silver.selectExpr(
        "count(1) AS n",
        f"{nulls} AS nulls",
        "min(unit_price) AS pmin",
        "max(unit_price) AS pmax",
        "min(quantity) AS qmin",
        "max(quantity) AS qmax",
        "min(delivery_days) AS dmin",
        "max(delivery_days) AS dmax",
    ).select("*", distinct_count(silver, "order_id").alias("keys"), *cols)
    plo, phi = exp.price_range
    qlo, qhi = exp.quantity_range
    dlo, dhi = exp.delivery_range
    rows += [
        _row("row_count", "ecommerce_silver", "n", exp.silver_rows or 1, exp.silver_rows),
        _row("no_nulls", "ecommerce_silver", "nulls", 0, 0),
        _row("no_duplicates", "order_id", "n - keys", 0, 0),
        _row("value_range", "unit_price_min", "pmin", plo),
        _row("value_range", "unit_price_max", "pmax", None, phi),
        _row("value_range", "quantity_min", "qmin", qlo),
        _row("value_range", "quantity_max", "qmax", None, qhi),
        _row("value_range", "delivery_days_min", "dmin", dlo),
        _row("value_range", "delivery_days_max", "dmax", None, dhi),
    ]
    # Test 5 is schema metadata: exact type names, no data read.
    types = {f.name: f.dataType.simpleString() for f in silver.schema.fields}
    for col, expected in EXPECTED_TYPES:
        actual = types.get(col)
        rows.append(_row("column_type", col, "1.0" if actual == expected else "0.0", 1, 1, actual))
    return _stack(one, rows)
