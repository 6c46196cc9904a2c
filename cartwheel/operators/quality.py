"""Data-quality operators: profiles, the seven-dimension report, the history row.

The reference issues one Spark job per check (17 for the report, 6 more for
the history row).  Here each operator is **one aggregate over one scan**; the
per-check rows come from unpivoting that single aggregate row (``stack``),
and per-check arithmetic (percentages, pass flags) is applied once to the
unpivoted rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.money import cents_sql, dollars_sql, half_up_ratio_sql, money_avg_sql, money_total_sql, pct_sql, stddev_of_sums_sql
from cartwheel.operators.cleaning import as_of_sql, surplus_rows
from cartwheel.session import shuffle_partitions

# Domains of the reference data (fixed values).
REFERENCE_REGIONS = ("North", "South", "East", "West", "Central")
REFERENCE_PAYMENT_METHODS = ("Credit Card", "Debit Card", "UPI", "Wallet", "Net Banking")


@dataclass(frozen=True)
class QualityRules:
    """Thresholds and domains of the quality checks (reference defaults)."""

    valid_regions: tuple[str, ...] = REFERENCE_REGIONS
    valid_payment_methods: tuple[str, ...] = REFERENCE_PAYMENT_METHODS
    quantity_range: tuple[int, int] = (1, 10)
    price_range: tuple[float, float] = (0.0, 200000.0)
    delivery_range: tuple[int, int] = (1, 90)
    key: str = "order_id"
    approx_distinct: bool = False  # HyperLogLog instead of exact distinct counts
    columns: tuple[str, ...] | None = field(default=None)  # null checks: all when None


def _q(name: str) -> str:
    return f"`{name}`"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def distinct_with_null_sql(c: str, approx: bool = False) -> str:
    """``select(c).distinct().count()``: NULL counts as one value."""
    base = f"approx_count_distinct({_q(c)})" if approx else f"count(DISTINCT {_q(c)})"
    return f"({base} + coalesce(max(CAST({_q(c)} IS NULL AS INT)), 0))"


def distinct_count(df: DataFrame, c: str) -> Column:
    """Exact ``select(c).distinct().count()`` (NULL is one value) as a scalar
    subquery Column: a partial-aggregated ``groupBy(c)`` (a hot value collapses
    map-side) instead of an Expand next to unrelated aggregates."""
    return df.select(c).distinct().selectExpr("count(1)").scalar()


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, Column]:
    """Exact distinct counts of several columns (NULL is one value each): a :func:`distinct_count` per column.
    Each scans, groups and shuffles its own column alone; ``GROUPING SETS`` would hold, shuffle and spill
    every value next to a place for each of the other columns, and all columns' groups in one hash map."""
    return {c: distinct_count(df, c) for c in dict.fromkeys(cols)}


def _nulls(c: str) -> str:
    return f"count_if({_q(c)} IS NULL)"


def _unpivot(df: DataFrame, rows: list[tuple], names: Sequence[str], types: Sequence[str]) -> DataFrame:
    """One output row per tuple of SQL expressions (``stack``), with fixed types."""
    args = ", ".join(", ".join(f"CAST({e} AS {t})" for e, t in zip(row, types)) for row in rows)
    return df.selectExpr(f"stack({len(rows)}, {args}) AS ({', '.join(names)})")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per-column NULL count over *all* rows (one scan), one row per column:
    ``column_name, null_count, total_records, null_pct``."""
    cols = list(columns or df.columns)
    wide = df.selectExpr("count(1) AS __total", *[f"{_nulls(c)} AS `nulls__{c}`" for c in cols])
    long = _unpivot(
        wide,
        [(_lit(c), f"`nulls__{c}`", "__total") for c in cols],
        ["column_name", "null_count", "total_records"],
        ["STRING", "BIGINT", "BIGINT"],
    )
    return long.withColumn("null_pct", F.expr(pct_sql("null_count", "total_records")))


def duplicate_count(df: DataFrame, key: str = "order_id", approx: bool = False) -> DataFrame:
    """``total_rows, distinct_keys, duplicate_count`` (NULL counted as a key value)."""
    if approx:
        d = distinct_with_null_sql(key, approx)
        return df.selectExpr("count(1) AS total_rows", f"{d} AS distinct_keys", f"count(1) - {d} AS duplicate_count")
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("__c"))
    return per_key.selectExpr(
        "coalesce(sum(__c), 0) AS total_rows",
        "count(1) AS distinct_keys",
        "coalesce(sum(__c), 0) - count(1) AS duplicate_count",
    )


def cleaning_summary(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows in, rows out and rows removed by cleaning (one row), from one scan
    of each layer; the silver count is a scalar subquery."""
    return bronze.selectExpr("count(1) AS bronze_rows").select(
        "bronze_rows",
        silver.selectExpr("count(1)").scalar().alias("silver_rows"),
    ).selectExpr("bronze_rows", "silver_rows", "bronze_rows - silver_rows AS rows_removed")


def profile(
    df: DataFrame,
    distinct_columns: Sequence[str] = ("order_id", "customer_id", "product_name", "category", "region"),
    price: str = "unit_price",
    date: str = "order_date",
    non_negative: Sequence[str] = (),
    ranges: dict[str, tuple[float, float]] | None = None,
    key: str = "order_id",
    amount: str | None = None,
) -> DataFrame:
    """Layer profile in one row (raw and cleaned checks of the reference):
    record count, distinct counts, NULLs per column and in total, price
    min/max/mean, date range, negatives, out-of-range counts, duplicates, the type
    of each column and, with ``amount``, revenue and average order value."""
    sql = ["count(1) AS record_count"]
    sql.append(f"CAST({' + '.join(_nulls(c) for c in df.columns)} AS BIGINT) AS null_total")
    sql += [f"{_nulls(c)} AS `nulls__{c}`" for c in df.columns]
    sql += [
        f"min({price}) AS min_{price}",
        f"max({price}) AS max_{price}",
        f"{money_avg_sql(price)} AS avg_{price}",
        f"min(CAST({date} AS DATE)) AS min_{date}",
        f"max(CAST({date} AS DATE)) AS max_{date}",
    ]
    sql += [f"'{f.dataType.simpleString()}' AS `type__{f.name}`" for f in df.schema.fields]
    if amount:
        sql += [f"{money_total_sql(amount)} AS total_revenue", f"{money_avg_sql(amount)} AS avg_order_value"]
    sql += [f"count_if({c} < 0) AS negative_{c}" for c in non_negative]
    for c, (lo, hi) in (ranges or {}).items():
        sql.append(f"count_if({c} < {lo} OR {c} > {hi}) AS out_of_range_{c}")
    main = df.selectExpr(*sql)
    distinct = distinct_counts(df, [*distinct_columns, key])
    return main.select(
        "record_count",
        *[distinct[c].alias(f"distinct_{c}") for c in distinct_columns],
        *[c for c in main.columns if c != "record_count"],
        (F.col("record_count") - distinct[key]).alias(f"duplicate_{key}"),
    )


REPORT_COLUMNS = ["dimension", "check_name", "column_name", "metric_value", "violations", "total", "passed"]


#: How partial states of a check meet, by the prefix of its column.
_MERGE = {"min_": "min", "max_": "max"}


def _plain_checks(cols: Sequence[str], r: QualityRules) -> dict[str, str]:
    """Aggregates of one scan that can be merged by sum, minimum or maximum: name -> SQL."""
    qlo, qhi = r.quantity_range
    plo, phi = r.price_range
    dlo, dhi = r.delivery_range
    regions = ", ".join(_lit(v) for v in r.valid_regions)
    payments = ", ".join(_lit(v) for v in r.valid_payment_methods)
    # |amount - q*price| > 0.005*q + 0.005, in exact integer half-cents
    q_long, cents = "CAST(quantity AS BIGINT)", cents_sql("order_amount")
    bounds = {"date": "order_date", "price": "unit_price", "delivery": "delivery_days", "amount": "order_amount", "qty": "quantity"}
    return {
        "total": "count(1)",
        **{f"nulls__{c}": _nulls(c) for c in cols},
        "neg_amount": "count_if(order_amount < 0)",
        "bad_qty": f"count_if(quantity < {qlo} OR quantity > {qhi})",
        "mismatch": f"count_if(2 * abs({cents} - {q_long} * {cents_sql('unit_price')}) > {q_long} + 1)",
        "bad_region": f"count_if(NOT region IN ({regions}))",
        "bad_payment": f"count_if(NOT payment_method IN ({payments}))",
        "low_price": f"count_if(unit_price < {plo})",
        "high_price": f"count_if(unit_price > {phi})",
        "low_delivery": f"count_if(delivery_days < {dlo})",
        "high_delivery": f"count_if(delivery_days > {dhi})",
        **{f"{f}_{name}": f"{f}({c})" for name, c in bounds.items() for f in ("min", "max")},
        "n_amount": "count(order_amount)",
        "cents_amount": f"sum({cents})",
        "squares_amount": f"sum(CAST({cents} AS DECIMAL(38,0)) * {cents})",
        "n_qty": "count(quantity)",
        "sum_qty": "sum(quantity)",
        "n_delivery": "count(delivery_days)",
        "sum_delivery": "sum(delivery_days)",
    }


def _with_means(checks: DataFrame) -> DataFrame:
    """The rounded figures that follow from the plain checks."""
    return checks.selectExpr(
        "*",
        f"{half_up_ratio_sql('cents_amount', 'n_amount', 2, num_scale=2)} AS avg_amount",
        f"{stddev_of_sums_sql('n_amount', 'cents_amount', 'squares_amount')} AS stddev_amount",
        f"{dollars_sql('cents_amount')} AS sum_amount",
        f"{half_up_ratio_sql('sum_qty', 'n_qty', 2)} AS avg_qty",
        f"{half_up_ratio_sql('sum_delivery', 'n_delivery', 2)} AS avg_delivery",
    )


def partial_checks(part: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The state of one increment of the silver table: a row that merges with those of others."""
    return part.selectExpr(*(f"{e} AS `{name}`" for name, e in _plain_checks(list(rules.columns or part.columns), rules).items()))


def partial_keys(part: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """(column_name, value): the increment's distinct keys and customers, for exact distinct counts (narrow rows:
    each column is grouped and shuffled on its own)."""
    own = lambda c: part.selectExpr(f"CAST({_q(c)} AS STRING) AS value").distinct().selectExpr(f"{_lit(c)} AS column_name", "value")
    keys, *rest = [own(c) for c in dict.fromkeys((rules.key, "customer_id"))]
    return keys.union(rest[0]) if rest else keys


def merged_report(states: DataFrame, keys: DataFrame, rules: QualityRules = QualityRules(), as_of: _dt.date | str | None = None) -> DataFrame:
    """:func:`quality_report` of all increments from their states and keys, without reading the table again."""
    if rules.approx_distinct:
        raise ValueError("states hold exact keys")
    cols = [c.removeprefix("nulls__") for c in states.columns if c.startswith("nulls__")]
    names = list(_plain_checks(cols, rules))
    merged = states.selectExpr(*(f"{_MERGE.get(c[:4], 'sum')}(`{c}`) AS `{c}`" for c in names))
    # A value occurs once per increment at most: no use in collapsing it before the exchange, by a hash map of a whole file split.
    parts = shuffle_partitions(keys.sparkSession)
    value = lambda c: keys.where(F.col("column_name") == c).select("value").repartition(parts, "value")
    counts = [value(c).distinct().selectExpr("count(1)").scalar() for c in (rules.key, "customer_id")]
    one = _with_means(merged).select("*", counts[0].alias("keys"), counts[1].alias("customers"))
    return _report_rows(one.fillna(0, ["total", *(c for c in names if c.startswith(("nulls__", "neg_", "bad_", "low_", "high_", "mismatch")))]), cols, rules, as_of)


def quality_report(
    silver: DataFrame,
    rules: QualityRules = QualityRules(),
    as_of: _dt.date | str | None = None,
    measured: bool = False,
) -> DataFrame:
    """Seven-dimension quality report of the silver table, one row per check:
    ``dimension, check_name, column_name, metric_value, violations, total, passed``.

    Volume, completeness (every column), accuracy (negative amounts, quantity
    range, amount vs quantity x price), consistency (duplicate keys, region and
    payment domains), timeliness (date span, freshness against ``as_of``),
    validity (price and delivery bounds) and summary statistics.  ``passed`` is
    NULL for informational rows.  For counted checks ``metric_value`` is the
    violating share in percent.  The amount check allows the rounding the
    cleaning step applies: ``|amount - quantity*price| <= 0.005*quantity +
    0.005`` in exact decimals (the reference compared doubles with ``!=``).
    With ``measured`` (for a stored table whose keys should not repeat) the copies of keys are counted at once by
    :func:`~cartwheel.operators.cleaning.surplus_rows`, which shuffles hashes instead of keys; the count is as exact.
    """
    r = rules
    cols = list(r.columns or silver.columns)
    if r.approx_distinct:  # HyperLogLog sketches: ordinary aggregates in the same pass
        sketched = [f"{distinct_with_null_sql(r.key, True)} AS keys", f"{distinct_with_null_sql('customer_id', True)} AS customers"]
        one = silver.selectExpr(*(f"{e} AS `{name}`" for name, e in _plain_checks(cols, r).items()), *sketched)
    else:  # exact: a narrow job per column, attached as scalar subqueries
        more = surplus_rows(silver, [r.key]) if measured else None
        keys = distinct_count(silver, r.key) if more is None else F.col("total") - F.lit(more)
        one = partial_checks(silver, r).select("*", keys.alias("keys"), distinct_count(silver, "customer_id").alias("customers"))
    return _report_rows(_with_means(one), cols, r, as_of)


def _report_rows(one: DataFrame, cols: Sequence[str], r: QualityRules, as_of: _dt.date | str | None) -> DataFrame:
    """The report's rows from the single row of its aggregates."""
    # Each row: dimension, check, column, metric (NULL: share of violations),
    # violations, passed rule ('count': violations = 0, else an expression).
    N = "NULL"
    rows = [
        ("volume", "total_records", None, "total", N, "total > 0"),
        ("volume", "unique_orders", r.key, "keys", N, N),
        ("volume", "unique_customers", "customer_id", "customers", N, N),
        *[("completeness", "null_count", c, N, f"`nulls__{c}`", "count") for c in cols],
        ("accuracy", "negative_amount", "order_amount", N, "neg_amount", "count"),
        ("accuracy", "quantity_out_of_range", "quantity", N, "bad_qty", "count"),
        ("accuracy", "amount_mismatch", "order_amount", N, "mismatch", "count"),
        ("consistency", "duplicate_key", r.key, N, "total - keys", "count"),
        ("consistency", "invalid_region", "region", N, "bad_region", "count"),
        ("consistency", "invalid_payment_method", "payment_method", N, "bad_payment", "count"),
        ("timeliness", "date_span_days", "order_date", "datediff(max_date, min_date)", N, N),
        ("timeliness", "data_freshness_days", "order_date", f"datediff({as_of_sql(as_of)}, max_date)", N, N),
        ("validity", "min_unit_price", "unit_price", "min_price", "low_price", "count"),
        ("validity", "max_unit_price", "unit_price", "max_price", "high_price", "count"),
        ("validity", "min_delivery_days", "delivery_days", "min_delivery", "low_delivery", "count"),
        ("validity", "max_delivery_days", "delivery_days", "max_delivery", "high_delivery", "count"),
        ("statistics", "min_amount", "order_amount", "min_amount", N, N),
        ("statistics", "max_amount", "order_amount", "max_amount", N, N),
        ("statistics", "avg_amount", "order_amount", "avg_amount", N, N),
        ("statistics", "stddev_amount", "order_amount", "stddev_amount", N, N),
        ("statistics", "total_revenue", "order_amount", "sum_amount", N, N),
        ("statistics", "min_quantity", "quantity", "min_qty", N, N),
        ("statistics", "max_quantity", "quantity", "max_qty", N, N),
        ("statistics", "avg_quantity", "quantity", "avg_qty", N, N),
        ("statistics", "min_delivery", "delivery_days", "min_delivery", N, N),
        ("statistics", "max_delivery", "delivery_days", "max_delivery", N, N),
        ("statistics", "avg_delivery", "delivery_days", "avg_delivery", N, N),
    ]
    stacked = _unpivot(
        one,
        [
            (_lit(d), _lit(n), _lit(c), m, v, "total", "NULL" if p == "count" else p, _lit(p == "count"))
            for d, n, c, m, v, p in rows
        ],
        ["dimension", "check_name", "column_name", "__metric", "violations", "total", "__passed", "__counted"],
        ["STRING", "STRING", "STRING", "DOUBLE", "BIGINT", "BIGINT", "BOOLEAN", "BOOLEAN"],
    )
    return stacked.selectExpr(
        "dimension",
        "check_name",
        "column_name",
        f"CASE WHEN __counted AND __metric IS NULL THEN {pct_sql('violations', 'total')} ELSE __metric END"
        " AS metric_value",
        "violations",
        "total",
        "CASE WHEN __counted THEN violations = 0 ELSE __passed END AS passed",
    )


def quality_metrics_row(
    silver: DataFrame,
    as_of: _dt.date | str | None = None,
    rules: QualityRules = QualityRules(),
    check_time: _dt.datetime | None = None,
    measured: bool = False,
) -> DataFrame:
    """One history row per run, from :func:`quality_report` (``measured`` as there):
    ``check_date, total_records, unique_customers, null_count, duplicate_count,
    data_freshness_days, quality_score_pct``.

    ``null_count`` is the NULL count of the key, ``quality_score_pct`` the share
    of passed checks in the report (the reference wrote a constant 98.5).
    ``check_date`` is ``check_time`` (default: midnight of ``as_of``; the
    current timestamp when neither is given)."""
    report = quality_report(silver, rules, as_of, measured)
    if check_time is not None:
        stamp = f"TIMESTAMP_NTZ '{check_time.isoformat(sep=' ')}'"
    elif as_of is not None:
        stamp = f"CAST({as_of_sql(as_of)} AS TIMESTAMP_NTZ)"
    else:
        stamp = "CAST(current_timestamp() AS TIMESTAMP_NTZ)"

    def pick(name: str, column: str | None, fld: str = "metric_value") -> str:
        cond = f"check_name = {_lit(name)}" + (f" AND column_name = {_lit(column)}" if column else "")
        return f"max(CASE WHEN {cond} THEN {fld} END)"

    return report.selectExpr(
        f"{stamp} AS check_date",
        f"CAST({pick('total_records', None)} AS BIGINT) AS total_records",
        f"CAST({pick('unique_customers', 'customer_id')} AS BIGINT) AS unique_customers",
        f"{pick('null_count', rules.key, 'violations')} AS null_count",
        f"{pick('duplicate_key', rules.key, 'violations')} AS duplicate_count",
        f"CAST({pick('data_freshness_days', 'order_date')} AS BIGINT) AS data_freshness_days",
        f"{pct_sql('count_if(passed)', 'count(passed)')} AS quality_score_pct",
    )
