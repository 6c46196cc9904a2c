"""Exact money and percentage arithmetic.

Money is carried as an integral number of **cents in BIGINT** and summed as
such: exact, independent of the order in which partial aggregates meet (the
same total on 8 or 8,000 partitions), and as cheap per row as a double sum.
A BIGINT sum of cents overflows only beyond about 92 quadrillion (9.2e16) in
one group, and ANSI mode raises instead of wrapping.  Sums of squared cents
(standard deviation) use ``DECIMAL(38,0)``.

Every rounded quotient (average, percentage, ratio) is an integral half-up
division on exact integers: ``round(mult * num / den, scale)`` with ties away
from zero and no intermediate rounding.  Doubles appear only at the output
edge, as ``cents / 100.0`` (correctly rounded).

The helpers emit Spark SQL text (column names, aggregate calls in, one
expression out): wrapped in ``F.expr`` / ``selectExpr``, the whole expression
tree is parsed inside the JVM in one call instead of one Py4J round trip per
node.  Column-argument forms are kept where Columns are natural.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
_WIDE = T.DecimalType(38, 0)

Expr = str | Column


def cents_sql(c: str) -> str:
    """A 2-dp money value as exact integral cents (BIGINT), rounded half-up."""
    return f"CAST(round(({c}) * 100, 0) AS BIGINT)"


def sum_cents_sql(c: str) -> str:
    """Exact sum of a money column, in cents (BIGINT)."""
    return f"sum({cents_sql(c)})"


def dollars_sql(cents: str) -> str:
    """Cents (integral) back to a money double: ``cents / 100`` correctly rounded."""
    return f"(CAST({cents} AS DOUBLE) / 100.0D)"


def money_total_sql(c: str) -> str:
    """Exact total of a money column as double."""
    return dollars_sql(sum_cents_sql(c))


def half_up_ratio_sql(num: str, den: str, scale: int = 2, mult: int = 1, num_scale: int = 0) -> str:
    """``round(mult * (num / 10^num_scale) / den, scale)`` half away from zero,
    as double; NULL when ``den`` is 0 or NULL.  ``num`` and ``den`` must be
    integral (cents: ``num_scale=2``)."""
    k = mult * 10 ** (scale - num_scale)
    if k < 1 or k != int(k):
        raise ValueError("scale must be at least num_scale (less log10(mult))")
    n = f"CAST(({num}) AS DECIMAL(38,0)) * {int(k)}"
    d = f"CAST(({den}) AS DECIMAL(38,0))"
    q = f"((abs({n}) * 2 + {d}) div ({d} * 2))"
    return (
        f"(CASE WHEN {d} != 0 THEN CAST(CASE WHEN {n} < 0 THEN -{q} ELSE {q} END AS DOUBLE)"
        f" / {10**scale}.0D END)"
    )


def money_avg_sql(c: str, scale: int = 2) -> str:
    """Exact mean of a money column, rounded half-up to ``scale`` places."""
    return half_up_ratio_sql(sum_cents_sql(c), f"count({c})", scale, num_scale=2)


def pct_sql(num: str, den: str, scale: int = 2) -> str:
    """``round(num * 100 / den, scale)`` exactly (num, den in the same integral unit)."""
    return half_up_ratio_sql(num, den, scale, mult=100)


def sample_stddev_money_sql(c: str, scale: int = 2) -> str:
    """Sample standard deviation of a money column, rounded to ``scale``.

    Variance is formed exactly in integer cents,
    ``(n*Σx² − (Σx)²) / (n(n−1))`` with Σx² in DECIMAL(38,0), so it does not
    depend on partial-aggregate merge order; only the final square root is
    floating point.  NULL for fewer than two values (as ``stddev_samp``)."""
    x = cents_sql(c)
    return stddev_of_sums_sql(f"count({c})", f"sum({x})", f"sum(CAST({x} AS DECIMAL(38,0)) * {x})", scale)


def stddev_of_sums_sql(count: str, total: str, squares: str, scale: int = 2) -> str:
    """:func:`sample_stddev_money_sql` from the number of values, their sum in cents and the sum of their squares."""
    n, s1 = f"CAST({count} AS DECIMAL(38,0))", f"CAST({total} AS DECIMAL(38,0))"
    exact = f"CAST(try_subtract(try_multiply({n}, {squares}), try_multiply({s1}, {s1})) AS DOUBLE) / CAST({n} * ({n} - 1) AS DOUBLE)"
    # Beyond 38 digits: divide before multiplying.
    wide = f"(CAST({squares} AS DOUBLE) - CAST({s1} AS DOUBLE) / {count} * CAST({s1} AS DOUBLE)) / ({count} - 1)"
    return f"(CASE WHEN {count} > 1 THEN round(sqrt(greatest(coalesce({exact}, {wide}), 0.0D)) / 100.0D, {scale}) END)"


# Column forms ---------------------------------------------------------------


def money(c: Expr) -> Column:
    """A 2-dp money value as ``decimal(18,2)`` (a double is rounded half-up)."""
    return F.expr(f"CAST({c} AS DECIMAL(18,2))") if isinstance(c, str) else c.cast(MONEY)


def cents(c: Expr) -> Column:
    return F.expr(cents_sql(c)) if isinstance(c, str) else F.round(c * 100, 0).cast("long")


def money_sum(c: Expr) -> Column:
    """Exact total of a money column, as double."""
    return F.expr(money_total_sql(c)) if isinstance(c, str) else (F.sum(cents(c)).cast("double") / 100.0)


def to_double(c: Expr) -> Column:
    return F.expr(f"CAST({c} AS DOUBLE)") if isinstance(c, str) else c.cast("double")


def half_up_ratio(num: Expr, den: Expr, scale: int = 2, mult: int = 1, num_scale: int = 0) -> Column:
    """Column form of :func:`half_up_ratio_sql`."""
    if isinstance(num, str) and isinstance(den, str):
        return F.expr(half_up_ratio_sql(num, den, scale, mult, num_scale))
    num = F.expr(num) if isinstance(num, str) else num
    den = F.expr(den) if isinstance(den, str) else den
    k = int(mult * 10 ** (scale - num_scale))
    n = num.cast(_WIDE) * k
    d = den.cast(_WIDE)
    q = F.call_function("div", F.abs(n) * 2 + d, d * 2)
    signed = F.when(n < 0, -q).otherwise(q)
    return F.when(d != 0, signed.cast("double") / float(10**scale))


def money_avg(c: Expr, scale: int = 2) -> Column:
    if isinstance(c, str):
        return F.expr(money_avg_sql(c, scale))
    return half_up_ratio(F.sum(cents(c)), F.count(c), scale, num_scale=2)


def pct(num: Expr, den: Expr, scale: int = 2) -> Column:
    return half_up_ratio(num, den, scale, mult=100)


def sample_stddev_money(c: str, scale: int = 2) -> Column:
    return F.expr(sample_stddev_money_sql(c, scale))
