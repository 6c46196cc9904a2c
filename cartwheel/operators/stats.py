"""Exact interpolated percentiles of an integral column, from a value histogram.

``PERCENTILE(x, p)`` interpolates between the order statistics at positions
``floor(p*(n-1))`` and ``ceil(p*(n-1))``.  For an integral column (days,
units) the result is a rational number, and rounding the double result half
up is not stable (``a + 0.05*(b-a)`` sits on a rounding tie).  Here the
interpolation is done exactly:

* one histogram row per (group, value) — partial-aggregated before the
  shuffle, so its size is groups x distinct values, independent of row count
  and of skew;
* a running count per group over that histogram locates both order
  statistics; with ``p = k/D``, ``p*(n-1) = (k*(n-1)) / D`` in integers;
* value = ``(D*a + rem*(b-a)) / D``, rounded half-up by integral division.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.money import half_up_ratio_sql


def _frac(p: float) -> Fraction:
    return Fraction(str(p)).limit_denominator(10**6)


def percentile_columns(
    hist: DataFrame,
    group: Sequence[str],
    value: str,
    count: str,
    percentiles: dict[str, float],
    scale: int = 1,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Given a histogram ``(group..., value, count, ...)``, return per group the
    exact interpolated percentiles named in ``percentiles`` (rounded half up
    to ``scale`` places; NULL values are not ranked) plus any ``extra``
    aggregate expressions over the histogram's columns — all from one window
    pass and one aggregate that reuses the window's partitioning."""
    part = ", ".join(f"`{g}`" for g in group)
    present = f"CASE WHEN `{value}` IS NOT NULL THEN `{count}` ELSE 0 END"
    h = hist.selectExpr(
        "*",
        f"`{value}` AS __v",
        f"`{count}` AS __c",
        f"sum({present}) OVER (PARTITION BY {part} ORDER BY `{value}` ASC NULLS LAST"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS __cum",
        f"sum({present}) OVER (PARTITION BY {part}) AS __n",
    )
    aggs = [F.expr(e) for e in extra]
    for name, p in percentiles.items():
        fr = _frac(p)
        k, d = fr.numerator, fr.denominator
        pos = f"((__n - 1) * {k})"
        lo = f"({pos} div {d})"
        rem = f"({pos} - {lo} * {d})"
        hi = f"({lo} + CASE WHEN {rem} > 0 THEN 1 ELSE 0 END)"
        a = f"max(CASE WHEN __v IS NOT NULL AND __cum - __c <= {lo} AND {lo} < __cum THEN __v END)"
        b = f"max(CASE WHEN __v IS NOT NULL AND __cum - __c <= {hi} AND {hi} < __cum THEN __v END)"
        r = f"max(CASE WHEN __n > 0 THEN {rem} END)"
        aggs.append(F.expr(f"{half_up_ratio_sql(f'{a} * {d} + {r} * ({b} - {a})', str(d), scale)} AS `{name}`"))
    return h.groupBy(*group).agg(*aggs)
