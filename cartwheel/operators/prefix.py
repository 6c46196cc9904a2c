"""Running totals and exact percentiles inside groups of any size.

``SUM(...) OVER (PARTITION BY g ORDER BY o)`` sorts a whole group in one task.  Here the rows are cut into ranges of
the order (group, o), as ``ranking`` does for a global order, so a group with a third of all rows is spread over many
tasks.  As ranges are contiguous in that order, only the first group of a range can have begun in an earlier one:

* the running total is the total inside (range, group) plus, for that one group, its total in all earlier ranges: an
  array with one entry per range, made from one aggregate;
* a percentile's two order statistics lie in (range, group) cells found from counts alone; only rows of these
  cells are sorted.

The caller's frame is read three times (split points, sums per range, rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.money import half_up_ratio_sql
from cartwheel.operators.ranking import MAX_RANGES, _range_of, _split_points, order_key
from cartwheel.operators.stats import _frac
from cartwheel.session import shuffle_partitions

_GROUP, _RANGE, _POINTS, _BEFORE, _V = (f"__cw_p_{x}" for x in ("group", "range", "points", "before", "v"))


def _placed(df: DataFrame, group: Sequence[str], order: Sequence[str], ranges: int) -> DataFrame:
    """``df`` with its order key, its group as one struct and the number of its range."""
    keyed = df.withColumns({"__cw_key0": order_key([*group, *order]), _GROUP: F.struct(*group)})
    placed = keyed.withColumn(_POINTS, _split_points(keyed, 1, ranges).scalar())
    return placed.withColumn(_RANGE, _range_of("__cw_key0", F.col(_POINTS)["__cw_key0"], ranges)).drop(_POINTS)


def running_total(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out_col: str, num_partitions: int | None = None
) -> DataFrame:
    """``sum(value) OVER (PARTITION BY group ORDER BY order ROWS UNBOUNDED PRECEDING)`` as ``out_col``.

    ``order`` (as in ``ranking.order_key``) must be total inside a group for a repeatable result; ``value`` is a SQL
    expression of an exact type (integers, decimals).  NULL groups are one group, NULL values add nothing, and a
    total with no value yet is NULL, as with the window."""
    ranges = max(1, min(MAX_RANGES, num_partitions or shuffle_partitions(df.sparkSession)))
    placed = _placed(df.withColumn(_V, F.expr(value)), group, order, ranges)
    sums = placed.groupBy(_RANGE, _GROUP).agg(F.sum(_V).alias("s"))
    earlier = Window.partitionBy(_GROUP).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    before = sums.select(_RANGE, _GROUP, F.sum("s").over(earlier).alias("s"), F.lag(_RANGE).over(Window.partitionBy(_GROUP).orderBy(_RANGE)).alias("last"))
    entry = F.struct(F.col(_RANGE), F.struct(F.col(_GROUP).alias("g"), "s"))
    table = before.where("last IS NOT NULL").agg(F.map_from_entries(F.collect_list(entry)).alias("m"))  # at most one entry per range
    dense = table.select(F.expr(f"transform(sequence(0, {ranges - 1}), r -> try_element_at(m, r))"))
    local = F.sum(_V).over(Window.partitionBy(_RANGE, _GROUP).orderBy("__cw_key0").rowsBetween(Window.unboundedPreceding, 0))
    out = placed.withColumn(out_col, local).withColumn(_BEFORE, dense.scalar()).withColumn(_BEFORE, F.get(_BEFORE, F.col(_RANGE)))
    add = F.when(F.col(_BEFORE)["g"].eqNullSafe(F.col(_GROUP)), F.col(_BEFORE)["s"])
    total = F.when(add.isNull(), F.col(out_col)).when(F.col(out_col).isNull(), add).otherwise(add + F.col(out_col))
    return out.withColumn(out_col, total).drop(_V, _GROUP, _RANGE, _BEFORE, "__cw_key0")


def group_percentiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    percentiles: dict[str, float],
    scale: int = 2,
    num_scale: int = 0,
    count_col: str = "n",
    num_partitions: int | None = None,
) -> DataFrame:
    """Per group the number of values (``count_col``) and the interpolated percentiles of the integral SQL expression ``value``, exact,
    rounded half up to ``scale`` places after dividing by ``10^num_scale`` (cents: 2).

    For domains of any size: equal values are counted first, ranges of (group, value) are summed, and only the cells
    that hold a wanted order statistic are sorted.  NULL values are not ranked; a group of NULLs gives n = 0 and NULLs."""
    ranges = max(1, min(MAX_RANGES, num_partitions or shuffle_partitions(df.sparkSession)))
    hist = df.withColumn(_V, F.expr(value)).groupBy(*group, _V).agg(F.count(_V).alias("__cw_c"))  # 0 for NULL
    placed = _placed(hist, group, [_V], ranges)
    cells = placed.groupBy(_RANGE, _GROUP).agg(F.sum("__cw_c").alias("c"))
    order = Window.partitionBy(_GROUP).orderBy(_RANGE)
    cells = cells.select(_RANGE, _GROUP, "c", F.sum("c").over(order).alias("upto"), F.sum("c").over(Window.partitionBy(_GROUP)).alias("n"))
    wanted, ranks = [], {}
    for name, p in percentiles.items():
        fr = _frac(p)
        at = f"((n - 1) * {fr.numerator})"
        low = f"({at} div {fr.denominator})"
        ranks[name] = (low, f"({low} + CASE WHEN {at} % {fr.denominator} > 0 THEN 1 ELSE 0 END)", f"({at} % {fr.denominator})", fr.denominator)
        wanted += ranks[name][:2]
    hit = " OR ".join(f"(upto - c <= {w} AND {w} < upto)" for w in dict.fromkeys(wanted))
    cells = cells.where(f"c > 0 AND ({hit})").select(F.col(_RANGE).alias("r"), F.col(_GROUP).alias("g"), (F.col("upto") - F.col("c")).alias("before"), "n")
    counted = placed.where("__cw_c > 0").select(_RANGE, _GROUP, _V, F.col("__cw_c").alias("c"))
    rows = counted.join(cells, F.col(_RANGE).eqNullSafe(F.col("r")) & F.col(_GROUP).eqNullSafe(F.col("g")))
    inside = Window.partitionBy("r", "g").orderBy(_V).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.col("before") + F.sum("c").over(inside))
    found = []
    for name, (low, high, rest, d) in ranks.items():
        a, b = (f"max(CASE WHEN upto - c <= {w} AND {w} < upto THEN {_V} END)" for w in (low, high))
        value_sql = half_up_ratio_sql(f"{a} * {d} + max({rest}) * ({b} - {a})", str(d), scale, num_scale=num_scale)
        found.append(F.expr(f"{value_sql} AS `{name}`"))
    exact = rows.groupBy("g").agg(F.max("n").alias(count_col), *found)
    empty = hist.groupBy(*group).agg(F.sum("__cw_c").alias(count_col)).where(F.col(count_col) == 0)
    out = exact.select(*(F.col("g")[c].alias(c) for c in group), count_col, *percentiles)
    return out.unionByName(empty, allowMissingColumns=True)
