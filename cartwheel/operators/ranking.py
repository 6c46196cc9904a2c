"""Distributed ranking: global row numbers and NTILE without a single-partition window.

``F.row_number().over(Window.orderBy(...))`` and ``F.ntile`` over an
unpartitioned window move every row into one task.  Here the total order
(the caller's keys plus tie-breakers) is cut into ranges, and each range is
numbered on its own; one plan for every input size, and no job before the action:

1. the order becomes one comparable struct per row (``order_key``);
2. split points are the quantiles of a bounded sample of keys, those of
   smallest hash — the same for any partitioning and after any retry, so
   nothing has to be frozen in a checkpoint;
3. each row finds its range by binary search among the split points;
4. rows per range are counted (partial aggregation, one row per range) and
   summed up (a window over these rows, a scalar subquery); ``row_number``
   inside each range plus the rows of all earlier ranges is the position.

A value shared by a third of all rows is still split by the tie-breaker.
Split points only lay out the work; positions are exact for any choice of them.
The sample and the counts come from the caller's frame once more each: rank an
aggregate or a stored table, whose exchanges Spark reuses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.session import shuffle_partitions

_KEY = "__cw_key"
_RANGE = "__cw_range"
_POINTS = "__cw_points"
_OFF = "__cw_off"

SAMPLE_PER_RANGE = 20  # sampled keys for each range
MAX_RANGES = 1024  # at most 20,480 sampled keys


def order_key(order: Sequence[str]) -> Column:
    """The order as one comparable struct.  ``"c"`` sorts ascending, NULL first;
    ``"-c"`` (numbers without NaN) descending, NULL last."""
    parts = []
    for i, c in enumerate(order):
        if c.startswith("-"):
            v = F.col(c[1:])
            parts += [v.isNull().alias(f"n{i}"), (-v).alias(f"k{i}")]
        else:
            parts.append(F.col(c).alias(f"k{i}"))
    return F.struct(*parts)


def _split_points(keys: DataFrame, m: int, ranges: int) -> DataFrame:
    """One row, one struct of ``m`` arrays: at most ``ranges - 1`` ascending keys of each order."""
    rows, names = ranges * SAMPLE_PER_RANGE, [f"{_KEY}{i}" for i in range(m)]
    sample = keys.select(*names).orderBy(F.xxhash64(*names), *names).limit(rows)
    lists = sample.agg(*(F.sort_array(F.collect_list(k)).alias(k) for k in names))  # at most ``rows`` keys
    each = "greatest(1, CAST(ceil(size({k}) / {n}) AS INT))"
    cut = "filter({k}, (x, i) -> i > 0 AND i % {each} = 0)"
    return lists.select(F.struct(*(F.expr(cut.format(k=k, each=each.format(k=k, n=ranges))).alias(k) for k in names)))


def _range_of(key: str, points: Column, ranges: int) -> Column:
    """How many split points are at or below ``key``: a binary search."""
    steps = [1 << b for b in range(max(1, ranges - 1).bit_length() - 1, -1, -1)]
    size = F.size(points)

    def step(at: Column, by: Column) -> Column:
        there = F.get(points, at + by - 1)
        return F.when((at + by <= size) & (there <= F.col(key)), at + by).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def _offsets(placed: DataFrame, m: int, ranges: int) -> DataFrame:
    """One row, one struct: for each order an array (range -> rows in all earlier ranges), and the row total."""
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("w"), F.col(f"{_RANGE}{i}").alias("r")) for i in range(m))))
    counts = placed.select(each.alias("at")).groupBy("at.w", "at.r").agg(F.count("*").alias("n"))
    order = Window.partitionBy("w").orderBy("r")  # one row per range: at most ``ranges``
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = counts.select("w", "r", before.alias("before"), F.sum("n").over(Window.partitionBy("w")).alias("n"))
    pairs = "map_from_entries(collect_list(CASE WHEN w = {i} THEN struct(r, before) END)) AS m{i}"
    maps = sums.agg(*(F.expr(pairs.format(i=i)) for i in range(m)), F.max("n").alias("n"))
    dense = f"transform(sequence(0, {ranges - 1}), r -> try_element_at(m{{i}}, r)) AS a{{i}}"
    return maps.select(F.struct(*(F.expr(dense.format(i=i)) for i in range(m)), "n"))


def global_ranks(
    df: DataFrame,
    orders: dict[str, Sequence[str]],
    total_col: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add, for each ``name: order``, the 0-based position of each row in that
    total order (and optionally the row total) with the scheme above.  Each
    order must be total (end with a unique key) for a deterministic result.
    ``df`` is read three times, however many orders there are: for the sample,
    the counts and the rows."""
    m, ranges = len(orders), max(1, min(MAX_RANGES, num_partitions or shuffle_partitions(df.sparkSession)))
    keyed = df.withColumns({f"{_KEY}{i}": order_key(o) for i, o in enumerate(orders.values())})
    placed = keyed.withColumn(_POINTS, _split_points(keyed, m, ranges).scalar())
    found = {f"{_RANGE}{i}": _range_of(f"{_KEY}{i}", F.col(_POINTS)[f"{_KEY}{i}"], ranges) for i in range(m)}
    placed = placed.withColumns(found).drop(_POINTS)
    out = placed
    for i, name in enumerate(orders):
        local = Window.partitionBy(f"{_RANGE}{i}").orderBy(f"{_KEY}{i}")
        out = out.withColumn(name, F.row_number().over(local))
    out = out.withColumn(_OFF, _offsets(placed, m, ranges).scalar())
    out = out.withColumns({name: F.get(F.col(_OFF)[f"a{i}"], F.col(f"{_RANGE}{i}")) + F.col(name) - 1 for i, name in enumerate(orders)})
    if total_col:
        out = out.withColumn(total_col, F.col(_OFF)["n"])
    return out.drop(_OFF, *(f"{c}{i}" for c in (_KEY, _RANGE) for i in range(m)))


def global_rank(df: DataFrame, order: Sequence[str], rank_col: str = "global_rank", total_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """:func:`global_ranks` of one order."""
    return global_ranks(df, {rank_col: order}, total_col, num_partitions)


def global_row_number(df: DataFrame, order: Sequence[str], out_col: str = "row_number", num_partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (ORDER BY order)`` (1-based, int)."""
    ranked = global_rank(df, order, "__cw_rank", num_partitions=num_partitions)
    return ranked.withColumn(out_col, (F.col("__cw_rank") + 1).cast("int")).drop("__cw_rank")


def ntile_of_rank(rank: Column, total: Column, n: int) -> Column:
    """NTILE bucket (1-based) of 0-based ``rank`` among ``total`` rows: the first
    ``total mod n`` buckets hold one row more than the others."""
    q = F.call_function("div", total, F.lit(n))
    r = total % n
    big = r * (q + 1)  # rows in the larger buckets
    return (
        F.when(rank < big, F.call_function("div", rank, q + 1) + 1)
        .otherwise(F.call_function("div", rank - big, F.greatest(q, F.lit(1))) + r + 1)
        .cast("int")
    )


def exact_ntiles(df: DataFrame, n: int, orders: dict[str, Sequence[str]], num_partitions: int | None = None) -> DataFrame:
    """``NTILE(n) OVER (ORDER BY order)`` for each ``name: order``, with the same bucket sizes as Spark's."""
    ranked = global_ranks(df, orders, "__cw_total", num_partitions)
    return ranked.withColumns({name: ntile_of_rank(F.col(name), F.col("__cw_total"), n) for name in orders}).drop("__cw_total")


def exact_ntile(df: DataFrame, n: int, order: Sequence[str], out_col: str = "ntile", num_partitions: int | None = None) -> DataFrame:
    """:func:`exact_ntiles` of one order."""
    return exact_ntiles(df, n, {out_col: order}, num_partitions)


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    n: int,
    out_col: str = "rank",
) -> DataFrame:
    """Rows ranked 1..n inside each group by ``order`` (``row_number``, so exactly
    ``min(n, group size)`` rows per group).  Spark plans the ``rank <= n``
    filter as a partial WindowGroupLimit before the shuffle: each map task
    forwards at most n rows per group, so a huge group is cut down map-side."""
    sort = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*group).orderBy(*sort)
    return df.withColumn(out_col, F.row_number().over(w)).filter(F.col(out_col) <= n)
