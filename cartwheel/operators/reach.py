"""Distinct counts that roll up: mergeable sketches kept per day, united per month, region and in total.

An exact distinct count of a month cannot be made from those of its days.  ``daily_sketches`` keeps one HyperLogLog
sketch per (day, group): a bounded binary, written once; ``rolled_up`` unites them for any coarser grouping without reading
the facts again.  The standard error of a sketch is about ``1.04 / sqrt(2 ** lg_k)``.  Exact counts stay the
default everywhere else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 14  # standard error 0.8 %, at most 16 KB a sketch


def daily_sketches(silver: DataFrame, value: str = "customer_id", group: Sequence[str] = ("region",), day: str = "order_date", lg_k: int = LG_K) -> DataFrame:
    """day, group, ``sketch`` of the day's distinct ``value`` (NULL is not counted)."""
    return silver.groupBy(day, *group).agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias("sketch"))


def rolled_up(sketches: DataFrame, sets: Sequence[Sequence[str]], out_col: str = "estimate") -> DataFrame:
    """The estimated distinct count of every grouping set, from the stored sketches alone."""
    cols = list(dict.fromkeys(c for s in sets for c in s))
    by = sketches.groupingSets([[F.col(c) for c in s] for s in sets], *map(F.col, cols))
    return by.agg(F.grouping_id().alias("level"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out_col))


def exact_counts(silver: DataFrame, sets: Sequence[Sequence[str]], value: str = "customer_id", out_col: str = "exact") -> DataFrame:
    """The exact distinct count of every grouping set; (set, value) pairs collapse map-side."""
    cols = list(dict.fromkeys(c for s in sets for c in s))
    by = silver.groupingSets([[F.col(c) for c in s] for s in sets], *map(F.col, cols))
    return by.agg(F.grouping_id().alias("level"), F.countDistinct(value).alias(out_col))


def measured_rollup(silver: DataFrame, sketches: DataFrame, sets: Sequence[Sequence[str]], value: str = "customer_id", tolerance: float = 0.05) -> DataFrame:
    """Per grouping set: exact count, estimate, and ``within`` (the estimate is off by at most ``tolerance``, and one)."""
    cols = list(dict.fromkeys(c for s in sets for c in s))
    guess = rolled_up(sketches, sets).withColumnsRenamed({c: f"__{c}" for c in [*cols, "level"]})
    match = F.lit(True)
    for c in [*cols, "level"]:
        match = match & F.col(c).eqNullSafe(F.col(f"__{c}"))
    both = exact_counts(silver, sets, value).join(guess, match)
    within = F.abs(F.col("estimate") - F.col("exact")) <= F.lit(tolerance) * F.col("exact") + 1
    return both.select(*cols, "level", "exact", "estimate", within.alias("within"))
