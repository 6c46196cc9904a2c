"""Display order of the gold tables ("sort on read").

``ORDER BY`` inside a table creation fixes no stored order, so the order the
reference gives each gold table is applied when the table is read.  Every
ordering is completed with the remaining columns as ascending tie-breakers,
so a display (and a display limit) is reproducible.  A global sort is Spark's
range-partitioned sort; with a limit it becomes a per-partition top-k merged
on the driver (``TakeOrderedAndProject``) — no full sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.operators.ranking import global_row_number

# Sort order of each gold table and the row limit of its display query in the
# reference (fixed values).
REFERENCE_ORDER: dict[str, list[str]] = {
    "daily_sales_summary": ["order_date DESC", "region ASC"],
    "customer_metrics": ["lifetime_value DESC"],
    "product_performance": ["total_revenue DESC"],
    "regional_analysis": ["total_revenue DESC"],
    "category_trends": ["order_month DESC", "category ASC"],
    "customer_segmentation": ["lifetime_value DESC"],
    "delivery_performance": ["region ASC", "avg_delivery_days ASC"],
    "revenue_trends": ["region ASC", "order_date DESC"],
    "top_products_by_region": ["region ASC", "rank_in_region ASC"],
    "customer_cohorts": ["cohort_month DESC", "months_since_cohort ASC"],
    "payment_analysis": ["total_revenue DESC"],
}
DISPLAY_LIMIT: dict[str, int] = {
    "daily_sales_summary": 20,
    "category_trends": 30,
    "customer_segmentation": 30,
    "revenue_trends": 50,
}


def _sort_col(spec: str):
    name, _, direction = spec.partition(" ")
    c = F.col(name)
    return c.desc_nulls_last() if direction.upper() == "DESC" else c.asc_nulls_first()


def ordered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` sorted by ``order`` (``"col ASC|DESC"``), then by every other column."""
    named = [s.partition(" ")[0] for s in order]
    rest = [c for c in df.columns if c not in named]
    return df.orderBy(*[_sort_col(s) for s in order], *[F.col(c).asc_nulls_first() for c in rest])


def present(name: str, df: DataFrame, limit: int | str | None = None) -> DataFrame:
    """Gold table ``name`` in the reference's display order: all rows, the first
    ``limit`` (0: none), or with ``"display"`` as many as the reference shows."""
    out = ordered(df, REFERENCE_ORDER[name])
    n = DISPLAY_LIMIT.get(name) if limit == "display" else limit
    return out if n is None else out.limit(n)


def positioned(name: str, df: DataFrame, limit: int | str | None = None) -> DataFrame:
    """:func:`present` with each row's ``position`` (1-based), so that the order survives a write or a shuffle.

    A limited display numbers its few rows in one window; without a limit positions come from the
    distributed row number (no single-partition sort)."""
    order = REFERENCE_ORDER[name]
    n = DISPLAY_LIMIT.get(name) if limit == "display" else limit
    if n is None:
        named = [s.partition(" ")[0] for s in order]
        keys = ["-" + c if s.endswith("DESC") else c for s, c in zip(order, named, strict=True)]
        out = global_row_number(df, [*keys, *(c for c in df.columns if c not in named)], "position")
        return out.withColumn("position", F.col("position").cast("long"))
    shown = present(name, df, n)
    rest = [c for c in df.columns if c not in {s.partition(" ")[0] for s in order}]
    rank = F.row_number().over(Window.orderBy(*[_sort_col(s) for s in order], *[F.col(c).asc_nulls_first() for c in rest]))  # n rows
    return shown.withColumn("position", rank.cast("long"))
