"""Time-series and top-N gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.money import dollars_sql, half_up_ratio_sql, pct_sql, sum_cents_sql
from cartwheel.operators.ranking import top_n_per_group


def revenue_trends(silver: DataFrame, window: int = 7, limit: int | None = None) -> DataFrame:
    """Daily revenue per region with running total, previous day, growth and a
    trailing ``window``-row moving average.

    "Previous day" is the previous *row* of the region (gaps are not filled) and
    the moving average spans ``window`` rows, fewer at the start — as in the
    reference.  Daily revenue is exact to the cent; the running total is exact;
    the moving average is exact to 6 dp (the scale of a decimal average);
    growth is rounded half-up to 2 dp and NULL on the first row or a zero
    previous day.  The reference's ``LIMIT 100`` truncated the table; here
    ``limit`` is opt-in.  All frames share one partitioning and ordering, so
    Spark evaluates them in one Window operator after one sort.
    """
    daily = silver.groupBy("order_date", "region").agg(F.expr(f"{sum_cents_sql('order_amount')} AS __daily"))
    spec = "PARTITION BY region ORDER BY order_date"
    prev = f"lag(__daily, 1) OVER ({spec})"
    trail = f"({spec} ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"
    out = daily.selectExpr(
        "order_date",
        "region",
        f"{dollars_sql('__daily')} AS daily_revenue",
        f"{dollars_sql(f'sum(__daily) OVER ({spec} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')}"
        " AS cumulative_revenue",
        f"{dollars_sql(prev)} AS prev_day_revenue",
        f"{pct_sql(f'__daily - {prev}', prev)} AS revenue_growth_pct",
        f"{half_up_ratio_sql(f'sum(__daily) OVER {trail}', f'count(__daily) OVER {trail}', 6, num_scale=2)}"
        f" AS moving_avg_{window}day",
    )
    if limit is not None:
        out = out.orderBy(F.col("region").asc(), F.col("order_date").desc()).limit(limit)
    return out


def top_products_by_group(silver: DataFrame, group: str = "region", n: int = 5) -> DataFrame:
    """Top ``n`` products by revenue inside each ``group`` value.

    Ranked on the exact revenue, ties broken by product then category, so
    each group yields exactly ``min(n, products)`` rows.
    """
    agg = silver.groupBy(group, "product_name", "category").agg(
        F.expr(f"{sum_cents_sql('order_amount')} AS __revenue"),
        F.expr("sum(quantity) AS total_units"),
        F.expr("count(1) AS order_count"),
    )
    ranked = top_n_per_group(
        agg,
        [group],
        [F.col("__revenue").desc(), F.col("product_name").asc_nulls_first(), F.col("category").asc_nulls_first()],
        n,
        out_col=f"rank_in_{group}",
    )
    return ranked.selectExpr(
        group,
        "product_name",
        "category",
        f"{dollars_sql('__revenue')} AS total_revenue",
        "total_units",
        "order_count",
        f"rank_in_{group}",
    )
