"""Operators: bronze -> silver cleaning, gold aggregates, ranking, quality."""

from cartwheel.operators.cleaning import clean_transactions, dedup_by_key  # noqa: F401
from cartwheel.operators.customers import cohort_retention, customer_metrics, rfm_segmentation  # noqa: F401
from cartwheel.operators.quality import (  # noqa: F401
    QualityRules,
    duplicate_count,
    null_profile,
    profile,
    quality_metrics_row,
    quality_report,
)
from cartwheel.operators.ranking import exact_ntile, exact_ntiles, global_rank, global_ranks, global_row_number, top_n_per_group  # noqa: F401
from cartwheel.operators.sales import (  # noqa: F401
    category_trends,
    daily_sales_summary,
    delivery_performance,
    payment_analysis,
    product_performance,
    regional_analysis,
)
from cartwheel.operators.trends import revenue_trends, top_products_by_group  # noqa: F401
