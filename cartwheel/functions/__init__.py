"""Column-expression helpers shared by the operators (all JVM-side, codegen-able)."""

from cartwheel.functions.money import (  # noqa: F401
    MONEY,
    cents,
    cents_sql,
    dollars_sql,
    half_up_ratio,
    half_up_ratio_sql,
    money,
    money_avg,
    money_avg_sql,
    money_sum,
    money_total_sql,
    pct,
    pct_sql,
    sample_stddev_money,
    sample_stddev_money_sql,
    sum_cents_sql,
    to_double,
)
from cartwheel.functions.dates import month_start, whole_months_between  # noqa: F401
from cartwheel.functions.rules import (  # noqa: F401
    DeliveryRule,
    SizeRule,
    ValueRule,
    delivery_type,
    order_size,
    order_value_segment,
)
