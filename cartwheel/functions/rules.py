"""Row classification rules of the silver layer (first matching branch wins)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SizeRule:
    """quantity > ``high_above`` -> 'High', else 'Normal'."""

    high_above: int = 3


@dataclass(frozen=True)
class ValueRule:
    """amount > premium_above -> 'Premium'; > standard_above -> 'Standard'; else 'Budget'."""

    premium_above: float = 50000.0
    standard_above: float = 10000.0


@dataclass(frozen=True)
class DeliveryRule:
    """days <= express_max -> 'Express'; <= fast_max -> 'Fast'; else (NULL too) 'Standard'."""

    express_max: int = 3
    fast_max: int = 7


def order_size(quantity: Column, rule: SizeRule = SizeRule()) -> Column:
    return F.when(quantity > rule.high_above, "High").otherwise("Normal")


def order_value_segment(amount: Column, rule: ValueRule = ValueRule()) -> Column:
    return (
        F.when(amount > rule.premium_above, "Premium")
        .when(amount > rule.standard_above, "Standard")
        .otherwise("Budget")
    )


def delivery_type(days: Column, rule: DeliveryRule = DeliveryRule()) -> Column:
    return (
        F.when(days <= rule.express_max, "Express")
        .when(days <= rule.fast_max, "Fast")
        .otherwise("Standard")
    )


def order_size_sql(quantity: str, rule: SizeRule = SizeRule()) -> str:
    return f"CASE WHEN {quantity} > {rule.high_above} THEN 'High' ELSE 'Normal' END"


def order_value_segment_sql(amount: str, rule: ValueRule = ValueRule()) -> str:
    return (
        f"CASE WHEN {amount} > {rule.premium_above!r} THEN 'Premium' "
        f"WHEN {amount} > {rule.standard_above!r} THEN 'Standard' ELSE 'Budget' END"
    )


def delivery_type_sql(days: str, rule: DeliveryRule = DeliveryRule()) -> str:
    return (
        f"CASE WHEN {days} <= {rule.express_max} THEN 'Express' "
        f"WHEN {days} <= {rule.fast_max} THEN 'Fast' ELSE 'Standard' END"
    )
