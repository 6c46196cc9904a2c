"""Bronze -> silver: typing, derived columns, validity filter, de-duplication."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.rules import (
    DeliveryRule,
    SizeRule,
    ValueRule,
    delivery_type_sql,
    order_size_sql,
    order_value_segment_sql,
)
from cartwheel.schemas import SILVER_COLUMNS, SURVIVOR_ORDER


def as_of_date(as_of: _dt.date | str | None) -> Column:
    """The processing clock: a fixed date when given, else ``current_date()``."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def as_of_sql(as_of: _dt.date | str | None) -> str:
    """SQL text of the processing clock (see :func:`as_of_date`)."""
    if as_of is None:
        return "current_date()"
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return f"DATE '{as_of.isoformat()}'"


def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep one row per key: the first by ``order`` (ascending, NULLs first).

    ``row_number() = 1`` is planned as a *partial* WindowGroupLimit before the
    shuffle, so each map task already collapses its copies of a key: a key
    holding a third of all rows ships one row per map task, not all of them.
    When the input is already hash-partitioned on (a prefix of) the keys, no
    shuffle is added at all.
    """
    rn = "__cartwheel_rn"
    if all(isinstance(c, str) for c in order):
        by = ", ".join(f"`{k}`" for k in keys)
        ob = ", ".join(f"`{c}` ASC NULLS FIRST" for c in order)
        ranked = df.selectExpr("*", f"row_number() OVER (PARTITION BY {by} ORDER BY {ob}) AS {rn}")
    else:
        order_cols = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
        ranked = df.withColumn(rn, F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols)))
    return ranked.filter(f"{rn} = 1").drop(rn)


#: Of how many repeated hashes of keys :func:`dedup_measured` still broadcasts the list.
RARE_KEYS = 100_000


def _repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    n = "__cartwheel_n"
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)).where(f"{n} > 1").select(*(F.col(k).alias(f"__cartwheel_{k}") for k in keys))


def _rank_copies(df: DataFrame, repeated: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__cartwheel_{k}"))
    copies = df.join(repeated, same, "left_semi")
    return df.join(repeated, same, "left_anti").unionByName(dedup_by_key(copies, keys, order))


def dedup_rare_copies(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """:func:`dedup_by_key` for a stored table in which few keys have copies.

    A first, narrow pass (key columns only, counted map-side) finds the keys that occur more than once.  Rows of
    all other keys go straight through an anti-join; only the copies are ranked.  So where the repeated keys
    are small enough to be broadcast (Spark's threshold on their measured size), no wide row is shuffled or
    sorted but copies; where they are not, both joins shuffle, and the window alone is the better plan.  ``df``
    is read three times.  NULL keys are one key."""
    return _rank_copies(df, _repeated_keys(df, keys), keys, order)


_HASH = "__cartwheel_hash"


def _shared_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The 64-bit hashes of ``keys`` that more than one row has, counted at once and kept; None if they are more than
    ``RARE_KEYS``.  A key of no such hash occurs once; rows of such a hash must still be told apart by their keys.

    Hashes are a fraction of what wide text keys take in the exchange and in each task's hash map."""
    if any(getattr(df.schema[k].dataType, "collation", "UTF8_BINARY") != "UTF8_BINARY" for k in keys):
        return None  # equal keys of other bytes would have other hashes
    n = "__cartwheel_n"
    hashes = df.select(F.xxhash64(*keys).alias(_HASH))
    found = hashes.groupBy(_HASH).agg(F.count(F.lit(1)).alias(n)).where(f"{n} > 1").select(_HASH).limit(RARE_KEYS + 1).persist()
    if found.count() <= RARE_KEYS:
        return found
    found.unpersist()
    return None


def surplus_rows(df: DataFrame, keys: Sequence[str]) -> int | None:
    """Rows less distinct keys (NULL is a key) of a stored table, exact, counted at once; None if too many keys are repeated
    (see :func:`_shared_hashes`): then a plain distinct count is the better plan."""
    shared = _shared_hashes(df, keys)
    if shared is None:
        return None
    copies = df.select(*keys).withColumn(_HASH, F.xxhash64(*keys)).join(F.broadcast(shared), _HASH, "left_semi")
    more = 0
    if not shared.isEmpty():
        more = copies.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shared.unpersist()
    return more


def dedup_measured(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """:func:`dedup_rare_copies` or :func:`dedup_by_key`, for a stored table of which neither is known to suit.

    A narrow pass over the keys' hashes runs at once.  With at most ``RARE_KEYS`` repeated hashes, their list is broadcast and
    no wide row but those of such a hash is shuffled or sorted (keys that only share a hash are ranked apart, so both stay); with
    more, all rows go through the window."""
    shared = _shared_hashes(df, keys)
    if shared is None:
        return dedup_by_key(df, keys, order)
    if shared.isEmpty():
        shared.unpersist()
        return df
    hashed, among = df.withColumn(_HASH, F.xxhash64(*keys)), F.broadcast(shared)
    copies = hashed.join(among, _HASH, "left_semi").select(*df.columns)
    return hashed.join(among, _HASH, "left_anti").select(*df.columns).unionByName(dedup_by_key(copies, keys, order))


def clean_transactions(
    bronze: DataFrame,
    as_of: _dt.date | str | None = None,
    size_rule: SizeRule = SizeRule(),
    value_rule: ValueRule = ValueRule(),
    delivery_rule: DeliveryRule = DeliveryRule(),
    dedup_keys: Sequence[str] = ("order_id",),
    strict: bool = True,
    rare_copies: bool | None = False,
) -> DataFrame:
    """The silver order table (20 columns, see ``schemas.SILVER_COLUMNS``).

    Steps, in the reference's order:

    1. type the 11 bronze columns; ``unit_price`` rounded to 2 dp;
       ``order_amount = round(quantity * raw unit_price, 2)`` — the *raw*
       price, not the rounded one;
    2. keep rows with rounded ``unit_price > 0``, ``quantity > 0`` and
       ``order_amount > 0`` (a NULL in any of them drops the row);
    3. one row per ``order_id``, the survivor being the first by
       ``schemas.SURVIVOR_ORDER`` — deterministic, unlike ``dropDuplicates``;
    4. calendar parts, size / value / delivery classes and the processing date.

    ``dedup_keys`` may name other key columns equivalent to ``order_id`` (e.g.
    the source line key), which are dropped from the output.  With
    ``strict=False`` casts are ``try_cast``: a value that does not fit becomes
    NULL (and the row is then dropped by step 2 if it is a quantity) instead of
    failing the job.  ``rare_copies`` (for a stored bronze table) ranks only the
    rows of repeated keys, see :func:`dedup_rare_copies`; None counts them first, see :func:`dedup_measured`.
    """
    extra = [k for k in dedup_keys if k not in SILVER_COLUMNS]
    # One SQL projection per step: the expression trees are built JVM-side.
    cast = "CAST" if strict else "try_cast"
    typed = bronze.selectExpr(
        "order_id",
        "customer_id",
        "product_name",
        "category",
        f"{cast}(quantity AS INT) AS quantity",
        "round(unit_price, 2) AS unit_price",
        f"{cast}(order_date AS DATE) AS order_date",
        "region",
        "payment_method",
        f"{cast}(delivery_days AS INT) AS delivery_days",
        f"{cast}(is_returned AS INT) AS is_returned",
        "round(quantity * unit_price, 2) AS order_amount",  # bronze quantity x raw price
        *extra,
    )
    valid = typed.filter("unit_price > 0 AND quantity > 0 AND order_amount > 0")
    order = SURVIVOR_ORDER if "order_id" in dedup_keys else [*SURVIVOR_ORDER, "order_id"]
    dedup = dedup_measured if rare_copies is None else dedup_rare_copies if rare_copies else dedup_by_key
    survivors = dedup(valid, list(dedup_keys), order)
    return survivors.selectExpr(
        *SILVER_COLUMNS[:12],
        "year(order_date) AS order_year",
        "month(order_date) AS order_month",
        "dayofweek(order_date) AS day_of_week",
        "weekofyear(order_date) AS week_of_year",
        f"{order_size_sql('quantity', size_rule)} AS order_size",
        f"{order_value_segment_sql('order_amount', value_rule)} AS order_value_segment",
        f"{delivery_type_sql('delivery_days', delivery_rule)} AS delivery_type",
        f"{as_of_sql(as_of)} AS processing_date",
    )
