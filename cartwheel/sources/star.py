"""Bronze transactions from a TPC-H-style star schema.

One bronze row per ``lineitem`` row:

=================  ====================================================
order_id           ``l_orderkey-l_linenumber-l_partkey-l_suppkey-l_quantity-
                   l_shipdate``: identifies a line item (order and line
                   number alone repeat with different content)
customer_id        ``c_custkey`` as string (the bronze schema's type)
product_name       ``p_name``
category           ``p_type``
quantity           ``l_quantity`` as bigint
unit_price         ``p_retailprice``
order_date         ``o_orderdate``
region             ``r_name`` (customer's nation's region)
payment_method     ``o_orderpriority``
delivery_days      ``1 + pmod(datediff(l_shipdate, o_orderdate), 30)``
is_returned        ``l_returnflag = 'R'`` as 0/1
=================  ====================================================

Join plan (all inner equi-joins).  The customer dimension (customer ->
nation -> region) is resolved on the order side, which is ~1/4 of the line
items; the line items join it on orderkey and then part on partkey.  The
fact-to-orders join is pinned to sort-merge (both sides grow with the data; a
column-pruned fact scan must never be broadcast).  All other joins are
Spark's choice (broadcast below ``spark.sql.autoBroadcastJoinThreshold``, else
sort-merge); AQE re-plans on measured sizes and splits skewed join keys.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from cartwheel.sources.layout import write_bucketed

STAR_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")

_CACHE: dict[tuple[str, str, tuple], dict[str, DataFrame]] = {}


def _fingerprint(spark: SparkSession, sf_dir: str, names) -> tuple:
    """Path, length and modification time of every input file, by the Hadoop file system."""
    out = []
    for n in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{n}.parquet")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
        digest, seen = hashlib.sha256(), []
        while files.hasNext():
            f = files.next()
            seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
        for line in sorted(seen):
            digest.update(line.encode())
        out.append((n, digest.hexdigest()[:16]))
    return tuple(out)


def load_star(spark: SparkSession, sf_dir: str, names=STAR_TABLES) -> dict[str, DataFrame]:
    """Scan DataFrames of the star tables, reused within a session (file
    listing and footer reads happen once per directory)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _fingerprint(spark, sf_dir, names))
    cached = _CACHE.get(key)
    if cached is None:
        cached = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names}
        _CACHE[key] = cached
    return cached


def bucketed_fact(tables: dict[str, DataFrame], database: str, buckets: int, location: str | None = None) -> dict[str, DataFrame]:
    """``tables`` with line items and orders (resolved to customer and region) stored as catalog tables bucketed
    by order key: the fact join, and a de-duplication keyed on the order key first, then share that
    layout and need no exchange of the fact."""
    at = (lambda name: f"{location}/{name}") if location else (lambda name: None)
    orders = _orders_with_region(tables)
    return {
        **tables,
        "lineitem": write_bucketed(tables["lineitem"], f"{database}.fact_lineitem", ["l_orderkey"], buckets, at("fact_lineitem")),
        "orders_x": write_bucketed(orders, f"{database}.fact_orders", ["o_orderkey"], buckets, at("fact_orders")),
    }


def _orders_with_region(tables: dict[str, DataFrame]) -> DataFrame:
    region, nation, customer, orders = (tables[t] for t in ("region", "nation", "customer", "orders"))
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    cust = customer.join(geo, customer.c_nationkey == geo.n_nationkey)
    return orders.join(cust, orders.o_custkey == cust.c_custkey)


def transactions_from_star(tables: dict[str, DataFrame], keep: tuple[str, ...] = ()) -> DataFrame:
    """Map the star schema to the bronze transaction layout (see module doc), with the source columns ``keep``
    besides.  ``tables`` may hold the orders already resolved, see :func:`bucketed_fact`."""
    # Catalyst prunes every scan to the columns used (ReadSchema of lineitem:
    # orderkey, partkey, suppkey, linenumber, quantity, returnflag, shipdate).
    # The day and the flag are taken before the exchanges: a timestamp and a
    # text are twice as wide there as a day number and a boolean.
    part = tables["part"]
    lineitem = tables["lineitem"].selectExpr("*", "CAST(l_shipdate AS DATE) AS __shipped", "l_returnflag = 'R' AS __returned")
    # Fact x orders: both grow with the data, so always a sort-merge join on
    # orderkey (a pruned fact scan can look small enough to broadcast; it must
    # not be).  Its output stays hash-partitioned by l_orderkey.
    orders_x = (tables.get("orders_x") or _orders_with_region(tables)).hint("merge")
    with_orders = lineitem.join(orders_x, lineitem.l_orderkey == orders_x.o_orderkey)
    joined = with_orders.join(part, with_orders.l_partkey == part.p_partkey)

    cols = [
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT), "
        "date_format(__shipped, 'yyyyMMdd')) AS order_id",
        "CAST(c_custkey AS STRING) AS customer_id",
        "p_name AS product_name",
        "p_type AS category",
        "CAST(l_quantity AS BIGINT) AS quantity",
        "p_retailprice AS unit_price",
        "o_orderdate AS order_date",
        "r_name AS region",
        "o_orderpriority AS payment_method",
        "CAST(pmod(datediff(__shipped, CAST(o_orderdate AS DATE)), 30) + 1 AS BIGINT) AS delivery_days",
        "CAST(CASE WHEN __returned THEN 1 ELSE 0 END AS BIGINT) AS is_returned",
    ]
    return joined.selectExpr(*cols, *keep)
