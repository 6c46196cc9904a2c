"""Command line: run the pipeline or print a query.

    python -m cartwheel pipeline --star /data/sf1 --target /warehouse/retail --as-of 2002-01-01
    python -m cartwheel pipeline --generate 50000 --target /warehouse/retail
    python -m cartwheel query regional_analysis --star /data/sf1 [--limit 20]
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="cartwheel")
    sub = p.add_subparsers(dest="cmd", required=True)
    pp = sub.add_parser("pipeline", help="write bronze, silver, gold and append quality history")
    src = pp.add_mutually_exclusive_group(required=True)
    src.add_argument("--star", help="directory with region/nation/customer/part/orders/lineitem parquet")
    src.add_argument("--generate", type=int, help="generate N synthetic transactions")
    pp.add_argument("--target", required=True)
    pp.add_argument("--as-of", default=None)
    pp.add_argument("--format", default="parquet")
    pp.add_argument("--partition-silver", action="store_true", help="partition silver by order_year, order_month")
    pq = sub.add_parser("query", help="run one registered query and print rows as JSON lines")
    pq.add_argument("name")
    pq.add_argument("--star", required=True)
    pq.add_argument("--limit", type=int, default=None, help="print only so many rows (default: all)")
    args = p.parse_args(argv)

    from cartwheel.session import get_session

    spark = get_session()
    if args.cmd == "pipeline":
        from cartwheel.operators.quality import QualityRules
        from cartwheel.plans.catalog import STAR_RULES
        from cartwheel.plans.pipeline import run_pipeline
        from cartwheel.sources import generate_transactions, load_star, transactions_from_star

        as_of = _dt.date.fromisoformat(args.as_of) if args.as_of else None
        rules = QualityRules()
        if args.star:
            rules = STAR_RULES
            bronze = transactions_from_star(load_star(spark, args.star))
        else:
            bronze = generate_transactions(spark, n=args.generate)
        out = run_pipeline(
            bronze,
            args.target,
            as_of=as_of,
            fmt=args.format,
            rules=rules,
            silver_partition_by=("order_year", "order_month") if args.partition_silver else None,
        )
        print(json.dumps(out, indent=2))
    else:
        from cartwheel.plans.catalog import QUERIES

        df = QUERIES[args.name](spark, args.star)
        for row in (df if args.limit is None else df.limit(args.limit)).toLocalIterator():
            print(json.dumps(row.asDict(), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
