"""Command line: list, run or export the queries.

  python -m tillsight list
  python -m tillsight run QUERY (--tables DIR | --csv DIR) [--out PATH --format csv|parquet|json] [--show N]
  python -m tillsight export (--tables DIR | --csv DIR) --out DIR
  python -m tillsight refresh --tables DIR --out DIR

--tables reads the warehouse parquet tables (region, nation, customer, part,
orders, lineitem) through the adapter; --csv reads retail exports
(customers.csv, products.csv, orders.csv, order_items.csv, ab_test_campaign.csv).
"""

from __future__ import annotations

import argparse
import dataclasses
import sys

from tillsight.plans.present import present
from tillsight.plans.registry import DRIVER_PARAMS, Params, plans


def _model(spark, args):
    if args.tables:
        from tillsight.sources.adapter import retail_from_driver
        return retail_from_driver(spark, args.tables, share_order_level=True), DRIVER_PARAMS
    from tillsight.sources.files import read_retail_csv
    return read_retail_csv(spark, args.csv), Params()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tillsight")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for name in ("run", "export"):
        sp = sub.add_parser(name)
        if name == "run":
            sp.add_argument("query")
            sp.add_argument("--format", default="csv", choices=["csv", "parquet", "json"])
            sp.add_argument("--show", type=int, default=0, help="print the first N rows instead of writing")
        src = sp.add_mutually_exclusive_group(required=True)
        src.add_argument("--tables")
        src.add_argument("--csv")
        sp.add_argument("--out")
        sp.add_argument("--order-level", help="reuse an order-level table written by an earlier export")
        sp.add_argument("--master")
        sp.add_argument("--active-year", type=int)
        sp.add_argument("--lapsed-year", type=int)
        sp.add_argument("--channels", help="comma-separated pivot columns")
    sp = sub.add_parser("refresh", help="bring a written order level up to date, month by month")
    sp.add_argument("--tables", required=True)
    sp.add_argument("--out", required=True)
    sp.add_argument("--master")
    args = ap.parse_args(argv)

    if args.cmd == "list":
        for name in plans():
            print(name)
        return 0

    from tillsight.session import build_session
    spark = build_session(args.master)
    if args.cmd == "refresh":
        from tillsight.sources.refresh import refresh, warehouse_facts
        done = refresh(spark, warehouse_facts(spark, args.tables), args.out)
        print("months:", "all" if done.months is None else " ".join(done.months) or "none")
        return 0
    t, params = _model(spark, args)
    if args.order_level:
        from tillsight.sources.files import read_order_level
        t = t.with_order_level(read_order_level(spark, args.order_level))
    overrides = {k: v for k, v in (("active_year", args.active_year), ("lapsed_year", args.lapsed_year)) if v}
    if args.channels:
        overrides["channels"] = args.channels.split(",")
    params = dataclasses.replace(params, **overrides)

    if args.cmd == "export":
        from tillsight.plans.export import export_reports
        for name, path in export_reports(t, args.out, params.recency_offset_days).items():
            print(f"{name}: {path}")
        return 0

    df = present(plans()[args.query](t, params))
    if args.show or not args.out:
        df.show(args.show or 20, truncate=False)
        return 0
    writer = df.write.mode("overwrite")
    if args.format == "csv":
        writer = writer.option("header", True)
    getattr(writer, args.format)(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
