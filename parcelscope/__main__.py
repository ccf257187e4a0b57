"""python -m parcelscope --warehouse PATH --params FILE --out PATH [--report NAME ...]"""

from __future__ import annotations

import argparse

from parcelscope.catalog import REPORTS
from parcelscope.params import load_params
from parcelscope.review import run_review
from parcelscope.session import build_session
from parcelscope.sources.star_schema import star_schema_tables
from parcelscope.sources.warehouse import warehouse_tables


def main() -> None:
    parser = argparse.ArgumentParser(prog="parcelscope")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--warehouse", help="folder of the stored logical tables")
    source.add_argument("--star-schema", help="folder of the order/line-item tables")
    parser.add_argument("--without-history", action="store_true", help="derive mom_history")
    parser.add_argument(
        "--returns-dated",
        action="store_true",
        help="return rows repeat the date of their shipment, so read only the months asked for",
    )
    parser.add_argument("--params", required=True, help="JSON file, fields of ReviewParams")
    parser.add_argument("--out", required=True)
    parser.add_argument("--report", nargs="*", choices=sorted(REPORTS), help="default: all")
    args = parser.parse_args()

    spark = build_session()
    if args.warehouse:
        tables = warehouse_tables(
            spark, args.warehouse, not args.without_history, args.returns_dated
        )
    else:
        tables = star_schema_tables(spark, args.star_schema)
    run_review(spark, tables, load_params(spark, args.params), args.out, args.report)


if __name__ == "__main__":
    main()
