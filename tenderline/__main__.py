"""spark-submit entry: write the report pack.

``python -m tenderline --tables DIR --out DIR --as-of 2024-05-10 [--excluded 7 77] [--only r04_stale_orders ...]``
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from tenderline.functions.dates import Period
from tenderline.plans.catalog import BY_CUSTOMER, REPORTS, Params
from tenderline.plans.pack import share_frames, write_pack
from tenderline.session import configure
from tenderline.sources import derive, read_parquet


def params_for(as_of: date, excluded: list[int], listed: list[int] | None, mails: list[str]) -> Params:
    """All periods as the reports take them from one day: last month, and weeks up to the day."""
    month = Period.previous_month(as_of)
    return Params(
        month_as_of=as_of,
        as_of=as_of,
        weeks_as_of=as_of,
        payments=month,
        cycles_since=month.first,
        excluded=tuple(excluded),
        listed=tuple(listed) if listed else None,
        excluded_mails=tuple(mails),
    )


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tenderline")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--tables", help="folder with one Parquet folder per table")
    source.add_argument("--star", help="folder with the star-schema test tables")
    parser.add_argument("--out", required=True)
    parser.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    parser.add_argument("--excluded", type=int, nargs="*", default=[])
    parser.add_argument("--customers", type=int, nargs="*")
    parser.add_argument("--excluded-mails", nargs="*", default=[])
    parser.add_argument("--only", nargs="*", choices=[*REPORTS, *BY_CUSTOMER])
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv", "orc"])
    parser.add_argument("--share", type=int, metavar="BUCKETS", help="write shared frames first, in this many buckets")
    args = parser.parse_args(argv)

    spark = configure(SparkSession.builder.appName("tenderline").getOrCreate())
    tables = read_parquet(spark, args.tables) if args.tables else derive(spark, args.star)
    if args.share:
        tables = share_frames(spark, tables, args.share)
    params = params_for(args.as_of, args.excluded, args.customers, args.excluded_mails)
    for path in write_pack(tables, params, args.out, args.only, args.format):
        print(path)


if __name__ == "__main__":
    main()
