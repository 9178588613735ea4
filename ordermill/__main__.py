"""Command line: ``spark-submit``-able entry to the three jobs."""

from __future__ import annotations

import argparse

from .plans import raw_to_silver, run_daily_sales, silver_to_gold
from .session import build


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ordermill")
    jobs = parser.add_subparsers(dest="job", required=True)

    silver = jobs.add_parser("raw-to-silver", help="clean one ingest day into order lines")
    silver.add_argument("ingest_date")
    silver.add_argument("--raw", required=True)
    silver.add_argument("--silver", required=True)
    silver.add_argument("--dedup-strategy", choices=("prefer_latest", "drop"), default="prefer_latest")
    silver.add_argument("--errors-out")
    silver.add_argument("--json-lines", action="store_true", help="one JSON object per line")
    silver.add_argument("--quarantine-first", action="store_true")
    silver.add_argument("--blank-ids-are-null", action="store_true")
    silver.add_argument("--tasks", type=int, help="tasks that share the partitioned writes")

    gold = jobs.add_parser("silver-to-gold", help="publish revenue, top products and order figures")
    gold.add_argument("--silver", required=True)
    gold.add_argument("--gold", required=True)
    gold.add_argument("--top-n", type=int, default=10)
    gold.add_argument("--snapshot", action=argparse.BooleanOptionalAction, default=True)
    gold.add_argument("--snapshot-date")
    gold.add_argument("--write-current", action=argparse.BooleanOptionalAction, default=True)
    gold.add_argument("--changed-dates", nargs="+", metavar="DATE", help="limit the daily tables to these purchase dates")
    gold.add_argument("--tasks", type=int, help="tasks that share the partitioned writes")

    sales = jobs.add_parser("daily-sales", help="daily sales from order and product CSV files")
    sales.add_argument("--orders", required=True)
    sales.add_argument("--products", required=True)
    sales.add_argument("--out", required=True)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = build(f"ordermill {args.job}")
    if args.job == "raw-to-silver":
        print(raw_to_silver(
            spark, args.raw, args.silver, args.ingest_date, strategy=args.dedup_strategy,
            errors_path=args.errors_out, multiline=not args.json_lines, quarantine_first=args.quarantine_first,
            blank_ids_are_null=args.blank_ids_are_null, tasks=args.tasks,
        ))
    elif args.job == "silver-to-gold":
        silver_to_gold(
            spark, args.silver, args.gold, top_n=args.top_n, snapshot=args.snapshot,
            snapshot_date=args.snapshot_date, write_current_tables=args.write_current,
            changed_dates=args.changed_dates, tasks=args.tasks,
        )
    else:
        run_daily_sales(spark, args.orders, args.products, args.out)


if __name__ == "__main__":
    main()
