"""Command line: ``python -m safetymart {land,silver,gold,all} ...``.

Run it through ``spark-submit`` on a cluster; the session takes its resources
and its checkpoint folder from there.
"""

from __future__ import annotations

import argparse

from safetymart import rules as R
from safetymart.plans.gold import run_gold
from safetymart.plans.silver import run_silver
from safetymart.session import build_session
from safetymart.sources.layout import as_day
from safetymart.sources.bronze import land_bronze, read_array_feed, read_pages
from safetymart.sources.tables import read_silver


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="safetymart", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    land = commands.add_parser("land", help="saved API responses to a bronze day")
    land.add_argument("--feed", required=True)
    land.add_argument("--shape", choices=("pages", "array"), required=True)
    land.add_argument("--input", required=True, help="files with one response each")
    land.add_argument("--bronze", required=True)
    land.add_argument("--date", help="ingest day, YYYY-MM-DD (default: today in UTC)")

    for name in ("silver", "gold", "all"):
        command = commands.add_parser(name)
        command.add_argument("--silver", required=True)
        command.add_argument("--date", help="day, YYYY-MM-DD (default: today in UTC)")
        command.add_argument("--as-of", action="store_true", help="latest day up to it")
        if name in ("silver", "all"):
            command.add_argument("--bronze", required=True)
            command.add_argument("--quarantine", help="folder for malformed lines")
            command.add_argument(
                "--enforce-min-rows", action="store_true", help="stop on small feeds"
            )
            command.add_argument(
                "--require-fields", action="store_true", help="stop on missing fields"
            )
        if name in ("gold", "all"):
            command.add_argument("--gold", required=True)
            command.add_argument(
                "--on-failure", choices=("raise", "warn"), default="raise"
            )
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    args.date = as_day(args.date)  # once, also for a run over midnight
    spark = build_session()
    if args.command == "land":
        read = read_pages if args.shape == "pages" else read_array_feed
        print(land_bronze(read(spark, args.input), args.bronze, args.feed, args.date))
    if args.command in ("silver", "all"):
        run = run_silver(
            spark,
            args.bronze,
            args.silver,
            args.date,
            as_of=args.as_of,
            min_rows=R.MIN_ROWS if args.enforce_min_rows else None,
            require_fields=args.require_fields,
            quarantine=args.quarantine,
        )
        for row in run.feeds:
            print(row.asDict())
        print(f"{run.row_count} rows in {run.path}")
        for title, stats in run.summary(spark).items():
            print(title)
            stats.show(stats.count(), truncate=False)
    if args.command in ("gold", "all"):
        silver = read_silver(spark, args.silver, args.date, as_of=args.as_of)
        for row in run_gold(spark, silver, args.gold, args.on_failure):
            print(row.asDict())


if __name__ == "__main__":
    main()
