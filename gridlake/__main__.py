"""Command line: `python -m gridlake <job> ...`.

Landed files lie under `--lake` (`eu_prices`, `eu_generation`, ...), raw tables and marts under
`--tables`.
"""

import argparse
from datetime import date

from pyspark.sql import functions as F

from gridlake.functions import normalize_name
from gridlake.plans import loads
from gridlake.plans.build import check, store
from gridlake.plans.wide import hourly_wide, hourly_wide_for_day, write_wide_months, yesterday
from gridlake.schemas import BACKFILL_PROGRESS, KEYED_MESSAGE
from gridlake.session import get_spark
from gridlake.sinks.tables import replace_keys, write_months
from gridlake.sources.landing import scan_or_none
from gridlake.sources.registry import RAW_SCHEMAS, RawTables
from gridlake.sources.zones import only_zones, zone_dimension
from gridlake.streaming.feed import file_feed, kafka_feed, to_rows
from gridlake.streaming.intake import check_json, keep_messages
from gridlake.streaming.ledger import Ledger
from gridlake.streaming.sinks import keep_intraday

WIDE = "entsoe_eu_hourly_wide"


def transform(spark, args) -> None:
    """Build the wide zone-hour table, all of it or one day.

    With `--fuels data` every month gets a column for each fuel it has; a day then rebuilds its month.
    """
    raw = RawTables(spark, args.tables)
    sources = raw["entsoe_eu_generation"], raw["entsoe_eu_prices"]
    day = args.date or yesterday()
    if args.fuels == ["data"]:
        months = None if args.mode == "full" else [day.replace(day=1)]
        rows = sum(write_wide_months(*sources, raw.path(WIDE), months).values())
    else:
        fuels = None if args.fuels == ["fixed"] else [normalize_name(f) for f in args.fuels]
        if args.mode == "full":
            rows = write_months(hourly_wide(*sources, fuels=fuels), raw.path(WIDE), "date", ["zone", "timestamp"])
        else:
            rows = replace_keys(hourly_wide_for_day(*sources, day, fuels=fuels), raw.path(WIDE), ["date"],
                                ["zone", "timestamp"])
    print(f"{WIDE}: {rows} rows in the rewritten months")


def load(spark, args) -> None:
    """Load landed zone prices and generation into their tables."""
    dt = str(yesterday()) if args.yesterday else args.date
    raw = RawTables(spark, args.tables)
    for job, landed, table in (
        (loads.load_prices, "eu_prices", "entsoe_eu_prices"),
        (loads.load_generation, "eu_generation", "entsoe_eu_generation"),
    ):
        print(f"{table}: {job(spark, f'{args.lake}/{landed}', raw.path(table), dt, args.replace)} rows")


def _known(spark, args) -> dict:
    raw = RawTables(spark, args.tables)
    tables = {name: scan_or_none(spark, raw.path(name), RAW_SCHEMAS[name]) for name in RAW_SCHEMAS}
    return {name: df for name, df in tables.items() if df is not None} | {
        "dim_region_mapping": zone_dimension(spark)}


def marts(spark, args) -> None:
    """Build and store the marts, then check their contracts."""
    stored = store(_known(spark, args), f"{args.tables}/marts", args.only)
    check(stored).show(100, truncate=False)


def pending(spark, args) -> None:
    """Show the (zone, year) chunks of a range that are not landed yet."""
    zones = only_zones(zone_dimension(spark), args.zones)
    tables = _known(spark, args)
    names = ["entsoe_eu_prices"] + ([] if args.skip_generation else ["entsoe_eu_generation"])
    held = [tables[n] for n in names if n in tables]
    if len(held) == len(names):
        done = loads.landed_chunks(*held)
    else:
        done = spark.createDataFrame([], BACKFILL_PROGRESS)
    todo = loads.pending_chunks(zones, args.start, args.end, done)
    todo.orderBy("zone", "year").show(10_000, truncate=False)


def stream(spark, args) -> None:
    """Follow the demand topic (or a directory of JSON messages) into the raw table and the mart.

    Messages that cannot become rows go to `pse_demand_rejects`.  Without `--every` the stream ends at the newest message.
    """
    if args.servers:
        messages = kafka_feed(spark, args.servers).withColumn("value", F.col("value").cast("string"))
    else:
        messages = file_feed(spark, f"{args.lake}/demand_stream", KEYED_MESSAGE, "json")
    progress = f"{args.tables}/_progress"
    trigger = {"processingTime": args.every} if args.every else {"availableNow": True}
    good = check_json(messages).where(F.col("reason").isNull())
    queries = [
        keep_messages(messages, f"{args.tables}/pse_demand_stream", f"{args.tables}/pse_demand_rejects",
                      f"{progress}/raw", Ledger(f"{progress}/raw_batches"), **trigger),
        keep_intraday(to_rows(good), f"{args.tables}/demand_latest", f"{args.tables}/marts/fct_intraday_demand",
                      f"{progress}/intraday", ledger=Ledger(f"{progress}/intraday_batches"), **trigger),
    ]
    for query in queries:
        query.awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gridlake", description=__doc__)
    top.add_argument("--lake", default="lake")
    top.add_argument("--tables", default="tables")
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("transform", help=transform.__doc__)
    job.add_argument("--mode", choices=["full", "incremental"], default="incremental")
    job.add_argument("--date", type=date.fromisoformat)
    job.add_argument("--fuels", nargs="+", default=["fixed"],
                     help="`fixed` for the known list, `data` for what each month has, or the names of the columns")
    job.set_defaults(run=transform)

    job = jobs.add_parser("load", help=load.__doc__)
    job.add_argument("--date", help="one day, or a pattern such as 2025-*; all days without it")
    job.add_argument("--yesterday", action="store_true")
    job.add_argument("--replace", choices=["hours", "zone_days", "days"], default="hours",
                     help="what the batch replaces; only its own hours by default")
    job.set_defaults(run=load)

    job = jobs.add_parser("marts", help=marts.__doc__)
    job.add_argument("--only", nargs="*")
    job.set_defaults(run=marts)

    job = jobs.add_parser("pending", help=pending.__doc__)
    job.add_argument("--start", type=int, default=2015)
    job.add_argument("--end", type=int, default=date.today().year)
    job.add_argument("--zones", nargs="*")
    job.add_argument("--skip-generation", action="store_true")
    job.set_defaults(run=pending)

    job = jobs.add_parser("stream", help=stream.__doc__)
    job.add_argument("--servers", help="Kafka servers; without them a directory is read")
    job.add_argument("--every", help="stay up and take a batch this often, such as '1 minute'")
    job.set_defaults(run=stream)
    return top


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    args.run(get_spark(f"gridlake-{args.job}"), args)


if __name__ == "__main__":
    main()
