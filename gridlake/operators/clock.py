"""Local stamps on the days of a clock change.

In autumn an hour passes twice and both passes carry the same stamps; only the order in which the feed gives them tells
them apart.  In spring an hour is missing.  Days therefore have 92, 96 or 100 quarter-hours.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridlake.constants import INTERVAL_MINUTES
from gridlake.functions import local_to_utc

QUARTER = INTERVAL_MINUTES * 60_000_000


def hour_later(instant: Column) -> Column:
    return instant + F.expr("INTERVAL 1 HOUR")


def passes_twice(local: Column, zone: Column | str) -> Column:
    """True for a local stamp that occurs again an hour later; false for NULL."""
    again = F.from_utc_timestamp(hour_later(local_to_utc(local, zone)), zone)
    return F.coalesce(again == local.cast("timestamp"), F.lit(False))


def with_utc(df: DataFrame, zone: Column | str, order, keys=("zone",), ts: str = "timestamp",
             out: str = "timestamp_utc") -> DataFrame:
    """Add the instant of the local stamp `ts`; of a stamp that passes twice, by its place in the series.

    `keys` name the series and `order` the columns by which the feed gives its rows.  In the repeated hour the second
    pass begins with the first row whose stamp is not later than the one before it; all rows from there on are an hour
    later.  A lone row counts as the first pass, so copies of a reading have to be removed before.  A stamp of the hour
    missing in spring moves to the hour after it; NULL stays NULL.

    Only rows of repeated hours are shuffled, by series and hour; all others are passed through.
    """
    local = F.col(ts)
    twice = passes_twice(local, zone)
    first = local_to_utc(local, zone)
    clear = df.where(~twice).withColumn(out, first)
    feed = Window.partitionBy(*keys, F.date_trunc("hour", local)).orderBy(*order)
    back = df.where(twice).withColumn("_back", local <= F.lag(local).over(feed))
    second = F.coalesce(F.max("_back").over(feed.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
                        F.lit(False))
    settled = back.withColumn(out, F.when(second, hour_later(first)).otherwise(first)).drop("_back")
    return clear.unionByName(settled)


def closed_day(utc: Column, zone: Column | str) -> Column:
    """Local day that an end-of-interval instant belongs to; midnight closes the day before."""
    return F.to_date(F.from_utc_timestamp(utc - F.expr(f"INTERVAL {INTERVAL_MINUTES} MINUTES"), zone))


def elapsed_interval(utc: Column, zone: Column | str) -> Column:
    """Quarter-hours since the local day began, for an end-of-interval instant: up to 92, 96 or 100."""
    midnight = local_to_utc(closed_day(utc, zone).cast("timestamp"), zone)
    return F.floor((F.unix_micros(utc) - F.unix_micros(midnight)) / F.lit(QUARTER)).cast("bigint")
