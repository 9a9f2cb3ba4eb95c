"""The wide zone-hour table: generation by fuel, mix, price and its seven-day mean."""

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridlake.constants import PRICE_WINDOW_HOURS
from gridlake.functions import month_of
from gridlake.operators.joins import HOUR_KEYS, attach_prices
from gridlake.operators.ranges import between_dates
from gridlake.operators.reshape import discover_fuels, energy_mix, pivot_generation
from gridlake.operators.windows import trailing_mean
from gridlake.sinks.tables import replace_months
from gridlake.sources.landing import scan_merged


def hourly_wide(generation: DataFrame, prices: DataFrame, how: str = "left",
                fuels: list[str] | None = None, scale: int | None = None) -> DataFrame:
    """`fuels` as in :func:`gridlake.operators.reshape.pivot_generation`."""
    mix = energy_mix(pivot_generation(generation, fuels, scale=scale), fuels)
    return trailing_mean(attach_prices(mix, prices, how), scale=scale)


def hourly_wide_for_days(generation: DataFrame, prices: DataFrame, first, last, **options) -> DataFrame:
    """The rows a full build would give for the days `first` to `last` (dates, or Columns without rows).

    The price mean looks back a week, so the inputs are read from a week before; the result is cut to the days at
    the end.  A range above the full join of both inputs would not reach their files, so it is put on either input.
    """
    first = F.lit(first).cast("date")
    start = F.date_sub(first, PRICE_WINDOW_HOURS // 24)
    built = hourly_wide(
        between_dates(generation, start, last), between_dates(prices, start, last), **options)
    return between_dates(built, first, last)


def hourly_wide_for_day(generation: DataFrame, prices: DataFrame, day: date | str, **options) -> DataFrame:
    """The rows a full build would give for one day."""
    return hourly_wide_for_days(generation, prices, day, day, **options)


def months_of(df: DataFrame, column: str = "date") -> list[date]:
    """The months that have rows, in order: one short row each."""
    month = F.col("month") if "month" in df.columns else month_of(F.col(column))
    found = df.select(month.cast("date").alias("month")).where("month is not null").distinct().collect()
    return sorted(r.month for r in found)


def write_wide_months(generation: DataFrame, prices: DataFrame, path: str, months: list[date] | None = None,
                      fuels: list[str] | None = None, how: str = "left", scale: int | None = None) -> dict[date, int]:
    """Build and replace whole months of the wide table, each with the fuels that its own rows have.

    `fuels` fixes the columns instead.  Months of different shape lie side by side; :func:`scan_wide` reads them as one
    table.  Rows written by month.
    """
    written = {}
    for month in months_of(generation) if months is None else months:
        last = (month.replace(day=1) + timedelta(days=31)).replace(day=1) - timedelta(days=1)
        own = discover_fuels(between_dates(generation, month, last)) if fuels is None else fuels
        built = hourly_wide_for_days(generation, prices, month, last, how=how, fuels=own, scale=scale)
        written[month] = replace_months(built, path, "date", ["zone", "timestamp"])
    return written


def scan_wide(spark: SparkSession, path: str) -> DataFrame:
    """The wide table with the columns of all its months; a fuel that a month did not have is NULL there."""
    return scan_merged(spark, path)


def yesterday(now: datetime | None = None) -> date:
    return ((now or datetime.now(timezone.utc)) - timedelta(days=1)).date()


__all__ = ["HOUR_KEYS", "between_dates", "hourly_wide", "hourly_wide_for_day", "hourly_wide_for_days", "months_of",
           "scan_wide", "write_wide_months", "yesterday"]
