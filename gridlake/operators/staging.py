"""Raw tables to clean, typed, renamed columns."""

from pyspark.sql import Column, DataFrame, functions as F

from gridlake.constants import DEMAND_SOURCE
from gridlake.functions import (
    date_of, interval_day, interval_id, local_to_utc, nan_to_null, to_int64, to_numeric,
)
from gridlake.operators.clock import closed_day, elapsed_interval, with_utc
from gridlake.operators.windows import keep_latest, keep_newest_version, trailing_rows_mean

MIX_COLUMNS = [
    "total_mw", "renewable_mw", "fossil_mw", "renewable_share", "fossil_share", "residual_load_mw",
]


def country_prices(raw: DataFrame) -> DataFrame:
    """Country day-ahead prices as NUMERIC, hours without a price dropped."""
    return raw.where(F.col("price_eur_mwh").isNotNull()).select(
        date_of(F.col("timestamp")).alias("price_date"),
        F.col("timestamp").alias("price_timestamp"),
        "country",
        to_numeric(F.col("price_eur_mwh")).alias("price_eur_mwh"),
        "ingested_at",
    )


def demand(raw: DataFrame) -> DataFrame:
    """Batch demand: day, instant and NUMERIC load."""
    return raw.where(F.col("zap_kse").isNotNull()).select(
        F.col("doba").cast("date").alias("demand_date"),
        F.col("udtczas").cast("timestamp").alias("demand_timestamp"),
        to_numeric(F.col("zap_kse")).alias("demand_mw"),
        "ingested_at",
    )


def quotes(raw: DataFrame) -> DataFrame:
    """Commodity and currency quotes as NUMERIC with whole volumes, rows without a close dropped."""
    return raw.where(F.col("close").isNotNull()).select(
        F.col("date").alias("price_date"),
        "ticker",
        *[to_numeric(F.col(c)).alias(f"{c}_price") for c in ("open", "high", "low", "close")],
        to_int64(F.col("volume")).alias("volume"),
    )


def latest_demand(raw: DataFrame, tie_break=()) -> DataFrame:
    """Newest ingest per quarter-hour of the demand stream table."""
    columns = ["event_ts", "demand_date", "interval_id", "demand_mw", "ingested_at"]
    kept = keep_latest(raw, ["demand_date", "interval_id"], ["ingested_at", *tie_break])
    return kept.select(*columns)


def hourly_wide(wide: DataFrame) -> DataFrame:
    """Staging view over the wide zone-hour table."""
    return wide.select(
        "date", F.col("timestamp").alias("ts_utc"), F.col("zone").alias("zone_code"),
        "price_eur_mwh", "price_7d_mean", *MIX_COLUMNS,
    )


def hourly_price_only(prices: DataFrame, scale: int | None = None, **slicing) -> DataFrame:
    """The same columns from prices alone: a mean over rows, and typed NULLs for the mix."""
    averaged = trailing_rows_mean(
        prices.select("date", "timestamp", "zone", "price_eur_mwh"), scale=scale, **slicing)
    return hourly_wide(averaged.withColumns({c: F.lit(None).cast("double") for c in MIX_COLUMNS}))


def rename_demand(records: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Feed records to the batch demand columns; only the needed ones, with fixed types."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    local = F.col("dtime").cast("timestamp")
    return records.select(
        F.col("business_date").alias("doba"),
        F.col("dtime").alias("udtczas"),
        F.col("demand").cast("double").alias("zap_kse"),
        interval_id(local).alias("znacznik"),
        stamp.alias("ingested_at"),
    )


def demand_events(records: DataFrame, ingested_at: Column | None = None,
                  local_zone: str | None = None) -> DataFrame:
    """Feed records (`dtime`, `demand`) to stream rows.

    By default the stamp is taken as UTC as it stands and the day is the day of the stamp.  With
    `local_zone` the stamp is converted from local time and interval 96 belongs to the day it closes.
    """
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    local = F.col("dtime").cast("timestamp")
    return records.select(
        (local_to_utc(local, local_zone) if local_zone else local).alias("event_ts"),
        (interval_day(local) if local_zone else date_of(local)).alias("demand_date"),
        interval_id(local).alias("interval_id"),
        F.col("demand").cast("double").alias("demand_mw"),
        F.lit(DEMAND_SOURCE).alias("source"),
        stamp.alias("ingested_at"),
    )


def zone_prices(landed: DataFrame) -> DataFrame:
    """Landed zone prices to table rows: NaN becomes NULL, the date comes from the instant.

    A day can lie in several chunks, a yearly and a daily one; the newest wins.
    """
    rows = keep_newest_version(landed, ["zone", "timestamp"], "dt")
    return rows.select(
        date_of(F.col("timestamp")).alias("date"), "timestamp", "zone",
        nan_to_null(F.col("price_eur_mwh")).alias("price_eur_mwh"),
    )


def zone_generation(landed: DataFrame) -> DataFrame:
    """Landed zone generation to table rows, as :func:`zone_prices`."""
    rows = keep_newest_version(landed, ["zone", "timestamp", "fuel_type"], "dt")
    return rows.select(
        date_of(F.col("timestamp")).alias("date"), "timestamp", "zone", "fuel_type",
        nan_to_null(F.col("generation_mw")).alias("generation_mw"),
    )


def to_utc(df: DataFrame, zone: Column | str, ts: str = "timestamp", order=(), keys=("zone",)) -> DataFrame:
    """Local wall-clock timestamps to UTC.

    A stamp that passes twice in autumn is taken as its first pass, unless `order` says in which order the feed gives
    the rows of a series (:func:`gridlake.operators.clock.with_utc`).
    """
    if not order:
        return df.withColumn(ts, local_to_utc(F.col(ts), zone))
    return with_utc(df, zone, order, keys, ts, "_utc").withColumn(ts, F.col("_utc")).drop("_utc")


def demand_events_by_order(records: DataFrame, zone: str, order, ingested_at: Column | None = None) -> DataFrame:
    """Feed records of local time to stream rows, right on the days of a clock change too.

    `order` names the columns that tell in which order the feed gives its records.  Intervals count the quarter-hours
    since local midnight, so a day has 92, 96 or 100 of them.
    """
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    local = records.withColumn("_local", F.col("dtime").cast("timestamp"))
    utc = F.col("_utc")
    return with_utc(local, zone, order, (), "_local", "_utc").select(
        utc.alias("event_ts"),
        closed_day(utc, zone).alias("demand_date"),
        elapsed_interval(utc, zone).alias("interval_id"),
        F.col("demand").cast("double").alias("demand_mw"),
        F.lit(DEMAND_SOURCE).alias("source"),
        stamp.alias("ingested_at"),
    )
