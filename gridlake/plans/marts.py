"""Business tables.  `scale` makes sums and means of quoted measures exact, see `functions.measures`.

Zone attributes depend on the zone alone, so the zone marts aggregate first and join the dimension to
the few aggregated rows.
"""

from pyspark.sql import DataFrame, functions as F

from gridlake.functions import hour_utc, mean, total
from gridlake.operators.joins import attach_region
from gridlake.operators.windows import period_returns, smoothed_demand


def hourly_with_region(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone-hours with the zone attributes (intermediate view)."""
    return attach_region(staged, zones).select(
        "date", "ts_utc", "zone_code", "country", "region", "primary_fuel", "zone_name", "timezone",
        "price_eur_mwh", "price_7d_mean", "total_mw", "renewable_mw", "fossil_mw",
        "renewable_share", "fossil_share", "residual_load_mw",
    )


def daily_prices(prices: DataFrame, scale: int | None = None) -> DataFrame:
    """Day and country: mean, lowest and highest price, hours seen."""
    price = F.col("price_eur_mwh")
    return prices.groupBy("price_date", "country").agg(
        mean(price, scale).cast("double").alias("avg_price_eur_mwh"),
        F.min(price).alias("min_price_eur_mwh"),
        F.max(price).alias("max_price_eur_mwh"),
        F.count(F.lit(1)).alias("hours_observed"),
    )


def commodity_drivers(quotes: DataFrame, **slicing) -> DataFrame:
    """Day and ticker: close and its returns over 5 and 20 quotes."""
    return period_returns(quotes.select("price_date", "ticker", "close_price"), **slicing)


def intraday_demand(latest: DataFrame, scale: int | None = None) -> DataFrame:
    """Quarter-hour demand with its one-hour mean, from deduplicated intervals."""
    return smoothed_demand(latest, scale=scale).select(
        "demand_date", "interval_id", "event_ts", "demand_mw", "demand_mw_1h_avg")


def daily_by_region(staged: DataFrame, zones: DataFrame, scale: int | None = None) -> DataFrame:
    """Day and zone, with the region tag: price statistics, mix shares, energy."""
    price = F.col("price_eur_mwh")
    per_zone = staged.groupBy("date", "zone_code").agg(
        mean(price, scale).alias("avg_price_eur_mwh"),
        F.min(price).alias("min_price_eur_mwh"),
        F.max(price).alias("max_price_eur_mwh"),
        F.stddev_samp(price).alias("price_std"),
        F.count_if(price < 0).alias("negative_price_hours"),
        F.avg("renewable_share").alias("avg_renewable_share"),
        F.avg("fossil_share").alias("avg_fossil_share"),
        total(F.col("total_mw"), scale).alias("total_generation_mwh"),
        mean(F.col("residual_load_mw"), scale).alias("avg_residual_load_mw"),
    )
    return attach_region(per_zone, zones).select(
        "date", "region", "country", "zone_code", "zone_name", "primary_fuel",
        *[c for c in per_zone.columns if c not in ("date", "zone_code")],
    )


def regional_summary(daily: DataFrame, scale: int | None = None) -> DataFrame:
    """Day and region: every zone counts the same, whatever its size."""
    return daily.groupBy("date", "region").agg(
        F.count_distinct("zone_code").alias("zones_reporting"),
        F.avg("avg_price_eur_mwh").alias("regional_avg_price_eur_mwh"),
        F.avg("price_std").alias("regional_avg_price_std"),
        F.sum("negative_price_hours").alias("regional_negative_price_hours"),
        F.avg("avg_renewable_share").alias("regional_renewable_share"),
        F.avg("avg_fossil_share").alias("regional_fossil_share"),
        total(F.col("total_generation_mwh"), scale).alias("regional_generation_mwh"),
    )


def duck_curve(staged: DataFrame, zones: DataFrame, scale: int | None = None) -> DataFrame:
    """Day, hour and zone: the hourly price profile of hours that have a price."""
    per_hour = (
        staged.where(F.col("price_eur_mwh").isNotNull())
        .groupBy("date", hour_utc(F.col("ts_utc")).alias("hour_utc"), "zone_code")
        .agg(mean(F.col("price_eur_mwh"), scale).alias("avg_price_eur_mwh"),
             F.avg("renewable_share").alias("avg_renewable_share"))
    )
    return attach_region(per_hour, zones).select(
        "date", "hour_utc", "region", "country", "zone_code",
        "avg_price_eur_mwh", "avg_renewable_share",
    )
