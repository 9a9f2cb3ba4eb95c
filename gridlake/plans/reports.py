"""Dashboard queries over the marts.

Trailing periods end at the newest day of the table, or at `as_of` where it is given.
"""

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from gridlake.constants import REGIONS, SOLAR_MONTHS, TICKERS
from gridlake.operators import staging
from gridlake.operators.ranges import newest_day, trailing_days, trailing_range
from gridlake.plans import marts
from gridlake.plans.wide import hourly_wide_for_days


def recent_daily(generation: DataFrame, prices: DataFrame, zones: DataFrame, days: int, as_of: Column | None = None,
                 scale: int | None = None) -> DataFrame:
    """Day-and-zone mart of the last days only, from the raw tables; of those stored by month the months in question.

    The reports below take it, or its regional summary, in place of the mart over all history.
    """
    end = F.greatest(newest_day(generation), newest_day(prices)) if as_of is None else as_of
    hours = hourly_wide_for_days(generation, prices, *trailing_range(days, end), how="full", scale=scale)
    return marts.daily_by_region(staging.hourly_wide(hours), zones, scale)


def price_scorecard(summary: DataFrame, days: int = 30, as_of: Column | None = None) -> DataFrame:
    """Mean regional price of the last month."""
    return trailing_days(summary, days, as_of=as_of).groupBy("region").agg(
        F.avg("regional_avg_price_eur_mwh").alias("avg_price_eur_mwh"))


def region_spread(summary: DataFrame, left: str = REGIONS[0], right: str = REGIONS[1]) -> DataFrame:
    """Daily price of two regions side by side, and their difference."""
    price = F.col("regional_avg_price_eur_mwh")
    sides = (
        summary.where(F.col("region").isin(left, right)).groupBy("date")
        .agg(F.avg(F.when(F.col("region") == left, price)).alias("left_price_eur_mwh"),
             F.avg(F.when(F.col("region") == right, price)).alias("right_price_eur_mwh"))
    )
    return sides.withColumn("spread_eur_mwh", F.col("left_price_eur_mwh") - F.col("right_price_eur_mwh"))


def negative_hours(summary: DataFrame, days: int = 90, as_of: Column | None = None) -> DataFrame:
    """Zone-hours below zero per region in the last quarter."""
    return trailing_days(summary, days, as_of=as_of).groupBy("region").agg(
        F.sum("regional_negative_price_hours").alias("negative_price_hours"))


def country_prices(daily: DataFrame, days: int = 60, as_of: Column | None = None) -> DataFrame:
    """Mean price per country and day over the last two months."""
    return trailing_days(daily, days, as_of=as_of).groupBy("country", "date").agg(
        F.avg("avg_price_eur_mwh").alias("avg_price_eur_mwh"))


def zone_heatmap(daily: DataFrame, dates: list | None = None) -> DataFrame:
    """Mean price by zone and day; one column per day when `dates` lists them."""
    cells = daily.groupBy("zone_code", "date").agg(F.avg("avg_price_eur_mwh").alias("avg_price_eur_mwh"))
    if dates is None:
        return cells
    return cells.groupBy("zone_code").agg(*[
        F.max(F.when(F.col("date") == F.lit(d).cast("date"), F.col("avg_price_eur_mwh"))).alias(str(d))
        for d in dates
    ])


def seasonal_profile(curve: DataFrame, months=SOLAR_MONTHS) -> DataFrame:
    """Mean price by region and hour over some months of the year."""
    return curve.where(F.month("date").isin(list(months))).groupBy("region", "hour_utc").agg(
        F.avg("avg_price_eur_mwh").alias("avg_price_eur_mwh"))


def price_against_driver(daily: DataFrame, drivers: DataFrame, country: str = "PL",
                         ticker: str = "TTF_GAS") -> DataFrame:
    """Daily price of a country beside the close of a driver on the same day."""
    price = daily.where(F.col("country") == country).select("price_date", "avg_price_eur_mwh")
    close = drivers.where(F.col("ticker") == ticker).select("price_date", "close_price")
    return price.join(close, "price_date", "left")


def driver_series(drivers: DataFrame, tickers=("BRENT", "NAT_GAS_HH", "EURPLN")) -> DataFrame:
    return drivers.where(F.col("ticker").isin(list(tickers))).select("price_date", "ticker", "close_price")


def ticker_correlation(drivers: DataFrame, tickers=tuple(TICKERS), value: str = "close_price") -> DataFrame:
    """Correlation of every pair of tickers over the days both were quoted.

    One column per ticker and day, then all pairs in a single aggregation: no rows are paired.
    """
    tickers = list(tickers)
    number = F.col(value).cast("double")
    by_day = drivers.where(F.col("ticker").isin(tickers)).groupBy("price_date").agg(*[
        F.max(F.when(F.col("ticker") == t, number)).alias(f"t{i}") for i, t in enumerate(tickers)
    ])
    pairs = list(combinations(range(len(tickers)), 2))
    both = {p: F.col(f"t{p[0]}").isNotNull() & F.col(f"t{p[1]}").isNotNull() for p in pairs}
    wide = by_day.agg(F.array(*[
        F.struct(
            F.lit(tickers[i]).alias("ticker_a"), F.lit(tickers[j]).alias("ticker_b"),
            F.corr(F.when(both[i, j], F.col(f"t{i}")), F.when(both[i, j], F.col(f"t{j}"))).alias("correlation"),
            F.count_if(both[i, j]).alias("n_days"),
        ) for i, j in pairs
    ]).alias("pairs"))
    return wide.select(F.inline("pairs"))


def demand_line(mart: DataFrame) -> DataFrame:
    return mart.select("event_ts", "demand_mw")
