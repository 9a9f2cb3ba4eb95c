from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridlake.operators import joins, staging
from gridlake.plans import marts, reports, wide
from gridlake.plans.build import MODELS, build, register_views, store, wanted
from gridlake.sources.zones import zone_dimension

START = datetime(2024, 1, 1)


@pytest.fixture
def inputs(spark, price_hours):
    """Three weeks of two known zones and an unknown one; some hours have only a price or only a mix."""
    hours = range(24 * 21)
    prices = price_hours({
        "PL": {h: (h % 50) - 10.0 for h in hours if h % 11},
        "ES": {h: (h % 37) - 20.0 for h in hours},
        "XX": {h: 5.0 for h in hours if h < 30},
    })
    cells = []
    for h in hours:
        at = START + timedelta(hours=h)
        for zone in ("PL", "ES", "XX") if h % 13 else ("ES",):
            cells.append((at.date(), at, zone, "Solar", float(h % 24)))
            cells.append((at.date(), at, zone, "Fossil Gas", 10.0))
    generation = spark.createDataFrame(
        cells, "date date, timestamp timestamp, zone string, fuel_type string, generation_mw double")
    return generation, prices


def test_left_keeps_generation_hours_and_full_keeps_all(inputs):
    generation, prices = inputs
    hours = {how: wide.hourly_wide(generation, prices, how).count() for how in ("left", "full")}
    keys = ["date", "timestamp", "zone"]
    have = generation.select(*keys).distinct()
    assert hours["left"] == have.count()
    assert hours["full"] == have.union(prices.select(*keys)).distinct().count() > hours["left"]
    with pytest.raises(ValueError):
        joins.attach_prices(have, prices, "inner")


@pytest.mark.parametrize("day", ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-21"])
def test_one_day_equals_that_day_of_a_full_build(inputs, rows, day):
    generation, prices = inputs
    full = wide.hourly_wide(generation, prices, scale=2).where(F.col("date") == F.lit(day).cast("date"))
    assert rows(wide.hourly_wide_for_day(generation, prices, day, scale=2)) == rows(full)


def test_between_dates_restricts_the_month_directories(spark):
    df = spark.range(100).select(F.expr("date_add(date'2024-01-01', cast(id as int))").alias("date"))
    df = df.withColumn("month", F.trunc("date", "month"))
    got = wide.between_dates(df, date(2024, 1, 30), "2024-02-02")
    assert got.count() == 4
    assert "month" in str(got._jdf.queryExecution().optimizedPlan())


def test_yesterday():
    assert wide.yesterday(datetime(2024, 3, 1, 5)) == date(2024, 2, 29)


@pytest.fixture
def staged(inputs):
    return staging.hourly_wide(wide.hourly_wide(*inputs, "full", scale=2))


def test_row_counts_follow_zones_days_and_hours(spark, inputs, staged):
    zones = zone_dimension(spark)
    _, prices = inputs
    daily = marts.daily_by_region(staged, zones)
    assert daily.count() == staged.select("date", "zone_code").distinct().count() == 3 * 21
    assert marts.regional_summary(daily).count() == 3 * 21  # Eastern, Southern and the unknown region
    assert marts.duck_curve(staged, zones).count() == prices.count()


def test_unknown_zone_keeps_nulls(spark, staged, rows):
    joined = marts.hourly_with_region(staged, zone_dimension(spark)).where("zone_code = 'XX'")
    assert rows(joined.select("region", "country", "timezone").distinct()) == [(None, None, None)]


def test_daily_mart_of_single_hours(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 1), START, "PL", -1.5, None, 0.0, 0.0, 0.0, None, None, 0.0)],
        "date date, ts_utc timestamp, zone_code string, price_eur_mwh double, price_7d_mean double,"
        "total_mw double, renewable_mw double, fossil_mw double, renewable_share double,"
        "fossil_share double, residual_load_mw double")
    got = marts.daily_by_region(df, zone_dimension(spark)).first()
    assert (got.price_std, got.negative_price_hours, got.avg_renewable_share) == (None, 1, None)
    assert (got.region, got.primary_fuel, got.zone_name) == ("Eastern", "coal", "Poland")


def test_region_mean_counts_zones_alike(spark):
    day = date(2024, 1, 1)
    daily = spark.createDataFrame(
        [(day, "Southern", "IT_SUD", 10.0), (day, "Southern", "ES", 40.0), (day, "Southern", "ES", None)],
        "date date, region string, zone_code string, avg_price_eur_mwh double",
    ).withColumns({c: F.lit(None).cast("double") for c in (
        "price_std", "avg_renewable_share", "avg_fossil_share", "total_generation_mwh")},
    ).withColumn("negative_price_hours", F.lit(1).cast("bigint"))
    got = marts.regional_summary(daily).first()
    assert (got.zones_reporting, got.regional_avg_price_eur_mwh, got.regional_negative_price_hours) == (2, 25.0, 3)


def test_zone_spread_needs_a_reference_price(price_hours):
    prices = price_hours({"DE": {0: 10.0}, "PL": {0: 12.5, 1: 3.0}})
    got = {(r.zone, r.timestamp.hour): r.price_spread_eur_mwh for r in joins.zone_spread(prices, "DE").collect()}
    assert got == {("DE", 0): 0.0, ("PL", 0): 2.5, ("PL", 1): None}


def test_high_water_mark_of_an_empty_target_lets_everything_through(price_hours):
    prices = price_hours({"PL": {0: 1.0, 1: 2.0}})
    assert joins.newer_than_target(prices, prices.limit(0), "timestamp").count() == 2
    assert joins.newer_than_target(prices, prices, "timestamp").count() == 0


def test_reports(spark):
    start = date(2024, 1, 1)
    summary = spark.createDataFrame(
        [(start + timedelta(days=d), r, float(d + k), d % 2) for d in range(40)
         for k, r in enumerate(("Eastern", "Southern"))],
        "date date, region string, regional_avg_price_eur_mwh double, regional_negative_price_hours bigint")
    card = {r.region: r.avg_price_eur_mwh for r in reports.price_scorecard(summary).collect()}
    assert card == {"Eastern": sum(range(10, 40)) / 30, "Southern": sum(range(11, 41)) / 30}
    assert {r.spread_eur_mwh for r in reports.region_spread(summary).collect()} == {-1.0}
    assert {r.negative_price_hours for r in reports.negative_hours(summary, 4).collect()} == {2}
    early = reports.price_scorecard(summary, 2, F.lit(date(2024, 1, 3)))
    assert {r.region: r.avg_price_eur_mwh for r in early.collect()} == {"Eastern": 1.5, "Southern": 2.5}


def test_seasonal_profile_takes_the_solar_months(spark):
    curve = spark.createDataFrame(
        [(date(2024, m, 1), 12, "Southern", float(m)) for m in range(1, 13)],
        "date date, hour_utc bigint, region string, avg_price_eur_mwh double")
    assert [tuple(r) for r in reports.seasonal_profile(curve).collect()] == [("Southern", 12, 5.5)]


def test_ticker_correlation_uses_common_days_only(spark):
    rows = [(date(2024, 1, d), t, v) for d, a, b in ((1, 1., 2.), (2, 2., 4.), (3, 3., 6.)) for t, v in (("A", a), ("B", b))]
    rows += [(date(2024, 1, 9), "A", 100.0)]
    drivers = spark.createDataFrame(rows, "price_date date, ticker string, close_price double")
    got = reports.ticker_correlation(drivers, ["A", "B"]).first()
    assert got.correlation == pytest.approx(1.0) and got.n_days == 3


@pytest.fixture
def raw(spark, inputs):
    generation, prices = inputs
    return {
        "entsoe_eu_prices": prices,
        "entsoe_eu_hourly_wide": wide.hourly_wide(generation, prices),
        "dim_region_mapping": zone_dimension(spark),
        "entsoe_prices_pl": prices.where("zone = 'PL'").select(
            "timestamp", "price_eur_mwh", F.lit("PL").alias("country"), F.col("timestamp").alias("ingested_at")),
        "yahoo_prices": spark.createDataFrame(
            [(date(2024, 1, 1) + timedelta(days=d), t, 1.0, 2.0, 0.5, d + 1.0, 2.7)
             for d in range(30) for t in ("BRENT", "TTF_GAS")],
            "date date, ticker string, open double, high double, low double, close double, volume double"),
        "pse_demand": spark.createDataFrame(
            [("2024-01-01", "2024-01-01 00:15:00", 100.0, 1, START), ("2024-01-01", "2024-01-01 00:30:00", None, 2, START)],
            "doba string, udtczas string, zap_kse double, znacznik bigint, ingested_at timestamp"),
        "pse_demand_stream": spark.createDataFrame(
            [(START, date(2024, 1, 1), i, v, "PSE", START + timedelta(hours=a))
             for i, v, a in ((1, 10.0, 0), (1, 20.0, 1), (2, 40.0, 0))],
            "event_ts timestamp, demand_date date, interval_id bigint, demand_mw double, source string,"
            "ingested_at timestamp"),
    }


def test_build_takes_ancestors_along():
    assert wanted(["fct_eu_regional_summary"]) == [
        "stg_entsoe__eu_hourly_wide", "fct_eu_daily_by_region", "fct_eu_regional_summary"]
    assert wanted() == list(MODELS)
    with pytest.raises(KeyError):
        wanted(["fct_unknown"])


def test_build_all_and_store_the_same(spark, raw, rows, tmp_path):
    built = build(raw)
    assert set(built) == set(MODELS) and built["stg_pse__demand"].count() == 1
    register_views(built)
    assert spark.sql("select count(*) from fct_commodity_drivers").first()[0] == 60
    assert [r.demand_mw for r in built["fct_intraday_demand"].orderBy("interval_id").collect()] == [20.0, 40.0]
    stored = store(raw, str(tmp_path))
    assert sorted(stored) == sorted(n for n in MODELS if n.startswith("fct_"))
    for name, df in stored.items():
        columns = [c for c in built[name].columns if c != "zone_name"]
        exact = [c for c, t in built[name].dtypes if c in columns and t != "double"]
        assert rows(df, *exact) == rows(built[name], *exact), name
    assert (tmp_path / "fct_daily_prices" / "month=2024-01-01").is_dir()


def test_without_a_wide_table_the_prices_stand_in(raw):
    del raw["entsoe_eu_hourly_wide"]
    got = build(raw, ["fct_eu_duck_curve"])
    assert list(got) == ["stg_entsoe__eu_hourly_wide", "fct_eu_duck_curve"]
    assert got["fct_eu_duck_curve"].where("avg_renewable_share is not null").isEmpty()
    assert got["fct_eu_duck_curve"].count() == raw["entsoe_eu_prices"].count()


def test_staging_drops_empty_measures_and_types_numbers(spark, raw):
    quotes = staging.quotes(raw["yahoo_prices"].union(raw["yahoo_prices"].limit(1).withColumn("close", F.lit(None))))
    assert quotes.count() == 60 and quotes.first().volume == 3
    assert dict(quotes.dtypes)["close_price"] == "decimal(18,6)"


def test_demand_events_literal_and_local(spark):
    records = spark.createDataFrame([("2024-07-01", "2024-07-02 00:00:00", 5.0)],
                                    "business_date string, dtime string, demand double")
    stamp = F.lit(START)
    literal = staging.demand_events(records, stamp).first()
    assert (literal.event_ts, literal.demand_date, literal.interval_id) == (datetime(2024, 7, 2), date(2024, 7, 2), 96)
    local = staging.demand_events(records, stamp, "Europe/Warsaw").first()
    assert (local.event_ts, local.demand_date, local.interval_id) == (datetime(2024, 7, 1, 22), date(2024, 7, 1), 96)
