from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridlake import functions as fn
from gridlake.constants import FUEL_TYPES


@pytest.mark.parametrize("name, expected", [
    ("Fossil Brown coal/Lignite", "fossil_brown_coal_lignite"),
    ("Hydro Run-of-river and poundage", "hydro_run_of_river_and_poundage"),
    ("Solar", "solar"),
    ("('Solar', 'Actual Aggregated')", "_solar_actual_aggregated_"),
])
def test_normalize_name_is_the_same_for_names_and_columns(spark, name, expected):
    assert fn.normalize_name(name) == expected
    assert spark.createDataFrame([(name,)], "n string").select(fn.normalize_name(F.col("n"))).first()[0] == expected


def test_fuel_names_stay_distinct():
    assert len({fn.normalize_name(f) for f in FUEL_TYPES}) == len(FUEL_TYPES)


@pytest.mark.parametrize("clock, expected", [
    ("00:15", 1), ("00:30", 2), ("12:00", 48), ("23:45", 95), ("00:00", 96), ("00:14", 96), ("00:29", 1)])
def test_interval_id(spark, clock, expected):
    df = spark.createDataFrame([(f"2024-03-05 {clock}:00",)], "t string")
    assert df.select(fn.interval_id(F.col("t").cast("timestamp"))).first()[0] == expected


def test_interval_day_closes_its_own_day(spark):
    df = spark.createDataFrame([("2024-03-06 00:00:00",), ("2024-03-06 00:15:00",)], "t string")
    days = [r[0] for r in df.select(fn.interval_day(F.col("t").cast("timestamp"))).collect()]
    assert days == [date(2024, 3, 5), date(2024, 3, 6)]


def test_local_to_utc_follows_daylight_saving(spark):
    df = spark.createDataFrame([("2024-01-15 12:00:00",), ("2024-07-15 12:00:00",)], "t string")
    utc = [r[0] for r in df.select(
        fn.local_to_utc(F.col("t").cast("timestamp"), "Europe/Warsaw").cast("string")).collect()]
    assert utc == ["2024-01-15 11:00:00", "2024-07-15 10:00:00"]


def test_to_int64_rounds_halves_away_from_zero(spark):
    df = spark.createDataFrame([(2.7,), (2.5,), (-2.5,), (2.4,), (None,)], "v double")
    assert [r[0] for r in df.select(fn.to_int64(F.col("v"))).collect()] == [3, 3, -3, 2, None]


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (1.0, -2.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(fn.guarded_ratio(F.col("a"), F.col("b"))).collect()] == [0.25, None, None, None]


def test_null_safe_sum(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (1.0, 2.5)], "a double, b double")
    assert [r[0] for r in df.select(fn.null_safe_sum(["a", "b"])).collect()] == [1.0, 0.0, 3.5]
    assert df.select(fn.null_safe_sum([])).first()[0] == 0.0


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,), (None,)], "v double")
    assert [r[0] for r in df.select(fn.nan_to_null(F.col("v"))).collect()] == [None, 1.5, None]


def test_period_return_of_a_zero_base_is_null(spark):
    df = spark.createDataFrame([(11.0, 10.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    got = [r[0] for r in df.select(fn.period_return(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(0.1) and got[1:] == [None, None]


def test_millis_round_trip_and_key(spark):
    df = spark.createDataFrame([(1_712_000_123_456,)], "m bigint").select(
        fn.timestamp_to_millis(fn.millis_to_timestamp(F.col("m"))).alias("m"),
        fn.message_key(F.lit(date(2024, 4, 1)), F.lit(96)).alias("k"))
    assert tuple(df.first()) == (1_712_000_123_456, "2024-04-01-96")


def test_default_source_and_constant_types(spark):
    df = spark.createDataFrame([(None,), ("X",)], "s string")
    assert [r[0] for r in df.select(fn.default_source(F.col("s"))).collect()] == ["PSE", "X"]
    assert df.select(fn.to_numeric(F.lit(1.5))).dtypes[0][1] == "decimal(18,6)"


def test_exact_measures_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e6 + 0.7, -0.6, 123456.78] * 50
    totals = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        totals.add(tuple(df.agg(fn.total(F.col("v"), 2), fn.mean(F.col("v"), 2)).first()))
    assert len(totals) == 1
    assert totals.pop()[0] == round(sum(round(v * 100) for v in values) / 100, 2)


def test_measures_of_nothing_are_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert tuple(df.agg(fn.total(F.col("v"), 2), fn.mean(F.col("v"), 2), fn.mean(F.col("v"))).first()) == (None,) * 3


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_epoch_micros(spark, kind):
    df = spark.createDataFrame([("1970-01-02 00:00:00",)], "t string").select(F.col("t").cast(kind).alias("t"))
    assert df.select(fn.epoch_micros(df, "t")).first()[0] == 86_400_000_000


def test_month_of(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 29, 13),)], "t timestamp")
    assert df.select(fn.month_of(fn.date_of(F.col("t")))).first()[0] == date(2024, 2, 1)
