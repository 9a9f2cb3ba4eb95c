from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from gridlake.operators import clock, staging

WARSAW = "Europe/Warsaw"


def local(utc):
    return utc.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(WARSAW)).replace(tzinfo=None)


def feed(spark, start, quarters, series=("A",)):
    rows = [(s, local(start + timedelta(minutes=15 * i)), i, start + timedelta(minutes=15 * i))
            for s in series for i in range(quarters)]
    return spark.createDataFrame(rows, "zone string, timestamp timestamp, place long, truth timestamp")


@pytest.mark.parametrize("start", [datetime(2024, 3, 30, 12), datetime(2024, 10, 26, 12), datetime(2025, 10, 25, 20)])
def test_instants_come_back_on_both_change_days(spark, start):
    got = clock.with_utc(feed(spark, start, 200, ("A", "B", None)), WARSAW, ["place"])
    assert got.count() == 600
    assert got.where(~F.col("timestamp_utc").eqNullSafe(F.col("truth"))).count() == 0


@pytest.mark.parametrize("day, length", [(date(2024, 3, 31), 92), (date(2024, 10, 27), 100), (date(2024, 7, 1), 96)])
def test_intervals_of_a_day_are_gapless(spark, day, length):
    begin = datetime.combine(day, datetime.min.time()) - timedelta(hours=3)
    records = feed(spark, begin, 130).select(
        F.col("timestamp").cast("string").alias("dtime"), F.lit(1).alias("demand"), "place")
    rows = staging.demand_events_by_order(records, WARSAW, ["place"]).where(F.col("demand_date") == F.lit(day))
    assert sorted(r.interval_id for r in rows.collect()) == list(range(1, length + 1))


def test_a_gap_in_the_second_pass_does_not_end_it(spark):
    stamps = ["02:00", "02:15", "02:30", "02:45", "02:00", "02:45", "03:00"]
    rows = spark.createDataFrame(
        [("A", datetime.fromisoformat(f"2024-10-27 {s}"), i) for i, s in enumerate(stamps)],
        "zone string, timestamp timestamp, place long")
    got = [f"{r.timestamp_utc:%H:%M}" for r in clock.with_utc(rows, WARSAW, ["place"]).orderBy("place").collect()]
    assert got == ["00:00", "00:15", "00:30", "00:45", "01:00", "01:45", "02:00"]


def test_nulls_lone_rows_and_empty_tables(spark):
    rows = spark.createDataFrame(
        [("A", None, 1), ("A", datetime(2024, 10, 27, 2, 30), None)], "zone string, timestamp timestamp, place long")
    got = {r.place: r.timestamp_utc for r in clock.with_utc(rows, WARSAW, ["place"]).collect()}
    assert got == {1: None, None: datetime(2024, 10, 27, 0, 30)}
    assert clock.with_utc(rows.limit(0), WARSAW, ["place"]).count() == 0


def test_without_an_order_the_first_pass_counts(spark):
    rows = feed(spark, datetime(2024, 10, 27, 0), 8)
    got = staging.to_utc(rows, WARSAW).where(F.col("timestamp") >= F.lit("2024-10-27 01:00:00").cast("timestamp"))
    assert got.count() == 0
    assert staging.to_utc(rows, WARSAW, order=["place"]).where("timestamp = truth").count() == 8
