import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window, functions as F

from gridlake.operators import windows
from testbed.queries import QUERIES


def test_frames_have_169_and_168_points(price_hours):
    prices = price_hours({"PL": {h: float(h) for h in range(400)}})
    ranged = {r.timestamp: r.price_7d_mean for r in windows.trailing_mean(prices, scale=2).collect()}
    counted = {r.timestamp: r.price_7d_mean for r in windows.trailing_rows_mean(prices, scale=2).collect()}
    last = max(ranged)
    assert ranged[last] == sum(range(231, 400)) / 169
    assert counted[last] == sum(range(232, 400)) / 168


def test_range_frame_sees_gaps_and_row_frame_does_not(price_hours):
    hours = [h for h in range(300) if not 100 <= h < 124]
    prices = price_hours({"PL": {h: float(h) for h in hours}})
    at = {r.timestamp.day * 24 + r.timestamp.hour - 24: r.price_7d_mean
          for r in windows.trailing_mean(prices).collect()}
    seen = [h for h in hours if 200 - 168 <= h <= 200]
    assert at[200] == pytest.approx(sum(seen) / len(seen)) and len(seen) < 169


def _series(zones=3, hours=1500, seed=5):
    """Irregular series with gaps, empty prices and one zone far longer than the others."""
    pick = random.Random(seed)
    return {
        f"Z{z}": {h: (None if pick.random() < 0.1 else round(pick.uniform(-50, 300), 2))
                  for h in range(hours if z == 0 else hours // 5) if pick.random() > 0.25}
        for z in range(zones)
    }


@pytest.mark.parametrize("slice_hours", [168, 200, 1000])
def test_sliced_range_equals_the_plain_window(price_hours, rows, slice_hours):
    prices = price_hours(_series())
    frame = (Window.partitionBy("zone").orderBy(F.col("timestamp").cast("long"))
             .rangeBetween(-168 * 3600, 0))
    plain = prices.withColumn("price_7d_mean", F.sum(F.rint(F.col("price_eur_mwh") * 100).cast("long")).over(frame)
                              / 100.0 / F.nullif(F.count("price_eur_mwh").over(frame), F.lit(0)))
    assert rows(windows.trailing_mean(prices, scale=2, slice_hours=slice_hours)) == rows(plain)


@pytest.mark.parametrize("slice_days, block_rows", [(1, 167), (3, 200), (28, None)])
def test_sliced_rows_equal_the_plain_window(price_hours, rows, slice_days, block_rows):
    prices = price_hours(_series())
    frame = Window.partitionBy("zone").orderBy("timestamp").rowsBetween(-167, 0)
    plain = prices.withColumn("price_7d_mean", F.sum(F.rint(F.col("price_eur_mwh") * 100).cast("long")).over(frame)
                              / 100.0 / F.nullif(F.count("price_eur_mwh").over(frame), F.lit(0)))
    got = windows.trailing_rows_mean(prices, scale=2, slice_days=slice_days, block_rows=block_rows)
    assert rows(got) == rows(plain)


def test_slices_must_hold_the_frame(price_hours):
    with pytest.raises(ValueError):
        windows.trailing_mean(price_hours({"PL": {0: 1.0}}), slice_hours=100)


def test_numbering_follows_the_order_in_every_series(price_hours):
    prices = price_hours(_series())
    got = windows.numbered(prices, ["zone"], ["timestamp"], "timestamp", windows.DAY)
    by_zone = {}
    for r in got.collect():
        by_zone.setdefault(r.zone, []).append((r._pos, r.timestamp))
    for found in by_zone.values():
        found.sort()
        assert [p for p, _ in found] == list(range(len(found)))
        assert [t for _, t in found] == sorted(t for _, t in found)


def test_null_series_is_numbered_too(spark):
    df = spark.createDataFrame([(None, date(2024, 1, d)) for d in (1, 2, 3)], "zone string, d date")
    got = windows.numbered(df, ["zone"], ["d"], "d", windows.DAY)
    assert sorted(r._pos for r in got.collect()) == [0, 1, 2]


def _quotes(spark, values, ticker="BRENT"):
    start = date(2024, 1, 1)
    return spark.createDataFrame(
        [(start + timedelta(days=i * 3), ticker, v) for i, v in enumerate(values)],
        "price_date date, ticker string, close_price double")


def test_returns_need_enough_history_and_a_base(spark):
    values = [float(i) for i in range(30)]  # the first close is zero
    got = sorted(windows.period_returns(_quotes(spark, values)).collect(), key=lambda r: r.price_date)
    assert [r.return_5d for r in got[:6]] == [None] * 6
    assert got[6].return_5d == 6.0 / 1.0 - 1
    assert got[20].return_20d is None and got[21].return_20d == 20.0


@pytest.mark.parametrize("slice_days, block_rows", [(5, 20), (40, 33), (366, None)])
def test_sliced_returns_equal_the_plain_window(spark, rows, slice_days, block_rows):
    pick = random.Random(3)
    quotes = _quotes(spark, [pick.uniform(1, 9) for _ in range(300)]).union(
        _quotes(spark, [pick.uniform(1, 9) for _ in range(12)], "EURPLN"))
    w = Window.partitionBy("ticker").orderBy("price_date")
    plain = quotes.withColumns({
        f"return_{n}d": F.try_divide("close_price", F.lag("close_price", n).over(w)) - 1 for n in (5, 20)})
    got = windows.period_returns(quotes, slice_days=slice_days, block_rows=block_rows)
    assert rows(got) == rows(plain)


LATEST = "k int, v string, at int, tie int"


def test_keep_latest_does_not_depend_on_input_order(spark, rows):
    data = [(1, "a", 1, 0), (1, "b", 3, 0), (1, "c", 3, 1), (1, "d", None, 9), (2, "e", None, 0)]
    for seed in range(4):
        shuffled = random.Random(seed).sample(data, len(data))
        df = spark.createDataFrame(shuffled, LATEST).repartition(3)
        assert rows(windows.keep_latest(df, ["k"], ["at", "tie"]), "k", "v") == [(1, "c"), (2, "e")]


def test_newest_version_keeps_all_its_rows(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", 1, 0), (1, "b", 3, 0), (1, "c", 3, 0), (None, "d", None, 0), (None, "e", 2, 0), (2, "f", None, 0)], LATEST)
    assert rows(windows.keep_newest_version(df, ["k"], "at"), "v") == [("b",), ("c",), ("e",), ("f",)]


def test_keep_latest_limits_groups_before_the_shuffle(spark):
    df = spark.range(100_000).selectExpr("id % 3 as k", "id as at")
    plan = windows.keep_latest(df, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("WindowGroupLimit"):]


def test_smoothed_demand(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 1), i, float(i)) for i in range(1, 7)] + [(date(2024, 1, 2), 1, 50.0)],
        "demand_date date, interval_id bigint, demand_mw double")
    got = {(r.demand_date.day, r.interval_id): r.demand_mw_1h_avg for r in windows.smoothed_demand(df).collect()}
    assert got[1, 1] == 1.0 and got[1, 4] == 2.5 and got[1, 6] == 4.5 and got[2, 1] == 50.0


@pytest.mark.parametrize("name, file", [("price_7d_rows", "events"), ("commodity_returns", "orders")])
def test_row_windows_scan_their_input_once(spark, name, file):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") == 1 and f"{file}.parquet" in final


def test_rows_with_a_map_are_numbered_too(price_hours, rows):
    prices = price_hours({"A": {h: float(h) for h in range(0, 300, 7)}, None: {3: 1.0}})
    mapped = prices.withColumn("m", F.create_map(F.lit("k"), F.col("zone")))
    got = windows.numbered(mapped, ["zone"], ["timestamp"], "timestamp", windows.DAY)
    plain = F.row_number().over(Window.partitionBy("zone").orderBy("timestamp")) - 1
    assert rows(got, "zone", "timestamp", "_pos") == rows(
        prices.select("zone", "timestamp", plain.cast("long").alias("_pos")))
