"""Reads of tables stored by month: which directories are read, and months of different shape."""

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridlake.__main__ import main
from gridlake.operators import reshape
from gridlake.operators.ranges import newest_day, trailing_days
from gridlake.plans import marts, reports, wide
from gridlake.operators import staging
from gridlake.sinks.tables import write_months
from gridlake.sources.landing import scan_merged, scan_table
from gridlake.sources.zones import zone_dimension

FIRST, DAYS = date(2024, 1, 1), 120
GEN = "date date, timestamp timestamp, zone string, fuel_type string, generation_mw double"
PRICES = "date date, timestamp timestamp, zone string, price_eur_mwh double"


def filters(df):
    """Partition filters of the scans of a plan."""
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", df._jdf.queryExecution().executedPlan().toString())


def rows_of(fuels):
    gen, prices = [], []
    for i in range(DAYS):
        at = datetime.combine(FIRST, datetime.min.time()) + timedelta(days=i, hours=i % 24)
        for zone in ("PL", "ES"):
            gen += [(at.date(), at, zone, f, float(i + k)) for k, f in enumerate(fuels(at.date()))]
            if i % 3:
                prices.append((at.date(), at, zone, float(i % 7 - 2)))
    return gen, prices


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Plain frames, and the same stored by month."""
    root, tables = tmp_path_factory.mktemp("tables"), []
    for name, data, schema in zip(("gen", "prices"), rows_of(lambda d: ["Solar", "Fossil Gas"]), (GEN, PRICES)):
        df = spark.createDataFrame(data, schema)
        write_months(df, f"{root}/{name}", "date", ["zone"])
        tables += [df, scan_table(spark, f"{root}/{name}")]
    return str(root), *tables


def test_a_day_of_a_month_table_reads_its_month(spark, stored):
    root, gen, *_ = stored
    day = scan_table(spark, f"{root}/gen", "2024-02-10")
    assert filters(day) == ["isnotnull(month#{0}), (month#{0} = 2024-02-01)".format(*re.findall(r"month#(\d+)", filters(day)[0]))]
    assert day.count() == 4


def test_both_sides_of_the_full_join_are_pruned(spark, stored):
    _, gen, gen_stored, prices, prices_stored = stored
    zones = zone_dimension(spark)
    as_of = F.lit("2024-03-05").cast("date")
    recent = reports.recent_daily(gen_stored, prices_stored, zones, 10, as_of)
    found = filters(recent)
    # ten days and the week before them: February and March, on either side
    assert len(found) == 2 and all("2024-02-01" in f and "2024-03-01" in f for f in found)
    all_days = marts.daily_by_region(staging.hourly_wide(wide.hourly_wide(gen, prices, "full")), zones)
    wanted = trailing_days(all_days, 10, as_of=as_of)
    assert wanted.count() == 20
    for columns in (["date", "zone_code", "avg_price_eur_mwh", "total_generation_mwh", "negative_price_hours"],):
        assert sorted(map(str, recent.select(columns).collect())) == sorted(map(str, wanted.select(columns).collect()))


def test_the_newest_day_needs_the_newest_month_only(spark, stored):
    _, gen, gen_stored, prices, prices_stored = stored
    assert spark.range(1).select(newest_day(gen_stored).alias("d")).first().d == FIRST + timedelta(days=DAYS - 1)
    last = trailing_days(gen_stored, 7)
    assert last.select("date").distinct().count() == 7
    assert any("month" in f for f in filters(last))
    zones = zone_dimension(spark)
    daily = reports.recent_daily(gen_stored, prices_stored, zones, 7)
    assert daily.select("date").distinct().count() == 7
    assert sum("month" in f for f in filters(daily)) >= 2


def changing(day):
    return ["Solar", "Fossil Gas"] if day.month < 3 else ["Fossil Gas", "Energy storage"]


def test_months_of_different_shape_are_one_table(spark, tmp_path):
    gen, prices = [spark.createDataFrame(d, s) for d, s in zip(rows_of(changing), (GEN, PRICES))]
    path = str(tmp_path / "wide")
    written = wide.write_wide_months(gen, prices, path)
    assert list(written) == [date(2024, m, 1) for m in (1, 2, 3, 4)]
    table = wide.scan_wide(spark, path)
    by_month = {r.month: r for r in table.groupBy(F.month("date").alias("month")).agg(
        *[F.count(c).alias(c) for c in ("solar", "fossil_gas", "energy_storage")]).collect()}
    assert (by_month[1].solar > 0, by_month[1].energy_storage, by_month[3].solar, by_month[3].energy_storage > 0) == (
        True, 0, 0, True)
    # the mean looks over the end of the month, and a month that is built again is replaced
    wide.write_wide_months(gen, prices, path, [date(2024, 3, 1)])
    whole = wide.hourly_wide(gen, prices, fuels=reshape.discover_fuels(gen))
    columns = ["date", "zone", "price_7d_mean", "total_mw", "renewable_share"]
    again = wide.scan_wide(spark, path)
    assert sorted(map(str, again.select(columns).collect())) == sorted(map(str, whole.select(columns).collect()))


def test_too_many_fuels_are_an_error(spark):
    gen = spark.createDataFrame([(f"Fuel {i}",) for i in range(7)] + [("fuel-1",), (None,)], "fuel_type string")
    assert len(reshape.discover_fuels(gen, 7)) == 7
    with pytest.raises(ValueError):
        reshape.discover_fuels(gen, 6)


def test_transform_with_fuels_of_the_data(spark, tmp_path):
    for name, data, schema in zip(("entsoe_eu_generation", "entsoe_eu_prices"), rows_of(changing), (GEN, PRICES)):
        spark.createDataFrame(data, schema).write.partitionBy("date").parquet(f"{tmp_path}/{name}")
    job = ["--tables", str(tmp_path), "transform", "--mode"]
    main([*job, "full", "--fuels", "data"])
    main([*job, "incremental", "--date", "2024-03-09", "--fuels", "data"])
    table = scan_merged(spark, f"{tmp_path}/entsoe_eu_hourly_wide")
    assert {"solar", "fossil_gas", "energy_storage"} < set(table.columns) and table.count() == 2 * DAYS
    main([*job, "full", "--fuels", "Fossil Gas"])
    assert "solar" not in scan_merged(spark, f"{tmp_path}/entsoe_eu_hourly_wide").columns


@pytest.mark.parametrize("listed", [1000, 1])
def test_only_the_partitions_of_a_batch_are_read(spark, tmp_path, monkeypatch, listed):
    """An old and a new day, and rows without a day: the days between stay unread, and whole."""
    from gridlake.sinks import tables

    monkeypatch.setattr(tables, "MOST_LISTED", listed)
    days = [(FIRST + timedelta(days=i), i) for i in range(9)] + [(None, 100)]
    path = str(tmp_path / "days")
    tables.reload_days(spark.createDataFrame(days, "date date, n int"), path, ["n"])
    stored = spark.read.parquet(path)
    batch = spark.createDataFrame([(FIRST, -1), (FIRST + timedelta(days=8), -2), (None, -3)], "date date, n int")
    same = tables.in_same_partitions(stored, batch, "date")
    assert sorted(r.n for r in same.collect()) == [0, 8, 100]
    if listed > 1:
        assert all(f"2024-01-0{i}" not in f for f in filters(same) for i in range(2, 9))
    tables.replace_keys(batch, path, ["date"], ["n"], by_month=False)
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [-3, -2, -1, *range(1, 8)]
