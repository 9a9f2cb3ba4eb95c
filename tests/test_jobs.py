"""The command line, end to end on a small lake."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.__main__ import main
from gridlake.sinks.tables import land
from gridlake.streaming.feed import publish

START = datetime(2024, 1, 25)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    hours = [START + timedelta(hours=h) for h in range(24 * 14)]
    prices = [(t, float(i % 60 - 10), z, z, str(t.date())) for i, t in enumerate(hours) for z in ("PL", "ES")]
    generation = [(t, f, 10.0 * (i % 5), z, z, str(t.date())) for i, t in enumerate(hours)
                  for z in ("PL", "ES") for f in ("Solar", "Fossil Gas")]
    land(spark.createDataFrame(prices, schemas.LANDED_PRICES), f"{root}/eu_prices", ["dt"])
    land(spark.createDataFrame(generation, schemas.LANDED_GENERATION), f"{root}/eu_generation", ["dt"])
    demand = [(t + timedelta(minutes=15), t.date(), 1, float(c), "PSE", t + timedelta(minutes=c))
              for t in hours[::24] for c in range(3)]
    publish(spark.createDataFrame(demand, schemas.DEMAND_STREAM), f"{root}/demand_stream")
    return root


def run(lake, *job):
    main(["--lake", str(lake), "--tables", f"{lake}/tables", *job])


def test_lake_to_marts(spark, lake, capsys, rows):
    run(lake, "pending", "--start", "2024", "--end", "2024", "--zones", "PL", "HU")
    assert "HU" in capsys.readouterr().out
    run(lake, "load")
    run(lake, "load", "--date", "2024-02-01")
    prices = spark.read.parquet(f"{lake}/tables/entsoe_eu_prices")
    assert prices.count() == 24 * 14 * 2
    run(lake, "pending", "--start", "2024", "--end", "2025", "--zones", "PL")
    shown = capsys.readouterr().out
    assert "2025" in shown and "|PL  |2024" not in shown

    run(lake, "transform", "--mode", "full")
    wide = f"{lake}/tables/entsoe_eu_hourly_wide"
    before = rows(spark.read.parquet(wide).withColumn("price_7d_mean", F.round("price_7d_mean", 9)))
    run(lake, "transform", "--mode", "incremental", "--date", "2024-02-03")
    assert rows(spark.read.parquet(wide).withColumn("price_7d_mean", F.round("price_7d_mean", 9))) == before

    run(lake, "stream")
    run(lake, "marts", "--only", "fct_eu_regional_summary", "fct_eu_duck_curve")
    assert "accepted_values" in capsys.readouterr().out
    summary = spark.read.parquet(f"{lake}/tables/marts/fct_eu_regional_summary")
    assert summary.count() == 14 * 2 and summary.agg(F.sum("regional_generation_mwh")).first()[0] > 0
    demand = spark.read.parquet(f"{lake}/tables/marts/fct_intraday_demand")
    assert demand.count() == 14 and {r.demand_mw for r in demand.collect()} == {2.0}
    run(lake, "stream")  # nothing new
    assert spark.read.parquet(f"{lake}/tables/marts/fct_intraday_demand").count() == 14
