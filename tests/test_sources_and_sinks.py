import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.plans import loads
from gridlake.session import cut_lineage, shared_dir
from gridlake.sinks import tables
from gridlake.sources import landing, zones
from gridlake.sources.registry import RAW_SCHEMAS, RawTables

D = date.fromisoformat
ROWS = "date date, zone string, v double"


def table(spark, data, schema=ROWS):
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("pattern, like", [("2025-*", "2025-%"), ("2025-0?-01", "2025-0_-01"), ("a_b%", "a\\_b\\%")])
def test_glob_to_like(pattern, like):
    assert landing.glob_to_like(pattern) == like


def test_landing_is_pruned_by_directory(spark, tmp_path, rows):
    path = str(tmp_path / "prices")
    data = [(datetime(2024, 1, d), float(d), z, z, f"2024-01-{d:02d}") for d in (9, 10, 11) for z in ("PL", "ES")]
    df = spark.createDataFrame(data, schemas.LANDED_PRICES)
    assert (tables.land(df, path), tables.land(df.limit(0), path)) == (6, 0)
    one = landing.scan_landing(spark, path, schemas.LANDED_PRICES, D("2024-01-10"))
    assert rows(one, "zone", "price_eur_mwh") == [("ES", 10.0), ("PL", 10.0)]
    some = landing.scan_landing(spark, path, schemas.LANDED_PRICES, "2024-01-1*", "PL")
    assert rows(some, "price_eur_mwh") == [(10.0,), (11.0,)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "StartsWith" in plan[plan.index("PartitionFilters"):].split("]")[0]
    assert landing.scan_landing(spark, path, schemas.LANDED_PRICES).count() == 6
    # landing a chunk again replaces it and nothing else
    tables.land(df.where("dt = '2024-01-10' and zone = 'PL'").withColumn("price_eur_mwh", F.lit(-1.0)), path)
    again = landing.scan_landing(spark, path, schemas.LANDED_PRICES)
    assert again.count() == 6 and again.where("price_eur_mwh = -1").count() == 1


def test_absent_or_empty_is_none_but_broken_is_an_error(spark, tmp_path):
    assert landing.scan_or_none(spark, str(tmp_path / "none")) is None
    empty = str(tmp_path / "empty")
    table(spark, []).write.parquet(empty)
    assert landing.scan_or_none(spark, empty) is None
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="footer"):
        landing.scan_or_none(spark, str(tmp_path / "broken"))


def test_demand_envelopes(spark, tmp_path, rows):
    lines = [{"value": [{"business_date": "2024-01-01", "dtime": "2024-01-01 00:15", "demand": 5, "jgm2": 1},
                        {"business_date": "2024-01-01", "dtime": "2024-01-01 00:30", "demand": None}]},
             {"value": []}, {}]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, lines)))
    got = landing.scan_demand_envelopes(spark, str(tmp_path))
    assert rows(got) == [("2024-01-01", "2024-01-01 00:15", 5.0), ("2024-01-01", "2024-01-01 00:30", None)]


def test_quotes_skip_absent_series(spark, tmp_path, rows):
    (tmp_path / "BRENT").mkdir()
    (tmp_path / "BRENT" / "a.csv").write_text("Date,Open,High,Low,Close,Volume\n2024-01-01,1,3,1,2,7\n2024-01-02,,,,,\n")
    got = landing.scan_quotes(spark, str(tmp_path))
    assert rows(got, "date", "ticker", "close", "volume") == [
        (D("2024-01-01"), "BRENT", 2.0, 7.0), (D("2024-01-02"), "BRENT", None, None)]
    with pytest.raises(ValueError):
        landing.scan_quotes(spark, str(tmp_path / "nothing"))


def test_zone_sources(spark, tmp_path, rows):
    dim = zones.zone_dimension(spark)
    assert dim.count() == 14
    assert zones.zones_by_region(dim, "southern").count() == 10 and zones.zones_by_region(dim).count() == 14
    assert rows(zones.only_zones(dim, ["PL", "CZ"]), "zone_code") == [("CZ",), ("PL",)]
    assert zones.only_zones(dim).count() == 14
    nested = tmp_path / "zones.json"
    nested.write_text(json.dumps({"zones": [
        {"code": "PL", "country": "Poland", "region": "Eastern"},
        {"code": "IT_NORD", "country": "Italy", "region": "Southern", "zone_name": "North"}]}, indent=1))
    assert rows(zones.scan_zone_json(spark, str(nested)), "zone_code", "zone_name") == [
        ("IT_NORD", "North"), ("PL", None)]
    dim.coalesce(1).write.option("header", True).csv(str(tmp_path / "csv"))
    assert rows(zones.scan_zone_csv(spark, str(tmp_path / "csv"))) == rows(dim)


def test_registry(spark, tmp_path):
    raw = RawTables(spark, str(tmp_path))
    spark.createDataFrame([(D("2024-01-01"), datetime(2024, 1, 1), "PL", 1.0)], schemas.ZONE_PRICES).write.parquet(
        raw.path("entsoe_eu_prices"))
    raw.register_views(["entsoe_eu_prices"])
    assert spark.sql("select zone from entsoe_eu_prices").first().zone == "PL"
    assert len(RAW_SCHEMAS) == 7
    with pytest.raises(KeyError):
        raw.path("unknown")
    day = landing.scan_table(spark, raw.path("entsoe_eu_prices"), "2024-01-02", schemas.ZONE_PRICES)
    assert day.isEmpty() and "PushedFilters: [IsNotNull(date), EqualTo(date,2024-01-02)]" in (
        day._jdf.queryExecution().executedPlan().toString())


OLD = [(D(f"2024-0{m}-{d:02d}"), z, 1.0) for m in (1, 2, 3) for d in (1, 2) for z in ("PL", "ES")]


def test_month_table_keeps_untouched_files(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.write_months(table(spark, OLD), path, "date", ["zone"])
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("month=2024-01-01/*.parquet")}
    batch = table(spark, [(D("2024-02-01"), "PL", 9.0), (D("2024-02-03"), "PL", 9.0)])
    for _ in range(2):
        tables.replace_keys(batch, path, ["date"], ["zone"])
        got = spark.read.parquet(path)
        expected = [r for r in OLD if r[0] != D("2024-02-01")] + [(D("2024-02-01"), "PL", 9.0), (D("2024-02-03"), "PL", 9.0)]
        assert rows(got, "date", "zone", "v") == sorted(expected, key=lambda t: tuple((False, str(v)) for v in t))
    assert before == {p: p.stat().st_mtime_ns for p in tmp_path.rglob("month=2024-01-01/*.parquet")}


def test_a_batch_of_one_zone_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_keys(table(spark, OLD), path, ["date", "zone"], ["zone"], by_month=False)
    tables.replace_keys(table(spark, [(D("2024-02-01"), "PL", 9.0)]), path, ["date", "zone"], ["zone"], by_month=False)
    got = {(r.date, r.zone): r.v for r in spark.read.parquet(path).collect()}
    assert len(got) == 12 and got[D("2024-02-01"), "PL"] == 9.0 and got[D("2024-02-01"), "ES"] == 1.0
    with pytest.raises(ValueError):
        tables.replace_keys(table(spark, OLD), path, ["zone"], ["zone"])


def test_partitions_between_the_touched_ones_stay(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.write_months(table(spark, OLD), path, "date", ["zone"])
    batch = table(spark, [(D("2024-01-01"), "PL", 9.0), (D("2024-03-01"), "PL", 9.0)])
    tables.replace_keys(batch, path, ["date", "zone"], ["zone"])
    assert spark.read.parquet(path).groupBy("v").count().orderBy("v").collect() == [(1.0, 10), (9.0, 2)]


def test_reload_days_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    df = table(spark, OLD)
    for _ in range(2):
        tables.reload_days(df, path, ["zone"])
    assert spark.read.parquet(path).count() == 12
    tables.append(df, path, ["date"], ["zone"])
    assert spark.read.parquet(path).count() == 24


def test_upsert_does_not_depend_on_batch_order_and_repeats(spark, tmp_path, rows):
    schema = "date date, k int, at int, v string"
    batches = [
        [(D("2024-01-31"), 1, 1, "old"), (D("2024-01-31"), 1, 2, "new"), (D("2024-02-01"), 1, 5, "x")],
        [(D("2024-01-31"), 1, 3, "newest"), (D("2024-03-01"), 2, 1, "y")],
        [(D("2024-01-31"), 1, 1, "late"), (D("2024-02-01"), 2, 1, "z")],
    ]
    results = []
    for number, order in enumerate(((0, 1, 2), (2, 1, 0), (1, 1, 0, 2, 0))):
        path = str(tmp_path / str(number))
        for i in order:
            tables.upsert(table(spark, batches[i], schema), path, ["date", "k"], ["at"], ["k"], "date")
        results.append(rows(spark.read.parquet(path), "date", "k", "v"))
    assert results[0] == results[1] == results[2] == [
        (D("2024-01-31"), 1, "newest"), (D("2024-02-01"), 1, "x"), (D("2024-02-01"), 2, "z"), (D("2024-03-01"), 2, "y")]


def test_ensure_table(spark, tmp_path):
    for _ in range(2):
        tables.ensure_table(spark, "demand_target", schemas.DEMAND_STREAM, str(tmp_path / "d"), ["demand_date"])
    got = spark.table("demand_target")
    assert got.count() == 0 and dict(got.dtypes)["interval_id"] == "bigint"
    spark.sql("drop table demand_target")


def test_cut_lineage_writes_to_the_shared_folder(spark):
    df = cut_lineage(spark.range(10).selectExpr("id * 2 as v"))
    assert df.agg(F.sum("v")).first()[0] == 90
    assert "Range" not in df._jdf.queryExecution().executedPlan().toString()
    assert shared_dir(spark)


def _landed(spark, rows_, kind):
    return spark.createDataFrame(rows_, kind)


def test_newest_chunk_wins_and_nan_becomes_null(spark, tmp_path):
    landed, stored = str(tmp_path / "l"), str(tmp_path / "s")
    hour = datetime(2024, 5, 1, 7)
    data = [(hour, 1.0, "PL", "PL", "2024-05-01"), (hour, 2.0, "PL", "PL", "2024-12-31"),
            (hour + timedelta(hours=1), float("nan"), "PL", "PL", "2024-05-01"), (hour, 4.0, "ES", "ES", "2024-05-01")]
    tables.land(_landed(spark, data, schemas.LANDED_PRICES), landed)
    assert loads.load_prices(spark, landed, stored)
    got = {(r.zone, r.timestamp.hour): r.price_eur_mwh for r in spark.read.parquet(stored).collect()}
    assert got == {("PL", 7): 2.0, ("PL", 8): None, ("ES", 7): 4.0}
    # a batch of one zone replaces that zone's day only
    tables.land(_landed(spark, [(hour, 9.0, "PL", "PL", "2025-01-01")], schemas.LANDED_PRICES), landed)
    assert loads.load_prices(spark, landed, stored, "2025-*", replace="zone_days")
    got = {(r.zone, r.timestamp.hour): r.price_eur_mwh for r in spark.read.parquet(stored).collect()}
    assert got == {("PL", 7): 9.0, ("ES", 7): 4.0}
    assert not loads.load_prices(spark, str(tmp_path / "none"), stored)


def test_two_rows_of_one_fuel_in_one_chunk_are_both_kept(spark, tmp_path):
    landed, stored = str(tmp_path / "l"), str(tmp_path / "s")
    hour = datetime(2024, 5, 1, 7)
    data = [(hour, "Solar", v, "PL", "PL", "2024-05-01") for v in (1.0, 2.0)]
    tables.land(_landed(spark, data, schemas.LANDED_GENERATION), landed)
    assert loads.load_generation(spark, landed, stored)
    assert spark.read.parquet(stored).count() == 2


def test_work_lists(spark, rows, price_hours):
    dim = zones.zone_dimension(spark).where("zone_code in ('PL', 'ES')")
    done = spark.createDataFrame([("PL", 2023)], schemas.BACKFILL_PROGRESS)
    assert rows(loads.pending_chunks(dim, 2023, 2024, done)) == [("ES", 2023), ("ES", 2024), ("PL", 2024)]
    prices = price_hours({"PL": {0: 1.0, 9000: 1.0}, "ES": {0: 1.0}})
    generation = price_hours({"PL": {1: 1.0}})
    assert rows(loads.landed_chunks(prices, generation)) == [("PL", 2024)]
    assert rows(loads.landed_chunks(prices)) == [("ES", 2024), ("PL", 2024), ("PL", 2025)]
    assert rows(loads.missing_days(prices, "2023-12-31", "2024-01-02")) == [(D("2023-12-31"),), (D("2024-01-02"),)]


def test_pairs_are_landed_together_or_not_at_all(spark, tmp_path):
    hour = datetime(2024, 5, 1)
    prices = spark.createDataFrame([(hour, 1.0, z, "2024-05-01") for z in ("PL", "ES")],
                                   "timestamp timestamp, price_eur_mwh double, zone string, dt string")
    generation = spark.createDataFrame([(hour, "Solar", 1.0, "PL", "2024-05-01")],
                                       "timestamp timestamp, fuel_type string, generation_mw double, zone string, dt string")
    assert loads.land_pair(prices, generation, str(tmp_path)) == {"eu_prices": 1, "eu_generation": 1}
    assert [p.name for p in (tmp_path / "eu_prices").glob("country=*")] == ["country=PL"]
    assert [p.name for p in (tmp_path / "eu_generation").glob("country=*")] == ["country=PL"]


def test_day_and_range_refresh(spark, tmp_path, price_hours):
    prices = price_hours({"PL": {0: 1.0, 30: 2.0}, "ES": {1: 3.0}}).select("timestamp", "zone", "price_eur_mwh")
    assert loads.refresh_day(prices, "2024-01-01", str(tmp_path / "d"), ["PL"])
    assert [p.name for p in (tmp_path / "d").rglob("dt=*")] == ["dt=2024-01-01"]
    assert not loads.refresh_day(prices, "2024-03-01", str(tmp_path / "d"))
    demand = spark.createDataFrame([(f"2024-01-0{d}", 1.0) for d in (1, 2, 4)], "doba string, zap_kse double")
    assert loads.refresh_range(demand, "2024-01-02", "2024-01-04", str(tmp_path / "r"))
    assert sorted(p.name for p in (tmp_path / "r").glob("dt=*")) == ["dt=2024-01-02", "dt=2024-01-04"]
