from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from gridlake.constants import FOSSIL_FUELS, FUEL_TYPES, RENEWABLE_FUELS
from gridlake.operators import reshape

NOON = datetime(2026, 4, 14, 12)
GEN = "date date, timestamp timestamp, zone string, fuel_type string, generation_mw double"


def gen(spark, cells, at=NOON):
    return spark.createDataFrame([(at.date(), at, z, f, v) for z, f, v in cells], GEN)


def mixed(spark, cells, **options):
    wide = reshape.energy_mix(reshape.pivot_generation(gen(spark, cells), **options))
    return {r.zone: r for r in wide.collect()}


def test_pivot_and_mix_of_two_zones(spark):
    got = mixed(spark, [
        ("PL", "Wind Onshore", 1500.0), ("PL", "Solar", 500.0), ("PL", "Fossil Hard coal", 8000.0),
        ("ES", "Solar", 12000.0), ("ES", "Fossil Gas", 2000.0)])
    pl, es = got["PL"], got["ES"]
    assert (pl.total_mw, pl.residual_load_mw) == (10000.0, 8000.0)
    assert (pl.renewable_share, pl.fossil_share) == (pytest.approx(0.2), pytest.approx(0.8))
    assert es.renewable_share == pytest.approx(12000 / 14000) and es.residual_load_mw == 2000.0
    assert pl.fossil_gas is None and es.solar == 12000.0


def test_rows_of_one_fuel_are_summed_and_odd_spellings_meet(spark):
    got = mixed(spark, [("PL", "Solar", 1.0), ("PL", "Solar", 2.0), ("PL", "SOLAR", 4.0),
                        ("PL", "Wind-Onshore", 8.0)])["PL"]
    assert (got.solar, got.wind_onshore) == (7.0, 8.0)


def test_empty_and_negative_hours(spark):
    got = mixed(spark, [("A", "Solar", None), ("B", "Solar", -5.0), ("C", "Nuclear", 10.0)])
    assert (got["A"].total_mw, got["A"].renewable_share, got["A"].fossil_share) == (0.0, None, None)
    assert (got["B"].total_mw, got["B"].renewable_share) == (-5.0, None)
    assert (got["C"].renewable_share, got["C"].fossil_share) == (0.0, 0.0)


def test_unknown_fuels_count_in_a_column_of_their_own(spark):
    got = mixed(spark, [("A", "Fusion", 10.0), ("A", None, 5.0), ("A", "Solar", 5.0)])["A"]
    assert (got.unlisted, got.total_mw, got.renewable_share) == (15.0, 20.0, 0.25)


def test_discovered_fuels_take_any_name(spark):
    df = gen(spark, [("A", "Fusion", 10.0), ("A", "Solar", 1.0), ("A", None, 3.0)])
    fuels = reshape.discover_fuels(df)
    assert fuels == ["fusion", "solar"]
    got = reshape.energy_mix(reshape.pivot_generation(df, fuels)).first()
    assert (got.fusion, got.total_mw, got.renewable_mw) == (10.0, 11.0, 1.0)


def test_fuel_classes_match_by_part_of_the_name():
    columns = reshape.fuel_columns()
    renewable = reshape.columns_matching(columns, RENEWABLE_FUELS)
    fossil = reshape.columns_matching(columns, FOSSIL_FUELS)
    assert len(renewable) == 9 and len(fossil) == 7 and not set(renewable) & set(fossil)
    assert fossil.count("fossil_oil_shale") == 1  # hit by two keywords
    assert not {"nuclear", "waste", "other", "other_renewable"} & {*renewable, *fossil}
    assert reshape.columns_matching(["_solar_actual_aggregated_"], RENEWABLE_FUELS)


def test_direction_filter_drops_consumption(spark, rows):
    wide = spark.createDataFrame(
        [(NOON, 5.0, 1.0, 7.0)],
        "timestamp timestamp, `Solar|Actual Aggregated` double, `Solar|Actual Consumption` double,"
        " `Fossil Gas|Actual Aggregated` double")
    long = reshape.unpivot_generation(reshape.keep_generation_direction(wide))
    assert rows(long, "fuel_type", "generation_mw") == [("Fossil Gas", 7.0), ("Solar", 5.0)]
    plain = wide.select("timestamp")
    assert reshape.keep_generation_direction(plain) is plain


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(
    st.tuples(st.sampled_from(["PL", "ES", "CZ"]), st.sampled_from(FUEL_TYPES)),
    st.integers(0, 10 ** 6), min_size=1, max_size=25))
def test_unpivot_undoes_pivot_and_shares_stay_in_range(spark, cells):
    cells = {k: v / 100 for k, v in cells.items()}
    wide = reshape.pivot_generation(gen(spark, [(z, f, v) for (z, f), v in cells.items()]), scale=2)
    back = reshape.unpivot_generation(wide, reshape.HOUR_KEYS).where("generation_mw is not null")
    names = dict(zip(FUEL_TYPES, reshape.fuel_columns()))
    assert {(r.zone, r.fuel_type): r.generation_mw for r in back.collect()} == {
        (z, names[f]): v for (z, f), v in cells.items()}
    for r in reshape.energy_mix(wide).collect():
        for share in (r.renewable_share, r.fossil_share):
            assert share is None or 0 <= share <= 1 + 1e-12


def test_landed_pairs_become_utc_rows(spark, rows):
    wide = spark.createDataFrame(
        [(NOON, 5.0, 1.0, float("nan"))],
        "timestamp timestamp, `('Solar', 'Actual Aggregated')` double, `('Solar', 'Actual Consumption')` double,"
        " `('Fossil Gas', 'Actual Aggregated')` double")
    got = reshape.generation_rows(wide, "PL", "Europe/Warsaw")
    at = datetime(2026, 4, 14, 10)
    assert rows(got, "timestamp", "fuel_type", "generation_mw", "zone") == [
        (at, "Fossil Gas", None, "PL"), (at, "Solar", 5.0, "PL")]


def test_union_series_tags_and_fills(spark, rows):
    a = spark.createDataFrame([(1.0,)], "close double")
    b = spark.createDataFrame([(2.0, 5.0)], "close double, volume double")
    got = reshape.union_series({"X": a, "Y": b})
    assert rows(got, "ticker", "close", "volume") == [("X", 1.0, None), ("Y", 2.0, 5.0)]
    with pytest.raises(ValueError):
        reshape.union_series({})


def test_hourly_resample(spark, rows):
    data = [(NOON.date(), NOON.replace(minute=m), "PL", v) for m, v in ((0, 1.0), (15, 2.0), (30, 6.0), (45, None))]
    df = spark.createDataFrame(data, "date date, timestamp timestamp, zone string, price_eur_mwh double")
    got = reshape.hourly(df, "price_eur_mwh", scale=2)
    assert rows(got, "timestamp", "price_eur_mwh") == [(NOON, 3.0)]


def test_flatten_names(spark):
    assert reshape.flatten_names(spark.createDataFrame([(1, 2)], "Date int, CLOSE int")).columns == ["date", "close"]
