"""Every operator of the library as a query over the test tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridlake import schemas
from gridlake.functions import columns, message_key, total
from gridlake.operators import joins, quality, reshape, staging, windows
from gridlake.plans import build, loads, marts, reports, wide
from gridlake.session import shared_dir
from gridlake.sinks import buckets, checked, tables as sinks
from gridlake.sources import landing, zones as zone_sources
from gridlake.sources.registry import RawTables
from gridlake.streaming import feed, intake, sinks as stream_sinks
from gridlake.streaming.ledger import Ledger
from testbed import derive
from testbed.derive import table

CUT = "2024-01-20"
DAY = "2024-01-15"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/gridlake-checks/{name}-{uuid.uuid4().hex}"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and instants as UTC wall-clock time, the types both engines compare."""
    kinds = {"decimal": "double", "timestamp": "timestamp_ntz"}
    return df.select(*[
        F.col(f"`{name}`").cast(kinds[kind.split("(")[0]]).alias(name) if kind.split("(")[0] in kinds
        else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ])


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- staging and scalar functions -------------------------------------------------------------------

def stg_prices(spark, sf_dir):
    return plain(staging.country_prices(derive.country_prices(spark, sf_dir)))


def stg_demand(spark, sf_dir):
    return plain(staging.demand(derive.demand_batch(spark, sf_dir)))


def stg_quotes(spark, sf_dir):
    return plain(staging.quotes(derive.quotes(spark, sf_dir)))


def demand_events(spark, sf_dir):
    events = staging.demand_events(derive.feed_records(spark, sf_dir), F.lit(None).cast("timestamp"))
    return plain(events.withColumn("key", message_key(F.col("demand_date"), F.col("interval_id"))))


def demand_events_local(spark, sf_dir):
    records = derive.feed_records(spark, sf_dir)
    return plain(staging.demand_events(records, F.lit(None).cast("timestamp"), "Europe/Warsaw"))


def prices_to_utc(spark, sf_dir):
    return plain(staging.to_utc(derive.prices(spark, sf_dir), "Europe/Warsaw"))


def prices_to_utc_dst(spark, sf_dir):
    return plain(staging.to_utc(derive.local_prices(spark, sf_dir), "Europe/Warsaw", order=["place"]).drop("place"))


def demand_intervals_dst(spark, sf_dir):
    return plain(staging.demand_events_by_order(
        derive.local_records(spark, sf_dir), "Europe/Warsaw", ["place", "event_id"], F.lit(None).cast("timestamp")))


def hourly_resample(spark, sf_dir):
    readings = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"), F.col("ts").alias("timestamp"),
        (F.col("user_id") % derive.N_ZONES).cast("string").alias("zone"),
        F.col("value").alias("price_eur_mwh"))
    return reshape.hourly(readings, "price_eur_mwh", scale=2)


# --- reshape and mix --------------------------------------------------------------------------------

def pivot_generation(spark, sf_dir):
    return reshape.pivot_generation(derive.generation(spark, sf_dir), scale=2)


def pivot_bulk(spark, sf_dir):
    pivoted = reshape.pivot_generation(derive.bulk_generation(spark, sf_dir), scale=2)
    return reshape.energy_mix(pivoted)


def unpivot_generation(spark, sf_dir):
    return reshape.unpivot_generation(pivot_generation(spark, sf_dir), reshape.HOUR_KEYS)


def generation_direction(spark, sf_dir):
    """Landed with a column per fuel and direction; odd `k` stands for consumption, which is dropped."""
    path = scratch(spark, "generation-wide")
    hour = F.date_trunc("hour", "ts").alias("timestamp")
    cells = [
        total(F.when((F.col("event_type") == kind) & F.col("props").rlike(digit), F.col("value")), 2)
        .alias(f"{fuel}|{side}")
        for fuel, kind in (("Solar", "click"), ("Wind Onshore", "view"), ("Fossil Gas", "purchase"))
        for side, digit in (("Actual Aggregated", "[02468]}"), ("Actual Consumption", "[13579]}"))
    ]
    table(spark, sf_dir, "events").groupBy(hour).agg(*cells).write.parquet(path)
    return plain(reshape.generation_rows(spark.read.parquet(path), "PL", "Europe/Warsaw"))


def energy_mix(spark, sf_dir):
    return reshape.energy_mix(pivot_generation(spark, sf_dir))


def _wide(spark, sf_dir, how="left"):
    return wide.hourly_wide(derive.generation(spark, sf_dir), derive.prices(spark, sf_dir), how, scale=2)


def hourly_wide(spark, sf_dir):
    return _wide(spark, sf_dir)


def hourly_wide_full(spark, sf_dir):
    return _wide(spark, sf_dir, "full")


def hourly_wide_day(spark, sf_dir):
    return wide.hourly_wide_for_day(
        derive.generation(spark, sf_dir), derive.prices(spark, sf_dir), DAY, scale=2)


# --- windows ----------------------------------------------------------------------------------------

def price_7d_range(spark, sf_dir):
    return windows.trailing_mean(derive.prices(spark, sf_dir), scale=2)


def price_7d_rows(spark, sf_dir):
    return staging.hourly_price_only(derive.prices(spark, sf_dir), scale=2)


def demand_dedup(spark, sf_dir):
    return staging.latest_demand(derive.demand_stream(spark, sf_dir), ["event_id"])


def demand_1h_avg(spark, sf_dir):
    return marts.intraday_demand(demand_dedup(spark, sf_dir), scale=2)


# --- marts ------------------------------------------------------------------------------------------

def _staged(spark, sf_dir):
    return staging.hourly_wide(_wide(spark, sf_dir, "full"))


def hourly_with_region(spark, sf_dir):
    return marts.hourly_with_region(_staged(spark, sf_dir), derive.zones(spark, sf_dir))


def _daily(spark, sf_dir):
    return marts.daily_by_region(_staged(spark, sf_dir), derive.zones(spark, sf_dir), scale=2)


def _summary(spark, sf_dir):
    return marts.regional_summary(_daily(spark, sf_dir), scale=2)


def daily_by_region(spark, sf_dir):
    return rounded(_daily(spark, sf_dir), "price_std", "avg_renewable_share", "avg_fossil_share")


def regional_summary(spark, sf_dir):
    return rounded(
        _summary(spark, sf_dir), "regional_avg_price_eur_mwh", "regional_avg_price_std",
        "regional_renewable_share", "regional_fossil_share")


def _curve(spark, sf_dir):
    return marts.duck_curve(_staged(spark, sf_dir), derive.zones(spark, sf_dir), scale=2)


def duck_curve(spark, sf_dir):
    return rounded(_curve(spark, sf_dir), "avg_renewable_share")


def daily_prices(spark, sf_dir):
    staged = staging.country_prices(derive.country_prices(spark, sf_dir))
    return plain(marts.daily_prices(staged, scale=2))


def commodity_returns(spark, sf_dir):
    return plain(marts.commodity_drivers(staging.quotes(derive.quotes(spark, sf_dir))))


# --- joins and set differences ----------------------------------------------------------------------

def zone_spread(spark, sf_dir):
    return joins.zone_spread(derive.prices(spark, sf_dir), "3")


def incremental_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return joins.newer_than_target(events, events.where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz")), "ts")


def merge_demand(spark, sf_dir):
    rows = derive.demand_stream(spark, sf_dir)
    old = staging.latest_demand(rows, ["event_id"]).withColumn("demand_mw", F.col("demand_mw") / 2)
    new = staging.latest_demand(rows.where(F.col("demand_date") >= F.lit(CUT).cast("date")), ["event_id"])
    return sinks.merge_rows(old, new, ["demand_date", "interval_id"])


def _ordered(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("c_nationkey").cast("string").alias("zone"), F.col("o_orderdate").alias("timestamp"))


def pending_chunks(spark, sf_dir):
    done = loads.landed_chunks(_ordered(spark, sf_dir))
    return loads.pending_chunks(derive.zones(spark, sf_dir), 1993, 2003, done)


def landed_chunks(spark, sf_dir):
    return loads.landed_chunks(_ordered(spark, sf_dir), derive.bulk_generation(spark, sf_dir))


def complete_pairs(spark, sf_dir):
    pair = loads.complete_pairs(
        derive.prices(spark, sf_dir), derive.generation(spark, sf_dir), ("zone", "timestamp"))
    tagged = [
        df.select("zone", "timestamp", F.col(value).alias("value"), F.lit(value).alias("measure"))
        for df, value in zip(pair, ("price_eur_mwh", "generation_mw"))
    ]
    return tagged[0].unionByName(tagged[1])


def missing_days(spark, sf_dir):
    return loads.missing_days(derive.prices(spark, sf_dir), "2023-12-20", "2024-02-10")


def batch_dates(spark, sf_dir):
    dates = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    return dates.groupBy("date").agg(F.count(F.lit(1)).alias("n_rows"))


def union_tickers(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("close"), "o_orderpriority")
    frames = {t: orders.where(F.col("o_orderpriority") == t).drop("o_orderpriority") for t in derive.TICKERS}
    return reshape.union_series(frames)


# --- reports ----------------------------------------------------------------------------------------

def _newest(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(F.to_date(F.max("ts"))).scalar()


def scorecard_10d(spark, sf_dir):
    report = reports.price_scorecard(_summary(spark, sf_dir), 10, _newest(spark, sf_dir))
    return rounded(report, "avg_price_eur_mwh")


def region_spread(spark, sf_dir):
    report = reports.region_spread(_summary(spark, sf_dir), "AFRICA", "ASIA")
    return rounded(report, "left_price_eur_mwh", "right_price_eur_mwh", "spread_eur_mwh")


def neg_hours_10d(spark, sf_dir):
    return reports.negative_hours(_summary(spark, sf_dir), 10, _newest(spark, sf_dir))


def country_10d(spark, sf_dir):
    report = reports.country_prices(_daily(spark, sf_dir), 10, _newest(spark, sf_dir))
    return rounded(report, "avg_price_eur_mwh")


def _stored(spark, sf_dir):
    """Generation and prices as tables stored by month."""
    tables = []
    for name, df in (("generation", derive.generation(spark, sf_dir)), ("prices", derive.prices(spark, sf_dir))):
        path = scratch(spark, name)
        sinks.write_months(df, path, "date", ["zone"])
        tables.append(landing.scan_table(spark, path))
    return tables


def _recent(spark, sf_dir):
    return reports.recent_daily(*_stored(spark, sf_dir), derive.zones(spark, sf_dir), 10, scale=2)


def scorecard_stored(spark, sf_dir):
    summary = marts.regional_summary(_recent(spark, sf_dir), scale=2)
    return rounded(reports.price_scorecard(summary, 10), "avg_price_eur_mwh")


def neg_hours_stored(spark, sf_dir):
    return reports.negative_hours(marts.regional_summary(_recent(spark, sf_dir), scale=2), 10)


def country_stored(spark, sf_dir):
    return rounded(reports.country_prices(_recent(spark, sf_dir), 10), "avg_price_eur_mwh")


def zone_date_heatmap(spark, sf_dir):
    return rounded(reports.zone_heatmap(_daily(spark, sf_dir)), "avg_price_eur_mwh")


def zone_date_matrix(spark, sf_dir):
    days = [f"2024-01-{i:02}" for i in range(1, 32)]
    report = reports.zone_heatmap(_daily(spark, sf_dir), days)
    return rounded(report, *days).toDF("zone_code", *[f"d{i}" for i in range(1, 32)])


def seasonal_profile(spark, sf_dir):
    report = reports.seasonal_profile(_curve(spark, sf_dir), (12, 1, 2))
    return rounded(report, "avg_price_eur_mwh")


def _drivers(spark, sf_dir):
    return marts.commodity_drivers(staging.quotes(derive.quotes(spark, sf_dir)))


def price_vs_driver(spark, sf_dir):
    daily = marts.daily_prices(staging.country_prices(derive.country_prices(spark, sf_dir)), scale=2)
    return plain(reports.price_against_driver(daily, _drivers(spark, sf_dir), "N", "3-MEDIUM"))


def driver_series(spark, sf_dir):
    return plain(reports.driver_series(_drivers(spark, sf_dir), derive.TICKERS[:3]))


def ticker_corr(spark, sf_dir):
    report = reports.ticker_correlation(_drivers(spark, sf_dir), derive.TICKERS)
    return rounded(report, "correlation")


def intraday_line(spark, sf_dir):
    return reports.demand_line(demand_1h_avg(spark, sf_dir))


# --- quality ----------------------------------------------------------------------------------------

def dq_not_null(spark, sf_dir):
    contract = quality.Contract(not_null=("price_eur_mwh", "region", "total_mw", "zone_code"))
    return quality.check_table(hourly_with_region(spark, sf_dir), contract, "hourly_with_region")


def dq_unique(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), keys)


def dq_accepted_values(spark, sf_dir):
    contract = quality.Contract(accepted_values={
        "event_type": ["click", "view", "purchase"], "user_id": list(range(10))})
    return quality.check_table(table(spark, sf_dir, "events"), contract, "events")


def dq_range(spark, sf_dir):
    contract = quality.Contract(accepted_range={"l_quantity": (1, 49), "l_discount": (0.02, 0.08)})
    return quality.check_table(table(spark, sf_dir, "lineitem"), contract, "lineitem")


def dq_failing_rows(spark, sf_dir):
    contract = quality.Contract(
        not_null=("price_eur_mwh",), accepted_range={"price_eur_mwh": (1000, 90000)})
    rows = quality.failing_rows(derive.country_prices(spark, sf_dir), contract)
    return rows.select("timestamp", "country", "price_eur_mwh", F.concat_ws(",", "failed").alias("failed"))


def dq_contracts(spark, sf_dir):
    zone_contract = quality.Contract(
        not_null=("zone_code", "region"), unique=("zone_code",),
        accepted_values={"region": ["AFRICA", "ASIA"]})
    contracts = {
        "dim_region_mapping": zone_contract,
        **{n: quality.CONTRACTS[n] for n in ("fct_daily_prices", "fct_intraday_demand", "fct_eu_duck_curve")},
    }
    return quality.check_tables({
        "dim_region_mapping": derive.zones(spark, sf_dir),
        "fct_daily_prices": daily_prices(spark, sf_dir),
        "fct_intraday_demand": demand_1h_avg(spark, sf_dir),
        "fct_eu_duck_curve": _curve(spark, sf_dir),
    }, contracts)


# --- sources and sinks: written to the shared folder and read back ------------------------------------

def zones_json(spark, sf_dir):
    path = scratch(spark, "zones-json")
    zones = derive.zones(spark, sf_dir).withColumnRenamed("zone_code", "code")
    # One document with all zones, as the configuration file has it.
    zones.agg(F.collect_list(F.struct(*[F.col(c) for c in zones.columns])).alias("zones")).write.json(path)
    return zone_sources.scan_zone_json(spark, path)


def zones_csv(spark, sf_dir):
    path = scratch(spark, "zones-csv")
    derive.zones(spark, sf_dir).write.option("header", True).csv(path)
    return zone_sources.scan_zone_csv(spark, path)


def zones_by_region(spark, sf_dir):
    return zone_sources.zones_by_region(derive.zones(spark, sf_dir), "Asia")


def only_zones(spark, sf_dir):
    return zone_sources.only_zones(derive.prices(spark, sf_dir), ["3", "7", "28"], "zone")


def demand_envelopes(spark, sf_dir):
    path = scratch(spark, "envelopes")
    records = derive.feed_records(spark, sf_dir)
    records.select(F.array(F.struct(*records.columns)).alias("value")).write.json(path)
    read = landing.scan_demand_envelopes(spark, path)
    return staging.rename_demand(read, F.lit(None).cast("timestamp")).drop("ingested_at")


def quotes_landed(spark, sf_dir):
    path = scratch(spark, "quotes")
    quotes = derive.quotes(spark, sf_dir)
    named = quotes.withColumn("series", F.regexp_replace("ticker", " ", "_"))
    named.drop("ticker").repartition("series").write.partitionBy("series").option("header", True).csv(path)
    names = [t.replace(" ", "_") for t in derive.TICKERS]
    return landing.scan_quotes(spark, path, names, "series={}")


def month_table(spark, sf_dir):
    path = scratch(spark, "wide")
    sinks.write_months(hourly_wide(spark, sf_dir), path, "date", ["zone", "timestamp"])
    return spark.read.parquet(path).drop("month")


def hourly_wide_dynamic(spark, sf_dir):
    """Two months, the second with fuels that the first does not have, built one by one and read as one table."""
    gen, prices = derive.two_months(spark, sf_dir)
    path = scratch(spark, "wide")
    wide.write_wide_months(gen, prices, path, scale=2)
    return wide.scan_wide(spark, path).drop("month")


def table_day(spark, sf_dir):
    path = scratch(spark, "prices")
    sinks.write_months(derive.prices(spark, sf_dir), path, "date", ["zone"])
    return landing.scan_table(spark, path, DAY).drop("month")


def append_rows(spark, sf_dir):
    path = scratch(spark, "prices")
    prices = derive.prices(spark, sf_dir)
    for _ in range(2):
        sinks.append(prices, path, ["date"], ["zone"])
    return spark.read.parquet(path).select(*prices.columns)


def rows_written(spark, sf_dir):
    n = sinks.reload_days(derive.prices(spark, sf_dir), scratch(spark, "prices"), ["zone"])
    return spark.range(1).select(F.lit(n).cast("long").alias("n_rows"))


def load_partial_day(spark, sf_dir):
    """All zones in one chunk, then a day of one zone with the closing hour, loaded by its own dt."""
    landed, stored = scratch(spark, "landing"), scratch(spark, "prices")
    prices = derive.prices(spark, sf_dir).select(
        F.col("timestamp").cast("timestamp"), "price_eur_mwh", "zone", F.col("zone").alias("country"))
    sinks.land(prices.withColumn("dt", F.lit("2024-01-14")), landed)
    loads.load_prices(spark, landed, stored)
    day = prices.where((F.col("zone") == "3") & F.col("timestamp").between(
        F.lit(DAY).cast("timestamp"), F.lit("2024-01-16").cast("timestamp")))
    sinks.land(day.withColumns({"dt": F.lit(DAY), "price_eur_mwh": F.col("price_eur_mwh") + 1}), landed)
    loads.load_prices(spark, landed, stored, DAY)
    loads.load_prices(spark, landed, stored, "2024-01-14")  # an older chunk does not win
    return plain(spark.read.parquet(stored))


def reload_null_days(spark, sf_dir):
    path = scratch(spark, "events")
    rows = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "error", F.to_date("ts")).alias("date"), "event_id", "value")
    sinks.write_months(rows, path, "date", ["event_id"])
    for _ in range(2):
        sinks.replace_keys(rows.withColumn("value", -F.col("value")), path, ["date"], ["event_id"])
    return spark.read.parquet(path).select(*rows.columns)


def pivot_unlisted_fuel(spark, sf_dir):
    kind = F.col("event_type")
    fuel = (F.when(kind == "click", "Solar").when(kind == "view", "Energy storage")
            .when(kind == "error", F.lit(None)).otherwise("Fossil Gas"))
    gen = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"),
        (F.col("user_id") % derive.N_ZONES).cast("string").alias("zone"), fuel.alias("fuel_type"),
        F.col("value").alias("generation_mw"))
    return reshape.pivot_generation(gen, scale=2)


def default_source(spark, sf_dir):
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", columns.default_source(kind).alias("source"))


def ordered_zones(spark, sf_dir):
    return derive.zones(spark, sf_dir).orderBy("region", "zone_code").select("zone_code", "country", "region")


def land_and_scan(spark, sf_dir):
    path = scratch(spark, "landing")
    prices = derive.prices(spark, sf_dir).select(
        F.col("timestamp").cast("timestamp"), "price_eur_mwh", "zone",
        F.lit("EU").alias("country"), F.col("date").cast("string").alias("dt"))
    sinks.land(prices, path)
    read = landing.scan_landing(spark, path, schemas.LANDED_PRICES, "2024-01-1*")
    return plain(read)


def load_prices(spark, sf_dir):
    landed, stored = scratch(spark, "landing"), scratch(spark, "prices")
    prices = derive.prices(spark, sf_dir).select(
        F.col("timestamp").cast("timestamp"), "price_eur_mwh", "zone", F.col("zone").alias("country"))
    sinks.land(prices.withColumn("dt", F.lit("2024-01-31")), landed)
    later = prices.where(F.col("timestamp") >= F.lit(CUT).cast("timestamp"))
    sinks.land(later.withColumns({
        "dt": F.lit("2024-02-01"), "price_eur_mwh": F.col("price_eur_mwh") + 1}), landed)
    loads.load_prices(spark, landed, stored)
    return plain(spark.read.parquet(stored))


def load_generation(spark, sf_dir):
    landed, stored = scratch(spark, "landing"), scratch(spark, "generation")
    gen = derive.generation(spark, sf_dir).select(
        F.col("timestamp").cast("timestamp"), "fuel_type", "generation_mw", "zone",
        F.col("zone").alias("country"), F.lit("2024-12-31").alias("dt"))
    sinks.land(gen, landed)
    for _ in range(2):  # the second load replaces the first
        loads.load_generation(spark, landed, stored)
    return plain(spark.read.parquet(stored))


def _shipments(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("date"), "l_orderkey", "l_linenumber", "l_quantity")


def reload_dates(spark, sf_dir):
    path = scratch(spark, "shipments")
    rows = _shipments(spark, sf_dir)
    sinks.write_months(rows, path, "date", ["l_orderkey"])
    batch = rows.where(F.col("date").between(F.lit("1996-03-10").cast("date"), F.lit("1996-05-02").cast("date")))
    for _ in range(2):
        sinks.replace_keys(batch.withColumn("l_quantity", -F.col("l_quantity")), path, ["date"], ["l_orderkey"])
    return spark.read.parquet(path).select(*rows.columns)


def reload_zone_days(spark, sf_dir):
    path = scratch(spark, "prices")
    prices = derive.prices(spark, sf_dir)
    sinks.reload_days(prices, path, ["zone"])
    batch = prices.where((F.col("zone") == "3") & (F.col("date") >= F.lit(CUT).cast("date")))
    batch = batch.withColumn("price_eur_mwh", F.lit(0.0))
    sinks.replace_keys(batch, path, ["date", "zone"], ["zone"], by_month=False)
    return spark.read.parquet(path).select(*prices.columns)


def upsert_demand(spark, sf_dir):
    path = scratch(spark, "demand")
    rows = derive.demand_stream(spark, sf_dir).drop("source")
    late = F.col("event_ts") >= F.lit(CUT).cast("timestamp_ntz")
    keys, order = ["demand_date", "interval_id"], ["ingested_at", "event_id"]
    for batch in (rows.where(late), rows.where(~late), rows.where(late)):
        sinks.upsert(batch, path, keys, order, ["interval_id"], "demand_date")
    return spark.read.parquet(path).select(*rows.columns)


# --- tables by name ---------------------------------------------------------------------------------

def demand_stamped(spark, sf_dir):
    stamp = F.lit("2024-02-01 12:30:00").cast("timestamp")
    return plain(staging.demand_events(derive.feed_records(spark, sf_dir), stamp))


def lower_names(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return reshape.flatten_names(events.toDF("Event_ID", "EVENT_TYPE", "Value"))


def stored_marts(spark, sf_dir):
    """A mart, built with all that it needs, stored by month and read back."""
    raw = {"entsoe_prices_pl": derive.country_prices(spark, sf_dir)}
    stored = build.store(raw, scratch(spark, "marts"), ["fct_daily_prices"])
    return rounded(plain(stored["fct_daily_prices"].drop("month")), "avg_price_eur_mwh")


def mart_views(spark, sf_dir):
    """Models as views, asked in SQL."""
    raw = {"entsoe_prices_pl": derive.country_prices(spark, sf_dir), "yahoo_prices": derive.quotes(spark, sf_dir)}
    build.register_views(build.build(raw, ["stg_entsoe__prices", "stg_yahoo__prices"]))
    return plain(spark.sql("""select price_date, count(distinct country) as countries, max(close_price) as best_close
        from stg_entsoe__prices join stg_yahoo__prices using (price_date) group by price_date"""))


def raw_registry(spark, sf_dir):
    """Raw tables under one root, found by name and asked in SQL."""
    root = scratch(spark, "raw")
    raw = RawTables(spark, root)
    instant = F.col("timestamp").cast("timestamp")
    for name, df in (("entsoe_eu_prices", derive.prices(spark, sf_dir)),
                     ("entsoe_eu_generation", derive.generation(spark, sf_dir))):
        df.withColumn("timestamp", instant).write.parquet(raw.path(name))
    raw.register_views(["entsoe_eu_prices", "entsoe_eu_generation"])
    return spark.sql("""select p.zone, p.date, count(distinct fuel_type) as fuels, max(price_eur_mwh) as best
        from entsoe_eu_prices p join entsoe_eu_generation g on p.zone = g.zone and p.timestamp = g.timestamp
        group by p.zone, p.date""")


def typed_table(spark, sf_dir):
    """A table created twice with types and a day level, filled by name and found again by a filter on the day."""
    name, path = f"demand_{uuid.uuid4().hex}", scratch(spark, "typed")
    rows = derive.demand_stream(spark, sf_dir).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("event_ts", "ingested_at")})
    for _ in range(2):
        sinks.ensure_table(spark, name, schemas.DEMAND_STREAM, path, ["demand_date"])
    rows.select(*spark.table(name).columns).write.insertInto(name)
    return plain(spark.table(name).where(F.col("demand_date") >= F.lit(CUT).cast("date")))


def bucketed_join(spark, sf_dir):
    """Generation and prices as tables with the same buckets, joined on their keys."""
    names = []
    for kind, df in (("generation", derive.generation(spark, sf_dir)), ("prices", derive.prices(spark, sf_dir))):
        names.append(f"{kind}_{uuid.uuid4().hex}")
        buckets.write_buckets(df, names[-1], scratch(spark, kind), 8)
    gen, prices = (spark.table(n) for n in names)
    return joins.attach_prices(reshape.pivot_generation(gen, scale=2), prices, "full")


def write_checked(spark, sf_dir):
    """A good mart is published, then a broken one refused: what readers see, and the failures of the second."""
    name, root = f"mart_{uuid.uuid4().hex}", scratch(spark, "checked")
    contract = quality.CONTRACTS["fct_daily_prices"]
    mart = marts.daily_prices(staging.country_prices(derive.country_prices(spark, sf_dir)), scale=2)
    good = checked.publish_checked(mart, name, root, contract, cluster=["price_date"])
    broken = mart.withColumn("avg_price_eur_mwh", F.when(F.col("country") != "R", F.col("avg_price_eur_mwh")))
    bad = checked.publish_checked(broken, name, root, contract)
    if not good.published or bad.published:
        raise ValueError(f"published: {good}, {bad}")
    return plain(spark.table(name).withColumn("n_refused", F.lit(bad.n_failures).cast("bigint")))


def day_refreshed(spark, sf_dir):
    """All days landed, then one day of some zones landed again with other values."""
    path = scratch(spark, "landing")
    prices = derive.prices(spark, sf_dir).select(F.col("timestamp").cast("timestamp"), "price_eur_mwh", "zone")
    for i in (14, 15, 16):
        loads.refresh_day(prices, f"2024-01-{i}", path)
    loads.refresh_day(prices.withColumn("price_eur_mwh", F.lit(-1.0)), DAY, path, ["3", "7"])
    return plain(landing.scan_landing(spark, path, schemas.LANDED_PRICES)).drop("country")


def range_refreshed(spark, sf_dir):
    path, rows = scratch(spark, "demand"), derive.demand_batch(spark, sf_dir)
    for first, last in (("2024-01-05", "2024-01-12"), ("2024-01-10", "2024-03-01")):
        loads.refresh_range(rows, first, last, path)
    return plain(spark.read.schema(schemas.DEMAND_BATCH).parquet(path).select("doba", "udtczas", "zap_kse", "znacznik"))


# --- streams ----------------------------------------------------------------------------------------

def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    # With the asterisk the path may be a file as well as a directory of files.
    events = feed.file_feed(spark, f"{sf_dir}/events.parquet*", schema)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _finish(query):
    query.awaitTermination()


def _to_files(spark, df, name):
    path = scratch(spark, name)
    _finish(df.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", f"{path}-progress").trigger(availableNow=True).start(path))
    return spark.read.schema(df.schema).parquet(path)


def stream_dedup(spark, sf_dir):
    first = feed.first_per_interval(derive.readings(_event_stream(spark, sf_dir)))
    return _to_files(spark, first.select("demand_date", "interval_id"), "dedup")


def _buckets(spark, sf_dir, name, *bucket):
    rows = derive.readings(_event_stream(spark, sf_dir))
    path = scratch(spark, name)
    # In update mode every bucket is sent when it changes, the ones still open at the end included.
    def keep(batch, _id):
        sinks.upsert(batch.withColumns({"day": F.to_date("bucket_start"), "version": F.lit(_id)}),
                     path, ["day", "bucket_start"], ["version"], ["bucket_start"], "day")
    _finish(feed.demand_buckets(rows, *bucket, scale=2).writeStream.outputMode("update").foreachBatch(keep)
            .option("checkpointLocation", f"{path}-progress").trigger(availableNow=True).start())
    return plain(spark.read.parquet(path).select("bucket_start", "bucket_end", "n_rows", "avg_mw"))


def stream_window_15m(spark, sf_dir):
    return _buckets(spark, sf_dir, "buckets")


def stream_window_1h(spark, sf_dir):
    return _buckets(spark, sf_dir, "sliding", "60 minutes", "15 minutes")


def stream_upsert(spark, sf_dir):
    path = scratch(spark, "intraday")
    rows = derive.readings(_event_stream(spark, sf_dir))
    _finish(stream_sinks.keep_intraday(
        rows, f"{path}/latest", f"{path}/mart", f"{path}-progress", ["event_id"], scale=2))
    mart = spark.read.parquet(f"{path}/mart")
    return plain(mart.select("demand_date", "interval_id", "event_ts", "demand_mw", "demand_mw_1h_avg"))


def stream_messages(spark, sf_dir):
    """Publish as keyed messages, read them as a stream in small batches, decode and store them."""
    path = scratch(spark, "messages")
    rows = derive.demand_stream(spark, sf_dir).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("event_ts", "ingested_at")})
    feed.publish(rows, f"{path}/topic")
    messages = feed.file_feed(spark, f"{path}/topic", schemas.KEYED_MESSAGE, "json", files_per_batch=1)
    decoded = feed.to_rows(feed.decode_json(messages))
    _finish(stream_sinks.append_raw(decoded, f"{path}/raw", f"{path}/progress"))
    raw = spark.read.schema(schemas.DEMAND_STREAM).parquet(f"{path}/raw")
    return plain(raw.select(*schemas.DEMAND_STREAM.fieldNames()))


def stream_rejects(spark, sf_dir):
    """Messages of which some are broken, a file a batch: rows of the good ones, and the others with the reason."""
    path = scratch(spark, "messages")
    derive.messages(spark, sf_dir).repartition(3).write.json(f"{path}/topic")
    feed_ = feed.file_feed(spark, f"{path}/topic", schemas.KEYED_MESSAGE, "json", files_per_batch=1)
    for _ in range(2):  # the second run finds nothing new
        _finish(intake.keep_messages(
            feed_, f"{path}/rows", f"{path}/rejects", f"{path}/progress", Ledger(f"{path}/batches")))
    rows = spark.read.schema(schemas.DEMAND_STREAM).parquet(f"{path}/rows").select(*schemas.DEMAND_STREAM.fieldNames())
    rejects = spark.read.schema("raw string, reason string").parquet(f"{path}/rejects").select("raw", "reason")
    return plain(rows.unionByName(rejects, allowMissingColumns=True))


def _arrivals(spark, sf_dir, path, numbers):
    """Files of arriving rows, one per number and in that order."""
    arriving = derive.arrivals(spark, sf_dir)
    for n in numbers:
        arriving.where(F.col("arrival") == n).drop("arrival").coalesce(1).write.mode("append").parquet(path)
    return feed.file_feed(spark, path, arriving.drop("arrival").schema, files_per_batch=1)


def stream_resume(spark, sf_dir):
    """Stopped after three batches, one of them sent again with other values, then gone on with."""
    path = scratch(spark, "intraday")
    places = f"{path}/latest", f"{path}/mart"
    ledger = Ledger(f"{path}/batches")
    for numbers in (range(3), range(3, derive.N_ARRIVALS)):
        rows = _arrivals(spark, sf_dir, f"{path}/in", numbers)
        _finish(stream_sinks.keep_intraday(rows, *places, f"{path}/progress", ["event_id"], scale=2, ledger=ledger))
        again = derive.arrivals(spark, sf_dir).where(F.col("arrival") == 1).drop("arrival").withColumns({
            "demand_mw": -F.col("demand_mw"), "event_id": F.col("event_id") + 10 ** 12})
        stream_sinks.intraday_handler(*places, ["event_id"], 2, ledger)(again, 1)
    mart = spark.read.parquet(places[1])
    return plain(mart.select("demand_date", "interval_id", "event_ts", "demand_mw", "demand_mw_1h_avg"))


def stream_late(spark, sf_dir):
    """Every row, whether it came behind the watermark, and how many a stateful operator dropped over the same files."""
    path = scratch(spark, "late")
    rows = _arrivals(spark, sf_dir, f"{path}/in", range(derive.N_ARRIVALS))
    _finish(intake.keep_with_late(rows, f"{path}/rows", f"{path}/progress", Ledger(f"{path}/batches"), "2 days"))
    first = feed.first_per_interval(rows, ["event_id"], "2 days", spread=1)
    query = (first.writeStream.format("noop").option("checkpointLocation", f"{path}/first")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    kept = spark.read.parquet(f"{path}/rows").select("event_id", F.col("late").cast("boolean").alias("late"))
    return kept.withColumn("n_dropped", F.lit(intake.dropped_by_watermark(query)).cast("bigint"))


QUERIES = {f.__name__: f for f in (
    hourly_wide, hourly_wide_full, hourly_wide_day, pivot_generation, pivot_bulk, unpivot_generation,
    generation_direction, energy_mix, stg_prices, stg_demand, stg_quotes, demand_events,
    demand_events_local, prices_to_utc, hourly_resample, price_7d_range, price_7d_rows, demand_dedup,
    demand_1h_avg, hourly_with_region, daily_by_region, regional_summary, duck_curve, daily_prices,
    commodity_returns, zone_spread, incremental_filter, merge_demand, pending_chunks, landed_chunks,
    complete_pairs, missing_days, batch_dates, union_tickers, scorecard_10d, region_spread, neg_hours_10d,
    country_10d, scorecard_stored, neg_hours_stored, country_stored, zone_date_heatmap, zone_date_matrix, seasonal_profile, price_vs_driver, driver_series,
    ticker_corr, intraday_line, dq_not_null, dq_unique, dq_accepted_values, dq_range, dq_failing_rows,
    dq_contracts, zones_json, zones_csv, zones_by_region, only_zones, demand_envelopes, quotes_landed,
    month_table, land_and_scan, load_prices, load_generation, reload_dates, reload_zone_days,
    table_day, append_rows, rows_written, load_partial_day, reload_null_days, pivot_unlisted_fuel,
    default_source, ordered_zones, upsert_demand, stream_dedup, stream_window_15m, stream_window_1h, stream_upsert, stream_messages,
    stream_rejects, stream_resume, stream_late, hourly_wide_dynamic, demand_stamped, lower_names, stored_marts,
    mart_views, raw_registry, typed_table, day_refreshed, range_refreshed, prices_to_utc_dst, demand_intervals_dst,
    bucketed_join, write_checked,
)}
