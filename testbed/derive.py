"""Power-market look-alikes derived from the test tables.

The test tables hold no energy data, so every raw table of the library is derived from one of them with
plain column expressions.  `oracle.py` states the same derivations in SQL.

* generation: every event, summed per hour; the zone comes from the user, the fuel from `k`
* prices: highest event value of the hour less 40, over every event; users map to zones in another way, so that
  hours with only a price and hours with only generation both occur; zones 25 to 29 are missing in the dimension
* demand: the events as quarter-hour readings, with many copies per interval
* quotes: orders as open, high, low, close and volume per day and priority
* country prices: line items by ship date and return flag; untaxed ones have no price
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridlake.constants import DEMAND_SOURCE, FUEL_TYPES
from gridlake.functions import interval_id, total
from gridlake.streaming.feed import to_messages

N_ZONES = 30
TICKERS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


# Declared, so that opening a table does not start a job to look at its files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _fuel(number):
    listed = ", ".join(f"'{f}'" for f in FUEL_TYPES)
    return F.element_at(F.expr(f"array({listed})"), number % len(FUEL_TYPES) + 1)


def _hour(ts):
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def _zone(number):
    return (number % N_ZONES).cast("string")


def generation(spark, sf_dir) -> DataFrame:
    events = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    return events.select(
        F.to_date("ts").alias("date"), _hour("ts").alias("timestamp"), _zone(F.col("user_id")).alias("zone"),
        _fuel(k).alias("fuel_type"), F.col("value").alias("generation_mw"))


def bulk_generation(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("date"), F.col("l_shipdate").alias("timestamp"),
        _zone(F.col("l_suppkey")).alias("zone"), _fuel(F.col("l_partkey").cast("int")).alias("fuel_type"),
        F.col("l_quantity").alias("generation_mw"))


def prices(spark, sf_dir) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.groupBy(
        F.to_date("ts").alias("date"), _hour("ts").alias("timestamp"),
        _zone(F.floor(F.col("user_id") / 5)).alias("zone"),
    ).agg((F.max("value") - 40).alias("price_eur_mwh"))


def zones(spark, sf_dir) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").cast("string").alias("zone_code"), F.col("n_name").alias("country"),
        F.col("r_name").alias("region"), F.lit("UTC").alias("timezone"),
        F.lower("r_name").alias("primary_fuel"), F.concat_ws(" - ", "r_name", "n_name").alias("zone_name"))


def demand_stream(spark, sf_dir) -> DataFrame:
    return readings(table(spark, sf_dir, "events"))


def readings(events: DataFrame) -> DataFrame:
    """Batch or streaming events as demand rows; `event_id` stays to break ties."""
    return events.select(
        F.col("ts").alias("event_ts"), F.to_date("ts").alias("demand_date"),
        interval_id(F.col("ts")).alias("interval_id"), F.col("value").alias("demand_mw"),
        F.lit(DEMAND_SOURCE).alias("source"), F.col("ts").alias("ingested_at"), "event_id")


def demand_batch(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").cast("string").alias("doba"), F.col("ts").cast("string").alias("udtczas"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("zap_kse"),
        interval_id(F.col("ts")).alias("znacznik"), F.col("ts").alias("ingested_at"))


def feed_records(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").cast("string").alias("business_date"), F.col("ts").cast("string").alias("dtime"),
        F.col("value").alias("demand"))


def quotes(spark, sf_dir) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").groupBy(
        F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("ticker"),
    ).agg(
        F.min_by(price, "o_orderkey").alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
        F.max_by(price, "o_orderkey").alias("close"), total(price, 2).alias("volume"))


def country_prices(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("timestamp"),
        F.when(F.col("l_tax") != 0, F.col("l_extendedprice")).alias("price_eur_mwh"),
        F.col("l_returnflag").alias("country"), F.col("l_shipdate").alias("ingested_at"))


N_ARRIVALS = 7


def arrivals(spark, sf_dir) -> DataFrame:
    """Demand rows with `arrival`: six days of a month arrive together, some rows one or two times later."""
    rows = readings(table(spark, sf_dir, "events"))
    block = F.least(F.floor((F.dayofmonth("event_ts") - 1) / 6), F.lit(4))
    late = F.when(F.col("event_id") % 10 == 0, 2).when(F.col("event_id") % 10 == 5, 1).otherwise(0)
    stamps = {c: F.col(c).cast("timestamp") for c in ("event_ts", "ingested_at")}
    return rows.withColumns({"arrival": (block + late).cast("int"), **stamps})


def messages(spark, sf_dir) -> DataFrame:
    """Demand messages; six of twenty cannot become rows."""
    rows = demand_stream(spark, sf_dir).withColumns({c: F.col(c).cast("timestamp") for c in ("event_ts", "ingested_at")})
    number = F.col("event_id").cast("string")
    broken = {
        1: F.concat(F.lit('{"event_ts": 1, "demand_date": "'), number),
        2: F.concat(F.lit('{"event_ts": 5, "interval_id": '), number, F.lit("}")),
        3: F.concat(F.lit('{"event_ts": 5, "demand_date": "2024-01-01", "interval_id": 97, "demand_mw": '), number, F.lit(".5}")),
        4: F.lit(""),
        5: F.concat(F.lit("no json "), number),
        6: F.concat(F.lit('{"event_ts": "x", "demand_date": "2024-01-01", "interval_id": 1, "demand_mw": '), number, F.lit("}")),
    }
    value = F.col("value")
    for kind, text in broken.items():
        value = F.when(F.col("event_id") % 20 == kind, text).otherwise(value)
    return to_messages(rows, "event_id").select("key", value.alias("value"))


def two_months(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Generation and prices of January and, for odd users, February, which alone has sun, wind on land and storage."""
    def moved(df, odd):
        later = {"date": F.date_add("date", 31), "timestamp": F.col("timestamp") + F.expr("INTERVAL 31 DAYS")}
        return df.withColumns({c: F.when(odd, e).otherwise(F.col(c)) for c, e in later.items()})

    odd = F.col("zone").cast("int") % 2 == 1
    fuel = F.col("fuel_type")
    gen = moved(generation(spark, sf_dir), odd).where(odd | ~fuel.isin("Solar", "Wind Onshore"))
    gen = gen.withColumn("fuel_type", F.when(odd & (fuel == "Waste"), "Energy storage").otherwise(fuel))
    return gen, moved(prices(spark, sf_dir), odd)


def _on_change_days(utc, number):
    """6 January becomes the day of a clock change: in spring for even numbers, in autumn for odd ones."""
    return utc + F.when(number % 2 == 0, F.expr("INTERVAL 85 DAYS")).otherwise(F.expr("INTERVAL 295 DAYS"))


def _warsaw(utc):
    """Local time of 2024, by the two changes of that year."""
    summer = (utc >= F.expr("TIMESTAMP_NTZ '2024-03-31 01:00:00'")) & (utc < F.expr("TIMESTAMP_NTZ '2024-10-27 01:00:00'"))
    return utc + F.when(summer, F.expr("INTERVAL 2 HOURS")).otherwise(F.expr("INTERVAL 1 HOUR"))


def local_prices(spark, sf_dir) -> DataFrame:
    """Prices at local stamps around both clock changes; `place` is the order of a zone's rows in the feed."""
    utc = _on_change_days(F.col("timestamp"), F.col("zone").cast("int"))
    return prices(spark, sf_dir).select(
        _warsaw(utc).alias("timestamp"), "zone", "price_eur_mwh", F.unix_micros(utc.cast("timestamp")).alias("place"))


def local_records(spark, sf_dir) -> DataFrame:
    """Feed records at local stamps around both clock changes, with their place in the feed."""
    utc = _on_change_days(F.col("ts"), F.col("user_id"))
    return table(spark, sf_dir, "events").select(
        _warsaw(utc).cast("string").alias("dtime"), F.col("value").alias("demand"),
        F.unix_micros(utc.cast("timestamp")).alias("place"), "event_id")
