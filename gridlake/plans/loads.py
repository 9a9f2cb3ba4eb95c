"""Loading landed files into raw tables, and working out what is still missing."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridlake import schemas
from gridlake.operators.joins import with_keys, without_keys
from gridlake.operators.staging import zone_generation, zone_prices
from gridlake.sinks.tables import land, reload_days, replace_keys
from gridlake.sources.landing import scan_landing, scan_or_none


def _load(spark, landed, table, schema, shape, keys, cluster, dt, replace) -> int:
    if replace not in ("hours", "zone_days", "days"):
        raise ValueError(f"replace is 'hours', 'zone_days' or 'days', not {replace!r}")
    if scan_or_none(spark, landed, schema) is None:
        return 0
    rows = scan_landing(spark, landed, schema, dt)
    if dt is not None:
        # An hour of the chunk that a newer one holds as well is taken from the newer one.
        span = rows.agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
                        F.min("dt").alias("dt")).first()
        newer = scan_landing(spark, landed, schema).where(
            (F.col("dt") >= F.lit(span.dt)) & F.col("timestamp").between(F.lit(span.first), F.lit(span.last)))
        hours = [k for k in keys if k != "date"]
        rows = rows.where(F.col("timestamp").isNull()).unionByName(with_keys(newer, rows, hours))
    rows = shape(rows)
    if replace == "days":
        return reload_days(rows, table, cluster)
    return replace_keys(rows, table, keys if replace == "hours" else ["date", "zone"], cluster, by_month=False)


def load_prices(spark: SparkSession, landed: str, table: str, dt: str | date | None = None,
                replace: str = "hours") -> int:
    """Load landed zone prices of one `dt`, of a pattern or of all; of an hour in several chunks the newest counts.

    The hours of the batch replace stored ones, everything else stays.  `replace="zone_days"` replaces the
    days of its zones as a whole, `"days"` the days of all zones.  Returns the rows written to the partitions
    that were touched, 0 when there is nothing to load.
    """
    return _load(spark, landed, table, schemas.LANDED_PRICES, zone_prices, ["date", "zone", "timestamp"],
                 ["zone"], dt, replace)


def load_generation(spark: SparkSession, landed: str, table: str, dt: str | date | None = None,
                    replace: str = "hours") -> int:
    """Load landed zone generation by hour and fuel, as :func:`load_prices`."""
    return _load(spark, landed, table, schemas.LANDED_GENERATION, zone_generation,
                 ["date", "zone", "timestamp", "fuel_type"], ["zone", "fuel_type"], dt, replace)


def chunks(zones: DataFrame, first_year: int, last_year: int, column: str = "zone_code") -> DataFrame:
    """Every (zone, year) of the range."""
    years = F.explode(F.sequence(F.lit(first_year), F.lit(last_year)))
    return zones.select(F.col(column).alias("zone"), years.alias("year"))


def pending_chunks(zones: DataFrame, first_year: int, last_year: int, done: DataFrame,
                   column: str = "zone_code") -> DataFrame:
    """Chunks of the range that are not done."""
    return without_keys(chunks(zones, first_year, last_year, column), done, ["zone", "year"])


def landed_chunks(prices: DataFrame, generation: DataFrame | None = None) -> DataFrame:
    """(zone, year) pairs that every required dataset holds; generation is optional."""
    def keys(df):
        return df.select("zone", F.year("timestamp").alias("year")).distinct()

    held = keys(prices)
    return held if generation is None else held.join(keys(generation), ["zone", "year"], "left_semi")


def complete_pairs(prices: DataFrame, generation: DataFrame, keys=("zone", "dt")) -> tuple[DataFrame, DataFrame]:
    """Rows of the chunks that both datasets hold, so that they are landed together or not at all."""
    return with_keys(prices, generation, keys), with_keys(generation, prices, keys)


def land_pair(prices: DataFrame, generation: DataFrame, root: str) -> dict[str, int]:
    """Land prices and generation of the chunks that are complete; rows written by dataset."""
    both = dict(zip(("eu_prices", "eu_generation"), complete_pairs(prices, generation)))
    return {name: land(df.withColumn("country", F.col("zone")), f"{root}/{name}") for name, df in both.items()}


def refresh_day(df: DataFrame, day: date | str, root: str, zones: list[str] | None = None) -> int:
    """Land one day of all zones, or of some; zones without rows are left alone."""
    rows = df.where(F.to_date("timestamp") == F.lit(day).cast("date"))
    if zones:
        rows = rows.where(F.col("zone").isin(list(zones)))
    return land(rows.withColumns({"country": F.col("zone"), "dt": F.lit(str(day))}), root)


def days(spark: SparkSession, first: date | str, last: date | str) -> DataFrame:
    """The days `first` to `last`, both included."""
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date"))


def missing_days(landed: DataFrame, first: date | str, last: date | str, column: str = "date") -> DataFrame:
    """Days of the range for which nothing is landed."""
    held = landed.select(F.col(column).cast("date").alias("date"))
    return without_keys(days(landed.sparkSession, first, last), held, ["date"])


def refresh_range(df: DataFrame, first: date | str, last: date | str, path: str) -> int:
    """Land every day of the range that has rows, in one job; empty days are skipped."""
    rows = df.where(F.col("doba").cast("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return land(rows.withColumn("dt", F.col("doba")), path, ["dt"])
