"""Joins and set differences.

No broadcast hints: Spark broadcasts a side when its size is below
`spark.sql.autoBroadcastJoinThreshold`, measured at run time by adaptive execution, and otherwise runs
a sort-merge join whose hot keys it splits.
"""

from pyspark.sql import Column, DataFrame, functions as F

HOUR_KEYS = ["date", "timestamp", "zone"]


def attach_prices(wide: DataFrame, prices: DataFrame, how: str = "left") -> DataFrame:
    """Add the price of the zone-hour.

    `left` keeps the hours of `wide` only, `full` also keeps hours that have nothing but a price.
    """
    if how not in ("left", "full"):
        raise ValueError(f"how is 'left' or 'full', not {how!r}")
    return wide.join(prices.select(*HOUR_KEYS, "price_eur_mwh"), HOUR_KEYS, how)


def attach_region(df: DataFrame, zones: DataFrame, key: str = "zone_code") -> DataFrame:
    """Add the zone attributes; zones missing in the dimension keep NULLs."""
    return df.join(zones, key, "left")


def zone_spread(prices: DataFrame, reference: str, keys=("date", "timestamp")) -> DataFrame:
    """Price difference of every zone to the reference zone in the same hour."""
    anchor = prices.where(F.col("zone") == reference).select(
        *keys, F.col("price_eur_mwh").alias("reference_price_eur_mwh"))
    return prices.join(anchor, list(keys), "left").withColumn(
        "price_spread_eur_mwh", F.col("price_eur_mwh") - F.col("reference_price_eur_mwh"))


def _by_keys(df: DataFrame, other: DataFrame, keys, how: str) -> DataFrame:
    named = other.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct()
    return df.join(named, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys], how)


def without_keys(df: DataFrame, done: DataFrame, keys) -> DataFrame:
    """Rows of `df` whose key is not in `done`.  NULL is a key like any other."""
    return _by_keys(df, done, keys, "left_anti")


def with_keys(df: DataFrame, wanted: DataFrame, keys) -> DataFrame:
    """Rows of `df` whose key is in `wanted`.  NULL is a key like any other."""
    return _by_keys(df, wanted, keys, "left_semi")


def newer_than_target(df: DataFrame, target: DataFrame, mark: str,
                      floor: Column | None = None) -> DataFrame:
    """Rows whose `mark` lies above the highest one in `target` (all rows if `target` is empty)."""
    kind = df.schema[mark].dataType
    start = F.lit("1970-01-01").cast(kind) if floor is None else floor
    reached = target.agg(F.coalesce(F.max(mark), start)).scalar()
    return df.where(F.col(mark) > reached)
