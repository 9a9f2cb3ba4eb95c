"""The zone dimension, from the fixed list, a CSV seed or a nested JSON file."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridlake.constants import ZONES
from gridlake.schemas import ZONE_CONFIG, ZONE_DIM


def zone_dimension(spark: SparkSession) -> DataFrame:
    """The known bidding zones."""
    return spark.createDataFrame(ZONES, ZONE_DIM)


def scan_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ZONE_DIM).option("header", True).csv(path)


def scan_zone_json(spark: SparkSession, path: str) -> DataFrame:
    """Zones of `{"zones": [{"code": ...}, ...]}`; zones without a name get NULL."""
    nested = spark.read.schema(ZONE_CONFIG).option("multiLine", True).json(path)
    return nested.select(F.inline("zones")).withColumnRenamed("code", "zone_code")


def zones_by_region(zones: DataFrame, region: str | None = None) -> DataFrame:
    """Zones of a region, upper and lower case alike; all zones without one."""
    return zones if region is None else zones.where(F.lower("region") == region.lower())


def only_zones(df: DataFrame, codes: list[str] | None = None, column: str = "zone_code") -> DataFrame:
    """Restrict to some zones; no list means all."""
    return df.where(F.col(column).isin(list(codes))) if codes else df
