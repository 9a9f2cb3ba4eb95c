"""Raw tables by name."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from gridlake import schemas
from gridlake.sources.landing import scan_merged

# The raw tables and what they hold.
RAW_SCHEMAS: dict[str, T.StructType | None] = {
    "pse_demand": schemas.DEMAND_BATCH,
    "entsoe_prices_pl": schemas.COUNTRY_PRICES,
    "yahoo_prices": schemas.QUOTES,
    "pse_demand_stream": schemas.DEMAND_STREAM,
    "entsoe_eu_prices": schemas.ZONE_PRICES,
    "entsoe_eu_generation": schemas.ZONE_GENERATION,
    "entsoe_eu_hourly_wide": None,  # one column per fuel, taken from the files
}


@dataclass(frozen=True)
class RawTables:
    """Raw tables stored as `root/<name>`."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        if name not in RAW_SCHEMAS:
            raise KeyError(f"unknown raw table {name!r}; known are {sorted(RAW_SCHEMAS)}")
        return f"{self.root.rstrip('/')}/{name}"

    def __getitem__(self, name: str) -> DataFrame:
        schema = RAW_SCHEMAS.get(name)
        path = self.path(name)
        return scan_merged(self.spark, path) if schema is None else self.spark.read.schema(schema).parquet(path)

    def register_views(self, names=None) -> None:
        """Make the tables available to SQL under their names."""
        for name in names or RAW_SCHEMAS:
            self[name].createOrReplaceTempView(name)
