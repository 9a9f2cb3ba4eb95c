"""Landed files: `root/dataset/country=Z/dt=D/*.parquet`, and table scans."""

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gridlake.constants import TICKERS
from gridlake.operators.reshape import flatten_names, union_series
from gridlake.schemas import DEMAND_ENVELOPE, QUOTES


def glob_to_like(pattern: str) -> str:
    """A `*`/`?` pattern as a SQL LIKE pattern."""
    escaped = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return escaped.replace("*", "%").replace("?", "_")


def scan_landing(spark: SparkSession, root: str, schema: T.StructType, dt: str | date | None = None,
                 country: str | None = None) -> DataFrame:
    """Landed rows of one day (`2025-01-31`), of a pattern (`2025-*`) or of all days.

    The filters are on directory levels, so other directories are not read.
    """
    df = spark.read.schema(schema).parquet(root)
    for column, wanted in (("dt", dt), ("country", country)):
        if wanted is not None:
            df = df.where(F.col(column).like(glob_to_like(str(wanted))))
    return df


def scan_or_none(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The parquet data at `path`, or None when there is no such path or not a single row.

    Any other failure is raised: an unreadable table must not pass for an absent one.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        df = reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return None if df.isEmpty() else df


def scan_table(spark: SparkSession, path: str, day: str | date | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """A table, or one day of it; of a table stored by month the day's month is read."""
    df = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    if day is None:
        return df
    wanted = F.lit(day).cast("date")
    one = df.where(F.col("date") == wanted)
    return one.where(F.col("month") == F.trunc(wanted, "month")) if "month" in df.columns else one


def scan_merged(spark: SparkSession, path: str) -> DataFrame:
    """A table whose partitions have different columns: the columns of all of them, NULL where a partition has none."""
    return spark.read.option("mergeSchema", True).parquet(path)


def scan_demand_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Records of landed `{"value": [...]}` answers, one JSON document per line; empty ones give none."""
    return spark.read.schema(DEMAND_ENVELOPE).json(path).select(F.inline("value"))


def scan_quotes(spark: SparkSession, root: str, tickers=tuple(TICKERS), directory: str = "{}") -> DataFrame:
    """Quotes landed as `root/<ticker>/*.csv`, one directory per series; absent series are skipped.

    `directory` names the directory of a ticker, such as `series={}`.
    """
    columns = [f for f in QUOTES.fields if f.name != "ticker"]
    frames = {}
    for ticker in tickers:
        try:
            raw = spark.read.option("header", True).csv(f"{root}/{directory.format(ticker)}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        named = flatten_names(raw)
        frames[ticker] = named.select(*[F.col(f.name).cast(f.dataType) for f in columns])
    return union_series(frames).select(*QUOTES.fieldNames())
