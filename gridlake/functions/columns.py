"""Scalar column helpers, all built from JVM-side expressions."""

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from gridlake.constants import DEMAND_SOURCE, INTERVAL_MINUTES, INTERVALS_PER_DAY
from gridlake.schemas import NUMERIC


def normalize_name(name):
    """Lower-case, with every run of other characters than a-z and 0-9 turned into one underscore.

    Works on a Python string (column names) and on a Column (values).
    """
    if isinstance(name, Column):
        return F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_")
    return re.sub("[^a-z0-9]+", "_", name.lower())


def null_safe_sum(columns: list[str]) -> Column:
    """Row-wise sum with NULL counted as zero; 0.0 for no columns."""
    return F.expr(" + ".join(f"coalesce(`{c}`, 0D)" for c in columns) or "0D")


def guarded_ratio(part: Column, whole: Column) -> Column:
    """`part / whole`, NULL unless `whole` is positive."""
    return F.when(whole > 0, part / whole)


def nan_to_null(column: Column) -> Column:
    return F.nanvl(column, F.lit(None).cast("double"))


def to_numeric(column: Column) -> Column:
    return column.cast(NUMERIC)


def to_int64(column: Column) -> Column:
    """Nearest integer, halves away from zero (a bare cast would cut the fraction off)."""
    return F.round(column).cast("bigint")


def date_of(column: Column) -> Column:
    return F.to_date(column)


def month_of(column: Column) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(column, "month")


def hour_utc(column: Column) -> Column:
    """Hour 0-23 of a timestamp; the session runs in UTC."""
    return F.hour(column).cast("bigint")


def interval_id(column: Column) -> Column:
    """Quarter-hour number of an end-of-interval stamp: 00:15 is 1, 23:45 is 95, 00:00 is 96."""
    quarter = F.floor((F.hour(column) * 60 + F.minute(column)) / F.lit(INTERVAL_MINUTES))
    return F.when(quarter == 0, F.lit(INTERVALS_PER_DAY)).otherwise(quarter).cast("bigint")


def interval_day(column: Column) -> Column:
    """Day an end-of-interval stamp belongs to, so that interval 96 closes its own day."""
    return F.to_date(column - F.expr(f"INTERVAL {INTERVAL_MINUTES} MINUTES"))


def local_to_utc(column: Column, zone: Column | str) -> Column:
    return F.to_utc_timestamp(column, zone)


def millis_to_timestamp(column: Column) -> Column:
    return F.timestamp_millis(column)


def timestamp_to_millis(column: Column) -> Column:
    return F.unix_millis(column)


def message_key(day: Column, interval: Column) -> Column:
    return F.concat_ws("-", day.cast("string"), interval.cast("string"))


def default_source(column: Column) -> Column:
    return F.coalesce(column, F.lit(DEMAND_SOURCE))


def period_return(value: Column, earlier: Column) -> Column:
    """`value / earlier - 1`; NULL where there is no earlier value or it is zero."""
    return F.try_divide(value, earlier) - 1


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a DATE, TIMESTAMP or TIMESTAMP_NTZ column of `df`."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(name))
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("bigint") * F.lit(86_400_000_000)
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col(name))
