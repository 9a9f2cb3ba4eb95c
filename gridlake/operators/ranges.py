"""Ranges of days, stated so that tables stored by month read the months in question only.

A table stored by month has the first day of the month as its directory level `month`.
"""

from pyspark.sql import Column, DataFrame, functions as F


def between_dates(df: DataFrame, first, last, column: str = "date") -> DataFrame:
    """Rows of the days `first` to `last`, both included; either may be a date, its text or a Column without rows.

    Tables stored by month have a `month` column; it is restricted as well, so that only the
    directories in question are listed and read.
    """
    first, last = (F.lit(d).cast("date") for d in (first, last))
    picked = df.where(F.col(column).between(first, last))
    if "month" in df.columns and column != "month":
        picked = picked.where(F.col("month").between(F.trunc(first, "month"), F.trunc(last, "month")))
    return picked


def newest_day(df: DataFrame, column: str = "date") -> Column:
    """The last day of a table, as a scalar subquery; of a table stored by month only the last month is read."""
    if "month" in df.columns:
        df = df.where(F.col("month") == df.agg(F.max("month")).scalar())
    return df.agg(F.max(column)).scalar()


def trailing_range(days: int, end: Column) -> tuple[Column, Column]:
    """First and last of the `days` days that end with `end`."""
    return F.date_sub(end, days - 1), end


def trailing_days(df: DataFrame, days: int, column: str = "date", as_of: Column | None = None) -> DataFrame:
    """The last `days` days of a table, or those up to `as_of`."""
    return between_dates(df, *trailing_range(days, newest_day(df, column) if as_of is None else as_of), column)
