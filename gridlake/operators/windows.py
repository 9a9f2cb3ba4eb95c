"""Windowed means, lags and keep-latest.

Prices and quotes have few, long series: a plain `partitionBy(zone)` leaves most of a cluster idle
and puts a whole series into one task.  The frames used here look back a bounded distance, so a series
is cut into slices, each slice gets a copy of the rows just before it, and the copies are dropped after
the window.  The result is the same row for row.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridlake.constants import DEMAND_WINDOW_ROWS, PRICE_WINDOW_HOURS, PRICE_WINDOW_ROWS, RETURN_STEPS
from gridlake.functions import epoch_micros, mean, period_return

HOUR = 3_600_000_000
DAY = 24 * HOUR


def _with_overlap(df: DataFrame, place: Column, width: int, back: int, *extra: Column) -> DataFrame:
    """Assign rows to slices of `width` along `place`; the last `back` of a slice go to the next too.

    Adds `_home` (own slice) and `_slice` (slice this copy works for), besides `extra`.
    """
    if width < back:
        raise ValueError(f"a slice of {width} is shorter than the frame of {back}")
    offset = F.pmod(place, F.lit(width))
    home = ((place - offset) / width).cast("bigint")
    targets = F.when(offset >= width - back, F.array(home, home + 1)).otherwise(F.array(home))
    return df.select("*", *extra, home.alias("_home"), F.explode(targets).alias("_slice"))


def _drop_overlap(df: DataFrame, *extra: str) -> DataFrame:
    return df.where(F.col("_slice") == F.col("_home")).drop("_slice", "_home", *extra)


def trailing_mean(df: DataFrame, value: str = "price_eur_mwh", out: str = "price_7d_mean",
                  hours: int = PRICE_WINDOW_HOURS, keys=("zone",), ts: str = "timestamp",
                  scale: int | None = None, slice_hours: int | None = None) -> DataFrame:
    """Mean over the RANGE from `hours` before a row up to it, both ends included.

    Slices are four frames long unless `slice_hours` says otherwise.  Rows without a timestamp are
    averaged among themselves, as a RANGE frame does.
    """
    span = hours * HOUR
    width = (slice_hours or 4 * hours) * HOUR
    at = epoch_micros(df, ts)
    # Rows without a timestamp all sit in a slice of their own.
    spread = _with_overlap(df, F.coalesce(at, F.lit(-(2 ** 60))), width, span, at.alias("_at"))
    frame = Window.partitionBy(*keys, "_slice").orderBy("_at").rangeBetween(-span, Window.currentRow)
    return _drop_overlap(spread.withColumn(out, mean(F.col(value), scale, frame)), "_at")


def numbered(df: DataFrame, keys, order, ts: str, slice_micros: int, out: str = "_pos") -> DataFrame:
    """Number the rows of every series from 0 without putting a series into one task.

    Rows are dealt once by series and time slice.  Both the numbers inside a slice and the count of its rows are taken
    from that one exchange; the counts, one short row a slice, are accumulated and joined back.  `order` has to start
    with `ts` and to be unique within a series.
    """
    at = epoch_micros(df, ts)
    part = ((at - F.pmod(at, F.lit(slice_micros))) / F.lit(slice_micros)).cast("bigint")
    groups = [*keys, "_part"]
    dealt = df.withColumn("_part", part).repartition(*[F.col(g) for g in groups])
    # Spark computes an exchange once for both branches only if they read the same columns of it.  The counts need
    # none but the groups, so the largest hash of a whole row keeps the others in; it is never NULL.  (Where a caller
    # drops columns afterwards, or some have a type without hash, the input is read twice, with the same result.)
    hashed = [f"`{c}`" for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    counts = dealt.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_rows"), F.max(F.xxhash64(*hashed)).alias("_whole")).where("_whole is not null")
    before = (Window.partitionBy(*[f"_of_{k}" for k in keys]).orderBy("_of__part")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = (
        counts.select("_rows", *[F.col(g).alias(f"_of_{g}") for g in groups])
        .select("*", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(*groups).orderBy(*order)
    ranked = dealt.withColumn("_rank", F.row_number().over(inside) - 1)
    # NULL keys form a series too, so the join has to treat them as equal.
    same = [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in groups]
    return (ranked.join(starts, same, "inner")
            .select(*df.columns, (F.col("_start") + F.col("_rank")).alias(out)))


def _row_blocks(df, keys, order, ts, back, slice_days, block_rows):
    """Cut every series into blocks of rows, each led by copies of the `back` rows before it."""
    placed = numbered(df, keys, order, ts, slice_days * DAY)
    spread = _with_overlap(placed, F.col("_pos"), block_rows or max(8 * back, 1024), back)
    return spread, Window.partitionBy(*keys, "_slice").orderBy("_pos")


def trailing_rows_mean(df: DataFrame, value: str = "price_eur_mwh", out: str = "price_7d_mean",
                       rows: int = PRICE_WINDOW_ROWS, keys=("zone",), ts: str = "timestamp",
                       tie_break=(), scale: int | None = None, slice_days: int = 28,
                       block_rows: int | None = None) -> DataFrame:
    """Mean over the last `rows` rows of the series, the current one included, gaps ignored."""
    blocks, ordered = _row_blocks(df, keys, [ts, *tie_break], ts, rows - 1, slice_days, block_rows)
    frame = ordered.rowsBetween(-(rows - 1), Window.currentRow)
    return _drop_overlap(blocks.withColumn(out, mean(F.col(value), scale, frame)), "_pos")


def period_returns(df: DataFrame, value: str = "close_price", steps=RETURN_STEPS, keys=("ticker",),
                   ts: str = "price_date", tie_break=(), slice_days: int = 366,
                   block_rows: int | None = None) -> DataFrame:
    """Add `return_<n>d`, the change against the quote `n` rows earlier, for every step."""
    blocks, ordered = _row_blocks(df, keys, [ts, *tie_break], ts, max(steps), slice_days, block_rows)
    current = F.col(value).cast("double")
    return _drop_overlap(blocks.withColumns({
        f"return_{n}d": period_return(current, F.lag(current, n).over(ordered)) for n in steps
    }), "_pos")


def keep_latest(df: DataFrame, keys, order) -> DataFrame:
    """Keep the row with the greatest `order` per key.

    Spark ranks inside every task before the shuffle, so a key with very many copies sends one row
    per task.  NULL in `order` loses against any value; `order` decides fully when it is unique per key.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(o) for o in order])
    return df.withColumn("_place", F.row_number().over(newest)).where("_place = 1").drop("_place")


def keep_newest_version(df: DataFrame, keys, version: str) -> DataFrame:
    """Keep all rows with the greatest `version` of their key: one shuffle, as a key has a handful of versions.

    Rows that lack a key column may be many of one key; their greatest versions are found by a pre-aggregated
    group-by and joined back.
    """
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    newest = F.max(version).over(Window.partitionBy(*keys))
    kept = df.where(whole).withColumn("_newest", newest).where(
        F.col(version).eqNullSafe(F.col("_newest"))).drop("_newest")
    loose = df.where(~whole)
    last = loose.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.max(version).alias("_version"))
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return kept.unionByName(loose.join(last, [*same, F.col(version).eqNullSafe(F.col("_version"))], "left_semi"))


def smoothed_demand(df: DataFrame, rows: int = DEMAND_WINDOW_ROWS, scale: int | None = None) -> DataFrame:
    """Mean of the last `rows` intervals of a day.  A deduplicated day has 96 rows at most."""
    frame = (Window.partitionBy("demand_date").orderBy("interval_id")
             .rowsBetween(-(rows - 1), Window.currentRow))
    return df.withColumn("demand_mw_1h_avg", mean(F.col("demand_mw"), scale, frame))
