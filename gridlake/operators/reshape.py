"""Long to wide and back, fuel classes and the energy mix."""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gridlake.constants import (
    FOSSIL_FUELS, FUEL_TYPES, GENERATION_DIRECTION, RENEWABLE_FUELS, SOLAR_MARK, WIND_MARK,
)
from gridlake.functions import (
    guarded_ratio, local_to_utc, mean, nan_to_null, normalize_name, null_safe_sum, whole_units,
)

HOUR_KEYS = ["date", "timestamp", "zone"]
UNLISTED = "unlisted"
#: Fuel columns of a table at most, if they are taken from the data.
MOST_FUELS = 200


def fuel_columns(fuels=FUEL_TYPES) -> list[str]:
    return [normalize_name(f) for f in fuels]


def discover_fuels(gen: DataFrame, most: int = MOST_FUELS) -> list[str]:
    """Fuels present in the data, sorted.  Runs one job that brings `most` names and one more at most.

    More than `most` fuels are an error: they would become as many columns.
    """
    spelled = gen.select("fuel_type").where("fuel_type is not null").distinct()
    rows = spelled.select(normalize_name(F.col("fuel_type")).alias("fuel")).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} fuels in fuel_type; name the wanted ones instead")
    return sorted(r.fuel for r in rows)


def _quoted(name: str) -> str:
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fuel_slot(fuel: str, fuels: list[str]) -> Column:
    """Position of the column `fuel` in the list of normalized names, NULL if it is not in it.

    The known spellings are looked up directly; only others go through the pattern.
    """
    known = {f: fuels.index(normalize_name(f)) for f in FUEL_TYPES if normalize_name(f) in fuels}
    listed = ", ".join(_quoted(f) for f in fuels)
    other = (F.array_position(F.expr(f"array({listed})"), normalize_name(F.col(fuel))) - 1).cast("int")
    if not known:
        return other
    spelled = ", ".join(f"{_quoted(f)}, {slot}" for f, slot in known.items())
    return F.coalesce(F.try_element_at(F.expr(f"map({spelled})"), F.col(fuel)), other)


def pivot_generation(gen: DataFrame, fuels: list[str] | None = None, keys=HOUR_KEYS,
                     scale: int | None = None) -> DataFrame:
    """One row per zone-hour with one summed column per fuel.

    By default the columns are the fixed list, so that every day has the same table shape, and one column
    `unlisted` with the sum of all other rows.  `fuels` names the columns instead, normalized, as
    :func:`discover_fuels` gives them; rows of other fuels then make their zone-hour appear only.  One conditional
    sum per fuel needs a single shuffle of pre-aggregated rows, where a pivot plans two.  `scale` as in
    :mod:`gridlake.functions.measures`.
    """
    rest = fuels is None
    fuels = fuel_columns() if rest else fuels
    amount, unit = F.col("generation_mw"), ""
    if scale is not None:
        amount, unit = whole_units(amount, scale), f" / {10 ** scale}D"
    slotted = gen.select(*keys, amount.alias("amount"), fuel_slot("fuel_type", fuels).alias("slot"))
    sums = [F.expr(f"sum(CASE WHEN slot = {i} THEN amount END){unit} AS `{f}`") for i, f in enumerate(fuels)]
    if rest:
        sums.append(F.expr(f"sum(CASE WHEN coalesce(slot, -1) < 0 THEN amount END){unit} AS `{UNLISTED}`"))
    return slotted.groupBy(*keys).agg(*sums)


def unpivot_generation(wide: DataFrame, ids=("timestamp",), fuels: list[str] | None = None) -> DataFrame:
    """One row per id and fuel column.  Empty cells stay as NULL rows."""
    fuels = [c for c in wide.columns if c not in ids] if fuels is None else fuels
    return wide.unpivot(list(ids), fuels, "fuel_type", "generation_mw")


def _fuel_and_direction(column: str, separator: str) -> tuple[str, str | None]:
    """Parts of `fuel|direction` or of the printed pair `('fuel', 'direction')`."""
    pair = re.fullmatch(r"\('(.*)', '(.*)'\)", column)
    if pair:
        return pair.group(1), pair.group(2)
    fuel, found, direction = column.rpartition(separator)
    return (fuel, direction) if found else (column, None)


def keep_generation_direction(wide: DataFrame, ids=("timestamp",), separator: str = "|") -> DataFrame:
    """Drop consumption columns of a frame with one column per fuel and direction.

    Columns keep only the fuel name.  A frame without any generation-direction column is returned
    as it is.
    """
    parts = {c: _fuel_and_direction(c, separator) for c in wide.columns if c not in ids}
    produced = {c: fuel for c, (fuel, direction) in parts.items() if direction == GENERATION_DIRECTION}
    if not produced:
        return wide
    return wide.select(*ids, *[F.col(f"`{c}`").alias(fuel) for c, fuel in produced.items()])


def generation_rows(wide: DataFrame, zone: str, local_zone: str | None = None, ts: str = "timestamp",
                    tag: str = "zone") -> DataFrame:
    """A landed wide generation frame as long rows: produced energy only, tagged, in UTC."""
    long = unpivot_generation(keep_generation_direction(wide, (ts,)), (ts,))
    instant = local_to_utc(F.col(ts), local_zone) if local_zone else F.col(ts)
    return long.select(
        instant.alias("timestamp"), "fuel_type",
        nan_to_null(F.col("generation_mw").cast("double")).alias("generation_mw"), F.lit(zone).alias(tag))


def columns_matching(columns: list[str], fuels: list[str]) -> list[str]:
    """Columns whose name contains the normalized name of any of `fuels`, each column once."""
    marks = [normalize_name(f) for f in fuels]
    return [c for c in columns if any(m in c for m in marks)]


def energy_mix(wide: DataFrame, fuels: list[str] | None = None) -> DataFrame:
    """Add totals, renewable and fossil shares and residual load.

    Shares are NULL unless the total is positive; totals of an empty hour are 0.0.
    """
    fuels = [c for c in wide.columns if c not in HOUR_KEYS] if fuels is None else fuels
    weather = [null_safe_sum([c for c in fuels if mark in c]) for mark in (WIND_MARK, SOLAR_MARK)]
    sums = wide.withColumns({
        "total_mw": null_safe_sum(fuels),
        "renewable_mw": null_safe_sum(columns_matching(fuels, RENEWABLE_FUELS)),
        "fossil_mw": null_safe_sum(columns_matching(fuels, FOSSIL_FUELS)),
    })
    whole = F.col("total_mw")
    return sums.withColumns({
        "renewable_share": guarded_ratio(F.col("renewable_mw"), whole),
        "fossil_share": guarded_ratio(F.col("fossil_mw"), whole),
        "residual_load_mw": whole - weather[0] - weather[1],
    })


def union_series(frames: dict[str, DataFrame], tag: str = "ticker") -> DataFrame:
    """Stack one frame per series, tagged with its name.  Absent columns become NULL."""
    if not frames:
        raise ValueError("no series given")
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def flatten_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def hourly(df: DataFrame, value: str, ts: str = "timestamp", keys=("date", "zone"),
           scale: int | None = None) -> DataFrame:
    """Resample sub-hourly rows to hourly means; hourly rows come out unchanged."""
    bucket = df.withColumn(ts, F.date_trunc("hour", F.col(ts)).cast(df.schema[ts].dataType))
    return bucket.groupBy(*keys, ts).agg(mean(F.col(value), scale).alias(value))
