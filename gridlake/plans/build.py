"""The tables built from the raw ones, each a plain function of the tables before it."""

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from gridlake.operators import staging
from gridlake.operators.quality import check_tables
from gridlake.plans import marts
from gridlake.sinks.tables import write_months

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Model:
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    # Marts are stored by month of this column, sorted by `cluster`; the others are views.
    stored_by: str | None = None
    cluster: tuple[str, ...] = ()


# In build order: a model only uses raw tables and models above it.
MODELS: dict[str, Model] = {
    "stg_entsoe__prices": Model(staging.country_prices, ("entsoe_prices_pl",)),
    "stg_pse__demand": Model(staging.demand, ("pse_demand",)),
    "stg_yahoo__prices": Model(staging.quotes, ("yahoo_prices",)),
    "stg_pse__demand_stream": Model(staging.latest_demand, ("pse_demand_stream",)),
    "stg_entsoe__eu_hourly_wide": Model(staging.hourly_wide, ("entsoe_eu_hourly_wide",)),
    "int_eu_hourly_with_region": Model(
        marts.hourly_with_region, ("stg_entsoe__eu_hourly_wide", "dim_region_mapping")),
    "fct_daily_prices": Model(
        marts.daily_prices, ("stg_entsoe__prices",), "price_date", ("country",)),
    "fct_commodity_drivers": Model(
        marts.commodity_drivers, ("stg_yahoo__prices",), "price_date", ("ticker",)),
    "fct_intraday_demand": Model(
        marts.intraday_demand, ("stg_pse__demand_stream",), "demand_date", ("interval_id",)),
    "fct_eu_daily_by_region": Model(
        marts.daily_by_region, ("stg_entsoe__eu_hourly_wide", "dim_region_mapping"),
        "date", ("region", "zone_code")),
    "fct_eu_duck_curve": Model(
        marts.duck_curve, ("stg_entsoe__eu_hourly_wide", "dim_region_mapping"),
        "date", ("region", "zone_code")),
    "fct_eu_regional_summary": Model(
        marts.regional_summary, ("fct_eu_daily_by_region",), "date", ("region",)),
}


def wanted(only: list[str] | None = None) -> list[str]:
    """The named models and everything they need, in build order; all models without names."""
    if only is None:
        return list(MODELS)
    names = set(only)
    unknown = names - MODELS.keys()
    if unknown:
        raise KeyError(f"unknown models {sorted(unknown)}")
    for name in reversed(MODELS):
        if name in names:
            names.update(i for i in MODELS[name].inputs if i in MODELS)
    return [name for name in MODELS if name in names]


def _frame(name: str, known: Mapping[str, DataFrame]) -> DataFrame:
    model = MODELS[name]
    if name == "stg_entsoe__eu_hourly_wide" and "entsoe_eu_hourly_wide" not in known:
        # Without a wide table the prices alone make up the staging view.
        return staging.hourly_price_only(known["entsoe_eu_prices"])
    return model.build(*[known[i] for i in model.inputs])


def build(raw: Mapping[str, DataFrame], only: list[str] | None = None) -> Tables:
    """The models as lazy frames, by name."""
    known = dict(raw)
    for name in wanted(only):
        known[name] = _frame(name, known)
    return {name: known[name] for name in wanted(only)}


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make tables available to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def store(raw: Mapping[str, DataFrame], root: str, only: list[str] | None = None) -> Tables:
    """Build and write the marts to `root/<mart>`; marts above others read the stored ones.

    Returns the stored marts.
    """
    known = dict(raw)
    stored: Tables = {}
    for name in wanted(only):
        known[name] = df = _frame(name, known)
        model = MODELS[name]
        if model.stored_by is not None:
            path = f"{root.rstrip('/')}/{name}"
            write_months(df, path, model.stored_by, list(model.cluster))
            known[name] = stored[name] = df.sparkSession.read.parquet(path).select(*df.columns, "month")
    return stored


def check(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Failure counts of the tables' contracts."""
    return check_tables(dict(tables))
