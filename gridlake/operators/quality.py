"""Data-quality checks that count failing rows, and views that return them."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from gridlake.constants import INTERVALS_PER_DAY, REGIONS, TICKERS


@dataclass(frozen=True)
class Contract:
    """Rules of one table.  NULL passes every rule but `not_null`."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted_values: dict[str, list] = field(default_factory=dict)
    accepted_range: dict[str, tuple] = field(default_factory=dict)

    def row_rules(self) -> dict[tuple[str, str], Column]:
        """Condition that is true for a failing row, by (check, column)."""
        rules = {("not_null", c): F.col(c).isNull() for c in self.not_null}
        for c, values in self.accepted_values.items():
            rules["accepted_values", c] = ~F.col(c).isin(values)
        for c, (low, high) in self.accepted_range.items():
            rules["accepted_range", c] = ~F.col(c).between(low, high)
        return rules


CONTRACTS = {
    "fct_daily_prices": Contract(not_null=("price_date", "country", "avg_price_eur_mwh")),
    "fct_commodity_drivers": Contract(
        not_null=("price_date", "ticker"), accepted_values={"ticker": list(TICKERS)}),
    "fct_intraday_demand": Contract(
        not_null=("demand_date", "interval_id", "demand_mw"),
        accepted_range={"interval_id": (1, INTERVALS_PER_DAY)}),
    "fct_eu_daily_by_region": Contract(
        not_null=("date", "region", "zone_code"), accepted_values={"region": REGIONS}),
    "fct_eu_duck_curve": Contract(
        not_null=("date", "hour_utc", "region"), accepted_range={"hour_utc": (0, 23)}),
    "fct_eu_regional_summary": Contract(
        not_null=("date", "region"), accepted_values={"region": REGIONS}),
    "dim_region_mapping": Contract(
        not_null=("zone_code", "region"), unique=("zone_code",),
        accepted_values={"region": REGIONS}),
}


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Key values that occur more than once, with their number of rows; NULL keys pass."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    counted = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where("n_rows > 1")


def failing_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows that break any row rule, with the list of broken rules in `failed`."""
    broken = [
        F.when(rule, F.lit(f"{check}:{column}"))
        for (check, column), rule in contract.row_rules().items()
    ]
    tagged = df.withColumn("failed", F.filter(F.array(*broken), lambda name: name.isNotNull()))
    return tagged.where(F.size("failed") > 0)


def check_table(df: DataFrame, contract: Contract, name: str = "") -> DataFrame:
    """One row per rule with its number of failures.

    All row rules of a table are counted in one pass; every unique rule groups by its column.
    """
    rules = contract.row_rules()
    parts = []
    if rules:
        counts = df.agg(*[F.count_if(rule).alias(f"{check}:{column}")
                          for (check, column), rule in rules.items()])
        long = counts.unpivot([], counts.columns, "rule", "failures")
        parts.append(long)
    for column in contract.unique:
        parts.append(duplicate_keys(df, column).agg(F.count(F.lit(1)).alias("failures"))
                     .select(F.lit(f"unique:{column}").alias("rule"), "failures"))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.select(
        F.lit(name).alias("table_name"),
        F.substring_index("rule", ":", 1).alias("check_name"),
        F.substring_index("rule", ":", -1).alias("column_name"),
        "failures",
    )


def check_tables(tables: dict[str, DataFrame], contracts: dict[str, Contract] | None = None) -> DataFrame:
    """The report of every table that has a contract."""
    contracts = CONTRACTS if contracts is None else contracts
    reports = [check_table(tables[n], c, n) for n, c in contracts.items() if n in tables]
    if not reports:
        raise ValueError("none of the tables has a contract")
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report
