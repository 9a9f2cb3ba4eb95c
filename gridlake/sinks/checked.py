"""Publish a table only when its contract holds.

A build is written to a folder of its own and the rules of its contract are counted in the same job.  When none is
broken, the table's name is moved to the new folder in one step; otherwise readers keep the former build.
"""

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from gridlake.operators.quality import Contract, duplicate_keys
from gridlake.sinks.tables import observed, replace_partitions


@dataclass(frozen=True)
class Build:
    """Where a build was written, its rows, the failures of every rule, and whether it was published."""

    path: str
    n_rows: int
    failures: dict[str, int]

    @property
    def published(self) -> bool:
        return not any(self.failures.values())

    @property
    def n_failures(self) -> int:
        return sum(self.failures.values())


def publish_checked(df: DataFrame, name: str, root: str, contract: Contract, partition=(), cluster=()) -> Build:
    """Write `df` below `root` and let the view `name` show it if `contract` holds.

    Row rules are counted by the job that writes; only `unique` rules, which need a shuffle, read the written column
    again.  The view is replaced in one step of the catalog, so a reader sees either build as a whole.  Running queries
    go on with the folder that they began with, therefore former builds are kept; so is a refused one, to be looked at.
    """
    path = f"{root.rstrip('/')}/build-{uuid.uuid4().hex}"
    rules = {f"{check}:{column}": rule for (check, column), rule in contract.row_rules().items()}
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("n_rows"),
                         *[F.count_if(rule).alias(rule_name) for rule_name, rule in rules.items()])
    spark = df.sparkSession
    if partition:
        replace_partitions(watched, path, list(partition), list(cluster))
    else:
        watched.sortWithinPartitions(*cluster).write.parquet(path) if cluster else watched.write.parquet(path)
    # The schema is given, as an empty build by partition has no file to take it from.
    written = spark.read.schema(df.schema).parquet(path)
    counts = observed(seen, written, ["n_rows", *rules])
    n_rows = counts.pop("n_rows")
    for column in contract.unique:
        counts[f"unique:{column}"] = duplicate_keys(written, column).count()
    build = Build(path, n_rows, counts)
    if build.published:
        quoted = ".".join(f"`{part}`" for part in name.split("."))
        fields = ", ".join(f"`{f.name}`" for f in df.schema)
        spark.sql(f"CREATE OR REPLACE VIEW {quoted} AS SELECT {fields} FROM parquet.`{path}`")
    return build
