"""Writes that can be repeated.

Tables are directories of parquet files partitioned by day or month.  A reload or upsert rewrites the
partitions its rows fall into and no others, through Spark's dynamic partition overwrite: new files are
complete before old ones are replaced, so a lost executor only costs a retry.  A driver that is lost while it moves
the new directories into place can leave a partition out; running the same load again restores it.
"""

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from gridlake.functions import month_of
from gridlake.operators.joins import with_keys, without_keys
from gridlake.operators.windows import keep_latest
from gridlake.session import cut_lineage
from gridlake.sources.landing import scan_or_none

#: Partitions of a batch that are named one by one when a table is read; names only, a short row each.
MOST_LISTED = 1000


def _arranged(df: DataFrame, partition: list[str], cluster: list[str]) -> DataFrame:
    """Rows grouped by partition in files of a good size, sorted by `cluster` inside.

    The rebalance splits a partition that is too large for one task and merges small ones, so a
    partition gets as few files as its size allows; the sort lets readers skip pages.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition]).sortWithinPartitions(*partition, *cluster)


def observed(seen: Observation, rows: DataFrame, names: list[str]) -> dict[str, int]:
    """Numbers counted on the way of `rows`; zeros where Spark knew that there were none and left the counter out."""
    try:
        return {name: seen.get[name] for name in names}
    except Py4JJavaError:
        if not rows.isEmpty():
            raise
        return dict.fromkeys(names, 0)


def _write(df: DataFrame, path: str, partition: list[str], cluster: list[str], mode: str) -> int:
    """Overwrite the table (`static`) or the partitions that have rows (`dynamic`); rows written.

    The rows are counted on their way, not by a pass of their own.
    """
    counted = Observation()
    watched = df.observe(counted, F.count(F.lit(1)).alias("n_rows"))
    (_arranged(watched, partition, cluster).write.mode("overwrite")
     .option("partitionOverwriteMode", mode).partitionBy(*partition).parquet(path))
    return observed(counted, df, ["n_rows"])["n_rows"]


def with_month(df: DataFrame, date_column: str) -> DataFrame:
    return df.withColumn("month", month_of(F.col(date_column)))


def write_months(df: DataFrame, path: str, date_column: str, cluster: list[str]) -> int:
    """Full rebuild of a table partitioned by month and sorted by `cluster` inside its files."""
    return _write(with_month(df, date_column), path, ["month"], cluster, "static")


def replace_months(df: DataFrame, path: str, date_column: str, cluster: list[str]) -> int:
    """Replace the months that `df` has rows of, columns included; other months keep theirs."""
    return _write(with_month(df, date_column), path, ["month"], cluster, "dynamic")


def replace_partitions(df: DataFrame, path: str, partition: list[str], cluster=()) -> int:
    """Replace the partitions that `df` has rows of, whatever their level; others stay."""
    return _write(df, path, list(partition), list(cluster), "dynamic")


def reload_days(batch: DataFrame, path: str, cluster: list[str], date_column: str = "date") -> int:
    """Replace exactly the days present in the batch; one pass over it."""
    return _write(batch, path, [date_column], cluster, "dynamic")


def land(df: DataFrame, path: str, partition=("country", "dt")) -> int:
    """Land a chunk, replacing the directories it fills; an empty one leaves everything as it is."""
    return _write(df, path, list(partition), [], "dynamic")


def append(df: DataFrame, path: str, partition: list[str], cluster: list[str]) -> None:
    """Plain append.  Running it twice stores the rows twice; reloads and upserts do not."""
    _arranged(df, partition, cluster).write.mode("append").partitionBy(*partition).parquet(path)


def in_same_partitions(old: DataFrame, batch: DataFrame, partition: str) -> DataFrame:
    """Rows of `old` in partitions that occur in `batch`; rows without a partition value count as one.

    The partitions of the batch are listed, so that no directory between them is read.  A batch of more than
    `MOST_LISTED` partitions is found by its span, which prunes, and a join, which picks those inside the span.
    """
    own = F.col(partition)
    values = [r[0] for r in batch.select(partition).distinct().limit(MOST_LISTED + 1).collect()]
    if len(values) <= MOST_LISTED:
        listed = own.isin([v for v in values if v is not None])
        return old.where(listed | own.isNull() if None in values else listed)
    span = batch.agg(F.min(partition).alias("first"), F.max(partition).alias("last")).first()
    inside = own.isNull() | own.between(F.lit(span.first), F.lit(span.last))
    return with_keys(old.where(inside), batch, [partition])


def _merge_into(batch: DataFrame, path: str, keys, date_column, by_month, cluster, combine) -> int:
    if date_column not in keys:
        raise ValueError(f"keys {keys} have to include the partitioning date {date_column!r}")
    partition = "month" if by_month else date_column
    batch = with_month(batch, date_column) if by_month else batch
    old = scan_or_none(batch.sparkSession, path)
    if old is None:
        return _write(batch, path, [partition], cluster, "dynamic")
    # Used three times below: for the touched partitions, for the keys and for the rows.
    batch = cut_lineage(batch)
    # Directory names come back as strings or dates, whatever they look like.
    old = old.withColumn(partition, F.col(partition).cast(batch.schema[partition].dataType))
    merged = combine(in_same_partitions(old, batch, partition).select(*batch.columns), batch)
    return _write(merged, path, [partition], cluster, "dynamic")


def replace_keys(batch: DataFrame, path: str, keys, cluster: list[str], date_column: str = "date",
                 by_month: bool = True) -> int:
    """Remove the stored rows whose `keys` occur in the batch, then add the batch.

    With the date alone as key a day is replaced as a whole; with date and zone a batch of some zones
    leaves the others in place.
    """
    return _merge_into(batch, path, list(keys), date_column, by_month, cluster,
                       lambda old, new: without_keys(old, new, list(keys)).unionByName(new))


def upsert(batch: DataFrame, path: str, keys, order, cluster: list[str], date_column: str,
           by_month: bool = True) -> int:
    """Store one row per key, the one with the greatest `order` among old and new.

    Repeating a batch or sending batches in another order gives the same table.
    """
    # Copies inside the batch go first, so that only the survivors are stored and merged.
    return _merge_into(keep_latest(batch, list(keys), list(order)), path, list(keys), date_column, by_month,
                       cluster, lambda old, new: keep_latest(old.unionByName(new), list(keys), list(order)))


def merge_rows(target: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """The content of `target` after an upsert of `batch`, as a lazy frame."""
    return without_keys(target, batch, list(keys)).unionByName(batch)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, path: str,
                 partition: list[str]) -> None:
    """Create an empty typed and partitioned parquet table unless there is one."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema)
    levels = ", ".join(f"`{c}`" for c in partition)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"PARTITIONED BY ({levels}) LOCATION '{path}'")
