"""Tables in buckets, so that joins and aggregates on their keys need no shuffle."""

from pyspark.sql import DataFrame, functions as F

from gridlake.operators.joins import HOUR_KEYS
from gridlake.sinks.tables import with_month


def write_buckets(df: DataFrame, name: str, path: str, buckets: int, keys=HOUR_KEYS, sort=None,
                  month_of: str | None = None) -> None:
    """Replace the catalog table `name` at `path`: rows dealt by the hash of `keys`, sorted inside each file.

    One shuffle deals the rows as the buckets do, so a bucket is one file (one per month if `month_of` names the date
    that months are cut by).  Tables meet without a further shuffle when they have the same `keys` and number of
    `buckets`.  All keys of a later join have to be among the bucket's, which also spreads a zone over all buckets; a
    task reads a bucket as a whole, so the number has to grow with the table (some 256 MB a bucket).  Rows with NULL in
    every key share one bucket.
    """
    sort = list(keys if sort is None else sort)
    df = df if month_of is None else with_month(df, month_of)
    dealt = df.repartition(buckets, *[F.col(k) for k in keys])
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
    if month_of is not None:
        # The whole table is replaced, so months that the new rows lack have to go too.
        writer = writer.option("partitionOverwriteMode", "static").partitionBy("month")
    writer.bucketBy(buckets, *keys).sortBy(*sort).saveAsTable(name)
