"""Which micro-batches a table has taken in already.

Spark repeats the last batch of a stream that was stopped before its progress was written.  A sink that writes down the
batch after it succeeded can leave a repeated one out, without reading or merging anything.
"""

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "batch bigint, newest timestamp, n_rows bigint, recorded_at timestamp, slice bigint"


@dataclass(frozen=True)
class Before:
    """What a ledger knows as a batch begins: whether it holds the batch, and the newest event time of earlier ones.

    `lagged` leaves the newest `lag` batches out.
    """

    held: bool = False
    newest: datetime | None = None
    lagged: datetime | None = None


@dataclass(frozen=True)
class Ledger:
    """Rows of finished batches at `path`: batch, newest event time of this and all earlier batches, number of rows.

    A row is one small file; batches are kept in directories of `per_slice`, so that a look at one lists few files.
    Batch numbers rise by one, as a stream's do, and one stream writes a ledger.
    """

    path: str
    per_slice: int = 1000

    def before(self, spark: SparkSession, batch: int, lag: int = 0) -> Before:
        try:
            rows = spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return Before()
        own, number = batch // self.per_slice, F.col("batch")
        found = rows.where(F.col("slice").between(own - 1, own)).agg(
            F.count_if(number == batch).alias("held"), F.max(F.when(number < batch, F.col("newest"))).alias("newest"),
            F.max(F.when(number < batch - lag, F.col("newest"))).alias("lagged")).first()
        return Before(found.held > 0, found.newest, found.lagged)

    def record(self, spark: SparkSession, batch: int, before: Before = Before(), newest: datetime | None = None,
               n_rows: int | None = None) -> None:
        newest = max((t for t in (before.newest, newest) if t is not None), default=None)
        row = spark.range(0, 1, 1, 1).select(
            F.lit(batch).cast("bigint").alias("batch"), F.lit(newest).cast("timestamp").alias("newest"),
            F.lit(n_rows).cast("bigint").alias("n_rows"), F.current_timestamp().alias("recorded_at"),
            F.lit(batch // self.per_slice).alias("slice"))
        row.write.mode("append").partitionBy("slice").parquet(self.path)


def once(handler, ledger: Ledger | None, lag: int = 0):
    """`handler(batch, batch_id, before)` for batches that the ledger does not hold.

    It returns what to record beside the batch's number, or None; empty batches are only recorded.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = Before() if ledger is None else ledger.before(spark, batch_id, lag)
        if before.held:
            return
        numbers = None if batch.isEmpty() else handler(batch, batch_id, before)
        if ledger is not None:
            ledger.record(spark, batch_id, before, **(numbers or {}))

    return on_batch
