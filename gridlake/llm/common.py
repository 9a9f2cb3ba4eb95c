"""Helpers shared by the operators of this subpackage."""

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from gridlake.session import shared_dir

#: Separators of words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "\\x20\\x09-\\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Code point table that lower-cases A-Z and leaves every other character alone.
ASCII_LOWER = str.maketrans(UPPER, LOWER)

#: Rows per Arrow batch.  A batch holds whole texts, so its size in bytes is rows times text length.
ROWS_PER_BATCH = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Bound the Arrow batches of this session, as Python workers hold a whole batch of texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) not in range(1, rows + 1):
        spark.conf.set(name, rows)


def stage(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read again: computed once, cut from its lineage."""
    path = os.path.join(shared_dir(df.sparkSession), "gridlake-llm", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
