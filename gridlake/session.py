"""Session defaults and the shared folder that cuts lineage."""

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(app_name: str = "gridlake", **conf) -> SparkSession:
    """A session in UTC with adaptive execution; `conf` adds or overrides settings.

    Master, memory and shuffle width belong to the cluster and are left alone.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Recording the caller of every column expression costs more than building the plan.
        "spark.sql.dataFrameQueryContext.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, visible to driver and executors alike.

    Where it is unset, a local session gets a new temporary folder; a cluster has to name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    current = context.getCheckpointDir()
    if current:
        return os.path.dirname(current.rstrip("/"))
    return tempfile.mkdtemp(prefix="gridlake-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute `df` once and keep it in the shared folder, so that it outlives its inputs."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
