"""Where the demand stream ends: a raw table, and the intraday mart kept up to date."""

from pyspark.sql import DataFrame, functions as F

from gridlake.operators.joins import with_keys
from gridlake.operators.windows import keep_latest
from gridlake.plans.marts import intraday_demand
from gridlake.session import cut_lineage
from gridlake.sinks.tables import in_same_partitions, replace_keys, upsert, with_month
from gridlake.streaming.ledger import Ledger, once

KEYS = ["demand_date", "interval_id"]


def append_raw(rows: DataFrame, path: str, checkpoint: str):
    """Append every message to the raw table, by event day.  Spark's file sink commits a batch once."""
    return (
        rows.withColumn("event_date", F.to_date("event_ts"))
        .writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).partitionBy("event_date")
        .trigger(availableNow=True).start(path)
    )


def update_intraday(batch: DataFrame, latest: str, mart: str, tie_break=(), scale: int | None = None) -> None:
    """Take in a batch of demand rows, duplicates and corrections included.

    The newest ingest per interval goes to `latest`; the days it touches are then smoothed again as a
    whole and replaced in `mart`.  Doing it twice changes nothing, so a retried batch is harmless.
    """
    order = ["ingested_at", *tie_break]
    # Used for both tables; also thins out copies before anything is merged.
    newest = cut_lineage(keep_latest(batch, KEYS, order))
    upsert(newest, latest, KEYS, order, ["interval_id"], "demand_date")
    stored = in_same_partitions(
        batch.sparkSession.read.parquet(latest), with_month(newest, "demand_date"), "month")
    touched = with_keys(stored, newest, ["demand_date"])
    replace_keys(intraday_demand(touched, scale), mart, ["demand_date"], ["interval_id"], "demand_date")


def intraday_handler(latest: str, mart: str, tie_break=(), scale: int | None = None, ledger: Ledger | None = None):
    """:func:`update_intraday` as a function of batch and batch number; the ledger's batches are left out."""
    def handler(batch: DataFrame, _batch_id: int, _before) -> None:
        update_intraday(batch, latest, mart, tie_break, scale)

    return once(handler, ledger)


def keep_intraday(rows: DataFrame, latest: str, mart: str, checkpoint: str, tie_break=(),
                  scale: int | None = None, ledger: Ledger | None = None, **trigger):
    """Run :func:`update_intraday` on every micro-batch; progress is recorded after it succeeded.

    With a ledger a batch that Spark repeats after a stop is not merged again.
    """
    on_batch = intraday_handler(latest, mart, tie_break, scale, ledger)
    return (
        rows.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
