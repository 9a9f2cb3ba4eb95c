"""Messages and rows into tables with nothing lost on the way: rejected messages and late rows are kept beside the rest."""

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from gridlake.constants import INTERVALS_PER_DAY
from gridlake.schemas import DEMAND_MESSAGE
from gridlake.sinks.tables import replace_partitions
from gridlake.streaming.feed import to_rows
from gridlake.streaming.ledger import Ledger, once

#: What a message must have to become a row.
REQUIRED = ("event_ts", "demand_date", "interval_id", "demand_mw")
BROKEN = "_broken"


def check_json(messages: DataFrame, required=REQUIRED) -> DataFrame:
    """Columns of JSON messages with `raw`, the value as it came, and `reason`, NULL where the message is good.

    Reasons: `empty` (no value), `malformed` (no JSON object, or a field of another type), `missing a,b` (fields without
    a value), `interval` (its number is none of a day's).
    """
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in DEMAND_MESSAGE] + [
        T.StructField(BROKEN, T.StringType(), True)])
    body = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    parsed = messages.select(F.col("value").cast("string").alias("value")).withColumn("m", body).select(
        "m.*", F.col("value").alias("raw"))
    return parsed.withColumn("reason", reject_reason(required)).drop(BROKEN)


def reject_reason(required=REQUIRED) -> Column:
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    return (F.when(F.trim(F.coalesce("raw", F.lit(""))) == "", "empty")
            .when(F.col(BROKEN).isNotNull(), "malformed")
            .when(missing != "", F.concat(F.lit("missing "), missing))
            .when(~F.col("interval_id").between(1, INTERVALS_PER_DAY), "interval"))


def keep_messages(messages: DataFrame, rows: str, rejects: str, checkpoint: str, ledger: Ledger | None = None,
                  check=check_json, **trigger):
    """Follow messages: good ones become rows of the table `rows`, by event day and batch, all others go to `rejects`,
    by batch, as they came and with the reason.

    Both writes replace what an earlier try of the batch left, and the ledger is written after both, so that a batch is
    in the tables once, whole.  A folder that Spark's file sink has written (`append_raw`) cannot be gone on with: readers
    then see that sink's files only.
    """
    def handler(batch: DataFrame, batch_id: int, _before):
        checked = check(batch).withColumn("batch", F.lit(batch_id).cast("bigint")).persist()
        try:
            is_good = F.col("reason").isNull()
            numbers = checked.agg(F.count(F.lit(1)).alias("n_rows"), F.max(
                F.when(is_good, F.timestamp_millis("event_ts"))).alias("newest")).first().asDict()
            replace_partitions(checked.where(~is_good).select("raw", "reason", "batch"), rejects, ["batch"])
            good = to_rows(checked.where(is_good)).withColumns({
                "event_date": F.to_date("event_ts"), "batch": F.lit(batch_id).cast("bigint")})
            replace_partitions(good, rows, ["event_date", "batch"], ["interval_id"])
            return numbers
        finally:
            checked.unpersist()

    return _follow(messages, once(handler, ledger), checkpoint, trigger)


def keep_with_late(rows: DataFrame, path: str, checkpoint: str, ledger: Ledger, delay: str = "1 day",
                   time: str = "event_ts", lag: int = 1, **trigger):
    """Store rows with `late`: whether they came behind the watermark, which is where stateful operators drop them.

    The watermark lies `delay` behind the newest event of earlier batches.  Operators drop by the watermark of the batch
    before, so the newest `lag` batches do not count yet; with `lag=0` they do, as where Spark runs an empty batch
    between any two.  The ledger keeps the newest event across restarts.  On-time and late rows are directories `late=false` and `late=true` of one table (read
    back as text), so a batch is written in one pass and a repeated batch replaces its own.
    """
    def handler(batch: DataFrame, batch_id: int, before):
        behind = F.lit(False) if before.lagged is None else F.col(time) <= (
            F.date_trunc("millisecond", F.lit(before.lagged)) - F.expr(f"INTERVAL {delay}"))
        counted = Observation()
        split = batch.observe(counted, F.count(F.lit(1)).alias("n_rows"), F.max(time).alias("newest")).withColumns({
            "late": F.coalesce(behind, F.lit(False)), "batch": F.lit(batch_id).cast("bigint")})
        replace_partitions(split, path, ["late", "batch"])
        return counted.get

    return _follow(rows, once(handler, ledger, lag), checkpoint, trigger)


def _follow(stream: DataFrame, on_batch, checkpoint: str, trigger: dict):
    return (stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def dropped_by_watermark(query) -> int:
    """Rows that the stateful operators of a stream dropped as late, by its last progress reports (100 by default)."""
    return sum(state.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for state in p["stateOperators"])
