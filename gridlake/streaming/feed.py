"""The demand stream: where it comes from, how messages become rows, and how they are published."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gridlake.constants import DEMAND_TOPIC, STREAM_BATCH_ROWS
from gridlake.functions import (
    default_source, interval_id, mean, message_key, millis_to_timestamp, timestamp_to_millis,
)
from gridlake.schemas import DEMAND_MESSAGE

# The message format on the wire.
DEMAND_AVRO = """
{
  "type": "record",
  "name": "Demand",
  "fields": [
    {"name": "event_ts", "type": {"type": "long", "logicalType": "timestamp-millis"}},
    {"name": "demand_date", "type": {"type": "int", "logicalType": "date"}},
    {"name": "interval_id", "type": "int"},
    {"name": "demand_mw", "type": "double"},
    {"name": "source", "type": "string", "default": "PSE"},
    {"name": "ingested_at", "type": {"type": "long", "logicalType": "timestamp-millis"}}
  ]
}
"""
# A registry-framed message starts with one marker byte and a four-byte schema id.
REGISTRY_HEADER_BYTES = 5


def kafka_options(servers: str, topic: str = DEMAND_TOPIC, per_batch: int = STREAM_BATCH_ROWS) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(per_batch),
    }


def kafka_feed(spark: SparkSession, servers: str, **options) -> DataFrame:
    """Keyed messages of the topic from its beginning.  Needs Spark's Kafka connector."""
    reader = spark.readStream.format("kafka")
    for name, value in kafka_options(servers, **options).items():
        reader = reader.option(name, value)
    return reader.load().select(F.col("key").cast("string").alias("key"), "value")


def file_feed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
              files_per_batch: int | None = None, pattern: str | None = None) -> DataFrame:
    """New files of a directory as a stream, oldest first."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def decode_json(messages: DataFrame) -> DataFrame:
    """JSON message values to columns."""
    return messages.select(F.from_json(F.col("value"), DEMAND_MESSAGE).alias("m")).select("m.*")


def decode_avro(messages: DataFrame, framed: bool = True) -> DataFrame:
    """Avro message values to columns, in the types of the JSON form.  Needs Spark's Avro module."""
    from pyspark.sql.avro.functions import from_avro

    body = F.substring("value", REGISTRY_HEADER_BYTES + 1, 2 ** 31 - 1) if framed else F.col("value")
    decoded = messages.select(from_avro(body, DEMAND_AVRO).alias("m")).select("m.*")
    return decoded.withColumns({c: timestamp_to_millis(F.col(c)) for c in ("event_ts", "ingested_at")})


def to_rows(events: DataFrame) -> DataFrame:
    """Decoded messages to rows of the demand stream table."""
    return events.select(
        millis_to_timestamp(F.col("event_ts")).alias("event_ts"),
        "demand_date",
        F.col("interval_id").cast("bigint").alias("interval_id"),
        "demand_mw",
        default_source(F.col("source")).alias("source"),
        millis_to_timestamp(F.col("ingested_at")).alias("ingested_at"),
    )


def to_messages(rows: DataFrame, *keep: str) -> DataFrame:
    """Rows of the demand stream table to keyed JSON messages, beside the columns `keep`."""
    payload = F.struct(
        timestamp_to_millis(F.col("event_ts")).alias("event_ts"),
        "demand_date",
        F.col("interval_id").cast("int").alias("interval_id"),
        "demand_mw",
        "source",
        timestamp_to_millis(F.col("ingested_at")).alias("ingested_at"),
    )
    return rows.select(
        message_key(F.col("demand_date"), F.col("interval_id")).alias("key"),
        F.to_json(payload).alias("value"),
        *keep,
    )


def publish(rows: DataFrame, path: str, checkpoint: str | None = None, fmt: str = "json", **options):
    """Write keyed messages: a stream returns its running query, a batch is written at once.

    With `fmt="kafka"` pass the topic and servers as options; `path` is then not used.
    """
    messages = to_messages(rows)
    if rows.isStreaming:
        writer = messages.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        writer = writer.format(fmt).options(**options).trigger(availableNow=True)
        return writer.start() if fmt == "kafka" else writer.start(path)
    writer = messages.write.format(fmt).mode("append").options(**options)
    return writer.save() if fmt == "kafka" else writer.save(path)


def first_per_interval(rows: DataFrame, keys=("demand_date", "interval_id"), delay: str = "1 day",
                       spread: int = 16) -> DataFrame:
    """Let every interval through once.

    State lasts for `delay` behind the newest event and is dropped afterwards; rows later than that are
    dropped as well, so corrections go through :mod:`gridlake.streaming.sinks`.  Add `demand_mw` to the
    keys to let changed values pass.  Copies of one interval are first thinned out by input partition
    (`spread` groups), so that a very frequent interval is not handled by one task.
    """
    marked = rows.withWatermark("event_ts", delay)
    if spread > 1:
        marked = marked.withColumn("_spread", F.pmod(F.spark_partition_id(), F.lit(spread)))
        marked = marked.dropDuplicatesWithinWatermark([*keys, "_spread"]).drop("_spread")
    return marked.dropDuplicatesWithinWatermark(list(keys))


def demand_buckets(rows: DataFrame, length: str = "15 minutes", step: str | None = None,
                   delay: str = "1 day", scale: int | None = None) -> DataFrame:
    """Event-time buckets with row count and mean demand; overlapping ones with `step`."""
    bucket = F.window("event_ts", length, step) if step else F.window("event_ts", length)
    return rows.withWatermark("event_ts", delay).groupBy(bucket).agg(
        F.count(F.lit(1)).alias("n_rows"), mean(F.col("demand_mw"), scale).alias("avg_mw"),
    ).select(F.col("window.start").alias("bucket_start"), F.col("window.end").alias("bucket_end"),
             "n_rows", "avg_mw")


def with_interval(rows: DataFrame) -> DataFrame:
    """Interval number and day of raw demand rows."""
    return rows.withColumns({
        "demand_date": F.to_date("event_ts"), "interval_id": interval_id(F.col("event_ts"))})
