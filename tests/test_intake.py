"""Rejected messages, late rows and repeated batches."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.streaming import feed, intake, sinks
from gridlake.streaming.ledger import Before, Ledger

GOOD = '{"event_ts": 1706745600000, "demand_date": "2024-02-01", "interval_id": 1, "demand_mw": 2.5, "ingested_at": 1}'
VALUES = {
    GOOD: None,
    GOOD.replace("}", ', "more": [1, {"x": 2}]}'): None,
    None: "empty", "": "empty", "  ": "empty",
    "no json": "malformed", GOOD[:-5]: "malformed", "7": "malformed", '"text"': "malformed",
    GOOD.replace("2.5", '"high"'): "malformed", GOOD.replace("2024-02-01", "2024-13-45"): "malformed",
    "{}": "missing event_ts,demand_date,interval_id,demand_mw",
    GOOD.replace("2.5", "null"): "missing demand_mw",
    GOOD.replace('"interval_id": 1', '"interval_id": 0'): "interval",
    GOOD.replace('"interval_id": 1', '"interval_id": 97'): "interval",
}


def messages(spark, values):
    return spark.createDataFrame([("k", v) for v in values], "key string, value string")


def test_every_message_is_good_or_has_a_reason(spark):
    found = {r.raw: r.reason for r in intake.check_json(messages(spark, VALUES)).collect()}
    assert found == VALUES


def test_rejects_keep_the_message_and_a_repeated_batch_replaces_itself(spark, tmp_path):
    for i, part in enumerate((list(VALUES)[:6], list(VALUES)[6:])):
        messages(spark, part).coalesce(1).write.mode("append").option("ignoreNullFields", False).json(f"{tmp_path}/in")
    stream = feed.file_feed(spark, f"{tmp_path}/in", schemas.KEYED_MESSAGE, "json", files_per_batch=1)
    for progress in ("first", "again"):  # a lost checkpoint: all batches come again, without a ledger
        intake.keep_messages(stream, f"{tmp_path}/rows", f"{tmp_path}/bad", f"{tmp_path}/{progress}").awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/rows")
    assert rows.count() == 2 and set(schemas.DEMAND_STREAM.fieldNames()) < set(rows.columns)
    bad = spark.read.parquet(f"{tmp_path}/bad").collect()
    assert sorted((r.raw or "", r.reason) for r in bad) == sorted((v or "", r) for v, r in VALUES.items() if r)


def test_ledger_counts_and_slices(spark, tmp_path):
    ledger = Ledger(str(tmp_path / "batches"), per_slice=2)
    at = datetime(2024, 1, 1)
    assert ledger.before(spark, 0) == Before()
    for batch, hours in enumerate([5, 9, 1, None, 2]):
        before = ledger.before(spark, batch)
        ledger.record(spark, batch, before, None if hours is None else at + timedelta(hours=hours), 3)
    assert [ledger.before(spark, b).held for b in range(6)] == [True] * 5 + [False]
    # the newest event time is carried along, so that old slices are not needed
    assert ledger.before(spark, 5) == Before(False, at + timedelta(hours=9), at + timedelta(hours=9))
    assert ledger.before(spark, 2, lag=1) == Before(True, at + timedelta(hours=9), at + timedelta(hours=5))


def readings(values, at):
    return [(at, at.date(), 1 + i, v, "PSE", at) for i, v in enumerate(values)]


def test_a_batch_that_comes_again_is_left_out(spark, tmp_path):
    places, ledger = (str(tmp_path / "latest"), str(tmp_path / "mart")), Ledger(str(tmp_path / "batches"))
    handler = sinks.intraday_handler(*places, scale=2, ledger=ledger)
    at = datetime(2024, 1, 1, 3)
    for batch, values in ((0, [1.0, 2.0]), (0, [7.0, 8.0]), (1, [3.0])):
        handler(spark.createDataFrame(readings(values, at + timedelta(minutes=batch)), schemas.DEMAND_STREAM), batch)
    assert sorted(r.demand_mw for r in spark.read.parquet(places[1]).collect()) == [2.0, 3.0]


def test_a_batch_that_fails_is_not_recorded(spark, tmp_path):
    from gridlake.streaming.ledger import once

    ledger, seen = Ledger(str(tmp_path / "batches")), []

    def handler(batch, batch_id, before):
        seen.append(batch_id)
        if len(seen) == 1:
            raise RuntimeError("lost")

    on_batch = once(handler, ledger)
    with pytest.raises(RuntimeError):
        on_batch(spark.range(1), 0)
    on_batch(spark.range(1), 0)
    on_batch(spark.range(1), 0)
    assert seen == [0, 0]


def test_late_rows_are_those_that_operators_drop(spark, tmp_path):
    start, rows = datetime(2024, 1, 1), []
    for day, late in ((0, 0), (3, 0), (6, 5), (9, 1), (12, 9)):
        at = start + timedelta(days=day)
        file = [(day * 100 + i, at + timedelta(hours=i)) for i in range(4)]
        rows.append(file + [(day * 100 + 50 + i, at - timedelta(days=9, hours=i)) for i in range(late)])
    for file in rows:
        spark.createDataFrame(file, "id long, event_ts timestamp").coalesce(1).write.mode("append").parquet(
            f"{tmp_path}/in")
    stream = feed.file_feed(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, files_per_batch=1)
    for _ in range(2):
        intake.keep_with_late(stream, f"{tmp_path}/rows", f"{tmp_path}/progress", Ledger(f"{tmp_path}/batches"),
                              "1 day").awaitTermination()
    kept = spark.read.parquet(f"{tmp_path}/rows")
    late = kept.where(F.col("late").cast("boolean")).count()
    assert kept.count() == sum(map(len, rows))
    query = (feed.first_per_interval(stream, ["id"], "1 day", spread=1).writeStream.format("noop")
             .option("checkpointLocation", f"{tmp_path}/first").trigger(availableNow=True).start())
    query.awaitTermination()
    assert late == intake.dropped_by_watermark(query) > 5
