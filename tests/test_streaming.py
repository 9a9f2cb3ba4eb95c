import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import AnalysisException

from gridlake import schemas
from gridlake.operators import staging
from gridlake.plans import marts
from gridlake.streaming import feed, sinks

START = datetime(2024, 1, 31, 22)


def readings(n=40, copies=3, seed=1):
    """Quarter-hours over a month end; every interval comes several times, the last value counts."""
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        at = START + timedelta(minutes=15 * i)
        for c in range(copies):
            rows.append((at, at.date(), (at.hour * 60 + at.minute) // 15 or 96,
                         round(pick.uniform(100, 200), 2), "PSE", at + timedelta(minutes=c)))
    pick.shuffle(rows)
    return rows


def land(spark, path, rows, files):
    """One file per slice of the rows, in the order of the slices."""
    size = -(-len(rows) // files)
    for i in range(files):
        part = spark.createDataFrame(rows[i * size:(i + 1) * size], schemas.DEMAND_STREAM)
        part.coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, per_batch=1):
    return feed.file_feed(spark, path, schemas.DEMAND_STREAM, files_per_batch=per_batch)


def finish(query):
    query.awaitTermination()
    return len([p for p in query.recentProgress if p["numInputRows"]])


def drain(df, path):
    return finish(df.writeStream.format("parquet").option("checkpointLocation", f"{path}-progress")
                  .trigger(availableNow=True).start(path))


def batch_mart(spark, rows):
    raw = spark.createDataFrame(rows, schemas.DEMAND_STREAM)
    return marts.intraday_demand(staging.latest_demand(raw), scale=2)


MART = ("demand_date", "interval_id", "event_ts", "demand_mw", "demand_mw_1h_avg")


@pytest.mark.parametrize("files", [1, 5])
def test_stream_mart_equals_batch_mart(spark, tmp_path, rows, files):
    data = readings()
    land(spark, str(tmp_path / "in"), data, files)
    query = sinks.keep_intraday(stream(spark, str(tmp_path / "in")), str(tmp_path / "latest"),
                                str(tmp_path / "mart"), str(tmp_path / "progress"), scale=2)
    assert finish(query) == files
    assert rows(spark.read.parquet(str(tmp_path / "mart")), *MART) == rows(batch_mart(spark, data), *MART)


def test_late_corrections_arrive_and_repeats_change_nothing(spark, tmp_path, rows):
    data = readings()
    paths = [str(tmp_path / n) for n in ("latest", "mart")]
    sinks.update_intraday(spark.createDataFrame(data, schemas.DEMAND_STREAM), *paths, scale=2)
    first = data[0]
    late = first[:3] + (999.0, "PSE", first[5] + timedelta(days=40))
    stale = data[1][:3] + (-1.0, "PSE", START - timedelta(days=1))
    for _ in range(2):
        sinks.update_intraday(spark.createDataFrame([late, stale], schemas.DEMAND_STREAM), *paths, scale=2)
    got = spark.read.parquet(paths[1])
    assert rows(got, *MART) == rows(batch_mart(spark, data + [late, stale]), *MART)
    assert got.where("demand_mw = 999").count() == 1 and got.where("demand_mw < 0").isEmpty()


def test_a_failed_batch_is_taken_again(spark, tmp_path, rows, monkeypatch):
    data = readings()
    land(spark, str(tmp_path / "in"), data, 3)
    args = (str(tmp_path / "latest"), str(tmp_path / "mart"), str(tmp_path / "progress"))
    write = sinks.replace_keys
    calls = []

    def fail_once(*a, **k):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost on the way")
        return write(*a, **k)

    monkeypatch.setattr(sinks, "replace_keys", fail_once)
    with pytest.raises(Exception, match="lost on the way"):
        finish(sinks.keep_intraday(stream(spark, str(tmp_path / "in")), *args, scale=2))
    finish(sinks.keep_intraday(stream(spark, str(tmp_path / "in")), *args, scale=2))
    assert rows(spark.read.parquet(args[1]), *MART) == rows(batch_mart(spark, data), *MART)


@pytest.mark.parametrize("spread", [1, 4])
def test_every_interval_passes_once(spark, tmp_path, rows, spread):
    data = readings(copies=6)
    land(spark, str(tmp_path / "in"), data, 3)
    assert drain(feed.first_per_interval(stream(spark, str(tmp_path / "in")), spread=spread),
                 str(tmp_path / "out")) == 3
    got = rows(spark.read.parquet(str(tmp_path / "out")), "demand_date", "interval_id")
    assert len(got) == 40 and got == sorted(set(got), key=lambda t: tuple((False, str(v)) for v in t))


def test_changed_values_pass_when_they_are_part_of_the_key(spark, tmp_path):
    data = readings(n=2, copies=1)
    data += [data[0], data[0][:3] + (1.0,) + data[0][4:]]
    land(spark, str(tmp_path / "in"), data, 2)
    once = feed.first_per_interval(stream(spark, str(tmp_path / "in")), ("demand_date", "interval_id", "demand_mw"))
    drain(once, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_closed_buckets_are_emitted_once(spark, tmp_path):
    data = readings(n=300, copies=1)
    data.sort()
    land(spark, str(tmp_path / "in"), data, 3)
    drain(feed.demand_buckets(stream(spark, str(tmp_path / "in")), "60 minutes", "15 minutes", scale=2),
          str(tmp_path / "out"))
    got = {r.bucket_start: (r.n_rows, r.avg_mw) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    at = START + timedelta(hours=5)
    inside = [r[3] for r in data if at <= r[0] < at + timedelta(hours=1)]
    assert got[at] == (4, round(sum(round(v * 100) for v in inside)) / 100.0 / 4)
    newest = max(r[0] for r in data)
    assert max(got) <= newest - timedelta(days=1)  # later ones wait for the watermark


def test_messages_round_trip(spark, tmp_path, rows):
    data = readings(n=10, copies=1)
    df = spark.createDataFrame(data, schemas.DEMAND_STREAM)
    messages = feed.to_messages(df)
    key, value = messages.where("key = '2024-02-01-96'").first()
    assert json.loads(value)["interval_id"] == 96 and json.loads(value)["demand_date"] == "2024-02-01"
    assert rows(feed.to_rows(feed.decode_json(messages))) == rows(df)
    feed.publish(df, str(tmp_path / "topic"))
    topic = feed.file_feed(spark, str(tmp_path / "topic"), schemas.KEYED_MESSAGE, "json")
    query = sinks.append_raw(feed.to_rows(feed.decode_json(topic)), str(tmp_path / "raw"), str(tmp_path / "progress"))
    finish(query)
    raw = spark.read.parquet(str(tmp_path / "raw"))
    assert rows(raw, *schemas.DEMAND_STREAM.fieldNames()) == rows(df)


def test_stream_can_be_published(spark, tmp_path):
    data = readings(n=4, copies=1)
    land(spark, str(tmp_path / "in"), data, 2)
    finish(feed.publish(stream(spark, str(tmp_path / "in")), str(tmp_path / "topic"), str(tmp_path / "progress")))
    assert spark.read.schema(schemas.KEYED_MESSAGE).json(str(tmp_path / "topic")).count() == 4


def test_missing_source_gets_the_default(spark):
    event = spark.createDataFrame([("k", json.dumps({
        "event_ts": 0, "demand_date": "1970-01-01", "interval_id": 96, "demand_mw": 1.5, "ingested_at": 1}))], schemas.KEYED_MESSAGE)
    got = feed.to_rows(feed.decode_json(event)).first()
    assert (got.source, got.demand_date, got.event_ts) == ("PSE", date(1970, 1, 1), datetime(1970, 1, 1))


def test_interval_columns(spark):
    df = spark.createDataFrame([(START,)], "event_ts timestamp")
    got = feed.with_interval(df).first()
    assert (got.demand_date, got.interval_id) == (date(2024, 1, 31), 88)


def test_topic_options(spark):
    options = feed.kafka_options("broker:9092")
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "200"
    try:
        df = feed.kafka_feed(spark, "broker:9092")
    except AnalysisException as error:  # the connector is not on this class path
        assert "kafka" in str(error).lower()
    else:
        assert df.columns == ["key", "value"]


def test_avro_schema_matches_the_row_schema():
    fields = [f["name"] for f in json.loads(feed.DEMAND_AVRO)["fields"]]
    assert fields == schemas.DEMAND_MESSAGE.fieldNames() == schemas.DEMAND_STREAM.fieldNames()


def test_update_spans_months(spark, tmp_path):
    sinks.update_intraday(spark.createDataFrame(readings(), schemas.DEMAND_STREAM),
                          str(tmp_path / "latest"), str(tmp_path / "mart"))
    months = sorted(p.name for p in (tmp_path / "mart").glob("month=*"))
    assert months == ["month=2024-01-01", "month=2024-02-01"]
