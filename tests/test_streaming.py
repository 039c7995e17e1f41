import json
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from obsflow.functions.messages import encode_observation
from obsflow.functions.weather import event_time
from obsflow.operators.messages import decode_messages
from obsflow.operators.models import fit_forecaster
from obsflow.operators.labels import training_table
from obsflow.schemas import OBS_RAW
from obsflow.sources.archive import KeyedArchive, latest_per_key
from obsflow.sources.messages import (
    FolderTopic, KafkaTopic, observation_messages, publish, read_observation_stream, replay_forecasts,
)
from obsflow.streaming import jobs

ORDER = ("ts", "temp", "weather")


def observations(spark, first=0, count=120):
    classes = ["Clear", "Clouds", "Rain", "Mist", "Snow"]
    rows = [(f"st_{i % 3}", 1.6e9 + i * 1800.0, 9.0 + i % 3, 45.0, 280.0 + i % 17, 279.0 + i % 17,
             1000.0 + i % 7, 50.0 + i % 11, classes[i * i % 5]) for i in range(first, first + count)]
    return spark.createDataFrame(rows, OBS_RAW)


def send(topic, df):
    publish(topic, df.coalesce(1).select(encode_observation("wire").alias("value")))


def drain(writer, checkpoint):
    query = jobs.start(writer, str(checkpoint), once=True)
    assert query.awaitTermination(120)
    return query


@pytest.fixture(scope="module")
def forecaster(spark):
    train = training_table(observations(spark, count=300), order=("ts",))
    return fit_forecaster(train, max_iter=2)


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    topic, out = FolderTopic(str(tmp_path / "in")), str(tmp_path / "out")

    def run():
        stream = decode_messages(read_observation_stream(spark, topic))
        writer = stream.writeStream.format("parquet").option("path", out)
        drain(writer, tmp_path / "checkpoint")

    send(topic, observations(spark, 0, 40))
    run()
    send(topic, observations(spark, 40, 40))
    run()
    run()
    got = spark.read.parquet(out).select("ts").collect()
    assert sorted(r.ts for r in got) == [1.6e9 + i * 1800 for i in range(80)]


def test_interval_trigger(spark, tmp_path):
    topic, out = FolderTopic(str(tmp_path / "in")), str(tmp_path / "out")
    send(topic, observations(spark, 0, 10))
    stream = decode_messages(read_observation_stream(spark, topic))
    writer = stream.writeStream.format("parquet").option("path", out)
    query = jobs.start(writer, str(tmp_path / "c"), interval="1 second")
    try:
        query.processAllAvailable()
        send(topic, observations(spark, 10, 10))
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(out).count() == 20


def test_intake_limit(spark, tmp_path):
    topic = FolderTopic(str(tmp_path / "in"))
    for i in range(3):
        send(topic, observations(spark, 10 * i, 10))
    stream = read_observation_stream(spark, topic, limit=1)
    query = drain(
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")), tmp_path / "c")
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [10, 10, 10]


def test_intake_limit_in_bytes(spark, tmp_path):
    topic = FolderTopic(str(tmp_path / "in"))
    for i in range(6):
        publish(topic, spark.createDataFrame([(f"{i}" * 99,)] * 10, "value string").coalesce(1))  # 1,000 bytes
    stream = read_observation_stream(spark, topic, limit_bytes=2_500)
    query = drain(
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")), tmp_path / "c")
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [20, 20, 20]
    with pytest.raises(ValueError, match="not both"):
        read_observation_stream(spark, topic, limit=1, limit_bytes=1)


def replayed(spark, topic, tmp_path, name, **start):
    out = str(tmp_path / name)
    drain(replay_forecasts(spark, topic, **start).writeStream.format("parquet").option("path", out), tmp_path / f"{name}-c")
    return sorted(r.value for r in spark.read.schema("value string").parquet(out).collect())


def test_replay_from_a_time(spark, tmp_path):
    topic = FolderTopic(str(tmp_path / "in"))
    publish(topic, spark.createDataFrame([("old",)], "value string"))
    time.sleep(1.1)
    since = time.time()
    publish(topic, spark.createDataFrame([("new",)], "value string"))
    assert replayed(spark, topic, tmp_path, "all") == ["new", "old"]
    assert replayed(spark, topic, tmp_path, "some", since=since) == ["new"]
    assert replayed(spark, topic, tmp_path, "none", since=since + 3600) == []


def test_replay_past_a_range_that_is_gone(spark, tmp_path):
    """From the first on means from the first there still is, also for a replay that goes on."""
    topic = FolderTopic(str(tmp_path / "in"))
    publish(topic, spark.createDataFrame([("a",)], "value string").coalesce(1))
    assert replayed(spark, topic, tmp_path, "kept") == ["a"]
    for file in Path(topic.path).glob("part-*"):
        file.unlink()
    publish(topic, spark.createDataFrame([("b",)], "value string").coalesce(1))
    assert replayed(spark, topic, tmp_path, "kept") == ["a", "b"]
    assert replayed(spark, topic, tmp_path, "anew") == ["b"]


def test_empty_batches_are_left_alone(spark):
    seen = []
    guarded = jobs.skip_empty(lambda batch, batch_id: seen.append(batch_id))
    guarded(observations(spark, count=0), 1)
    guarded(observations(spark, count=1), 2)
    assert seen == [2]


def test_fan_out_equals_the_batch_result(spark, tmp_path, forecaster):
    topic = FolderTopic(str(tmp_path / "in"))
    squall = observations(spark, 200, 6).withColumn("weather", F.lit("Squall"))
    for part in (observations(spark), observations(spark, 120, 30), squall):
        send(topic, part)
    stream = read_observation_stream(spark, topic, limit=1)
    schema = decode_messages(stream).schema
    archive = KeyedArchive(spark, str(tmp_path / "archive"), schema, order=ORDER)
    emit = jobs.emit_to_folder(str(tmp_path / "forecast"))
    drain(stream.writeStream.foreachBatch(jobs.fan_out(archive, forecaster, emit)), tmp_path / "c")

    everything = decode_messages(spark.read.text(topic.path))
    expected = latest_per_key(everything, order=ORDER)
    assert archive.read().exceptAll(expected).count() == 0
    assert expected.exceptAll(archive.read()).count() == 0
    assert archive.read().filter("weather = 'Squall'").count() > 0

    sent = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "forecast")).collect()]
    scored = [r.asDict() for r in jobs.forecasts(everything, forecaster).collect()]
    key = lambda r: tuple(r.values())
    assert sorted(sent, key=key) == sorted(scored, key=key)
    assert len(sent) == 150, "rows of an unknown class are archived but not forecast"


def test_fan_out_sets_unreadable_messages_apart(spark, tmp_path, forecaster):
    topic = FolderTopic(str(tmp_path / "in"))
    publish(topic, spark.createDataFrame([("no message",), ("{}",)], "value string").coalesce(1))
    send(topic, observations(spark, 0, 10))
    stream = read_observation_stream(spark, topic)
    archive = KeyedArchive(
        spark, str(tmp_path / "archive"), decode_messages(stream).schema, order=ORDER)
    handle = jobs.fan_out(
        archive, forecaster, jobs.emit_to_folder(str(tmp_path / "forecast")),
        reject=jobs.emit_to_folder(str(tmp_path / "rejects")))
    drain(stream.writeStream.foreachBatch(handle), tmp_path / "c")
    rejected = spark.read.text(str(tmp_path / "rejects")).select("value").collect()
    assert sorted(r.value for r in rejected) == ["no message", "{}"]
    assert spark.read.text(str(tmp_path / "forecast")).count() == 10
    everything = decode_messages(spark.read.text(topic.path))
    assert archive.read().exceptAll(latest_per_key(everything, order=ORDER)).count() == 0


def test_figures_of_batches(spark, tmp_path, forecaster):
    """Figures are those of each batch; without a known class nothing is emitted."""
    topic = FolderTopic(str(tmp_path / "in"))
    squall = observations(spark, 200, 6).withColumn("weather", F.lit("Squall"))
    for part in (observations(spark, 0, 10), squall):
        send(topic, part)
    publish(topic, spark.createDataFrame([("no message",), ("{}",)], "value string").coalesce(1))
    stream, emitted, figures = read_observation_stream(spark, topic, limit=1), [], []
    archive = KeyedArchive(spark, str(tmp_path / "archive"), decode_messages(stream).schema, order=ORDER)
    handle = jobs.fan_out(
        archive, forecaster, lambda messages, batch_id: emitted.append((batch_id, messages.count())),
        report=lambda batch_id, seen: figures.append(seen))
    drain(stream.writeStream.foreachBatch(handle), tmp_path / "c")
    assert [(f["messages"], f["rejected"], f["scored"]) for f in figures] == [(10, 0, 10), (6, 0, 0), (2, 2, 0)]
    assert [f["partitions"] > 0 for f in figures] == [True, True, False]
    assert emitted == [(0, 10)]


def test_a_new_checkpoint_loses_nothing(spark, tmp_path, forecaster):
    """Batch numbers start again with a new checkpoint; a message with NaN does not stop the job."""
    topic = FolderTopic(str(tmp_path / "in"))
    store = None
    for run in range(2):
        send(topic, observations(spark, 20 * run, 20))
        publish(topic, spark.createDataFrame([('{"name":a,"ts":1.0,"lon":NaN}',)], "value string").coalesce(1))
        stream = read_observation_stream(spark, topic)
        store = KeyedArchive(spark, str(tmp_path / "archive"), decode_messages(stream).schema, order=ORDER)
        handle = jobs.fan_out(store, forecaster, jobs.emit_to_folder(str(tmp_path / "forecast")))
        drain(stream.writeStream.foreachBatch(handle), tmp_path / f"c{run}")
    everything = decode_messages(spark.read.text(topic.path))
    assert store.read().exceptAll(latest_per_key(everything, order=ORDER)).count() == 0
    assert spark.read.text(str(tmp_path / "forecast")).count() == 20 + 40


def test_failed_batch_is_done_over(spark, tmp_path, forecaster):
    topic = FolderTopic(str(tmp_path / "in"))
    send(topic, observations(spark, 0, 30))
    archive = KeyedArchive(
        spark, str(tmp_path / "archive"), decode_messages(spark.read.text(topic.path)).schema, order=ORDER)
    emit = jobs.emit_to_folder(str(tmp_path / "forecast"))

    def broken(messages, batch_id):
        emit(messages, batch_id)
        raise RuntimeError("lost")

    def run(emitter):
        stream = read_observation_stream(spark, topic)
        writer = stream.writeStream.foreachBatch(jobs.fan_out(archive, forecaster, emitter))
        drain(writer, tmp_path / "c")

    with pytest.raises(Exception, match="lost"):
        run(broken)
    run(emit)
    assert spark.read.text(str(tmp_path / "forecast")).count() == 30


def test_running_latest_over_a_restart(spark, tmp_path):
    topic = FolderTopic(str(tmp_path / "in"))
    store = None
    for first in (0, 60):
        send(topic, observations(spark, first, 60))
        rows = decode_messages(read_observation_stream(spark, topic))
        store = KeyedArchive(spark, str(tmp_path / "archive"), rows.schema, order=ORDER)
        running = jobs.running_latest(rows, store.keys, store.order)
        handle = jobs.upsert_to(store)
        drain(running.writeStream.outputMode("update").foreachBatch(handle), tmp_path / "c")
    expected = latest_per_key(decode_messages(spark.read.text(topic.path)), order=ORDER)
    assert store.read().exceptAll(expected).count() == 0
    assert store.read().count() == expected.count() > 0


def test_score_stream_equals_batch(spark, tmp_path, forecaster):
    topic = FolderTopic(str(tmp_path / "in"))
    send(topic, observations(spark))
    stream = jobs.score_stream(read_observation_stream(spark, topic), forecaster)
    out = str(tmp_path / "out")
    drain(stream.writeStream.format("parquet").option("path", out), tmp_path / "c")
    expected = jobs.score_stream(spark.read.text(topic.path), forecaster)
    assert spark.read.parquet(out).exceptAll(expected).count() == 0


def test_forecast_topic(spark, tmp_path):
    topic, sent = FolderTopic(str(tmp_path / "in")), FolderTopic(str(tmp_path / "out"))
    send(topic, observations(spark, 0, 5))
    drain(sent.stream_writer(read_observation_stream(spark, topic)), tmp_path / "c")
    assert spark.read.text(sent.path).count() == 5


def test_active_points(spark):
    points = spark.createDataFrame([("a", 10.0), ("a", 99.0), ("b", 100.0), ("b", 101.0)], "name string, ts double")
    shown = jobs.active_points(points, 100.0)
    assert sorted(r.ts for r in shown.collect()) == [99.0, 100.0], "one that is 90 s old is gone"


def test_points_expire_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 50.0), (4, 95.0), (5, 140.0)], "id bigint, ts double")
    path = str(tmp_path / "points")
    rows.coalesce(1).write.json(path)
    points = spark.readStream.schema(rows.schema).json(path).withColumn("event_time", event_time("ts"))
    out = str(tmp_path / "out")
    drain(jobs.expired_points(points).writeStream.outputMode("append").format("parquet")
          .option("path", out), tmp_path / "c")
    ended = {r.id: r.expired_at.timestamp() for r in spark.read.parquet(out).collect()}
    assert sorted(ended) == [1, 2, 3]


def test_points_go_by_the_clock(spark, tmp_path):
    """Points of any age stay for their lifetime from arrival; timers fire when nothing arrives."""
    path, out = str(tmp_path / "points"), str(tmp_path / "out")
    rows = [(1, "a", 0.0, datetime(2020, 1, 1, 0, 0, 0, 123456)), (2, "a", 5e9, None), (2, "a", 5e9, None), (3, None, 9.0, None)]
    schema = "id bigint, name string, ts double, seen timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).parquet(path)
    ended = jobs.points_from_arrival(stream, lifetime=3, shares=2)
    query = jobs.start(ended.writeStream.format("parquet").option("path", out), str(tmp_path / "c"), interval="1 second")
    taken = lambda: spark.read.schema(ended.schema).parquet(out).collect() if Path(out, "_spark_metadata").exists() else []
    try:  # timers keep the query busy, so it never counts as having processed all
        limit = time.time() + 60
        while not any(p.numInputRows for p in query.recentProgress) and time.time() < limit:
            time.sleep(0.1)
        spark.createDataFrame([(4, "b", -1.0, None)], schema).coalesce(1).write.mode("append").parquet(path)
        while len(taken()) < 5 and time.time() < limit:
            time.sleep(0.3)
    finally:
        query.stop()
    got = taken()
    assert sorted(r.id for r in got) == [1, 2, 2, 3, 4]
    assert all((r.expired_at - r.arrived_at).total_seconds() >= 3 for r in got)
    first, = (r for r in got if r.id == 1)
    assert (first.name, first.ts, first.seen) == rows[0][1:]
    assert first.arrived_at <= min(r.arrived_at for r in got if r.id == 4)


def test_pages_that_come_again_are_not_stored(spark, tmp_path):
    incoming, stored = str(tmp_path / "pages"), str(tmp_path / "history")
    pages = [observations(spark, 0, 30), observations(spark, 20, 30), observations(spark, 0, 30), observations(spark, 50, 5)]
    state = []
    for page in pages:
        page.write.mode("append").json(incoming)
        rows = spark.readStream.schema(OBS_RAW).json(incoming)
        query = drain(jobs.append_history(jobs.unrepeated(rows, delay="2 days"), stored), tmp_path / "c")
        state.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = spark.read.schema(OBS_RAW).json(stored)
    assert sorted(r.ts for r in got.collect()) == [1.6e9 + i * 1800 for i in range(55)]
    assert max(state) <= 100


def test_keyed_messages(spark, tmp_path):
    messages = observation_messages(observations(spark, 0, 3), keyed=True)
    assert {r.key for r in messages.collect()} == {"st_0", "st_1", "st_2"}
    topic = FolderTopic(str(tmp_path / "out"))
    publish(topic, messages)
    assert spark.read.text(topic.path).count() == 3


def test_kafka_options():
    topic = KafkaTopic("weather", "broker:9092")
    assert topic.reader_options("latest", 20) == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "weather",
        "startingOffsets": "latest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "20"}
    assert "maxOffsetsPerTrigger" not in topic.reader_options("earliest", None)
    timed = topic.reader_options("earliest", since=1.5)
    assert timed["startingTimestamp"] == "1500" and "startingOffsets" not in timed
    with pytest.raises(ValueError):
        topic.reader_options("latest", limit_bytes=5)
