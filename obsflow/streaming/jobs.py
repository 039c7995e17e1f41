"""The live path: messages in, archive and forecasts out.

All queries recover from their checkpoint. Work done in ``foreachBatch`` writes to a folder
named by the batch, or merges by key, so a batch run again after a failure replaces its first,
partial run.
"""

from __future__ import annotations

import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from obsflow.constants import BATCH_INTERVAL, POINT_LIFETIME_SECONDS
from obsflow.functions.messages import encode_forecast
from obsflow.functions.weather import event_time, hour_of_epoch, merge_weather
from obsflow.operators.messages import decode_messages, parse_messages, to_observations
from obsflow.operators.models import forecast_columns, score
from obsflow.sources.archive import KeyedArchive
from obsflow.sources.files import station_bucket


def start(writer: DataStreamWriter, checkpoint: str, once: bool = False,
          interval: str = BATCH_INTERVAL) -> StreamingQuery:
    """Start on an interval, or ``once`` for all data there is now."""
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def skip_empty(handle):
    """A ``foreachBatch`` function that leaves empty batches alone."""
    def guarded(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            handle(batch, batch_id)
    return guarded


def forecasts(observations: DataFrame, forecaster: PipelineModel, hour_offset: float = 0):
    """Decoded observations, batch or streaming, to forecast rows.

    The models get the hour they were trained with, plain UTC; ``hour_offset`` 2 feeds them the
    archived hour instead.
    """
    timed = observations.withColumn("hour", hour_of_epoch("ts", hour_offset))
    return forecast_columns(score(timed, forecaster))


def score_stream(messages: DataFrame, forecaster: PipelineModel, hour_offset: float = 0):
    """Streaming messages to streaming forecasts; no state."""
    return forecasts(decode_messages(messages), forecaster, hour_offset)


def fan_out(archive: KeyedArchive, forecaster: PipelineModel, emit, reject=None,
            hour_offset: float = 0, report=None):
    """Parse a batch once, archive every observation, then score and emit what can be scored.

    ``emit(messages, batch_id)`` writes forecast messages and ``reject`` the messages that could
    not be read. Archived rows include classes the models do not know; forecasts do not. The
    batch's figures are observed in the one pass that parses and keeps it: nothing is archived where
    no message could be read, nothing emitted where no row has a known class, and nothing rejected
    where all could be read.
    ``report(batch_id, figures)`` gets them: messages, rejected, scored and partitions (touched).
    """
    known = F.col("rejected").isNull() & merge_weather("weather").isin(*forecaster.stages[0].labels)

    def handle(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        parsed = parse_messages(batch).observe(
            seen, F.count(F.lit(1)).alias("messages"),
            F.count_if(F.col("rejected").isNotNull()).alias("rejected"), F.count_if(known).alias("scored"),
        ).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            parsed.write.format("noop").mode("overwrite").save()
            figures = seen.get | {"partitions": 0}
            observations = to_observations(parsed.filter("rejected is null").drop("rejected"))
            if figures["messages"] > figures["rejected"]:
                figures["partitions"] = archive.upsert(observations)
            if figures["scored"]:
                scored = forecasts(observations, forecaster, hour_offset)
                emit(scored.select(encode_forecast().alias("value")), batch_id)
            if reject and figures["rejected"]:
                broken = parsed.filter("rejected is not null")
                reject(broken.select(F.col("rejected").alias("value")), batch_id)
            if report:
                report(batch_id, figures)
        finally:
            parsed.unpersist()
    return handle


def emit_to_folder(path: str, writer: str | None = None):
    """Emit to a folder per writer and batch; ``writer`` defaults to the streaming query's id."""
    def emit(messages: DataFrame, batch_id: int) -> None:
        query = messages.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        who = writer or query or "batch"
        messages.write.mode("overwrite").text(f"{path}/writer={who}/batch_id={batch_id}")
    return emit


def upsert_to(archive: KeyedArchive):
    """A ``foreachBatch`` function that archives batches; an empty one touches nothing."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        archive.upsert(batch)
    return handle


def emit_to_topic(topic):
    """Emit to a topic, at least once: a batch run again is sent again."""
    def emit(messages: DataFrame, batch_id: int) -> None:
        topic.write(messages)
    return emit


def running_latest(observations: DataFrame, keys, order) -> DataFrame:
    """Streaming latest row per key, for update mode. State is one row per key."""
    rest = [c for c in observations.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return observations.groupBy(*keys).agg(last).select(*keys, "_last.*")


def active_points(points: DataFrame, as_of, time: str = "ts",
                  lifetime: float = POINT_LIFETIME_SECONDS) -> DataFrame:
    """Points that arrived up to ``as_of`` and are younger than ``lifetime`` seconds.

    Over the files a stream of points appends to, this is the set on show. A newer point does not replace an older one of its station.
    """
    as_of = as_of if not isinstance(as_of, (int, float)) else F.lit(float(as_of))
    return points.filter((F.col(time) <= as_of) & (F.col(time) > as_of - F.lit(float(lifetime))))


def stamp_arrival(points: DataFrame, time: str = "event_time") -> DataFrame:
    """Points with their time of arrival, which never goes back: none of them is ever late."""
    return points.withColumn(time, F.current_timestamp())


def expired_points(points: DataFrame, time: str = "event_time",
                   lifetime: float = POINT_LIFETIME_SECONDS, lateness: float = 0) -> DataFrame:
    """Streaming form: each point once, with ``expired_at``, when its lifetime is over.

    The state holds one plain row per point on show, spread by point. Append mode emits a point
    when the latest ``time``, less ``lateness`` seconds, reaches its end. A point may arrive up to
    ``lifetime + lateness`` seconds after a newer one; what comes later than that is over already
    and is left out. With ``stamp_arrival`` nothing is.
    """
    end = (F.col(time) + F.make_dt_interval(secs=F.lit(lifetime))).alias("expired_at")
    others = [c for c in points.columns if c != time]
    timed = points.select(*others, F.unix_micros(time).alias("_at"), end)
    shown = timed.withWatermark("expired_at", f"{lifetime + lateness} seconds")
    ended = shown.groupBy("expired_at", *others, "_at").agg(F.count(F.lit(1)).alias("copies"))
    return ended.select(*others, F.timestamp_micros("_at").alias(time), "copies", "expired_at")


#: Groups that points on show are spread over, whatever their stations.
POINT_SHARES = 64
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def points_from_arrival(points: DataFrame, lifetime: float = POINT_LIFETIME_SECONDS,
                        shares: int = POINT_SHARES) -> DataFrame:
    """Streaming form by the clock: each point once, with ``arrived_at`` and ``expired_at``, when
    ``lifetime`` seconds are over since it arrived, however old it is; none is late.

    State is the points on show, dealt over ``shares`` groups by their content, with a
    processing-time timer each; on an interval trigger timers also fire when nothing arrives. Time
    of arrival is that of the micro-batch.
    """
    span = int(lifetime * 1000)
    options = {"timestampFormat": _MICROS}
    packed = points.select(F.to_json(F.struct("*"), options).alias("point")).withColumn(
        "share", F.pmod(F.xxhash64("point"), F.lit(shares)).cast("int"))

    def hold(key, pages, state):
        held, ends = map(list, state.get if state.exists else ((), ()))
        now = state.getCurrentProcessingTimeMs()
        for page in pages:
            held += page["point"].tolist()
            ends += [now + span] * len(page)
        left = [(p, e) for p, e in zip(held, ends) if e > now]
        gone = [(p, e, now) for p, e in zip(held, ends) if e <= now]
        if left:
            state.update(tuple(map(list, zip(*left))))
            state.setTimeoutDuration(max(1, min(e for _, e in left) - now))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(gone, columns=["point", "ends", "now"]).astype({"point": object, "ends": "int64", "now": "int64"})

    ended = packed.groupBy("share").applyInPandasWithState(
        hold, "point string, ends long, now long", "points array<string>, ends array<bigint>", "append",
        "ProcessingTimeTimeout")
    point = F.from_json("point", points.schema, options)
    return ended.select(point.alias("_p"), F.timestamp_millis(F.col("ends") - span).alias("arrived_at"),
                        F.timestamp_millis("now").alias("expired_at")).select("_p.*", "arrived_at", "expired_at")


def unrepeated(rows: DataFrame, keys=("name", "ts", "weather"), delay: str = "60 days") -> DataFrame:
    """Streaming rows without those that repeat an earlier one's ``keys``, so that a page that comes
    again never reaches the stored history.

    State is one key per row of the last ``delay`` by the newest observation. What is older than
    that is late and left out, so ``delay`` must exceed the age of the oldest page that may come.
    """
    timed = rows.withColumn("_time", event_time("ts")).withWatermark("_time", delay)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_time")


#: Files a batch writes to each folder that stations share.
FOLDER_SHARES = 4


def append_history(rows: DataFrame, path: str, key: str = "name", buckets: int | None = None) -> DataStreamWriter:
    """Append a stream of rows to JSON lines in folders per station, each batch exactly once.

    With ``buckets``, stations share that many folders and a batch writes at most ``FOLDER_SHARES``
    files to each, whatever the number of stations.
    """
    if buckets:
        share = F.pmod(F.xxhash64(*rows.columns), F.lit(FOLDER_SHARES))
        rows = rows.withColumn("bucket", station_bucket(key, buckets)).repartition("bucket", share)
        key = "bucket"
    return rows.writeStream.format("json").partitionBy(key).option("path", path)
