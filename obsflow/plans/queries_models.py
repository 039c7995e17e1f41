"""Checked queries: models and streams.

Streaming queries stage the observations as message files, run until the files are used up, and
return what the sink then holds.
"""

from __future__ import annotations

import time

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from obsflow.constants import FEATURES
from obsflow.functions.messages import encode_forecast
from obsflow.functions.weather import event_time, merge_weather, utc_hour
from obsflow.operators import models as ml
from obsflow.operators.features import index_to_label
from obsflow.operators.labels import training_table
from obsflow.operators.messages import decode_messages, to_observations
from obsflow.operators.split import hash_split
from obsflow.plans.queries_scalar import persisted_forecast
from obsflow.plans.queries_tables import STATION_BUCKETS, _LATEST_SQL
from obsflow.plans.registry import query
from obsflow.plans.testview import LAGGED_SQL, MERGED_SQL, OBS_SQL, observations
from obsflow.schemas import FORECAST, FORECAST_COLUMNS, OBS_RAW, OBS_RAW_COLUMNS
from obsflow.session import materialize, scratch_path
from obsflow.sources import files
from obsflow.sources.archive import KeyedArchive
from obsflow.sources.messages import (
    FolderTopic, observation_messages, publish, read_observation_stream, replay_forecasts,
)
from obsflow.streaming import jobs

_RAW = ", ".join(OBS_RAW_COLUMNS)
_shared: dict = {}


def _once(spark, name, sf, make):
    """Keeps one result a session and data folder, such as the training table and the model."""
    key = (spark.sparkContext.applicationId, name, sf)
    if key not in _shared:
        _shared[key] = make()
    return _shared[key]


def training_rows(spark, sf):
    """The training table, written once for all models because fitting reads it often."""
    return _once(spark, "rows", sf, lambda: materialize(
        training_table(observations(spark, sf), keep=("event_id",))))


def forecaster(spark, sf):
    """The chained model of a data folder, fitted with all rounds, once per session."""
    return _once(spark, "model", sf, lambda: ml.fit_forecaster(hash_split(training_rows(spark, sf), "event_id")[0]))


def serving_rows(spark, sf):
    """Live observations with the hour the models were trained with."""
    return to_observations(observations(spark, sf)).withColumn("hour", utc_hour("ts").cast("double"))


_IS_TRAIN = "cast(('0x' || substr(md5(cast(event_id as varchar)), 1, 8)) as bigint) % 10 < 8"
#: The rows the models are fitted on, and those held out.
_TRAIN_SQL = LAGGED_SQL + f""", complete as (select * from lagged where temp_forecast is not null),
 train as (select * from complete where {_IS_TRAIN}),
 held as (select * from complete where not {_IS_TRAIN})"""


def _held_out(rows, encoding, model, label, predicted):
    """Held-out rows with their true label and what the model says of them."""
    assembled = ml.with_features(rows, encoding)
    return model.transform(assembled).select("event_id", F.col(label).alias("truth"), predicted.alias("sound"))


@query("gbt_forecast", f"""with {_TRAIN_SQL} select event_id, temp_forecast as truth, true as sound from held
 where weather in (select weather from train)""")
def gbt_forecast(spark, sf):
    """Held-out rows; sound is a finite forecast that is near the range of the fitted labels."""
    train, test = hash_split(training_rows(spark, sf), "event_id")
    encoding = ml.fit_encoding(train)
    model = ml.fit_boosted(ml.regression_data(train, encoding))
    low, high = train.agg(F.min("temp_forecast"), F.max("temp_forecast")).first()
    rows = test.withColumn("_truth", F.col("temp_forecast")).drop("temp_forecast")
    sound = F.col("temp_forecast").between(2 * low - high, 2 * high - low)
    return _held_out(rows, encoding, model, "_truth", sound)


@query("lr_baseline", f"""with {_TRAIN_SQL} select event_id, temp_forecast as truth, true as sound from held
 where weather in (select weather from train)""")
def lr_baseline(spark, sf):
    """Held-out rows; sound is the model's own coefficients times the features, added up."""
    train, test = hash_split(training_rows(spark, sf), "event_id")
    encoding = ml.fit_encoding(train)
    model = ml.fit_linear(ml.regression_data(train, encoding))
    slots = vector_to_array(F.col(ml.REGRESSION_FEATURES))
    total = F.lit(float(model.intercept))
    for i, weight in enumerate(model.coefficients.toArray().tolist()):
        total = total + F.lit(weight) * slots[i]
    sound = F.abs(F.col("prediction") - total) < 1e-6
    return _held_out(test, encoding, model, "temp_forecast", sound)


@query("gbt_calibration", f"""with {_TRAIN_SQL} select count(*) as n,
 round(avg(temp_forecast), 6) as mean_forecast from train""")
def gbt_calibration(spark, sf):
    """Boosted trees with squared loss keep the mean of the rows they were fitted on."""
    train, _ = hash_split(training_rows(spark, sf), "event_id")
    encoding = ml.fit_encoding(train)
    data = ml.regression_data(train, encoding)
    return ml.fit_boosted(data).transform(data).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("temp_forecast"), 6).alias("mean_forecast")
    )


@query("lr_normal_equations", f"""with {_TRAIN_SQL} select count(*) as n,
 cast(0 as double) as residual, cast(0 as double) as with_temp, cast(0 as double) as with_hour,
 cast(0 as double) as with_lat from train""")
def lr_normal_equations(spark, sf):
    """Least squares leave residuals with mean 0 that no feature explains any further."""
    train, _ = hash_split(training_rows(spark, sf), "event_id")
    encoding = ml.fit_encoding(train)
    data = ml.regression_data(train, encoding)
    rest = F.col("label") - F.col("prediction")
    slots = vector_to_array(F.col(ml.REGRESSION_FEATURES))
    return ml.fit_linear(data).transform(data).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(rest), 4).alias("residual"),
        *[F.round(F.avg(rest * slots[i]), 4).alias(f"with_{c}")
          for c, i in (("temp", 3), ("hour", 2), ("lat", 1))],
    )


_SIDE_SQL = LAGGED_SQL + """, sides as (select event_id, cast(pressure >= 1023 as integer) as side,
 temp, weather from merged)"""


def _sides(spark, sf, features):
    """One feature of two values."""
    rows = to_observations(observations(spark, sf)).select(
        "event_id", (F.col("pressure") >= 1023).cast("int").alias("side"), "temp", "weather")
    return VectorAssembler(inputCols=["side"], outputCol=features).transform(rows)


@query("boosted_stump", f"""with {_SIDE_SQL} select event_id, side,
 round(avg(temp) over (partition by side), 6) as forecast from sides""")
def boosted_stump(spark, sf):
    """One round of depth one on a feature of two values forecasts the mean of each side."""
    rows = materialize(_sides(spark, sf, ml.REGRESSION_FEATURES))
    data = rows.select(ml.REGRESSION_FEATURES, F.col("temp").alias("label"))
    model = ml.fit_boosted(data, max_iter=1, max_depth=1)
    return model.transform(rows).select("event_id", "side", F.round("temp_forecast", 6).alias("forecast"))


@query("tree_stump", f"""with {_SIDE_SQL}, counts as (select side, weather, count(*) as n from sides group by all),
 best as (select side, max(n) as n from counts group by side)
 select event_id, side, best.n as share from sides join best using (side)""")
def tree_stump(spark, sf):
    """A tree of depth one on such a feature predicts a most frequent class of each side."""
    rows = materialize(_sides(spark, sf, ml.CLASSIFICATION_FEATURES))
    labels = ml.fit_label_indexer(rows.withColumnRenamed("weather", "weather_forecast"))
    indexed = labels.transform(rows.withColumn("weather_forecast", F.col("weather")))
    model = ml.fit_tree(indexed.select(ml.CLASSIFICATION_FEATURES, ml.LABEL_INDEX), max_depth=1)
    named = index_to_label(labels.labels, "class_prediction").transform(model.transform(rows))
    counts = rows.groupBy("side", F.col("weather").alias("predicted_label")).agg(F.count(F.lit(1)).alias("share"))
    return named.select("event_id", "side", "predicted_label").join(
        counts, ["side", "predicted_label"]).select("event_id", "side", "share")


_CELL_SQL = LAGGED_SQL + """, cells as (select event_id, temp, weather,
 concat(cast(pressure >= 1023 as integer), cast(humidity >= 55 as integer),
  cast(floor(ts % 86400 / 3600) >= 12 as integer), cast(lon >= 12.5 as integer)) as cell from merged)"""


def _cells(spark, sf, features):
    """Four features of two values: 16 cells, which a tree of depth five can tell apart."""
    rows = to_observations(observations(spark, sf))
    bits = {"high": F.col("pressure") >= 1023, "damp": F.col("humidity") >= 55,
            "late": utc_hour("ts") >= 12, "east": F.col("lon") >= 12.5}
    rows = rows.select("event_id", "temp", "weather", *[b.cast("int").alias(c) for c, b in bits.items()])
    rows = rows.withColumn("cell", F.concat(*[F.col(c).cast("string") for c in bits]))
    return materialize(VectorAssembler(inputCols=list(bits), outputCol=features).transform(rows))


@query("boosted_cells", f"""with {_CELL_SQL} select event_id, cell,
 round(avg(temp) over (partition by cell), 6) as forecast from cells""")
def boosted_cells(spark, sf):
    """The forecast of one round at full depth, which is the mean of the rows in the same leaf."""
    rows = _cells(spark, sf, ml.REGRESSION_FEATURES)
    model = ml.fit_boosted(rows.select(ml.REGRESSION_FEATURES, F.col("temp").alias("label")), max_iter=1)
    return model.transform(rows).select("event_id", "cell", F.round("temp_forecast", 6).alias("forecast"))


@query("tree_cells", f"""with {_CELL_SQL}, seen as (select weather, count(*) as n from cells group by 1),
 ranked as (select weather, row_number() over (order by n desc, weather) as place from seen),
 votes as (select cell, weather, count(*) as n from cells group by all),
 winners as (select cell, weather from votes join ranked using (weather)
  qualify row_number() over (partition by cell order by votes.n desc, place) = 1)
 select event_id, cell, winners.weather as predicted_label from cells join winners using (cell)""")
def tree_cells(spark, sf):
    """The class a tree of full depth names, which is the most frequent one in the same leaf."""
    rows = _cells(spark, sf, ml.CLASSIFICATION_FEATURES).withColumn("weather_forecast", F.col("weather"))
    labels = ml.fit_label_indexer(rows)
    model = ml.fit_tree(labels.transform(rows).select(ml.CLASSIFICATION_FEATURES, ml.LABEL_INDEX))
    named = index_to_label(labels.labels, "class_prediction").transform(model.transform(rows))
    return named.select("event_id", "cell", "predicted_label")


@query("lr_one_feature", f"""with {LAGGED_SQL} select round(regr_slope(temp_forecast, temp), 6) as slope,
 round(regr_intercept(temp_forecast, temp), 4) as intercept from lagged where temp_forecast is not null""")
def lr_one_feature(spark, sf):
    rows = training_table(observations(spark, sf))
    data = VectorAssembler(inputCols=["temp"], outputCol=ml.REGRESSION_FEATURES).transform(rows)
    model = ml.fit_linear(data.select(ml.REGRESSION_FEATURES, F.col("temp_forecast").alias("label")))
    return spark.range(1).select(
        F.round(F.lit(float(model.coefficients[0])), 6).alias("slope"),
        F.round(F.lit(float(model.intercept)), 4).alias("intercept"),
    )


@query("dt_forecast", f"""with {_TRAIN_SQL} select event_id, weather_forecast as truth, true as sound from held
 where weather in (select weather from train)""")
def dt_forecast(spark, sf):
    """Held-out rows; sound is a predicted class that the training labels have."""
    train, test = hash_split(training_rows(spark, sf), "event_id")
    encoding, labels = ml.fit_encoding(train), ml.fit_label_indexer(train)
    model = ml.fit_tree(ml.classification_data(train, encoding, labels))
    sound = F.col("class_prediction").isin(*map(float, range(len(labels.labels))))
    return _held_out(test, encoding, model, "weather_forecast", sound)


def forecast_by_parts(spark, rows, chain, temperature="temp_forecast"):
    """event_id, part_temp and part_label, without the chain's own columns: features put together by
    hand, stage one written and joined back by event_id, ``temperature`` given to the classifier."""
    indexer, boosted, tree, names = (chain.stages[i] for i in (0, 3, 5, 6))
    slots = [f"_slot{i}" for i in range(len(indexer.labels) - 1)]
    known = ml.worked_out(rows).filter(F.col("weather").isin(*indexer.labels)).withColumns(
        {slot: (F.col("weather") == label).cast("double") for slot, label in zip(slots, indexer.labels)})
    first = VectorAssembler(inputCols=[*FEATURES, *slots], outputCol=ml.REGRESSION_FEATURES).transform(known)
    path = scratch_path(spark, "stage-one")
    boosted.transform(first).select("event_id", "temp_forecast").write.parquet(path)
    fed = known.join(spark.read.parquet(path), "event_id")
    second = VectorAssembler(inputCols=[*FEATURES, temperature, *slots], outputCol=ml.CLASSIFICATION_FEATURES).transform(fed)
    label = F.element_at(F.array(*map(F.lit, names.getLabels())), F.col("class_prediction").cast("int") + 1)
    return tree.transform(second).select("event_id", F.col("temp_forecast").alias("part_temp"), label.alias("part_label"))


@query("two_stage_forecast", f"""with {_TRAIN_SQL} select event_id, weather, temp, true as same from merged
 where weather in (select weather from train)""")
def two_stage_forecast(spark, sf):
    """Whether the chain says of each row what its parts say, put together by hand."""
    rows, chain = serving_rows(spark, sf), forecaster(spark, sf)
    both = ml.score(rows, chain).join(forecast_by_parts(spark, rows, chain), "event_id")
    same = (F.col("temp_forecast") == F.col("part_temp")) & (F.col("predicted_label") == F.col("part_label"))
    return both.select("event_id", "weather", "temp", same.alias("same"))


@query("model_roundtrip", f"""with {_TRAIN_SQL} select event_id, true as same from merged
 where weather in (select weather from train)""")
def model_roundtrip(spark, sf):
    """Whether the saved and loaded model says the same of every row it scores."""
    path = scratch_path(spark, "model")
    ml.save_model(forecaster(spark, sf), path)
    rows = serving_rows(spark, sf)
    first = ml.score(rows, forecaster(spark, sf))
    second = ml.score(rows, ml.load_model(path)).select(
        "event_id", F.struct("predicted_label", "temp_forecast").alias("loaded")
    )
    kept = F.struct("predicted_label", "temp_forecast") == F.col("loaded")
    return first.join(second, "event_id").select("event_id", kept.alias("same"))


# ---- streams ---------------------------------------------------------------------------------

def staged_observations(spark, sf) -> FolderTopic:
    topic = FolderTopic(scratch_path(spark, "messages"))
    publish(topic, observation_messages(observations(spark, sf), style="wire"))
    return topic


def drain(writer, checkpoint):
    jobs.start(writer, checkpoint, once=True).awaitTermination()


def run_to_parquet(spark, stream, label, mode="append"):
    """Run a stream over all staged data into Parquet files and read them."""
    out = scratch_path(spark, label)
    writer = stream.writeStream.outputMode(mode).format("parquet").option("path", out)
    drain(writer, scratch_path(spark, f"{label}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)


@query("publish_obs", f"with {OBS_SQL} select {_RAW} from obs")
def publish_obs(spark, sf):
    topic = FolderTopic(scratch_path(spark, "published"))
    publish(topic, observation_messages(observations(spark, sf)))
    written = spark.read.text(topic.path)
    return written.select(F.from_json("value", OBS_RAW).alias("o")).select("o.*")


@query("stream_read_obs", f"with {MERGED_SQL} select {_RAW}, hour from merged")
def stream_read_obs(spark, sf):
    messages = read_observation_stream(spark, staged_observations(spark, sf))
    return run_to_parquet(spark, decode_messages(messages), "stream-obs")


_FORECAST_MESSAGES_SQL = f"""with {LAGGED_SQL} select lon, lat, weather as cweather,
 weather_forecast as fweather, temp as ctemp, temp_forecast as ftemp from lagged
 where temp_forecast is not null"""
_FORECAST_TYPE = FORECAST.simpleString()


def staged_forecasts(spark, sf) -> FolderTopic:
    topic = FolderTopic(scratch_path(spark, "forecasts"))
    rows = ml.forecast_columns(persisted_forecast(spark, sf))
    publish(topic, rows.select(encode_forecast().alias("value")))
    return topic


@query("stream_replay_forecast", _FORECAST_MESSAGES_SQL)
def stream_replay_forecast(spark, sf):
    messages = replay_forecasts(spark, staged_forecasts(spark, sf))
    parsed = messages.select(F.from_json("value", _FORECAST_TYPE).alias("f")).select("f.*")
    return run_to_parquet(spark, parsed, "replayed")


@query("stream_replay_since", f"""with {LAGGED_SQL} select lon, lat, weather as cweather,
 weather_forecast as fweather, temp as ctemp, temp_forecast as ftemp from lagged
 where temp_forecast is not null and event_id % 2 = 1""")
def stream_replay_since(spark, sf):
    """Replay from a time between two publications; what was published before is left out."""
    topic = FolderTopic(scratch_path(spark, "forecasts"))
    rows = persisted_forecast(spark, sf)
    for part in (0, 1):
        if part:  # by the clock of the folder's own files, which may count whole seconds
            last = spark.read.text(topic.path).agg(F.max(F.unix_micros("_metadata.file_modification_time"))).first()[0]
            since = last / 1_000_000 + 0.001
            time.sleep(1.1)
        publish(topic, ml.forecast_columns(rows.filter(F.col("event_id") % 2 == part)).select(encode_forecast().alias("value")))
    messages = replay_forecasts(spark, topic, since=since)
    parsed = messages.select(F.from_json("value", _FORECAST_TYPE).alias("f")).select("f.*")
    return run_to_parquet(spark, parsed, "replayed-since")


@query("stream_write_forecast", _FORECAST_MESSAGES_SQL)
def stream_write_forecast(spark, sf):
    messages = replay_forecasts(spark, staged_forecasts(spark, sf))
    topic = FolderTopic(scratch_path(spark, "forecast-topic"))
    drain(topic.stream_writer(messages), scratch_path(spark, "forecast-checkpoint"))
    return spark.read.text(topic.path).select(
        F.from_json("value", _FORECAST_TYPE).alias("f")
    ).select("f.*")


def _as_scored(spark, sf, rows):
    """Counts of equal forecasts by what was observed, and whether a batch score gives the same."""
    batch = jobs.forecasts(observations(spark, sf).withColumn("weather", merge_weather("weather")), forecaster(spark, sf))
    seen, all_ = ("lon", "lat", "cweather", "ctemp"), FORECAST_COLUMNS
    got = rows.groupBy(*all_).agg(F.count(F.lit(1)).alias("n"))
    want = batch.groupBy(*all_).agg(F.count(F.lit(1)).alias("_n"))
    both = got.join(want, list(all_), "left").withColumn("same", F.coalesce(F.col("n") == F.col("_n"), F.lit(False)))
    return both.groupBy(*seen).agg(F.sum("n").alias("n"), F.bool_and("same").alias("same"))


_AS_SCORED_SQL = f"""with {_TRAIN_SQL} select lon, lat, weather as cweather, temp as ctemp, count(*) as n,
 true as same from merged where weather in (select weather from train) group by all"""


@query("stream_score", _AS_SCORED_SQL)
def stream_score(spark, sf):
    """Forecasts of a stream equal the batch forecasts of the same observations."""
    messages = read_observation_stream(spark, staged_observations(spark, sf))
    scored = run_to_parquet(spark, jobs.score_stream(messages, forecaster(spark, sf)), "scored")
    return _as_scored(spark, sf, scored)


#: Files that each part of a staged stream is written as, and taken in as one batch.
PART_FILES = 3
#: Order of archived rows that carry no row number: later first, then by every value.
MESSAGE_ORDER = ("ts", "temp", "tempfelt", "pressure", "humidity", "weather", "lon", "lat")


@query("stream_fanout", _AS_SCORED_SQL)
def stream_fanout(spark, sf):
    """Forecasts of the live path equal the batch forecasts; ``stream_archive`` checks the archive."""
    forecasts, _ = run_fanout(spark, sf)
    return _as_scored(spark, sf, forecasts)


@query("stream_batch_figures", f"""with {_TRAIN_SQL} select cast(event_id % 3 as bigint) as batch,
 count(*) as messages, count(*) filter (event_id % 50 = 0) as rejected,
 count(*) filter (event_id % 50 <> 0 and weather in (select weather from train)) as scored
 from merged group by 1""")
def stream_batch_figures(spark, sf):
    """What each batch read, could not read and scored, observed by the live path as it runs."""
    topic = FolderTopic(scratch_path(spark, "messages"))
    obs = observations(spark, sf)
    for part in range(3):
        mine = obs.filter(F.col("event_id") % 3 == part)
        broken = mine.filter("event_id % 50 = 0").select(F.concat(F.lit("{"), "name").alias("value"))
        whole = observation_messages(mine.filter("event_id % 50 <> 0"), style="wire")
        publish(topic, whole.union(broken).repartition(PART_FILES))
    figures, taken = [], read_observation_stream(spark, topic, limit=PART_FILES)
    archive = KeyedArchive(spark, scratch_path(spark, "archive"), decode_messages(taken).schema, order=MESSAGE_ORDER)
    handle = jobs.fan_out(
        archive, forecaster(spark, sf), jobs.emit_to_folder(scratch_path(spark, "emitted")),
        report=lambda batch_id, seen: figures.append((batch_id, seen["messages"], seen["rejected"], seen["scored"])))
    drain(taken.writeStream.foreachBatch(handle), scratch_path(spark, "figures-checkpoint"))
    return spark.createDataFrame(figures, "batch bigint, messages bigint, rejected bigint, scored bigint")


@query("stream_fanout_rows", f"""with {_TRAIN_SQL} select lon, lat, weather as cweather, temp as ctemp
 from merged where weather in (select weather from train)""")
def stream_fanout_rows(spark, sf):
    """The observed half of the forecasts: each row of a known class is forecast once."""
    forecasts, _ = run_fanout(spark, sf)
    return forecasts.select("lon", "lat", "cweather", "ctemp")


@query("stream_archive", f"""with {MERGED_SQL} select name, hour, ts, lon, lat, temp, tempfelt, pressure,
 humidity, weather from merged qualify row_number() over (partition by name, hour order by ts desc,
 temp desc, tempfelt desc, pressure desc, humidity desc, weather desc) = 1""")
def stream_archive(spark, sf):
    _, archive = run_fanout(spark, sf)
    return archive.read().select(
        "name", "hour", "ts", "lon", "lat", "temp", "tempfelt", "pressure", "humidity", "weather"
    )


def run_fanout(spark, sf):
    messages = read_observation_stream(spark, staged_observations(spark, sf), limit=8)
    schema = decode_messages(messages).schema
    archive = KeyedArchive(spark, scratch_path(spark, "archive"), schema, order=MESSAGE_ORDER)
    out = scratch_path(spark, "emitted")
    handle = jobs.fan_out(archive, forecaster(spark, sf), jobs.emit_to_folder(out))
    drain(messages.writeStream.foreachBatch(handle), scratch_path(spark, "fanout-checkpoint"))
    parsed = spark.read.text(out).select(F.from_json("value", _FORECAST_TYPE).alias("f"))
    return parsed.select("f.*"), archive


def observation_stream(spark, sf):
    """The observations, row numbers included, as a stream of JSON files."""
    path = scratch_path(spark, "rows")
    rows = observations(spark, sf)
    rows.write.json(path)
    return spark.readStream.schema(rows.schema).json(path)


@query("stream_upsert", _LATEST_SQL)
def stream_upsert(spark, sf):
    rows = to_observations(observation_stream(spark, sf)).select(
        "event_id", "name", "hour", "ts", "temp", "weather"
    )
    archive = KeyedArchive(spark, scratch_path(spark, "running"), rows.schema)
    running = jobs.running_latest(rows, archive.keys, archive.order)
    writer = running.writeStream.outputMode("update").foreachBatch(jobs.upsert_to(archive))
    drain(writer, scratch_path(spark, "running-checkpoint"))
    return archive.read()


#: Events lie minutes apart, so the queries show points for two days instead of 90 seconds.
LIFETIME = 172800


@query("active_points", f"""with {OBS_SQL} select event_id, name, ts, lon, lat from obs
 where ts <= 1705276800 and ts > 1705276800 - {LIFETIME}""")
def active_points(spark, sf):
    shown = jobs.active_points(observations(spark, sf), 1705276800, lifetime=LIFETIME)
    return shown.select("event_id", "name", "ts", "lon", "lat")


#: How much later than the newest point others may come, in the stream below.
LATENESS = 864000


def point_stream(spark, sf):
    """Points as three parts read one by one; the last one is older than the second."""
    path = scratch_path(spark, "points")
    points = observations(spark, sf).select(
        "event_id", "name", "ts", "lon", "lat", event_time("ts").alias("event_time"))
    newest = F.lit(1706659200)
    for days in ((11, 1000), (-1000, 5), (5, 11)):
        age = (newest - F.col("ts")) / 86400
        points.filter((age >= days[0]) & (age < days[1])).repartition(
            PART_FILES).write.mode("append").parquet(path)
    return spark.readStream.schema(points.schema).option("maxFilesPerTrigger", PART_FILES).parquet(path)


@query("stream_active_points", f"""with {OBS_SQL} select event_id, name, ts, lon, lat,
 ts + {LIFETIME} <= (select max(ts) from obs) - {LATENESS} as expired from obs""")
def stream_active_points(spark, sf):
    """Every point, and whether the stream has taken it off by the time of the last arrival."""
    points = point_stream(spark, sf)
    ended = run_to_parquet(spark, jobs.expired_points(points, lifetime=LIFETIME, lateness=LATENESS), "expired")
    shown = observations(spark, sf).select("event_id", "name", "ts", "lon", "lat")
    gone = ended.select("event_id", F.lit(True).alias("expired"))
    return shown.join(gone, "event_id", "left").withColumn(
        "expired", F.coalesce("expired", F.lit(False))
    )


@query("stream_visible_points", f"""with {OBS_SQL} select event_id, name, ts, lon, lat from obs
 where ts > (select max(ts) from obs) - {LIFETIME}""")
def stream_visible_points(spark, sf):
    """The points on show after the last arrival, from what a stream has appended."""
    points = run_to_parquet(spark, point_stream(spark, sf).drop("event_time"), "arrived")
    latest = points.select(F.max("ts")).scalar()
    return jobs.active_points(points, latest, lifetime=LIFETIME)


@query("stream_arrived_points", f"with {OBS_SQL} select event_id, name, ts, lon, lat from obs")
def stream_arrived_points(spark, sf):
    """Points that are taken off by the clock, two seconds after they arrived, in two arrivals.

    A row is there if its point was on show for its whole lifetime and went once, before the time
    limit of the run.
    """
    path, out, lifetime = scratch_path(spark, "points"), scratch_path(spark, "taken-off"), 2
    points = observations(spark, sf).select("event_id", "name", "ts", "lon", "lat")
    points.filter("event_id % 2 = 0").write.mode("append").json(path)
    stream = spark.readStream.schema(points.schema).json(path)
    ended = jobs.points_from_arrival(stream, lifetime).writeStream.format("parquet").option("path", out)
    running = jobs.start(ended, scratch_path(spark, "taken-off-checkpoint"), interval="1 second")
    limit, arrived, total = time.time() + 120, False, points.count()
    try:  # timers keep the query busy, so it never counts as having processed all
        while running.isActive and time.time() < limit:
            time.sleep(0.3)
            progress = running.recentProgress
            if not arrived and any(p.numInputRows for p in progress):
                points.filter("event_id % 2 = 1").write.mode("append").json(path)
                arrived = True
            if sum(p.numInputRows for p in progress) == total and not progress[-1]["stateOperators"][0]["numRowsTotal"]:
                break
    finally:
        running.stop()
    shown = spark.read.schema(jobs.points_from_arrival(stream, lifetime).schema).parquet(out)
    whole = F.unix_millis("expired_at") >= F.unix_millis("arrived_at") + 1000 * lifetime
    return shown.filter(whole).select("event_id", "name", "ts", "lon", "lat")


@query("append_history_stream", f"with {OBS_SQL} select distinct name, ts, weather from obs")
def append_history_stream(spark, sf):
    """Two pages that overlap and the first one again, appended through a stream: what is stored."""
    incoming, stored, checkpoint = (scratch_path(spark, label) for label in ("pages", "history", "history-checkpoint"))
    obs = observations(spark, sf).select(*OBS_RAW_COLUMNS)
    first, second = obs.filter(F.col("ts") < 1705708800), obs.filter(F.col("ts") >= 1705276800)
    for page in (first, second, first):
        page.write.mode("append").json(incoming)
        rows = spark.readStream.schema(OBS_RAW).json(incoming)
        drain(jobs.append_history(jobs.unrepeated(rows), stored, buckets=STATION_BUCKETS), checkpoint)
    return files.read_json_lines(spark, stored, OBS_RAW).select("name", "ts", "weather")


@query("stream_restart", f"with {MERGED_SQL} select {_RAW} from merged")
def stream_restart(spark, sf):
    """Two runs on one checkpoint, with more messages before the second, and one without any."""
    topic = FolderTopic(scratch_path(spark, "messages"))
    out, checkpoint = scratch_path(spark, "restarted"), scratch_path(spark, "restart-checkpoint")
    obs = observations(spark, sf)
    for part in ("event_id % 2 = 0", "event_id % 2 <> 0", "false"):
        publish(topic, observation_messages(obs.filter(part), style="wire"))
        stream = decode_messages(read_observation_stream(spark, topic)).select(*OBS_RAW_COLUMNS)
        drain(stream.writeStream.format("parquet").option("path", out), checkpoint)
    return spark.read.parquet(out)


@query("stream_intake", f"""with {OBS_SQL} select cast(event_id % 4 as bigint) as batch, count(*) as n,
 cast(3 as bigint) as files from obs group by 1""")
def stream_intake(spark, sf):
    """Four parts of three files under a limit of three files a batch: what each batch took in."""
    topic = FolderTopic(scratch_path(spark, "messages"))
    obs = observations(spark, sf)
    for part in range(4):
        publish(topic, observation_messages(obs.filter(F.col("event_id") % 4 == part)).repartition(PART_FILES))
    taken = scratch_path(spark, "taken")

    def keep(batch, batch_id):
        batch.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("append").parquet(taken)

    stream = read_observation_stream(spark, topic, limit=PART_FILES).select("value", F.col("_metadata.file_path").alias("file"))
    drain(stream.writeStream.foreachBatch(keep), scratch_path(spark, "intake-checkpoint"))
    return spark.read.parquet(taken).groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("file").alias("files"))
