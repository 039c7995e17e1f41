"""From history documents to a trained model, and from live messages to forecasts on the map."""

import json
import random

from obsflow.constants import STATIONS
from obsflow.functions.weather import kelvin_to_celsius, temp_band
from obsflow.operators.aggregates import fit_viewport, place_on_map, viewport_bounds
from obsflow.operators.messages import decode_messages
from obsflow.operators.models import load_model
from obsflow.operators.stations import default_stations, with_coordinates
from obsflow.plans.offline import build_training_files, train
from obsflow.schemas import FORECAST, OBS_RAW
from obsflow.sources import files
from obsflow.sources.archive import KeyedArchive
from obsflow.sources.messages import (
    FolderTopic, observation_messages, publish, read_observation_stream, replay_forecasts,
)
from obsflow.streaming import jobs
from pyspark.sql import functions as F

CONDITIONS = ["Clear", "Clouds", "Mist", "Haze", "Smoke", "Fog", "Drizzle", "Rain", "Thunderstorm", "Snow"]


def document(rng, lat, lon, hours=60):
    hourly = [{
        "dt": 1633046400 + h * 3600, "temp": 280 + 8 * rng.random(), "feels_like": 279.0,
        "pressure": rng.randint(1000, 1030), "humidity": rng.randint(10, 100),
        "weather": [{"main": c} for c in rng.sample(CONDITIONS, rng.choice([1, 1, 1, 2]))],
    } for h in range(hours)]
    return {"lat": lat, "lon": lon, "timezone": "Europe/Rome", "current": {"dt": 0}, "hourly": hourly}


def test_whole_path(spark, tmp_path):
    rng = random.Random(5)
    folder = tmp_path / "documents"
    folder.mkdir()
    rows = {}
    for name, lat, lon in STATIONS:
        content = document(rng, lat, lon)
        rows[name] = sum(len(h["weather"]) for h in content["hourly"])
        (folder / f"{name}.json").write_text(json.dumps(content))
    build_training_files(spark, str(folder), str(tmp_path / "training"))
    table = files.read_csv(spark, str(tmp_path / "training"), key="name")
    counts = {r.name: r["count"] for r in table.groupBy("name").count().collect()}
    assert counts == {name: n - 3 for name, n in rows.items()}

    train(table, str(tmp_path / "model"), max_iter=2)
    model = load_model(str(tmp_path / "model"))

    live = with_coordinates(
        spark.createDataFrame(
            [(name, 1.634375358e9 + i) for i, (name, _, _) in enumerate(STATIONS)],
            "name string, ts double"),
        default_stations(spark), salt_by=("ts",),
    ).select(
        "name", "ts", "lon", "lat", F.lit(285.0).alias("temp"), F.lit(284.0).alias("tempfelt"),
        F.lit(1010.0).alias("pressure"), F.lit(60.0).alias("humidity"), F.lit("Haze").alias("weather"),
    )
    incoming, outgoing = FolderTopic(str(tmp_path / "in")), FolderTopic(str(tmp_path / "out"))
    publish(incoming, observation_messages(live.select(*OBS_RAW.fieldNames()), style="wire"))
    stream = read_observation_stream(spark, incoming)
    archive = KeyedArchive(
        spark, str(tmp_path / "archive"), decode_messages(stream).schema, order=("ts", "temp"))
    handle = jobs.fan_out(archive, model, jobs.emit_to_topic(outgoing))
    query = jobs.start(stream.writeStream.foreachBatch(handle), str(tmp_path / "c1"), once=True)
    assert query.awaitTermination(120)
    assert archive.read().count() == 20

    replay = replay_forecasts(spark, outgoing).select(F.from_json("value", FORECAST).alias("f"))
    shown = str(tmp_path / "shown")
    query = jobs.start(
        replay.select("f.*").writeStream.format("parquet").option("path", shown),
        str(tmp_path / "c2"), once=True)
    assert query.awaitTermination(120)
    points = spark.read.parquet(shown)
    placed = place_on_map(points, fit_viewport(viewport_bounds(points), 620, 700))
    drawn = placed.withColumn("colour", temp_band("cweather", kelvin_to_celsius("ctemp"))).collect()
    assert len(drawn) == 20
    assert all(0 <= r.x <= 620 and 0 <= r.y <= 700 for r in drawn)
    assert {r.colour for r in drawn} == {"#a1887f"}, "Haze counts as Fog, 11.85 degrees"
    assert {r.fweather for r in drawn} <= {"Clear", "Clouds", "Fog", "Rain", "Snow"}
