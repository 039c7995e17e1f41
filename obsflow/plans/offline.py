"""The offline path as one job: history documents to a training table, and models from it."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from obsflow.functions.weather import kelvin_to_celsius, merge_weather, temp_band
from obsflow.operators.flatten import flatten_history_documents
from obsflow.operators.labels import label_lag, training_table
from obsflow.operators.models import fit_forecaster, save_model
from obsflow.session import materialize
from obsflow.sources.files import dedup_history, read_history, write_csv

#: Rows of one hour keep the order of their conditions in the payload.
HISTORY_ORDER = ("ts", "condition")


def history_to_training(raw: DataFrame, max_rows=None, order=HISTORY_ORDER,
                        dedup_order=("condition",)) -> DataFrame:
    """Flattened history, possibly with pages appended twice, to training rows with ``name``.

    The rows are written once before the shift, which reads its input several times, so that
    documents are parsed and deduplicated once.
    """
    unique = materialize(dedup_history(raw, order=dedup_order))
    return training_table(unique, order=order, keep=("name",), max_rows=max_rows)


def build_training_files(spark: SparkSession, documents: str, out: str) -> None:
    raw = flatten_history_documents(read_history(spark, documents), position="condition")
    write_csv(history_to_training(raw), out)


def train(table: DataFrame, path: str, **settings) -> PipelineModel:
    """Fit on a training table and save. The table is written once, as fitting reads it often."""
    model = fit_forecaster(materialize(table), **settings)
    save_model(model, path)
    return model


def persistence_forecast(raw: DataFrame, order=("ts", "event_id"), max_rows=None) -> DataFrame:
    """Each observation with the class and temperature of three rows before, and their colours."""
    merged = raw.select(
        "name", *order, "lon", "lat", "temp", merge_weather("weather").alias("weather")
    )
    labelled = label_lag(merged, order=order, max_rows=max_rows).na.drop("any")
    celsius = {c: F.round(kelvin_to_celsius(c), 2) for c in ("temp", "temp_forecast")}
    return labelled.select(
        *order, "name", "lon", "lat", F.col("weather").alias("cweather"),
        F.col("weather_forecast").alias("fweather"), celsius["temp"].alias("celsius"),
        celsius["temp_forecast"].alias("celsius_forecast"),
    ).withColumns({
        "ccolour": temp_band("cweather", "celsius"),
        "fcolour": temp_band("fweather", "celsius_forecast"),
    })
