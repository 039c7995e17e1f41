"""Shifted training labels.

``*_forecast`` labels come in four forms: three rows earlier (the form existing training data
carries), three rows later, three hours later by the hour, and three hours later by time with gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from obsflow.constants import LABEL_SHIFT_ROWS
from obsflow.functions.weather import merge_weather, utc_hour
from obsflow.operators.ordered import fill_forward, join_unique, shift_rows
from obsflow.schemas import TRAIN_COLUMNS

_LABELS = {"weather_forecast": "weather", "temp_forecast": "temp"}


def label_lag(df: DataFrame, rows: int = LABEL_SHIFT_ROWS, outputs=None, keys=("name",),
              order=("ts", "event_id"), max_rows=None) -> DataFrame:
    """Labels taken ``rows`` rows earlier in the station's order; all labels share one sort."""
    return shift_rows(df, outputs or _LABELS, rows, keys, order, max_rows)


def label_lead(df: DataFrame, rows: int = LABEL_SHIFT_ROWS, outputs=None, keys=("name",),
               order=("ts", "event_id"), max_rows=None) -> DataFrame:
    """Labels taken ``rows`` rows later in the station's order."""
    return shift_rows(df, outputs or _LABELS, -rows, keys, order, max_rows)


def label_at_offset(df: DataFrame, hours: int = 3, outputs=None, key: str = "name",
                    order=("ts", "event_id"), max_rows=None) -> DataFrame:
    """Labels from the last row of the hour ``hours`` later; null where that hour has no row.

    The label side is first reduced to one row per station and hour, so a hot hour is combined
    before it is shuffled and the join multiplies nothing.
    """
    outputs = outputs or _LABELS
    hour = F.floor(F.col("ts") / 3600).cast("bigint")
    last = (
        df.groupBy(key, (hour - hours).alias("_hour"))
        .agg(F.max_by(F.struct(*outputs.values()), F.struct(*order)).alias("_last"))
        .select(key, "_hour", *[F.col(f"_last.{c}").alias(o) for o, c in outputs.items()])
    )
    timed = df.withColumn("_hour", hour)
    return join_unique(timed, last, [key, "_hour"], order, max_rows=max_rows).select(
        *df.columns, *outputs
    )


def label_asof_offset(df: DataFrame, hours: float = 3, tolerance: float = 1, outputs=None, key: str = "name",
                      order=("ts", "event_id"), max_rows=None) -> DataFrame:
    """Labels from the station's newest row at or before ``hours`` later, null where that row is
    ``tolerance`` hours or more before then.

    The rows and their later times are one sorted column, in which the last row seen is carried
    on; nothing is joined. ``order`` begins with the time in seconds.
    """
    outputs = outputs or _LABELS
    time = order[0]
    late = F.col(time) + hours * 3600
    seen = F.struct(F.col(time).alias("_time"), *outputs.values())
    own = df.select("*", F.col(time).alias("_at"), F.lit(0).alias("_asks"), seen.alias("_seen"))
    asked = df.select("*", late.alias("_at"), F.lit(1).alias("_asks"), F.lit(None).cast(own.schema["_seen"].dataType).alias("_seen"))
    # A row at the very time comes before the one that asks for it.
    found = fill_forward(own.unionByName(asked), "_seen", [key], ["_at", "_asks", *order[1:]], "_found", max_rows)
    near = F.col("_found._time") > late - tolerance * 3600
    return found.filter("_asks = 1").select(
        *df.columns, *[F.when(near, F.col(f"_found.{c}")).alias(o) for o, c in outputs.items()])


def training_table(raw: DataFrame, order=("ts", "event_id"), keep=(), max_rows=None) -> DataFrame:
    """Raw observations to training rows: merge, hour, shift, drop identifiers, drop nulls.

    ``keep`` names identifier columns to carry along.
    """
    carried = [c for c in keep if c not in ("name", *order)]
    needed = raw.select(
        "name", *order, *carried, "lon", "lat", "temp", "tempfelt", "pressure", "humidity",
        merge_weather("weather").alias("weather"),
    )
    labelled = label_lag(needed, order=order, max_rows=max_rows)
    return (
        labelled.withColumn("hour", utc_hour("ts"))
        .select(*keep, *TRAIN_COLUMNS)
        .na.drop("any", subset=list(TRAIN_COLUMNS))
    )
