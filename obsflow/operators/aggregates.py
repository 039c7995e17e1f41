"""Label frequencies, errors and bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from obsflow.functions.geo import centre_offset, fit_scale, mercator_x, mercator_y


def label_index(df: DataFrame, column: str = "weather") -> DataFrame:
    """Classes numbered by falling frequency, ties by name.

    The window runs over one row per class, after the counts are combined.
    """
    counts = df.groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    ranked = Window.orderBy(F.col("n").desc(), "label")
    return counts.select("label", "n", (F.row_number().over(ranked) - 1).cast("bigint").alias("index"))


def label_list(df: DataFrame, column: str = "weather") -> DataFrame:
    return df.select(F.col(column).alias("label")).distinct()


def rmse(prediction: str, label: str) -> Column:
    return F.sqrt(F.avg(F.pow(F.col(prediction) - F.col(label), 2)))


def accuracy(prediction: str, label: str) -> Column:
    return F.avg((F.col(prediction) == F.col(label)).cast("double"))


def viewport_bounds(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Bounds on the map plane at scale 1; one row."""
    placed = df.select(mercator_x(lon).alias("x"), mercator_y(lat).alias("y"))
    return placed.agg(
        F.min("x").alias("min_x"), F.min("y").alias("min_y"),
        F.max("x").alias("max_x"), F.max("y").alias("max_y"),
    )


def fit_viewport(bounds: DataFrame, width: float, height: float, pad: float = 0.95) -> DataFrame:
    """Scale and offset that centre the bounds in a viewport; one row."""
    scaled = bounds.withColumn(
        "scale", fit_scale("min_x", "min_y", "max_x", "max_y", width, height, pad)
    )
    return scaled.select(
        "scale", centre_offset("min_x", "max_x", "scale", width).alias("tx"),
        centre_offset("min_y", "max_y", "scale", height).alias("ty"),
    )


def place_on_map(df: DataFrame, viewport: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Add x, y in a fitted viewport, which is the one row of an aggregate."""
    fitted = viewport.select(F.struct("scale", "tx", "ty")).scalar()
    return df.withColumns({
        "x": mercator_x(lon, fitted["scale"], fitted["tx"]),
        "y": mercator_y(lat, fitted["scale"], fitted["ty"]),
    })
