"""Station lists: catalogues, backfill plans, batches, pages and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from obsflow.constants import BACKFILL_DAYS, IDS_PER_REQUEST, STATIONS
from obsflow.functions.weather import epoch_day_offset
from obsflow.operators.ordered import join_unique, row_positions


def default_stations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATIONS, "name string, lat double, lon double")


def distinct_stations(observations: DataFrame) -> DataFrame:
    return observations.groupBy("name").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"))


def filter_country(catalogue: DataFrame, country: str = "IT") -> DataFrame:
    """Ids, as text, of the catalogue entries of one country."""
    return catalogue.filter(F.col("country") == country).select(F.col("id").cast("string").alias("id"))


def pair_by_position(left: DataFrame, right: DataFrame, left_order, right_order) -> DataFrame:
    """Match two lists by position in their orders; the longer list's rest is left out."""
    numbered_left = row_positions(left, [], left_order)
    numbered_right = row_positions(right, [], right_order)
    return numbered_left.join(numbered_right, "position")


def with_coordinates(df: DataFrame, stations: DataFrame, key: str = "name", salt_by=("event_id",),
                     max_rows: int | None = None) -> DataFrame:
    """Each row with lat, lon of its station in place of its own; unlisted stations are left out.

    Of a station that ``stations`` lists more than once the least (lat, lon) counts.
    """
    places = stations.groupBy(key).agg(F.min(F.struct("lat", "lon")).alias("_place")).select(
        key, "_place.lat", "_place.lon")
    return join_unique(df.drop("lat", "lon"), places, [key], salt_by, how="inner", max_rows=max_rows)


def backfill_plan(stations: DataFrame, as_of: int, days: int = BACKFILL_DAYS) -> DataFrame:
    """One request per station and day: 1 to ``days`` days before ``as_of`` (epoch seconds)."""
    offsets = F.explode(F.sequence(F.lit(1), F.lit(days)))
    return stations.select("name", "lat", "lon", offsets.alias("day")).withColumn(
        "dt", epoch_day_offset(F.lit(as_of).cast("bigint"), "day")
    )


def shuffle_key(column: str = "id", seed: int = 13):
    """Reproducible random order: the 60 leading bits of a seeded hash, as a number."""
    text = F.concat(F.col(column).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def shuffle_ids(ids: DataFrame, column: str = "id", seed: int = 13) -> DataFrame:
    keyed = ids.select("*", shuffle_key(column, seed).alias("shuffle_key"))
    return keyed.orderBy("shuffle_key", column)


def batch_ids(ids: DataFrame, order, column: str = "id", size: int = IDS_PER_REQUEST,
              max_rows: int | None = None) -> DataFrame:
    """Comma-joined ids in groups of ``size`` along ``order``; a group is never larger."""
    numbered = row_positions(ids, [], order, max_rows=max_rows)
    grouped = numbered.groupBy(F.floor(F.col("position") / size).cast("bigint").alias("batch"))
    entries = F.array_sort(
        F.collect_list(F.struct("position", F.col(column).cast("string").alias("id")))
    )
    return grouped.agg(F.count(F.lit(1)).alias("n"), entries.alias("_entries")).select(
        "batch", "n", F.concat_ws(",", F.col("_entries.id")).alias("ids")
    )


def json_pages(df: DataFrame, columns, order, key: str = "name", page_rows: int = 10_000,
               max_rows: int | None = None, number: str | None = None) -> DataFrame:
    """Each station's rows as JSON arrays of at most ``page_rows`` elements, pages in order.

    A station within ``page_rows`` gets one array; a larger one gets several, so no value grows
    with the station. ``number`` names a field of each element for the number of its page.
    """
    numbered = row_positions(df, [key], order, max_rows=max_rows)
    page = F.floor(F.col("position") / page_rows).cast("bigint")
    paged = numbered.groupBy(key, page.alias("page"))
    fields = [*columns, *([page.alias(number)] if number else [])]
    entries = F.array_sort(F.collect_list(F.struct("position", F.struct(*fields).alias("row"))))
    return paged.agg(F.count(F.lit(1)).alias("n"), entries.alias("_entries")).select(
        key, "page", "n", F.to_json(F.col("_entries.row")).alias("json")
    )


def merge_hourly(pages: DataFrame, hourly: str = "hourly", key: str = "name") -> DataFrame:
    """The hourly elements of all pages of a station as one list of rows.

    The list stays exploded: a station's elements may exceed what one value can hold.
    """
    return pages.select(key, F.explode(hourly).alias("_e")).select(key, "_e.*")


def union_stations(tables: list[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, tables)
