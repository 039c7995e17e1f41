"""Raw observations over the ``events`` table, as a DataFrame and as the SQL to check against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch_seconds(ts):
    """Seconds of a zone-less timestamp read as UTC, whatever the session time zone."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date"))
    return (days.cast("bigint") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
            + F.second(ts)).cast("double")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows as observations; ``event_id`` is unique and breaks ties in ``ts``."""
    k = F.get_json_object("props", "$.k").cast("int")
    rows = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", "ts", k.alias("k")
    )
    classes = (
        "Clear", "Clouds", "Mist", "Fog", "Haze", "Smoke", "Drizzle", "Rain", "Thunderstorm",
        "Snow", "Squall",
    )
    weather = F.element_at(F.array(*map(F.lit, classes)), (F.col("k") % 11 + 1).cast("int"))
    warmth = F.lit(258.15) + F.col("value") % 45
    return rows.select(
        "event_id",
        F.concat(F.lit("st_"), F.col("user_id").cast("string")).alias("name"),
        _epoch_seconds(F.col("ts")).alias("ts"),
        (F.lit(6.6) + (F.col("user_id") % 120) / F.lit(10.0)).alias("lon"),
        (F.lit(36.6) + (F.col("user_id") % 105) / F.lit(10.0)).alias("lat"),
        F.round(warmth, 2).alias("temp"),
        F.round(warmth - F.col("k") % 5, 2).alias("tempfelt"),
        (F.lit(1004) + F.col("k") % 38).cast("double").alias("pressure"),
        (F.lit(10) + F.col("k") % 91).cast("double").alias("humidity"),
        weather.alias("weather"),
    )


def conditions():
    """Condition list of a row: none for one class, two in humid air, else its own class."""
    return (
        F.when(F.col("weather") == "Squall", F.array().cast("array<string>"))
        .when(F.col("humidity") >= 80, F.array(F.col("weather"), F.lit("Mist")))
        .otherwise(F.array(F.col("weather")))
    )


def _condition_structs():
    return F.transform(conditions(), lambda c: F.struct(c.alias("main")))


#: Rows per payload. ``event_id`` is unique, so a payload never holds more.
GROUP_ROWS, HISTORY_ROWS = 20, 200


def group_payloads(obs: DataFrame) -> DataFrame:
    """The observations as JSON texts of several stations each."""
    element = F.struct(
        F.struct("lon", "lat").alias("coord"), _condition_structs().alias("weather"),
        F.struct(
            "temp", F.col("tempfelt").alias("feels_like"), (F.col("temp") - 2).alias("temp_min"),
            (F.col("temp") + 2).alias("temp_max"), "pressure", "humidity",
        ).alias("main"),
        F.lit(7000).alias("visibility"), F.col("ts").cast("bigint").alias("dt"),
        F.col("event_id").alias("id"), "name",
    )
    grouped = obs.groupBy(F.floor(F.col("event_id") / GROUP_ROWS).alias("payload"))
    listed = grouped.agg(F.count(F.lit(1)).alias("cnt"), F.collect_list(element).alias("list"))
    return listed.select("payload", F.to_json(F.struct("cnt", "list")).alias("value"))


def history_pages(obs: DataFrame) -> DataFrame:
    """The observations as pages of one station each, with a ``hourly`` array."""
    element = F.struct(
        F.col("ts").cast("bigint").alias("dt"), "temp", F.col("tempfelt").alias("feels_like"),
        "pressure", "humidity", _condition_structs().alias("weather"),
    )
    grouped = obs.groupBy("name", F.floor(F.col("event_id") / HISTORY_ROWS).alias("page"))
    return grouped.agg(
        F.min("lon").alias("lon"), F.min("lat").alias("lat"),
        F.collect_list(element).alias("hourly"),
    )


def history_payloads(obs: DataFrame, named: bool = False) -> DataFrame:
    """The pages as JSON documents; ``named`` adds the station's name to the document."""
    own = ["name"] if named else []
    page = F.to_json(F.struct(*own, "lon", "lat", F.struct(F.lit(1).alias("dt")).alias("current"), "hourly"))
    return history_pages(obs).select("name", "page", page.alias("value"))


OBS_SQL = """obs as (
 select event_id, concat('st_', cast(user_id as varchar)) as name,
  cast(epoch_us(ts)//1000000 as double) as ts,
  cast(6.6 as double)+(user_id%120)/cast(10.0 as double) as lon,
  cast(36.6 as double)+(user_id%105)/cast(10.0 as double) as lat,
  round(cast(258.15 as double)+value%45,2) as temp,
  round(cast(258.15 as double)+value%45-k%5,2) as tempfelt,
  cast(1004+k%38 as double) as pressure, cast(10+k%91 as double) as humidity,
  case k%11 when 0 then 'Clear' when 1 then 'Clouds' when 2 then 'Mist' when 3 then 'Fog'
   when 4 then 'Haze' when 5 then 'Smoke' when 6 then 'Drizzle' when 7 then 'Rain'
   when 8 then 'Thunderstorm' when 9 then 'Snow' else 'Squall' end as weather
 from (select *, cast(json_extract_string(props,'$.k') as int) as k from events) e)"""

#: Observations with merged classes and the live hour.
MERGED_SQL = OBS_SQL + """, merged as (
 select * exclude (weather), cast(floor(ts % 86400 / 3600) + 2 as double) as hour,
  case when weather in ('Smoke','Haze','Mist') then 'Fog'
   when weather in ('Drizzle','Thunderstorm') then 'Rain' else weather end as weather
 from obs)"""

#: Merged observations with the labels of three rows before.
LAGGED_SQL = MERGED_SQL + """, lagged as (
 select *, lag(weather, 3) over w as weather_forecast, lag(temp, 3) over w as temp_forecast
 from merged window w as (partition by name order by ts, event_id))"""

#: One row per weather condition.
EXPLODED_SQL = OBS_SQL + """, exploded as (
 select * exclude (weather), unnest(case when weather = 'Squall' then cast([] as varchar[])
   when humidity >= 80 then [weather, 'Mist'] else [weather] end) as weather from obs)"""
