"""Checked queries: scalar functions, projections, filters and messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsflow.constants import COLOUR_BANDS, DEFAULT_COLOUR
from obsflow.functions import text, weather as w
from obsflow.functions.geo import mercator_x, mercator_y
from obsflow.functions.messages import encode_forecast, encode_observation, is_complete, parse_observation
from obsflow.operators import flatten, messages as m
from obsflow.operators.aggregates import fit_viewport, place_on_map, viewport_bounds
from obsflow.operators.features import constant_class
from obsflow.operators.labels import label_lag, training_table
from obsflow.operators.models import forecast_columns
from obsflow.operators.stations import filter_country, merge_hourly
from obsflow.plans.registry import query
from obsflow.plans.testview import (
    EXPLODED_SQL, LAGGED_SQL, MERGED_SQL, OBS_SQL, conditions, group_payloads, history_pages,
    history_payloads, observations, table,
)
from obsflow.schemas import FORECAST_COLUMNS, HISTORY, OBS_COLUMNS, OBS_RAW_COLUMNS, TRAIN_COLUMNS

_RAW = ", ".join(OBS_RAW_COLUMNS)


def merged_observations(spark, sf):
    return m.to_observations(observations(spark, sf))


def lagged_observations(spark, sf):
    return label_lag(merged_observations(spark, sf))


@query("merge_weather", f"with {MERGED_SQL} select event_id, weather from merged")
def merge_weather(spark, sf):
    return observations(spark, sf).select("event_id", w.merge_weather("weather").alias("weather"))


@query("hour_of_epoch", f"""with {MERGED_SQL} select event_id, hour,
 cast(floor(ts % 86400 / 3600 + 2) % 24 as double) as hour_wrapped,
 cast(floor(((ts - 1800000000) % 86400 + 86400) % 86400 / 3600) + 2 as double) as hour_before_epoch
 from merged""")
def hour_of_epoch(spark, sf):
    return observations(spark, sf).select(
        "event_id", w.hour_of_epoch("ts").alias("hour"),
        w.hour_of_epoch("ts", wrap=True).alias("hour_wrapped"),
        w.hour_of_epoch(F.col("ts") - 1800000000).alias("hour_before_epoch"),
    )


@query("utc_hour", f"""with {OBS_SQL} select event_id, cast(hour(make_timestamp(cast(ts as bigint)
 * 1000000)) as integer) as utc_hour from obs""")
def utc_hour(spark, sf):
    return observations(spark, sf).select("event_id", w.utc_hour("ts").alias("utc_hour"))


@query("kelvin_to_celsius", f"with {OBS_SQL} select event_id, round(temp - 273.15, 2) as celsius from obs")
def kelvin_to_celsius(spark, sf):
    return observations(spark, sf).select(
        "event_id", F.round(w.kelvin_to_celsius("temp"), 2).alias("celsius")
    )


def band_rows() -> str:
    """The colour bands as SQL rows (class, low, high, colour)."""
    rows = []
    for name, bands in COLOUR_BANDS.items():
        low = "-infinity"
        for high, colour in bands:
            high = "infinity" if high is None else high
            rows.append(f"('{name}', cast('{low}' as double), cast('{high}' as double), '{colour}')")
            low = high
    return f"bands(class, low, high, colour) as (values {', '.join(rows)})"


@query("temp_band", f"""with {MERGED_SQL}, {band_rows()}, warm as (
 select event_id, weather, round(temp - 273.15, 2) as celsius from merged)
 select event_id, weather, celsius, coalesce(colour, '{DEFAULT_COLOUR}') as colour
 from warm left join bands on weather = class and celsius >= low and celsius < high""")
def temp_band(spark, sf):
    return merged_observations(spark, sf).select(
        "event_id", "weather", F.round(w.kelvin_to_celsius("temp"), 2).alias("celsius")
    ).withColumn("colour", w.temp_band("weather", "celsius"))


_X = "radians(lon)"
_Y = "-ln(tan(pi() / 4 + radians(lat) / 2))"
_BOUNDS_SQL = OBS_SQL + f""", bounds as (select min({_X}) as min_x, min({_Y}) as min_y,
 max({_X}) as max_x, max({_Y}) as max_y from obs)"""
_VIEWPORT_SQL = _BOUNDS_SQL + """, scaled as (select *, least(0.95 / ((max_x - min_x) / 620.0),
 0.95 / ((max_y - min_y) / 700.0)) as scale from bounds), viewport as (select scale,
 (620 - scale * (min_x + max_x)) / 2 as tx, (700 - scale * (min_y + max_y)) / 2 as ty from scaled)"""


@query("mercator_xy", f"with {OBS_SQL} select event_id, round({_X}, 9) as x, round({_Y}, 9) as y from obs")
def mercator_xy(spark, sf):
    return observations(spark, sf).select(
        "event_id", F.round(mercator_x("lon"), 9).alias("x"), F.round(mercator_y("lat"), 9).alias("y")
    )


@query("viewport_bounds", f"""with {_BOUNDS_SQL} select round(min_x, 9) as min_x,
 round(min_y, 9) as min_y, round(max_x, 9) as max_x, round(max_y, 9) as max_y from bounds""")
def bounds(spark, sf):
    found = viewport_bounds(observations(spark, sf))
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


@query("fit_viewport", f"""with {_VIEWPORT_SQL} select round(scale, 6) as scale,
 round(tx, 6) as tx, round(ty, 6) as ty from viewport""")
def viewport(spark, sf):
    fitted = fit_viewport(viewport_bounds(observations(spark, sf)), 620, 700)
    return fitted.select(*[F.round(c, 6).alias(c) for c in fitted.columns])


@query("place_on_map", f"""with {_VIEWPORT_SQL} select event_id, round(scale * {_X} + tx, 6) as x,
 round(ty + scale * ({_Y}), 6) as y from obs, viewport""")
def map_points(spark, sf):
    obs = observations(spark, sf)
    placed = place_on_map(obs, fit_viewport(viewport_bounds(obs), 620, 700))
    return placed.select("event_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


# Numbers as message text: epoch seconds carry an exponent, the other values do not.
_TS_TEXT = """concat(left(cast(cast(ts as bigint) as varchar), 1), '.',
 coalesce(nullif(rtrim(substr(cast(cast(ts as bigint) as varchar), 2), '0'), ''), '0'), 'E9')"""


def _number(column: str) -> str:
    return f"cast({column} as varchar)"


_WIRE_SQL = f"""concat('{{"name":', name, ',"ts":', {_TS_TEXT}, ',"lon":', {_number('lon')},
 ',"lat":', {_number('lat')}, ',"temp":', {_number('temp')}, ',"tempfelt":', {_number('tempfelt')},
 ',"pressure": ', {_number('pressure')}, ',"humidity":', {_number('humidity')},
 ',"weather":', weather, '}}')"""
_JSON_SQL = f"""concat('{{"name":"', name, '","ts":', {_TS_TEXT}, ',"lon":', {_number('lon')},
 ',"lat":', {_number('lat')}, ',"temp":', {_number('temp')}, ',"tempfelt":', {_number('tempfelt')},
 ',"pressure":', {_number('pressure')}, ',"humidity":', {_number('humidity')},
 ',"weather":"', weather, '"}}')"""


@query("encode_observation", f"""with {OBS_SQL} select event_id, {_WIRE_SQL} as wire,
 {_JSON_SQL} as json from obs""")
def encode(spark, sf):
    return observations(spark, sf).select(
        "event_id", encode_observation("wire").alias("wire"), encode_observation().alias("json")
    )


def wire_messages(spark, sf):
    return observations(spark, sf).select("event_id", encode_observation("wire").alias("value"))


@query("decode_message", f"with {MERGED_SQL} select {_RAW}, hour from merged")
def decode(spark, sf):
    return m.decode_messages(wire_messages(spark, sf))


@query("decode_json_message", f"with {MERGED_SQL} select {_RAW}, hour from merged")
def decode_json(spark, sf):
    return m.decode_messages(observations(spark, sf).select(encode_observation().alias("value")))


def faulty_messages(spark, sf):
    """Wire messages; those of four classes carry one fault each."""
    obs = observations(spark, sf).withColumn(
        "name", F.when(F.col("weather") == "Smoke", F.concat("name", F.lit(", x")))
        .when(F.col("weather") == "Haze", F.concat("name", F.lit(":x"))).otherwise(F.col("name"))
    )
    whole = encode_observation("wire")
    return obs.select(
        F.when(F.col("weather") == "Drizzle", F.regexp_replace(whole, '"temp":[^,]*', '"temp":n/a'))
        .when(F.col("weather") == "Thunderstorm", F.regexp_replace(whole, ',"humidity":[^,]*', ""))
        .otherwise(whole).alias("value")
    )


_FAULTY_SQL = f"""with {OBS_SQL}, named as (select * replace (case weather
  when 'Smoke' then concat(name, ', x') when 'Haze' then concat(name, ':x') else name end as name)
  from obs), messages as (select weather, {_WIRE_SQL} as value from named)"""


@query("rejects", f"""{_FAULTY_SQL} select case weather
  when 'Drizzle' then regexp_replace(value, '"temp":[^,]*', '"temp":n/a')
  when 'Thunderstorm' then regexp_replace(value, ',"humidity":[^,]*', '') else value end as value
 from messages where weather in ('Smoke', 'Haze', 'Drizzle', 'Thunderstorm')""")
def rejects(spark, sf):
    return m.rejected_messages(faulty_messages(spark, sf))


@query("decode_past_rejects", f"""with {OBS_SQL} select {_RAW} from (select * replace (case when
 weather = 'Mist' then 'Fog' else weather end as weather) from obs
 where weather not in ('Smoke', 'Haze', 'Drizzle', 'Thunderstorm'))""")
def decode_past_rejects(spark, sf):
    return m.decode_messages(faulty_messages(spark, sf)).select(*OBS_RAW_COLUMNS)


def faulty_payloads(spark, sf):
    """Payloads of one observation each: cut short for Snow, without a name for Clear."""
    obs = observations(spark, sf)
    value = F.to_json(F.struct(F.array(F.struct(
        F.struct("lon", "lat").alias("coord"),
        F.array(F.struct(F.col("weather").alias("main"))).alias("weather"),
        F.struct("temp", F.col("tempfelt").alias("feels_like"), "pressure", "humidity").alias("main"),
        F.col("ts").cast("bigint").alias("dt"),
        F.when(F.col("weather") != "Clear", F.col("name")).alias("name"),
    )).alias("list")))
    cut = F.when(F.col("weather") == "Snow", F.expr("substring(value, 1, 40)")).otherwise(F.col("value"))
    return obs.select("event_id", "weather", value.alias("value")).select(
        "event_id", cut.alias("value")
    )


@query("reject_payloads", f"with {OBS_SQL} select event_id from obs where weather in ('Clear', 'Snow')")
def reject_payloads(spark, sf):
    return flatten.rejected_payloads(faulty_payloads(spark, sf)).select("event_id")


@query("reject_payloads_ext", f"with {OBS_SQL} select event_id from obs")
def reject_payloads_ext(spark, sf):
    """No payload here has the two fields that only the extended form needs."""
    return flatten.rejected_payloads(faulty_payloads(spark, sf), kind="extended").select("event_id")


@query("payloads_one_parse", f"""with {OBS_SQL} select event_id, weather in ('Clear', 'Snow') as rejected from obs""")
def payloads_one_parse(spark, sf):
    """Rows and rejects of payloads parsed once; together they are all payloads."""
    parsed = flatten.parse_payloads(faulty_payloads(spark, sf))
    taken = parsed.filter("_whole").select("event_id", F.lit(False).alias("rejected"))
    return taken.unionByName(flatten.rejects_of_parsed(parsed).select("event_id", F.lit(True).alias("rejected")))


@query("reject_not_finite", f"""with {OBS_SQL} select event_id, weather in ('Rain', 'Snow', 'Fog') as rejected from obs""")
def reject_not_finite(spark, sf):
    """Messages with NaN, Infinity or a null name are rejected, all others taken."""
    obs = observations(spark, sf)
    whole = encode_observation("wire")
    value = (F.when(F.col("weather") == "Rain", F.regexp_replace(whole, '"temp":[^,]*', '"temp":NaN'))
             .when(F.col("weather") == "Snow", F.regexp_replace(whole, '"lon":[^,]*', '"lon":Infinity'))
             .when(F.col("weather") == "Fog", F.regexp_replace(whole, '"name":[^,]*', '"name":null'))
             .otherwise(whole))
    tagged = obs.select("event_id", F.explode(F.array(parse_observation(value))).alias("p"))
    return tagged.select("event_id", (~is_complete(F.col("p"))).alias("rejected"))


@query("flatten_past_rejects", f"with {OBS_SQL} select {_RAW} from obs where weather not in ('Clear', 'Snow')")
def flatten_past_rejects(spark, sf):
    return flatten.flatten_group(faulty_payloads(spark, sf)).select(*OBS_RAW_COLUMNS)


@query("flatten_group_payload", f"with {EXPLODED_SQL} select {_RAW} from exploded")
def flatten_group(spark, sf):
    return flatten.flatten_group(group_payloads(observations(spark, sf))).select(*OBS_RAW_COLUMNS)


@query("flatten_group_ext", f"""with {EXPLODED_SQL} select event_id as id, {_RAW},
 temp - 2 as tempmin, temp + 2 as tempmax from exploded""")
def flatten_group_ext(spark, sf):
    return flatten.flatten_group(group_payloads(observations(spark, sf)), extended=True)


@query("flatten_history_payload", f"with {EXPLODED_SQL} select {_RAW} from exploded")
def flatten_history(spark, sf):
    return flatten.flatten_history(history_payloads(observations(spark, sf)))


@query("merge_hourly", f"""with {OBS_SQL} select name, cast(ts as bigint) as dt, temp, tempfelt
 as feels_like, pressure, humidity, case when weather = 'Squall' then '' when humidity >= 80
 then concat(weather, ',Mist') else weather end as weather from obs""")
def hourly(spark, sf):
    rows = merge_hourly(history_pages(observations(spark, sf)))
    return rows.withColumn("weather", F.concat_ws(",", "weather.main"))


@query("explode_conditions", f"with {EXPLODED_SQL} select event_id, weather from exploded")
def explode_conditions(spark, sf):
    rows = observations(spark, sf).select("event_id", conditions().alias("conditions"))
    return flatten.explode_conditions(rows)


@query("filter_country", """select cast(c_custkey as varchar) as id from customer join nation
 on c_nationkey = n_nationkey where n_name = 'NATION_7'""")
def country(spark, sf):
    nation = table(spark, sf, "nation")
    catalogue = table(spark, sf, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("c_custkey").alias("id"), F.col("n_name").alias("country"))
    return filter_country(catalogue, "NATION_7")


@query("rename_labels", f"""with {LAGGED_SQL} select event_id, weather_forecast as label,
 temp_forecast as target from lagged""")
def rename_labels(spark, sf):
    return (
        lagged_observations(spark, sf).withColumnRenamed("weather_forecast", "label")
        .withColumnRenamed("temp_forecast", "target").select("event_id", "label", "target")
    )


@query("drop_columns", f"with {LAGGED_SQL} select * exclude (name, ts) from lagged")
def drop_columns(spark, sf):
    return lagged_observations(spark, sf).drop("name", "ts")


@query("drop_section", f"with {EXPLODED_SQL} select {_RAW} from exploded")
def drop_section(spark, sf):
    """The rows of the pages whose section was cut; a page that kept it or lost more has none."""
    cut = flatten.drop_section(history_payloads(observations(spark, sf)), "value", HISTORY)
    gone = cut.filter(F.get_json_object("value", "$.current").isNull())
    return flatten.flatten_history(gone).select(*OBS_RAW_COLUMNS)


@query("dropna_any", f"""with {LAGGED_SQL} select event_id, weather_forecast, temp_forecast
 from lagged where weather_forecast is not null and temp_forecast is not null""")
def dropna_any(spark, sf):
    return lagged_observations(spark, sf).na.drop("any").select(
        "event_id", "weather_forecast", "temp_forecast"
    )


@query("training_table", f"""with {LAGGED_SQL} select name, event_id, lon, lat, temp, tempfelt,
 pressure, humidity, weather, cast(hour - 2 as integer) as hour, weather_forecast, temp_forecast
 from lagged where temp_forecast is not null""")
def training(spark, sf):
    return training_table(observations(spark, sf), keep=("name", "event_id"))


def persisted_forecast(spark, sf):
    """Scored rows without a model: the labels stand in for the predictions."""
    return lagged_observations(spark, sf).na.drop("any").withColumnRenamed(
        "weather_forecast", "predicted_label"
    )


_FORECAST_SQL = LAGGED_SQL + """, forecast as (select lon, lat, weather as cweather,
 weather_forecast as fweather, temp as ctemp, temp_forecast as ftemp
 from lagged where temp_forecast is not null)"""


@query("project_forecast", f"with {_FORECAST_SQL} select * from forecast")
def project_forecast(spark, sf):
    return forecast_columns(persisted_forecast(spark, sf)).select(*FORECAST_COLUMNS)


@query("typed_forecast", f"with {_FORECAST_SQL} select * from forecast")
def typed_forecast(spark, sf):
    rows = persisted_forecast(spark, sf)
    as_text = rows.select(*[F.col(c).cast("string").alias(c) for c in (
        "lon", "lat", "weather", "predicted_label", "temp", "temp_forecast")])
    return forecast_columns(as_text)


@query("encode_forecast", f"""with {_FORECAST_SQL} select concat('{{"lon":', {_number('lon')},
 ',"lat":', {_number('lat')}, ',"cweather":"', cweather, '","fweather":"', fweather,
 '","ctemp":', {_number('ctemp')}, ',"ftemp":', {_number('ftemp')}, '}}') as value from forecast""")
def forecast_message(spark, sf):
    return forecast_columns(persisted_forecast(spark, sf)).select(encode_forecast().alias("value"))


@query("fallback_constant", f"with {OBS_SQL} select event_id, cast(1.0 as double) as weather, temp from obs")
def fallback_constant(spark, sf):
    return constant_class(observations(spark, sf)).select("event_id", "weather", "temp")


@query("archive_projection", f"with {MERGED_SQL} select {', '.join(OBS_COLUMNS)} from merged")
def archive_projection(spark, sf):
    return m.archive_columns(merged_observations(spark, sf))


@query("string_helpers", f"""with {OBS_SQL} select event_id, name as stripped, weather as picked,
 concat(name, ',', weather) as joined, name as trimmed, cast(event_id as varchar) as number_text,
 cast(event_id as double) as number from obs""")
def string_helpers(spark, sf):
    pairs = F.concat(F.lit("name:"), "name", F.lit(",weather:"), "weather")
    return observations(spark, sf).select(
        "event_id",
        text.strip_ends(F.concat(F.lit("{"), "name", F.lit("}"))).alias("stripped"),
        text.split_pairs(pairs)["weather"].alias("picked"),
        text.join_text("name", "weather").alias("joined"),
        F.rtrim(F.concat("name", F.lit("  "))).alias("trimmed"),
        text.number_text("event_id").alias("number_text"),
        text.number_from_text(F.concat(F.lit(" "), F.col("event_id").cast("string"))).alias("number"),
    )
