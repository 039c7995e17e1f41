"""Nested JSON payloads to observation rows.

A payload is taken or rejected whole: one element without a required field rejects it. Each
weather condition of an element gives one row; an element with an empty list gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from obsflow.functions.messages import is_finite
from obsflow.schemas import GROUP, HISTORY, OBS_RAW_COLUMNS

_CORRUPT = "_corrupt"
_GROUP_FIELDS = {
    "name": "name", "ts": "dt", "lon": "coord.lon", "lat": "coord.lat", "temp": "main.temp",
    "tempfelt": "main.feels_like", "pressure": "main.pressure", "humidity": "main.humidity",
}
_EXTENDED_FIELDS = {
    "id": "id", **_GROUP_FIELDS, "tempmin": "main.temp_min", "tempmax": "main.temp_max",
}
_NOT_NUMBERS = ("name", "id")
_HISTORY_FIELDS = {
    "ts": "dt", "temp": "temp", "tempfelt": "feels_like", "pressure": "pressure",
    "humidity": "humidity",
}


def _field(element: Column, path: str) -> Column:
    for step in path.split("."):
        element = element[step]
    return element


def _is_whole(element: Column, fields) -> Column:
    whole = element["weather"].isNotNull() & ~F.exists(
        element["weather"], lambda condition: condition["main"].isNull()
    )
    for path in fields:
        value = _field(element, path)
        whole = whole & (value.isNotNull() if path in _NOT_NUMBERS else is_finite(value))
    return whole


def _parsed(column: str, schema: StructType) -> Column:
    read = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return F.from_json(column, read, options)


def _whole_list(payload: Column, array: str, fields) -> Column:
    """True where the payload has the list and no element of it misses a field."""
    elements = F.forall(payload[array], lambda e: F.coalesce(_is_whole(e, fields), F.lit(False)))
    return F.coalesce(elements, F.lit(False))


def _whole_group(fields):
    return lambda payload: _whole_list(payload, "list", fields)


def _whole_history(payload: Column) -> Column:
    placed = F.coalesce(is_finite(payload["lon"]) & is_finite(payload["lat"]), F.lit(False))
    return placed & _whole_list(payload, "hourly", _HISTORY_FIELDS.values())


def _payload_where(parsed: Column, wanted) -> Column:
    """Rows of the parsed payload where ``wanted`` holds; parses once, unlike a filter."""
    return F.explode(F.filter(F.array(parsed), wanted)).alias("_payload")


def explode_conditions(rows: DataFrame, column: str = "conditions", out: str = "weather",
                       position: str | None = None) -> DataFrame:
    """One row per weather condition; rows with an empty or missing list are dropped.

    ``position`` names a column for the place of the condition in its list.
    """
    if position:
        exploded = rows.select("*", F.posexplode(column).alias(position, out))
    else:
        exploded = rows.select("*", F.explode(column).alias(out))
    return exploded.drop(column)


def flatten_group(payloads: DataFrame, column: str = "value", extended: bool = False) -> DataFrame:
    """Payloads of several stations to raw observations; ``extended`` adds id, tempmin, tempmax."""
    fields = _EXTENDED_FIELDS if extended else _GROUP_FIELDS
    whole = payloads.select(_payload_where(_parsed(column, GROUP), _whole_group(fields.values())))
    return _group_rows(whole, fields)


def _group_rows(whole: DataFrame, fields) -> DataFrame:
    items = whole.select(F.explode("_payload.list").alias("_e"))
    rows = items.select(
        *[_field(F.col("_e"), path).alias(c) for c, path in fields.items()],
        F.col("_e.weather.main").alias("conditions"),
    )
    return explode_conditions(rows)


def flatten_history(payloads: DataFrame, column: str = "value", name: str = "name",
                    position: str | None = None) -> DataFrame:
    """Hourly pages of one station each, named by a column, to raw observations.

    Several conditions in one hour give several rows with the same ``ts``; ``position`` names a
    column that keeps their order.
    """
    whole = payloads.select(
        F.col(name).alias("name"), _payload_where(_parsed(column, HISTORY), _whole_history)
    )
    return _history_rows(whole, position)


def flatten_history_documents(documents: DataFrame, position: str | None = None) -> DataFrame:
    """Like ``flatten_history`` for documents read by ``sources.files.read_history``."""
    payload = F.struct("lon", "lat", "hourly")
    return _history_rows(documents.select("name", _payload_where(payload, _whole_history)), position)


def rejected_history_documents(documents: DataFrame) -> DataFrame:
    """Names of the documents that ``flatten_history_documents`` leaves out."""
    payload = F.struct("lon", "lat", "hourly")
    broken = _payload_where(payload, lambda p: ~_whole_history(p))
    return documents.select("name", broken).select("name")


def _history_rows(payloads: DataFrame, position: str | None) -> DataFrame:
    items = payloads.select(
        "name", F.col("_payload.lon").alias("lon"), F.col("_payload.lat").alias("lat"),
        F.explode("_payload.hourly").alias("_e"),
    )
    rows = items.select(
        "name", "lon", "lat",
        *[_field(F.col("_e"), path).alias(c) for c, path in _HISTORY_FIELDS.items()],
        F.col("_e.weather.main").alias("conditions"),
    )
    carried = [position] if position else []
    return explode_conditions(rows, position=position).select(*OBS_RAW_COLUMNS, *carried)


def rejected_payloads(payloads: DataFrame, column: str = "value", kind: str = "group") -> DataFrame:
    """Payloads the flattening leaves out: unreadable ones and ones that miss a required field."""
    schema, whole = _KINDS[kind]
    broken = _payload_where(_parsed(column, schema), lambda payload: ~whole(payload))
    return payloads.select("*", broken).drop("_payload")


#: Schema and test of wholeness of each kind of payload.
_KINDS = {
    "group": (GROUP, _whole_group(_GROUP_FIELDS.values())),
    "extended": (GROUP, _whole_group(_EXTENDED_FIELDS.values())),
    "history": (HISTORY, _whole_history),
}


def parse_payloads(payloads: DataFrame, column: str = "value", kind: str = "group") -> DataFrame:
    """All payloads parsed once: the input's columns, ``_payload`` and whether it is ``_whole``.

    Persist the result where both sides are used; ``rows_of_parsed`` and ``rejects_of_parsed``
    read it.
    """
    schema, whole = _KINDS[kind]
    # The one-element list keeps Catalyst from parsing again for every field the test names.
    tested = F.transform(F.array(_parsed(column, schema)),
                         lambda p: F.struct(p.alias("payload"), F.coalesce(whole(p), F.lit(False)).alias("whole")))
    parsed = payloads.select("*", F.explode(tested).alias("_tested"))
    return parsed.select(*payloads.columns, F.col("_tested.payload").alias("_payload"),
                         F.col("_tested.whole").alias("_whole"))


def rows_of_parsed(parsed: DataFrame, kind: str = "group", position: str | None = None) -> DataFrame:
    """Raw observations of the whole payloads."""
    whole = parsed.filter("_whole")
    if kind == "history":
        return _history_rows(whole.select("name", "_payload"), position)
    return _group_rows(whole.select("_payload"), _EXTENDED_FIELDS if kind == "extended" else _GROUP_FIELDS)


def rejects_of_parsed(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("_whole")).drop("_payload", "_whole")


def drop_section(payloads: DataFrame, column: str, schema: DataType) -> DataFrame:
    """Rewrite JSON text with only the sections ``schema`` names; all others are cut."""
    return payloads.withColumn(column, F.to_json(F.from_json(column, schema)))
