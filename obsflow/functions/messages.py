"""Encoders of the two messages, and the one-pass decoder of the observation message.

The published observation text looks like JSON but leaves ``name`` and ``weather`` unquoted.
The decoder quotes those two values where they are bare and then parses JSON once, so it reads
that text and real JSON alike.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from obsflow.schemas import FORECAST_COLUMNS, OBS_RAW, OBS_RAW_COLUMNS

CORRUPT = "_corrupt"
_READ_SCHEMA = StructType([*OBS_RAW.fields, StructField(CORRUPT, StringType())])

#: A bare value of the two text keys. Commas and colons cannot occur in one; null stays null.
_BARE_TEXT = r'"(name|weather)":(?!\s*")(?!\s*null\s*(?:,"|\}$))([^,:]*?)(?=,"|\}$)'


def encode_observation(style: str = "json") -> Column:
    """Observation columns to one message: ``json``, or ``wire`` for the bare-text form.

    A null field is left out of ``json`` and stands as null in ``wire``; either is a message that
    readers reject.
    """
    if style == "json":
        return F.to_json(F.struct(*OBS_RAW_COLUMNS))
    if style != "wire":
        raise ValueError(f"unknown style {style!r}")
    pieces = []
    for position, name in enumerate(OBS_RAW_COLUMNS):
        gap = " " if name == "pressure" else ""
        opening = "{" if position == 0 else ","
        pieces += [F.lit(f'{opening}"{name}":{gap}'), F.coalesce(F.col(name).cast("string"), F.lit("null"))]
    return F.concat(*pieces, F.lit("}"))


def encode_forecast() -> Column:
    return F.to_json(F.struct(*FORECAST_COLUMNS))


def parse_observation(value) -> Column:
    """Message to a struct of the raw observation fields plus the corrupt-record field."""
    value = F.col(value) if isinstance(value, str) else value
    quoted = F.regexp_replace(F.trim(value), _BARE_TEXT, '"$1":"$2"')
    return F.from_json(
        quoted, _READ_SCHEMA,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def is_complete(parsed: Column) -> Column:
    """True where the message parsed, no field is missing and every number is finite."""
    complete = parsed.isNotNull()
    for field in OBS_RAW.fields:
        value = parsed[field.name]
        complete = complete & (is_finite(value) if field.dataType == DoubleType() else value.isNotNull())
    return complete


def is_finite(value: Column) -> Column:
    """True for a number; false for null, NaN and the infinities."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
