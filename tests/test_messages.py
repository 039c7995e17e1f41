import pytest

from obsflow.functions.messages import encode_forecast, encode_observation
from obsflow.operators.messages import (
    archive_columns, decode_messages, parse_messages, rejected_messages,
)
from obsflow.schemas import FORECAST, OBS_COLUMNS, OBS_RAW

WIRE = (
    '{"name":Northport,"ts":1.700039358E9,"lon":11.25,"lat":44.75,"temp":291.5,'
    '"tempfelt":290.75,"pressure": 1003.0,"humidity":64.0,"weather":Clouds}'
)
NORTH = ("Northport", 1700039358.0, 11.25, 44.75, 291.5, 290.75, 1003.0, 64.0, "Clouds")


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_encode_wire(spark):
    df = spark.createDataFrame([NORTH], OBS_RAW)
    assert df.select(encode_observation("wire")).first()[0] == WIRE


def test_encode_rejects_unknown_style():
    with pytest.raises(ValueError):
        encode_observation("xml")


@pytest.mark.parametrize("style", ["wire", "json"])
def test_round_trip(spark, style):
    df = spark.createDataFrame([NORTH], OBS_RAW)
    decoded = decode_messages(df.select(encode_observation(style).alias("value")))
    assert tuple(decoded.select(*OBS_RAW.fieldNames()).first()) == NORTH
    assert decoded.first().hour == 11.0
    assert archive_columns(decoded).columns == list(OBS_COLUMNS)


@pytest.mark.parametrize("old, new", [
    ("Northport", "Northport, North"), ("Northport", "Milan:North"), ("Clouds", "Clouds:x"),
    ('"lat":44.75,', ""), ("291.5", "warm"), ("291.5", '"291.5"'), (WIRE, "not a message"), (WIRE, ""),
    (WIRE, "{}"), (WIRE, None), ("}", ""), ("Northport", 'Mi"lan'),
])
def test_rejects(spark, old, new):
    broken = new if old == WIRE else WIRE.replace(old, new)
    both = messages(spark, broken, WIRE)
    assert [r.value for r in rejected_messages(both).collect()] == [broken]
    assert decode_messages(both).count() == 1
    parsed = parse_messages(both).collect()
    assert sorted(r.rejected or "" for r in parsed) == sorted([broken or "", ""])
    assert [r.name for r in parsed if r.rejected is None] == ["Northport"]


@pytest.mark.parametrize("name", ["Mignano Monte Lungo", "L'Aquila", "Forlì", "A{b}c", "St. X-Y"])
def test_names(spark, name):
    decoded = decode_messages(messages(spark, WIRE.replace("Northport", name)))
    assert decoded.first().name == name


def test_hour_settings(spark):
    decoded = decode_messages(messages(spark, WIRE), offset=20, wrap=True)
    assert decoded.first().hour == 5.0


def test_encode_forecast(spark):
    df = spark.createDataFrame([(11.5, 44.25, "Clouds", "Rain", 291.5, 288.0)], FORECAST)
    assert df.select(encode_forecast()).first()[0] == (
        '{"lon":11.5,"lat":44.25,"cweather":"Clouds","fweather":"Rain","ctemp":291.5,"ftemp":288.0}'
    )


@pytest.mark.parametrize("bad", [
    WIRE.replace("291.5", "NaN"), WIRE.replace("44.75", "Infinity"), WIRE.replace("64.0", "-Infinity"),
    WIRE.replace("Northport", "null"), WIRE.replace("Clouds", "null"),
    WIRE.replace("Northport", '"Northport"').replace("Clouds", " null "),
])
def test_numbers_that_are_not_finite_and_nulls_are_rejected(spark, bad):
    df = messages(spark, WIRE, bad)
    assert [tuple(r)[0] for r in decode_messages(df).collect()] == ["Northport"]
    assert [r.value for r in rejected_messages(df).collect()] == [bad]
    assert parse_messages(df).filter("rejected is not null").count() == 1


def test_a_null_is_published_as_a_message_that_is_rejected(spark):
    row = spark.createDataFrame([(None, *NORTH[1:])], OBS_RAW)
    for style in ("json", "wire"):
        sent = row.select(encode_observation(style).alias("value"))
        assert rejected_messages(sent).count() == 1
