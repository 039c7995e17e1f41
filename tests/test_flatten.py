import json

import pytest

from obsflow.operators.flatten import (
    drop_section, flatten_group, flatten_history, parse_payloads, rejected_payloads,
    rejects_of_parsed, rows_of_parsed,
)
from obsflow.schemas import HISTORY


def element(name="Northport", conditions=("Clouds",), **changes):
    return {
        "coord": {"lon": 11.25, "lat": 44.75}, "sys": {"country": "IT"},
        "weather": [{"id": 801, "main": c, "icon": "02d"} for c in conditions],
        "main": {"temp": 291.5, "feels_like": 290.75, "temp_min": 288.25, "temp_max": 294.5,
                 "pressure": 1003, "humidity": 64},
        "visibility": 7000, "dt": 1700039358, "id": 40017, "name": name, **changes,
    }


def payloads(spark, *documents):
    texts = [d if isinstance(d, str) else json.dumps(d) for d in documents]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_group(spark):
    df = payloads(spark, {"cnt": 2, "list": [element(), element("Roma", ("Rain", "Mist"))]})
    rows = sorted(tuple(r) for r in flatten_group(df).collect())
    fields = (1700039358.0, 11.25, 44.75, 291.5, 290.75, 1003.0, 64.0)
    assert rows == [("Northport", *fields, "Clouds"), ("Roma", *fields, "Mist"), ("Roma", *fields, "Rain")]


def test_group_extended(spark):
    row = flatten_group(payloads(spark, {"list": [element()]}), extended=True).first()
    assert (row.id, row.tempmin, row.tempmax) == (40017, 288.25, 294.5)


def test_empty_condition_list_gives_no_row_and_no_reject(spark):
    df = payloads(spark, {"list": [element(conditions=())]})
    assert flatten_group(df).count() == 0
    assert rejected_payloads(df).count() == 0


@pytest.mark.parametrize("bad", [
    "{", "[]", "", '{"cnt":0}', {"list": [element(), element(name=None)]},
    {"list": [element(coord={"lon": 1.0})]}, {"list": [element(weather=None)]},
    {"list": [element(weather=[{"id": 1}])]}, {"list": [element(main={"temp": 1})]}, {"list": [None]},
])
def test_bad_payload_is_rejected_whole(spark, bad):
    good = {"list": [element()]}
    df = payloads(spark, bad, good)
    assert flatten_group(df).count() == 1
    assert [r.value for r in rejected_payloads(df).collect()] == [
        bad if isinstance(bad, str) else json.dumps(bad)]


def page(**changes):
    hour = {"dt": 3600, "temp": 280.0, "feels_like": 279.0, "pressure": 1000, "humidity": 50,
            "weather": [{"main": "Rain"}, {"main": "Mist"}]}
    return {"lon": 9.0, "lat": 45.0, "current": {"dt": 1}, "hourly": [hour], **changes}


def test_history(spark):
    df = spark.createDataFrame([("Milano", json.dumps(page()))], "name string, value string")
    rows = [tuple(r) for r in flatten_history(df, position="condition").collect()]
    fields = ("Milano", 3600.0, 9.0, 45.0, 280.0, 279.0, 1000.0, 50.0)
    assert sorted(rows) == [(*fields, "Mist", 1), (*fields, "Rain", 0)]


def test_history_rejects(spark):
    rows = [("a", json.dumps(page(lat=None))), ("b", json.dumps(page())), ("c", "nothing")]
    df = spark.createDataFrame(rows, "name string, value string")
    assert {r.name for r in rejected_payloads(df, kind="history").collect()} == {"a", "c"}
    assert {r.name for r in flatten_history(df).collect()} == {"b"}


def test_drop_section(spark):
    cut = drop_section(payloads(spark, page()), "value", HISTORY).first().value
    assert "current" not in json.loads(cut)
    assert len(json.loads(cut)["hourly"]) == 1


@pytest.mark.parametrize("kind", ["group", "extended"])
def test_one_parse_gives_rows_and_rejects(spark, kind):
    no_least = element()
    del no_least["main"]["temp_min"]
    infinite = json.dumps({"list": [element()]}).replace("291.5", "Infinity")
    df = payloads(spark, {"list": [element()]}, {"list": [no_least]}, infinite, "{")
    extended = kind == "extended"
    parsed = parse_payloads(df, kind=kind)
    rows, broken = rows_of_parsed(parsed, kind), rejects_of_parsed(parsed)
    assert rows.exceptAll(flatten_group(df, extended=extended)).count() == 0
    assert broken.exceptAll(rejected_payloads(df, kind=kind)).count() == 0
    assert broken.count() == (3 if extended else 2)
    assert rows.count() == (1 if extended else 2)


def test_one_parse_of_history(spark):
    page = {"lon": 1.0, "lat": 2.0, "hourly": [
        {"dt": 0, "temp": 280.0, "feels_like": 279.0, "pressure": 1000, "humidity": 50, "weather": [{"main": "Clear"}]}]}
    df = payloads(spark, page, {**page, "lon": None}).selectExpr("'a' as name", "value")
    parsed = parse_payloads(df, kind="history")
    assert rows_of_parsed(parsed, "history").exceptAll(flatten_history(df)).count() == 0
    assert rows_of_parsed(parsed, "history").count() == rejects_of_parsed(parsed).count() == 1
