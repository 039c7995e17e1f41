import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from obsflow.constants import STATIONS
from obsflow.operators import stations as s
from obsflow.operators.flatten import rejected_history_documents
from obsflow.plans.offline import build_training_files
from obsflow.schemas import OBS_RAW
from obsflow.sources import files

ROW = ("Milano", 3600.0, 11.25, 44.75, 280.0, 279.0, 1000.0, 50.0, "Rain")


def observations(spark, count=6):
    rows = [("Milano" if i % 2 else "Roma", float(i), *ROW[2:]) for i in range(count)]
    return spark.createDataFrame(rows, OBS_RAW)


def test_json_lines_fail_if_present(spark, tmp_path):
    path = str(tmp_path / "obs")
    files.write_json_lines(observations(spark), path)
    assert files.read_json_lines(spark, path).exceptAll(observations(spark)).count() == 0
    with pytest.raises(AnalysisException):
        files.write_json_lines(observations(spark), path)


def test_stations_can_share_folders(spark, tmp_path):
    path = str(tmp_path / "obs")
    files.write_json_lines(observations(spark), path, buckets=4)
    assert all(p.name.startswith("bucket=") for p in (tmp_path / "obs").iterdir() if p.is_dir())
    assert files.read_json_lines(spark, path).exceptAll(observations(spark)).count() == 0
    files.write_csv(observations(spark), str(tmp_path / "one"), key=None)
    files.write_csv(observations(spark), str(tmp_path / "csv"), buckets=4)
    for folder in ("one", "csv"):
        assert files.read_csv(spark, str(tmp_path / folder), OBS_RAW).count() == 6


def test_append_twice_then_dedup(spark, tmp_path):
    path = str(tmp_path / "obs")
    files.append_json_lines(observations(spark), path)
    files.append_json_lines(observations(spark), path)
    stored = files.read_json_lines(spark, path)
    assert stored.count() == 12
    assert files.dedup_history(stored).count() == 6
    first = files.dedup_history(stored.withColumn("n", F.lit(1)), order=("n",))
    assert first.columns == [*stored.columns, "n"] and first.count() == 6


def test_csv_of_several_paths_is_one_table(spark, tmp_path):
    header = "lon,lat,temp,tempfelt,pressure,humidity,weather,hour,weather_forecast,temp_forecast\n"
    line = "11.25,44.75,281.25,280.5,1009,41,Clouds,3,Clear,279.75\n"
    for name in ("Milano", "Roma"):
        (tmp_path / f"{name}.csv").write_text(header + line)
    rows = files.read_csv(spark, [str(tmp_path / "Milano.csv"), str(tmp_path / "Roma.csv")])
    assert rows.count() == 2
    assert tuple(rows.first()) == (
        11.25, 44.75, 281.25, 280.5, 1009.0, 41.0, "Clouds", 3, "Clear", 279.75)


def test_catalogue(spark, tmp_path):
    path = tmp_path / "cities.json"
    entries = [{"id": 1, "country": "IT", "name": "x"}, {"id": 2, "country": "FR"}, {"id": 3, "country": "IT"}]
    path.write_text(json.dumps(entries, indent=1))
    ids = s.filter_country(files.read_catalogue(spark, str(path)), "IT")
    assert sorted(r.id for r in ids.collect()) == ["1", "3"]


def test_observation_arrays(spark, tmp_path):
    path = tmp_path / "Milano.json"
    path.write_text(json.dumps([dict(zip(OBS_RAW.fieldNames(), ROW))] * 2))
    rows = files.read_observation_arrays(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [ROW, ROW]


def test_json_pages_hold_all_rows_in_order(spark):
    df = spark.createDataFrame([("a", i) for i in range(25)] + [("b", 0)], "name string, id bigint")
    pages = s.json_pages(df, ["id"], ["id"], page_rows=10, max_rows=7).orderBy("name", "page").collect()
    assert [(p.name, p.page, p.n) for p in pages] == [("a", 0, 10), ("a", 1, 10), ("a", 2, 5), ("b", 0, 1)]
    listed = [e["id"] for p in pages if p.name == "a" for e in json.loads(p.json)]
    assert listed == list(range(25))


def test_json_array_files(spark, tmp_path):
    pages = s.json_pages(observations(spark), list(OBS_RAW.fieldNames()), ["ts"], page_rows=2)
    files.write_json_arrays(pages, str(tmp_path / "paged"))
    back = files.read_json_arrays(spark, str(tmp_path / "paged"))
    assert back.count() == 6 and back.exceptAll(observations(spark)).count() == 0
    paged = files.read_observation_arrays(spark, str(tmp_path / "paged"))
    assert paged.exceptAll(observations(spark)).count() == 0 and paged.count() == 6
    whole = s.json_pages(observations(spark), list(OBS_RAW.fieldNames()), ["ts"])
    files.write_json_arrays(whole, str(tmp_path / "whole"))
    for folder in (tmp_path / "whole").glob("name=*"):
        (file,) = folder.glob("page=0/*.txt")
        assert len(json.loads(file.read_text())) == 3


def hour(n, *conditions):
    return {"dt": n * 3600, "temp": 280.0 + n, "feels_like": 279.0, "pressure": 1000, "humidity": 50,
            "weather": [{"main": c} for c in conditions]}


def test_offline_path(spark, tmp_path):
    """Documents to CSV: repeated hours shift by rows, and the first three rows are dropped."""
    folder = tmp_path / "documents"
    folder.mkdir()
    hourly = [hour(0, "Clear"), hour(1, "Mist", "Drizzle"), hour(2, "Snow"), hour(3, "Clouds"), hour(26, "Smoke")]
    for name in ("Milano", "Roma"):
        document = {"lat": 45.0, "lon": 9.0, "current": {"dt": 0}, "hourly": hourly + hourly[:2]}
        (folder / f"{name}.json").write_text(json.dumps(document, indent=1))
    (folder / "Lecce.json").write_text("{ cut short")
    (folder / "Udine.json").write_text(json.dumps({"lat": 1.0, "hourly": hourly}))
    documents = files.read_history(spark, str(folder))
    broken = rejected_history_documents(documents)
    assert sorted(r.name for r in broken.collect()) == ["Lecce", "Udine"]
    (folder / "Bari.json").write_text(json.dumps({"lat": 1.0, "lon": 2.0, "hourly": hourly[:2]}))
    out = str(tmp_path / "csv")
    build_training_files(spark, str(folder), out)
    rows = files.read_csv(spark, out, key="name").orderBy("name", "temp").collect()
    want = [(3, "Snow", "Clear", 280.0), (3, "Clouds", "Fog", 281.0), (2, "Fog", "Rain", 281.0)]
    want[0] = (2, "Snow", "Clear", 280.0)
    want[1] = (3, "Clouds", "Fog", 281.0)
    assert [(r.hour, r.weather, r.weather_forecast, r.temp_forecast) for r in rows] == want * 2
    assert [r.name for r in rows] == ["Milano"] * 3 + ["Roma"] * 3


def test_stations(spark):
    listed = s.default_stations(spark)
    assert listed.count() == len(STATIONS) == 20
    plan = s.backfill_plan(listed, as_of=1700039358)
    assert plan.count() == 100
    days = {r.day: r.dt for r in plan.filter("name = 'Roma'").collect()}
    assert days == {k: 1700039358 - k * 86400 for k in range(1, 6)}


def test_batches_of_twenty(spark):
    ids = spark.range(45).withColumnRenamed("id", "id")
    batches = s.batch_ids(ids, ["id"], max_rows=10).orderBy("batch").collect()
    assert [b.n for b in batches] == [20, 20, 5]
    assert ",".join(b.ids for b in batches) == ",".join(map(str, range(45)))


def test_shuffle_is_a_permutation_and_repeats(spark):
    ids = spark.range(50)
    once = [r.id for r in s.shuffle_ids(ids).collect()]
    assert sorted(once) == list(range(50)) and once != list(range(50))
    assert once == [r.id for r in s.shuffle_ids(ids.repartition(5)).collect()]
    assert once != [r.id for r in s.shuffle_ids(ids, seed=14).collect()]


def test_pages_share_files(spark, tmp_path):
    """Each page's rows come back with its number, from far fewer files than pages."""
    df = spark.createDataFrame([(f"s{i % 40}", float(i), *ROW[2:]) for i in range(400)], OBS_RAW)
    pages = s.json_pages(df, list(OBS_RAW.fieldNames()), ["ts"], page_rows=4, number="page")
    files.write_json_arrays(pages, str(tmp_path / "paged"), per_file=60)
    assert len(list((tmp_path / "paged").glob("**/*.txt"))) <= 2 < pages.count() == 120
    back = files.read_observation_arrays(spark, str(tmp_path / "paged"), page="page")
    assert back.drop("page").exceptAll(df).count() == 0 and back.count() == 400
    assert {(r.name, r.ts): r.page for r in back.collect()} == {(f"s{i % 40}", float(i)): i // 40 // 4 for i in range(400)}


def test_documents_share_files(spark, tmp_path):
    hourly = [hour(0, "Clear"), hour(1, "Mist", "Drizzle")]
    texts = [(f"s{i}", 0, json.dumps({"name": f"s{i}", "lon": float(i), "lat": 1.0, "hourly": hourly})) for i in range(50)]
    documents = spark.createDataFrame(texts, "name string, page bigint, value string")
    files.write_documents(documents, str(tmp_path / "documents"), ["name", "page"], per_file=25)
    assert len(list((tmp_path / "documents").glob("**/*.txt"))) <= 2
    read = files.read_history(spark, str(tmp_path / "documents"), name="name")
    assert {r.name: (r.lon, len(r.hourly)) for r in read.collect()} == {f"s{i}": (float(i), 2) for i in range(50)}
    assert rejected_history_documents(read).count() == 0


@pytest.mark.parametrize("name", ["json_roundtrip", "read_csv_roundtrip", "append_history_dedup",
                                  "json_array_roundtrip", "history_documents", "append_history_stream"])
def test_files_do_not_grow_with_the_stations(spark, tmp_path, monkeypatch, name):
    from obsflow.plans import queries_models, queries_tables
    from obsflow.plans.registry import QUERIES

    data, out = str(tmp_path / "data"), []

    def scratch(_, label):
        out.append(tmp_path / f"{label}-{len(out)}")
        return str(out[-1])

    for module in (queries_models, queries_tables):
        monkeypatch.setattr(module, "scratch_path", scratch)
    moment = F.timestamp_seconds(1704067200 + F.col("id") * 60 % 2592000).cast("timestamp_ntz")
    spark.range(1500).select(
        F.col("id").alias("event_id"), moment.alias("ts"), (F.col("id") % 250).alias("user_id"), F.lit("view").alias("event_type"),
        F.col("id").cast("double").alias("value"), F.format_string('{"k": %d}', F.col("id") % 97).alias("props"),
    ).coalesce(1).write.parquet(f"{data}/events.parquet")
    assert QUERIES[name](spark, data).count() > 700
    folders = {p.parent for path in out for p in path.glob("**/part-*")}
    assert len(folders) <= 2 + queries_tables.STATION_BUCKETS
