import pytest
from pyspark.sql import functions as F

from obsflow.sources.archive import ArchiveTable, KeyedArchive, create_archive_table, latest_per_key

SCHEMA = "name string, hour double, ts double, event_id bigint, temp double"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def archive(spark, tmp_path):
    return KeyedArchive(spark, str(tmp_path / "archive"), frame(spark).schema)


def content(store):
    return sorted((tuple(r[c] for c in ("name", "hour", "ts", "event_id", "temp")) for r in store.read().collect()), key=str)


def files(store):
    """Data files by the hour they hold."""
    rows = store.read().select("hour", F.col("_metadata.file_path").alias("file")).distinct().collect()
    return {(r.hour, r.file) for r in rows}


A1, A2 = ("a", 1.0, 10.0, 1, 5.0), ("a", 1.0, 20.0, 2, 6.0)
B1, B2 = ("b", 1.0, 10.0, 3, 7.0), ("b", 2.0, 10.0, 4, 8.0)
N1 = (None, None, 10.0, 5, 9.0)


def test_empty(spark, tmp_path):
    store = archive(spark, tmp_path)
    assert content(store) == []
    assert store.upsert(frame(spark)) == 0
    assert content(store) == []


def test_latest_wins_whatever_the_arrival(spark, tmp_path):
    store = archive(spark, tmp_path)
    assert store.upsert(frame(spark, A2, B1)) == 1
    assert store.upsert(frame(spark, A1, B2, N1)) == 3
    assert content(store) == sorted([A2, B1, B2, N1], key=str)


def test_ties_are_broken_by_the_row_number(spark):
    rows = frame(spark, A1, (*A1[:3], 9, 1.0), (*A1[:3], 5, 2.0))
    assert [r.event_id for r in latest_per_key(rows).collect()] == [9]


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    store = archive(spark, tmp_path)
    for rows in ((A1, B1), (A2, B2), (A1, B1), (A2, B2)):
        store.upsert(frame(spark, *rows))
    assert content(store) == [A2, B1, B2]


def test_other_partitions_keep_their_files(spark, tmp_path):
    store = archive(spark, tmp_path)
    store.upsert(frame(spark, A1, B2))
    before = files(store)
    store.upsert(frame(spark, A2, B1))
    after = files(store)
    assert {f for f in before if f[0] == 2.0} == {f for f in after if f[0] == 2.0}
    assert not {f for f in before if f[0] == 1.0} & {f for f in after if f[0] == 1.0}
    assert content(store) == [A2, B1, B2]


def test_only_touched_partitions_are_read(spark, tmp_path):
    store = archive(spark, tmp_path)
    store.upsert(frame(spark, A1, B2))
    from obsflow.sources.archive import _within
    part = store.read().filter(_within([{"hour": 2.0}], ("hour",)))
    assert "PartitionFilters: [(hour" in part._jdf.queryExecution().executedPlan().toString()
    assert [r.name for r in part.collect()] == ["b"]


def test_partitions_are_key_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="key"):
        KeyedArchive(spark, str(tmp_path / "a"), frame(spark).schema, partition_by=("temp",))
    store = KeyedArchive(spark, str(tmp_path / "b"), frame(spark).schema, partition_by=("hour", "name"))
    store.upsert(frame(spark, A1, B2))
    store.upsert(frame(spark, A2, B1, N1))
    assert content(store) == sorted([A2, B1, B2, N1], key=str)


def test_opened_again(spark, tmp_path):
    archive(spark, tmp_path).upsert(frame(spark, A1, B1))
    again = archive(spark, tmp_path)
    again.upsert(frame(spark, A2))
    assert content(again) == [A2, B1]
    again.create_view("archive_view")
    assert spark.sql("SELECT count(*) FROM archive_view").first()[0] == 2
    plain = spark.read.parquet(again.path)
    assert plain.count() == 2 and set(plain.columns) == {"name", "hour", "ts", "event_id", "temp"}


def test_table(spark, tmp_path):
    create_archive_table(spark, "kept_rows", str(tmp_path / "table"), frame(spark).schema)
    try:
        store = ArchiveTable(spark, "kept_rows")
        store.upsert(frame(spark, A1, B2))
        before = files(store)
        store.upsert(frame(spark, A2, B1))
        assert content(store) == [A2, B1, B2]
        assert {f for f in before if f[0] == 2.0} == {f for f in files(store) if f[0] == 2.0}
        assert spark.sql("SELECT count(*) FROM kept_rows WHERE hour = 1.0").first()[0] == 2
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    finally:
        spark.sql("DROP TABLE kept_rows")


def test_create_table_is_idempotent(spark, tmp_path):
    for _ in range(2):
        create_archive_table(spark, "latest_rows", str(tmp_path / "table"))
    assert sorted(spark.table("latest_rows").columns) == sorted([
        "name", "hour", "lon", "lat", "temp", "tempfelt", "pressure", "humidity", "weather"])
    spark.sql("DROP TABLE latest_rows")
