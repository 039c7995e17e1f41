"""The split paths against brute force: ties, nulls, hot groups, one hot timestamp."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from obsflow.operators.labels import label_asof_offset
from obsflow.operators.ordered import divide, fill_forward, join_unique, row_positions, shift_rows

SCHEMA = "name string, ts double, id bigint, value double"


def rows(seed=1, count=600):
    """Half of the rows in one station, a third of those at one moment; null keys and times."""
    rng = random.Random(seed)
    out = []
    for i in range(count):
        name = "hot" if i % 2 else rng.choice(["a", "b", "c", None])
        ts = 500.0 if i % 3 == 0 else rng.choice([None, 1e9, float(rng.randint(0, 1000))])
        out.append((name, ts, i, float(i)))
    rng.shuffle(out)
    return out


def brute(data, key=True):
    """Rows per group in order, nulls first."""
    groups = {}
    for r in data:
        groups.setdefault(r[0] if key else 0, []).append(r)
    for members in groups.values():
        members.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    return groups


@pytest.mark.parametrize("n", [1, 3, -3])
@pytest.mark.parametrize("max_rows", [None, 2, 40])
def test_shift_rows(spark, n, max_rows):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    got = shift_rows(df, {"shifted": "value"}, n, ["name"], ["ts", "id"], max_rows)
    assert got.columns == ["name", "ts", "id", "value", "shifted"]
    result = {r.id: r.shifted for r in got.collect()}
    assert len(result) == len(data) == got.count()
    for members in brute(data).values():
        for i, r in enumerate(members):
            source = i - n
            want = members[source][3] if 0 <= source < len(members) else None
            assert result[r[2]] == want


@pytest.mark.parametrize("max_rows", [None, 3, 25, 1000])
def test_row_positions(spark, max_rows):
    data = rows(2)
    df = spark.createDataFrame(data, SCHEMA)
    got = row_positions(df, ["name"], ["ts", "id"], max_rows=max_rows)
    result = {r.id: r.position for r in got.collect()}
    for members in brute(data).values():
        assert [result[r[2]] for r in members] == list(range(len(members)))


@pytest.mark.parametrize("max_rows", [None, 2, 40])
def test_fill_forward(spark, max_rows):
    """Gaps longer than cells, groups that begin or consist of nulls."""
    data = [(n, t, i, v if i % 7 == 3 and 50 < i else None) for n, t, i, v in rows(8)]
    df = spark.createDataFrame(data, SCHEMA)
    got = fill_forward(df, "value", ["name"], ["ts", "id"], "filled", max_rows)
    assert got.columns == ["name", "ts", "id", "value", "filled"]
    result = {r.id: r.filled for r in got.collect()}
    assert len(result) == len(data) == got.count()
    for members in brute(data).values():
        last = None
        for r in members:
            last = r[3] if r[3] is not None else last
            assert result[r[2]] == last
    whole = {r.id: r.filled for r in fill_forward(df, "value", [], ["ts", "id"], "filled", max_rows).collect()}
    last = None
    for r in brute(data, key=False)[0]:
        last = r[3] if r[3] is not None else last
        assert whole[r[2]] == last


@pytest.mark.parametrize("max_rows", [None, 5])
@pytest.mark.parametrize("hours, tolerance", [(3, 1), (3, 3), (0.5, 0.25)])
def test_label_asof(spark, max_rows, hours, tolerance):
    rng = random.Random(4)
    data = [(rng.choice("ab"), float(rng.randrange(0, 40) * 900), i, rng.random(), f"c{i}") for i in range(120)]
    df = spark.createDataFrame(data, "name string, ts double, event_id bigint, temp double, weather string")
    got = label_asof_offset(df, hours, tolerance, max_rows=max_rows).collect()
    assert len(got) == len(data)
    for r in got:
        late = r.ts + hours * 3600
        before = [(x[1], x[2], x) for x in data if x[0] == r.name and x[1] <= late]
        newest = max(before)[2]
        want = (newest[4], newest[3]) if newest[1] > late - tolerance * 3600 else (None, None)
        assert (r.weather_forecast, r.temp_forecast) == want


@pytest.mark.parametrize("max_rows", [3, 50, 10_000])
def test_row_positions_of_the_whole_input(spark, max_rows):
    data = rows(3)
    got = row_positions(spark.createDataFrame(data, SCHEMA), [], ["ts", "id"], max_rows=max_rows)
    result = {r.id: r.position for r in got.collect()}
    ordered = brute(data, key=False)[0]
    assert [result[r[2]] for r in ordered] == list(range(len(data)))


def largest_cell(df, bound, keys=("name",)):
    rest, cells = divide(df, list(keys), ["ts", "id"], bound)
    assert rest.count() + cells.count() == df.count()
    return cells.groupBy(*keys, "_cell").count().agg({"count": "max"}).first()[0]


def test_cells_are_bounded(spark):
    data = [("hot", 5.0, i, 0.0) for i in range(1000)] + [("a", float(i), i, 0.0) for i in range(9)]
    df = spark.createDataFrame(data, SCHEMA)
    assert largest_cell(df, 50) <= 50
    rest, _ = divide(df, ["name"], ["ts", "id"], 50)
    assert {r.name for r in rest.collect()} == {"a"}


def test_nan_infinity_and_outliers_do_not_keep_a_group_whole(spark):
    odd = [float("nan"), float("inf"), float("-inf"), None, 1e300, -1e300]
    data = [("hot", odd[i] if i < 6 else float(i), i, float(i)) for i in range(1000)]
    df = spark.createDataFrame(data, SCHEMA)
    assert largest_cell(df, 50) <= 50
    got = {r.id: r.position for r in row_positions(df, ["name"], ["ts", "id"], max_rows=50).collect()}
    assert got == {r.id: r.position for r in row_positions(df, ["name"], ["ts", "id"]).collect()}


def test_a_small_file_that_explodes_is_counted(spark, tmp_path):
    spark.range(20).select(F.array_repeat(F.lit(1.0), 500).alias("x"), "id").coalesce(1).write.parquet(f"{tmp_path}/p")
    rows = spark.read.parquet(f"{tmp_path}/p").select(F.lit("hot").alias("name"), F.posexplode("x").alias("ts", "v"), "id")
    assert largest_cell(rows, 700) <= 700


def test_equal_order_values_end_the_division(spark):
    data = [("hot", 5.0, 7, float(i)) for i in range(100)]
    _, cells = divide(spark.createDataFrame(data, SCHEMA), ["name"], ["ts", "id"], 10)
    assert cells.count() == 100


def test_lag_then_lead_restores_the_column(spark):
    data = [(n, float(i), i, float(i)) for i in range(200) for n in ("a", "b")]
    df = spark.createDataFrame(data, SCHEMA)
    lagged = shift_rows(df, {"earlier": "value"}, 3, ["name"], ["ts", "id"], 20)
    back = shift_rows(lagged, {"restored": "earlier"}, -3, ["name"], ["ts", "id"], 20)
    known = back.filter(F.col("restored").isNotNull())
    assert known.count() == 2 * 197
    assert known.filter("restored <> value").count() == 0


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("max_rows", [None, 5, 100])
def test_join_unique(spark, how, max_rows):
    left = spark.createDataFrame(rows(4), SCHEMA)
    right = spark.createDataFrame([("hot", 1), ("a", 2), ("x", 3)], "name string, w int")
    got = join_unique(left, right, ["name"], ["id"], how, max_rows)
    want = left.join(right, ["name"], how)
    key = ["id"]
    pd.testing.assert_frame_equal(
        got.toPandas().sort_values(key, ignore_index=True)[want.columns],
        want.toPandas().sort_values(key, ignore_index=True),
    )


@pytest.mark.parametrize("times", [
    (None, 500.0), (float("nan"), 1.0), (float("inf"), 2.0), (float("-inf"), 2.0, None), (None,),
])
def test_times_that_cannot_be_divided(spark, times):
    data = [("hot", times[i % len(times)], i, float(i)) for i in range(60)]
    df = spark.createDataFrame(data, SCHEMA)
    got = {r.id: r.position for r in row_positions(df, ["name"], ["ts", "id"], max_rows=5).collect()}
    plain = {r.id: r.position for r in row_positions(df, ["name"], ["ts", "id"]).collect()}
    assert got == plain


def test_numbers_closer_than_doubles_tell(spark):
    base = 2**62
    data = [("hot", base + (i * 7) % 40, i) for i in range(40)]
    df = spark.createDataFrame(data, "name string, big bigint, id bigint")
    got = {r.id: r.position for r in row_positions(df, ["name"], ["big", "id"], max_rows=5).collect()}
    assert got == {r[2]: r[1] - base for r in data}


def test_tasks_follow_the_rows_and_not_the_cells(spark):
    df = spark.range(5000).select(F.lit("hot").alias("name"), F.col("id").cast("double").alias("ts"), "id")
    _, cells = divide(df, ["name"], ["ts", "id"], 10)
    assert cells.rdd.getNumPartitions() <= 200
    assert cells.groupBy("_cell").count().agg({"count": "max"}).first()[0] <= 10
    assert cells.count() == 5000


@pytest.mark.parametrize("n", [1, -2])
def test_rows_equal_in_order_are_shifted_once_each(spark, n):
    data = [("hot", float(i // 7), 0, float(i // 7)) for i in range(140)]
    got = shift_rows(spark.createDataFrame(data, SCHEMA), {"shifted": "value"}, n, ["name"], ["ts", "id"], 5)
    want = [data[i - n][3] if 0 <= i - n < 140 else None for i in range(140)]
    by = lambda pair: (pair[0], pair[1] is None, pair[1])
    assert sorted(((r.ts, r.shifted) for r in got.collect()), key=by) == sorted(zip([d[1] for d in data], want), key=by)
