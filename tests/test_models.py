import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from obsflow.operators import features as f, models as ml
from obsflow.operators.aggregates import label_index
from obsflow.operators.labels import training_table
from obsflow.operators.split import hash_split, random_split

CLASSES = ["Clouds"] * 5 + ["Clear"] * 4 + ["Rain"] * 3 + ["Fog"] * 2 + ["Snow"]


@pytest.fixture(scope="module")
def train(spark):
    """Temperatures that climb, so that three rows before is three degrees colder."""
    rows = [(f"st_{s}", float(i * 3600), i, 9.0 + s, 45.0, 270.0 + (i + 5 * s) % 40,
             269.0, 1000.0, 50.0, CLASSES[(i + s) % 15]) for s in range(4) for i in range(300)]
    raw = spark.createDataFrame(
        rows, "name string, ts double, event_id bigint, lon double, lat double, temp double,"
              "tempfelt double, pressure double, humidity double, weather string")
    return training_table(raw, keep=("name", "event_id")).cache()


@pytest.fixture(scope="module")
def forecaster(train):
    return ml.fit_forecaster(train, max_iter=5)


def test_indexer_orders_by_frequency(train):
    labels = f.class_indexer().fit(train).labels
    assert labels[:2] == ["Clouds", "Clear"] and labels[-1] == "Snow"
    listed = label_index(train).orderBy("index").collect()
    assert [r.label for r in listed] == labels
    assert [r["index"] for r in listed] == list(range(5))


def test_equal_frequencies_order_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "weather string")
    assert f.class_indexer().fit(df).labels == ["c", "a", "b"]


@pytest.mark.parametrize("policy, rows", [("skip", 1), ("keep", 2), ("constant", 2)])
def test_unseen_class(spark, train, policy, rows):
    indexer = f.class_indexer().fit(train)
    df = spark.createDataFrame([("Clear",), ("Squall",)], "weather string")
    got = f.apply_index(df, indexer, policy).collect()
    assert len(got) == rows
    if policy == "constant":
        assert {r.weather for r in got} == {1.0}
    if policy == "keep":
        assert got[1][f.INDEX] == 5.0


def test_unseen_class_error(spark, train):
    indexer = f.class_indexer().fit(train)
    df = spark.createDataFrame([("Squall",)], "weather string")
    with pytest.raises(Exception):
        f.apply_index(df, indexer, "error").collect()
    with pytest.raises(ValueError):
        f.apply_index(df, indexer, "other")


def test_vector_widths(train):
    encoding = ml.fit_encoding(train)
    data = ml.regression_data(train, encoding).first()
    assert data[0].size == 11
    data = ml.classification_data(train, encoding, ml.fit_label_indexer(train)).first()
    assert data[0].size == 12


def test_boosted_trees_beat_persistence(train):
    fit, test = hash_split(train, F.concat("name", F.col("event_id").cast("string")))
    encoding = ml.fit_encoding(fit)
    data = ml.regression_data(test, encoding)
    boosted = ml.fit_boosted(ml.regression_data(fit, encoding), max_iter=10)
    error = ml.regression_error(boosted.transform(data))
    linear = ml.fit_linear(ml.regression_data(fit, encoding))
    persistence = test.agg(F.sqrt(F.avg(F.pow(F.col("temp") - F.col("temp_forecast"), 2)))).first()[0]
    assert error < ml.regression_error(linear.transform(data), "prediction") < persistence


def test_tree_error(train):
    encoding, labels = ml.fit_encoding(train), ml.fit_label_indexer(train)
    data = ml.classification_data(train, encoding, labels)
    error = ml.classification_error(ml.fit_tree(data).transform(data))
    assert 0 <= error < 0.6


def test_one_artefact(spark, train, forecaster, tmp_path):
    live = train.withColumn("hour", F.col("hour").cast("double")).drop(
        "weather_forecast", "temp_forecast")
    before = ml.score(live, forecaster)
    ml.save_model(forecaster, str(tmp_path / "model"))
    after = ml.score(live, ml.load_model(str(tmp_path / "model")))
    assert before.count() == train.count()
    assert before.exceptAll(after).count() == 0
    assert ml.forecast_columns(before).columns == ["lon", "lat", "cweather", "fweather", "ctemp", "ftemp"]


def test_label_override(train, forecaster):
    names = ["c0", "c1", "c2", "c3", "c4"]
    forced = ml.fit_forecaster(train, max_iter=5, labels=names)
    live = train.drop("weather_forecast", "temp_forecast")
    pairs = ml.score(live, forecaster).join(
        ml.score(live, forced).select("name", "event_id", F.col("predicted_label").alias("forced")),
        ["name", "event_id"]).select("predicted_label", "forced").distinct().collect()
    own = forecaster.stages[-1].getLabels()
    assert {(r[0], r[1]) for r in pairs} <= set(zip(own, names))


def test_unknown_classes_are_not_scored(spark, train, forecaster):
    live = train.drop("weather_forecast", "temp_forecast").limit(2).withColumn("weather", F.lit("Squall"))
    assert ml.score(live, forecaster).count() == 0


def test_class_is_worked_out_once(spark, train, forecaster):
    live = train.drop("weather_forecast", "temp_forecast")
    packed = live.withColumn("weather", F.to_json(F.struct("weather")))
    taken = F.get_json_object("weather", "$.weather")
    again = packed.withColumn("weather", F.when(taken == "Fog", "Clear").when(taken == "Rain", "Clouds").otherwise(taken))
    scored = ml.score(again, forecaster)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and not [line for line in plan.splitlines() if "Filter" in line and "get_json_object" in line]
    assert scored.columns[:len(live.columns)] == live.columns and scored.count() == live.count()
    empty = ml.worked_out(spark.createDataFrame([(1, None), (1, None), (2, "a")], "n int, weather string"))
    assert sorted(empty.collect(), key=str) == sorted([(1, None), (1, None), (2, "a")], key=str)


def test_splits(train):
    key = F.concat("name", F.col("event_id").cast("string"))
    first, second = hash_split(train, key)
    again, _ = hash_split(train.repartition(7), key)
    assert first.count() + second.count() == train.count()
    assert first.exceptAll(again).count() == 0
    assert sum(part.count() for part in random_split(train)) == train.count()


def test_leaves_of_full_trees(train):
    """At full depth on all features, each leaf forecasts the mean or the most frequent class of
    the rows that reach it; both trees have many leaves."""
    encoding, labels = ml.fit_encoding(train), ml.fit_label_indexer(train)
    data = ml.regression_data(train, encoding)
    boosted = ml.fit_boosted(data, max_iter=1).setLeafCol("leaf")
    leaves = boosted.transform(data).groupBy(vector_to_array("leaf")[0].alias("leaf")).agg(
        F.avg("label").alias("mean"), F.min("temp_forecast").alias("low"), F.max("temp_forecast").alias("high")).collect()
    assert len(leaves) > 10
    for leaf in leaves:
        assert leaf.low == leaf.high and abs(leaf.mean - leaf.low) < 1e-9
    data = ml.classification_data(train, encoding, labels)
    tree = ml.fit_tree(data).setLeafCol("leaf")
    scored = tree.transform(data)
    votes = {}
    for r in scored.groupBy("leaf", ml.LABEL_INDEX, "class_prediction").count().collect():
        votes.setdefault(r.leaf, []).append((-r["count"], r[ml.LABEL_INDEX], r.class_prediction))
    assert len(votes) > 5
    for leaf in votes.values():
        assert {v[2] for v in leaf} == {min(leaf)[1]}


def test_parts_of_the_chain(spark, train, forecaster):
    """The chain equals its parts put together by hand, and not with another temperature."""
    from obsflow.plans.queries_models import forecast_by_parts

    rows = train.select("event_id", "lon", "lat", F.col("hour").cast("double").alias("hour"), "temp", "tempfelt",
                        "pressure", "humidity", "weather").dropDuplicates(["event_id"])
    chain = ml.score(rows, forecaster).join(forecast_by_parts(spark, rows, forecaster), "event_id")
    assert chain.filter("temp_forecast <> part_temp or predicted_label <> part_label").count() == 0
    swapped = ml.score(rows, forecaster).join(forecast_by_parts(spark, rows, forecaster, "temp"), "event_id")
    assert swapped.filter("predicted_label <> part_label").count() > 0
