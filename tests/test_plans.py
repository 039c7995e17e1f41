"""Physical plans: one parse, pruned scans, shared shuffles. See test_oracle for joins."""

import re

from pyspark.sql import functions as F

from obsflow.operators.labels import label_lag, training_table
from obsflow.operators.messages import decode_messages, rejected_messages
from obsflow.operators.ordered import join_unique, row_positions
from obsflow.plans.testview import observations
from obsflow.sources.archive import latest_per_key

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_messages_are_parsed_once(spark, tmp_path):
    path = str(tmp_path / "messages")
    spark.createDataFrame([("x",)], "value string").write.text(path)
    for read in (decode_messages, rejected_messages):
        assert plan(read(spark.read.text(path))).count("from_json(") == 1


def scanned(df):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<([^>]*)>", plan(df)).group(1)))


def test_scans_are_pruned(spark):
    obs = observations(spark, SF)
    lagged = label_lag(obs, outputs={"temp_forecast": "temp"}).select("name", "temp_forecast")
    assert scanned(lagged) == {"event_id", "ts", "user_id", "value"}
    assert scanned(obs.select("lon")) == {"user_id"}


def test_both_labels_share_one_shuffle_and_one_sort(spark):
    text = plan(training_table(observations(spark, SF)))
    assert text.count("Exchange") == 1 and text.count("+- Sort") == 1


def test_latest_rows_are_combined_before_the_shuffle(spark):
    rows = observations(spark, SF).withColumn("hour", F.lit(1.0))
    text = plan(latest_per_key(rows))
    assert text.index("Exchange") < text.index("partial_max_by")


def test_a_hot_join_key_is_dealt_out(spark):
    left = spark.range(100).select("id", F.lit("hot").alias("name"))
    right = spark.createDataFrame([("hot", 1)], "name string, w int")
    dealt = join_unique(left, right, ["name"], ["id"], max_rows=10)
    assert "_share" in plan(dealt) and dealt.count() == 100


def test_no_window_over_the_whole_input(spark):
    rows = row_positions(spark.range(1000), [], ["id"], max_rows=100)
    above_scan = plan(rows).split("Range")[0]
    assert "row_number() windowspecdefinition(_cell" in above_scan
