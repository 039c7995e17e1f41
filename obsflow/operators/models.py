"""The two chained models: temperature, then class with the forecast temperature as a feature."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, functions as F

from obsflow.operators.features import (
    class_encoder, class_indexer, classification_assembler, index_to_label, regression_assembler,
)
from obsflow.schemas import FORECAST

REGRESSION_FEATURES = "regression_features"
CLASSIFICATION_FEATURES = "classification_features"
LABEL_INDEX = "label_index"


def fit_encoding(train: DataFrame) -> PipelineModel:
    """Indexer and one-hot encoder, fitted once; scoring reuses them."""
    indexer = class_indexer().fit(train)
    encoder = class_encoder().fit(indexer.transform(train.select("weather")))
    return PipelineModel([indexer, encoder])


def regression_data(train: DataFrame, encoding: PipelineModel) -> DataFrame:
    assembler = regression_assembler(REGRESSION_FEATURES)
    return assembler.transform(encoding.transform(train)).select(
        REGRESSION_FEATURES, F.col("temp_forecast").alias("label")
    )


def with_features(rows: DataFrame, encoding: PipelineModel) -> DataFrame:
    """Rows to score, with the feature vectors of those models whose inputs they have."""
    out = regression_assembler(REGRESSION_FEATURES).transform(
        PipelineModel([encoding.stages[0].copy().setHandleInvalid("skip"), encoding.stages[1]]).transform(rows))
    if "temp_forecast" in rows.columns:
        out = classification_assembler(CLASSIFICATION_FEATURES).transform(out)
    return out


def fit_boosted(data: DataFrame, max_iter: int = 20, max_depth: int = 5, seed: int = 13):
    return GBTRegressor(
        featuresCol=REGRESSION_FEATURES, labelCol="label", predictionCol="temp_forecast",
        maxIter=max_iter, maxDepth=max_depth, stepSize=0.1, seed=seed,
    ).fit(data)


def fit_linear(data: DataFrame, features: str = REGRESSION_FEATURES):
    return LinearRegression(featuresCol=features, labelCol="label").fit(data)


def fit_label_indexer(train: DataFrame) -> StringIndexerModel:
    return class_indexer("weather_forecast", LABEL_INDEX).fit(train)


def classification_data(train: DataFrame, encoding: PipelineModel, labels: StringIndexerModel):
    """Training rows of the classifier; its temperature feature is the true label."""
    assembler = classification_assembler(CLASSIFICATION_FEATURES)
    return labels.transform(assembler.transform(encoding.transform(train))).select(
        CLASSIFICATION_FEATURES, LABEL_INDEX
    )


def fit_tree(data: DataFrame, max_depth: int = 5, seed: int = 13):
    return DecisionTreeClassifier(
        featuresCol=CLASSIFICATION_FEATURES, labelCol=LABEL_INDEX,
        predictionCol="class_prediction", rawPredictionCol="class_raw",
        probabilityCol="class_probability", maxDepth=max_depth, maxBins=32, impurity="gini",
        seed=seed,
    ).fit(data)


def fit_forecaster(train: DataFrame, max_iter: int = 20, max_depth: int = 5, seed: int = 13,
                   labels=None) -> PipelineModel:
    """Fit both models and chain them into one artefact, label names included.

    ``labels`` overrides the class names of the predicted indices; left out, they are those of
    the indexer the classifier was trained with.
    """
    encoding = fit_encoding(train)
    boosted = fit_boosted(regression_data(train, encoding), max_iter, max_depth, seed)
    label_indexer = fit_label_indexer(train)
    tree = fit_tree(classification_data(train, encoding, label_indexer), max_depth, seed)
    indexer, encoder = encoding.stages
    return PipelineModel([
        indexer.copy().setHandleInvalid("skip"), encoder,
        regression_assembler(REGRESSION_FEATURES), boosted,
        classification_assembler(CLASSIFICATION_FEATURES), tree,
        index_to_label(labels or label_indexer.labels, "class_prediction"),
    ])


def worked_out(rows: DataFrame, column: str = "weather") -> DataFrame:
    """The same rows, with ``column`` worked out before anything filters on it.

    The indexer's filter would be moved below the projections and work the class out again, once
    for each time its expression names its source. Filters are not moved below an exploded list.
    """
    return rows.select(*[F.explode(F.array(c)).alias(c) if c == column else F.col(c) for c in rows.columns])


def score(observations: DataFrame, forecaster: PipelineModel) -> DataFrame:
    """Batch or streaming observations plus ``temp_forecast`` and ``predicted_label``.

    Rows of classes the training never saw are skipped.
    """
    scored = forecaster.transform(worked_out(observations))
    return scored.select(*observations.columns, "temp_forecast", "predicted_label")


def forecast_columns(scored: DataFrame) -> DataFrame:
    """The six forecast columns, typed."""
    source = {
        "lon": "lon", "lat": "lat", "cweather": "weather", "fweather": "predicted_label",
        "ctemp": "temp", "ftemp": "temp_forecast",
    }
    return scored.select(
        *[F.col(source[f.name]).cast(f.dataType).alias(f.name) for f in FORECAST.fields]
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def regression_error(predictions: DataFrame, prediction: str = "temp_forecast") -> float:
    return RegressionEvaluator(
        labelCol="label", predictionCol=prediction, metricName="rmse"
    ).evaluate(predictions)


def classification_error(predictions: DataFrame) -> float:
    return 1.0 - MulticlassClassificationEvaluator(
        labelCol=LABEL_INDEX, predictionCol="class_prediction", metricName="accuracy"
    ).evaluate(predictions)
