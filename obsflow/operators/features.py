"""Feature columns and vectors."""

from __future__ import annotations

from pyspark.ml.feature import (
    IndexToString, OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from obsflow.constants import FEATURES

INDEX = "weather_index"
ENCODED = "weather_encoded"
NUMERIC = FEATURES
REGRESSION_INPUTS = (*NUMERIC, ENCODED)
CLASSIFICATION_INPUTS = (*NUMERIC, "temp_forecast", ENCODED)
HANDLE_INVALID = ("skip", "keep", "error", "constant")


def class_indexer(column: str = "weather", out: str = INDEX, handle_invalid: str = "error"):
    """Indexer by falling frequency, ties by name; fit it on the whole training data."""
    return StringIndexer(
        inputCol=column, outputCol=out, stringOrderType="frequencyDesc",
        handleInvalid=handle_invalid,
    )


def apply_index(df: DataFrame, indexer: StringIndexerModel, handle_invalid: str = "skip") -> DataFrame:
    """Index classes; ``constant`` drops the class instead and makes it 1.0 for every row."""
    if handle_invalid not in HANDLE_INVALID:
        raise ValueError(f"unknown policy {handle_invalid!r}")
    if handle_invalid == "constant":
        return constant_class(df)
    return indexer.copy().setHandleInvalid(handle_invalid).transform(df)


def constant_class(df: DataFrame, value: float = 1.0, column: str = "weather") -> DataFrame:
    """Replace the class by a constant, the fallback of batches that cannot be encoded."""
    return df.withColumn(column, F.lit(float(value)))


def class_encoder(index: str = INDEX, out: str = ENCODED) -> OneHotEncoder:
    """One slot per class except the last."""
    return OneHotEncoder(inputCols=[index], outputCols=[out], dropLast=True)


def regression_assembler(out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(REGRESSION_INPUTS), outputCol=out)


def classification_assembler(out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(CLASSIFICATION_INPUTS), outputCol=out)


def index_to_label(labels, column: str = "prediction", out: str = "predicted_label") -> IndexToString:
    """Predicted index to class name. Pass the labels of the indexer the model was fitted with."""
    return IndexToString(inputCol=column, outputCol=out, labels=list(labels))


def vector_columns(vector: str, names) -> list[Column]:
    """The slots of a vector as plain columns."""
    slots = vector_to_array(F.col(vector))
    return [slots[i].alias(name) for i, name in enumerate(names)]
