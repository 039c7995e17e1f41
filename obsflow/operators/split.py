"""Train/test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def in_training(key, tenths: int = 8) -> Column:
    """True for ``tenths`` of ten keys, decided by the key alone, so any layout splits alike."""
    text = F.col(key).cast("string") if isinstance(key, str) else key.cast("string")
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return number % 10 < tenths


def hash_split(df: DataFrame, key, tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    chosen = in_training(key, tenths)
    return df.filter(chosen), df.filter(~chosen)


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 13) -> list[DataFrame]:
    """Seeded random split; unlike ``hash_split`` it depends on the partition layout."""
    return df.randomSplit(list(weights), seed)
