"""Message text to observations, with unreadable messages set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from obsflow.functions.messages import is_complete, parse_observation
from obsflow.functions.weather import hour_of_epoch, merge_weather
from obsflow.schemas import OBS_COLUMNS, OBS_RAW_COLUMNS


def _parsed_where(column: str, wanted) -> Column:
    """A list of the parsed message, or of nothing where ``wanted`` turns it down.

    Exploding this list filters on the parsed fields and parses once. A filter would be moved
    below the projection and would parse again for every field it names.
    """
    return F.filter(F.array(parse_observation(column)), wanted)


def read_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """Raw observation columns of the messages that are whole."""
    rows = messages.select(F.explode(_parsed_where(column, is_complete)).alias("_parsed"))
    return rows.select(*[F.col(f"_parsed.{c}").alias(c) for c in OBS_RAW_COLUMNS])


def to_observations(raw: DataFrame, offset: float = 2, wrap: bool = False) -> DataFrame:
    """Merge classes and add ``hour``; ``ts`` stays, so later steps can order rows by it."""
    return raw.withColumns({
        "weather": merge_weather("weather"), "hour": hour_of_epoch("ts", offset, wrap),
    })


def decode_messages(messages: DataFrame, column: str = "value", **hour) -> DataFrame:
    return to_observations(read_messages(messages, column), **hour)


def rejected_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """The text of the messages that are not whole."""
    broken = F.explode(_parsed_where(column, lambda parsed: ~is_complete(parsed)))
    return messages.select(F.col(column).alias("value"), broken.alias("_parsed")).select("value")


def parse_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """All messages: raw observation columns, and ``rejected``, the text of those not whole.

    For batches that are persisted before both kinds are used; ``rejected`` is null for the rest.
    """
    parsed = messages.select(F.col(column).alias("value"), parse_observation(column).alias("_parsed"))
    broken = F.when(~is_complete(F.col("_parsed")), F.coalesce("value", F.lit("")))
    return parsed.select(
        *[F.col(f"_parsed.{c}").alias(c) for c in OBS_RAW_COLUMNS], broken.alias("rejected")
    )


def archive_columns(observations: DataFrame) -> DataFrame:
    """The nine archived columns in table order."""
    return observations.select(*OBS_COLUMNS)
