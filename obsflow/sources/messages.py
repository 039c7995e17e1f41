"""Message topics as batch and streaming sources and sinks.

A topic is a Kafka topic, or a folder of text files with one message per line. Both give and
take one string column, ``value``, and everything downstream is the same for either.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from obsflow.functions.messages import encode_observation


@dataclass(frozen=True)
class KafkaTopic:
    topic: str
    servers: str

    def reader_options(self, starting: str, limit: int | None = None, since: float | None = None,
                       limit_bytes: int | None = None) -> dict[str, str]:
        if limit_bytes:
            raise ValueError("a Kafka topic limits offsets, not bytes")
        options = {
            "kafka.bootstrap.servers": self.servers, "subscribe": self.topic, "failOnDataLoss": "false",
        }
        if since is None:
            options["startingOffsets"] = starting
        else:  # a partition with nothing as new as that starts with what comes next
            options |= {"startingTimestamp": str(int(since * 1000)), "startingOffsetsByTimestampStrategy": "latest"}
        if limit:
            options["maxOffsetsPerTrigger"] = str(limit)
        return options

    def read_stream(self, spark: SparkSession, starting: str, **bounds) -> DataFrame:
        reader = spark.readStream.format("kafka").options(**self.reader_options(starting, **bounds))
        return reader.load().selectExpr("cast(value as string) as value")

    def write(self, messages: DataFrame) -> None:
        options = {"kafka.bootstrap.servers": self.servers, "topic": self.topic}
        messages.write.format("kafka").options(**options).save()

    def stream_writer(self, messages: DataFrame) -> DataStreamWriter:
        options = {"kafka.bootstrap.servers": self.servers, "topic": self.topic}
        return messages.writeStream.format("kafka").options(**options)


@dataclass(frozen=True)
class FolderTopic:
    path: str

    def read_stream(self, spark: SparkSession, starting: str, limit: int | None = None,
                    since: float | None = None, limit_bytes: int | None = None) -> DataFrame:
        """All files there are and will be (``starting`` has no meaning for a folder), or those
        written at ``since``, in epoch seconds, or later; files that are gone are passed over."""
        if limit and limit_bytes:
            raise ValueError("limit files or bytes, not both")
        reader = spark.readStream.format("text").option("ignoreMissingFiles", "true")
        if limit:
            reader = reader.option("maxFilesPerTrigger", str(limit))
        if limit_bytes:
            reader = reader.option("maxBytesPerTrigger", str(limit_bytes))
        lines = reader.load(self.path)
        if since is not None:
            written = F.unix_micros("_metadata.file_modification_time")
            lines = lines.filter(written >= int(since * 1_000_000)).select("value")
        return lines

    def write(self, messages: DataFrame) -> None:
        messages.select("value").write.mode("append").text(self.path)

    def stream_writer(self, messages: DataFrame) -> DataStreamWriter:
        return messages.select("value").writeStream.format("text").option("path", self.path)


def read_observation_stream(spark: SparkSession, topic, limit: int | None = None,
                            limit_bytes: int | None = None) -> DataFrame:
    """Live messages from the newest on; ``limit`` bounds offsets or files per micro-batch, and
    ``limit_bytes`` the bytes of a folder's files (one file at least)."""
    return topic.read_stream(spark, "latest", limit=limit, limit_bytes=limit_bytes)


def replay_forecasts(spark: SparkSession, topic, limit: int | None = None, since: float | None = None) -> DataFrame:
    """All forecasts from the first on, or from ``since`` (epoch seconds) on, going on past ranges
    that are gone: the first ones there still are come first."""
    return topic.read_stream(spark, "earliest", limit=limit, since=since)


def observation_messages(observations: DataFrame, style: str = "json", keyed: bool = False):
    """One message per raw observation; ``keyed`` adds the station as the message key."""
    value = encode_observation(style).alias("value")
    return observations.select(*([F.col("name").alias("key")] if keyed else []), value)


def publish(topic, messages: DataFrame) -> None:
    """Write a batch with one string column ``value`` (and ``key`` for keyed Kafka topics)."""
    topic.write(messages)
