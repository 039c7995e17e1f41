"""File sources and sinks: CSV tables, JSON lines and whole JSON documents."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from obsflow.functions.text import station_from_path, strip_ends
from obsflow.schemas import CATALOGUE, HISTORY, OBS_RAW, TRAIN
from obsflow.session import materialize


def station_bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _by_folder(df: DataFrame, key: str | None, buckets: int | None) -> tuple[DataFrame, list[str]]:
    """Rows gathered by the folder they go to, and the folder columns.

    One folder per station suits station lists; with ``buckets``, stations share that many
    folders and stay a column. Adaptive execution splits what is large.
    """
    if buckets:
        df, key = df.withColumn("bucket", station_bucket(key, buckets)), "bucket"
    return (df.hint("rebalance", key), [key]) if key else (df, [])


def write_csv(df: DataFrame, path: str, key: str | None = "name", mode: str = "errorifexists",
              buckets: int | None = None):
    """CSV with a header and without an index, in folders per station where ``key`` is given."""
    rows, folders = _by_folder(df, key, buckets)
    rows.write.mode(mode).option("header", True).partitionBy(*folders).csv(path)


def read_csv(spark: SparkSession, paths, schema: StructType = TRAIN, key: str | None = None):
    """Training CSV files of one or several paths as one table; ``key`` is the folder column, or the
    last column of the files where stations share folders."""
    if key:
        schema = StructType([*schema.fields, StructField(key, StringType())])
    return spark.read.schema(schema).option("header", True).csv(paths).select(*schema.fieldNames())


def write_json_lines(df: DataFrame, path: str, key: str = "name", mode: str = "errorifexists",
                     buckets: int | None = None):
    """JSON lines in folders per station; fails if the path already exists."""
    rows, folders = _by_folder(df, key, buckets)
    rows.write.mode(mode).partitionBy(*folders).json(path)


def append_json_lines(df: DataFrame, path: str, key: str = "name", buckets: int | None = None):
    """Add a page of history. A page added twice is removed again by ``dedup_history``."""
    write_json_lines(df, path, key, mode="append", buckets=buckets)


def read_json_lines(spark: SparkSession, path: str, schema: StructType = OBS_RAW) -> DataFrame:
    return spark.read.schema(schema).json(path).select(*schema.fieldNames())


def dedup_history(rows: DataFrame, keys=("name", "ts", "weather"), order=()) -> DataFrame:
    """One row per key; the one lowest in ``order``, or any of them where no order is given."""
    if not order:
        return rows.dropDuplicates(list(keys))
    rest = [c for c in rows.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return rows.groupBy(*keys).agg(first).select(
        *[c if c in keys else F.col(f"_first.{c}") for c in rows.columns]
    )


def read_history(spark: SparkSession, path: str, pattern: str | None = None,
                 name: str | None = None) -> DataFrame:
    """History documents, a JSON object per file, with the station named by the file, or arrays of
    them (``write_documents``), in which ``name`` is the field with the station's name.

    A file is read by one task; with ``pattern``, whose group is the station's name in the path,
    a station may have any number of files, so none need be large.
    """
    schema = StructType([*HISTORY.fields, StructField(name, StringType())]) if name else HISTORY
    documents = spark.read.schema(schema).json(path, multiLine=True)
    named = F.col(name) if name else station_from_path("_metadata.file_path", *([pattern] if pattern else []))
    return documents.select(*HISTORY.fieldNames(), named.alias("name"))


def _write_together(texts: DataFrame, path: str, keys, per_file: int, mode: str):
    """Elements in column ``value`` as files of one JSON array each, of about ``per_file`` rows.

    ``keys`` name a row; a file takes those of one hash. The rows are written once to be counted.
    """
    kept = materialize(texts.select(*keys, "value"))
    shares = max(1, math.ceil(kept.count() / per_file))
    listed = kept.groupBy(F.pmod(F.xxhash64(*keys), F.lit(shares)).alias("file")).agg(
        F.concat(F.lit("["), F.concat_ws(",\n", F.collect_list("value")), F.lit("]")).alias("value"))
    listed.write.mode(mode).partitionBy("file").text(path)


def write_documents(documents: DataFrame, path: str, keys, per_file: int = 1000, mode: str = "errorifexists"):
    """JSON documents of column ``value``, named by ``keys``, as arrays of about ``per_file`` a file,
    so that the number of files does not grow with each document."""
    _write_together(documents, path, keys, per_file, mode)


def write_json_arrays(pages: DataFrame, path: str, key: str = "name", mode: str = "errorifexists",
                      per_file: int | None = None):
    """Arrays from ``stations.json_pages``: each page a file of its own, one JSON array.

    Files lie in folders per station and page, so both readers see every page. With ``per_file``
    about as many pages are one array in one file; their elements should carry the page's number
    (``json_pages(number=...)``).
    """
    if per_file:
        elements = pages.select(key, "page", strip_ends("json").alias("value"))
        return _write_together(elements, path, [key, "page"], per_file, mode)
    rows, folders = _by_folder(pages.select(key, "page", F.col("json").alias("value")), key, None)
    rows.write.mode(mode).partitionBy(*folders, "page").text(path)


def read_json_arrays(spark: SparkSession, path: str, schema: StructType = OBS_RAW) -> DataFrame:
    """Observations from files with one JSON array per line."""
    return spark.read.schema(schema).json(path).select(*schema.fieldNames())


def read_observation_arrays(spark: SparkSession, path: str, schema: StructType = OBS_RAW,
                            page: str | None = None) -> DataFrame:
    """Observations from files that are one JSON array each, over any number of lines.

    ``page`` names a column for the number of the page a row comes from: the element's own field
    of that name, or else the folder's.
    """
    if not page:
        return spark.read.schema(schema).json(path, multiLine=True).select(*schema.fieldNames())
    carried = StructType([*schema.fields, StructField(page, LongType())])
    rows = spark.read.schema(carried).json(path, multiLine=True)
    number = F.regexp_extract(F.col("_metadata.file_path"), r"page=(\d+)/", 1).try_cast("bigint")
    return rows.select(*schema.fieldNames(), F.coalesce(F.col(page), number).alias(page))


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOGUE).json(path, multiLine=True)
