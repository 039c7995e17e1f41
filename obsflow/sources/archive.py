"""Keyed archive: a plain Parquet table with the latest row per key.

The table is partitioned by some of the key columns. An upsert merges the batch with the partitions
that it touches and overwrites these alone (dynamic partition overwrite), so its cost follows the
touched partitions, any reader sees one ordinary table, and the files of all others stay as they
are. The winner of a key is the greatest row in ``order``, whatever the order of arrival, so a batch
that comes again after a failure changes nothing.

One writer at a time: two that overwrite the same partition at once would lose one's rows. Spark
writes the new files aside and puts them in place when all are written; a driver that ends while it
does so can leave a partition aside, in the table's ``.spark-staging`` folder.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce
from operator import and_, or_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from obsflow.schemas import OBS

ARCHIVE_KEYS = ("name", "hour")
#: Rows of one hour of the day lie together: a live batch touches one or two of them.
ARCHIVE_PARTITIONS = ("hour",)
_MODE = "spark.sql.sources.partitionOverwriteMode"


def latest_per_key(df: DataFrame, keys=ARCHIVE_KEYS, order=("ts", "event_id")) -> DataFrame:
    """One row per key: the greatest in ``order``. Combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(
        *[c if c in keys else F.col(f"_last.{c}") for c in df.columns]
    )


def _within(partitions: list, names) -> Column:
    """Rows of the listed partitions; as plain values, so that only these are read."""
    return reduce(or_, [reduce(and_, [F.col(c).eqNullSafe(F.lit(p[c])) for c in names]) for p in partitions])


@contextmanager
def _dynamic(spark: SparkSession):
    before = spark.conf.get(_MODE, None)
    spark.conf.set(_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_MODE, before) if before else spark.conf.unset(_MODE)


class KeyedArchive:
    """The archive in a folder. ``partition_by`` names key columns with a bounded number of values;
    for keys without one, rows can carry ``files.station_bucket`` as a key column of their own."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys=ARCHIVE_KEYS,
                 order=("ts", "event_id"), partition_by=ARCHIVE_PARTITIONS):
        if not set(partition_by) <= set(keys):
            raise ValueError("an archive is partitioned by columns of its key")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.order, self.partition_by = tuple(keys), tuple(order), tuple(partition_by)
        self.create()

    def create(self) -> None:
        """Make the empty table, unless there is one."""
        empty = self.spark.createDataFrame([], self.schema)
        empty.write.mode("ignore").partitionBy(*self.partition_by).parquet(self.path)

    def read(self, spark: SparkSession | None = None) -> DataFrame:
        rows = (spark or self.spark).read.schema(self.schema).parquet(self.path)
        return rows.select(*self.schema.fieldNames())

    def replace(self, rows: DataFrame) -> None:
        """Overwrite the partitions that ``rows`` has, and no others."""
        rows.hint("rebalance", *self.partition_by).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*self.partition_by).parquet(self.path)

    def upsert(self, batch: DataFrame) -> int:
        """Insert or overwrite by key; the number of partitions that were touched."""
        rows = batch.select(*self.schema.fieldNames())
        winners = latest_per_key(rows, self.keys, self.order).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = winners.select(*self.partition_by).distinct().collect()
            if touched:
                old = self.read(batch.sparkSession).filter(_within(touched, self.partition_by))
                self.replace(latest_per_key(old.unionByName(winners), self.keys, self.order))
            return len(touched)
        finally:
            winners.unpersist()

    def create_view(self, name: str) -> None:
        """A view of what is archived now, for SQL in this session; create again to see more."""
        self.read().createOrReplaceTempView(name)


class ArchiveTable(KeyedArchive):
    """The archive as a table of the catalogue, made by ``create_archive_table``."""

    def __init__(self, spark: SparkSession, table: str, keys=ARCHIVE_KEYS, order=("ts", "event_id"),
                 partition_by=ARCHIVE_PARTITIONS):
        super().__init__(spark, table, spark.table(table).schema, keys, order, partition_by)

    def create(self) -> None:
        pass

    def read(self, spark: SparkSession | None = None) -> DataFrame:
        spark = spark or self.spark
        spark.catalog.refreshTable(self.path)
        return spark.table(self.path)

    def replace(self, rows: DataFrame) -> None:
        # INSERT OVERWRITE goes by position and knows the mode from the session only.
        with _dynamic(rows.sparkSession):
            rows.hint("rebalance", *self.partition_by).select(*self.schema.fieldNames()).write.insertInto(
                self.path, overwrite=True)


def create_archive_table(spark: SparkSession, table: str, location: str | None = None,
                         schema: StructType = OBS, partition_by=ARCHIVE_PARTITIONS) -> None:
    """Create the archive table unless it exists; ``ArchiveTable`` fills it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
              f"PARTITIONED BY ({', '.join(partition_by)}){place}")
