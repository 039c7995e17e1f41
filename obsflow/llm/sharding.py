"""Sharding by extendible hashing: a directory of hash prefixes, split only where too large.

Every row has a 128-bit hash. A shard is the shortest prefix of it whose rows fit ``max_bytes``;
so only oversized buckets split on another bit, and the directory is a prefix tree. Bytes are added
up for ``BITS`` more bits at a time, and only rows of buckets still too large go on to the next
round. A row's bytes are the UTF-8 bytes of its text.

Rows equal in every column have equal hashes; their bits beyond the 60th come from a number that
tells them apart, so a large group of copies splits too.

Defined results: a null text has 0 bytes; a row larger than the limit is alone in its shard but
for rows of 0 bytes; without rows there is no shard. Other columns only feed the hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import cut, table
from obsflow.llm.registry import query

MAX_BYTES, BITS, MAX_DEPTH = 1 << 20, 12, 120


def _word(text) -> F.Column:
    """The first 60 bits of an md5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _number(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_row", F.monotonically_increasing_id())


def _assign(numbered: DataFrame, max_bytes: int, bits: int) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    named = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))
    rows = cut(numbered.select("doc_id", "_row", F.octet_length(text).cast("long").alias("n_bytes"),
                               _word(named.cast("binary")).alias("_h")))
    rows = rows.withColumn("_more", _word(F.col("_row").cast("string").cast("binary")))
    open_, done, depth = rows.withColumn("_prefix", F.lit("")), None, 0
    while depth < MAX_DEPTH:
        step = min(bits, 60 - depth % 60)
        source = F.col("_h") if depth < 60 else F.col("_more")
        chunk = F.shiftright(source, 60 - depth % 60 - step).bitwiseAND((1 << step) - 1)
        marked = open_.withColumn("_cell", F.lpad(F.bin(chunk), step, "0"))
        cells = marked.groupBy("_prefix", "_cell").agg(F.sum("n_bytes").alias("bytes"))
        least = 0 if depth == 0 else 1  # a bucket without more bits was too large in the last round
        levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(least), F.lit(step))))
        key = F.concat("_prefix", F.substring("_cell", F.lit(1), F.col("depth")))
        levels = levels.withColumn("shard", key)
        fits = levels.groupBy("shard").agg(F.sum("bytes").alias("bytes")).filter(F.col("bytes") <= max_bytes)
        shards = levels.join(fits.select("shard"), "shard").groupBy("_prefix", "_cell").agg(
            F.min_by("shard", "depth").alias("shard"))
        placed = cut(marked.join(shards, ["_prefix", "_cell"], "left"))
        ready = placed.filter("shard is not null")
        done = ready if done is None else done.unionByName(ready)
        open_ = placed.filter("shard is null").select(
            "doc_id", "n_bytes", "_h", "_row", "_more", F.concat("_prefix", "_cell").alias("_prefix"))
        depth += step
        if open_.isEmpty():
            break
    else:
        done = done.unionByName(open_.withColumn("_cell", F.lit("")).withColumn("shard", F.col("_prefix")))
    return done.select("_row", "doc_id", "n_bytes", "shard", F.length("shard").alias("depth"))


def assign(docs: DataFrame, max_bytes: int = MAX_BYTES, bits: int = BITS) -> DataFrame:
    """doc_id, n_bytes, shard (its bits as 0s and 1s) and depth of every row.

    The first 60 bits are those of md5 over the id and the md5 of the text, each as text. Sums of
    one row per prefix and depth are all that is shuffled besides the rows' ids and hashes.
    """
    return _assign(_number(docs.select("doc_id", "text")), max_bytes, bits).drop("_row")


def directory(assigned: DataFrame) -> DataFrame:
    """shard, depth, n_docs and n_bytes of every shard."""
    return assigned.groupBy("shard", "depth").agg(
        F.count("*").alias("n_docs"), F.sum("n_bytes").alias("n_bytes"))


def write_shards(docs: DataFrame, path: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Write the rows as Parquet, one folder ``shard=<bits>`` each, and return the directory.

    The shard without bits is named ``root``; a column ``shard`` of the rows is replaced.
    """
    rows = cut(_number(docs.select(F.struct("*").alias("doc"), "doc_id", "text")))
    assigned = _assign(rows, max_bytes, BITS)
    columns = [F.col("doc")[c].alias(c) for c in docs.columns if c.lower() != "shard"]
    name = F.when(F.col("shard") == "", "root").otherwise(F.col("shard")).alias("shard")
    named = rows.join(assigned.select("_row", name), "_row").select(*columns, "shard")
    named.repartition("shard").write.partitionBy("shard").parquet(path)
    return directory(assigned)


SQL = f"""
with d as (
  select doc_id, row_number() over () as row, coalesce(strlen(text), 0)::bigint as n_bytes,
         lpad(bin(('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))), 1, 15))::bigint), 60, '0') as bits
  from documents),
p as (select d.*, t.depth, substr(bits, 1, t.depth) as shard from d, (select unnest(range(0, 33)) as depth) t),
s as (select shard from p group by shard having sum(n_bytes) <= {MAX_BYTES})
select doc_id, n_bytes, arg_min(shard, depth) as shard, min(depth)::int as depth
from p join s using (shard) group by row, doc_id, n_bytes
"""


@query("op6_extendible_shards", SQL)
def op6_extendible_shards(spark, sf_dir):
    return assign(table(spark, sf_dir, "documents"))
