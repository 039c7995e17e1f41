"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled, repeatable order. A document's virtual
finish time is the words its source has sent with it, divided by the source's target; the mix is
the rows of all queues in order of finish time, cut where the total budget is reached. A source
whose words run out is sent again, up to ``passes`` times in all.

Defined results: a null text has size 0; a null source is a source of its own, the last one; rows
that repeat are rows of their own; without words every target and every ``taken`` is 0; an empty
table gives an empty result. Other columns of the input don't matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsflow.llm.common import WORD, cut, running_sum, table
from obsflow.llm.registry import query

WEIGHTS, SHARE, PASSES = (3, 1, 2), 1.5, 2


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, passes=PASSES) -> DataFrame:
    """Per source: size, rank, words of the sources before it, and target words.

    The sources, in order of code point, weigh ``weights`` in turn and divide ``share`` of all
    words. A target stops at ``passes`` times the source's size; the rest is divided anew by
    weight among the others until none is above. Only sums over sources reach the driver.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_sum(sums, [F.col("source").isNull(), F.col("source")], "source_size",
                         "source_start", "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = cut(ranked.withColumn("weight", weight).withColumn("cap", passes * F.col("source_size")))
    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        above = F.col("weight") * level > F.col("cap") if full >= 0 else F.lit(False)
        row = ranked.agg(
            F.count_if(above), F.sum(F.when(above, F.col("cap")).otherwise(0)),
            F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if row[0] == full or not row[2]:
            break
        full, level = row[0], (budget - row[1]) / row[2]
    return ranked.withColumn("target", F.least(F.col("cap").cast("double"), level * F.col("weight")))


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, passes=PASSES) -> DataFrame:
    """Per row of ``docs``: doc_id, row_hash, copy (number among equal rows), size, source_size,
    target, taken (words, repeats counted) and times (passes taken whole).

    ``taken`` adds up to the budget to the word; only the row at the cut is taken in part.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", "source", F.xxhash64(*sorted(docs.columns)).alias("row_hash"), size.alias("size"))
    copy = F.row_number().over(Window.partitionBy("doc_id", "row_hash").orderBy("size"))
    rows = cut(rows.withColumn("copy", copy))
    sources = source_targets(rows, weights, share, passes)
    budget = int(share * (rows.agg(F.sum("size")).first()[0] or 0))
    joined = rows.join(sources.drop("cap", "weight").withColumnRenamed("source", "_source"),
                       F.col("source").eqNullSafe(F.col("_source"))).drop("source", "_source")
    shuffled = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    joined = joined.withColumn("turn", shuffled)
    ties = [F.col(c) for c in ("turn", "doc_id", "size", "row_hash", "copy")]
    queued = running_sum(joined, [F.col("rank"), *ties], "size", "_before", "row")
    sent = F.col("_before") - F.col("source_start") + F.col("size") + F.col("pass") * F.col("source_size")
    passed = queued.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    finish = F.when(F.col("target") > 0, sent.cast("double") / F.col("target")).otherwise(0.0)
    timed = passed.withColumn("finish", finish)
    served = running_sum(timed, [F.col("finish"), F.col("rank"), F.col("pass"), *ties], "size", "_served")
    left = F.greatest(F.lit(0), F.least(F.col("size"), budget - F.col("_served")))
    whole = (left == F.col("size")) & (F.col("_served") + F.col("size") <= budget)
    keep = ("doc_id", "row_hash", "copy", "size", "source_size", "target")
    return served.groupBy("row").agg(
        *(F.first(c).alias(c) for c in keep), F.sum(left).alias("taken"),
        F.count_if(whole & (F.col("target") > 0)).alias("times")).drop("row")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share=SHARE, passes=PASSES) -> DataFrame:
    """The documents the mix takes whole, each row as often as it is taken.

    The one document at the cut is left out.
    """
    plan = mix(docs, weights, share, passes).filter("times > 0").select(
        F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash"),
        F.col("copy").alias("_copy"), F.col("times").cast("int").alias("_times"))
    rows = docs.select(F.struct("*").alias("doc"), "doc_id", F.xxhash64(*sorted(docs.columns)).alias("row"))
    number = F.row_number().over(Window.partitionBy("doc_id", "row").orderBy("doc_id"))
    rows = rows.withColumn("number", number)
    taken = rows.join(plan, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_hash"))
                      & (F.col("number") == F.col("_copy")))
    return taken.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("doc.*")


SQL = r"""
with d as (
  select doc_id, source, md5(coalesce(doc_id::varchar, '')) as turn,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
  from documents),
s as (
  select *, [3, 1, 2][(rank % 3 + 1)::int] as w, 2 * source_size as cap from (
    select source, sum(size)::bigint as source_size,
           row_number() over (order by source nulls last) - 1 as rank
    from d group by source)),
r as (
  select *, coalesce(sum(cap) over (order by cap / w, rank rows between unbounded preceding and 1 preceding), 0) as caps,
         sum(w) over (order by cap / w, rank rows between current row and unbounded following) as ws
  from s),
b as (select 1.5 * sum(source_size)::double as budget from s),
l as (select arg_min((budget - caps) / ws, cap / w) filter ((budget - caps) / ws * w <= cap) as level from r, b),
t as (select s.*, least(cap::double, level * w) as target from s, l),
q as (
  select d.*, t.source_size, t.target, t.rank, t.source_size * p.pass as earlier, p.pass,
         row_number() over (order by d.doc_id, d.turn, d.size) as row
  from d join t on d.source is not distinct from t.source, (values (0), (1)) p(pass)),
f as (
  select *, case when target > 0 then (earlier + sum(size) over (
      partition by rank, pass order by turn, doc_id, size rows unbounded preceding))::double / target else 0 end as finish
  from q),
g as (
  select *, coalesce(sum(size) over (order by finish, rank, pass, turn, doc_id, size
      rows between unbounded preceding and 1 preceding), 0) as served
  from f)
select doc_id, size, source_size, target,
       sum(greatest(0, least(size, floor(budget)::bigint - served)))::bigint as taken
from g, b group by doc_id, size, source_size, target
"""


@query("op4_mix", SQL)
def op4_mix(spark, sf_dir):
    plan = mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")
