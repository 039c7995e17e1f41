"""Merkle dataset manifest by checkpoint-and-recompute.

Every document is a leaf, the sha256 of its columns. The leaves of each lang, ascending by doc_id,
are a tree: every ``FANOUT`` consecutive nodes (the last run has fewer, even one) become the sha256
of their digests as hex text, until one is left, the subroot; the subroots, ordered by lang, are the
leaves of one more tree, whose last node is the root.

Of the levels only every ``KEEP``th is written, leaves included. A proof goes through the aligned
subtrees from the root down: a task gets the stored nodes below one stored node (``FANOUT`` to the
power ``KEEP`` at most) and the siblings above it, computes the levels between them again, hands the
siblings on and forgets these nodes. So storage is the leaves and an eighth of an eighth of an eighth
of them and so on, and no task ever has more than one subtree.

Defined results: nulls are marked in the leaf; documents without lang are a tree of their own, which
comes first; null ids come last in their tree; rows that share an id are ordered by leaf, and equal
rows are leaves of their own; a text of any length is hashed whole; a row without id is never taken
for tampering; an empty table has no root and gives an empty result. Other columns don't matter.
"""

from __future__ import annotations

import uuid
from hashlib import sha256
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from obsflow.llm.common import cut, partitions, shared_folder, shipped, table
from obsflow.llm.registry import query

FANOUT, KEEP = 8, 3
SPAN = FANOUT**KEEP
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows up to which a table that was counted is sent to every task.
MAX_LIST = 100_000
_PATH = "path array<struct<left:string,right:string>>, subroot string, root string"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def levels_above(n: int) -> int:
    """Levels from ``n`` nodes up to a single one."""
    found = 0
    while n > 1:
        n, found = -(-n // FANOUT), found + 1
    return found


def level_up(nodes: list[str]) -> list[str]:
    return [digest("".join(nodes[i : i + FANOUT])) for i in range(0, len(nodes), FANOUT)]


def siblings(nodes: list[str], i: int) -> tuple[str, str]:
    """What stands left and right of node ``i`` in its run."""
    start = i // FANOUT * FANOUT
    return "".join(nodes[start:i]), "".join(nodes[i + 1 : start + FANOUT])


def fold(leaf: str, path) -> str:
    """The root that ``leaf`` has with the siblings of ``path``."""
    for left, right in path:
        leaf = digest(left + leaf + right)
    return leaf


def leaf_digest(text="text") -> F.Column:
    """sha256 over the columns: ``-`` for a null, else the number of UTF-8 bytes, a colon, the value."""
    def field(column):
        value = (F.col(column) if isinstance(column, str) else column).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*(field(text if c == "text" else c) for c in COLUMNS)).cast("binary"), 256)


def numbered(rows: DataFrame, order: list[F.Column]) -> DataFrame:
    """``rows`` with pos, the number from 0 in ``order`` within its ``tree``, and n, the tree's rows.

    Rows are range-partitioned along the order, so a tree may lie in many tasks; one row a tree and
    task adds them up. Equal rows are told apart by their place in a checkpoint, which stays.
    """
    spark = rows.sparkSession
    keys = [F.asc_nulls_first("tree"), *order, F.asc("_row")]
    marked = cut(rows).withColumn("_row", F.monotonically_increasing_id())
    ranged = marked.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).drop("_row")
    schema = StructType(ranged.schema.fields + StructType.fromDDL("_part int, _local long").fields)

    def number(batches):
        part, last, seen = TaskContext.get().partitionId(), (), 0
        for batch in batches:
            local = []
            for name in batch.column("tree").to_pylist():
                seen = seen + 1 if (name,) == last else 0
                last = (name,)
                local.append(seen)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(local), pa.int32()), pa.array(local, pa.int64())], names=schema.names)

    placed = cut(shipped(ranged).mapInArrow(number, schema))
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("tree", "_part").agg((F.max("_local") + 1).alias("k")).select(
        F.col("tree").alias("_tree"), F.col("_part").alias("_in"), F.coalesce(F.sum("k").over(before), F.lit(0)).alias("_before"),
        F.sum("k").over(of_tree).alias("n"))
    if sizes.count() <= MAX_LIST:
        sizes = F.broadcast(sizes)
    same = (F.col("_part") == F.col("_in")) & F.col("tree").eqNullSafe(F.col("_tree"))
    return placed.join(sizes, same).select(*rows.columns, (F.col("_local") + F.col("_before")).alias("pos"), "n")


def _groups(batches):
    """(tree, group) and the rows of each, of rows sorted by these, their first two columns."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:2] != key:
                if rows:
                    yield key, rows
                key, rows = row[:2], []
            rows.append(row)
    if rows:
        yield key, rows


def _batched(rows, schema: pa.Schema, size: int = 2000):
    """Tuples as record batches."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _by_subtree(rows: DataFrame, run, fields: StructType) -> DataFrame:
    """``run`` over the groups of ``rows``, which begin with tree, group and pos."""
    arrow = to_arrow_schema(fields)
    dealt = rows.repartition(partitions(rows.sparkSession), "tree", "group").sortWithinPartitions("tree", "group", "pos")
    return shipped(dealt).mapInArrow(lambda batches: _batched(run(_groups(batches)), arrow), fields)


def _next_level(nodes: DataFrame) -> DataFrame:
    """tree, pos, n and digest of the stored nodes ``KEEP`` levels above."""
    def run(groups):
        for (tree, group), rows in groups:
            n, found = rows[0][3], [r[4] for r in rows]
            for _ in range(min(KEEP, levels_above(n))):
                found, n = level_up(found), -(-n // FANOUT)
            yield tree, group, n, found[0]

    rows = nodes.select("tree", F.floor(F.col("pos") / SPAN).alias("group"), "pos", "n", "digest")
    kind = nodes.schema["tree"].dataType.simpleString()
    return _by_subtree(rows, run, StructType.fromDDL(f"tree {kind}, pos long, n long, digest string"))


def build(leaves: DataFrame, path: str) -> list[DataFrame]:
    """Write every ``KEEP``th level below ``path`` and read them back, the leaves first.

    ``leaves`` has tree, pos, n and digest; further columns stay with the leaves. Trees that have
    one node left are carried up as they are, so the last level has one node a tree.
    """
    leaves.write.parquet(f"{path}/level=0")
    return read(leaves.sparkSession, path, leaves.schema)


def read(spark: SparkSession, path: str, schema: StructType) -> list[DataFrame]:
    """The levels below ``path``; those that are missing are written."""
    found = [spark.read.schema(schema).parquet(f"{path}/level=0")]
    largest = found[0].agg(F.max("n")).first()[0] or 0
    for k in range(-(-levels_above(largest) // KEEP)):
        above = _next_level(found[-1])
        at = f"{path}/level={(k + 1) * KEEP}"
        above.write.mode("ignore").parquet(at)
        found.append(spark.read.schema(above.schema).parquet(at))
    return found


def siblings_down(stored: list[DataFrame], upper: DataFrame, carry: list[str], finish=None, fields: str = _PATH) -> DataFrame:
    """``carry`` columns and digest of every leaf with what ``finish`` makes of its proof: by default
    path (left and right siblings, level by level), subroot and root.

    ``upper`` has these three for the last stored nodes, by tree and pos.
    """
    def plain(own, digest_, path, subroot, root):
        return path, subroot, root

    path_fields = StructType.fromDDL(_PATH).fields
    for k in range(max(len(stored) - 2, 0), -1, -1):
        nodes, own = stored[k], carry if k == 0 else ["tree", "pos"]
        last = (finish or plain) if k == 0 else plain

        def run(groups, last=last, width=len(own)):
            for _, (above, *rows) in groups:  # the row that stands for the subtree comes first
                upper_path = [(s["left"], s["right"]) for s in above[-3]]
                levels = [[r[4] for r in rows]]
                depth = min(KEEP, levels_above(rows[0][3])) if rows else 0
                for _ in range(depth):
                    levels.append(level_up(levels[-1]))
                inner: dict = {}
                for i, row in enumerate(rows):
                    j = i // FANOUT
                    if j not in inner:
                        inner[j] = [siblings(levels[m], j // FANOUT ** (m - 1)) for m in range(1, depth)] + upper_path
                    path = [siblings(levels[0], i), *inner[j]] if depth else upper_path
                    yield *row[5 : 5 + width], row[4], *last(row[5 : 5 + width], row[4], path, *above[-2:])

        none = F.lit(None)
        below = nodes.select(
            "tree", F.floor(F.col("pos") / SPAN).alias("group"), "pos", "n", "digest",
            *(F.col(c).alias(f"_{c}") for c in own), *(none.cast(f.dataType).alias(f.name) for f in path_fields))
        heads = upper.select(
            "tree", F.col("pos").alias("group"), F.lit(-1).cast("long").alias("pos"), none.cast("long").alias("n"),
            none.cast("string").alias("digest"), *(none.cast(nodes.schema[c].dataType).alias(f"_{c}") for c in own),
            "path", "subroot", "root")
        made = StructType([nodes.schema[c] for c in own] + StructType.fromDDL("digest string").fields
                          + (StructType.fromDDL(fields).fields if k == 0 else path_fields))
        upper = _by_subtree(below.unionByName(heads), run, made)
        if k:
            upper = cut(upper)
    return upper


def manifest(docs: DataFrame, path: str, claim: F.Column | None = None) -> list[DataFrame]:
    """The stored levels of the trees of all langs: tree (the lang), pos, n, digest, and with the
    leaves doc_id and claim, the digest to be verified in place of the leaf's own (null: that)."""
    claim = F.lit(None).cast("string") if claim is None else claim
    leaves = docs.select(F.col("lang").cast("string").alias("tree"), "doc_id", leaf_digest().alias("digest"), claim.alias("claim"))
    return build(numbered(leaves, [F.asc_nulls_last("doc_id"), F.asc("digest")]), path)


def proofs(stored: list[DataFrame], path: str, finish=None, fields: str = _PATH) -> DataFrame:
    """doc_id, claim, digest (the leaf), and path, subroot and root of every leaf.

    The tree of the subroots is written below ``path``. ``finish`` and ``fields`` put something else
    in place of the last three, made where the proof is.
    """
    tops = stored[-1].select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "digest")
    top = build(numbered(tops, [F.asc_nulls_first("lang")]), f"{path}/top")
    root = top[-1].select("tree", "pos", F.array().cast("array<struct<left:string,right:string>>").alias("path"),
                          F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    of_lang = cut(siblings_down(top, root, ["lang"]))
    upper = of_lang.select(F.col("lang").alias("tree"), F.lit(0).cast("long").alias("pos"), "path",
                           F.col("digest").alias("subroot"), "root")
    return siblings_down(stored, upper, ["doc_id", "claim"], finish, fields)


def verified(docs: DataFrame, path: str, claim: F.Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256 (of all siblings), folded_root (from ``claim`` where
    it isn't null, else the leaf) and whether that is the root, of every document."""
    def finish(own, leaf, siblings_, subroot, root):
        folded = fold(own[1] or leaf, siblings_)
        return subroot, root, digest("".join(left + right for left, right in siblings_)), folded, folded == root

    fields = "subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    found = proofs(manifest(docs, path, claim), path, finish, fields)
    return found.withColumnRenamed("digest", "leaf").drop("claim")


def lowered_third() -> F.Column:
    """The leaf with A-Z of the text as small letters, where 3 divides the crc32 of the id."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(chosen, leaf_digest(F.translate(F.col("text").cast("string"), ascii_uppercase, ascii_lowercase)))


def _fields_sql(text: str) -> str:
    return " || ".join(f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"
                       for c in ("doc_id", "source", "lang", "n_chars", text))


def _tree_sql(name: str, start: str) -> str:
    return f"""{name}(tree, level, pos, n, digest) as (
  select tree, 0, pos, n, digest from ({start})
  union all
  select tree, level + 1, pos // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(digest, '' order by pos))
  from {name} where n > 1 group by tree, level, pos // {FANOUT}, n)"""


def _sides_sql(nodes: str, up: int, tree: str, pos: str) -> str:
    own, run = (f"{pos} // ({FANOUT} ** {level})::bigint" for level in ("s.level", "(s.level + 1)"))
    return f"""select d.row, s.level + {up} as level,
   coalesce(string_agg(s.digest, '' order by s.pos) filter (s.pos < {own}), '') as l,
   coalesce(string_agg(s.digest, '' order by s.pos) filter (s.pos > {own}), '') as r
  from d join {nodes} s on s.tree is not distinct from {tree} and s.n > 1
   and s.pos // {FANOUT} = {run} group by d.row, s.level"""


SQL = f"""
with recursive c as (
  select *, list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(doc_id::varchar, ''),
    lambda ch: [ascii(ch)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda x, y: case when y >= 0 then xor(x, y) else xor(x >> 1, 3988292384 * (x & 1)) end) as crc from documents),
f as (
  select row_number() over () as row, doc_id, lang, sha256({_fields_sql("text")}) as leaf,
    case when xor(crc, 4294967295) % 3 = 0
      then sha256({_fields_sql(f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')")}) end as claim from c),
e as (
  select *, row_number() over (partition by lang order by doc_id nulls last, leaf, row) - 1 as pos,
    count(*) over (partition by lang) as n from f),
{_tree_sql("t", "select lang as tree, pos, n, leaf as digest from e")},
{_tree_sql("u", "select '' as tree, row_number() over (order by tree nulls first) - 1 as pos, count(*) over () as n, digest from t where n = 1")},
d as (
  select e.*, o.subroot, o.place, (select digest from u where n = 1) as root from e join (
    select tree, digest as subroot, row_number() over (order by tree nulls first) - 1 as place from t where n = 1) o
  on o.tree is not distinct from e.lang),
b as (
  {_sides_sql("t", 0, "d.lang", "d.pos")}
  union all
  {_sides_sql("u", 1000, "''", "d.place")}),
p as (select row, sha256(string_agg(l || r, '' order by level)) as proof, list(l || '|' || r order by level) as sides from b group by row),
g as (
  select d.*, coalesce(proof, sha256('')) as proof_sha256,
    list_reduce(list_prepend(coalesce(claim, leaf), coalesce(sides, [])),
      lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) as folded_root
  from d left join p using (row))
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified from g
"""


@query("op13_merkle", SQL)
def op13_merkle(spark, sf_dir):
    path = f"{shared_folder(spark)}/merkle-{uuid.uuid4().hex}"
    return verified(table(spark, sf_dir, "documents"), path, lowered_third())
