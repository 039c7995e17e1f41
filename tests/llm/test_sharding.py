from collections import defaultdict

from obsflow.llm import sharding


def test_limits_and_directory(docs, tmp_path):
    rows = [(i, "x" * (i % 97)) for i in range(400)] + [(1, "same text " * 3)] * 300 + [(9, None), (None, "a"), (8, "L" * 5000)]
    df = docs([(*r, "s", 1) for r in rows], ", shard int")
    got = sharding.assign(df, 1000, 3).collect()
    assert sorted(r.n_bytes for r in got) == sorted(len(r[1] or "") for r in rows)
    sums = defaultdict(int)
    for r in got:
        sums[r.shard] += r.n_bytes
    assert all(v <= 1000 or k == next(r.shard for r in got if r.n_bytes == 5000) for k, v in sums.items())
    shards = sorted(sums)
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]))
    # Only oversized buckets were split: the parent of every shard is too large.
    for shard in shards:
        if shard:
            assert sum(r.n_bytes for r in got if r.shard.startswith(shard[:-1])) > 1000
    assert len({r.shard for r in got if r.n_bytes == 30}) > 5


def test_written_shards(spark, docs, tmp_path):
    rows = [(i, "text %d " % i * 9) for i in range(200)]
    table = sharding.write_shards(docs(rows), f"{tmp_path}/out", 2000)
    back = spark.read.option("basePath", f"{tmp_path}/out").parquet(f"{tmp_path}/out")
    assert sorted((r.doc_id, r.text) for r in back.collect()) == rows
    counts = {r.shard: r.n_docs for r in table.collect()}
    assert max(r.n_bytes for r in table.collect()) <= 2000 and sum(counts.values()) == 200
    assert sharding.write_shards(docs(rows), f"{tmp_path}/one", 10**6).first().depth == 0


def test_empty(docs):
    assert sharding.assign(docs([])).count() == 0
