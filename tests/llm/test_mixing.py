from collections import Counter, defaultdict

from obsflow.llm import mixing


def test_targets_and_takes(docs):
    rows = [(i, "w " * (i % 9 + 1), f"src{i % 4}") for i in range(300)] + [(400 + i, "x y z", None) for i in range(40)]
    rows += [(500, None, "src0"), (501, "", "src1"), rows[5], (None, "a b", "src2")]
    got = mixing.mix(docs([(*r, 1) for r in rows], ", size int")).collect()
    assert len(got) == len(rows)
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len((text or "").split())
    order = sorted(s for s in size if s is not None) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    budget, target, free = 1.5 * sum(size.values()), {}, set(order)
    while True:
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        if not over:
            break
        target |= {s: 2.0 * size[s] for s in over}
        free -= over
    target |= {s: level * weight[s] for s in free}
    source_of = {r[0]: r[2] for r in rows}
    taken = defaultdict(int)
    for r in got:
        source = source_of[r.doc_id]
        assert abs(r.target - target[source]) < 1e-6 and r.source_size == size[source]
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    assert sum(taken.values()) == int(budget)
    assert all(abs(taken[s] - target[s]) <= 12 for s in order)
    again = mixing.mix(docs(rows))
    assert Counter(map(tuple, again.select("doc_id", "taken").collect())) == Counter((r.doc_id, r.taken) for r in got)


def test_mixed_rows(docs):
    rows = [(i, "w " * (i + 1), "a" if i % 2 else "b") for i in range(20)] + [(3, "w w w w ", "a")]
    df = docs([(*r, 1, 2, 3) for r in rows], ", row int, number int, again int")
    plan = {}
    for r in mixing.mix(df).collect():
        plan[r.doc_id] = plan.get(r.doc_id, 0) + r.times
    got = mixing.mixed_documents(df)
    assert got.columns == df.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter({k: v for k, v in plan.items() if v})


def test_without_words(docs):
    assert [(r.taken, r.target) for r in mixing.mix(docs([(1, None), (2, "")])).collect()] == [(0, 0.0)] * 2
    assert mixing.mix(docs([])).count() == 0
    assert mixing.mixed_documents(docs([])).count() == 0
