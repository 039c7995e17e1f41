import random
import re

import numpy as np
import pyarrow as pa

from obsflow.llm import substring as sub
from obsflow.llm.common import span_hashes


def ends(word):
    """Whether a piece ends with this word, wherever it stands."""
    data = word.encode()
    return word[-1] in ".!?,;:" or int(span_hashes(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]))[0]) % 12 == 0


def split(text):
    """Pieces of sentences as (segment, words)."""
    words = list(re.finditer(r"[^\x20\x09-\x0D]+", text))
    out, begin, current = [], 0, []
    for k, w in enumerate(words):
        current.append(w.group())
        gap = text[w.end():words[k + 1].start()] if k + 1 < len(words) else "\n"
        if ends(w.group()) or "\n" in gap:
            end = words[k + 1].start() if k + 1 < len(words) else len(text)
            out.append((text[begin:end], current))
            begin, current = end, []
    return out


def long_enough(sentences):
    n = sum(len(w) for _, w in sentences)
    return (len(sentences) >= sub.SENTENCES and n >= sub.SOME_WORDS) or n >= sub.MANY_WORDS


def runs(sentences):
    found = set()
    for i in range(len(sentences)):
        j = next((j for j in range(i, len(sentences)) if long_enough(sentences[i:j + 1])), None)
        if j is not None:
            found.add((i, j))
        k = next((k for k in range(i, -1, -1) if long_enough(sentences[k:i + 1])), None)
        if k is not None:
            found.add((k, i))
    return sorted(found)


def brute(rows):
    """rows: (doc_id, text); the texts that stay."""
    cut, first = [], {}
    for doc, text in rows:
        sentences = split(text or "")
        found = [((i, j), tuple(w for _, ws in sentences[i:j + 1] for w in ws)) for i, j in runs(sentences)]
        cut.append((doc, text, sentences, found))
        for _, words in found:
            if doc is not None:
                first[words] = min(doc, first.get(words, doc))
    out = []
    for doc, text, sentences, found in cut:
        gone, seen = set(), set()
        for (i, j), words in found:
            later = words in first and (doc is None or doc > first[words])
            if later or words in seen:
                gone |= set(range(i, j + 1))
            seen.add(words)
        stays = None if text is None else (
            text if not sentences else "".join(s for k, (s, _) in enumerate(sentences) if k not in gone))
        out.append((-1 if doc is None else doc, stays, len(sentences), len(gone)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(5)
    words = [f"wö{i}" for i in range(60)]
    sentence = lambda n=None: " ".join(rng.choice(words) for _ in range(n or rng.randint(1, 14))) + rng.choice([".", "!", "?", ",", ":", "\n"])
    passages = [" ".join(sentence() for _ in range(rng.randint(3, 9))) for _ in range(6)] + [sentence(60), sentence(30) + " " + sentence(25)]
    rows = [(100, None), (101, ""), (102, " \n "), (103, "one."), (104, "A b. " * 40), (105, "x" * 50_000)]
    for i in range(80):
        parts = [sentence() for _ in range(rng.randint(0, 12))]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), "\n" + rng.choice(passages) + "\n")
        rows.append((i, rng.choice([" ", "  ", "\n", "\t"]).join(parts)))
    return rows + [rows[-1], (None, rows[-2][1]), (None, rows[-2][1]), (7, rows[-3][1])]


def test_against_brute_force(docs):
    rows = corpus()
    df = sub.without_repeats(docs([(*r, "s", 1) for r in rows], ", place int"))
    assert df.columns[:5] == docs(rows).columns
    got = sorted(((-1 if r.doc_id is None else r.doc_id, r.text, r.n_sentences, r.n_removed) for r in df.collect()), key=str)
    assert got == brute(rows)
    assert sum(r[3] > 0 for r in got) > 20


def test_long_passages_go_whole(docs):
    passage = " ".join(f"p{i}" for i in range(30)) + ". " + " ".join(f"q{i}" for i in range(25)) + "."
    rows = [(i, f"Own{i} start{i}.\n{passage}\nOwn{i} end{i}.") for i in range(50)]
    got = {r.doc_id: r.text for r in sub.without_repeats(docs(rows)).collect()}
    assert got[0] == rows[0][1]
    assert all(got[i] == f"Own{i} start{i}.\nOwn{i} end{i}." for i in range(1, 50))


def test_batches_and_empty(docs):
    texts = pa.array([r[1] for r in corpus()])
    whole = sub.sentence_spans(texts)[3][2]
    parts = [sub.sentence_spans(texts.slice(i, 1))[3][2] for i in range(len(texts))]
    assert whole.tolist() == [h for p in parts for h in p.tolist()]
    assert sub.without_repeats(docs([])).count() == 0


def test_places_of_repeated_rows(docs):
    """Rows that repeat list each place once."""
    passage = " ".join(f"p{i}" for i in range(60)) + "."
    rows = [(1, passage)] + [(2, passage)] * 30
    places, = (r.places for r in sub.repeated_spans(docs(rows)).collect())
    spans = sub.sentence_spans(pa.array([passage]))[3][2]
    assert sorted(places) == list(range(len(spans)))
    got = {(r.doc_id, r.text) for r in sub.without_repeats(docs(rows)).collect()}
    assert got == {(1, passage), (2, "")}
