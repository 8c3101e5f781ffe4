import collections
import random
import re

import numpy as np
import pytest

import sonoledger.llm._components as parts
from sonoledger.llm.near_dup import (
    drop_near_duplicates, near_duplicates, prob_min_hash, probability_jaccard, shingles,
)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingle_counts(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else {}


def similarity(x, y):
    """Probability Jaccard by its definition."""

    total = 0.0
    for d in set(x) & set(y):
        total += 1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in set(x) | set(y))
    return total


def brute_classes(rows):
    texts = {}
    for i, t in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r[0])):
        texts.setdefault(t, i)
    held = [(i, shingle_counts(t)) for t, i in texts.items()]
    parent = {i: i for i, _ in held}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(held)):
        for b in range(a):
            (i, x), (j, y) = held[a], held[b]
            if x and y and set(x) & set(y) and similarity(x, y) >= 0.8:
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return {i: (i if t is None else root(texts[t])) for i, t in rows}


def random_family(rng, n, length=60, edits=6, first=0):
    words = [f"w{rng.randrange(10_000)}" for _ in range(length)]
    out = []
    for k in range(n):
        mine = list(words)
        for _ in range(rng.randrange(edits + 1) if k else 0):
            mine[rng.randrange(length)] = f"v{rng.randrange(10_000)}"
        out.append((first + k, " ".join(mine)))
    return out


def test_similarity_matches_its_definition():
    rng = random.Random(5)
    for _ in range(200):
        x = {k: rng.randrange(1, 4) for k in range(20) if rng.random() < 0.6}
        y = {k: rng.randrange(1, 4) for k in range(20) if rng.random() < 0.6}
        as_arrays = [(np.array(sorted(s), np.uint64), np.array([s[k] for k in sorted(s)])) for s in (x, y)]
        assert probability_jaccard(*as_arrays) == pytest.approx(similarity(x, y)) if x and y else True


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(2)
    element = rng.integers(0, 2**63, 60).astype(np.uint64)
    x, y = {int(e): 1 + i % 3 for i, e in enumerate(element[:45])}, {int(e): 1 + i % 2 for i, e in enumerate(element[10:])}
    row = np.repeat([0, 1], [len(x), len(y)])
    signs = prob_min_hash(row, np.array([*x, *y], np.uint64), np.array([*x.values(), *y.values()]), 2, places=4000)
    assert (signs[0] == signs[1]).mean() == pytest.approx(similarity(x, y), abs=0.03)


@pytest.mark.parametrize("unit", [512, 8])
def test_against_brute_force(make_docs, unit):
    rng = random.Random(unit)
    rows = [r for f in range(4) for r in random_family(rng, 30, first=f * 100)]
    rows += [(1000 + i, rows[0][1]) for i in range(20)] + [(2000 + i, f"own words number {i} of it all here") for i in range(20)]
    rows += [(3000, None), (3001, None), (3002, ""), (3003, ""), (3004, "..."), (3005, "two words"), (3006, "Two, words!")]
    got = near_duplicates(make_docs(rows), unit=unit).collect()
    assert {r.doc_id: r.class_id for r in got} == brute_classes(rows)
    assert len(got) == len(rows)
    sizes = collections.Counter(r.class_id for r in got)
    assert all(r.class_size == sizes[r.class_id] for r in got)
    assert sorted(r.class_id for r in got if r.keep) == sorted(sizes)


def test_table_against_brute_force(table):
    docs = table("documents")
    got = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    assert got == brute_classes([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_stage_keeps_one_row_of_each(make_docs):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "something else altogether in here"), (2, "A b c d e f g"), (None, "x"),
            (None, "x"), (None, None), (5, None), (6, ""), (7, "")]
    docs = make_docs(rows).withColumnRenamed("n_chars", "key")
    got = sorted((str(r.doc_id), str(r.text)) for r in drop_near_duplicates(docs).collect())
    assert got == sorted([("1", "a b c d e f g"), ("1", "something else altogether in here"), ("None", "x"), ("None", "None"),
                          ("5", "None"), ("6", "")])
    assert drop_near_duplicates(docs).columns == docs.columns
    assert near_duplicates(make_docs([])).collect() == []


def test_very_long_text(make_docs):
    long = " ".join(f"w{i}" for i in range(120_000))
    got = near_duplicates(make_docs([(1, long), (2, long + " end"), (3, "w1 w2")])).collect()
    assert {r.doc_id: r.class_id for r in got} == {1: 1, 2: 1, 3: 3}


@pytest.mark.parametrize("few", [0, 10**6])
def test_components(spark, few):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2100)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    got = {r.node: r.root for r in parts.components(spark.createDataFrame(edges, "a long, b long"), few=few).collect()}
    assert got == {i: root(i) for i in parent if root(i) != i}
    assert parts.components(spark.createDataFrame([], "a long, b long"), few=few).collect() == []


def test_short_texts_are_one_shingle():
    from sonoledger.llm._words import Hasher, words_of

    data = np.frombuffer(b"a ba b c d e f", np.uint8)
    row, _, weight = shingles(words_of(data, np.array([0, 3, 3, len(data)]), Hasher()), 3)
    assert row.tolist() == [0, 2, 2] and weight.tolist() == [1, 1, 1]
