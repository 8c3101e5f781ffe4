import hashlib
import random

import pytest

from sonoledger.llm.decontaminate import build_patterns, contamination, drop_contaminated, item_words

ITEM_SCHEMA = "item_id long, text string, doc_id string"


def brute(docs, items, window=10):
    out = []
    for i, text in docs:
        words, hit, found = item_words(text), set(), set()
        for item, said in items:
            w = item_words(said)
            n = min(window, len(w))
            for k in range(len(w) - n + 1) if w else ():
                for at in range(len(words) - n + 1):
                    if words[at : at + n] == w[k : k + n]:
                        hit.update(range(at, at + n))
                        found.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(4)
    few = [f"w{i}" for i in range(6)]
    items = [(k, " ".join(rng.choice(few) for _ in range(rng.choice([1, 2, 5, 9, 10, 11, 14])))) for k in range(3, 12)]
    items += [(12, None), (13, ""), (14, "Über-straße ABC"), (14, "Über-straße ABC"), (None, "lone item")]
    docs = [(k, " ".join(rng.choice(few) for _ in range(rng.randrange(40)))) for k in range(25)]
    docs += [(100, None), (101, ""), (None, "a LONE, item"), (102, "über straße abc über"), (102, "über straße abc über")]
    docs.append((103, "z " * 50_000 + items[5][1] + " z" * 10))
    return docs, items


@pytest.mark.parametrize("block_words", [200_000, 15])
def test_against_brute_force(spark, make_docs, block_words):
    docs, items = cases()
    benchmark = spark.createDataFrame([(*i, "x") for i in items], ITEM_SCHEMA)
    got = contamination(make_docs(docs).withColumnRenamed("source", "n_hit"), benchmark, block_words=block_words).collect()
    short = [d for d in docs if d[0] != 103]
    rows = sorted(map(tuple, got), key=str)
    assert [r for r in rows if r[0] != 103] == brute(short, items)
    assert [r[1] for r in rows if r[0] == 103] == [50_010 + len(item_words(items[5][1]))] and [r[5] for r in rows if r[0] == 103] == [True]


def test_empty_sides(spark, make_docs):
    none = spark.createDataFrame([], ITEM_SCHEMA)
    assert [r.contaminated for r in contamination(make_docs(["a b"]), none).collect()] == [False]
    assert contamination(make_docs([]), spark.createDataFrame([(1, "a", "")], ITEM_SCHEMA)).collect() == []


def test_stage_drops_what_is_hit(spark, make_docs):
    docs, items = cases()
    benchmark = spark.createDataFrame([(*i, "x") for i in items], ITEM_SCHEMA)
    frame = make_docs(docs)
    kept = drop_contaminated(frame, benchmark)
    clean = {r[0] for r in brute([d for d in docs if d[0] != 103], items) if not r[5]}
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == clean


def test_shifts_skip():
    table = build_patterns([("a", [b"w%d" % i for i in range(10)])])[0]
    assert table.shift.max() == 9 and (table.shift == 0).sum() == 1
