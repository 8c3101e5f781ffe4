import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from sonoledger.llm import ranked_search
from sonoledger.llm.ranked_search import Search, Treap, build_index, corpus_size, query_terms, search_index

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(docs, items, k=10):
    """Every document scored for every item."""

    held = [(i, terms(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n, total = len(held), sum(len(w) for _, w in held)
    df, counts = {}, []
    for _, words in held:
        tf = {}
        for w in words:
            tf[w] = tf.get(w, 0) + 1
        counts.append(tf)
        for w in tf:
            df[w] = df.get(w, 0) + 1
    weight = {w: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for w, d in df.items()}
    out = []
    for item, text in items:
        found = []
        for (i, words), tf in zip(held, counts):
            m = 100 - 90 + (90 * len(words) * n) // total
            score = sum(weight[t] * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in set(terms(text)) if t in tf)
            if score > 0:
                found.append((-score, i is None, i or 0))
        found.sort()
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(found[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def test_equals_plain(spark, table):
    docs, items = table("documents"), table("benchmark")
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got(ranked_search.ranked_search(docs, items)) == want


def test_odd_rows(spark, make_docs):
    rows = [(1, "Ab c"), (1, "Ab c"), (None, "ab C"), (2, None), (3, ""), (4, "..."), (5, "äb ÄB x_y x"), (0, "c " * 5000), (6, "ab c")]
    docs = make_docs(rows).withColumnRenamed("source", "term")
    items = [(9, "AB"), (9, "c c"), (None, "ÄB äb"), (8, None), (7, "unknown"), (6, "x y")]
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    assert got(ranked_search.ranked_search(docs, asked)) == plain(rows, items)
    assert got(ranked_search.ranked_search(docs, asked, k=1)) == plain(rows, items, 1)
    assert got(ranked_search.ranked_search(docs.limit(0), asked)) == []
    assert got(ranked_search.ranked_search(docs, asked.limit(0))) == []
    assert got(ranked_search.ranked_search(make_docs([None, ""]), asked)) == []


def test_blocks_groups_copies_and_ties(spark, make_docs, monkeypatch):
    """Small blocks and query groups; a third of all rows are copies that tie."""

    monkeypatch.setattr(ranked_search, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 30)))) for i in range(200)]
    rows += [(1000 - i, "w1 w2 w3 common") for i in range(100)] + [(500, "w4 " * 4000)]
    items = [(i, " ".join(rng.choice(words, 4))) for i in range(30)] + [(99, "common w1")]
    docs = make_docs(rows).repartition(3)
    asked = query_terms(spark.createDataFrame(items, "item_id long, text string"))
    size = corpus_size(docs)
    index = build_index(docs, size=size)
    assert index.count() > 10
    want = plain(rows, items)
    assert got(search_index(index, asked, size[0], group_items=7)) == want
    assert got(search_index(index, asked, size[0], group_items=7, sent_pairs=0)) == want


def test_treap_holds_the_points():
    rng = np.random.default_rng(1)
    points = np.unique(rng.integers(0, [40, 300], (500, 2)), axis=0)
    value = rng.integers(1, 1000, len(points))
    treap = Treap(*Treap.build(points[:, 0], points[:, 1], value))
    held = {}
    stack = [(0, treap.height, 0, 0)]
    while stack:
        cell, level, row, column = stack.pop()
        if level == 0:
            held[row, column] = treap.maxima[cell]
            continue
        below = []
        for quarter in range(4):
            there, child = treap.child(np.array([cell]), np.array([quarter], np.uint8))
            if there[0]:
                below.append(int(child[0]))
                stack.append((int(child[0]), level - 1, 2 * row + quarter // 2, 2 * column + quarter % 2))
        assert treap.maxima[cell] == max(treap.maxima[c] for c in below)
    assert held == {(r, c): v for (r, c), v in zip(points.tolist(), value)}


def test_search_leaves_ranges_closed(spark, make_docs):
    """A rare term ends the search before most documents are opened."""

    rows = [(i, "a b c d " + ("rare " * 30 if i % 100 == 7 else "")) for i in range(1000)]
    docs = make_docs(rows).coalesce(1)
    block = build_index(docs).collect()
    assert len(block) == 1
    search = Search(block[0].asDict())
    hasher = ranked_search.Hasher()
    term = np.concatenate([ranked_search._postings(pa.array([w]), hasher)[2] for w in ("rare", "a")])
    query, column, score = search.best(np.zeros(2, np.int64), term, np.array([4000, 1]), 10)
    assert search.ids[column].tolist() == [i for i, _ in rows if i % 100 == 7]
    assert search.opened < 500


def test_copies_stay_closed(spark, make_docs):
    """Of a thousand copies the ten smallest ids are found without opening the rest; a null id comes last."""

    rows = [(5000 - i, "same words here") for i in range(1000)] + [(None, "same words here")]
    docs = make_docs(rows).coalesce(1)
    block = build_index(docs).collect()
    search = Search(block[0].asDict())
    hasher = ranked_search.Hasher()
    term = ranked_search._postings(pa.array(["words"]), hasher)[2]
    query, column, score = search.best(np.zeros(1, np.int64), term, np.array([7]), 10)
    assert search.ids[column].tolist() == list(range(4001, 4011)) and search.opened < 200


def test_counts_of_asked_terms(make_docs):
    hasher = ranked_search.Hasher()
    words = ["ab", "b", "zz", "ä"]
    known = np.array([ranked_search._postings(pa.array([w]), hasher)[2][0] for w in words])
    order = np.argsort(known)
    docs = make_docs(["ab AB b", None, "", "b b ä", "...", "ab", "c"] * 3).repartition(4)
    found, total, held = ranked_search.corpus_counts(docs, known[order])
    assert (found, total) == corpus_size(docs) == (12, 24)
    assert dict(zip(np.array(words)[order].tolist(), held.tolist())) == {"ab": 6, "b": 6, "zz": 0, "ä": 3}
    assert ranked_search.corpus_counts(docs.limit(0), known[order])[2].tolist() == [0] * 4


def test_few_terms_are_searched_where_blocks_are_made(spark, make_docs, monkeypatch):
    """No index goes through the JVM, whose rows of megabytes filled executors; many terms meet a written one."""

    monkeypatch.setattr(ranked_search, "BLOCK_ROWS", 8)
    monkeypatch.setattr(ranked_search, "TOGETHER", 3)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(40)]
    rows = [(i % 90, " ".join(rng.choice(words, rng.integers(0, 20)))) for i in range(150)]
    rows += [(None, "w1 w2"), (7, None), (400, "w3 " * 3000)] + [(300 - i, "w5 same w6") for i in range(60)]
    items = [(i // 2, " ".join(rng.choice(words, 5))) for i in range(20)] + [(None, "same none"), (77, "nowhere"), (78, None)]
    docs = make_docs(rows).repartition(2)
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = plain(rows, items)
    assert got(ranked_search.ranked_search(docs, asked, sent_pairs=0)) == want
    monkeypatch.setattr(ranked_search, "build_index", None)
    assert got(ranked_search.ranked_search(docs, asked)) == want


def test_index_files_hold_a_block_a_row_group(make_docs, monkeypatch):
    """Writers and readers hold a row group whole, so one of all blocks of a task grows with its input."""

    monkeypatch.setattr(ranked_search, "BLOCK_ROWS", 8)
    index = build_index(make_docs([f"a{i} b" for i in range(200)]).coalesce(1))
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    groups = [f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
    assert groups == [1] * index.count() and len(groups) > 10
