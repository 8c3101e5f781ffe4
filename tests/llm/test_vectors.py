import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sonoledger.llm.vectors import _search_block, nearest


def brute(rows, is_query, k):
    out = {}
    for q, v in rows:
        if is_query(q):
            far = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), i) for i, w in rows if i != q and len(w) == len(v))
            out[q] = far[:k]
    return out


def test_recall_and_scores(table):
    vectors = table("embeddings")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    want = brute(rows, lambda i: i % 100 == 0, 10)
    got = {}
    for r in nearest(vectors, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    assert set(got) == set(want)
    exact = {(q, i): s for q in want for s, i in brute(rows, lambda x: x == q, len(rows))[q]}
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert all(abs(s - exact[q, i]) < 1e-9 for _, s, i in found)
        assert [(s, i) for _, s, i in found] == sorted((s, i) for _, s, i in found)
        hits += len({i for _, _, i in found} & {i for _, i in want[q]})
    assert hits / (10 * len(want)) >= 0.9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0, 1.0]),
            (7, [1.0, 1.0]), (None, [1.0, 0.1]), (8, [1.0]), (6, [1.0, 1.0]), (9, [])]
    vectors = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, rank int, score string")
    got = [tuple(r) for r in nearest(vectors, F.col("vec_id") % 100 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 6, 1.0), (0, 2, 7, 1.0)]
    assert nearest(vectors.limit(0), F.lit(True)).collect() == []


def test_hot_pivot_in_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (np.ones(8) + rng.normal(0, 1e-3, 8)).tolist()) for i in range(400)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest(vectors, F.col("vec_id") % 100 == 0, block=50, share=1.0, posted=4, probed=300).collect()
    want = brute(rows, lambda i: i % 100 == 0, 10)
    for q in want:
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == [i for _, i in want[q]]


def test_copies_and_repeated_ids(spark):
    """One vector under a third of all ids, and one id repeated 100 times."""

    rng = np.random.default_rng(5)
    hot = rng.normal(0, 1, 8)
    rows = [(i, (hot if i % 3 == 0 else rng.normal(0, 1, 8)).tolist()) for i in range(3000)]
    rows += [(1, rows[1][1])] * 50 + [(1, (np.array(rows[1][1]) + 0.01 * i).tolist()) for i in range(1, 50)]
    near = {i: (np.array(rows[1][1]) + 0.001 * (i - 3000)).tolist() for i in range(3001, 3016)}
    rows += list(near.items())
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = {}
    for r in nearest(vectors, F.col("vec_id").isin(0, 1500, 2997, 3001)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q in (0, 1500, 2997):
        assert [i for _, i, _ in sorted(got[q])] == [i for i in range(0, 36, 3) if i != q][:10]
        assert all(s == 0 for _, _, s in got[q])
    assert [i for _, i, _ in sorted(got[3001])][:2] == [1, 3002]
    assert {i for _, i, _ in got[3001]} == {1, *range(3002, 3011)}


def test_block_cuts_count_ids():
    def frame(ids, vectors, ranks):
        raw = [np.array(v, float).tobytes() for v in vectors]
        return pd.DataFrame({"vec_id": ids, "vector": raw, "ranks": [np.array(r, np.uint8).tobytes() for r in ranks]})

    # 1,000 ids tie at the cut, in no order; one id fills 100 rows before them.
    ids = np.random.default_rng(1).permutation(np.arange(10, 1010))
    block = frame([5] * 100 + list(ids), [[3.0]] * 1100, [[0, 1]] * 1100)
    got = _search_block(frame([7, 7], [[2.9], [1.2]], [[0, 1]] * 2), block, 5, 0.1)
    assert got["vec_id"].tolist() == [5, 10, 11, 12, 13] and (got["query_id"] == 7).all()
    assert np.allclose(got["score"], [0.1, 0.1, 0.1, 0.1, 0.1])
