import numpy as np
import pytest
from pyspark.sql import functions as F

from sonoledger.llm.vector_links import SLACK, near_duplicate_vectors, units


def brute(rows, cosine=0.9):
    """Every pair measured; components by repeated minima."""

    def takes_part(i, v):
        return i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = {n: [] for n in range(len(rows))}
    for dim in {len(v) for i, v in rows if v}:
        mine = [n for n, (i, v) in enumerate(rows) if takes_part(i, v) and len(v) == dim]
        if mine:
            x = units(np.array([rows[n][1] for n in mine], float))
            near = x @ x.T >= cosine
            for a, n in enumerate(mine):
                links[n] = [mine[b] for b in np.flatnonzero(near[a]) if b != a]
    low = {n: rows[n][0] for n in links}
    changed = True
    while changed:
        changed = False
        for n, others in links.items():
            least = min([low[n], *(low[o] for o in others)]) if others else low[n]
            if least != low[n]:
                low[n], changed = least, True
    return sorted(((i, len(links[n]), low[n], i == low[n]) for n, (i, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def noisy(rng, centre, n, size):
    return [(units((centre + rng.normal(0, size, len(centre)))[None])[0]).tolist() for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<double>, node int, radius double")


def test_groups_of_all_sizes(spark):
    """Pairs, chains, a group of a third of all rows, and copies, in uniform noise; equal to brute force."""

    rng = np.random.default_rng(4)
    vectors = noisy(rng, np.zeros(32), 500, 1.0)
    vectors += noisy(rng, units(rng.normal(size=(1, 32)))[0], 400, 0.03)  # tight
    vectors += noisy(rng, units(rng.normal(size=(1, 32)))[0], 120, 0.075)  # about 0.85: many links just missed
    for v in list(vectors[:60]):
        vectors += noisy(rng, np.array(v), 1, 0.05)
    vectors += [vectors[3]] * 100
    ids = rng.permutation(len(vectors)).tolist()
    rows = list(zip(ids, vectors))
    out, want = got(near_duplicate_vectors(frame(spark, rows).repartition(4))), brute(rows)
    links, true = sum(r[1] for r in out), sum(r[1] for r in want)
    assert links <= true and links >= 0.99 * true
    assert sum(a == b for a, b in zip(out, want)) >= 0.98 * len(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [inf, 1.0]),
            (None, [1.0, 0.0]), (7, [1.0, 0.0, 0.0]), (8, [1e300, 1e299]), (9, [1e-300, 0.0]), (0, [-1.0, 0.0]), (10, [])]
    assert got(near_duplicate_vectors(frame(spark, rows))) == sorted(
        [(1, 3, 1, True), (1, 3, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
         (None, 0, None, True), (7, 0, 7, True), (8, 3, 1, False), (9, 3, 1, False), (0, 0, 0, True), (10, 0, 10, True)], key=str)
    assert near_duplicate_vectors(frame(spark, rows).limit(0)).collect() == []
    assert got(near_duplicate_vectors(frame(spark, [(4, [2.0]), (5, None)]))) == [(4, 0, 4, True), (5, 0, 5, True)]


def test_table(table):
    vectors = table("embeddings")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in vectors.collect()]
    assert got(near_duplicate_vectors(vectors)) == brute(rows)


def test_slack_holds():
    """Half-precision cosines are off by less than the slack."""

    rng = np.random.default_rng(0)
    for dim in (2, 64, 1000):
        x = units(rng.normal(size=(300, dim)))
        y = units(x + rng.normal(0, 0.2 / np.sqrt(dim), x.shape))
        small = [z.astype(np.float16).astype(np.float32) for z in (x, y)]
        assert np.abs((x * y).sum(axis=1) - (small[0] * small[1]).sum(axis=1)).max() < SLACK
