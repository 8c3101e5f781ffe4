import hashlib

import numpy as np
import pytest

from sonoledger.llm.vector_codes import MOST, Slices, compress

SCHEMA = "vec_id long, embedding array<double>, label int, code string"


def plain(rows, entries=256, rounds=4, parts=4):
    """The same by measuring every entry."""

    kept = sorted((r for r in rows if r[1] and len(r[1]) % parts == 0 and all(x is not None and np.isfinite(x) for x in r[1])),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    x = np.clip(np.floor(np.array([r[1] for r in kept]) * 1024), -MOST, MOST).astype(np.int64).reshape(len(kept), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def assign():
        far = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        return far.argmin(axis=2), far.min(axis=2).sum(axis=1)

    for _ in range(rounds):
        index, _ = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[index[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(axis=0) // len(mine)
    index, error = assign()
    by_label = {}
    for r, e in zip(kept, error.tolist()):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{i:02x}" for i in c), e, by_label[r[2]], digest) for r, c, e in zip(kept, index, error.tolist())), key=str)


def got(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=str)


def test_equals_plain(table):
    vectors = table("embeddings")
    assert got(compress(vectors)) == plain([(r.vec_id, list(r.embedding), r.label) for r in vectors.collect()])


@pytest.mark.parametrize("entries", [1, 7, 64, 200])
def test_sizes_ties_and_copies(spark, entries):
    rng = np.random.default_rng(entries)
    rows = [(i, (rng.integers(-3, 4, 12) / 1024).tolist(), i % 3) for i in range(300)]
    rows += [(1000 + i, rows[5][1], None) for i in range(150)]  # one vector under a third of all rows
    vectors = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(5)
    assert got(compress(vectors, entries=entries)) == plain(rows, entries)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [0.1] * 8, None), (3, [0.0] * 8, 1), (None, [0.5] * 8, None), (4, None, 1), (5, [], 1), (6, [nan] * 8, 1),
            (7, [inf] * 8, 1), (8, [None] * 8, 1), (9, [0.5] * 4, 2), (10, [0.5] * 7, 2), (11, [1e300] * 8, 3), (11, [1e300] * 8, 3)]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    out = got(compress(vectors, entries=2))
    assert [r[0] for r in out] == [11, 11, 3, 3, None]
    assert out == plain(rows, 2)
    empty = compress(vectors.limit(0))
    assert empty.columns[:4] == ["vec_id", "label", "code", "error"] and empty.collect() == []
    assert compress(vectors.filter("vec_id in (4, 5, 6)")).collect() == []
    with pytest.raises(ValueError):
        compress(vectors, entries=257)


def test_masks_are_exact():
    """The last mask holds every entry in the box, and the search looks at fewer than all."""

    rng = np.random.default_rng(0)
    entries, x = rng.integers(-500, 500, (130, 6)), rng.integers(-500, 500, (40, 6))
    slices = Slices(entries)
    radius = rng.integers(0, 400, 40)
    bits = np.unpackbits(slices.masks(x, radius).view(np.uint8), axis=1, count=130, bitorder="little").astype(bool)
    assert (bits == (np.abs(x[:, None] - entries[None]).max(axis=2) <= radius[:, None])).all()
    index, distance = slices.nearest(x)
    far = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (index == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()
    assert slices.masks(x, np.full(40, slices.first_radius)).any(axis=1).sum() < 40
