import string

import numpy as np
import pyarrow as pa
import pytest

from sonoledger.llm import toxicity
from sonoledger.llm.toxicity import (
    Decoder, character_counts, character_model, drop_toxic, learn_words, restore_slice, score_documents, suspicious_spans, train,
)

LABELS = "doc_id long, quality int, toxic int, score double"


@pytest.fixture(scope="module")
def world(spark):
    """Documents of plain words, a third of them with one of three nasty words."""

    rng = np.random.default_rng(8)
    plain = "the river runs under an old stone bridge where children play and fish all day long".split()
    nasty = ["moronic", "scumbag", "worthless"]
    docs, labels = [], []
    for i in range(400):
        words = list(rng.choice(plain, 20)) + [f"u{i}"]
        bad = i % 3 == 0
        if bad:
            words.insert(int(rng.integers(0, 20)), nasty[i // 3 % 3])
        docs.append((i, " ".join(words)))
        labels.append((i, 0, int(bad), 0.0))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return frame, spark.createDataFrame(labels, LABELS)


@pytest.fixture(scope="module")
def model(world):
    return train(*world)


@pytest.mark.parametrize("disguise", [
    "w0rthless", "w0rthle$$", "worth1ess", "wooorthlesss", "w o r t h l e s s", "w.o.r.t.h.l.e.s.s", "sc*mbag", "$cumbag", "m0r0n!c", "S C U M B A G",
])
def test_disguised_words_are_scored(model, disguise):
    score = model.scorer()
    assert score(pa.array([f"the old {disguise} bridge"]))[0] >= 0.5
    assert score(pa.array(["the old stone bridge"]))[0] < 0.5


def test_held_out_labels(world, model):
    docs, labels = world
    got = score_documents(docs, model).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 40 and all(r.predicted == r.toxic for r in held)


def test_counts_see_all_text(spark):
    counts = character_counts(spark.createDataFrame([("ab",), (None,), ("",), ("a-b",)], "text string"))
    assert counts.sum() == 3 + 4  # a, b, edge; a, edge, b, edge
    p = np.exp(character_model(counts)).reshape(-1, 28).sum(axis=1)
    assert np.allclose(p, 1, atol=1e-3)


def test_spans_and_offsets():
    texts = ["plain words", "an 1d10t", "x", "y", "z", "w", "that*** $$$ 12:30 v2", "s t o p it"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    spans = [data[a:b].tobytes().decode() for a, b in suspicious_spans(data, offsets)]
    assert "1d10t" in spans and "s t o p" in spans and "xyzw" not in "".join(spans)
    decoder = Decoder(character_model(np.ones(28**4)))
    new, moved, changes = restore_slice(data, offsets, decoder)
    back = [new[a:b].tobytes().decode() for a, b in zip(moved[:-1], moved[1:])]
    assert back[0] == texts[0] and back[2:6] == texts[2:6] and len(back) == len(texts)
    assert {c[0] for c in changes} <= {1, 6, 7}


def test_edges(spark, make_docs, world, model):
    rows = [(1, None), (2, ""), (None, "moronic"), (3, "moronic"), (3, "moronic"), (4, "river " * 100_000 + "m0ronic"), (5, "1" * 100_000)]
    docs = make_docs(rows).withColumnRenamed("lang", "score").withColumnRenamed("source", "predicted")
    got = score_documents(docs, model).collect()
    assert sorted((r.doc_id or 0, r.predicted) for r in got) == [(0, 1), (1, 0), (2, 0), (3, 1), (3, 1), (4, 1), (5, 0)]
    assert not [r for r in got if r.doc_id is None][0].held_out
    kept = drop_toxic(docs, model)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 5] and kept.columns == docs.columns
    none, no_labels = make_docs([]), spark.createDataFrame([], LABELS)
    assert score_documents(none, train(none, no_labels)).collect() == []
    one = spark.createDataFrame([(1, 0, 0, 0.0), (2, 0, None, 0.0), (None, 0, 1, 0.0)], LABELS)
    assert [r.predicted for r in score_documents(world[0], train(world[0], one)).take(3)] == [0, 0, 0]


@pytest.mark.parametrize("gap", [" ", ".", "-"])
def test_long_spans_are_decoded(model, gap):
    """Toxic words spaced out letter by letter, several thousand letters on end."""

    words = "the river runs under an old stone bridge where children play and fish all day long".split() * 60 + ["worthless"]
    spaced = gap.join(gap.join(w) for w in words)
    score = model.scorer()
    assert len(spaced) > 8_000 and score(pa.array([spaced]))[0] >= 0.5
    assert score(pa.array([gap.join(gap.join(w) for w in words[:-1])]))[0] < 0.5


@pytest.mark.parametrize("disguise", ["worth-less", "mo.ronic", "scum_bag", "wor--thless", "m-oronic"])
def test_words_in_parts_are_scored(model, disguise):
    assert model.scorer()(pa.array([f"the old {disguise} bridge"]))[0] >= 0.5


def test_short_runs_of_single_letters_are_spans():
    text = b"an a s s or 1 2 3"
    spans = suspicious_spans(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert [text[a:b] for a, b in spans] == [b"a s s"]


def exhaustive(decoder, span):
    """Cost and text of the likeliest path, of all paths one by one."""

    paths = [(0.0, 0, b"")]
    for here in decoder._arcs(span):
        grown = []
        for cost, state, text in paths:
            for symbol, byte, price in here:
                if symbol < 0:
                    grown.append((cost + price, state, text))
                elif symbol == 0 and state % 28 == 0:
                    grown.append((cost + price, state, text if byte == 32 else text + bytes([byte])))
                else:
                    spent = cost + price - decoder.log_p[state * 28 + symbol]
                    grown.append((spent, (state * 28 + symbol) % 28**3, text + bytes([byte])))
        paths = grown
    return min((cost - (decoder.log_p[state * 28] if state % 28 else 0.0), text) for cost, state, text in paths)[1]


@pytest.mark.parametrize("wide", [0, 1_500, 10**9])
def test_wildcards_against_all_paths(monkeypatch, wide):
    """Two and three wildcards; the array steps and the others choose the same."""

    monkeypatch.setattr(toxicity, "WIDE", wide, raising=False)
    # All of s??e are common and one word is rare, so only the letters after the wildcards can tell.
    counts = np.zeros((28,) * 4)
    pairs = [("s" + x + y + "e", 1 if x + y == "qz" else 100) for x in string.ascii_lowercase for y in string.ascii_lowercase]
    for word, n in [*pairs, ("sqzkum", 1)]:
        held = [0, 0, 0, *(ord(c) - 96 for c in word), 0]
        for at in range(3, len(held)):
            counts[tuple(held[at - 3 : at + 1])] += n
    decoder = Decoder(character_model(counts))
    for span in (b"s**e", b"s**kum", b"s*zk*m", b"s**.kum", b"s**k*m"):
        assert decoder.restore(span) == exhaustive(decoder, span), span


def test_words_with_two_and_three_wildcards(world, model):
    decoder = Decoder(model.characters)
    for span, word in ((b"mor**ic", b"moronic"), (b"s*u*bag", b"scumbag"), (b"wo**hl*ss", b"worthless")):
        assert decoder.restore(span) == word


def families_of(groups):
    """Copy keys: texts of the same group above 0 share one."""

    keys = np.zeros((len(groups), 12), np.uint64)
    keys[:, 0] = groups
    return keys


def test_near_copies_of_a_clean_text_count_once():
    """A word in ten toxic texts and one clean text that has 100 near copies."""

    held = [np.array([8, 100 + 2 * i]) for i in range(10)] + [np.array([8, 300])] * 100
    held += [np.array([1000 + 2 * i]) for i in range(200)]
    labels = np.array([1] * 10 + [0] * 300)
    words, shares, _ = learn_words(held, families_of([0] * 10 + [1] * 100 + [0] * 200), labels)
    assert words.tolist() == [8] and np.allclose(shares, 10.5 / 12)


def test_weights_bring_back_true_shares():
    """Of 20 clean texts for each one in the sample, one holds the word of 60 toxic ones."""

    held = [np.array([8])] * 60 + [np.array([8])] + [np.array([1000 + 2 * i]) for i in range(60)]
    labels, keys = np.array([1] * 60 + [0] * 61), families_of([0] * 121)
    assert np.allclose(learn_words(held, keys, labels)[1], 60.5 / 62)
    words, _, base = learn_words(held, keys, labels, (20.0, 1.0))
    assert not len(words) and np.isclose(base, 60.5 / (60 + 61 * 20 + 1))


def test_each_label_has_its_own_bound(spark, make_docs):
    """One text in 40 is toxic, far fewer than the bound: all of them are learned from."""

    plain = "the river runs under an old stone bridge where children play and fish all day long".split()
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(4000):
        bad = i % 40 == 0
        rows.append((i, " ".join([*rng.choice(plain, 12), f"u{i}", *(["scumbag"] if bad else [])])))
        labels.append((i, 0, int(bad), 0.0))
    docs = make_docs(rows)
    model = train(docs, spark.createDataFrame(labels, LABELS), max_rows=200)
    got = score_documents(docs, model).collect()
    assert all(r.predicted == int(r.doc_id % 40 == 0) for r in got)
    assert model.base < 0.02


def test_one_id_under_many_rows(spark, make_docs):
    """One id has nine tenths of all rows, and the fit takes about twice its bound of rows."""

    rng = np.random.default_rng(3)
    plain = "the river runs under an old stone bridge where children play and fish all day long".split()
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        rows.append((i, " ".join([*rng.choice(plain, 12), f"u{i}", *(["scumbag"] if bad else [])])))
        labels.append((i, 0, int(bad), 0.0))
    rows += [(1, " ".join([*rng.choice(plain, 12), f"hot{k}"])) for k in range(6000)]
    docs = make_docs(rows)
    model = train(docs, spark.createDataFrame(labels, LABELS), max_rows=700)
    got = score_documents(docs, model).collect()
    assert all(r.predicted == int(r.doc_id != 1 and r.doc_id % 3 == 0) for r in got)
