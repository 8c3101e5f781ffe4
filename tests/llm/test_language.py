import numpy as np

from sonoledger.llm._ftrl import temperature
from sonoledger.llm.language import Letters, identify, n_grams


def test_held_out_accuracy(table):
    docs = table("documents")
    got = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and held
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_edge_rows(make_docs, spark):
    base = [(i, f"the quick brown fox number {i}", "en") for i in range(1, 40)] + [
        (i, f"der schnelle braune fuchs nummer {i}", "de") for i in range(40, 80)
    ]
    odd = [(100, None, "en"), (101, "", None), (102, "123 !!", None), (None, "the brown fox", "xx"), (103, "the fox " * 60_000, None),
           (104, "der fuchs", None), (104, "der fuchs", None)]
    docs = spark.createDataFrame([(*r, 1.0, True) for r in base + odd], "doc_id long, text string, lang string, score double, held_out boolean")
    got = {(r.doc_id, r.lang_pred, r.score > 0) for r in identify(docs).collect()}
    for i in (100, 101, 102):
        assert (i, "und", False) in got
    assert (103, "en", True) in got and (104, "de", True) in got
    assert not any(p == "xx" for _, p, _ in got)  # never learned from a null id
    assert identify(docs).count() == len(base) + len(odd)


def test_nothing_to_learn_from(make_docs):
    assert identify(make_docs([])).collect() == []
    got = identify(make_docs(["abc", "def"], lang=None)).collect()
    assert [r.lang_pred for r in got] == ["und", "und"]


def test_grams_stay_inside_their_text():
    letters = Letters()
    alone = [sorted(b.tolist()) for _, b in n_grams(["ab c"], letters)]
    both = [sorted(b[r == 1].tolist()) for r, b in n_grams(["xyz", "ab c"], letters)]
    assert alone == both


def test_temperature_cools_unsure_scores():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 2, 500)
    sure = np.where(labels[:, None] == np.arange(2), 5.0, 0.0)
    wrong = rng.random(500) < 0.3
    sure[wrong] = sure[wrong][:, ::-1]
    assert temperature(sure, labels) > 3
    assert temperature(np.zeros((0, 2)), np.zeros(0, int)) == 1.0
