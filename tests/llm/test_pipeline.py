import collections

import corpus_pipeline
import __spark_entry__ as entry
from tests.llm.test_decontaminate import brute as hit_by
from tests.llm.test_near_dup import brute_classes


def test_registered():
    names = [q for q in entry.queries() if q.startswith("op") and q[2].isdigit()]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_stages_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.materialise(stage(spark, before, sf_dir), f"test-{name}")
        rows, left = [(r.doc_id, r.text) for r in before.collect()], after.collect()
        ids = {r.doc_id for r in left}
        if name != "sentencepiece":
            assert after.columns == columns
        if name == "near_duplicates":
            classes = brute_classes(rows)
            assert ids == set(classes.values()) and len(left) == len(ids)
        if name == "decontamination":
            long = [r for r in rows if len(r[1].split()) < 3000]
            assert ids >= {r[0] for r in hit_by(long, items) if not r[5]}
            assert not ids & {r[0] for r in hit_by(long, items) if r[5]}
        if name in ("secrets", "sentencepiece"):
            assert ids == {r[0] for r in rows}
        before = after


def test_clean_documents_stay(spark):
    rows = [(i, f"clean words of document {i} about {i * 7} and {i * 13} other plain things", "en", "s", 1) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, "/root/testdata/sf0.001"), "test-clean")
    assert collections.Counter(r.doc_id for r in docs.collect()) == {i: 1 for i in range(30)}
