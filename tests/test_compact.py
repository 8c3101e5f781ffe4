import json

import pytest
from pyspark.sql import functions as F

from sonoledger.streaming import compact as C
from sonoledger.streaming.ingest import add_up, by_window


def batch(spark, out, n, rows=3):
    spark.range(n * 10, n * 10 + rows).withColumn("b", F.lit(n)).write.mode("overwrite").parquet(f"{out}/batch={n}")


def ids(spark, out):
    return sorted(r.id for r in C.read_batches(spark, out).collect())


def folders(tmp_path):
    return sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir())


def test_many_batches_become_few_files(spark, tmp_path):
    """The same rows at every moment, and a number of folders that does not grow."""

    out, want = f"{tmp_path}/t", []
    for n in range(12):
        batch(spark, out, n)
        want += [n * 10 + i for i in range(3)]
        done = C.compact(spark, out, least=3)
        assert ids(spark, out) == want
        assert done is None or done == n - 1  # the newest batch is left as it is
        assert len(folders(tmp_path)) <= 3 + 1 + 3 + 2
    assert C.current(out)["upto"] >= 8
    assert len(list((tmp_path / "t" / C.current(out)["generation"]).glob("*.parquet"))) == 1


def test_a_batch_that_runs_again(spark, tmp_path):
    out = f"{tmp_path}/t"
    for n in range(5):
        batch(spark, out, n)
    before = ids(spark, out)
    assert C.compact(spark, out) == 3
    batch(spark, out, 4)  # not folded in: replaced
    batch(spark, out, 2)  # folded in already: left out
    assert ids(spark, out) == before
    (tmp_path / "t" / "batch=5").mkdir()  # begun and not finished
    assert ids(spark, out) == before and C.compact(spark, out) is None


@pytest.mark.parametrize("step", ["repartition", "publish", "_sweep"])
def test_a_crash_between_two_steps(spark, tmp_path, monkeypatch, step):
    """Readers see every batch once whatever was done; the next run goes on."""

    out = f"{tmp_path}/t"
    for n in range(6):
        batch(spark, out, n)
    before = ids(spark, out)
    calls = []

    def dies(*args, **kwargs):
        calls.append(args)
        if step != "_sweep" or len(calls) > 1:
            raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        if step == "repartition":  # the generation was written, the pointer was not
            patch.setattr(C.json, "dumps", dies)
        else:
            patch.setattr(C, step, dies)
        with pytest.raises(KeyboardInterrupt):
            C.compact(spark, out)
    assert ids(spark, out) == before
    batch(spark, out, 6)
    batch(spark, out, 7)
    batch(spark, out, 8)
    assert C.compact(spark, out) == 7
    assert ids(spark, out) == before + [60 + i for i in range(3)] + [70, 71, 72, 80, 81, 82]
    assert len([f for f in folders(tmp_path) if f.startswith("generation=")]) <= 2


def test_sums_are_folded(spark, tmp_path):
    out = f"{tmp_path}/t"
    for n in range(4):
        spark.createDataFrame([(1, "w", 0, 2, 1.5, 2), (2, f"w{n}", None, 1, None, 0)],
                              "bucket int, chunk_id string, chunk_start_ms long, n long, total double, known long"
                              ).write.parquet(f"{out}/batch={n}")
    want = sorted(map(tuple, add_up(C.read_batches(spark, out)).collect()), key=str)
    assert C.compact(spark, out, fold=add_up) == 2
    assert sorted(map(tuple, add_up(C.read_batches(spark, out)).collect()), key=str) == want
    assert spark.read.parquet(f"{out}/{C.current(out)['generation']}").count() == 4


def test_an_empty_folder_and_the_pointer(spark, tmp_path):
    assert C.compact(spark, f"{tmp_path}/none") is None
    for n in range(3):
        batch(spark, f"{tmp_path}/t", n)
    C.compact(spark, f"file://{tmp_path}/t", keep=0)  # a path with a scheme
    held = json.loads((tmp_path / "t" / C.POINTER).read_text())
    assert held["upto"] == 1 and folders(tmp_path) == ["batch=2", held["generation"]]


def test_sums_are_added_in_tasks_of_bounded_length(spark):
    rows = spark.range(4000).coalesce(1).selectExpr(
        "id % 4 AS bucket", "concat('w', id % 2000) AS chunk_id", "id % 2000 AS chunk_start_ms",
        "1L AS n", "1D AS total", "1L AS known")
    lengths = by_window(rows, per_task=100).rdd.glom().map(len).collect()
    assert len(lengths) == 40 and max(lengths) <= 200
    summed = add_up(rows)
    assert summed.count() == 2000 and {r.n for r in summed.collect()} == {2}
    # One exchange, below every adding up: plans print from the top down.
    plan = summed._jdf.queryExecution().sparkPlan().toString()
    assert plan.rindex("HashAggregate") < plan.index("Exchange hashpartitioning")
    assert summed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hash") == 1
