import json

import pytest

from sonoledger.operators import telemetry as tel
from sonoledger.sources.runs import parse_run_summary, read_run_summary, write_worker_totals
from sonoledger.sources.telemetry import append_telemetry, count_skipped, read_telemetry
from sonoledger.streaming import monitor


def log(path, events, blank=True):
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [json.dumps(e) for e in events]
    path.write_text("\n".join(lines) + "\n" + ("\n\n" if blank else ""))
    return str(path)


def gpu_events(n=30):
    return [
        {"chunk_id": f"chunk_gpu_{i}", "gpu_index": 0, "gpu_name": "Quadro RTX 4000",
         "status": "success" if i % 2 == 0 else "failure", "timestamp": f"2025-12-08T20:{13 + i:02d}:00Z",
         "runtime_s": 10.0 + i,
         "details": {"gpu_metrics": {"after": {"utilization": 10 + i, "memory_used_mb": 5400 + i,
                                               "memory_total_mb": 8192}}}}
        for i in range(n)
    ]


CPU = {"chunk_id": "chunk_cpu", "gpu_index": None, "status": "success", "timestamp": "2025-12-08T21:00:00Z",
       "runtime_s": 3.0, "details": {}}


def test_device_summary(spark, tmp_path):
    events = read_telemetry(spark, log(tmp_path / "log.jsonl", [*gpu_events(), CPU]))
    rows = {r.device: r for r in tel.device_summary(events).collect()}
    gpu, cpu = rows["GPU 0"], rows["CPU"]
    assert (gpu.events, gpu.success, gpu.failures, gpu.failure_attempts) == (30, 15, 15, 15)
    assert (gpu.util_min, gpu.util_max, gpu.max_memory, gpu.memory_total) == (10.0, 39.0, 5429.0, 8192)
    assert (gpu.last_chunk, gpu.name) == ("chunk_gpu_29", "Quadro RTX 4000")
    assert gpu.util_history == [float(v) for v in range(16, 40)]
    assert len(gpu.memory_history) == 24 and gpu.retry_history == [0.0] * 24
    assert (cpu.events, cpu.success, cpu.avg_runtime, cpu.name, cpu.util_avg) == (1, 1, 3.0, "CPU", None)
    assert cpu.util_history == [] and cpu.retry_history == [0.0]


def test_event_details(spark, tmp_path):
    before = {"utilization": 1, "memory_used_mb": 2}
    events = [
        {"chunk_id": "a", "gpu_index": 1, "gpu_name": "X", "timestamp": "t1",
         "details": {"attempt": 3, "gpu_metrics": {"before": before, "after": None}}},
        {"chunk_id": "b", "gpu_index": 1, "gpu_name": "", "status": "SUCCESS",
         "details": {"attempt": 2.9, "gpu_metrics": {"before": {}, "after": {"utilization": 7}}}},
        {"chunk_id": "c", "gpu_index": 1, "status": "failure", "details": {"attempt": "4"}},
        {"chunk_id": "d", "gpu_index": 1, "status": "success", "details": "free text"},
    ]
    flat = tel.device_events(read_telemetry(spark, log(tmp_path / "l.jsonl", events)))
    row = tel.device_totals(flat).first()
    assert (row.events, row.success, row.failures) == (4, 2, 1)
    assert (row.retry_attempts, row.retry_events, row.failure_attempts) == (1, 1, 1)
    assert (row.last_timestamp, row.name, row.last_status, row.last_chunk) == ("t1", "X", "success", "d")
    assert (row.util_min, row.util_max, row.last_metrics.utilization) == (1.0, 7.0, 7.0)
    hist = tel.device_histories(flat).first()
    assert (hist.util_history, hist.memory_history, hist.retry_history) == ([1.0, 7.0], [2.0], [2.0, 1.0, 0.0, 0.0])


def test_free_details_are_kept(spark, tmp_path):
    details = {"attempt": 2, "site": {"name": "north", "tags": ["a", None, 1.5]}, "note": "x \u00e9 \"y\""}
    events = [{"chunk_id": "a", "details": details}, {"chunk_id": "b"}, {"chunk_id": "c", "details": "free text"}]
    read = read_telemetry(spark, log(tmp_path / "l.jsonl", events))
    again = read_telemetry(spark, append_telemetry(read, f"{tmp_path}/again"))
    for rows in ({r.chunk_id: r for r in df.collect()} for df in (read, again)):
        assert json.loads(rows["a"].details_json) == details and rows["a"].details.attempt == 2
        assert rows["b"].details_json is None and rows["c"].details_json == "free text"
    assert read_telemetry(spark, f"{tmp_path}/none.jsonl").columns == read.columns


def test_skipped_lines_are_counted(spark, tmp_path):
    lines = ['{"chunk_id": "a"}', '{"chunk_id": "b", "sta', "", "  ", '{"status": "x"}', '{"chunk_id": null}', "[]", "text"]
    (tmp_path / "l.jsonl").write_text("\n".join(lines))
    count = count_skipped(spark.read.text(f"{tmp_path}/l.jsonl")).first()
    assert count.asDict() == {"lines": 6, "broken": 2, "without_chunk_id": 3}
    assert read_telemetry(spark, f"{tmp_path}/l.jsonl").count() == count.lines - count.broken - count.without_chunk_id


def test_missing_log_is_empty(spark, tmp_path):
    assert read_telemetry(spark, f"{tmp_path}/none.jsonl").count() == 0


def test_default_status_and_tail_order(spark, tmp_path):
    events = read_telemetry(spark, log(tmp_path / "l.jsonl", [{"chunk_id": f"c{i}"} for i in range(40)]))
    assert {r.status for r in events.collect()} == {"unknown"}
    tail = tel.tail_table(events, 3).collect()
    assert [(r.chunk_id, r.device, r.attempt) for r in tail] == [
        ("c37", "CPU", None), ("c38", "CPU", None), ("c39", "CPU", None)]


def test_line_order_holds_across_splits(spark, tmp_path):
    """A log cut into many splits keeps its order."""

    path = log(tmp_path / "big.jsonl", [{"chunk_id": f"c{i}", "details": {"attempt": i}} for i in range(20_000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        events = read_telemetry(spark, path)
        assert events.rdd.getNumPartitions() > 4
        ordered = events.orderBy("event_order").collect()
        assert [r.chunk_id for r in ordered] == [f"c{i}" for i in range(20_000)]
        hist = tel.device_histories(tel.device_events(events)).first()
        assert hist.retry_history == [float(i - 1) for i in range(19_976, 20_000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_history_is_thinned_before_the_shuffle(spark):
    events = spark.createDataFrame([], read_schema())
    plan = tel.device_histories(tel.device_events(events))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def read_schema():
    from sonoledger.schemas import TELEMETRY

    return TELEMETRY


def test_worker_totals_and_hotspots(spark, tmp_path):
    results = spark.createDataFrame(
        [("a", "r", "success", 3, 2, "o", "gpu-0", 4.0, "e", None),
         ("b", "r", "failure", 3, None, None, "gpu-0", 5.0, "e", "x"),
         ("c", None, "success", 1, 0, "o", "cpu-0", None, None, None),
         *[(f"z{i}", "r", "success", 2, 1, "o", "cpu-0", None, None, None) for i in range(6)]],
        "chunk_id string, recording_id string, status string, attempts int, retries int, output string,"
        " worker string, last_backoff_s double, last_error string, error string")
    totals = {r.worker: tuple(r)[1:] for r in tel.worker_totals(results).collect()}
    assert totals == {"gpu-0": (2, 1, 1, 2, 2), "cpu-0": (7, 7, 0, 6, 0)}
    top, counts = tel.top_hotspots(results)
    assert [r.chunk_id for r in top.collect()] == ["a", "z0", "z1", "z2", "z3"]
    assert tuple(counts.first()) == (8, 3)
    write_worker_totals(tel.worker_totals(results), f"{tmp_path}/w")
    text = next((tmp_path / "w").glob("part*.csv")).read_text().splitlines()
    assert text[0] == "worker,jobs,success,failure,retries,failed_retries" and text[1].startswith("cpu-0,7")


def test_run_summary(spark, tmp_path):
    doc = {"workers": {}, "jobs": {"chunk_a": {"status": "success", "attempts": 2}, "chunk_b": "odd",
                                   "chunk_c": {"status": "failure", "recording_id": "rec1"}}}
    (tmp_path / "s.json").write_text(json.dumps(doc, indent=2))
    rows = {r.chunk_id: (r.recording_id, r.status, r.attempts) for r in
            read_run_summary(spark, f"{tmp_path}/s.json").collect()}
    assert rows == {"chunk_a": (None, "success", 2), "chunk_c": ("rec1", "failure", None)}
    texts = spark.createDataFrame([("p", "{broken"), ("q", '{"jobs": null}')], "summary_path string, value string")
    assert parse_run_summary(texts).count() == 0


def add(spark, path, n, start=0, device=0):
    from pyspark.sql import functions as F

    rows = spark.range(start, start + n).selectExpr(
        "concat('c', id) AS chunk_id", f"{device}L AS gpu_index", "'success' AS status",
        "lpad(id, 8, '0') AS timestamp",
        "named_struct('attempt', cast(id AS double)) AS details")
    append_telemetry(rows.coalesce(1), path)


@pytest.mark.parametrize("second", [5, 60])
def test_live_state_across_batches(spark, tmp_path, second):
    src, state, tail = f"{tmp_path}/log", f"{tmp_path}/state", f"{tmp_path}/tail"
    add(spark, src, 50)
    add(spark, src, 3, device=1)

    def run():
        monitor.start_histories(monitor.telemetry_stream(spark, src, 1), state, f"{tmp_path}/cp1").awaitTermination()
        monitor.start_tail(monitor.telemetry_stream(spark, src, 1), tail, f"{tmp_path}/cp2", 4).awaitTermination()

    run()
    add(spark, src, second, start=50)
    run()
    hist = {r.device: r.retry_history for r in monitor.read_histories(spark, state).collect()}
    end = 50 + second
    assert hist["GPU 0"] == [float(i - 1) for i in range(end - 24, end)]
    assert hist["GPU 1"] == [0.0, 0.0, 1.0]
    assert sorted(r.chunk_id for r in monitor.read_newest(spark, tail).collect()) == [
        f"c{i}" for i in range(end - 4, end)]


def test_live_totals_update(spark, tmp_path):
    src, seen = f"{tmp_path}/log", []
    add(spark, src, 10)

    def keep(batch, batch_id):
        seen.append({r.device: r.events for r in batch.collect()})

    for n in (0, 7):
        if n:
            add(spark, src, n, start=10)
        monitor.start_totals(monitor.telemetry_stream(spark, src), keep, f"{tmp_path}/cp").awaitTermination()
    assert seen[-1] == {"GPU 0": 17} and seen[0] == {"GPU 0": 10}
