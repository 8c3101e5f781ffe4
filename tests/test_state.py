import random
import time

import pytest

from sonoledger.operators import telemetry as tel
from sonoledger.sources.telemetry import append_telemetry, read_telemetry
from sonoledger.streaming import monitor, state


@pytest.fixture
def store(spark):
    before = spark.conf.get(state.STORE_KEY)
    spark.conf.set(state.STORE_KEY, state.STORE)
    yield spark
    spark.conf.set(state.STORE_KEY, before)


def add(spark, path, rows):
    frame = spark.createDataFrame(rows, "chunk_id string, gpu_index long, status string, timestamp string, k double")
    append_telemetry(
        frame.selectExpr(
            "chunk_id", "gpu_index", "status", "timestamp",
            "named_struct('attempt', k % 4 + 1, 'gpu_metrics', named_struct('before', named_struct('index', gpu_index,"
            " 'utilization', if(k % 5 = 0, NULL, k), 'memory_used_mb', 100 + k, 'memory_total_mb', 1000D))) AS details",
        ).coalesce(1),
        path,
    )


def shown(df):
    return {r.device: (r.util_history, r.memory_history, r.retry_history) for r in df.collect()}


def test_rings_equal_the_batch_form_across_restarts(store, tmp_path):
    """Batches in mixed order, one device with most events, the query stopped and started between them."""

    log, cp = f"{tmp_path}/log", f"{tmp_path}/cp"
    rng = random.Random(3)
    times = rng.sample(range(1000, 9999), 300)
    for part in range(3):
        rows = [(f"c{t}", 0 if rng.random() < 0.7 else rng.choice([1, None]), "success", str(t), float(t % 97))
                for t in times[part * 100 : part * 100 + 100]]
        add(store, log, rows)
        state.start_state_histories(monitor.telemetry_stream(store, log, 1), cp).awaitTermination()
        want = tel.device_histories(tel.device_events(read_telemetry(store, log), tel.time_order()))
        assert shown(state.read_state_histories(store, cp)) == shown(want)
    # Nothing new: the state stays as it is.
    state.start_state_histories(monitor.telemetry_stream(store, log, 1), cp).awaitTermination()
    assert shown(state.read_state_histories(store, cp)) == shown(want)


def test_rings_are_bounded(store, tmp_path):
    log, cp = f"{tmp_path}/log", f"{tmp_path}/cp"
    add(store, log, [(f"c{i}", 0, "success", f"{i:05d}", 1.0) for i in range(2000)])
    state.start_state_histories(monitor.telemetry_stream(store, log), cp, length=5, parts=2).awaitTermination()
    rings = store.read.format("statestore").option("stateVarName", state.RING).load(cp)
    assert rings.count() == 2 * 3 * 5


def test_silent_devices_are_dropped(store, tmp_path):
    """A time to live that has passed by the next batch."""

    log, cp = f"{tmp_path}/log", f"{tmp_path}/cp"

    def run():
        state.start_state_histories(monitor.telemetry_stream(store, log, 1), cp, ttl_ms=20_000).awaitTermination()
        return set(shown(state.read_state_histories(store, cp)))

    add(store, log, [("a", 0, "success", "00001", 1.0)])
    assert run() == {"GPU 0"}
    time.sleep(20)
    add(store, log, [("b", 1, "success", "00002", 2.0)])
    assert run() == {"GPU 1"}
