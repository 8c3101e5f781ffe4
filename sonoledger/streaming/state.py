"""Device histories in the streaming state store.

The newest samples of each device and series are a ring in Spark's state store: versioned with
the query's checkpoint, restored after a restart or on another executor, and dropped by a time
to live when a device falls silent. Samples of a device are dealt over ``PARTS`` rings by their
window, so one device with a third of all events is many tasks; a ring is as long as a history,
so the newest of all rings together are the newest of the device.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sonoledger.operators import telemetry as tel

PARTS = 8
# The setting and class of the store that holds such state.
STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

RING = "newest"
_PLACE = ["timestamp", "file", "block", "row"]
_SAMPLE = "series STRING, timestamp STRING, file STRING, block BIGINT, row BIGINT, value DOUBLE"
_FIELDS = ["series", *_PLACE, "value"]


class NewestSamples(StatefulProcessor):
    """Keeps the newest ``length`` samples of each series of a key; emits those it holds."""

    def __init__(self, length: int, ttl_ms: int | None) -> None:
        self.length, self.ttl_ms = length, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState(RING, _SAMPLE, self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame([tuple(r) for r in self.ring.get()], columns=_FIELDS)
        for frame in rows:
            # Thinned frame by frame: a key never holds more than a frame beside its ring.
            both = frame[_FIELDS] if held.empty else pd.concat([held, frame[_FIELDS]], ignore_index=True)
            held = both.sort_values(_PLACE, ascending=False, kind="stable").groupby("series", sort=False).head(self.length)
        self.ring.put([
            (s, t, f, int(b), int(r), float(v)) for s, t, f, b, r, v in held.itertuples(index=False, name=None)
        ])
        yield pd.DataFrame({"device": [key[0]], "part": [key[1]], "samples": [len(held)]})

    def close(self) -> None:
        pass


def history_samples(events: DataFrame, parts: int = PARTS) -> DataFrame:
    """Samples of every series with their place in time, keyed by device and part."""

    flat = tel.device_events(events, tel.time_order())
    pairs = F.array(*[
        F.struct(F.lit(name).alias("series"), F.col(column).cast("double").alias("value"))
        for name, column in (("utilization", "utilization"), ("memory", "memory_used_mb"), ("retries", "retries"))
    ])
    return flat.select(
        "device", F.pmod(F.xxhash64("chunk_id"), F.lit(parts)).cast("int").alias("part"), "ord", F.explode(pairs).alias("s")
    ).select(
        "device", "part", "s.series", F.coalesce("ord.timestamp", F.lit("")).alias("timestamp"),
        F.col("ord.event_order.file").alias("file"), F.col("ord.event_order.block").alias("block"),
        F.col("ord.event_order.row").alias("row"), F.col("s.value").alias("value"),
    ).filter("value IS NOT NULL")


def start_state_histories(
    events: DataFrame, checkpoint: str, length: int = tel.HISTORY_LENGTH, ttl_ms: int | None = None,
    interval: str | None = None, parts: int = PARTS,
) -> StreamingQuery:
    """Keep the newest ``length`` samples per device and series in the state store.

    With ``ttl_ms`` a ring that gets no sample for that long is dropped. The session must use
    the state store ``STORE`` (``STORE_KEY``). :func:`read_state_histories` reads the rings.
    """

    kept = history_samples(events, parts).groupBy("device", "part").transformWithStateInPandas(
        NewestSamples(length, ttl_ms), "device STRING, part INT, samples INT", "Update",
        "ProcessingTime" if ttl_ms else "None",
    )
    # The state is the result; what a batch changed needs no other place.
    writer = kept.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
    if interval:
        writer = writer.trigger(processingTime=interval)
    elif ttl_ms:  # state that expires asks for batches without end, so what is there is one batch
        writer = writer.trigger(once=True)
    else:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_state_histories(spark: SparkSession, checkpoint: str, length: int = tel.HISTORY_LENGTH) -> DataFrame:
    """Arrays per device, as in the batch form, of the last batch that was committed.

    Samples past their time to live are left out, removed from the store already or not.
    """

    rings = spark.read.format("statestore").option("stateVarName", RING).load(checkpoint)
    sample = F.col("list_element")
    if "ttlExpirationMs" in rings.schema["list_element"].dataType.names:
        rings = rings.filter(sample["ttlExpirationMs"] > F.unix_millis(F.current_timestamp()))
        sample = sample["value"]
    series = rings.select(
        F.col("key.device").alias("device"), sample["series"].alias("series"),
        F.struct(*[sample[c].alias(c) for c in _PLACE]).alias("ord"), sample["value"].alias("value"),
    )
    return tel.pack_histories(tel.newest_samples(series, length))
