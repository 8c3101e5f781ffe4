"""Column expressions: everything here stays inside Catalyst."""

from sonoledger.functions.device_metrics import attempt_number, event_retries, metric_block
from sonoledger.functions.paths import basename, directory, parent_name, posix_path, stem
from sonoledger.functions.scalars import (
    absolute_time,
    blank_to_null,
    bucket_index,
    bucket_label,
    chunk_key,
    first_text,
    memory_estimate_mb,
    memory_limit_mb,
    seconds_to_ms,
    tolerant_double,
    tolerant_long,
)
from sonoledger.functions.sparkline import sparkline

__all__ = [
    "absolute_time",
    "attempt_number",
    "basename",
    "blank_to_null",
    "bucket_index",
    "bucket_label",
    "chunk_key",
    "directory",
    "event_retries",
    "first_text",
    "memory_estimate_mb",
    "memory_limit_mb",
    "metric_block",
    "parent_name",
    "posix_path",
    "seconds_to_ms",
    "sparkline",
    "stem",
    "tolerant_double",
    "tolerant_long",
]
