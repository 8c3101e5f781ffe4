"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of ``window`` consecutive words of a benchmark item (all words
of a shorter item). Patterns of one length share a shift table over blocks of two
words: a block that is in no pattern lets the search jump over window - 1 words. Where
the shift is zero, the suffix-hash bucket names the patterns to test, and a direct
comparison of the text confirms the occurrence.

All texts of a slice are searched at once: each stretch of words has a cursor, and the
cursors jump together.

The patterns go to the tasks in blocks of at most ``BLOCK_WORDS`` words; further blocks
are further passes over the documents, so a benchmark of any size is searched whole.

Cases: a null text has no words and no hits; a null item text has no window; items that
repeat an id count once; a null item id is the empty string; repeated documents are rows
of their own; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructType

from sonoledger.llm._words import Hasher, Words, counts_by_doc, mix, slices, words_of
from sonoledger.session import materialise

WINDOW = 10
BLOCK_WORDS = 200_000
STRETCH = 256  # words under one cursor
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = bytes(range(65, 91))


def item_words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().translate(bytes.maketrans(_UPPER, _UPPER.lower())))


class Patterns:
    """Search tables for patterns of one length in words."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[str]]) -> None:
        self.texts = list(windows)
        self.items = [sorted(windows[t]) for t in self.texts]
        self.length = m = len(self.texts[0])
        hasher = Hasher()
        joined = np.frombuffer(b" ".join(b" ".join(t) for t in self.texts), np.uint8)
        found = words_of(joined, np.array([0, len(joined)]), hasher)
        self.hashes = found.hash.reshape(len(self.texts), m)
        self.block = b = min(2, m)
        self.bits = int(np.clip(np.ceil(np.log2(len(self.texts) * m + 1)) + 3, 12, 24))
        self.shift = np.full(1 << self.bits, m - b + 1, np.uint8 if m < 255 else np.int32)
        for end in range(b - 1, m):
            key = self._block_key(self.hashes[:, end], self.hashes[:, end - b + 1])
            np.minimum.at(self.shift, key >> np.uint64(64 - self.bits), m - 1 - end)
        suffix = self._block_key(self.hashes[:, m - 1], self.hashes[:, m - b])
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.hashes = suffix[order], self.hashes[order]
        self.texts = [self.texts[i] for i in order]
        self.items = [self.items[i] for i in order]

    def _block_key(self, last: np.ndarray, first: np.ndarray) -> np.ndarray:
        return mix(last * np.uint64(0xD6E8FEB86659FD93) + first) if self.block > 1 else mix(last)

    def find(self, words: Words, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last word, pattern) of every occurrence."""

        m, rows = self.length, len(offsets) - 1
        bounds = np.searchsorted(words.doc, np.arange(rows + 1))
        first, stop = bounds[:-1] + m - 1, bounds[1:]
        pieces = np.maximum(-(-(stop - first) // STRETCH), 0)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = np.repeat(first, pieces) + nth * STRETCH
        limit = np.minimum(at + STRETCH, np.repeat(stop, pieces))
        zero = []
        while len(at):
            key = self._block_key(words.hash[at], words.hash[at - self.block + 1])
            jump = self.shift[key >> np.uint64(64 - self.bits)].astype(np.int64)
            stays = jump == 0
            if stays.any():
                zero.append(np.stack([at[stays].astype(np.uint64), key[stays]]))
            at = at + np.maximum(jump, 1)
            going = at < limit
            at, limit = at[going], limit[going]
        if not zero:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends, keys = np.concatenate(zero, axis=1)
        ends = ends.astype(np.int64)
        low, high = np.searchsorted(self.suffix, keys), np.searchsorted(self.suffix, keys, side="right")
        return self._tested(words, ends, low, high)

    def _tested(self, words: Words, ends, low, high) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences among the patterns of each bucket, tested a bounded number at a time."""

        m, found = self.length, []
        k = 0
        sizes = np.cumsum(high - low)
        while k < len(ends):
            stop = max(int(np.searchsorted(sizes, (sizes[k - 1] if k else 0) + 100_000, side="right")), k + 1)
            n = high[k:stop] - low[k:stop]
            end = np.repeat(ends[k:stop], n)
            pattern = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[k:stop], n)
            for back in range(m - 1, -1, -1):  # from the front, where patterns of a bucket differ
                same = words.hash[end - back] == self.hashes[pattern, m - 1 - back]
                end, pattern = end[same], pattern[same]
            same = np.fromiter((self._direct(words, e, p) for e, p in zip(end, pattern)), bool, len(end))
            found.append((end[same], pattern[same]))
            k = stop
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _direct(self, words: Words, end: int, pattern: int) -> bool:
        return all(
            words.low[words.start[w] : words.end[w]].tobytes() == word
            for w, word in enumerate(self.texts[pattern], int(end) - self.length + 1)
        )


def build_patterns(items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> list[Patterns]:
    """One table per pattern length."""

    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for item, words in items:
        if words:
            n = min(window, len(words))
            for i in range(len(words) - n + 1):
                by_length.setdefault(n, {}).setdefault(tuple(words[i : i + n]), set()).add(item)
    return [Patterns(windows) for _, windows in sorted(by_length.items())]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items with their words, read item by item, in blocks of about ``most`` words."""

    block, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), text_col)
    for item, text in rows.toLocalIterator():
        words = item_words(text)
        block.append((item, words))
        size += len(words)
        if size >= most:
            yield block
            block, size = [], 0
    yield block


def _scan(batches, patterns, column: int, hasher: Hasher):
    """(batch, n_words, hit words as ranges per row, items per row)."""

    for batch in batches:
        rows = batch.num_rows
        n_words = np.zeros(rows, np.int64)
        ranges: dict[int, list] = {}
        items: dict[int, set[str]] = {}
        for first, data, offsets in slices(batch.column(column)):
            words = words_of(data, offsets, hasher)
            count = counts_by_doc(words.doc, len(offsets) - 1)
            n_words[first : first + len(count)] = count
            begins = np.cumsum(count) - count
            for table in patterns:
                ends, which = table.find(words, offsets)
                for end, p in zip(ends.tolist(), which.tolist()):
                    doc = int(words.doc[end])
                    place = end - int(begins[doc])
                    ranges.setdefault(first + doc, []).append((place - table.length + 1, place + 1))
                    items.setdefault(first + doc, set()).update(table.items[p])
        yield batch, n_words, ranges, items


def _covered(ranges: list[tuple[int, int]]) -> int:
    total, reach = 0, 0
    for a, b in sorted(ranges):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


def _row(n_words: np.ndarray, ranges: dict, items: dict) -> list[pa.Array]:
    rows = range(len(n_words))
    hit = [_covered(ranges[r]) if r in ranges else 0 for r in rows]
    none = hashlib.sha256(b"").hexdigest()
    digest = [hashlib.sha256(",".join(sorted(items[r])).encode()).hexdigest() if r in items else none for r in rows]
    return [
        pa.array(n_words, pa.int64()), pa.array(hit, pa.int64()),
        pa.array([len(items.get(r, ())) for r in rows], pa.int64()),
        pa.array(digest, pa.string()), pa.array([h > 0 for h in hit], pa.bool_()),
    ]


_FOUND = [
    ("n_words", LongType()), ("n_hit", LongType()), ("n_items", LongType()),
    ("items_sha256", StringType()), ("contaminated", BooleanType()),
]


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every document."""

    blocks = _blocks(benchmark, item_id_col, item_text_col, block_words)
    block = next(blocks)
    following = next(blocks, None)
    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if following is None:
        return _one_pass(kept, build_patterns(block, window))
    numbered = materialise(
        kept.withColumn("row_no", F.monotonically_increasing_id()), "decontaminate-docs"
    )
    parts = []
    while block is not None:
        parts.append(materialise(_block_hits(numbered, build_patterns(block, window)), "decontaminate-block"))
        block, following = following, next(blocks, None)
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    return _merged(numbered, hits)


def _one_pass(kept: DataFrame, patterns: list[Patterns]) -> DataFrame:
    schema = StructType([kept.schema["doc_id"]])
    for name, kind in _FOUND:
        schema = schema.add(name, kind)

    def work(batches):
        for batch, n_words, ranges, items in _scan(batches, patterns, 1, Hasher()):
            yield pa.RecordBatch.from_arrays([batch.column(0), *_row(n_words, ranges, items)], names=schema.names)

    return kept.mapInArrow(work, schema)


def _block_hits(numbered: DataFrame, patterns: list[Patterns]) -> DataFrame:
    """One row per document and block: its words, merged hit ranges and items."""

    schema = "row_no long, n_words long, ranges array<struct<a:long,b:long>>, items array<string>"
    names = ["row_no", "n_words", "ranges", "items"]

    def work(batches):
        for batch, n_words, ranges, items in _scan(batches, patterns, 1, Hasher()):
            rows = range(batch.num_rows)
            pairs = pa.array(
                [[{"a": a, "b": b} for a, b in sorted(set(ranges.get(r, ())))] for r in rows],
                pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])),
            )
            named = pa.array([sorted(items.get(r, ())) for r in rows], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(n_words), pairs, named], names=names)

    return numbered.select("doc_id", "text", "row_no").mapInArrow(work, schema)


def _merged(numbered: DataFrame, hits: DataFrame) -> DataFrame:
    """Ranges and items of one document over all blocks. Each list is bounded by its text."""

    merged = hits.groupBy("row_no").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("ranges"))).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    n_hit = F.expr(
        "aggregate(ranges, struct(0L as total, 0L as reach), (acc, r) -> struct("
        "acc.total + greatest(0L, r.b - greatest(r.a, acc.reach)) as total, greatest(acc.reach, r.b) as reach)).total"
    )
    return numbered.select("doc_id", "row_no").join(merged, "row_no").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without any hit, all columns as they are."""

    blocks = _blocks(benchmark, "item_id", "text", BLOCK_WORDS)
    place = docs.columns.index("text")
    for block in blocks:
        patterns = build_patterns(block, window)

        def work(batches, patterns=patterns):
            for batch, _, ranges, _ in _scan(batches, patterns, place, Hasher()):
                yield batch.filter(pa.array([r not in ranges for r in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(work, docs.schema)
    return docs
