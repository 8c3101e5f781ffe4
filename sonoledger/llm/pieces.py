"""SentencePiece encoding and decoding with a table of distinct chunks.

No piece of the model has a white-space marker after another character, so merges
never cross the start of a run of markers: a text falls into chunks (markers, then
other characters) that are segmented independently. Each task keeps a table of the
distinct chunks it met; the library segments a chunk once, and the ids of a text are
joined from the table by position. A table of ``TABLE_BYTES`` is begun anew and no chunk
above ``LONG_CHUNK`` characters is kept, so memory is bounded by the table, a slice of
texts and the longest text. A model with pieces across markers is refused.

Cases: null and empty texts have no ids and decode to the empty text; a text without
white space is one chunk and goes to the library as it is.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructType

MARK = "▁"
TABLE_BYTES = 64 << 20
ENTRY_BYTES = 120  # of a chunk besides its text: its place in the table, its row and offset
LONG_CHUNK = 200
SLICE_CHARS = 1 << 20


def crossing_pieces(model: str) -> list[str]:
    """Pieces that hold a marker after another character; the method needs none."""

    import sentencepiece

    return _crossing(sentencepiece.SentencePieceProcessor(model_file=model))


def _crossing(held) -> list[str]:
    return [p for p in map(held.id_to_piece, range(held.get_piece_size())) if re.search(f"[^{MARK}]{MARK}", p)]


class _Rows(dict):
    """Chunk to row of the table; a new chunk gets the next row and waits to be segmented.
    A long one gets a row too, but no entry."""

    def __init__(self) -> None:
        super().__init__()
        self.waiting: list[str] = []
        self.rows = 0
        self.bytes = 0

    def __missing__(self, chunk: str) -> int:
        row = self.rows
        self.rows += 1
        self.waiting.append(chunk)
        if len(chunk) <= LONG_CHUNK:
            self[chunk] = row
            self.bytes += sys.getsizeof(chunk) + ENTRY_BYTES
        return row


class _Array:
    """An array that grows at its end, by doubling."""

    def __init__(self, kind: type) -> None:
        self.held, self.used = np.zeros(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        need = self.used + len(values)
        if need > len(self.held):
            grown = np.zeros(max(need, 2 * len(self.held)), self.held.dtype)
            grown[: self.used] = self.held[: self.used]
            self.held = grown
        self.held[self.used : need] = values
        self.used = need


def _chunks(text: str) -> list[str]:
    """Chunks without the first marker of each: the library puts that one in front."""

    if f"{MARK}{MARK}" in (marked := MARK + text.replace(" ", MARK)):
        return [c[1:] for c in re.findall(f"{MARK}+[^{MARK}]*", marked)]
    return marked[1:].split(MARK)


def _gather(flat: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin ``at``, one after the other."""

    ends = np.cumsum(lengths)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(at - (ends - lengths), lengths)]


class ChunkEncoder:
    """Exact encoder of one task. The model must add a dummy prefix and keep white space."""

    def __init__(self, model: str, table_bytes: int = TABLE_BYTES) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        if crossing := _crossing(self.model):
            raise ValueError(f"pieces with a marker after another character: {crossing[:5]}")
        self.most = table_bytes
        self._begin()

    def _begin(self) -> None:
        self.rows = _Rows()
        self.ids, self.at = _Array(np.int32), _Array(np.int64)
        self.at.add(np.zeros(1, np.int64))

    def held_bytes(self) -> int:
        return self.rows.bytes + self.ids.held.nbytes + self.at.held.nbytes

    def _segment(self) -> None:
        waiting, self.rows.waiting = self.rows.waiting, []
        if not waiting:
            return
        lists = self.model.encode(waiting, num_threads=1)
        if "" in waiting:
            lists[waiting.index("")] = [self.model.piece_to_id(MARK)]
        ends = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
        fresh = np.fromiter(chain.from_iterable(lists), np.int32, int(ends[-1]))
        self.at.add(self.ids.used + ends)
        self.ids.add(fresh)

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; give texts of about ``SLICE_CHARS`` characters at a time."""

        if self.held_bytes() > self.most:
            self._begin()
        found = [np.array(list(map(self.rows.__getitem__, _chunks(t))) if t else [], np.int64) for t in texts]
        self._segment()
        rows = np.concatenate([*found, np.zeros(0, np.int64)])
        at = self.at.held
        lengths = at[rows + 1] - at[rows]
        every = _gather(self.ids.held, at[rows], lengths)
        bounds = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *map(len, found)])]
        return [every[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids) if ids else ""


class _Decimals:
    """Ids as decimal numbers joined by commas."""

    def __init__(self, size: int) -> None:
        names = [b"%d," % i for i in range(size)]
        self.flat = np.frombuffer(b"".join(names), np.uint8)
        self.lengths = np.array([len(n) for n in names])
        self.at = np.cumsum(self.lengths) - self.lengths

    def join(self, ids: np.ndarray) -> bytes:
        return _gather(self.flat, self.at[ids], self.lengths[ids]).tobytes()[:-1]


def encode_texts(
    docs: DataFrame, model: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), ids: bool = False
) -> DataFrame:
    """``keep`` plus n_tokens, ids_sha256, decoded_sha256 (and the ids, where asked for)."""

    kept = docs.select(*keep, text_col)
    schema = StructType([f for f in kept.schema.fields if f.name in keep])
    for name, kind in (("n_tokens", LongType()), ("ids_sha256", StringType()), ("decoded_sha256", StringType())):
        schema = schema.add(name, kind)
    if ids:
        schema = schema.add("token_ids", "array<int>")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(model)
        decimals = _Decimals(encoder.model.get_piece_size())
        for batch in batches:
            counts, digests, decoded, lists = [], [], [], []
            for texts in _slices(batch.column(len(keep))):
                for found in encoder.encode_many(texts):
                    counts.append(len(found))
                    digests.append(hashlib.sha256(decimals.join(found)).hexdigest())
                    decoded.append(hashlib.sha256(encoder.decode(found.tolist()).encode()).hexdigest())
                    if ids:
                        lists.append(found)
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            if ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.mapInArrow(work, schema)


def _slices(column: pa.Array) -> Iterator[list[str]]:
    texts, size = [], 0
    for value in column:
        text = value.as_py() or ""
        texts.append(text)
        size += len(text)
        if size >= SLICE_CHARS:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts
