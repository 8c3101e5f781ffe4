"""Vectors compressed to product-quantiser codes, nearest entries found by slices and bit masks.

A component x becomes the integer floor(1024 * x). Vectors are cut into ``PARTS`` equal
consecutive parts; each part position has a codebook of ``ENTRIES`` parts, first those of the
smallest ids, then moved ``ROUNDS`` times to the componentwise floored mean of the parts that
lie nearest (ties to the lower index; unused entries stay). A vector's code is the index of
the nearest entry of each part.

Nearest entries are found exactly by slices and intersections. Each dimension of a codebook
holds its coordinates sorted, with the mask of the entries before every place. A radius selects
a range of each dimension, two lookups give the mask of the entries in it, and the masks of all
dimensions are ANDed in 64-bit words. The radius begins small and doubles for parts that meet no
entry; the nearest of the entries met bounds the distance, and a second selection by that bound
holds every entry that can be as near. Only the entries of the last mask are measured in full.

Vectors never move: a round reads them where they lie, sends ``PARTS * ENTRIES`` sums a task
and takes the new codebooks (a bounded table) to the driver.

Cases: rows whose vector is null or empty or holds null or non-finite components are dropped,
as are vectors whose length is no multiple of ``PARTS`` or differs from that of the smallest id
left (null ids are the largest; of rows with one id the smaller vector comes first). Components
beyond +-2^16 count as that, so all sums fit 64 bits; an error sum that does not is the largest
long. Repeated rows are coded each. With fewer rows than entries the codebooks are as small. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoledger.session import materialise

SCALE = 1024
MOST = 1 << 26  # of an integer component
PARTS, ENTRIES, ROUNDS = 4, 256, 4
ROWS = 512  # parts searched at once; bounds the table of candidates
BIGGEST = (1 << 63) - 1


class Slices:
    """The codebook of one part position, ready for nearest-entry search."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        n, width = entries.shape
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0).T.copy()
        bits = np.zeros((n, -(-n // 64)), np.uint64)
        bits[np.arange(n), np.arange(n) // 64] = np.uint64(1) << (np.arange(n) % 64).astype(np.uint64)
        self.before = np.zeros((width, n + 1, bits.shape[1]), np.uint64)
        for d in range(width):
            np.bitwise_or.accumulate(bits[order[:, d]], axis=0, out=self.before[d, 1:])
        self.first_radius = self._typical_gap()

    def _typical_gap(self) -> int:
        """Half the entries have another one within this of every coordinate."""

        n = len(self.entries)
        if n < 2:
            return 1
        gap = np.full(n, BIGGEST)
        for i in range(n):
            far = np.abs(self.entries - self.entries[i]).max(axis=1)
            far[i] = BIGGEST
            gap[i] = far.min()
        return max(1, int(np.median(gap)))

    def masks(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Entries whose every coordinate lies within the radius of the part's."""

        out = None
        for d, coordinates in enumerate(self.sorted):
            low = np.searchsorted(coordinates, parts[:, d] - radius, side="left")
            high = np.searchsorted(coordinates, parts[:, d] + radius, side="right")
            inside = self.before[d][high] ^ self.before[d][low]
            out = inside if out is None else out & inside
        return out

    def _measured(self, parts: np.ndarray, masks: np.ndarray, bound: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of the nearest entry of each mask; masks hold one at least."""

        n = len(self.entries)
        held = np.unpackbits(np.ascontiguousarray(masks).view(np.uint8), axis=1, count=n, bitorder="little")
        row, entry = np.nonzero(held)
        half = max(1, parts.shape[1] // 2)
        gap = parts[row, :half] - self.entries[entry, :half]
        far = np.einsum("ij,ij->i", gap, gap)
        if bound is not None:  # half the way may be too far already
            near = far <= bound[row]
            row, entry, far = row[near], entry[near], far[near]
        gap = parts[row, half:] - self.entries[entry, half:]
        far = far + np.einsum("ij,ij->i", gap, gap)
        start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        least = np.minimum.reduceat(far, start)
        hit = np.flatnonzero(far == np.repeat(least, np.diff(np.r_[start, len(row)])))
        _, first = np.unique(row[hit], return_index=True)  # entries ascend, so the lower index wins
        return entry[hit[first]], least

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of every part."""

        index, distance = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        for at in range(0, len(parts), ROWS):
            x = parts[at : at + ROWS]
            radius = np.full(len(x), self.first_radius, np.int64)
            masks = self.masks(x, radius)
            while len(empty := np.flatnonzero(~masks.any(axis=1))):
                radius[empty] *= 2
                masks[empty] = self.masks(x[empty], radius[empty])
            best, least = self._measured(x, masks, None)
            # An entry as near as ``least`` is within its root on every coordinate.
            root = np.ceil(np.sqrt(least.astype(float))).astype(np.int64)
            wide = np.flatnonzero(root > radius)
            if len(wide):
                best[wide], least[wide] = self._measured(x[wide], self.masks(x[wide], root[wide]), least[wide])
            index[at : at + ROWS], distance[at : at + ROWS] = best, least
        return index, distance


def integers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(np.asarray(values, float) * SCALE), -MOST, MOST).astype(np.int64)


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, vector) of the rows that can be coded, whatever their length."""

    v = F.col(vector_col)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vectors.filter(v.isNotNull() & (F.size(v) > 0) & (F.size(v) % PARTS == 0) & ~F.exists(v, bad)).select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), v.cast("array<double>").alias("vector")
    )


def _parts(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """(rows, parts, part width) of a batch, as integers."""

    column = batch.column(batch.schema.get_field_index("vector"))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return integers(flat).reshape(len(column), PARTS, width)


def _moved(held: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""

    parts, entries, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Slices(book) for book in books]
        sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            x = _parts(batch, width)
            for p in range(parts):
                index, _ = search[p].nearest(x[:, p])
                np.add.at(sums[p], index, x[:, p])
                counts[p] += np.bincount(index, minlength=entries)
        used = np.flatnonzero(np.repeat(counts.reshape(-1), width))
        yield pa.RecordBatch.from_pydict({
            "slot": pa.array(used.astype(np.int32)), "total": sums.reshape(-1)[used],
            "n": np.repeat(counts.reshape(-1), width)[used],
        })

    summed = (
        held.select("vector").mapInArrow(work, "slot int, total long, n long")
        .groupBy("slot").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .collect()  # parts x entries x width numbers, the size of the codebooks
    )
    out = books.reshape(-1).copy()
    for slot, total, n in summed:
        out[slot] = total // n
    return out.reshape(books.shape)


def train_codebooks(held: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (part, entry, component) of :func:`kept_vectors` rows; None for an empty table."""

    order = [F.col("vec_id").asc_nulls_last(), "vector"]
    first = held.orderBy(*order).select(F.size("vector")).first()
    if first is None:
        return None
    alike = held.filter(F.size("vector") == first[0])
    seed = alike.orderBy(*order).limit(entries).select("vector").collect()
    width = first[0] // PARTS
    books = integers(np.array([v for (v,) in seed])).reshape(len(seed), PARTS, width).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = _moved(alike, books)
    return books


def encode_vectors(held: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) under given codebooks."""

    parts, _, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Slices(book) for book in books]
        for batch in batches:
            x = _parts(batch, width)
            found = [search[p].nearest(x[:, p]) for p in range(parts)]
            names = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            codes = [row.tobytes().hex() for row in names]
            error = sum(distance for _, distance in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(error, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    kinds = dict(held.dtypes)
    return held.filter(F.size("vector") == parts * width).mapInArrow(
        work, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    )


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256), codebooks trained on the table itself."""

    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: entries must be 1 to 256")
    held = kept_vectors(vectors, id_col, vector_col, label_col)
    books = train_codebooks(held, entries, rounds)
    if books is None:
        books, held = np.zeros((PARTS, 1, 1), np.int64), held.limit(0)
    coded = materialise(encode_vectors(held, books), "vector-codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(
        F.coalesce(F.try_sum("error"), F.lit(BIGGEST)).alias("label_error")
    )
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )
