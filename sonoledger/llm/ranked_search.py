"""Ranked lexical search with a K2-treap over the term-document grid.

Documents are cut into blocks. The grid of a block has a row for each of its terms and a column
for each of its documents; a point holds the impact of the term in the document,
``(10^9 tf) div (1000 tf + 8 m)``. The grid is kept as a quadtree of square cells: of each cell
that holds a point the four bits of its children and the largest impact inside are stored, level
by level; empty cells are not. Rows are ordered by their number of documents, so that rare terms
share cells, which stay small and mostly empty.

A query follows the path of each of its terms down the tree, jointly over ranges of documents.
The sum of weight times cell maximum over its terms bounds the score of every document of a
range. The ranges with the highest bounds are opened first, some at a time, until no open range
can reach the k best found; a range of one document has its exact score. Columns of a block are
ordered by id, so of equal scores the leftmost wins: a range whose bound equals the k-th score is
opened only if it lies left of the k-th document, which keeps large groups of copies closed.

Terms are maximal runs of characters other than ASCII controls, blanks and signs, only A-Z
lower-cased. They are told apart by 64-bit hashes. The score of a document sums
``w * impact`` over the query's distinct terms, with ``w = floor(1000 ln((2N + 2) / (2df + 1)))``,
``m = 10 + (90 n N) div L``, N the documents with a term, L all their terms, n the document's.

Two passes over the texts. Up to ``SENT_PAIRS`` query terms go to all tasks: the first pass counts N, L
and the documents of each term, in the second a task makes one block after the other and searches it
at once, so that no more than a block is held and the JVM moves texts only. More query terms meet a
written index: the first pass counts N and L, the second writes a row per block with its arrays
compressed, a row group each, as rows are megabytes and readers and writers hold row groups whole.
Document frequencies are sums over its blocks; queries are cut into groups by their number and joined
with the blocks by group and lane. Each meeting gives k documents a query at most.

Cases: null and empty texts have no terms and are never found; queries without terms find
nothing; repeated rows of documents or queries count and are ranked each; ids may be null (a null
document id is ranked last among equals); columns beyond id and text are not read; empty tables
give no rows. A block holds whole documents, a single long one if need be.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonoledger.llm._words import Hasher, slices, words_of
from sonoledger.session import materialise

BEST = 10
BLOCK_BYTES, BLOCK_ROWS = 2 << 20, 1024  # of a block's texts, but for a single longer one
GROUP_ITEMS = 512  # queries that are searched together
WAVE = 16  # ranges of a query opened at once
TOGETHER = 32  # queries whose ranges are open at once in a task
SENT_PAIRS = 200_000  # (query, term) pairs, counted first, that are sent to all tasks: some 5 MB
# A writer or reader of the index holds one block, whatever a task holds; its arrays are compressed already.
INDEX_FILES = {"parquet.block.row.count.limit": "1", "parquet.enable.dictionary": "false"}

INDEX_SCHEMA = (
    "block long, ids array<long>, terms binary, row_of binary, doc_counts binary,"
    " masks binary, maxima binary, levels array<int>"
)
FOUND_SCHEMA = "query long, doc_id long, score long"


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(N, L): documents with at least one term, all their terms."""

    return corpus_counts(docs, np.zeros(0, np.uint64), text_col)[:2]


def corpus_counts(docs: DataFrame, known: np.ndarray, text_col: str = "text") -> tuple[int, int, np.ndarray]:
    """(N, L, documents that hold each of the terms ``known``, which are sorted and distinct)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sums = Hasher(), np.zeros(len(known) + 2, np.int64)
        for batch in batches:
            for _, data, offsets in slices(batch.column(0)):
                words, rows = words_of(data, offsets, hasher), len(offsets) - 1
                n = np.bincount(words.doc, minlength=rows)
                sums[-2:] += (n > 0).sum(), n.sum()
                if len(known):
                    place = np.minimum(np.searchsorted(known, words.hash), len(known) - 1)
                    asked = known[place] == words.hash
                    held = np.unique(place[asked] * rows + words.doc[asked]) // rows
                    sums[:-2] += np.bincount(held, minlength=len(known))
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"place": some, "n": sums[some]})

    counted = docs.select(F.col(text_col)).mapInArrow(work, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    counted, sums = counted.toArrow(), np.zeros(len(known) + 2, np.int64)
    sums[counted["place"].to_numpy()] = counted["n"].to_numpy()
    return int(sums[-2]), int(sums[-1]), sums[:-2]


def _postings(column: pa.Array, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms of each row, then by posting: row, term hash, occurrences)."""

    lengths, rows, hashes, counts = [], [], [], []
    for first, data, offsets in slices(column):
        words = words_of(data, offsets, hasher)
        lengths.append(np.bincount(words.doc, minlength=len(offsets) - 1))
        order = np.lexsort((words.hash, words.doc))
        doc, term = words.doc[order], words.hash[order]
        new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])][: len(doc)])
        rows.append(doc[new] + first)
        hashes.append(term[new])
        counts.append(np.diff(np.r_[new, len(doc)]))
    if not lengths:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), none
    return np.concatenate(lengths), np.concatenate(rows), np.concatenate(hashes), np.concatenate(counts)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _packed(numbers: np.ndarray) -> bytes:
    raw = numbers.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(packed: bytes, kind) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    return np.frombuffer(pa.decompress(packed[8:], decompressed_size=size, codec="zstd"), kind)


class Treap:
    """A K2-treap (K = 2): levels from the root, cells of a level in Morton order."""

    def __init__(self, masks: np.ndarray, maxima: np.ndarray, levels: np.ndarray) -> None:
        """``levels``: cells of each level. Cells of single points have no mask."""

        self.maxima = maxima
        self.height = len(levels) - 1
        inner = len(maxima) - (int(levels[-1]) if len(levels) else 0)
        self.masks = np.zeros(len(maxima), np.uint8)
        self.masks[:inner] = masks
        children = np.bitwise_count(self.masks[:inner]).astype(np.int64)
        # The children of all cells follow the root in one run, level after level.
        self.first = np.zeros(len(maxima), np.int64)
        self.first[:inner] = 1 + np.cumsum(children) - children

    @staticmethod
    def build(row: np.ndarray, column: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(masks, maxima, cells of each level) of distinct points, one at least."""

        height = max(1, int(max(row.max(), column.max())).bit_length())
        key = _spread(row) << np.uint64(1) | _spread(column)
        order = np.argsort(key)
        key, largest = key[order], value[order].astype(np.uint32)
        masks, maxima = [], [largest]
        for _ in range(height):
            parent = key >> np.uint64(2)
            start = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
            bit = np.left_shift(np.uint8(1), (key & np.uint64(3)).astype(np.uint8))
            masks.append(np.bitwise_or.reduceat(bit, start))
            largest = np.maximum.reduceat(largest, start)
            maxima.append(largest)
            key = parent[start]
        levels = np.array([len(m) for m in maxima[::-1]], np.int32)
        return np.concatenate(masks[::-1]), np.concatenate(maxima[::-1]), levels

    def child(self, cell: np.ndarray, quarter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(is there one, its number) of the child in a quarter (0 to 3) of each cell."""

        mask = self.masks[cell]
        there = (mask >> quarter) & 1 == 1
        before = mask & ((np.uint8(1) << quarter) - np.uint8(1))
        return there, self.first[cell] + np.bitwise_count(before)


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers at every second place."""

    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


def _block(ids: pa.Array, texts: pa.Array, found: int, terms: int, hasher: Hasher) -> dict | None:
    """Ids and arrays of some documents; None if they have no terms."""

    order = pc.sort_indices(ids, null_placement="at_end")
    ids, texts = ids.take(order), texts.take(order)
    lengths, row, term, tf = _postings(texts, hasher)
    if not len(row):
        return None
    m = np.array([10 + 90 * n * found // terms for n in lengths.tolist()], np.int64)  # exact at any size
    known, place, held = np.unique(term, return_inverse=True, return_counts=True)
    rank = np.empty(len(known), np.int64)
    rank[np.argsort(held, kind="stable")] = np.arange(len(known))
    masks, maxima, levels = Treap.build(rank[place], row, impacts(tf.astype(np.int64), m[row]))
    return {
        "ids": ids.to_pylist(), "terms": known, "row_of": rank.astype(np.int32), "doc_counts": held.astype(np.int32),
        "masks": masks, "maxima": maxima, "levels": levels,
    }


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: tuple[int, int] | None = None,
) -> DataFrame:
    """One row per block of documents: ids, terms and their rows, the quadtree's levels. Written to the shared folder."""

    found, terms = size or corpus_size(docs, text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for ids, texts in _gathered(batches):
            made = _block(ids, texts, found, terms, hasher)
            if made:
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([0], pa.int64()), "ids": pa.array([made["ids"]], pa.list_(pa.int64())),
                    **{k: pa.array([_packed(made[k])], pa.binary()) for k in ("terms", "row_of", "doc_counts", "masks", "maxima")},
                    "levels": pa.array([made["levels"]], pa.list_(pa.int32())),
                })

    blocks = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(work, INDEX_SCHEMA)
    return materialise(
        blocks.withColumn("block", F.monotonically_increasing_id()), "search-index", "uncompressed", INDEX_FILES
    )


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Rows of a task in blocks of about ``BLOCK_BYTES`` of text and ``BLOCK_ROWS`` rows."""

    held: list[pa.RecordBatch] = []
    size = rows = 0

    def flush() -> tuple[pa.Array, pa.Array]:
        ids = pa.concat_arrays([b.column(0) for b in held])
        return ids, pa.concat_arrays([b.column(1).cast(pa.large_string()) for b in held])

    for batch in batches:
        at = 0
        for row, data, _ in slices(batch.column(1), most_rows=BLOCK_ROWS // 8):
            if row > at:
                held.append(batch.slice(at, row - at))
                rows += row - at
                at = row
                if size >= BLOCK_BYTES or rows >= BLOCK_ROWS:
                    yield flush()
                    held, size, rows = [], 0, 0
            size += len(data)
        if at < batch.num_rows:
            held.append(batch.slice(at))
            rows += batch.num_rows - at
        if held and (size >= BLOCK_BYTES or rows >= BLOCK_ROWS):
            yield flush()
            held, size, rows = [], 0, 0
    if held:
        yield flush()


def query_terms(queries: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(query, item_id, term) of the distinct terms of each row; ``query`` numbers the rows. Written to the shared folder."""

    kind = dict(queries.dtypes)[id_col]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            _, row, term, _ = _postings(batch.column(2), hasher)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(term.view(np.int64))],
                names=["query", "item_id", "term"],
            )

    numbered = queries.select(F.monotonically_increasing_id().alias("query"), F.col(id_col).alias("item_id"), F.col(text_col))
    return materialise(numbered.mapInArrow(work, f"query long, item_id {kind}, term long"), "search-queries")


def _term_counts(index: DataFrame) -> DataFrame:
    """(term, df) partial counts of each block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_pydict({
                    "term": _unpacked(terms, np.int64), "df": _unpacked(counts, np.int32).astype(np.int64),
                })

    return index.select("terms", "doc_counts").mapInArrow(work, "term long, df long")


def term_weights(index: DataFrame, asked: DataFrame, found: int) -> DataFrame:
    """(term, w) of the terms of ``asked`` that some document holds."""

    df = _term_counts(index).join(asked.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"term": batch["term"], "w": _weights(batch["df"].to_numpy(), found)})

    return df.mapInPandas(work, "term long, w long")


def _weights(df: np.ndarray, found: int) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * found + 2.0) / (2.0 * df + 1.0))).astype(np.int64)


class Search:
    """Best-first search of one block for some queries at once."""

    def __init__(self, block: dict) -> None:
        """``block``: of :func:`_block`, or with its arrays packed, as a row of the index."""

        def array(name: str, kind) -> np.ndarray:
            held = block[name]
            return held if isinstance(held, np.ndarray) else _unpacked(held, kind)

        self.terms, self.row_of = array("terms", np.uint64), array("row_of", np.int32)
        self.treap = Treap(array("masks", np.uint8), array("maxima", np.uint32), np.asarray(block["levels"]))
        self.null_id = np.array([i is None for i in block["ids"]], bool)
        self.ids = np.array([i or 0 for i in block["ids"]], np.int64)

    def best(self, query: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int, wave: int = WAVE) -> tuple:
        """(query, column, score) of the ``k`` best columns of each query, of equal scores the leftmost.

        ``query``: a number from 0 for each (query, term) pair.
        """

        place = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        known = (self.terms[place] == term) & (weight > 0)
        query, weight, row = query[known], weight[known], self.row_of[place[known]]
        self.opened = 0
        if not len(query):
            none = np.zeros(0, np.int64)
            return none, none, none
        n_queries = int(query.max()) + 1
        # Score and column of the k-th best of each query so far: what lies behind it stays closed.
        top, edge = np.zeros(n_queries, np.int64), np.full(n_queries, np.iinfo(np.int64).max)
        # Open ranges, and for each the terms that have a cell in it.
        owner, level, start = np.unique(query), None, None
        pair_of = np.searchsorted(owner, query)
        open_ = {
            "query": owner, "level": np.full(len(owner), self.treap.height), "at": np.zeros(len(owner), np.int64),
        }
        pairs = {"range": pair_of, "row": row.astype(np.int64), "w": weight, "cell": np.zeros(len(row), np.int64)}
        open_["bound"] = self._bounds(pairs, len(owner))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(open_["query"]):
            left = open_["at"] << open_["level"]
            chosen = _first_of_each(open_["query"], open_["bound"], left, wave)
            self.opened += int(chosen.sum())
            rest, rest_pairs = _keep(open_, pairs, ~chosen)
            now, now_pairs = _keep(open_, pairs, chosen)
            fresh, fresh_pairs = self._split(now, now_pairs)
            scored = fresh["level"] == 0
            if scored.any():
                done.append((fresh["query"][scored], fresh["at"][scored], fresh["bound"][scored]))
                done = [_best_rows(*(np.concatenate(x) for x in zip(*done)), k)]
                self._raise(top, edge, done[0], k)
                fresh, fresh_pairs = _keep(fresh, fresh_pairs, ~scored)
            open_ = {c: np.concatenate([rest[c], fresh[c]]) for c in rest}
            fresh_pairs["range"] = fresh_pairs["range"] + len(rest["query"])
            pairs = {c: np.concatenate([rest_pairs[c], fresh_pairs[c]]) for c in rest_pairs}
            q, left = open_["query"], open_["at"] << open_["level"]
            alive = (open_["bound"] > top[q]) | ((open_["bound"] == top[q]) & (left < edge[q]) & (top[q] > 0))
            if not alive.all():
                open_, pairs = _keep(open_, pairs, alive)
        if not done:
            none = np.zeros(0, np.int64)
            return none, none, none
        return done[0]

    def _bounds(self, pairs: dict, n: int) -> np.ndarray:
        """Weight times cell maximum, summed over each range (sums below 2^53 are exact)."""

        value = pairs["w"] * self.treap.maxima[pairs["cell"]].astype(np.int64)
        out = np.zeros(n, np.int64)
        np.add.at(out, pairs["range"], value)
        return out

    def _split(self, now: dict, pairs: dict) -> tuple[dict, dict]:
        """Both halves of each range; those without a cell of any term are empty and go."""

        below = now["level"] - 1
        row_bit = (pairs["row"] >> below[pairs["range"]]) & 1
        halves, half_pairs = [], []
        for column_bit in (0, 1):
            there, cell = self.treap.child(pairs["cell"], (2 * row_bit + column_bit).astype(np.uint8))
            mine = {c: pairs[c][there] for c in pairs}
            mine["cell"] = cell[there]
            half = {"query": now["query"], "level": below, "at": now["at"] * 2 + column_bit}
            half["bound"] = self._bounds(mine, len(below))
            kept, kept_pairs = _keep(half, mine, half["bound"] > 0)
            kept_pairs["range"] = kept_pairs["range"] + sum(len(h["query"]) for h in halves)
            halves.append(kept)
            half_pairs.append(kept_pairs)
        return (
            {c: np.concatenate([h[c] for h in halves]) for c in halves[0]},
            {c: np.concatenate([h[c] for h in half_pairs]) for c in half_pairs[0]},
        )

    def found(self, query: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
        """(query, doc_id, score) of :meth:`best`, for ``TOGETHER`` queries at a time. ``query`` is sorted."""

        number, start = np.unique(query, return_index=True)
        start = np.r_[start, len(query)]
        for first in range(0, len(number), TOGETHER):
            last = min(first + TOGETHER, len(number))
            mine = slice(start[first], start[last])
            local = np.searchsorted(number[first:last], query[mine])
            which, column, score = self.best(local, term[mine], weight[mine], k)
            yield pa.RecordBatch.from_pydict({
                "query": number[which + first], "doc_id": pa.array(self.ids[column], mask=self.null_id[column]), "score": score,
            })

    @staticmethod
    def _raise(top: np.ndarray, edge: np.ndarray, held: tuple, k: int) -> None:
        """``held`` is in order of query and rank."""

        query, column, score = held
        start = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        full = np.diff(np.r_[start, len(query)]) >= k
        last = start[full] + k - 1
        top[query[last]], edge[query[last]] = score[last], column[last]


def _keep(ranges: dict, pairs: dict, kept: np.ndarray) -> tuple[dict, dict]:
    number = np.cumsum(kept) - 1
    mine = kept[pairs["range"]]
    out = {c: pairs[c][mine] for c in pairs}
    out["range"] = number[out["range"]]
    return {c: ranges[c][kept] for c in ranges}, out


def _first_of_each(group: np.ndarray, value: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Marks the ``n`` highest values of every group, of equal ones those with the lowest place."""

    order = np.lexsort((place, -value, group))
    out = np.zeros(len(group), bool)
    out[order[_nth(group[order]) < n]] = True
    return out


def _best_rows(query: np.ndarray, column: np.ndarray, score: np.ndarray, k: int) -> tuple:
    """The ``k`` best rows of each query in order, of equal scores the leftmost."""

    order = np.lexsort((column, -score, query))
    order = order[_nth(query[order]) < k]
    return query[order], column[order], score[order]


def ranked_search(
    docs: DataFrame, queries: DataFrame, k: int = BEST, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", query_text_col: str = "text", sent_pairs: int = SENT_PAIRS,
) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best documents of every query with a score above 0."""

    asked = query_terms(queries, item_col, query_text_col)
    if asked.count() <= sent_pairs:
        return search_blocks(docs, asked, k, id_col, text_col)
    size = corpus_size(docs, text_col)
    return search_index(build_index(docs, id_col, text_col, size), asked, size[0], k, sent_pairs=sent_pairs)


def search_blocks(
    docs: DataFrame, asked: DataFrame, k: int = BEST, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """:func:`ranked_search` for few :func:`query_terms`: blocks are searched by the task that makes them."""

    pairs = asked.select("query", "term").toArrow()
    order = np.argsort(pairs["query"].to_numpy(), kind="stable")
    query, term = pairs["query"].to_numpy()[order], pairs["term"].to_numpy()[order].view(np.uint64)
    known, place = np.unique(term, return_inverse=True)
    found, terms, df = corpus_counts(docs, known, text_col)
    weight = _weights(df, found)[place]
    held = df[place] > 0
    query, term, weight = query[held], term[held], weight[held]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for ids, texts in _gathered(batches):
            made = _block(ids, texts, found, terms, hasher)
            if made:
                yield from Search(made).found(query, term, weight, k)

    return _ranked(docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(work, FOUND_SCHEMA), asked, k)


def search_index(
    index: DataFrame, asked: DataFrame, found: int, k: int = BEST, group_items: int = GROUP_ITEMS, sent_pairs: int = SENT_PAIRS,
) -> DataFrame:
    """:func:`ranked_search` on a written index and :func:`query_terms`; ``found`` is N."""

    spark = index.sparkSession
    weights = term_weights(index, asked, found)
    n_queries, n_pairs = asked.agg(F.count_distinct("query"), F.count("*")).first()
    groups = max(1, -(-n_queries // group_items))
    lanes = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    of_group = F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int").alias("part")
    # About ``group_items`` queries a group; a lane of blocks meets a group under one key.
    told = (
        asked.join(weights, "term").groupBy(of_group)
        .agg(F.collect_list(F.struct("query", "term", "w")).alias("asked"))
    )
    blocks = index.drop("doc_counts").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    if n_pairs <= sent_pairs:
        met = blocks.join(F.broadcast(told), "part")
    else:
        met = blocks.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int")).join(
            told.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))), ["part", "lane"]
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block = {c: batch.column(batch.schema.get_field_index(c))[at].as_py()
                         for c in ("ids", "terms", "row_of", "masks", "maxima", "levels")}
                pairs = batch.column(batch.schema.get_field_index("asked"))[at].values
                query = pairs.field("query").to_numpy()
                order = np.argsort(query, kind="stable")
                term, weight = pairs.field("term").to_numpy().view(np.uint64), pairs.field("w").to_numpy()
                yield from Search(block).found(query[order], term[order], weight[order], k)

    best = met.select("ids", "terms", "row_of", "masks", "maxima", "levels", "asked").mapInArrow(work, FOUND_SCHEMA)
    return _ranked(best, asked, k)


def _ranked(best: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of what the blocks gave, by item."""

    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ranked = best.withColumn("rank", rank).filter(F.col("rank") <= k)
    names = asked.groupBy("query").agg(F.first("item_id").alias("item_id"))
    return ranked.join(names, "query").select("item_id", "rank", "doc_id", "score")


def _nth(group: np.ndarray) -> np.ndarray:
    """Place of each row in its run of equal values."""

    if not len(group):
        return np.zeros(0, np.int64)
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    return np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)]))
