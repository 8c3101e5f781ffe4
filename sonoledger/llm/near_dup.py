"""Near-duplicate groups by ProbMinHash, banding and verification.

Weighted shingles of five words (weight: occurrences in the text) send Poisson arrivals to
the signature's places; a place keeps the element that arrives first. An element whose
next arrival is later than the latest place so far is done, which ends nearly all of them
after one or two arrivals. Two signatures agree in a place with the probability Jaccard
similarity of the texts. 25 bands of five places propose candidates, and the similarity of
0.8 is checked exactly on the shingles.

Equal texts are one node from the start. Nodes that share bands form clusters (components
of star edges to the smallest node of each bucket, never all pairs). A cluster's texts meet
in one task only while it has at most ``UNIT`` nodes. A larger one is first linked along
its stars; what is then outside its largest group is compared with everything in the
cluster, block against block. No candidate pair between different groups is left out.

Cases: a null text is a class of its own and stays; a text without words equals only equal
texts; a text of one to four words is one shingle; repeated rows and ids are copies if
their texts are equal; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoledger.llm._components import components
from sonoledger.llm._words import Hasher, Words, mix, slices, words_of
from sonoledger.session import materialise

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5  # at 0.8 a pair is missed by all bands once in 20,000
PLACES = BANDS * ROWS
UNIT = 512  # texts that meet in one task


def shingles(words: Words, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, weight), ordered by row and shingle."""

    n = np.bincount(words.doc, minlength=rows)
    first = np.cumsum(n) - n
    begins = np.maximum(n - SHINGLE + 1, (n > 0).astype(int))
    row = np.repeat(np.arange(rows), begins)
    at = np.arange(len(row)) - np.repeat(np.cumsum(begins) - begins, begins) + first[row]
    stop = first[row] + n[row]
    out = np.zeros(len(row), np.uint64)
    for k in range(SHINGLE):
        inside = at + k < stop
        word = np.where(inside, words.hash[np.minimum(at + k, max(len(words.hash) - 1, 0))], np.uint64(0))
        out = out * np.uint64(0xD6E8FEB86659FD93) + word
    out = mix(out)
    order = np.lexsort((out, row))
    row, out = row[order], out[order]
    new = np.append(True, (row[1:] != row[:-1]) | (out[1:] != out[:-1]))[: len(row)]
    places = np.flatnonzero(new)
    return row[places], out[places], np.diff(np.append(places, len(row)))


def prob_min_hash(row: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int, places: int = PLACES) -> np.ndarray:
    """(rows, places) signatures; rows without elements hold zeros."""

    first = np.full(rows * places, np.inf)
    kept = np.zeros(rows * places, np.uint64)
    time, rate = np.zeros(len(row)), 1.0 / weight
    step = 0
    while len(row):
        step += 1
        draw = mix(element + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64))
        uniform = ((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
        time = time - np.log(uniform) * rate
        place = row * places + (mix(draw) % np.uint64(places)).astype(np.int64)
        np.minimum.at(first, place, time)
        won = first[place] == time
        kept[place[won]] = element[won]
        latest = first.reshape(rows, places).max(axis=1)
        going = time < latest[row]
        row, element, time, rate = row[going], element[going], time[going], rate[going]
    return kept.reshape(rows, places)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(rows, BANDS) keys as signed 64-bit numbers; the band is part of the key."""

    parts = signatures.reshape(len(signatures), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(ROWS):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, k])
    return keys.view(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact similarity of two texts given as (sorted shingles, weights)."""

    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    if a[1].max() == 1 and b[1].max() == 1:
        return len(common) / (len(a[0]) + len(b[0]) - len(common))
    only_a, only_b = np.ones(len(a[0]), bool), np.ones(len(b[0]), bool)
    only_a[i] = only_b[j] = False
    x, y = a[1][i].astype(float), b[1][j].astype(float)
    ratio = x / y
    order = np.argsort(-ratio, kind="stable")
    sorted_ratio = -ratio[order]
    upto = np.searchsorted(sorted_ratio, sorted_ratio, side="right")  # as large a ratio or larger
    above = np.concatenate([[0.0], np.cumsum(x[order])])[upto] + a[1][only_a].sum()
    below = y.sum() - np.concatenate([[0.0], np.cumsum(y[order])])[upto] + b[1][only_b].sum()
    return float((1.0 / (above / x[order] + below / y[order])).sum())


def _shingles_of(texts: pa.Array, hasher: Hasher) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for _, data, offsets in slices(texts, most_rows=8192):
        rows = len(offsets) - 1
        row, element, weight = shingles(words_of(data, offsets, hasher), rows)
        bounds = np.searchsorted(row, np.arange(rows + 1))
        out += [(element[a:b], weight[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    return out


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, key, bands): the text's digest and band keys. Null texts are left out."""

    held = docs.filter(F.col("text").isNotNull()).select("doc_id", _text_key(F.col("text")).alias("key"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            lists: list = []
            for _, data, offsets in slices(batch.column(2), most_rows=8192):
                rows = len(offsets) - 1
                row, element, weight = shingles(words_of(data, offsets, hasher), rows)
                keys = band_keys(prob_min_hash(row, element, weight, rows))
                filled = np.bincount(row, minlength=rows) > 0
                lists += [k if f else [] for k, f in zip(keys, filled)]
            bands = pa.array(lists, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), bands], names=["doc_id", "key", "bands"])

    return held.mapInArrow(work, "doc_id long, key binary, bands array<long>")


class _Groups:
    """Union-find over positions."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)


def _unit_links(unit: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links that join the groups of a unit.

    Compared is every pair that shares a bucket and is in different groups so far; where
    there are two sides, every such pair with one text of each.
    """

    unit = unit.sort_values(["side", "node"], ignore_index=True)
    texts = _shingles_of(pa.array(unit["text"], pa.string()), Hasher())
    groups = _Groups(len(unit))
    firsts: dict[int, int] = {}
    for i, root in enumerate(unit["root"].tolist()):
        groups.join(firsts.setdefault(root, i), i)
    buckets: dict[int, list[int]] = {}
    for i, bands in enumerate(unit["bands"]):
        for key in bands:
            buckets.setdefault(int(key), []).append(i)
    first_side = int((unit["side"] == 0).sum())
    compared, links, nodes = set(), [], unit["node"].tolist()
    for members in buckets.values():
        for at, i in enumerate(members):
            if i >= first_side:
                break
            for j in members[at + 1 :]:
                if first_side < len(nodes) and j < first_side:
                    continue
                if groups.root(i) != groups.root(j) and (i, j) not in compared:
                    compared.add((i, j))
                    if probability_jaccard(texts[i], texts[j]) >= least:
                        groups.join(i, j)
                        links.append((nodes[i], nodes[j]))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _star_links(pairs: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b, text_a, text_b) that are similar enough."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            left, right = _shingles_of(batch.column(2), hasher), _shingles_of(batch.column(3), hasher)
            good = pa.array([probability_jaccard(x, y) >= least for x, y in zip(left, right)], pa.bool_())
            yield batch.select(["a", "b"]).filter(good)

    return pairs.mapInArrow(work, "a long, b long")


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, unit: int = UNIT) -> DataFrame:
    """(doc_id, class_id, text_id, class_size, keep) for every document.

    ``class_id`` is the smallest id of the documents linked by similarities of ``least`` or
    more, over any number of steps; ``text_id`` the smallest id with an equal text. ``keep``
    marks one document of each class: the one whose id is ``class_id``.
    """

    return _classes(docs, least, unit).drop("key")


def _classes(docs: DataFrame, least: float, unit: int) -> DataFrame:
    """The columns of :func:`near_duplicates` and the digest of the text."""

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = materialise(signatures(docs), "near-signatures")
    nodes = materialise(
        signed.groupBy("key").agg(F.min("doc_id").alias("text_id"), F.count("*").alias("n"), F.max("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()),
        "near-nodes",
    )
    posted = nodes.select("node", F.explode("bands").alias("band"))
    hubs = posted.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("size")).filter("size > 1")
    stars = materialise(
        posted.join(hubs, "band").filter("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(),
        "near-stars",
    )
    links = _links(docs, nodes, stars, least, unit)
    roots = components(links)
    named = nodes.drop("bands").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per_class = named.groupBy("root").agg(
        F.min("text_id").alias("class_id"), F.sum("n").alias("class_size"), F.min(F.struct("text_id", "node")).alias("best")
    )
    # A node's rows may be very many (a text with a third of all rows): adaptive
    # execution splits that side, the other has one row per distinct text.
    by_text = named.join(per_class, "root").select(
        "key", "class_id", "text_id", "class_size", (F.col("best.node") == F.col("node")).alias("best")
    )
    found = signed.select("doc_id", "key").join(by_text, "key").select(
        "doc_id", "class_id", "text_id", "class_size",
        (F.col("best") & F.col("doc_id").eqNullSafe(F.col("text_id"))).alias("keep"), "key",
    )
    alone = docs.filter(F.col("text").isNull()).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("text_id"),
        F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("keep"), F.lit(None).cast("binary").alias("key"),
    )
    return found.unionByName(alone)


def _links(docs: DataFrame, nodes: DataFrame, stars: DataFrame, least: float, unit: int) -> DataFrame:
    """Verified links (a, b) that connect every group of similar texts."""

    inner = components(stars).withColumnRenamed("root", "cluster")
    members = materialise(inner.unionByName(inner.select(F.col("cluster").alias("node"), "cluster").distinct()), "near-members")
    sized = members.join(members.groupBy("cluster").agg(F.count("*").alias("size")), "cluster")
    # Joined on id and digest, so that the copies of one text are spread over tasks.
    texts = materialise(
        docs.filter(F.col("text").isNotNull()).withColumn("key", _text_key(F.col("text"))).alias("d")
        .join(
            nodes.join(sized, "node").alias("n"),
            (F.col("d.key") == F.col("n.key")) & F.col("d.doc_id").eqNullSafe(F.col("n.text_id")),
        )
        .select("node", "cluster", "size", "bands", "text")
        .dropDuplicates(["node"]),
        "near-texts",
    )
    unit_schema = "a long, b long"
    compare = lambda pdf: _unit_links(pdf, least)
    small = (
        texts.filter(F.col("size") <= unit)
        .select("cluster", "node", "bands", "text", F.lit(0).alias("side"), F.col("node").alias("root"))
        .groupBy("cluster").applyInPandas(compare, unit_schema)
    )
    found = materialise(small, "near-links-small")
    large = texts.filter(F.col("size") > unit)
    if large.isEmpty():
        return found

    pairs = (
        stars.join(large.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .join(large.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    first = materialise(_star_links(pairs, least), "near-links-stars")
    linked = large.join(components(first), "node", "left").withColumn("root", F.coalesce("root", "node"))
    per_root = linked.groupBy("cluster", "root").agg(F.count("*").alias("n"))
    main = per_root.groupBy("cluster").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n_all")
    )
    half = unit // 2
    placed = materialise(
        linked.join(main, "cluster").select(
            "cluster", "node", "bands", "text", "root", (F.col("root") == F.col("main")).alias("in_main"),
            F.ceil(F.col("n_main") / half).cast("int").alias("main_blocks"),
            F.ceil((F.col("n_all") - F.col("n_main")) / half).cast("int").alias("rest_blocks"),
        )
        .withColumn("block", F.pmod(F.xxhash64("node"), F.when(F.col("in_main"), F.col("main_blocks")).otherwise(F.col("rest_blocks"))).cast("int"))
        .filter("rest_blocks > 0"),
        "near-blocks",
    )
    rest, core = placed.filter("not in_main"), placed.filter("in_main")
    held = ["cluster", "node", "bands", "text", "root"]
    # Units are named (kind, i, j): block i outside the main group against block j of the
    # main group, or against block j >= i outside it.
    against_main = [
        rest.select(*held, F.lit(0).alias("side"), F.lit("m").alias("kind"), F.col("block").alias("i"),
                    F.explode(F.sequence(F.lit(0), F.col("main_blocks") - 1)).alias("j")),
        core.select(*held, F.lit(1).alias("side"), F.lit("m").alias("kind"),
                    F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1)).alias("i"), F.col("block").alias("j")),
    ]
    among_rest = rest.select(
        *held, F.lit("r").alias("kind"), "block",
        F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1)).alias("other"),
    ).select(
        *held, (F.col("block") > F.col("other")).cast("int").alias("side"), "kind",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )
    units = against_main[0].unionByName(against_main[1]).unionByName(among_rest)
    second = units.groupBy("cluster", "kind", "i", "j").applyInPandas(compare, unit_schema)
    return found.unionByName(first).unionByName(materialise(second, "near-links-blocks"))


def drop_near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each class, all columns as they are; of rows equal in id and text one."""

    kept = _classes(docs, least, UNIT).filter("keep").select(
        F.col("doc_id").alias("_kept_id"), F.col("key").alias("_kept_key")
    ).distinct()
    keyed = docs.withColumn("_text_key", _text_key(F.col("text")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_kept_id")) & F.col("_text_key").eqNullSafe(F.col("_kept_key"))
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_text_key"]).select(*docs.columns)
