"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

Disguised words are found by their bytes: digits and signs beside letters (leetspeak),
three equal letters in a row, letters with gaps between them: single ones over white space,
any parts of a token over other gap signs. Each such span, however long, is a
lattice: a sign may stand for letters, a repeated letter or a gap may have been put in. A
Viterbi search, which prunes no state, picks the path that a character 4-gram model, counted
over all documents, together with the channel's costs finds likeliest. The restored text is scored by a noisy
or over its words and word beginnings: each learned one makes a text toxic with the share
of toxic texts among the labelled ones that hold it.

Cases: null and empty texts get the score of a text without words; ids that are null are
never learned from and not held out; several labels of one id count as toxic if any is;
labels other than 0 and 1 are left out; without both labels all texts score alike (0.99 if
all labels are toxic, else 0); repeated rows each get a row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from sonoledger.llm._words import Hasher, mix, slices, words_of
from sonoledger.llm.language import held_out

WORD_BITS = 44  # of a word's hash; the rows of a slice fit beside them
MAX_ROWS = 12_000  # labelled texts of each label that the classifier may see
LEAST_TEXTS = 3  # sampled texts a learned feature must be in
PARTS = 16  # of the features, counted one after the other
LEAST_SHARE, LEAST_STEM_SHARE = 0.8, 0.95  # of them that must be toxic, for words and beginnings
STEMS = (4, 5, 6)  # bytes of word beginnings that are features beside the word

# What a sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "abcdefghijklmnopqrstuvwxyz",
}
# Costs of the channel, in nats.
SUBSTITUTED, WILDCARD, REPEATED, DOUBLED, GAP, DROPPED = 0.7, 1.5, 0.3, 6.0, 0.1, 6.0
TABLED_SPAN = 400  # bytes; longer spans are decoded each time, so that the table stays small
WIDE = 1_500  # states times choices beyond which a step is taken in arrays

# Symbols of the character model: 0 edge of a word, 1-26 a-z, 27 any other letter's byte.
_SYMBOLS, _ORDER = 28, 4
_GAP_BYTES = b" .-_*~,/\\"


def _byte_table(pairs: dict[bytes, int]) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for held, value in pairs.items():
        table[list(held)] = value
    return table


_LOWER, _UPPER = bytes(range(97, 123)), bytes(range(65, 91))
_SYMBOL = np.zeros(256, np.int32)
_SYMBOL[list(_LOWER)] = _SYMBOL[list(_UPPER)] = np.arange(1, 27)
_SYMBOL[0x80:] = 27
_LETTER = _SYMBOL > 0
_LEET = _byte_table({"".join(LEET).encode(): 1}).astype(bool)
_FIRM = _byte_table({b"$@0134578": 1}).astype(bool)
_SPACE = _byte_table({b" \t\n\r\x0b\x0c": 1}).astype(bool)
_GAP = _byte_table({_GAP_BYTES: 1}).astype(bool)


def character_counts(texts: DataFrame) -> np.ndarray:
    """Counts of all runs of four symbols in a text column; 28^4 numbers at most."""

    size = _SYMBOLS**_ORDER

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for _, data, offsets in slices(batch.column(0)):
                # An edge before and after each text, and one edge for a run of non-letters.
                s = np.insert(_SYMBOL[data], offsets, 0)
                s = s[np.append(True, (s[1:] > 0) | (s[:-1] > 0))]
                s = np.concatenate([[0, 0], s])
                code = s[3:].copy()
                for back in range(1, _ORDER):
                    code += s[3 - back : len(s) - back] * _SYMBOLS**back
                total += np.bincount(code, minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["code", "n"])

    rows = texts.mapInArrow(work, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, np.int64)
    counts[rows["code"].to_numpy(int)] = rows["n"].to_numpy(int)
    return counts


def character_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a symbol after three others, each order smoothed by the shorter ones."""

    held = counts.reshape((_SYMBOLS,) * _ORDER).astype(float)
    p = (held.sum((0, 1, 2)) + 1.0) / (held.sum() + _SYMBOLS)
    for order in range(2, _ORDER + 1):
        c = held.sum(tuple(range(_ORDER - order)))
        p = (c + 5.0 * p) / (c.sum(-1, keepdims=True) + 5.0)
    return np.log(p).reshape(-1).astype(np.float32)


class Decoder:
    """Viterbi search of one span, with a table of spans already decoded."""

    def __init__(self, model: np.ndarray, table_spans: int = 100_000) -> None:
        self.log_p = model.tolist()
        self.by_symbol = np.ascontiguousarray(model.reshape(-1, _SYMBOLS).T).astype(float)
        self.known: dict[bytes, bytes] = {}
        self.most = table_spans

    def restore(self, span: bytes) -> bytes:
        if len(span) > TABLED_SPAN:
            return self._search(span)
        if span not in self.known:
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[span] = self._search(span)
        return self.known[span]

    def _arcs(self, span: bytes) -> Iterator[list[tuple[int, int, float]]]:
        """For each byte: (symbol, byte written, cost); symbol -1 writes nothing."""

        text = span.lower()
        for at, byte in enumerate(text):
            char, here = chr(byte), []
            again = at > 0 and text[at - 1] == byte
            # Words have double letters; three in a row were put in.
            extra = REPEATED if bytes([byte]) * 3 in text[max(at - 2, 0) : at + 3] else DOUBLED
            if _LETTER[byte]:
                here.append((int(_SYMBOL[byte]), byte, 0.0))
                if again:
                    here.append((-1, 0, extra))
            else:
                if _GAP[byte]:
                    here.append((-1, 0, GAP))
                    here.append((0, 32, 0.0))
                if char in LEET:
                    cost = WILDCARD if char == "*" else SUBSTITUTED
                    here.extend((ord(c) - 96, ord(c), cost) for c in LEET[char])
                    if again:
                        here.append((-1, 0, extra))
                    here.append((-1, 0, DROPPED))
                if not here:
                    here.append((0, byte, 0.0))
            yield here

    def _wide_step(self, cells: dict[int, tuple[float, tuple]], here: list[tuple[int, int, float]]) -> dict:
        """One step of the search over all 28^3 states at once."""

        n = _SYMBOLS
        held = np.full(n**3, np.inf)
        states = np.fromiter(cells, np.int64, len(cells))
        held[states] = [cost for cost, _ in cells.values()]
        best, came, wrote = np.full(n**3, np.inf), np.zeros(n**3, np.int64), np.full(n**3, -1)

        def offer(to: np.ndarray, spent: np.ndarray, source: np.ndarray, byte: int) -> None:
            better = spent < best[to]
            at = to[better]
            best[at], came[at], wrote[at] = spent[better], source[better], byte

        edges, pairs = states[states % n == 0], np.arange(n * n)
        for symbol, byte, price in here:
            if symbol < 0:
                offer(states, held[states] + price, states, -1)
                continue
            spent = (held + price - self.by_symbol[symbol]).reshape(n, n * n)
            if symbol == 0:  # no second edge
                offer(edges, held[edges] + price, edges, -1 if byte == 32 else byte)
                spent[:, ::n] = np.inf
            first = spent.argmin(axis=0)
            offer(pairs * n + symbol, spent[first, pairs], first * n * n + pairs, byte)
        out = {}
        to = np.flatnonzero(best < np.inf)
        for state, cost, source, byte in zip(to.tolist(), best[to].tolist(), came[to].tolist(), wrote[to].tolist()):
            way = cells[source][1]
            out[state] = (cost, way if byte < 0 else (way, byte))
        return out

    def _search(self, span: bytes) -> bytes:
        n, log_p = _SYMBOLS, self.log_p
        cells: dict[int, tuple[float, tuple]] = {0: (0.0, ())}  # last three symbols: cost, path
        out = bytearray()
        for here in self._arcs(span):
            if len(cells) * len(here) > WIDE:
                cells = self._wide_step(cells, here)
                continue
            grown: dict[int, tuple[float, tuple]] = {}
            for state, (cost, path) in cells.items():
                for symbol, byte, price in here:
                    if symbol < 0:
                        to, spent, way = state, cost + price, path
                    elif symbol == 0 and state % n == 0:
                        to, spent, way = state, cost + price, path if byte == 32 else (path, byte)
                    else:
                        spent = cost + price - log_p[state * n + symbol]
                        to, way = (state * n + symbol) % n**3, (path, byte)
                    if to not in grown or spent < grown[to][0]:
                        grown[to] = (spent, way)
            cells = grown
            if len(cells) == 1:  # all paths are one: what it wrote is settled
                [(state, (cost, way))] = cells.items()
                out += _written(way)
                cells = {state: (cost, ())}
        ends = ((cost - (log_p[state * n] if state % n else 0.0), state, way) for state, (cost, way) in cells.items())
        _, _, way = min(ends, key=lambda e: e[:2])
        return bytes(out + _written(way))


def _written(way: tuple) -> bytes:
    out = bytearray()
    while way:
        way, byte = way
        out.append(byte)
    return bytes(reversed(out))


_PLAIN, _THRICE = re.compile(rb"[A-Za-z\x80-\xff]+"), re.compile(rb"(?i)([a-z])\1\1")


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def suspicious_spans(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges of a slice that may hold a disguised word, in order and apart."""

    if not len(data):
        return []
    inside = ~_SPACE[data]
    starts_new = np.zeros(len(data) + 1, bool)
    starts_new[offsets[offsets < len(data)]] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | starts_new[1:-1]
    start = np.flatnonzero(begin)
    if not len(start):
        return []
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | starts_new[1:-1]
    end = np.flatnonzero(stop) + 1
    letter = _LETTER[data] & inside
    token = np.cumsum(begin) - 1

    leet = _LEET[data]
    beside = np.zeros(len(data), bool)
    beside[:-1] |= leet[:-1] & letter[1:] & (token[:-1] == token[1:])
    # After a letter, a digit, $ or @ counts anywhere, another sign only before a letter:
    # at a word's end it is punctuation.
    firm = _FIRM[data]
    firm[:-1] |= letter[1:] & (token[:-1] == token[1:])
    beside[1:] |= leet[1:] & letter[:-1] & (token[:-1] == token[1:]) & firm[1:]
    low = np.where(letter, data | 0x20, 0)
    same = (low[1:] == low[:-1]) & letter[1:] & (data[1:] < 0x80) & (token[1:] == token[:-1])
    triple = np.zeros(len(data), bool)
    triple[:-2] = same[:-1] & same[1:]
    # Letters that stand alone between gaps, inside one token: i.d.i.o.t
    gap = _GAP[data] & inside
    alone = np.zeros(len(data), bool)
    alone[1:-1] = letter[1:-1] & gap[:-2] & gap[2:] & (token[1:-1] == token[:-2]) & (token[1:-1] == token[2:])
    flag = np.zeros(len(start), bool)
    flag[token[(beside | triple) & inside]] = True
    flag |= np.bincount(token[alone & inside], minlength=len(start)) >= 2
    # Parts of a token with gaps between them: mo-ron
    held = np.flatnonzero(inside & ~gap)
    before, behind = held[:-1], held[1:]
    parted = (behind - before > 1) & (token[before] == token[behind]) & letter[before] & letter[behind]
    flag[token[behind[parted]]] = True
    has_letter = np.zeros(len(start), bool)
    has_letter[token[letter]] = True
    flag &= has_letter

    # Tokens of one letter or sign each, one after the other: i d i o t. A letter is among
    # them, or they are four at least.
    single = (end - start == 1) & (letter[start] | leet[start])
    first, after = _runs(single)
    spans = [(int(start[k]), int(end[k])) for k in np.flatnonzero(flag & ~single)]
    doc = np.searchsorted(offsets, start, side="right")
    for a, b in zip(first, after):
        # A run may not go on over the edge of a text.
        cuts = [a, *(a + 1 + np.flatnonzero(np.diff(doc[a:b]))), b]
        spans += [(int(start[i]), int(end[j - 1])) for i, j in zip(cuts[:-1], cuts[1:]) if j - i >= (2 if letter[start[i:j]].any() else 4)]
    return sorted(spans)


def restore_slice(
    data: np.ndarray, offsets: np.ndarray, decoder: Decoder
) -> tuple[np.ndarray, np.ndarray, list[tuple[int, bytes, bytes]]]:
    """The slice with its spans restored, its offsets, and (row, span, restored) of each change."""

    pieces, at, moved, changes = [], 0, [], []
    held = data.tobytes()
    for a, b in suspicious_spans(data, offsets):
        core = held[a:b]
        left = len(core) - len(core.lstrip(b"\"'([{<.,;:?-_*~&%#"))
        right = len(core.rstrip(b"\"')]}>.,;:?!-_*~&%#"))
        tail = core[left:right]
        if tail.endswith((b"$$$", b"@@@")):  # three signs are decoration
            tail = tail.rstrip(b"$@")
        if not _PLAIN.sub(b"", tail) and not _THRICE.search(tail):
            continue
        a, b = a + left, a + left + len(tail)
        new = decoder.restore(tail)
        if new != tail.lower():
            pieces += [held[at:a], new]
            at = b
            moved.append((b, len(new) - (b - a)))
            changes.append((int(np.searchsorted(offsets, a, side="right")) - 1, tail, new))
    if not pieces:
        return data, offsets, []
    pieces.append(held[at:])
    places = np.array([m[0] for m in moved])
    shift = np.concatenate([[0], np.cumsum([m[1] for m in moved])])
    return np.frombuffer(b"".join(pieces), np.uint8), offsets + shift[np.searchsorted(places, offsets, side="right")], changes


def _word_features(column, decoder: Decoder, hasher: Hasher) -> Iterator[tuple]:
    """(first row, rows, row of each feature, feature, words) of restored texts, by slices.

    Features are the distinct words of a text and their first bytes.
    """

    bits = np.uint64(WORD_BITS)
    for first, data, offsets in slices(column):
        data, offsets, _ = restore_slice(data, offsets, decoder)
        words = words_of(data, offsets, hasher)
        # The last bit of a feature tells word beginnings from words.
        hashes, docs = [words.hash >> (np.uint64(64) - bits) & ~np.uint64(1)], [words.doc]
        for stem in STEMS:
            longer = np.flatnonzero(words.end - words.start > stem)
            start = words.start[longer]
            stems = mix(hasher.ranges(words.low, start, start + stem) + np.uint64(stem))
            hashes.append(stems >> (np.uint64(64) - bits) | np.uint64(1))
            docs.append(words.doc[longer])
        keys = np.unique((np.concatenate(docs).astype(np.uint64) << bits) | np.concatenate(hashes))
        feature = keys & ((np.uint64(1) << bits) - np.uint64(1))
        yield first, len(offsets) - 1, (keys >> bits).astype(np.int64), feature.astype(np.int64), words


class ToxicityModel:
    """Character model, toxic shares of learned words, and the share among other texts."""

    def __init__(self, characters: np.ndarray, words: np.ndarray, shares: np.ndarray, base: float) -> None:
        order = np.argsort(words)
        self.characters, self.words, self.shares, self.base = characters, words[order], shares[order], base

    def scorer(self):
        decoder, hasher = Decoder(self.characters), Hasher()
        spared = np.log1p(-self.shares)  # log of the chance that a word leaves a text clean

        def score(column) -> np.ndarray:
            clean = np.full(len(column), np.log1p(-self.base))
            for first, rows, row, word, _ in _word_features(column, decoder, hasher):
                known, at = _places(word, self.words)
                clean[first : first + rows] += np.bincount(row[known], spared[at], minlength=rows)
            return 1 - np.exp(clean)

        return score


def _copy_keys(words, rows: int) -> np.ndarray:
    """(rows, 12) keys, of which near copies share some: minima of word pairs in 64 bins, four to a key."""

    pair = mix(words.hash[:-1] * np.uint64(3) + words.hash[1:])
    same = words.doc[:-1] == words.doc[1:]
    pair, doc = pair[same], words.doc[:-1][same]
    none = np.uint64(2**64 - 1)
    minima = np.full(rows * 64, none)
    np.minimum.at(minima, doc * 64 + (pair >> np.uint64(58)).astype(np.int64), pair)
    minima = minima.reshape(rows, 64)[:, :48].reshape(rows, 12, 4)
    keys = np.zeros((rows, 12), np.uint64)
    for k in range(4):
        keys = mix(keys + minima[:, :, k])
    return np.where((minima == none).any(axis=2), np.uint64(0), keys)  # 0: too short to tell


def _families(keys: np.ndarray) -> np.ndarray:
    """A number per text; texts that share a key, over any number of steps, share it."""

    parent = np.arange(len(keys))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    seen: dict[tuple[int, int], int] = {}
    for i, row in enumerate(keys.tolist()):
        for place, key in enumerate(row):
            if key:
                a, b = root(i), root(seen.setdefault((place, key), i))
                parent[max(a, b)] = min(a, b)
    return np.array([root(i) for i in range(len(keys))], np.int64)


def _places(values: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of ``values`` that are in ``held``, their places there); ``held`` is sorted."""

    if not len(held):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(held, values), len(held) - 1)
    found = np.flatnonzero(held[at] == values)
    return found, at[found]


def learn_words(
    held: list[np.ndarray], keys: np.ndarray, labels: np.ndarray, weights: tuple[float, float] = (1.0, 1.0)
) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, toxic shares, share of toxic texts among those without such features).

    A feature is learned if nearly all texts that hold it are toxic and the log-likelihood
    ratio against the overall share stands out among as many features as were looked at.
    Near copies of one text count once, as a share of a text each way, so that what was
    copied often isn't taken for evidence. ``weights`` are of a clean and of a toxic text:
    how many of its label each stands for. Shares are weighted, the ratio is the sample's.
    """

    # Features of toxic texts are counted by families, a range of features at a time, so that
    # memory follows the texts. ``held`` ascends in each text.
    none = np.zeros(0, np.int64)
    known = np.unique(np.concatenate([none, *(h for h, y in zip(held, labels) if y)]))
    _, family = np.unique(_families(keys), return_inverse=True)
    families = int(family.max(initial=0)) + 1
    inner = known[np.arange(1, PARTS) * len(known) // PARTS] if len(known) else np.zeros(PARTS - 1, np.int64)
    edges = np.concatenate([[0], inner, [np.iinfo(np.int64).max]])
    clean_weight, toxic_weight = (w / min(weights) for w in weights)
    spans = [np.searchsorted(h, edges) for h in held]
    k, n = np.zeros(len(known)), np.zeros(len(known))
    for part in range(PARTS):
        cut = [h[at[part] : at[part + 1]] for h, at in zip(held, spans)]
        text = np.repeat(np.arange(len(held)), [len(h) for h in cut])
        found, word = _places(np.concatenate([*cut, none]), known)
        text = text[found]
        both, row = np.unique(word * families + family[text], return_inverse=True)
        toxic = labels[text].astype(bool)
        weight = np.where(toxic, toxic_weight, clean_weight)
        mean = np.bincount(row, weight * toxic, len(both)) / np.bincount(row, weight, len(both))
        n += np.bincount(both // families, minlength=len(known))
        k += np.bincount(both // families, mean, len(known))
    weighted_k = k * toxic_weight
    share = (weighted_k + 0.5) / (weighted_k + (n - k) * clean_weight + 1)
    overall = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-6, 1 - 1e-6))
    p = np.clip(k / np.maximum(n, 1), 1e-9, 1 - 1e-9)
    ratio = 2 * (k * np.log(p / overall) + (n - k) * np.log((1 - p) / (1 - overall)))
    least = np.where(known & 1, LEAST_STEM_SHARE, LEAST_SHARE)
    learned = (n >= LEAST_TEXTS) & (share > least) & (ratio > 2 * np.log(max(len(known), 1)) + 4)
    words = known[learned]
    without = np.array([not len(_places(h, words)[0]) for h in held], bool)
    toxic = labels[without].sum() * toxic_weight
    clean = (without.sum() - labels[without].sum()) * clean_weight
    base = (toxic + 0.5) / (toxic + clean + 1)
    return words, share[learned], float(min(base, 0.49))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> ToxicityModel:
    """Character model over all ``docs``; word shares on labelled ones that are not held out.

    The classifier sees about ``max_rows`` texts of each label at most, chosen by a hash of
    the id, and about twice as many of its rows where ids repeat (chosen by id and place), so
    that one id under many rows doesn't reach the fit whole. Weights bring back the true sizes
    of the labels; equal texts count once.
    """

    characters = character_model(character_counts(docs.select("text")))
    usable = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(5, 0))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
    )
    sizes = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return ToxicityModel(characters, np.zeros(0, np.int64), np.zeros(0), 0.99 if 1 in sizes else 0.0)
    # Each label up to its own bound; weights bring back the true shares.
    share = {label: min(1.0, max_rows / n) for label, n in sizes.items()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    # At most about 2 x max_rows pairs of numbers: small enough to send to every task.
    chosen = F.broadcast(usable.filter(place < F.when(F.col("label") == 1, share[1]).otherwise(share[0])))
    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("at"))
    found = placed.join(chosen, "doc_id")
    rows = {r["label"]: r["n"] for r in found.groupBy("label").agg(F.count("*").alias("n")).collect()}
    of_rows = {label: min(1.0, 2 * max_rows / max(rows.get(label, 0), 1)) for label in sizes}
    weights = (1 / share[0] / of_rows[0], 1 / share[1] / of_rows[1])
    row_place = F.pmod(F.xxhash64("doc_id", "at"), F.lit(1 << 30)) / float(1 << 30)
    sample = found.filter(row_place < F.when(F.col("label") == 1, of_rows[1]).otherwise(of_rows[0])).select("label", "text")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, hasher = Decoder(characters), Hasher()
        for batch in batches:
            found, keys = [], []
            for _, rows, row, feature, words in _word_features(batch.column(1), decoder, hasher):
                bounds = np.searchsorted(row, np.arange(rows + 1))
                found += [feature[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                keys += [k.tobytes() for k in _copy_keys(words, rows)]
            columns = [batch.column(0), pa.array(found, pa.binary()), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "words", "copies"])

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Equal texts once, toxic if any copy is; only arrays are kept, in a fixed order.
        seen: dict[bytes, list] = {}
        for batch in batches:
            for label, words, copies in zip(batch["label"], batch["words"], batch["copies"]):
                digest = hashlib.blake2b(words + copies, digest_size=16).digest()
                if digest in seen:
                    seen[digest][0] = max(seen[digest][0], int(label))
                else:
                    seen[digest] = [int(label), np.frombuffer(words, np.int64), np.frombuffer(copies, np.uint64)]
        kept = [seen[d] for d in sorted(seen)]
        held, labels = [k[1] for k in kept], np.array([k[0] for k in kept], int)
        keys = np.array([k[2] for k in kept], np.uint64).reshape(-1, 12)
        words, shares, base = learn_words(held, keys, labels, weights)
        yield pd.DataFrame({"words": [words.tobytes()], "shares": [shares.tobytes()], "base": [base]})

    model = (
        sample.mapInArrow(featured, "label int, words binary, copies binary")
        .repartition(1)  # the bounded sample
        .mapInPandas(fitted, "words binary, shares binary, base double")
        .first()
    )
    return ToxicityModel(
        characters, np.frombuffer(model["words"], np.int64), np.frombuffer(model["shares"]), model["base"]
    )


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) from the text alone."""

    schema = StructType([
        docs.schema["doc_id"], StructField("held_out", BooleanType()),
        StructField("score", DoubleType()), StructField("predicted", IntegerType()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            p = score(batch.column(2))
            columns = [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", held_out(5, 0).alias("held_out"), "text").mapInArrow(work, schema)


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Documents with a score below one half, all columns as they are."""

    place = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            yield batch.filter(pa.array(score(batch.column(place)) < 0.5))

    return docs.mapInArrow(work, docs.schema)
