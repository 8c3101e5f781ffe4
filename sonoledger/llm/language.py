"""Language ID: multinomial logistic regression on TF-IDF character n-grams.

Features are runs of one to three letters, lower-cased, with a mark for word edges,
hashed to 2^16 buckets. The term frequency is the share of a text's n-grams; document
frequencies come from all learning texts. Follow-the-regularised-leader with an elastic
net fits the weights on a bounded sample (``max_rows``), and a temperature fitted on
rows kept out of the fit calibrates the scores.

Cases: a text that is null or has no letter is ``und`` with score 0; nothing to learn
from (no labelled text) makes every text ``und``; a null id is never learned from and not
held out; repeated rows each get a row. A text over ``PIECE_CHARS`` is worked on in
pieces, whose edges count as word edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from sonoledger.llm._ftrl import Example, Penalty, fit, softmax, temperature

BUCKETS = 1 << 16
ORDERS = 3
BIAS = BUCKETS  # one more feature
SCALE = 30.0  # brings shares of n-grams to the size of the bias
PIECE_CHARS = 1 << 18
UNKNOWN = "und"
MAX_ROWS = 6000
PENALTY = Penalty(alpha=0.5, beta=1.0, l1=0.5, l2=0.1)
PASSES = 2


class Letters:
    """Code points to lower-case letters; 0 for everything else."""

    def __init__(self) -> None:
        chars = [chr(i) for i in range(1 << 16)]
        self.table = np.array([ord(c.lower()[0]) if c.isalpha() else 0 for c in chars], np.uint32)

    def of(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = self.table[np.minimum(points, 0xFFFF)]
        for i in np.flatnonzero(points > 0xFFFF):
            letters[i] = points[i] if chr(points[i]).isalpha() else 0
        return letters


def n_grams(texts: list[str], letters: Letters) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of all n-grams, one order after the other; rows come in text order."""

    c = letters.of("\n" + "\n".join(texts) + "\n")
    row = np.repeat(np.arange(len(texts) + 1), [1, *(len(t) + 1 for t in texts)]) - 1
    held = c > 0
    held[1:] |= c[:-1] > 0
    held[0] = True
    c, row = c[held], row[held]
    h = np.zeros(len(c), np.uint32)
    for order in range(1, ORDERS + 1):
        if order > 1:
            back = np.zeros(len(c), np.uint32)
            same = row[order - 1 :] == row[: 1 - order]
            back[order - 1 :] = np.where(same, c[: 1 - order], 0)
        else:
            back = c
        h = (h ^ (back + np.uint32(order))) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        real = c > 0 if order == 1 else (c > 0) | (back > 0)
        if order == 3:  # at a word's end the last two letters, at its start the first
            real = c + np.concatenate([[0], c[:-1]]).astype(np.uint32) > 0
        real &= row >= 0
        out = (h * np.uint32(0x85EBCA6B)) >> np.uint32(16)
        yield row[real], out[real]


def _pieces(values: pa.Array) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(rows, texts) of about ``PIECE_CHARS`` characters."""

    rows, texts, size = [], [], 0
    for row, value in enumerate(values):
        text = value.as_py() or ""
        for at in range(0, max(len(text), 1), PIECE_CHARS):
            piece = text[at : at + PIECE_CHARS]
            rows.append(row)
            texts.append(piece)
            size += len(piece)
            if size >= PIECE_CHARS:
                yield np.array(rows), texts
                rows, texts, size = [], [], 0
    if texts:
        yield np.array(rows), texts


def _counts(text: str, letters: Letters) -> np.ndarray:
    """n-grams of one text per bucket."""

    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(len(text), 1), PIECE_CHARS):
        for _, bucket in n_grams([text[at : at + PIECE_CHARS]], letters):
            total += np.bincount(bucket, minlength=BUCKETS)
    return total


def _document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Texts with a letter, and in how many of them each bucket occurs. At most 2^16 numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, df, n = Letters(), np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                found = np.flatnonzero(_counts(value.as_py() or "", letters))
                df[found] += 1
                n += len(found) > 0
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, -1)), pa.array(np.append(df[held], n))], names=["bucket", "n"]
        )

    rows = texts.mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(BUCKETS + 1, np.int64)
    df[rows["bucket"].to_numpy()] = rows["n"].to_numpy()  # -1 is the last place
    return int(df[BUCKETS]), df[:BUCKETS]


class LanguageModel:
    """Learned languages, weights with the document frequencies worked in, temperature."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray, heat: float) -> None:
        self.languages, self.weights, self.bias, self.heat = languages, weights.astype(np.float32), bias, heat

    def logits(self, values: pa.Array, letters: Letters) -> tuple[np.ndarray, np.ndarray]:
        """(logits per text, n-grams per text)."""

        total = np.zeros((len(values), len(self.languages)))
        n = np.zeros(len(values), np.int64)
        for rows, texts in _pieces(values):
            for row, bucket in n_grams(texts, letters):
                if not len(row):
                    continue
                starts = np.flatnonzero(np.diff(row, prepend=-1))
                sums = np.add.reduceat(self.weights[bucket], starts, axis=0, dtype=np.float64)
                np.add.at(total, rows[row[starts]], sums)
                np.add.at(n, rows[row[starts]], np.diff(np.append(starts, len(row))))
        return total * (SCALE / np.maximum(n, 1))[:, None] + self.bias, n


def train(labelled: DataFrame, max_rows: int = MAX_ROWS) -> LanguageModel | None:
    """A model of the ``text`` and ``lang`` of ``labelled``.

    The fit sees at most about ``max_rows`` texts, shared evenly by the languages and
    chosen by a hash of id and text; document frequencies see every text.
    """

    labelled = labelled.filter(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return None
    n, df = _document_frequencies(labelled.select("text"))
    idf = np.log((1 + n) / (1 + df)) + 1
    share = {lang: min(1.0, max_rows / len(languages) / sizes[lang]) for lang in languages}
    wanted = F.element_at(F.create_map(*(F.lit(x) for pair in share.items() for x in pair)), F.col("lang"))
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.col("text")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.select("lang", "text", place.alias("place")).filter(F.col("place") < wanted)

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = Letters()
        for batch in batches:
            out = []
            for lang, text, at in zip(batch["lang"], batch["text"], batch["place"]):
                counts = _counts(text or "", letters)
                index = np.flatnonzero(counts)
                if len(index):
                    value = (counts[index] / counts.sum() * idf[index] * SCALE).astype(np.float32)
                    out.append((languages.index(lang), at, index.astype(np.int32).tobytes(), value.tobytes()))
            yield pd.DataFrame(out, columns=["label", "place", "index", "value"])

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True)
        # Labels and bytes break ties, so the order never depends on how rows arrive.
        rows = rows.sort_values(["place", "label", "index"], ignore_index=True)
        examples = [
            Example(
                np.append(np.frombuffer(i, np.int32), BIAS), np.append(np.frombuffer(v, np.float32), 1.0), int(label)
            )
            for label, i, v in zip(rows["label"], rows["index"], rows["value"])
        ]
        kept_out = examples[::5] if len(examples) >= 20 else []
        used = [e for k, e in enumerate(examples) if not kept_out or k % 5]
        weights = fit(used, BUCKETS + 1, len(languages), PENALTY, PASSES, BIAS)
        logits = np.array([e.value @ weights[e.index] for e in kept_out]).reshape(len(kept_out), len(languages))
        heat = temperature(logits, np.array([e.label for e in kept_out], int))
        yield pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()], "heat": [heat]})

    model = (
        sample.mapInPandas(featured, "label int, place double, index binary, value binary")
        .repartition(1)  # the bounded sample
        .mapInPandas(fitted, "weights binary, heat double")
        .first()
    )
    weights = np.frombuffer(model["weights"], np.float32).reshape(BUCKETS + 1, len(languages))
    return LanguageModel(languages, weights[:BUCKETS] * idf[:, None], weights[BIAS].astype(float), model["heat"])


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) from the text alone."""

    schema = StructType([
        docs.schema["doc_id"], StructField("held_out", BooleanType()),
        StructField("lang_pred", StringType()), StructField("score", DoubleType()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for batch in batches:
            names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if model is not None and batch.num_rows:
                logits, n = model.logits(batch.column(2), letters)
                shares = softmax(logits / model.heat)
                best = shares.argmax(axis=1)
                names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, n)]
                scores = np.where(n > 0, shares.max(axis=1), 0.0)
            columns = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", held_out(4, 2).alias("held_out"), "text").mapInArrow(work, schema)


def held_out(modulus: int, remainder: int):
    """Whether the checksum of the id as text has that remainder; false for a null id."""

    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


def identify(docs: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Learn from the documents that are not held out, predict all."""

    learning = docs.filter(F.col("doc_id").isNotNull() & ~held_out(4, 2))
    return predict(docs, train(learning.select("doc_id", "text", "lang"), max_rows))
