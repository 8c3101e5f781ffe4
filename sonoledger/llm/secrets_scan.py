"""Secret scans: candidates by shape, false positives removed by a random forest.

Candidates are values given to a telling name (``password = ...``) and long tokens that mix
letters and digits. A quoted value goes to its closing quote on the line, whatever stands
in it; one without quotes to the next blank, quote, end tag or ``,name=``. Any run of blanks
may surround the sign. Each gets numbers for its length, character transitions, dictionary
coverage, path and neighbouring words; a random forest (Spark ML) trained on labelled
findings decides. Labelled findings are a table (text, path, start, end, label);
``example_findings`` makes one from written rules, where no reviewed findings exist.

The dictionary and the letter transitions come from the words of all documents: words are
counted in the tasks first, and the ``DICTIONARY`` most frequent ones of 3 to 24 letters are
kept, ties by the word.

Cases: null and empty texts have no candidates; null paths count as empty; candidates that
overlap are one, the named value first, but a quoted value with blanks and what is found
inside are judged apart and the outer one replaces both; a candidate may be as long as its text; repeated
rows each get a row; without documents the dictionary is empty and the forest still works.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from sonoledger.llm._words import Hasher, slices, words_of
from sonoledger.session import materialise

DICTIONARY = 20_000
LEAST_LENGTH = 16  # of tokens without a telling name
EXAMPLES = 6000  # labelled findings made where none are given
TREES, DEPTH = 40, 10
REPLACEMENT = "[SECRET]"

# Fixed words.
SECRET_NAMES = "password passwd pwd passphrase secret token apikey api_key api-key access_key accesskey auth_key credential private_key"
SECRET_WORDS = set("password passwd pwd passphrase secret token key apikey auth credential credentials bearer private login".split())
BENIGN_WORDS = set(
    "commit sha sha1 sha256 md5 checksum hash digest uuid guid id version revision build isbn order invoice card phone"
    " example sample test placeholder dummy fake figure page mail email http https www".split()
)
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "glpat-", "sk_live_", "sk-", "xoxb-", "xoxp-", "AIza", "eyJ", "SG.", "npm_")
PLACEHOLDERS = re.compile(r"(?i)example|changeme|change_me|your[_-]|placeholder|dummy|sample|xxxx|\*\*\*|redacted|12345678|abcdef|<|\$\{|\{\{")
TEST_PATHS = re.compile(r"(?i)(?:^|[/_.-])(?:tests?|spec|examples?|samples?|fixtures?|docs?|mock)(?:[/_.-]|$)")
CONFIG_PATHS = re.compile(r"(?i)\.(?:env|ini|cfg|conf|ya?ml|toml|properties|pem|tfvars)$|(?:^|/)\.env")

_NAME = "|".join(re.escape(n) for n in SECRET_NAMES.split())
_NAMED = re.compile(
    rf"(?i)(?<![a-z0-9])([a-z0-9_.-]{{0,40}}?(?:{_NAME})[a-z0-9_-]{{0,20}})[\"']?\s*+(?:=>|:=|==?|:)\s*+"
    r"(?:([\"'`])((?:\\.|(?!\2)[^\\\r\n])*+)\2|[\"'`]?([^\s\"'`]+))"
)
_BARE_END = re.compile(r"(?i)[,;&](?=[a-z0-9_.-]+[=:])|</?[a-z!]")  # of a value without quotes
LEAST_VALUE = 6  # of values with a telling name
_TOKEN = re.compile(r"[A-Za-z0-9+/_=.-]{16,}")
_TOKEN_BYTES = np.zeros(256, bool)
_TOKEN_BYTES[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-")] = True
_DIGIT = np.zeros(256, np.int64)
_DIGIT[list(b"0123456789")] = 1
_ALPHA = np.zeros(256, np.int64)
_ALPHA[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = 1
_UUID = re.compile(r"(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
_BLANK = re.compile(r"\s")
_LETTERS = re.compile(r"[A-Za-z]+")
_WORDS = re.compile(r"[A-Za-z][A-Za-z0-9]*")


class Candidate(NamedTuple):
    start: int  # code points
    end: int
    kind: str  # "named" or "token"
    name: str


def _named(text: str, start: int, end: int) -> Iterator[Candidate]:
    """Values with a telling name; those inside a quoted text too (quotes nest a few times at most)."""

    for m in _NAMED.finditer(text, start, end):
        a, b = m.span(3) if m[2] else _bare(text, *m.span(4))
        if b - a >= LEAST_VALUE:
            yield Candidate(a, b, "named", m[1])
        if m[2] and _BLANK.search(text, a, b):
            yield from _named(text, a, b)


def _bare(text: str, start: int, end: int) -> tuple[int, int]:
    """A value without quotes, less what follows it and closing signs that nothing opened."""

    cut = _BARE_END.search(text, start, end)
    end = cut.start() if cut else end
    spare = {c: text.count(c, start, end) - text.count(o, start, end) for o, c in ("()", "[]", "{}")}
    while end > start and (text[end - 1] in ",;" or spare.get(text[end - 1], 0) > 0):
        if text[end - 1] in spare:
            spare[text[end - 1]] -= 1
        end -= 1
    return start, end


def candidates(text: str) -> list[Candidate]:
    found = list(_named(text, 0, len(text)))
    taken = [(c.start, c.end) for c in found if not _BLANK.search(text, c.start, c.end)]
    k = 0
    for m in _TOKEN.finditer(text):
        value = m[0].strip(".=-")
        start = m.start() + m[0].index(value) if value else m.start()
        end = start + len(value)
        if len(value) < LEAST_LENGTH or not re.search(r"\d", value) or not re.search(r"[A-Za-z]", value):
            continue
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if k < len(taken) and taken[k][0] < end:
            continue
        found.append(Candidate(start, end, "token", ""))
    return sorted(found)


def may_hold(column: pa.Array) -> np.ndarray:
    """Whether a text can have a candidate; a quick look at the bytes of all texts."""

    named = pc.fill_null(pc.match_substring_regex(column, f"(?:{_NAME})", ignore_case=True), False)
    out = np.array(named.to_pylist(), bool)
    for first, data, offsets in slices(column):
        if not len(data):
            continue
        inside = _TOKEN_BYTES[data]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
        start, end = edges[::2], edges[1::2]
        digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
        letters = np.concatenate([[0], np.cumsum(_ALPHA[data])])
        long = (end - start >= LEAST_LENGTH) & (digits[end] > digits[start]) & (letters[end] > letters[start])
        # A run over the edge of two texts counts for all it touches; the search decides.
        for a, b in zip(start[long], end[long]):
            i, j = np.searchsorted(offsets, [a, b - 1], side="right") - 1
            out[first + i : first + j + 1] = True
    return out


class Lexicon:
    """Frequent words, and how likely one letter follows another in them."""

    def __init__(self, words: dict[str, int]) -> None:
        self.words = {w for w in words if len(w) >= 3}
        counts = np.ones((27, 27))
        for word, n in words.items():
            codes = [0, *(ord(c) - 96 if "a" <= c <= "z" else 0 for c in word), 0]
            for a, b in zip(codes, codes[1:]):
                counts[a, b] += n
        self.log_p = np.log(counts / counts.sum(axis=1, keepdims=True))
        self.longest = max(map(len, self.words), default=0)

    def coverage(self, value: str) -> float:
        """Share of the characters in dictionary words, the longest first from the left."""

        covered = 0
        for run in _LETTERS.findall(value):
            run, at = run.lower(), 0
            while at < len(run):
                for size in range(min(self.longest, len(run) - at), 3, -1):
                    if run[at : at + size] in self.words:
                        covered += size
                        at += size
                        break
                else:
                    at += 1
        return covered / max(len(value), 1)

    def transitions(self, value: str) -> float:
        codes = [0, *(ord(c) - 96 if "a" <= c <= "z" else 0 for c in value.lower()), 0]
        return float(np.mean([self.log_p[a, b] for a, b in zip(codes, codes[1:])]))


def _class(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def finding_features(text: str, c: Candidate, path: str, lexicon: Lexicon) -> list[float]:
    value = text[c.start : c.end]
    n = len(value)
    kinds = [_class(x) for x in value]
    shares = [kinds.count(k) / n for k in range(4)]
    counts = np.array(list(Counter(value).values())) / n
    before = [w.lower() for w in _WORDS.findall(text[max(0, c.start - 80) : c.start])[-4:]]
    after = [w.lower() for w in _WORDS.findall(text[c.end : c.end + 40])[:2]]
    name = set(re.split(r"[^a-z0-9]+", c.name.lower()))
    near = set(before) | set(after) | name
    return [
        float(min(n, 1000)),
        float(-(counts * np.log2(counts)).sum()),
        *shares,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / max(n - 1, 1),
        lexicon.transitions(value),
        lexicon.coverage(value),
        float(max(map(len, _LETTERS.findall(value)), default=0)) / n,
        float(bool(re.fullmatch(r"[0-9a-fA-F]+", value))),
        float(c.kind == "named"),
        float(bool(near & SECRET_WORDS)),
        float(bool(near & BENIGN_WORDS)),
        float(bool(PLACEHOLDERS.search(value))),
        float(value.startswith(PREFIXES)),
        float(bool(_UUID.fullmatch(value))),
        len(set(value)) / n,
        float(path.count("/")),
        float(bool(TEST_PATHS.search(path))),
        float(bool(CONFIG_PATHS.search(path))),
        float(value.count(".") + value.count("/")) / n,
        float(value.count(" ")) / n,
        float(text[max(0, c.start - 1) : c.start] in "/@." and c.start > 0 or text[c.end : c.end + 1] == "@"),
    ]


class Forest:
    """Trees as arrays, read from the model's printed form."""

    def __init__(self, printed: str) -> None:
        self.trees = []
        for block in re.split(r"\n\s*Tree \d+ [^\n]*\n", printed)[1:]:
            lines = [(len(x) - len(x.lstrip()), x.strip()) for x in block.splitlines() if x.strip()]
            nodes: list[list[float]] = []  # feature, threshold, left, right, prediction
            self._node(lines, 0, nodes)
            self.trees.append(np.array(nodes, float))

    def _node(self, lines: list[tuple[int, str]], at: int, nodes: list) -> tuple[int, int]:
        """(number of the node that begins at line ``at``, line after it)."""

        me = len(nodes)
        line = lines[at][1]
        if line.startswith("Predict"):
            nodes.append([-1, 0, 0, 0, float(line.split(":")[1])])
            return me, at + 1
        feature, threshold = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        nodes.append([float(feature), float(threshold), 0, 0, 0])
        nodes[me][2], at = self._node(lines, at + 1, nodes)
        nodes[me][3], at = self._node(lines, at + 1, nodes)  # past the Else line
        return me, at

    def score(self, x: np.ndarray) -> np.ndarray:
        """Share of trees that vote for a secret."""

        votes, rows = np.zeros(len(x)), np.arange(len(x))
        for tree in self.trees:
            node = np.zeros(len(x), int)
            while (going := tree[node, 0] >= 0).any():
                left = x[rows, np.maximum(tree[node, 0], 0).astype(int)] <= tree[node, 1]
                node = np.where(going, np.where(left, tree[node, 2], tree[node, 3]), node).astype(int)
            votes += tree[node, 4]
        return votes / max(len(self.trees), 1)


def _example(rng: np.random.Generator) -> tuple[str, str, int, int, int]:
    """One made finding: (text, path, start, end, label)."""

    def pick(chars: str, n: int) -> str:
        return "".join(rng.choice(list(chars), n))

    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    hexa, mixed = "0123456789abcdef", lower + upper + digits
    word = lambda: "".join(rng.choice("on th er an re he in ti es or st ar nd to nt en".split(), rng.integers(1, 5)))
    before, after = " ".join(word() for _ in range(rng.integers(0, 6))), " ".join(word() for _ in range(rng.integers(0, 6)))
    name = str(rng.choice("password passwd pwd secret token api_key access_key client_secret auth_token db_password".split()))
    sign = str(rng.choice(["=", " = ", ": ", "=\"", " = \"", ": '"]))
    label = int(rng.integers(0, 2))
    if label:
        shape = rng.integers(0, 10)
        value = [
            lambda: pick(hexa, rng.integers(16, 65)), lambda: "AKIA" + pick(upper + digits, 16),
            lambda: "ghp_" + pick(mixed, 36), lambda: pick(mixed, rng.integers(12, 44)), lambda: "sk_live_" + pick(mixed, 24),
            lambda: "eyJ" + pick(mixed, 30) + "." + pick(mixed, 60) + "." + pick(mixed + "_-", 43),
            lambda: pick(mixed + "+/", 40), lambda: pick(mixed + "!@#%^&*", rng.integers(10, 24)),
            lambda: pick(mixed + "!@#()[],;", rng.integers(8, 24)) + pick(digits, 1),
            lambda: "".join(word() + pick(" ,;.-_!()", 1) for _ in range(rng.integers(2, 5))) + pick(digits, rng.integers(1, 4)),
        ][shape]()
        if shape >= 8:  # such values are whole between quotes only
            sign = str(rng.choice(["=\"", " = \"", ": '"]))
        bare = shape in (1, 2, 4, 5) and rng.random() < 0.7
        lead = "" if bare else f"{name}{sign}"
        path = str(rng.choice(["config/app.env", "src/main.py", "deploy/values.yaml", "settings.ini", "", "src7", "notes/log.txt"]))
    else:
        shape = rng.integers(0, 15)
        value, lead = [
            lambda: ("-".join(pick(hexa, k) for k in (8, 4, 4, 4, 12)), "id "), lambda: (pick(hexa, 40), "commit "),
            lambda: (pick(hexa, 64), str(rng.choice(["sha256:", "checksum ", "digest "]))), lambda: (pick(hexa, 32), "md5 "),
            lambda: ("changeme" + pick(digits, 2), f"{name}{sign}"), lambda: (f"your-{name.replace('_', '-')}-here", f"{name}{sign}"),
            lambda: ("".join(word() for _ in range(6)) + pick(digits, 1), ""), lambda: (word() + word() + word(), f"{name}{sign}"),
            lambda: (f"{word()}.{pick(digits, 2)}@mail.{word()}.example.com".split("@")[0] + word() + word() + pick(digits, 4), "mail "),
            lambda: ("/".join(word() for _ in range(5)) + f"/v{pick(digits, 2)}/index.html", ""),
            lambda: ("mail" + pick(digits, 1) + ".example.com", f"{word()}.{pick(digits, 2)}@"),
            lambda: ("x" * int(rng.integers(8, 20)) + pick(digits, 2), f"{name}{sign}"),
            lambda: (" ".join(word() for _ in range(rng.integers(3, 9))), f"{name}: \""),
            lambda: (pick(upper, 1) + pick("-_.", 1).join(pick(digits, rng.integers(2, 5)) for _ in range(rng.integers(5, 8))), ""),
            lambda: (pick("-_.", 1).join([word() + word(), pick(digits, rng.integers(1, 9)), word() + word(), word()]), ""),
        ][shape]()
        path = str(rng.choice(["tests/test_auth.py", "docs/usage.md", "src/main.py", "examples/conf.yaml", "", "src7", "README.md"]))
    closing = lead[-1:] if lead[-1:] in "\"'" else ""
    text = f"{before} {lead}{value}{closing} {after}".lstrip()
    start = text.index(lead + value) + len(lead)
    return text, path, start, start + len(value), label


def example_findings(spark: SparkSession, rows: int = EXAMPLES, seed: int = 7) -> DataFrame:
    """Labelled findings made by written rules, the same for the same seed."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [_example(np.random.default_rng([seed, int(i)])) for i in batch["id"]]
            yield pd.DataFrame(made, columns=["text", "path", "start", "end", "label"])

    return spark.range(0, rows, 1, 4).mapInPandas(work, "text string, path string, start int, end int, label int")


def learn_lexicon(texts: DataFrame, most: int = DICTIONARY) -> Lexicon:
    """The most frequent ASCII words of all texts, at most ``most``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, n, held = Hasher(), Counter(), {}
        for batch in batches:
            for _, data, offsets in slices(batch.column(0)):
                words = words_of(data, offsets, hasher)
                size = words.end - words.start
                fit = np.flatnonzero((size >= 3) & (size <= 24))
                keys, at, count = np.unique(words.hash[fit], return_index=True, return_counts=True)
                for key, i, c in zip(keys.tolist(), fit[at].tolist(), count.tolist()):
                    if key not in held:
                        held[key] = words.low[words.start[i] : words.end[i]].tobytes()
                    n[key] += c
                if len(held) > 500_000:  # hand over what is counted so far
                    yield _word_rows(held, n)
                    held, n = {}, Counter()
        yield _word_rows(held, n)

    counted = materialise(
        texts.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "secret-words"
    )
    # Words fall into a few hundred classes of frequency: the highest ones that fit are taken
    # whole, and of the next one its first words, so only ``most`` words reach the driver.
    level = F.floor(F.log2("n") * 16)
    sizes = counted.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()
    words: dict[str, int] = {}
    room, above = most, None
    for row in sorted(sizes, key=lambda r: -r["level"]):
        if row["words"] > room:
            edge = counted.filter(level == row["level"]).orderBy(F.desc("n"), "word").limit(room)
            words = {r["word"]: r["n"] for r in edge.collect()}
            break
        room, above = room - row["words"], row["level"]
    if above is not None:
        words.update((r["word"], r["n"]) for r in counted.filter(level >= above).collect())
    return Lexicon(dict(sorted(words.items())))


def _word_rows(held: dict[int, bytes], n: Counter) -> pa.RecordBatch:
    kept = [(w.decode(), n[k]) for k, w in held.items() if 3 <= len(w) <= 24 and w.isalpha() and w.isascii()]
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in kept], pa.string()), pa.array([k[1] for k in kept], pa.int64())], names=["word", "n"]
    )


class SecretModel(NamedTuple):
    lexicon: Lexicon
    forest: Forest

    def find(self, text: str, path: str) -> list[tuple[Candidate, float]]:
        found = candidates(text)
        if not found:
            return []
        x = np.array([finding_features(text, c, path, self.lexicon) for c in found])
        return list(zip(found, self.forest.score(x).tolist()))

    def secrets(self, findings: list[tuple[Candidate, float]], least: float) -> list[tuple[Candidate, float]]:
        """Findings of at least that score, without those inside another one."""

        out: list[tuple[Candidate, float]] = []
        for c, score in sorted(findings, key=lambda f: (f[0].start, -f[0].end)):
            if score >= least and not (out and c.start < out[-1][0].end):
                out.append((c, score))
        return out


def train(docs: DataFrame, findings: DataFrame | None = None) -> SecretModel:
    """Dictionary of all documents and a forest of the labelled findings.

    ``findings`` is a reviewed, bounded table (text, path, start, end, label).
    """

    lexicon = learn_lexicon(docs.select("text"))
    findings = example_findings(docs.sparkSession) if findings is None else findings

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, path, start, end, label in zip(*(batch[c] for c in ("text", "path", "start", "end", "label"))):
                same = [c for c in candidates(text) if c.start == start] or [Candidate(start, end, "token", "")]
                rows.append((finding_features(text, same[0]._replace(end=end), path or "", lexicon), float(label)))
            yield pd.DataFrame(rows, columns=["x", "label"])

    table = findings.select("text", "path", "start", "end", "label").mapInPandas(featured, "x array<double>, label double")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=3, seed=11
    ).fit(table.select(array_to_vector("x").alias("features"), "label"))
    return SecretModel(lexicon, Forest(forest.toDebugString))


def _redacted(text: str, secrets: list[Candidate]) -> str:
    parts, at = [], 0
    for c in secrets:
        parts += [text[at : c.start], REPLACEMENT]
        at = c.end
    return "".join([*parts, text[at:]])


def _found(batch: pa.RecordBatch, text_at: int, path_at: int | None, model: SecretModel):
    """(row, text, findings) of each text; findings only where the quick look sees a reason."""

    may = may_hold(batch.column(text_at))
    for row, value in enumerate(batch.column(text_at)):
        text = value.as_py() or ""
        path = "" if path_at is None else str(batch.column(path_at)[row].as_py() or "")
        yield row, text, model.find(text, path) if may[row] else []


def scan(docs: DataFrame, model: SecretModel, path_col: str | None = "source", least: float = 0.5) -> DataFrame:
    """(doc_id, n_candidates, n_secrets, secrets, redacted_sha256) for every document.

    ``secrets`` holds start and end in code points, kind and score (share of the trees).
    """

    item = StructType([
        StructField("start", LongType()), StructField("end", LongType()), StructField("kind", StringType()),
        StructField("score", DoubleType()),
    ])
    schema = StructType([
        docs.schema["doc_id"], StructField("n_candidates", LongType()), StructField("n_secrets", LongType()),
        StructField("secrets", ArrayType(item)), StructField("redacted_sha256", StringType()),
    ])
    arrow_item = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("score", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, kept, digests = [], [], []
            for _, text, findings in _found(batch, 1, 2 if path_col else None, model):
                secrets = model.secrets(findings, least)
                counts.append(len(findings))
                kept.append([{"start": c.start, "end": c.end, "kind": c.kind, "score": s} for c, s in secrets])
                digests.append(hashlib.sha256(_redacted(text, [c for c, _ in secrets]).encode()).hexdigest())
            columns = [
                batch.column(0), pa.array(counts, pa.int64()), pa.array(map(len, kept), pa.int64()),
                pa.array(kept, arrow_item), pa.array(digests, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text", *([path_col] if path_col else [])).mapInArrow(work, schema)


def redact(docs: DataFrame, model: SecretModel, path_col: str | None = "source", least: float = 0.5) -> DataFrame:
    """All documents and columns, secrets in ``text`` replaced, ``n_chars`` (if there) counted anew."""

    names = docs.columns
    text_at, path_at = names.index("text"), names.index(path_col) if path_col in names else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, changed = batch.column(text_at).to_pylist(), {}
            for row, text, findings in _found(batch, text_at, path_at, model):
                secrets = [c for c, _ in model.secrets(findings, least)]
                if secrets:
                    texts[row] = changed[row] = _redacted(text, secrets)
            columns = list(batch.columns)
            if changed:
                columns[text_at] = pa.array(texts, batch.schema.field(text_at).type)
                if "n_chars" in names:
                    at = names.index("n_chars")
                    sizes = batch.column(at).to_pylist()
                    for row, text in changed.items():
                        sizes[row] = len(text)
                    columns[at] = pa.array(sizes, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(work, docs.schema)
