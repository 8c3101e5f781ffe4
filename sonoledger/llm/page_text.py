"""Main text of HTML pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive, tags negative; one linear
scan finds the contiguous region with the largest sum, and its words are the text. Elements
that stand around or inside the article (menus, adverts, forms and so on) are islands: they
cost their tag's weight once and their words neither count nor stay.

All weights are log odds counted on labelled pages: those of the input that mark the article
themselves (one ``article`` or ``main`` element; a bounded sample of different pages,
``MAX_PAGES``), and written examples (``example_pages``) for what the input lacks. What an
element is called is one weight among several: in the anchor of a section or the class of a
paragraph only the word that heads the name tells (``search-engines`` is about engines), the
anchor of a paragraph or heading tells nothing, and prose speaks for an element.

A page with one ``article`` (else one ``main``) has its text there: words outside it score
negative, as they do on the labelled pages, and tags inside cost little. An ``article`` inside
another is a remark on it. A form around half of the page is the page.

Cases: null, empty and wordless pages have an empty text; unclosed or stray tags, comments
and quotes are read leniently; a page whose every word lies in furniture is scanned again
by tags alone; repeated rows each get a row; long pages are read whole. Time is linear in
the page, whatever the nesting.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

MAX_PAGES = 2000
FURNITURE_ODDS = -1.5  # log odds below which an element is furniture
SMALL_TAG = -0.01  # the least a tag costs
PROSE_WORDS, PROSE_LINKS = 25, 0.2  # words an element needs, and its largest share of links, to be prose

# Fixed values of the markup language.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table"
    " tbody tfoot thead tr ul caption".split()
)
SPACED = set("br td th option button input select img".split())
# Elements kept on the stack; the others close too carelessly to matter.
HELD = set(
    "article aside details dialog div fieldset footer form header main menu nav ol section table td th ul li search"
    " noscript template button select svg label figure blockquote dl p span a h1 h2 h3 h4 h5 h6".split()
)
# Elements that are not the article wherever they stand; labelled pages are labelled by them.
NEVER = set("nav aside footer form script style noscript template button select dialog menu search svg".split())
# Elements whose name says nothing of what they hold.
GENERIC = set("div section td th table tr ul ol li dl p span a h1 h2 h3 h4 h5 h6 label figure blockquote ins".split())
# Elements of one paragraph or heading: their id is an anchor.
LEAVES = set("p h1 h2 h3 h4 h5 h6 blockquote pre dt dd li figcaption b i em strong span a".split())
# Words that say of a name where or how large its element is, not what it holds.
WRAPPING = set(
    "area bar block bottom box center col column container desktop fixed global group head holder inner item large last"
    " left link list main mobile outer page panel primary right row secondary section site slot small sticky top unit"
    " wrap wrapper zone".split()
)
CLOSED_BY_BLOCK = {"p", "a", "span", "h1", "h2", "h3", "h4", "h5", "h6", "label", "button"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*>?"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/<>\"']*)(?P<rest>(?:\"[^\"<]*\"|'[^'<]*'|[^'\"<>])*+)>"
    r"|<(?P<close2>/?)(?P<name2>[A-Za-z][^\s/<>\"']*)(?P<rest2>[^<>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Token(NamedTuple):
    kind: str  # "text", "open", "close"
    value: str  # text with references decoded, or the element's name
    attributes: str = ""


def tokens(page: str) -> Iterator[Token]:
    at = 0
    while True:
        found = _TOKEN.search(page, at)
        if found is None:
            break
        if found.start() > at:
            yield Token("text", html.unescape(page[at : found.start()]))
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        if found["close"] or found["close2"]:
            yield Token("close", name)
            continue
        rest = found["rest"] if found["name"] else found["rest2"]
        yield Token("open", name, rest)
        if name in RAW:
            end = re.compile(f"</{name}", re.I).search(page, at)
            at = end.start() if end else len(page)
    if at < len(page):
        yield Token("text", html.unescape(page[at:]))


def name_features(name: str, anchor: bool) -> list[str]:
    """What a class or id says: each of its words; of an anchor, or the class of a paragraph,
    ``class:`` the word that heads it and ``of:`` those before."""

    parts = [w.lower() for w in _PART.findall(name)]
    # "with-sidebar" or "no-ads" tell of something else on the page.
    told = [w for w, before in zip(parts, ["", *parts]) if before not in ("with", "has", "no", "without")]
    told = [w.rstrip("s") or w for w in told]
    if not anchor:
        return [f"class:{w}" for w in told]
    heads = [w for w in told if w not in WRAPPING] or told
    return [f"of:{w}" for w in heads[:-1]] + [f"class:{w}" for w in heads[-1:]]


def element_features(name: str, attributes: str, within: str = "", prose: bool = False) -> list[str]:
    """What is known of an element: its name and what it is in, its role, its names, its text.

    ``within`` is ``article`` or ``main`` inside such an element, or ``page`` for a form
    that holds half of the page.
    """

    told = within and (name in ("header", "form") or name == within == "article")
    out = [f"in:{'page' if within == 'page' else 'article'}>{name}" if told else f"in:{name}"]
    names: set[str] = set()
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "class" or key == "id" and name not in LEAVES:
            anchor = name in LEAVES or key == "id" and name == "section"
            names.update(f for part in value.split() for f in name_features(part, anchor))
        elif key == "role":
            out.append(f"role:{value.lower()}")
        elif key in ("hidden", "aria-hidden") and value.lower() != "false" or key == "style" and re.search(r"display\s*:\s*none", value):
            out.append("attr:hidden")
    if re.search(r"(?:^|\s)hidden(?:\s|$)", attributes):
        out.append("attr:hidden")
    return out + sorted(names) + ["text:prose"] * prose


class _Stack:
    """Open elements; tolerant of missing and stray end tags, each step in constant time
    but for what it takes off."""

    def __init__(self) -> None:
        self.open: list[tuple[str, int]] = []
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.barriers: list[int] = [-1]  # places of blocks that hold paragraphs

    def push(self, name: str, value: int) -> None:
        self.places[name].append(len(self.open))
        if name in BLOCKS and name not in CLOSED_BY_BLOCK:
            self.barriers.append(len(self.open))
        self.open.append((name, value))

    def _take(self) -> int:
        name, value = self.open.pop()
        self.places[name].pop()
        if self.barriers[-1] == len(self.open):
            self.barriers.pop()
        return value

    def block(self) -> list[int]:
        """A block begins: the paragraphs before it end."""

        out = []
        while self.open and self.open[-1][0] in CLOSED_BY_BLOCK:
            out.append(self._take())
        return out

    def pop(self, name: str) -> list[int]:
        places = self.places[name]
        if not places or name in CLOSED_BY_BLOCK and places[-1] < self.barriers[-1]:
            return []
        down = places[-1]
        return [self._take() for _ in range(len(self.open) - down)]

    def has(self, name: str) -> bool:
        return bool(self.places[name])


class Element:
    """An element from the token that opens it to the one that ends it."""

    __slots__ = ("name", "attributes", "start", "end", "within")

    def __init__(self, name: str, attributes: str, start: int, end: int, within: str) -> None:
        self.name, self.attributes, self.start, self.end, self.within = name, attributes, start, end, within


class Page:
    """Tokens of a page, its elements, and the words and linked words before each token."""

    def __init__(self, page: str) -> None:
        self.tokens = list(tokens(page))
        n = len(self.tokens)
        words, linked = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        self.elements: list[Element] = []
        stack = _Stack()
        for i, token in enumerate(self.tokens):
            if token.kind == "text":
                words[i + 1] = len(token.value.split())
                linked[i + 1] = words[i + 1] if stack.has("a") else 0
                continue
            if token.kind == "close":
                for k in stack.pop(token.value):
                    self.elements[k].end = i
                continue
            if token.value in BLOCKS:
                for k in stack.block():
                    self.elements[k].end = i - 1
            if token.value in HELD or token.attributes and token.value not in VOID | RAW | {"html", "body"}:
                within = "article" if stack.has("article") else "main" if stack.has("main") else ""
                stack.push(token.value, len(self.elements))
                self.elements.append(Element(token.value, token.attributes, i, n - 1, within))
        self.words = np.cumsum(words).tolist()
        self.linked = np.cumsum(linked).tolist()

    def features(self, e: Element) -> list[str]:
        n = self.words[e.end + 1] - self.words[e.start]
        links = self.linked[e.end + 1] - self.linked[e.start]
        prose = n >= PROSE_WORDS and links <= PROSE_LINKS * n
        whole = e.name == "form" and n >= PROSE_WORDS and 2 * n >= self.words[-1]
        return element_features(e.name, e.attributes, "page" if whole else e.within, prose)

    def inside(self, elements: list[Element]) -> np.ndarray:
        """Whether each token lies in one of the elements, their own tags included."""

        edges = np.zeros(len(self.tokens) + 1, np.int64)
        np.add.at(edges, np.array([e.start for e in elements], np.int64), 1)
        np.subtract.at(edges, np.array([e.end + 1 for e in elements], np.int64), 1)
        return np.cumsum(edges)[:-1] > 0


def page_counts(page: str, labelled_by: str) -> Counter:
    """(feature, is content) counts of one labelled page.

    ``labelled_by`` is an element name whose words are content, or an attribute text that
    the content element carries.
    """

    counts: Counter = Counter()
    read = Page(page)
    starts = [e for e in read.elements if e.name == labelled_by and not e.within or labelled_by in e.attributes]
    first = {id(e) for e in starts}
    never = [
        e for e in read.elements if id(e) not in first and (e.name in NEVER or 'data-label="no"' in e.attributes)
    ]
    marked, content = read.inside(starts), read.inside(starts) & ~read.inside(never)
    landmark = any(e.name in ("article", "main") for e in starts)
    words = np.diff(read.words)
    good = np.concatenate([[0], np.cumsum(words * content)])
    for i, token in enumerate(read.tokens):
        c = bool(content[i])
        if token.kind != "text":
            counts[f"tag:{token.value}", c] += 1
        elif words[i]:
            kind = "word:link" if read.linked[i + 1] > read.linked[i] else "word"
            counts[kind, c] += int(words[i])
            if landmark and not marked[i]:
                counts["word:outside", c] += int(words[i])
    for e in read.elements:
        n = read.words[e.end + 1] - read.words[e.start]
        kept = int(good[e.end + 1] - good[e.start])
        for feature in set(read.features(e)):
            counts[feature, True] += kept
            counts[feature, False] += n - kept
    return counts


# Written examples: page furniture by element and class or role, around plain content.
FURNITURE = [
    ("nav", ""), ("div", 'class="menu"'), ("div", 'class="nav"'), ("ul", 'class="navbar"'), ("div", 'class="breadcrumbs"'), ("div", 'id="navigation"'),
    ("header", ""), ("div", 'class="masthead"'), ("div", 'id="header"'), ("div", 'role="banner"'), ("div", 'role="navigation"'),
    ("footer", ""), ("div", 'id="footer"'), ("div", 'class="copyright"'), ("div", 'role="contentinfo"'),
    ("aside", ""), ("div", 'class="sidebar"'), ("div", 'id="rail"'), ("div", 'class="widget"'), ("div", 'role="complementary"'),
    ("div", 'class="related"'), ("section", 'class="recommended"'), ("div", 'class="trending"'), ("div", 'class="teaser"'),
    ("div", 'class="notice"'), ("div", 'class="cookie"'), ("div", 'id="consent"'), ("div", 'class="gdpr"'), ("div", 'class="alert"'),
    ("div", 'class="banner"'), ("div", 'class="popup"'), ("div", 'class="modal"'), ("div", 'class="overlay"'), ("div", 'role="alert"'),
    ("div", 'role="dialog"'), ("div", 'class="disclaimer"'), ("div", 'class="paywall"'), ("dialog", ""),
    ("div", 'class="ad"'), ("div", 'class="advert"'), ("div", 'class="advertisement"'), ("ins", 'class="adsbygoogle"'),
    ("div", 'class="sponsored"'), ("div", 'class="sponsor"'), ("div", 'class="promo"'), ("div", 'class="promotion"'),
    ("form", ""), ("div", 'class="newsletter"'), ("div", 'class="subscribe"'), ("div", 'class="signup"'), ("div", 'class="login"'),
    ("div", 'class="search"'), ("div", 'role="search"'), ("div", 'class="form"'),
    ("section", 'id="comments"'), ("div", 'class="comment"'), ("ol", 'class="commentlist"'), ("div", 'id="respond"'),
    ("div", 'id="disqus_thread"'), ("div", 'class="disqus"'), ("div", 'class="replies"'), ("div", 'class="reply"'),
    ("div", 'class="share"'), ("div", 'class="social"'), ("div", 'class="toolbar"'), ("div", 'class="pagination"'),
    ("div", 'class="pager"'), ("noscript", ""), ("div", "hidden"), ("div", 'aria-hidden="true"'), ("div", 'style="display:none"'),
    ("button", ""), ("select", ""), ("template", ""),
]
CONTENT = [
    ("article", ""), ("main", ""), ("div", 'class="content"'), ("div", 'id="main"'), ("div", 'class="post"'), ("div", 'class="entry"'),
    ("section", 'class="story"'), ("div", 'class="article-body"'), ("div", 'class="text"'), ("div", 'role="main"'), ("td", ""),
    ("div", 'id="page"'), ("section", 'class="body"'),
]


def example_pages() -> list[str]:
    """Every furniture element once before, in and after every kind of content; and, in that, a
    part whose name only begins with the word for such furniture."""

    out = []
    links = "".join('<li><a href="#">word</a></li>' for _ in range(4))
    for tag, attributes in CONTENT:
        for furniture, its in FURNITURE:
            inner = f"<ul>{links}</ul>" if furniture in ("nav", "ul") else "<p>some words of it, <a href='#'>more</a></p>"
            item = f'<{furniture} {its} data-label="no">{inner}</{furniture}>'
            about = re.sub(r"(?:class|id)=\"([a-z]+)\"", r'id="\1-topic"', its) if "role" not in its else ""
            paragraphs = "<p>" + "word " * 40 + '<a href="#">link</a> <b>word</b></p><p>' + "word " * 25 + "</p>"
            title = "<h1>word word</h1>"
            title = f"<header>{title}</header>" if tag in ("article", "main") else title
            body = f"{title}{paragraphs}<h2>word</h2><ul><li>word word</li><li>word word</li></ul>{item}{paragraphs}"
            body += f"<section {about}>{paragraphs}</section>" if "topic" in about else ""
            out.append(f"<body>{item}<{tag} {attributes} data-label=\"yes\">{body}</{tag}>{item}</body>")
    remark = '<article data-label="no"><p>' + "word " * 30 + "</p></article>"
    prose = "<p>" + "word " * 40 + "</p>"
    out.append(f'<body><article data-label="yes">{prose}{remark}</article></body>')
    out.append(f'<body><form action="#" data-label="yes">{prose}{prose}</form></body>')
    return out


class PageWeights:
    """Log odds of content for words, tags and enclosing elements."""

    def __init__(self, counts: dict[tuple[str, bool], int]) -> None:
        names = {f for f, _ in counts}
        self.odds: dict[str, float] = {}
        for kind in ("word", "tag", "in", "class", "of", "role", "attr", "text"):
            group = sorted(f for f in names if f.split(":")[0] == kind)
            # Words and enclosing elements share one total: the words of the pages.
            base = group if kind == "tag" else [f for f in names if f.split(":")[0] == "word"]
            total = [sum(counts.get((f, c), 0) for f in base) + 1.0 for c in (False, True)]
            for f in group:
                out, inside = ((counts.get((f, c), 0) + 0.5) / total[c] for c in (False, True))
                self.odds[f] = float(np.clip(np.log(inside / out), -8, 8))
        self.word = max(self.odds.get("word", 0.5), 0.5)
        self.link = min(self.word, max(self.odds.get("word:link", -1.0), -1.0))
        self.outside = min(-self.word, self.odds.get("word:outside", -self.word))

    def tag(self, name: str) -> float:
        return min(SMALL_TAG, self.odds.get(f"tag:{name}", -0.5) / 4)

    def element(self, features: list[str]) -> float:
        """Below ``FURNITURE_ODDS`` for furniture, by all that is known of it together."""

        name = features[0].removeprefix("in:")
        told = features[1:] if name in GENERIC else features
        return sum(min(1.0, self.odds.get(f, 0.0)) for f in told)


def main_text(page: str | None, weights: PageWeights) -> str:
    if not page:
        return ""
    read = Page(page)
    # A generic element without attributes tells nothing.
    told = [(e, read.features(e)) for e in read.elements if e.attributes or e.name not in GENERIC]
    named = [e for e, features in told if weights.element(features) < FURNITURE_ODDS]
    by_tag = [e for e, features in told if features[0].removeprefix("in:") in NEVER]
    return _region_text(read, weights, named) or _region_text(read, weights, by_tag)


def _landmark(read: Page, islands: np.ndarray) -> Element | None:
    """The element that marks the article: one ``article``, else one ``main``, that holds words
    outside islands; of several articles the one with more of these words than all else."""

    plain = np.concatenate([[0], np.cumsum(np.diff(read.words) * ~islands)])
    held = [e for e in read.elements if e.name in ("article", "main") and e.within != "article" and not islands[e.start]]
    held = [e for e in held if plain[e.end + 1] > plain[e.start]]
    for name in ("article", "main"):
        same = [e for e in held if e.name == name]
        if len(same) == 1:
            return same[0]
        most = [e for e in same if 2 * (plain[e.end + 1] - plain[e.start]) > plain[-1]]
        if most:
            return most[0]
    return None


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and last place of the contiguous run with the largest sum; (0, -1) if none is above 0."""

    best, first, last, running, start = 0.0, 0, -1, 0.0, 0
    for i, score in enumerate(scores):
        if running <= 0:
            running, start = 0.0, i
        running += score
        if running > best:
            best, first, last = running, start, i
    return first, last


def _region_text(read: Page, weights: PageWeights, furniture: list[Element]) -> str:
    inside = read.inside(furniture)
    mark = _landmark(read, inside)
    islands = inside.tolist()
    words, linked = np.diff(read.words).tolist(), (np.diff(read.linked) > 0).tolist()
    scores = []
    for i, token in enumerate(read.tokens):
        marked = mark is not None and mark.start <= i <= mark.end
        if islands[i]:
            score = 0.0 if i and islands[i - 1] else weights.tag(token.value)
        elif token.kind == "text":
            weight = weights.word if marked else weights.outside if mark else weights.link if linked[i] else weights.word
            score = words[i] * weight
        else:
            score = SMALL_TAG if marked else weights.tag(token.value)
        scores.append(score)
    first, last = best_region(scores)
    blocks, block = [], []
    for i in range(first, last + 1):
        token = read.tokens[i]
        if token.kind == "text":
            if not islands[i]:
                block.append(token.value)
        elif token.value in BLOCKS:
            blocks.append(" ".join("".join(block).split()))
            block = []
        elif token.value in SPACED:
            block.append(" ")
    blocks.append(" ".join("".join(block).split()))
    return "\n\n".join(b for b in blocks if b)


def learn_weights(pages: DataFrame, max_pages: int = MAX_PAGES) -> PageWeights:
    """Weights from about ``max_pages`` pages that mark their article, and the examples.

    Different pages are chosen by a hash of their markup, each once however often it is
    repeated. Counts leave the tasks per feature, and the features of a bounded sample are
    bounded.
    """

    spark = pages.sparkSession
    marks = F.size(F.expr("regexp_extract_all(html, '(?i)<(article|main)[\\\\s>]', 1)"))
    marked = pages.select("html").filter(marks == 1)
    n = marked.select(F.approx_count_distinct(F.xxhash64("html"))).first()[0]
    place = F.pmod(F.xxhash64("html"), F.lit(1 << 30)) / float(1 << 30)
    sample = marked.filter(place < min(1.0, max_pages / max(n, 1))).select("html", F.lit("").alias("by")).dropDuplicates()
    examples = spark.createDataFrame([(p, 'data-label="yes"') for p in example_pages()], "html string, by string")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for page, by in zip(batch["html"], batch["by"]):
                mark = by or ("article" if re.search(r"(?i)<article[\s>]", page) else "main")
                total.update(page_counts(page, mark))
        rows = [(f, c, n) for (f, c), n in total.items()]
        yield pd.DataFrame(rows, columns=["feature", "content", "n"])

    counts = (
        sample.unionByName(examples).mapInPandas(count, "feature string, content boolean, n long")
        .groupBy("feature", "content").agg(F.sum("n").alias("n")).collect()
    )
    return PageWeights({(r["feature"], r["content"]): r["n"] for r in counts})


def extract_pages(pages: DataFrame, weights: PageWeights) -> DataFrame:
    """(page_id, url, text, n_chars) for every page."""

    schema = StructType([
        pages.schema["page_id"], pages.schema["url"], StructField("text", StringType()), StructField("n_chars", LongType()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), weights) for page in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return pages.select("page_id", "url", "html").mapInArrow(work, schema)
