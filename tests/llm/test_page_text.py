import html
import random
import re
import time
from collections import Counter

import pytest
from sonoledger.llm.page_text import (
    PageWeights, best_region, example_pages, extract_pages, learn_weights, main_text, page_counts, tokens,
)


def written_weights():
    counts = Counter()
    for page in example_pages():
        counts.update(page_counts(page, 'data-label="yes"'))
    return PageWeights(counts)


WEIGHTS = written_weights()
BODY = "<p>" + "one two three " * 10 + "</p>"
TEXT = " ".join("one two three".split() * 10)


def test_furniture_goes():
    for around in (
        "<nav><a href='#'>Home</a></nav>", "<footer>All rights</footer>",
        "<aside><p>side words</p></aside>", "<div class='cookie-notice'>We use cookies</div>", "<div class='ad'>Buy</div>",
        "<form><label>Mail</label></form>", "<script>var a='</p>';</script>", "<style>p{}</style>",
        "<section id='comments'><p>first comment</p></section>", "<!-- hidden <p>words</p> -->", "<div hidden>never seen</div>",
    ):
        for page in (f"{around}<div>{BODY}</div>{around}", f"<article>{BODY}{around}{BODY}</article>"):
            want = TEXT if "<article>" not in page else f"{TEXT}\n\n{TEXT}"
            assert main_text(page, WEIGHTS) == want, page


def test_prose_stays_whatever_it_is_called():
    for part in (
        "<section id='search-engines'><h2>Kept</h2><p>words</p></section>", "<p id='login'>Kept words</p>",
        "<p class='alert-text'>Kept words</p>", "<h2 id='discussion'>Kept</h2>", "<blockquote class='social-quote'>Kept</blockquote>",
        "<section id='discussion'><p>Kept words</p></section>", "<p>Kept <a href='#'>and linked</a></p>",
        "<table><tr><td>Kept</td><td></td><td></td></tr></table>",
    ):
        for page in (f"<article>{BODY}{part}{BODY}</article>", f"<div class='content'>{BODY}{part}{BODY}</div>"):
            text = main_text(page, WEIGHTS)
            assert "Kept" in text and text.startswith(TEXT) and text.endswith(TEXT), page


def test_what_follows_a_marked_article_goes():
    remark = "<p>" + "I do not agree at all " * 20 + "</p>"
    parts = (
        f"<div class='rdr'>{remark * 4}</div>", "<div class='more'><h3>Read next</h3><a href='#'>One</a><a href='#'>Two</a></div>",
        f"<article class='x'>{remark}</article>",
    )
    for part in parts[:2]:
        assert main_text(f"<article>{BODY}</article>{part}", WEIGHTS) == TEXT
        assert main_text(f"{part}<main>{BODY}</main>{part}", WEIGHTS) == TEXT
    # An article in an article is a remark; cards beside the main text are not the page.
    assert main_text(f"<article>{BODY}{parts[2]}{BODY}</article>", WEIGHTS) == f"{TEXT}\n\n{TEXT}"
    card = "<article><p>card</p></article>"
    assert TEXT in main_text(f"<div>{BODY * 5}</div>{card}{card}", WEIGHTS)


def test_names_of_containers():
    remark = "<p>" + "a long remark " * 20 + "</p>"
    for name in ("related-posts", "comment-body", "comments-area", "ad-slot", "topNav", "newsletter-form", "sidebar-inner"):
        part = f"<div class='{name}'>{remark}</div>"
        for page in (f"<article>{BODY}{part}{BODY}</article>", f"<div>{BODY}{part}{BODY}</div>"):
            assert main_text(page, WEIGHTS) == f"{TEXT}\n\n{TEXT}", page


def test_form_around_the_page():
    page = f"<form action='#'><div id='nav'><a href='#'>Home</a></div>{BODY}{BODY}<form><p>Your name</p></form></form>"
    assert TEXT in main_text(page, WEIGHTS)
    assert "Your name" not in main_text(f"<div>{BODY}<form><p>Your name</p></form></div>", WEIGHTS)


@pytest.mark.parametrize("seed", range(40))
def test_region_is_the_best_of_all(seed):
    draw = random.Random(seed)
    scores = [draw.choice([-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 3.0]) for _ in range(draw.randrange(30))]
    first, last = best_region(scores)
    sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
    assert sum(scores[first : last + 1]) == max([0.0, *sums])


def test_time_is_linear_in_nesting():
    n = 50_000
    began = time.monotonic()
    assert main_text("<article>" + "<div class='x'>" * n + "deep words" + "</div>" * n + "</article>", WEIGHTS) == "deep words"
    assert main_text("<b class='x'>" * n + "</p></i></div>" * n + "words", WEIGHTS) == "words"
    assert time.monotonic() - began < 60  # the square of this depth takes many minutes


def test_headers():
    assert main_text(f"<header>Site name here</header><div>{BODY}</div>", WEIGHTS) == TEXT
    # An article's own header holds its title.
    assert main_text(f"<article><header><h1>Title</h1></header>{BODY}</article>", WEIGHTS) == f"Title\n\n{TEXT}"


def test_references_space_and_blocks():
    page = "<article><h1>A &amp; B</h1><p>x\n  <b>y</b>&nbsp;z<br>w</p><p> </p><ul><li>1<li>2</ul>" + BODY + "</article>"
    assert main_text(page, WEIGHTS) == "A & B\n\nx y z w\n\n1\n\n2\n\n" + TEXT
    assert main_text("a &lt; b & c", WEIGHTS) == "a < b & c"


def test_odd_pages():
    for page in (None, "", "<p></p>", "<!-- open", "<", "<<>>", "</div></p>", "<script>x"):
        assert isinstance(main_text(page, WEIGHTS), str)
    assert main_text("<p>only</p>", WEIGHTS) == "only"
    assert main_text("<div class='content-with-sidebar'>" + BODY + "</div>", WEIGHTS) == TEXT
    assert main_text("<div class='ad'>all of it</div>", WEIGHTS) == "all of it"
    long = "<p>" + "w " * 300_000 + "</p>"
    assert main_text(long, WEIGHTS).count("w") == 300_000
    assert list(tokens('<a title="x > y">t</a>'))[0].value == "a"


def test_whole_table_against_the_known_layout(spark, table):
    pages = table("pages")
    got = {r.page_id: r for r in extract_pages(pages, learn_weights(pages)).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for row in rows:
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", row.html, re.S)[1]
        blocks = [re.sub(r"</?b>|<br>", lambda m: " " if m[0] == "<br>" else "", b) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(" ".join(html.unescape(b).split()) for b in blocks if b.strip())
        assert got[row.page_id].text == want
        assert got[row.page_id].n_chars == len(want)


def test_copies_of_one_page_count_once_in_the_sample(spark):
    page = f"<body><div class='zig'>{BODY}</div><article>{BODY}</article></body>"
    other = f"<body><div class='zag'>{BODY}</div><article>{BODY} more</article></body>"
    schema = "page_id long, url string, html string"
    few = learn_weights(spark.createDataFrame([(1, "", page), (2, "", other)], schema))
    many = learn_weights(spark.createDataFrame([(i, "", page) for i in range(300)] + [(300, "", other)], schema))
    assert few.odds == many.odds and few.odds["class:zig"] < -1.5


def test_empty_table_and_null_rows(spark):
    schema = "page_id long, url string, html string, text int, n_chars string"
    empty = spark.createDataFrame([], schema)
    assert extract_pages(empty, learn_weights(empty)).collect() == []
    rows = spark.createDataFrame([(1, None, None, 1, ""), (None, "u", "<p>x</p>", 2, ""), (None, "u", "<p>x</p>", 2, "")], schema)
    got = sorted((r.text, r.n_chars) for r in extract_pages(rows, WEIGHTS).collect())
    assert got == [("", 0), ("x", 1), ("x", 1)]
