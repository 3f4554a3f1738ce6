import itertools
import random

import numpy as np
import pytest

from livestats.llm.html_mincut import extract, main_text, min_cut
from livestats.llm.queries import QUERIES

from ..conftest import SF_SMALL


def brute_cut(scores, edges):
    n = len(scores)
    best = None
    for side in itertools.product((False, True), repeat=n):
        cost = sum(max(-s, 0) if keep else max(s, 0) for s, keep in zip(scores, side, strict=True))
        cost += sum(c for a, b, c in edges if side[a] != side[b])
        best = cost if best is None else min(best, cost)
    return best


def cost_of(scores, edges, side):
    cost = sum(max(-s, 0) if keep else max(s, 0) for s, keep in zip(scores, side, strict=True))
    return cost + sum(c for a, b, c in edges if side[a] != side[b])


def test_min_cut_is_minimal():
    r = random.Random(3)
    for _ in range(300):
        n = r.randrange(1, 9)
        scores = np.array([r.randrange(-9, 10) for _ in range(n)])
        edges = [(a, b, r.randrange(1, 7)) for a in range(n) for b in range(a + 1, n) if r.random() < 0.4]
        assert cost_of(scores, edges, min_cut(scores, edges)) == brute_cut(scores.tolist(), edges)


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   \n", ""), ("<html><head><title>T</title></head></html>", ""),
    ("<p>only a paragraph, which says something long enough to count.", "only a paragraph, which says something long "
     "enough to count."),
    ("<nav><a href=/>Home</a></nav><article><h1>Head &amp; line</h1><p>One\n  two&nbsp;three.<p>Four<br>five</article>"
     "<footer>&copy; me</footer>", "Head & line\nOne two three.\nFour five"),
    ("<article><p>Text of the article.</p><aside>see also</aside><div class='share-buttons'>Share</div>"
     "<section id=comments><article><p>A reader says that this is a very long and nice comment, thanks to all."
     "</p></article></section></article>", "Text of the article."),
    ("<article><p>a &lt;b&gt; c</p><script>if (a</p>b) '</article>'</script><p>d</p></article>", "a <b> c\nd"),
    ("<article><p>It is cut off here</p><p>right in the mar<b", "It is cut off here\nright in the mar"),
    ("<div id=cookie-notice><p>We use cookies to make this site work better for all of you, do agree now.</p></div>"
     "<div class='post-content'><p>The story of the day is told in this paragraph, at some length, as it should.</p>"
     "</div><form><label>Name</label> <input></form>",
     "The story of the day is told in this paragraph, at some length, as it should."),
])
def test_pages(page, text):
    assert main_text(page) == text


STORY = ("The story of the day is told in this paragraph, at some length, as it should be.",
         "A second paragraph goes on with what happened next, and it ends with a full stop too.")
BODY = "".join(f"<p>{x}</p>" for x in STORY)
TOLD = "\n".join(STORY)


@pytest.mark.parametrize("page", [
    # names that tell a state, or that the main part carries
    f"<div class='post no-sidebar'>{BODY}</div>", f"<div class='entry-content has-share'>{BODY}</div>",
    f"<div id='search-article'>{BODY}</div>", f"<div class='legal'>{BODY}</div>",
    f"<div class='page menu-open'><article>{BODY}</article></div>",
    f"<body class='single comments-open'><article>{BODY}</article></body>",
    f"<article class='comments-open'>{BODY}</article>", f"<div class='layout-with-banner'>{BODY}</div>",
    f"<div id='content' class='with-sidebar'>{BODY}</div>", f"<main class='nav-closed'>{BODY}</main>",
    f"<body class='has-cookie-notice'><div class='story'>{BODY}</div></body>",
    f"<div class='copyright'>{BODY}</div><div class='footer'>All rights are kept by the owner of this site.</div>",
    # the same names on parts that are not the main one
    f"<article>{BODY}</article><div class='legal'>Terms of use and privacy. They are long and they are dull.</div>",
    f"<div class='post'>{BODY}</div><div class='search'><p>Type a word and press enter to search all pages.</p></div>",
    f"<div class='sidebar-left'>Popular now</div><div class='post-content'>{BODY}</div><div class='social-share'>Share</div>",
    f"<div class='entry'>{BODY}</div><div class='comment-list'><p>A reader says that this is a very long comment. Nice.</p>"
    "</div>", f"<div class='entry'>{BODY}<div class='content-ad'>Buy one of these now, they are cheap.</div></div>",
    f"<div class='related-posts'><p>Another story that you may like to read as well.</p></div><div class='story'>{BODY}</div>",
    # heads and skipped elements without an end
    f"<html><head><title>T</title><meta name=a><article>{BODY}</article>",
    f"<head><title>T</title><script>if (a) document.write('<p>no</p>')</script><style>p > b {{}}</style><article>{BODY}",
    f"<head><title>T</title><body><article>{BODY}</article>",
    f"<article><svg><path d='M0'>{BODY}</article>", f"<article><select><option>one{BODY}</article>",
    f"<article><button>{BODY}</article>", f"<article><button><div>{STORY[0]}</div><div>{STORY[1]}</div></article>",
    f"<article><object>{BODY}</article>",
    f"<article><button>Menu<p>{STORY[0]}</p><p>{STORY[1]}</p><button>More</button></article>",
    f"<article><svg><title>x</title><foreignObject><p>drawn</p></foreignObject></svg>{BODY}</article>",
    f"<article><svg><svg><text>drawn</text></svg></svg>{BODY}</article>",
])
def test_names_and_open_elements(page):
    assert main_text(page) == TOLD


def test_a_list_of_links_inside_an_article_stays():
    links = "".join(f"<li><a href=/{x}>{x}</a></li>" for x in ("first source", "second source", "third"))
    assert main_text(f"<article>{BODY}<ul>{links}</ul></article>") == TOLD + "\nfirst source\nsecond source\nthird"
    assert main_text(f"<article>{BODY}<nav><ul>{links}</ul></nav></article>") == TOLD


def test_headers_of_an_entry_stay():
    page = f"<div class='site-header'>The Paper</div><div class='entry'><div class='entry-header'><h1>A head</h1></div>{BODY}</div>"
    assert main_text(page) == "A head\n" + TOLD


def test_many_open_elements_take_linear_time():
    page = "<article>" + "".join(f"<button>{i}<p>Paragraph number {i} has a few words.</p>" for i in range(3000)) + "</article>"
    assert main_text(page).count("\n") == 2999


def test_long_and_deep_pages():
    paragraphs = [f"Paragraph number {i} has a few words and ends." for i in range(4000)]
    page = "<nav>menu</nav><article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>"
    assert main_text(page) == "\n".join(paragraphs)
    assert main_text("<div>" * 20_000 + "<article><p>Deep text in here.</p></article>") == "Deep text in here."


def test_table_cases(spark):
    rows = [(None, None, None, 1), (1, "u", "", 2), (2, "u", "<article><p>Some text.</p></article>", 3),
            (2, "u", "<article><p>Some text.</p></article>", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in extract(pages).collect())
    assert got == [(0, "", 0), (1, "", 0), (2, "Some text.", 10), (2, "Some text.", 10)]
    assert extract(pages.limit(0)).collect() == []


def test_query_keeps_every_page(spark):
    got = QUERIES["op1_html_mincut"](spark, SF_SMALL).toPandas()
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").toPandas()
    assert sorted(got.page_id) == sorted(pages.page_id)
    assert (got.n_chars == got.text.str.len()).all()
    html = pages.set_index("page_id").html
    for r in got.itertuples():  # menus, adverts and footers of these pages
        assert "©" not in r.text
        advert = html[r.page_id].split('class="ad">')[1].split("</div>")[0]
        assert advert not in r.text.split("\n") or advert in html[r.page_id].split("<article>")[1]
