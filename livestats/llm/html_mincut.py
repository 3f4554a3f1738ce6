"""Main text of web pages by minimum-cut labelling of text blocks.

A page is cut into text blocks with the open elements around each.  A linear
classifier over tag context, names, link share and length gives each block a
score: positive scores become capacities from the source (content), negative
ones capacities to the sink (boilerplate).  Blocks that follow each other and
blocks of the same container are joined by smoothness edges.  The blocks on the
source side of the minimum cut, found by maximum flow, are the main text.

Defined cases: NULL or empty html gives an empty text; text inside a block has
its white space turned into one space, ``br`` counts as white space; blocks
join by one line break in page order; markup that is cut off at the end of the
page is dropped; a skipped element (script, button, svg) without an end ends at
the next block or is read on; a name such as ``no-sidebar`` or ``menu-open``
tells a state and counts for nothing, and a doubtful name (``legal``,
``search``) does not when its element holds most of the sentences and no other
part is marked as main; rows are handled one by one, so NULL ids, repeated rows and
other columns do no harm.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|</?\Z", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORD = re.compile(r"[a-z0-9]+")

# Element kinds of HTML.
_SKIPPED = frozenset("script style template noscript svg math iframe object canvas audio video title textarea select "
                     "option button head".split())
_RAW = frozenset("script style textarea title noscript iframe".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                    "strike strong sub sup time tt u var wbr img input br acronym".split())
_AWAY = frozenset("nav footer aside form menu dialog fieldset".split())
_MAIN = frozenset("article main".split())
_CLOSES_P = frozenset("p div ul ol dl li table section article main header footer nav aside form h1 h2 h3 h4 h5 h6 "
                      "blockquote pre figure hr fieldset address details dialog menu".split())
# Words of class, id and role that name a part of a page.
_AWAY_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored promo promoted promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs masthead footer sidebar sidenav aside complementary "
    "contentinfo widget widgets cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "dialog newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "comment comments commentlist reply replies respond disqus discussion pagination pager toolbar copyright legal "
    "disclaimer search hidden".split())
# Words that make a name the state of an element and not its part, first or in the middle, and last.
_STATE_BEFORE = frozenset("no not has have with without is hide show".split())
_STATE_AFTER = frozenset("open opened closed active inactive enabled disabled on off visible collapsed loaded ready".split())
# Names that an element with most of the text may carry and still be the main text.
_DOUBTFUL = frozenset(
    "legal copyright disclaimer search social share sharing banner promo promotion promoted notice notices alert widget "
    "widgets overlay signup login subscribe subscription toolbar".split())
# Elements of a head, and those that end an unclosed button, select, svg or math.
_OF_HEAD = frozenset("head title meta link script style base noscript template".split())
_BREAKS_OUT = frozenset("p article section main header footer nav aside form h1 h2 h3 h4 h5 h6 ul ol dl table blockquote "
                        "pre".split())
_BROKEN_OUT_OF = frozenset("button select option svg math".split())
_MAIN_WORDS = frozenset("article content post entry story main articlebody".split())

#: Scores, in thousandths of a log-odds unit or so; capacities of the flow.
IN_MAIN, IN_NAMED_MAIN, OUTSIDE_MAIN, AWAY, NO_MAIN = 2000, 1200, -1500, -6000, 200
LONG_TEXT, SENTENCE, SHORT_TEXT, LINKED, LINKED_IN_MAIN = 1000, 400, -500, -2500, -1000
NEXT_TO, SAME_CONTAINER = 150, 350
#: Characters that end a sentence.
ENDS = ".!?…\"”"


class Block:
    __slots__ = ("container", "doubts", "links", "marks", "parts", "size", "text", "tag")

    def __init__(self, container: int, marks: tuple[int, int], doubts: tuple[int, ...], tag: str):
        self.container, self.marks, self.doubts, self.tag = container, marks, doubts, tag
        self.parts: list[str] = []
        self.size = self.links = 0
        self.text = ""


def _names(attributes: str) -> tuple[set[str], set[str], bool]:
    """Words of class, id and role that name a part of a page, words of main parts, and whether the element is hidden.

    A name such as ``no-sidebar`` or ``menu-open`` tells a state and no part.
    """
    away: set[str] = set()
    main: set[str] = set()
    hidden = False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            hidden = True
        elif key == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
        elif key in ("class", "id", "role"):
            for name in value.split():
                words = _WORD.findall(name)
                if not words or len(words) > 1 and (words[-1] in _STATE_AFTER or not _STATE_BEFORE.isdisjoint(words[:-1])):
                    continue
                main.update(_MAIN_WORDS.intersection(words))
                own = _AWAY_WORDS.intersection(words)
                if "header" in words and words[0] not in _MAIN_WORDS:
                    own |= {"header"}
                if words[-1] in ("article", "story", "articlebody"):  # as in search-article
                    own = own - _DOUBTFUL
                away |= own
    return away, main, hidden


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order.  ``marks`` is (main rank 0-2, away elements around it)."""
    out: list[Block] = []
    # open block-level elements: tag, container number, main rank, number of away elements, numbers of doubtful ones
    stack: list[tuple[str, int, int, int, tuple[int, ...]]] = [("", 0, 0, 0, ())]
    n_open: dict[str, int] = {}
    n_containers, in_link, skipping, current = 1, False, 0, None
    skip_tag, inside_foreign = "", False
    never_closed: set[str] = set()

    def add(text: str) -> None:
        nonlocal current
        if skipping or not text:
            return
        if current is None:
            if text.isspace():
                return
            tag, container, main, away, doubts = stack[-1]
            # the block's own paragraph is no container
            if tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li") and len(stack) > 1:
                container = stack[-2][1]
            current = Block(container, (main, away), doubts, tag)
            out.append(current)
        text = entities.unescape(text) if "&" in text else text
        current.parts.append(text)
        current.size += len(text)
        if in_link:
            current.links += len(text)

    def closes(tag: str, at: int) -> bool:
        """Whether an end tag follows."""
        if tag not in never_closed and not re.compile(f"</{re.escape(tag)}\\b", re.I).search(page, at):
            never_closed.add(tag)
        return tag not in never_closed

    def close(tag: str) -> None:
        while len(stack) > 1:
            name = stack.pop()[0]
            n_open[name] -= 1
            if name == tag:
                return

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if skipping:
            if name == "foreignobject":
                inside_foreign = not closing
            if skip_tag == "head" and not closing and name in _RAW:
                found = re.compile(f"</{name}\\b[^>]*(?:>|\\Z)", re.I).search(page, at)
                at = found.end() if found else end
            elif name == skip_tag:
                # a button, an option and a head can't hold another one
                skipping = skipping - 1 if closing else skipping + (name in ("svg", "math", "object", "template"))
                if not closing and not closes(name, at) and name not in _BROKEN_OUT_OF:
                    skipping = 0
            elif not closing and (name not in _OF_HEAD if skip_tag == "head" else
                                  skip_tag in _BROKEN_OUT_OF and not inside_foreign and (
                                      name in _BREAKS_OUT or name == "div" and skip_tag in never_closed)):
                skipping = 0
            if skipping or name == skip_tag:
                continue
            inside_foreign = False
        if name in _SKIPPED:
            if not closing and not attributes.endswith("/"):
                if name in _RAW:
                    found = re.compile(f"</{name}\\b[^>]*(?:>|\\Z)", re.I).search(page, at)
                    at = found.end() if found else end
                    if name in ("script", "style", "noscript"):
                        add(" ")
                elif closes(name, at) or name == "head" or name in _BROKEN_OUT_OF:  # else what never closes is read on
                    skipping, skip_tag, inside_foreign = 1, name, False
            continue
        if name in _INLINE:
            if name == "a":
                in_link = not closing
            elif name == "br":
                add(" ") if current is not None else None
            continue
        current, in_link = None, False
        if closing:
            if n_open.get(name):
                close(name)
            continue
        if name in _VOID or attributes.endswith("/") and name not in _CLOSES_P:
            continue
        if name in _CLOSES_P and stack[-1][0] == "p":
            close("p")
        if name == "li" and stack[-1][0] == "li" or name in ("td", "th") and stack[-1][0] in ("td", "th"):
            close(stack[-1][0])
        _, _, main, away, doubts = stack[-1]
        names, main_names, hidden = _names(attributes) if attributes else (set(), set(), False)
        own_away = hidden or name in _AWAY or name == "header" and main < 2
        if name in _MAIN:
            own_away = own_away or bool(names & {"comment", "comments", "reply"})
        elif name not in ("html", "body"):
            if main == 2:
                names.discard("header")
            if names and not own_away and names <= _DOUBTFUL:
                doubts = (*doubts, n_containers)
            else:
                own_away = own_away or bool(names)
        rank = 2 if name in _MAIN else 1 if main_names and name != "body" else 0
        stack.append((name, n_containers, max(main, rank), away + own_away, doubts))
        n_open[name] = n_open.get(name, 0) + 1
        n_containers += 1
    for b in out:
        b.text = " ".join("".join(b.parts).split())
    return settle_doubts([b for b in out if b.text])


def settle_doubts(blocks: list[Block]) -> list[Block]:
    """Elements of a doubtful name are away elements, unless they hold most of the page's sentences."""
    whole, held = 0, dict.fromkeys((d for b in blocks for d in b.doubts), 0)
    if not held:
        return blocks
    for b in blocks:
        if not b.marks[1] and 2 * b.links <= b.size and (b.text[-1] in ENDS or b.text.count(" ") >= 11):
            whole += b.size
            for d in b.doubts:
                held[d] += b.size
    has_main = any(b.marks[0] and not b.marks[1] and not b.doubts for b in blocks)
    for b in blocks:
        main, away = b.marks
        # beside a main part that is free of doubt, or with less than most of the text, the name counts
        b.marks = main, away + sum(2 * held[d] <= whole or has_main for d in b.doubts)
    return blocks


def block_scores(blocks: list[Block]) -> np.ndarray:
    """The classifier: a positive score speaks for content."""
    best = max((b.marks[0] for b in blocks if not b.marks[1]), default=0)
    scores = []
    for b in blocks:
        main, away = b.marks
        score = (0, IN_NAMED_MAIN, IN_MAIN)[main]
        if best and main < best:
            score = OUTSIDE_MAIN * (best - main)
        elif not best:
            score = NO_MAIN
        score += AWAY * min(away, 2)
        n_words = b.text.count(" ") + 1
        if n_words >= 12:
            score += LONG_TEXT
        elif n_words <= 3 and b.tag not in ("h1", "h2", "h3", "h4", "p"):
            score += SHORT_TEXT
        if b.text[-1] in ENDS:
            score += SENTENCE
        # a list of links inside a marked main part belongs to it
        score += (LINKED if main < 2 else LINKED_IN_MAIN) * b.links // max(b.size, 1)
        if not main and not best and b.tag in ("p", "h1", "h2", "h3"):
            score += SENTENCE
        scores.append(score)
    return np.array(scores, np.int64)


def smoothness(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Edges ``(block, block, capacity)`` for neighbours and for the next block of a container."""
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEXT_TO))
        if b.container in last:
            edges.append((last[b.container], i, SAME_CONTAINER))
        last[b.container] = i
    return edges


def min_cut(scores: np.ndarray, edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay on the source side of the minimum cut (maximum flow by Dinic's algorithm)."""
    n = len(scores)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def connect(a: int, b: int, forth: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, s in enumerate(scores.tolist()):
        if s > 0:
            connect(source, i, s, 0)
        elif s < 0:
            connect(i, sink, -s, 0)
    for a, b, c in edges:
        connect(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for k, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if not room[e])
                a = to[path[k] ^ 1]
                del path[k:]
                continue
            while turn[a] < len(out[a]):
                e = out[a][turn[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(out[a]):
                path.append(out[a][turn[a]])
                a = to[path[-1]]
            elif path:
                e = path.pop()
                a = to[e ^ 1]
                turn[a] += 1
            else:
                break


def main_text(page: str | None) -> str:
    blocks = blocks_of(page) if page else []
    if not blocks:
        return ""
    keep = min_cut(block_scores(blocks), smoothness(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""

    def texts(batches):
        for batch in batches:
            found = [main_text(p) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(texts, "page_id bigint, url string, text string, n_chars bigint")
