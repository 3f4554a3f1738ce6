"""Periodic runs of words in each text, found in a grammar of the text.

A run is a stretch of consecutive words with smallest period q that is at
least ``max(LEAST, 2 q)`` words long and that no neighbouring word extends
keeping the period.  For each text:

* Words that can be in a run are picked first.  A run of length L and period q
  repeats L - q >= LEAST / 2 consecutive words at distance q, and the two
  copies cover it, so each of its words lies in a ``LEAST / 2``-gram that
  occurs twice in the text.  The others split the text into stretches.
* Re-Pair turns the stretches into a grammar: the most frequent pair of
  neighbouring symbols becomes a nonterminal until no pair occurs twice.  The
  places where a pair is replaced are the derivation positions of its
  nonterminal.  What is left of a stretch is joined by a balanced tree.
* A run's lowest node in the derivation holds it across the boundary of its
  two children.  So the runs across the boundary are computed once for each
  nonterminal, at its first place: a run of period q holds the word before
  the boundary or the one after it in an equal word q places on, or back,
  and so in an equal gram; these give the candidate periods, ascending, whose
  equal stretches are then measured.  Multiples of a found period are skipped.
* The runs go to all places of their nonterminal, and of each period the
  maximal intervals stay: a run cut off at the end of a nonterminal lies in
  the whole one, which is found higher up.

Texts are independent, so there is no shuffle; memory is that of one text.

Defined cases: a NULL text has no words; an empty or blank text has no runs and
an empty collapsed text; rows of equal or NULL doc_id are handled one by one;
an empty table yields no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices
from .words import mix, words

#: Words of the shortest run.
LEAST = 12
#: Words of a gram that every word of a run lies in twice.
GRAM = LEAST // 2
SLICE_BYTES = 4_000_000

_U = np.uint64

Run = tuple[int, int, int]


def repair(symbols: list[int]) -> tuple[list[tuple[int, int]], list[list[int]], list[int]]:
    """Re-Pair of a sequence; negative symbols part it and are never paired.

    Returns the lengths of the two sides of each rule, the places of each rule (index of the first word, in the order
    of replacement), and the start of each symbol that is left.
    """
    n = len(symbols)
    seq = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    size = [1] * n
    at: dict[tuple[int, int], dict[int, None]] = {}
    for i in range(n - 1):
        a, b = seq[i], seq[i + 1]
        if a >= 0 and b >= 0:
            at.setdefault((a, b), {})[i] = None
    queues: dict[int, deque] = {}
    for pair, places in at.items():
        if len(places) > 1:
            queues.setdefault(len(places), deque()).append(pair)
    top = max(queues, default=0)
    symbol = max(symbols, default=0) + 1
    sides, places_of = [], []

    def leave(i: int, pair: tuple[int, int]) -> None:
        places = at.get(pair)
        if places is not None:
            places.pop(i, None)

    while top > 1:
        queue = queues.get(top)
        if not queue:
            top -= 1
            continue
        pair = queue.popleft()
        places = at.get(pair)
        if places is None or len(places) < 2:
            continue
        if len(places) < top:  # replaced in part since it was queued
            queues.setdefault(len(places), deque()).append(pair)
            continue
        a, b = pair
        chosen = []
        if a == b:  # occurrences can overlap: from the left
            taken = -1
            for i in sorted(places):
                if i != taken:
                    chosen.append(i)
                    taken = after[i]
        else:
            chosen = list(places)
        del at[pair]
        if len(chosen) < 2:
            continue
        new: dict[tuple[int, int], None] = {}
        sides.append((size[chosen[0]], size[after[chosen[0]]]))
        for i in chosen:
            j = after[i]
            k, h = after[j], before[i]
            if h >= 0 and seq[h] >= 0:
                leave(h, (seq[h], a))
                p = (seq[h], symbol)
                at.setdefault(p, {})[h] = None
                new[p] = None
            if k < n and seq[k] >= 0:
                leave(j, (b, seq[k]))
                p = (symbol, seq[k])
                at.setdefault(p, {})[i] = None
                new[p] = None
            seq[i] = symbol
            size[i] += size[j]
            seq[j] = -1
            after[i] = k
            if k < n:
                before[k] = i
        places_of.append(chosen)
        for p in new:
            m = len(at.get(p, ()))
            if m > 1:
                queues.setdefault(m, deque()).append(p)
                top = max(top, m)
        symbol += 1
    left, i = [], 0
    while i < n:
        left.append(i)
        i = after[i]
    return sides, places_of, left


def _equal_after(x: np.ndarray, i: int, j: int, end: int) -> int:
    """How many words from ``i`` on equal those from ``j`` on, ``i < j``, up to ``end``."""
    done, step, most = 0, 32, end - j
    while done < most:
        m = min(step, most - done)
        differ = x[i + done:i + done + m] != x[j + done:j + done + m]
        k = int(differ.argmax())
        if differ[k]:
            return done + k
        done, step = done + m, step * 2
    return done


def _equal_before(x: np.ndarray, i: int, j: int, start: int) -> int:
    """How many words before ``i`` equal those before ``j``, ``i < j``, down to ``start``."""
    done, step, most = 0, 32, i - start
    while done < most:
        m = min(step, most - done)
        differ = (x[i - done - m:i - done] != x[j - done - m:j - done])[::-1]
        k = int(differ.argmax())
        if differ[k]:
            return done + k
        done, step = done + m, step * 2
    return done


def _nodes(sides, places, left, breaks) -> np.ndarray:
    """First word, boundary, end and number of each node; the nodes above the grammar have number -1."""
    out = [np.array([(p[0], p[0] + a, p[0] + a + b, k) for k, ((a, b), p) in enumerate(zip(sides, places, strict=True))],
                    np.int64).reshape(-1, 4)]
    starts = np.array(left, np.int64)
    part = np.searchsorted(breaks, starts, side="left")
    for lo, hi in zip(np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))),
                      np.flatnonzero(np.concatenate((part[1:] != part[:-1], [True]))) + 1, strict=True):
        # the last edge is the break behind the stretch
        edges = starts[lo:hi]
        width = 1
        while width < len(edges) - 1:
            first = np.arange(0, len(edges) - 1 - width, 2 * width)
            last = np.minimum(first + 2 * width, len(edges) - 1)
            out.append(np.stack((edges[first], edges[first + width], edges[last], np.full(len(first), -1)), axis=1))
            width *= 2
    return np.concatenate(out)


def _crossing(x: np.ndarray, lo: int, mid: int, hi: int, candidates: np.ndarray) -> list[tuple[int, int, int]]:
    """Start, end, smallest period of the runs in ``[lo, hi)`` that hold the words on both sides of ``mid``."""
    found: list[tuple[int, int, int]] = []
    while len(candidates):
        q = int(candidates[0])
        candidates = candidates[1:]
        for i in (mid - 1, mid - q):  # the word before the boundary equals one after it, or the one after it one before
            if i < lo or i + q >= hi or x[i] != x[i + q]:
                continue
            start = i - _equal_before(x, i, i + q, lo)
            end = i + q + _equal_after(x, i, i + q, hi)
            if end - start < max(LEAST, 2 * q) or not start < mid < end:
                continue
            if any(s == start and e == end for s, e, _ in found):
                continue
            found.append((start, end, q))
            # a multiple whose words lie in this run, or outside the node, gives the same stretch or none
            right = (mid - 1 + candidates < end) | (mid - 1 + candidates >= hi)
            back = (mid - candidates >= start) | (mid - candidates < lo)
            candidates = candidates[~((candidates % q == 0) & right & back)]
    return found


def runs_of(x: np.ndarray, grams: np.ndarray) -> list[Run]:
    """Runs (start, length, period) of the word ids ``x``, by start and period.

    ``grams`` has an id of the ``GRAM`` words from each place on.
    """
    n = len(x)
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    if not same.any():
        return []
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    edge[at] += 1
    np.add.at(edge, at + GRAM, -1)
    covered = np.cumsum(edge[:-1]) > 0
    # stretches in a row, each with a break behind it
    place = np.flatnonzero(covered)
    cut = np.flatnonzero(np.diff(place) > 1) + 1
    source = np.insert(place, cut, -1)
    source = np.append(source, -1)
    breaks = np.flatnonzero(source < 0)
    y = np.where(source < 0, -1, x[source])
    y[breaks] = -1 - np.arange(len(breaks))
    sides, places, left = repair(y.tolist())
    nodes = _nodes(sides, places, left, breaks)
    nodes = nodes[nodes[:, 2] - nodes[:, 0] >= LEAST]
    if not len(nodes):
        return []
    m = len(y)
    # the gram at each place of a stretch; the last places have none
    whole = source >= 0
    full = np.zeros(m, bool)
    full[:m - GRAM + 1] = np.lib.stride_tricks.sliding_window_view(whole, GRAM).all(axis=1)
    g = np.full(m, -1, np.int64)
    distinct, g[full] = np.unique(grams[source[full]], return_inverse=True)
    order = np.lexsort((np.arange(m), g))
    rank = np.empty(m, np.int64)
    rank[order] = np.arange(m)
    later, earlier = np.full(m, m, np.int64), np.full(m, -1, np.int64)
    same = (g[order][1:] == g[order][:-1]) & (g[order][1:] >= 0)
    later[order[:-1][same]] = order[1:][same]
    earlier[order[1:][same]] = order[:-1][same]
    lo, mid, hi = nodes[:, 0], nodes[:, 1], nodes[:, 2]
    live = np.zeros(len(nodes), bool)
    for d in range(GRAM):
        i = mid - 1 - d
        ok = i >= lo
        live |= ok & (later[np.maximum(i, 0)] + GRAM <= hi)
        j = mid - d
        ok = (j >= lo) & (j + GRAM <= hi)
        live |= ok & (earlier[np.clip(j, 0, m - 1)] >= lo)
    group_end = np.searchsorted(g[order], np.arange(len(distinct)), side="right")
    out: dict[int, list[tuple[int, int]]] = {}
    for a, b, c, k in nodes[live].tolist():
        shifts = []
        for i in range(max(b - GRAM, a), min(b + 1, c - GRAM + 1)):
            if g[i] < 0:
                continue
            # places of the same gram in the node, ascending
            own = order[rank[i] + 1:group_end[g[i]]]
            shifts.append(own[:np.searchsorted(own, c - GRAM, side="right")] - i)
            first = group_end[g[i] - 1] if g[i] else int((g < 0).sum())
            own = order[first:rank[i]]
            shifts.append(i - own[np.searchsorted(own, a):])
        if not shifts:
            continue
        candidates = np.unique(np.concatenate(shifts))
        candidates = candidates[2 * candidates <= c - a]
        for s, e, q in _crossing(y, a, b, c, candidates):
            for p in places[k] if k >= 0 else (a,):
                out.setdefault(q, []).append((s + p - a, e + p - a))
    found = []
    for q, intervals in out.items():
        reach = -1
        for s, e in sorted(intervals, key=lambda z: (z[0], -z[1])):
            if e > reach:
                found.append((int(source[s]), e - s, q))
                reach = e
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of ``n`` words stay when each run keeps its first period only."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


#: Turns a doc_id and a number of words into the order of the words to look at, or None for the words as they are.
Edit = Callable[[int | None, int], np.ndarray | None]


def repeat_some(doc_id: int | None, n: int) -> np.ndarray | None:
    """The edit of the contract: every tenth document repeats a part of itself (a NULL doc_id has no hash: none)."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def detect(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """``doc_id, runs, collapsed`` of every document: its runs, and its words without the repeats, joined by spaces."""
    schema = "doc_id bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary"
    types = [pa.int64(), pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])),
             pa.binary()]

    def found(batches):
        for batch in batches:
            for part in text_slices(batch, most=SLICE_BYTES):
                texts = part.column("text").fill_null("")
                w = words(texts)
                hashes, ends = w.hashes(fold=False), np.cumsum(w.counts)
                runs, collapsed = [], []
                for doc_id, text, n, end in zip(part.column("doc_id").to_pylist(), texts, w.counts.tolist(),
                                                ends.tolist(), strict=True):
                    own = text.as_py().encode().split()  # at the white space of the words
                    h = hashes[end - n:end]
                    at = edit(doc_id, n) if edit else None
                    if at is not None:
                        own, h = [own[i] for i in at.tolist()], h[at]
                    some: list[Run] = []
                    if n >= LEAST:
                        grams = np.zeros(n - GRAM + 1, np.uint64)
                        for d in range(GRAM):
                            grams = mix(grams + h[d:n - GRAM + 1 + d])
                        if len(np.unique(grams)) < len(grams):
                            number: dict[bytes, int] = {}
                            x = np.array([number.setdefault(word, len(number)) for word in own], np.int64)
                            some = runs_of(x, grams)
                    runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in some])
                    if some:
                        stay = kept_words(n, some)
                        own = [own[i] for i in np.flatnonzero(stay).tolist()]
                    collapsed.append(b" ".join(own))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(runs, types[1]), pa.array(collapsed, types[2])],
                    names=["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(found, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def run_digests(docs: DataFrame) -> DataFrame:
    """The contract's row of each document, edited as it says: its longest run and digests of all runs and kept words."""
    found = detect(docs, repeat_some)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat_ws("", F.transform(lines, lambda s: F.concat(s, F.lit("\n"))))
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    named = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"),
                         F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return named.select(
        "doc_id", "n_runs", F.col("top.start").alias("start"), (-F.col("top.l")).alias("length"),
        F.col("top.period").alias("period"), F.expr("-1000 * top.l div top.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
