import random
import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from livestats.llm import jaccard_join
from livestats.llm.jaccard_join import (
    LAYOUTS, bands_of, components, entries, join, keep_one, layout_counts, sketch, sketch_distance)
from livestats.llm.queries import QUERIES

from ..conftest import SF_SMALL
from .helpers import documents, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    having = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            having[g].append(i)
    shared = defaultdict(int)
    for at in having.values():
        for x, i in enumerate(at):
            for j in at[x + 1:]:
                shared[i, j] += 1
    for (i, j), n in shared.items():
        if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def families(seed):
    r = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for family in range(24):
        base = [f"w{r.randrange(5000)}" for _ in range(r.choice([5, 6, 8, 12, 20, 40, 70, 130, 400]))]
        if family % 3 == 0:
            at = r.randrange(len(base) + 1)
            base[at:at] = passage
        for _ in range(r.choice([1, 2, 5, 25])):
            words = list(base)
            for _ in range(r.choice([0, 0, 1, 2, max(1, len(words) // 30), len(words) // 12])):
                at, op = r.randrange(len(words)), r.random()
                if op < 0.4:
                    words[at] = f"e{r.randrange(99999)}"
                elif op < 0.7 or len(words) == 1:
                    words.insert(at, f"e{r.randrange(99999)}")
                else:
                    del words[at]
            if r.random() < 0.15:
                words += [f"w{r.randrange(5000)}" for _ in range(len(words) // r.choice([4, 5, 6, 10]))]
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize(("seed", "options"), [(1, {}), (2, {"forced_layout": 2}), (3, {"forced_layout": 0}),
                                               (4, {"forced_layout": 1})])
def test_components_equal_brute_force(spark, seed, options):
    rows = families(seed) + [(d if d is None else 5000 + d, t) for d, t in odd_rows()]
    assert rows_of(join(documents(spark, rows), **options)) == brute(rows)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert rows_of(QUERIES["op9_jaccard_join"](spark, SF_SMALL)) == brute(rows)


@pytest.mark.parametrize("layout", range(len(LAYOUTS)))
def test_similar_sets_share_an_entry(layout):
    """The pigeonhole: whenever the larger set's allowances suffice, a similar smaller set shares an entry."""
    r = np.random.default_rng(layout)
    tried = 0
    for _ in range(400):
        n = int(r.choice([3, 5, 9, 30, 100, 300]))
        s = r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        gone, new = r.integers(0, n // 7 + 1, 2)
        t = np.concatenate((s[gone:], r.integers(0, 1 << 63, int(new), dtype=np.uint64)))
        s, t = np.unique(s), np.unique(t)
        both = len(np.intersect1d(s, t))
        if 4 * both < 3 * (len(s) + len(t) - both):
            continue
        large, small = (s, t) if len(s) >= len(t) else (t, s)
        assert sketch_distance(sketch(s), sketch(t)) <= len(s) + len(t) - 2 * both
        band = bands_of(len(small))[0]
        assert band in bands_of(len(large))
        if layout_counts(large, band)[layout][0] >= 0:
            a, b = (set((entries(x, band, LAYOUTS[layout]) >> np.uint64(1)).tolist()) for x in (large, small))
            assert a & b
            tried += 1
    assert tried > 20


def test_a_layout_suffices_for_every_set():
    r = np.random.default_rng(9)
    for n in (*range(1, 40), 500):
        s = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
        for band in bands_of(len(s)):
            assert max(spare for spare, _, _ in layout_counts(s, band)) >= 0


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 50)]
    got = {r.c: r.root for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{100 + i: 100 for i in range(50)}}


def test_cells_equal_pairs_as_rows(spark, monkeypatch):
    """Small blocks, so that groups are cut into many cells, give the links of the plain form."""
    monkeypatch.setattr(jaccard_join, "SMALL", 2)
    monkeypatch.setattr(jaccard_join, "BLOCK", 5)
    monkeypatch.setattr(jaccard_join, "CELL_ROWS", 3)
    rows = families(5)
    assert rows_of(join(documents(spark, rows))) == brute(rows)


def test_a_family_of_sets_that_are_alike_but_not_similar(spark):
    r = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(150):
        words = list(base)
        for _ in range(r.choice([1, 3, 6, 8])):
            words[r.randrange(len(words))] = f"e{r.randrange(10**6)}"
        rows.append((d, " ".join(words)))
    assert rows_of(join(documents(spark, rows))) == brute(rows)


@pytest.mark.parametrize("seed", range(4))
def test_cell_pairs_lose_no_similar_pair(seed):
    r = np.random.default_rng(seed)
    base = r.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate((base[r.integers(0, 40):], r.integers(0, 1 << 63, r.integers(0, 60), dtype=np.uint64))))
            for _ in range(60)]
    n, side = np.array([len(s) for s in sets]), r.integers(0, 2, 60)
    i, j = jaccard_join.cell_pairs(np.arange(60), n, np.arange(60), np.ones(60, bool), [sketch(s) for s in sets], side)
    found = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
    for a in range(60):
        for b in range(a):
            if side[a] != side[b] and jaccard_join.similar(sets[a], sets[b]):
                assert (b, a) in found


def test_merged_groups_keep_every_meeting_and_compare_no_more(spark):
    r = random.Random(4)
    family = r.sample(range(1000), 60)
    sets = {g: r.sample(family, 45) for g in range(30)} | {100 + g: r.sample(range(1000), 20) for g in range(20)}
    rows = [(g, len(cs), c, 50, c, r.random() < 0.5) for g, cs in sets.items() for c in cs]
    large = spark.createDataFrame(rows, "g long, size int, c long, n int, root long, asks boolean")
    asked = {(g, c) for g, _, c, _, _, asks in rows if asks}
    got = defaultdict(dict)
    for x in jaccard_join.merged(large).collect():
        assert x.c not in got[x.g]
        got[x.g][x.c] = x.asks
        assert x.n == 50 and x.root == x.c
    met = {(a, b) for cs in got.values() for a, asks in cs.items() if asks for b in cs}
    assert all((a, b) in met for g, a in asked for b in sets[g])
    assert sum(len(cs) ** 2 for cs in got.values()) <= sum(len(cs) ** 2 for cs in sets.values()) / 3
    assert jaccard_join.merged(large.limit(0)).collect() == []


def test_keep_one_of_rows_without_id_and_of_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (None, text + " more"), (7, "a b c d e f"), (7, text + " and"), (3, "a b c d e f"), (9, "z " + text)]
    kept = keep_one(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(3, "a b c d e f"), (7, text + " and")]
    alone = keep_one(documents(spark, rows[:2])).collect()
    assert len(alone) == 1 and alone[0].doc_id is None


def test_keep_one(spark):
    rows = [(3, "a b c d e f g h"), (1, "a b c d e f g h"), (2, "x y z"), (2, "x y z"), (4, ""), (5, None), (None, "q"),
            (None, "q"), (6, "l m n o p q r")]
    docs = documents(spark, rows)
    kept = keep_one(docs)
    assert kept.schema == docs.schema
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, "a b c d e f g h"), (2, "x y z"), (4, ""), (5, None), (6, "l m n o p q r"), (None, "q")], key=str)
    assert join(docs.limit(0)).collect() == [] and keep_one(docs.limit(0)).collect() == []


def test_a_forest_unites_what_all_pairs_of_a_cell_do():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate((base[r.integers(0, 60):], r.integers(0, 1 << 63, r.integers(0, 40), dtype=np.uint64))))
            for _ in range(700)]
    n, root, asks = np.array([len(s) for s in sets]), np.arange(700) // 2, r.random(700) < 0.8
    cell = (np.arange(700), n, root, asks, [sketch(s) for s in sets], None)
    every, some = jaccard_join.cell_pairs(*cell), jaccard_join.cell_pairs(*cell, forest=True)
    assert set(zip(*some, strict=True)) <= set(zip(*every, strict=True)) and len(some[0]) < 350 < len(every[0])
    after = [jaccard_join.uniting(*pairs, root)[1].tolist() for pairs in (every, some)]
    assert after[0] == after[1]


def test_sets_of_a_batch_are_counted_as_each_alone():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 2**64 - 1, n, dtype=np.uint64)) for n in (1, 2, 5, 9, 16, 31, 64, 65, 300, 700, 5000)]
    each = [(s, b) for s in sets for b in bands_of(len(s))]
    spare, n_entries, cost = jaccard_join.layout_counts_of(*map(list, zip(*each, strict=True)))
    for row, (s, b) in enumerate(each):
        for i, layout in enumerate(LAYOUTS):
            _, lengths, two = jaccard_join.segments(s, b, layout)
            assert n_entries[row, i] == len(entries(s, b, layout))
            assert spare[row, i] == len(lengths) + two.sum() - jaccard_join.most_different(len(s)) - 1
            assert cost[row, i] - n_entries[row, i] in (0, jaccard_join.EXPOSED)
    assert jaccard_join.class_keys(sets) == [jaccard_join.class_key(s) for s in sets]


def test_words_of_any_length_and_case_have_keys_of_their_own():
    words = ["a", "b\0", "a\0", "ab", "abcdefgh", "abcdefghi", "abcdefgh\0", "x" * 16, "x" * 17, "ÀÉ", "àÉ", "y" * 100_000,
             "y" * 99_999 + "z", "1" * 8 + "2" * 8 + "3", "2" * 8 + "1" * 8 + "3", "[", "{", "@", "`"]
    texts = [" ".join(words), " ".join(re.sub("[a-z]+", lambda m: m.group().upper(), w) for w in words)]
    keys = jaccard_join.words(pa.array(texts)).keys()
    assert len(set(keys.tolist())) == len(words) and (keys[:len(words)] == keys[len(words):]).all()


def test_memory_of_a_task_stays_small():
    texts = pa.array([" ".join(f"w{(i * 7919 + k) % 9973}" for k in range(400)) for i in range(3000)])
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    assert texts.nbytes > 6_000_000
    tracemalloc.start()
    for _ in jaccard_join._sets([batch]):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000
