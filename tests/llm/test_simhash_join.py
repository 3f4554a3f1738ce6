import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from livestats.llm import simhash_join as sj

from .helpers import documents, odd_rows, prose


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    h = [xxhash.xxh64(g, 42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(f):
    """The smallest fingerprint that each one reaches."""
    f = sorted(set(f))
    root = {x: x for x in f}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    v = np.array(f, np.uint64)
    for i, x in enumerate(f):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1:] ^ np.uint64(x)) <= 3).tolist():
            a, b = find(x), find(f[i + 1 + j])
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in f}


def near_texts(seed=1):
    r = random.Random(seed)
    rows, base = [], [prose(n, s) for s, n in enumerate((40, 120, 200, 300, 60))]
    for i in range(260):
        w = r.choice(base).split()
        for _ in range(r.choice((0, 0, 1, 2, 5))):
            w[r.randrange(len(w))] = f"new{r.randrange(1000)}"
        rows.append((1000 - i, " ".join(w) if r.random() < 0.8 else prose(50, 100 + i)))
    return rows


def test_query_equals_brute_force(spark):
    rows = odd_rows() + near_texts() + [(None, "")]
    got = sorted((tuple(x) for x in sj.join(documents(spark, rows)).collect()), key=str)
    f = [plain_fingerprint(t) for _, t in rows]
    root = plain_components(f)
    least = {}
    for (i, _), x in zip(rows, f, strict=True):
        if i is not None:
            least[root[x]] = min(least.get(root[x], i), i)
    want = sorted(((i, f"{x:016x}", least.get(root[x])) for (i, _), x in zip(rows, f, strict=True)), key=str)
    assert got == want
    assert len(set(root.values())) < len(root)


def family(n, varying, seed):
    """Distinct fingerprints around one, of which only some bits vary."""
    r = random.Random(seed)
    centre, bits = r.getrandbits(64), r.sample(range(64), varying)
    out = set()
    while len(out) < n:
        x = centre
        for b in r.sample(bits, r.randrange(min(7, varying + 1))):
            x ^= 1 << b
        out.add(x)
    return list(out)


@pytest.mark.parametrize("small, large", [(256, 4096), (8, 60)])
def test_components_of_families_and_random_fingerprints(spark, monkeypatch, small, large):
    monkeypatch.setattr(sj, "SMALL", small)
    monkeypatch.setattr(sj, "LARGE", large)
    r = random.Random(7)
    f = set(family(500, 14, 1) + family(150, 40, 2) + [r.getrandbits(64) for _ in range(300)])
    # a set of a hot bucket without any link: the low half is equal, the others differ in four bits at least
    f |= {(x << 60 | x << 56 | x << 52 | x << 48 | x << 36) & (1 << 64) - 1 | 5 for x in range(16)}
    f = sorted(f)
    classes = spark.createDataFrame([(sj.signed(x), i) for i, x in enumerate(f)], "f long, first_id long")
    n, together = sj.bit_counts(classes)
    assert n == len(f)
    parts = sj.choose_partitions(together, n)
    p = np.diag(together) / n
    chance = np.array([sj.within(2 * p[b] * (1 - p[b])) for b in parts])
    rooted = sj.components(sj.links_of(sj.entries(classes, parts, chance / chance[:, :1])))
    got = {x["c"] % (1 << 64): x["root"] % (1 << 64) for x in rooted.collect()}
    want = plain_components(f)
    assert {frozenset(g) for g in groups({x: got.get(x, x) for x in f})} == {frozenset(g) for g in groups(want)}


def groups(root):
    for _, g in itertools.groupby(sorted(root, key=lambda x: root[x]), key=lambda x: root[x]):
        yield g


def test_thresholds_are_those_of_least_cost():
    r = np.random.default_rng(3)
    for m in (2, 3, 4, 6):
        cost = r.integers(1, 50, (30, m, sj.MOST + 1)).astype(float).cumsum(axis=2)
        t, total = sj.allocate(cost)
        assert ((t + 1).sum(axis=1) == sj.MOST + 1).all()
        for x in range(30):
            every = [c for c in itertools.product(range(-1, sj.MOST + 1), repeat=m) if sum(c) + m == sj.MOST + 1]
            price = [sum(cost[x, i, k] for i, k in enumerate(c) if k >= 0) for c in every]
            assert total[x] == min(price)


def test_correlated_bits_share_a_partition():
    r = np.random.default_rng(2)
    bits = r.integers(0, 2, (4000, 64))
    bits[:, 40:48] = bits[:, :1] ^ (r.random((4000, 8)) < 0.05)
    parts = sj.correlated((bits.T @ bits).astype(float), 4000, 4)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert any(set(range(40, 48)) <= set(p) for p in parts)


def test_flips():
    assert sorted(sj.flips((1, 3, 5), 2).tolist()) == sorted([2, 8, 32, 10, 34, 40])
    assert len(sj.flips(tuple(range(16)), 3)) + 1 == sj.questions(16, 3)


def test_hash_is_the_session_hash(spark):
    """Spark's own xxhash64 has the contract's seed."""
    h = spark.sql("select xxhash64('a b c') as h").first()["h"] % (1 << 64)
    assert h == xxhash.xxh64(b"a b c", 42).intdigest()
    one = sj.fingerprints(documents(spark, [(1, "A b  C")])).select(F.col("f")).first()["f"] % (1 << 64)
    assert one == h


def test_empty_table(spark):
    df = sj.join(documents(spark, []))
    assert df.collect() == [] and df.columns == ["doc_id", "fingerprint", "component_id"]
