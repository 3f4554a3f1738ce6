import hashlib
import random
import zlib

import numpy as np
import pytest

from livestats.llm import periodic_runs as pr

from .helpers import documents, odd_rows


def plain_runs(w):
    """All runs by comparing the words with those q places on, for each q."""
    n, best = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                best.setdefault((i, j + q), q)  # the smallest period comes first
            i = j
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def ids_and_grams(w):
    x = np.array(w, np.int64)
    grams = np.zeros(max(len(w) - pr.GRAM + 1, 0), np.uint64)
    for d in range(pr.GRAM):
        grams = pr.mix(grams + x[d:len(grams) + d].astype(np.uint64) + np.uint64(1))
    return x, grams


def found(w):
    return pr.runs_of(*ids_and_grams(w)) if len(w) >= pr.LEAST else []


def test_runs_equal_brute_force_on_random_words():
    r = random.Random(5)
    for _ in range(1500):
        w = []
        while len(w) < r.randrange(12, 160):
            kind = r.randrange(4)
            if kind == 0:
                w += [r.randrange(r.choice((2, 3, 50))) for _ in range(r.randrange(1, 15))]
            elif kind == 1:
                unit = [r.randrange(r.choice((2, 4, 60))) for _ in range(r.randrange(1, 14))]
                w += unit * r.randrange(2, 7) + unit[:r.randrange(len(unit) + 1)]
            elif kind == 2 and w:
                at = r.randrange(len(w))
                w += w[at:at + r.randrange(1, 30)]
            else:
                w += [w[-1] if w else 1] * r.randrange(1, 20)
        assert found(w) == plain_runs(w)


@pytest.mark.parametrize("w", [
    [0] * 11, [0] * 12, [0] * 3000, [0, 1] * 6, [0, 1, 2] * 400 + [0, 1], list(range(12)) * 2, list(range(13)) * 2 + [0],
    (([0, 1] * 7 + [2]) * 5 + [3]) * 4, list(range(40)) + [0] * 20 + list(range(40)) + [0] * 20])
def test_runs_of_plain_shapes(w):
    assert found(w) == plain_runs(w)


def test_fibonacci_word():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert found(b) == plain_runs(b)


def test_repair_expands_to_its_input():
    r = random.Random(2)
    for _ in range(200):
        w = [r.randrange(3) for _ in range(r.randrange(1, 80))] + [-1]
        sides, places, left = pr.repair(w)
        for (a, b), at in zip(sides, places, strict=True):
            assert len(at) > 1 and len({tuple(w[i:i + a + b]) for i in at}) == 1
        grammar_size = len(left) + len(sides)
        assert grammar_size <= len(w)


def test_long_text_of_one_word_and_of_a_long_period():
    assert found([7] * 100_000) == [(0, 100_000, 1)]
    r = random.Random(1)
    unit = [r.randrange(5000) for _ in range(20_000)]
    assert (5, 60_000, 20_000) in found([9001 + i for i in range(5)] + unit * 3)


def digest_rows(rows):
    out = []
    for doc_id, text in rows:
        w = (text or "").encode().split()
        n = len(w)
        if doc_id is not None and n:
            h = zlib.crc32(str(doc_id).encode())
            if h % 10 == 0:
                g = h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        number = {}
        runs = plain_runs([number.setdefault(x, len(number)) for x in w]) if n < 3000 else None
        if runs is None:
            continue
        dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        out.append((doc_id, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
                    hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
                    hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in dropped)).hexdigest()))
    return out


def key(r):
    return tuple((x is not None, x) for x in r)


def test_query_equals_brute_force(spark):
    r = random.Random(3)
    rows = odd_rows()
    for i in range(100, 220):
        w = [r.choice("ab cd ef gh é日 Ab".split()) + str(r.randrange(r.choice((1, 3, 99)))) for _ in range(r.randrange(90))]
        rows.append((i, r.choice((" ", "\n", "\t ")).join(w * r.choice((1, 1, 3)))))
    got = [tuple(x) for x in pr.run_digests(documents(spark, rows)).collect()]
    assert len(got) == len(rows)
    long_ids = {7}
    assert sorted((g for g in got if g[0] not in long_ids), key=key) == sorted(digest_rows(rows), key=key)
    assert sum(g[1] > 0 for g in got) > 20


def test_empty_table(spark):
    df = pr.run_digests(documents(spark, []))
    assert df.collect() == []
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint"] * 6 + ["string"] * 2
