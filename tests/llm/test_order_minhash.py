import hashlib
import re
import struct
from collections import defaultdict

import pytest
import xxhash

from livestats.llm.order_minhash import K, PER_SLOT, SLOTS, fingerprints, likeness, prints
from livestats.llm.queries import QUERIES

from ..conftest import SF_SMALL
from .helpers import documents, odd_rows, prose


def spark_hash(*values):
    """The 64-bit hash of values one after another, each seeded by the hash before; lists of numbers have their width."""
    h = 42
    for v in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack(*v), h)
    return h


def model(text):
    """The prints of a text, from the definition: every slot looks at all items."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    low = (1 << 33) - 1
    seen, items = defaultdict(int), []
    for i in range(len(words)):
        kmer = words[i:i + K]
        h = spark_hash(*kmer) & low
        seen[h] += 1
        items.append((h if seen[h] == 1 else spark_hash(("<q", h), ("<i", seen[h] - 1)) & low, i))
    out = []
    for slot in range(SLOTS if items else 0):
        own = sorted(x for x in items if x[0] >> 27 == slot)[:PER_SLOT]
        others = sorted((spark_hash(("<q", h), ("<q", slot)) & low, i) for h, i in items if (h, i) not in own)
        own += others[:PER_SLOT - len(own)]
        h = 0
        for x, _ in sorted(own, key=lambda x: x[1]):
            h = spark_hash(("<Q", h), ("<q", x))
        out.append(slot << 26 | h & (1 << 26) - 1)
    return out


def same_slots(a, b):
    return sum(x == y for x, y in zip(a, b)) / SLOTS if a and b else float(a == b)


def check(rows, got):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for i, (d, t) in enumerate(rows):
        half = len(t) // 2
        edited = t[:len(t) - half] + rows[(i + 1) % len(rows)][1][:half]
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


@pytest.mark.parametrize("buckets", [None, 1, 37])
def test_edited_texts(spark, buckets):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    df = fingerprints(documents(spark, rows), buckets) if buckets else QUERIES["op10_order_minhash"](spark, SF_SMALL)
    got = df.collect()
    check(rows, got)
    texts = dict(rows)
    by_text = defaultdict(set)
    for r in got:
        by_text[texts[r.doc_id]].add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert len({r.fingerprint for r in got}) == len(by_text)
    near = sorted(r.near_edited - r.near_next for r in got)
    assert near[len(near) // 2] > 0.05  # half of a text remains in its edited text


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    check(odd_rows(), fingerprints(docs).collect())
    check(odd_rows()[:3], fingerprints(documents(spark, odd_rows()[:3]), 5).collect())
    assert fingerprints(docs.limit(0)).collect() == []
    alone = fingerprints(documents(spark, [(1, "a b c d")])).first()
    assert alone.near_next == 1 and alone.edited_sha256 == hashlib.sha256(b"a b a b").hexdigest()
    plan = fingerprints(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def of_texts(spark, *texts):
    rows = spark.createDataFrame([tuple(texts)], ", ".join(f"t{i} string" for i in range(len(texts))))
    made = rows.select(*[prints(rows[f"t{i}"]).alias(f"p{i}") for i in range(len(texts))])
    return made.select(*[f"p{i}" for i in range(len(texts))], *[
        likeness(made["p0"], made[f"p{i}"]).alias(f"near{i}") for i in range(len(texts))]).first()


def test_follows_edit_distance(spark):
    words = prose(600).split()
    one = [*words[:300], "new", *words[300:]]
    ten = [w if i % 60 else "new" for i, w in enumerate(words)]
    swapped = words[300:] + words[:300]
    r = of_texts(spark, " ".join(words), " ".join(one), " ".join(ten), " ".join(swapped), prose(600, 1))
    assert r.near0 == 1 and r.near1 > 0.9 and r.near1 > r.near2 > 0.5
    # the same k-mers but for two, in another order
    assert r.near3 < 0.75 and r.near4 < 0.05
    assert len(r.p0) <= SLOTS


def test_repeats_count(spark):
    r = of_texts(spark, "a b c " * 10, "a b c " * 11, "a b c " * 40, "", "x")
    assert r.p0 != r.p1 and 1 > r.near1 > r.near2 and r.p3 == [] and r.near3 == 0 and len(r.p4) == SLOTS


def test_prints_and_likeness_equal_the_model(spark):
    texts = ["", " \t", "x", "x y", "x x x x x x", "a b c " * 30, *(prose(n, n) for n in (3, 20, 63, 64, 128, 300, 900)),
             prose(40) + " " + prose(40), "\u00e9t\u00e9 " * 7]
    got = of_texts(spark, *texts)
    want = [model(t) for t in texts]
    for i in range(len(texts)):
        assert got[f"p{i}"] == want[i], texts[i]
    pairs = [(0, 1), (7, 8), (8, 8), (11, 12)]
    for i, j in pairs:
        near = of_texts(spark, texts[i], texts[j]).near1
        assert near == same_slots(want[i], want[j])


def test_query_equals_the_model(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    got = {r.doc_id: r for r in QUERIES["op10_order_minhash"](spark, SF_SMALL).collect()}
    for i, (d, t) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        own, edited, after = model(t), model(t[:len(t) - half] + following[:half]), model(following)
        assert got[d].fingerprint == "".join(f"{x:08x}" for x in own)
        assert got[d].edited_fingerprint == "".join(f"{x:08x}" for x in edited)
        assert got[d].near_edited == same_slots(own, edited) and got[d].near_next == same_slots(own, after)


@pytest.mark.parametrize("n", [20, 30, 40, 60, 80, 100, 600])
def test_swapped_halves_are_told_apart(n):
    near = []
    for seed in range(6):
        words = [f"{w}{i}" for i, w in enumerate(prose(n, seed).split())]
        near.append(same_slots(model(" ".join(words)), model(" ".join(words[n // 2:] + words[:n // 2]))))
    assert sum(near) / 6 <= 0.5 and max(near) <= 0.66


@pytest.mark.parametrize("n", [20, 60, 100])
def test_a_changed_word_costs_little(n):
    words = [f"{w}{i}" for i, w in enumerate(prose(n).split())]
    # the last three k-mers change; both items of a tuple have to be others
    expected = ((n - K) / (n + K)) ** PER_SLOT
    assert abs(same_slots(model(" ".join(words)), model(" ".join([*words[:-1], "other"]))) - expected) < 0.2
