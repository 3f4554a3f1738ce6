import random
import re
import zlib
from collections import Counter

from livestats.llm import spelling_variants as sv

from .helpers import documents, odd_rows


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def plain(rows, edited=True):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if edited and doc_id is not None and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    form, n_near = {}, {}
    for w, n in words.items():
        own = [v for v in words if near(v, w)]
        n_near[w] = len(own)
        best = min(own, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, n_near[w], words[form[w]] if form[w] else None) for w, n in words.items()}


def rows_of_variants(seed=4):
    r = random.Random(seed)
    letters = "abcdeéÀ×ÿxyz"
    bases = ["".join(r.choice(letters) for _ in range(r.randrange(7, 12))) for _ in range(30)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(120):
            w = r.choice(bases[:1 + int(30 * r.random() ** 3)])
            for _ in range(r.choice((0, 0, 0, 0, 0, 1, 1, 2))):
                at, k = r.randrange(len(w)), r.randrange(3)
                w = w[:at] + (r.choice(letters[:4]) if k else "") + w[at + (k < 2):]
            text.append(w.upper() if r.random() < 0.1 else w)
        rows.append((i, r.choice((" ", "-", "9")).join(text)))
    return rows


def check(spark, rows, **kwargs):
    got = [tuple(x) for x in sv.word_variants(documents(spark, rows)).select(
        "word", "form", "root", "n", "n_near", "form_n").collect()]
    want = plain(rows)
    assert len(got) == len(want) and set(got) == want
    return want


def test_query_equals_brute_force(spark):
    want = check(spark, rows_of_variants())
    assert sum(w[1] is not None for w in want) > 30 and max(w[4] for w in want) > 4
    assert any(w[1] is not None and w[1] != w[2] for w in want)  # a chain of forms


def test_rows_of_equal_letters(spark):
    words = ["a" * k for k in range(6, 12)] + ["aabbccdd", "abbccdd", "aabccdd", "aabbbccdd", "bbbbbbbb", "abbbbbbb"]
    rows = [(k, " ".join(w for j, w in enumerate(words) for _ in range(1 + (j * 7 + k) % 40))) for k in range(4)]
    check(spark, rows)


def test_odd_rows(spark):
    long = "xy" * 30_000
    rows = odd_rows() + [(20, long + " " + long), (21, long + "z " + long + "z"), (22, "no-words 12 ab"),
                         (None, "withoutid withoutid"), (23, "Ångström Ångström ångström ångström")]
    check(spark, rows)


def test_group_of_a_pair_is_bounded():
    word = "abcdefgh"
    alphabet = [*map(chr, range(97, 123)), *map(chr, range(0xc0, 0x100))]
    assert len(alphabet) == sv.LETTERS
    own = [word[:3] + c + word[4:] for c in alphabet] + [word[:3] + word[4:]]
    p, s, *_ = sv.node_pairs(own)
    groups = Counter(zip(p.tolist(), s.tolist(), strict=True))
    assert max(groups.values()) == sv.LETTERS + 1


def test_empty_table(spark):
    df = sv.word_variants(documents(spark, []))
    assert df.collect() == [] and set(df.columns) == {"word", "form", "root", "n", "n_near", "form_n"}
