"""SimHash near-duplicates by a generalised pigeonhole.

A fingerprint has 64 bits, each the majority of that bit in the hashes of all
shingles.  Two link if they differ in ``MOST`` bits or fewer.  Equal fingerprints are one
class, so copies cost nothing beyond the first.

Pigeonhole: cut the bits into partitions and give partition i of a fingerprint
x a threshold t_i >= -1 with sum(t_i + 1) = MOST + 1.  If y differed from x in more
than t_i bits of every partition, it would differ in MOST + 1 or more.  So x finds
all its links by asking, in each partition with t_i >= 0, for the fingerprints
whose bits there are within t_i of its own.

* Correlated bits go into one partition, by their counts over all classes.  The
  number of partitions is the one of least estimated cost.
* Thresholds are chosen for each fingerprint by dynamic programming on the
  estimated numbers of candidates: the counted size of its bucket in each
  partition, times the growth with the threshold that the bits' counts imply.
  So a fingerprint leaves out a partition in which it shares its bits with many.
* Every class is entered under its bits of each partition, and asks under all
  values within its threshold.  Entries and questions of a value are a bucket.

Buckets are settled in rounds, so that no bucket is compared all against all.
Those of ``SMALL`` members or fewer are compared in pairs.  All members of larger ones
are compared with two of them, and buckets whose members are then known to be in
one component are done.  Of the rest, those of ``LARGE`` members or fewer are compared
in pairs not known to be in one component.  The members of still larger ones agree
on the bucket's bits, and a link among them differs in MOST of the others at most, so
it agrees on one of MOST + 1 parts of those: each bucket is dealt to smaller ones by the
bits of each part, and the next round follows.  Where no more than MOST bits are left, a
member can meet 2 ** MOST different entries at most and is compared with them.
Components of all links follow at the end.

Defined cases: a NULL text or one without words has fingerprint zero and links like
any other; fewer words than a shingle make one shingle of the sequence; rows of
equal or NULL doc_id are documents of their own, a component's id is the
smallest doc_id in it (NULL if there is none); an empty table yields no rows;
other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_slices
from .jaccard_join import components
from .words import mix

BITS = 64
SHINGLE = 3
SEED = 42
#: Bits that linked fingerprints differ in at most.
MOST = 3
#: Partitions that are considered.
PARTITIONS = range(2, 9)
#: Members of a bucket that are compared in pairs: at first, and once the members of larger ones have met two of them.
SMALL, LARGE = 256, 4096
HASHES = 1 << 16
SLICE_BYTES = 4_000_000

_U = np.uint64


def majority(words: list[bytes]) -> int:
    """The fingerprint of a sequence of words."""
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > SHINGLE:
        starts, ends = starts[:-SHINGLE + 1], ends[SHINGLE - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros(BITS, np.int64)
    for lo in range(0, len(starts), HASHES):
        h = [xxhash.xxh64_intdigest(text[a:b], SEED) for a, b in zip(
            starts[lo:lo + HASHES].tolist(), ends[lo:lo + HASHES].tolist(), strict=True)]
        counts += bit_matrix(np.array(h, np.uint64)).sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * counts > len(starts)))


def bit_matrix(x: np.ndarray) -> np.ndarray:
    """The bits of 64-bit integers, lowest first, a row for each."""
    return np.unpackbits(x.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, f``: the fingerprint of every document, as a signed integer."""
    def found(batches):
        for batch in batches:
            for part in text_slices(batch, most=SLICE_BYTES):
                own = [majority(t.as_py().encode().lower().split()) for t in part.column("text").fill_null("")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.array(own, np.uint64).view(np.int64))], names=["doc_id", "f"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(found, "doc_id bigint, f bigint")


def bit_counts(classes: DataFrame) -> tuple[int, np.ndarray]:
    """The number of classes, and in how many of them each two bits are set together."""
    def count(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = bit_matrix(batch.column("f").to_numpy().view(np.uint64)).astype(np.float64)
            total += bits.T @ bits
            n += len(bits)
        a, b = np.divmod(np.arange(BITS * BITS + 1), BITS)
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)),
                                          pa.array(np.append(total.ravel(), n).astype(np.int64))], names=["a", "b", "n"])

    summed = classes.select("f").mapInArrow(count, "a int, b int, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))
    out, n = np.zeros((BITS, BITS)), 0
    for r in summed.collect():  # one for each two bits
        if r["a"] == BITS:
            n = r["n"]
        else:
            out[r["a"], r["b"]] = r["n"]
    return n, out


def correlated(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """The bits in ``m`` partitions of about equal width, each grown by the bit that goes with it most."""
    p = np.diag(together) / n
    scale = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    go = np.abs(together / n - np.outer(p, p)) / np.outer(scale, scale)
    np.fill_diagonal(go, 0)
    free, out = list(range(BITS)), []
    for k in range(m):
        part = [max(free, key=lambda b: go[b, free].sum())]
        free.remove(part[0])
        while len(part) < BITS // m + (k < BITS % m):
            part.append(max(free, key=lambda b: go[b, part].sum()))
            free.remove(part[-1])
        out.append(sorted(part))
    return out


def within(differ: np.ndarray) -> np.ndarray:
    """The chances that at most 0..MOST bits differ, for bits that differ with the given chances each."""
    chance = np.zeros(MOST + 1)
    chance[0] = 1
    for d in differ:
        chance[1:] = chance[1:] * (1 - d) + chance[:-1] * d
        chance[0] *= 1 - d
    return np.maximum(np.cumsum(chance), 1e-300)


def questions(width: int, t: int) -> int:
    return sum(comb(width, k) for k in range(t + 1))


def allocate(cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds of least cost and that cost; ``cost[x, i, t]`` is that of threshold t of partition i for x.

    Dynamic programming over the partitions and the sum of t + 1 so far, which ends at MOST + 1.
    """
    n, m, _ = cost.shape
    best = np.full((n, MOST + 2), np.inf)
    best[:, 0] = 0
    taken = np.zeros((n, m, MOST + 2), np.int8)
    for i in range(m):
        new = best.copy()  # threshold -1
        for used in range(1, MOST + 2):
            for t in range(used):
                c = best[:, used - t - 1] + cost[:, i, t]
                less = c < new[:, used]
                new[less, used] = c[less]
                taken[less, i, used] = t + 1
        best = new
    out = np.empty((n, m), np.int8)
    used = np.full(n, MOST + 1)
    for i in reversed(range(m)):
        out[:, i] = taken[np.arange(n), i, used] - 1
        used = used - out[:, i] - 1
    return out, best[:, MOST + 1]


def choose_partitions(together: np.ndarray, n: int) -> list[list[int]]:
    """The partitions of the least estimated cost: entries, questions and candidates of a fingerprint."""
    p = np.diag(together) / n
    best = None
    for m in PARTITIONS:
        parts = correlated(together, n, m)
        cost = np.array([[questions(len(b), t) + n * within(2 * p[b] * (1 - p[b]))[t] for t in range(MOST + 1)]
                         for b in parts])
        total = m + allocate(cost[None])[1][0]
        if best is None or total < best[0]:
            best = total, parts
    return best[1]


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def signed(x: int) -> int:
    return x - (x >> 63 << 64)


@lru_cache(maxsize=None)
def flips(bits: tuple[int, ...], t: int) -> np.ndarray:
    """Patterns of 1..t of the bits."""
    out = [0]
    sets: list[tuple[int, int]] = [(0, -1)]
    for _ in range(t):
        sets = [(x | 1 << bits[j], j) for x, last in sets for j in range(last + 1, len(bits))]
        out += [x for x, _ in sets]
    return np.array(out[1:], np.uint64)


def entries(classes: DataFrame, parts: list[list[int]], growth: np.ndarray) -> DataFrame:
    """``k, f, entry, ask, used``: members of the buckets k; ``used`` has the bits that its entries agree on."""
    masks = [mask_of(b) for b in parts]
    own = classes.select("f", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col("f").bitwiseAND(F.lit(signed(x))).alias("v")) for i, x in enumerate(masks)]))
        .alias("e")).select("f", "e.i", "e.v")
    sizes = own.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    counted = own.join(sizes, ["i", "v"]).groupBy("f").agg(*[
        F.max(F.when(F.col("i") == i, F.col("n"))).alias(f"n{i}") for i in range(len(parts))])
    ask = np.array([[questions(len(b), t) for t in range(MOST + 1)] for b in parts], np.float64)

    def enter(batches):
        for batch in batches:
            f = batch.column("f").to_numpy().view(np.uint64)
            for lo in range(0, len(f), 4096):
                x = f[lo:lo + 4096]
                n = np.stack([batch.column(f"n{i}").to_numpy()[lo:lo + 4096] for i in range(len(masks))], axis=1)
                thresholds, _ = allocate(ask[None] + n[:, :, None] * growth[None])
                for i, mask in enumerate(masks):
                    v = x & _U(mask)
                    t = thresholds[:, i]
                    out = [(v, x, np.ones(len(x), bool), t >= 0)]
                    for k in range(1, MOST + 1):
                        some = t == k
                        if some.any():
                            near = (v[some][:, None] ^ flips(tuple(parts[i]), k)[None]).ravel()
                            whose = np.repeat(x[some], len(near) // int(some.sum()))
                            out.append((near, whose, np.zeros(len(near), bool), np.ones(len(near), bool)))
                    value, who, entry, asks = (np.concatenate(z) for z in zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mix(value + _U(i * 0x9E3779B97F4A7C15 % (1 << 64))).view(np.int64)), pa.array(who.view(np.int64)),
                         pa.array(entry), pa.array(asks), pa.array(np.full(len(who), signed(mask), np.int64))],
                        names=["k", "f", "entry", "ask", "used"])

    return counted.mapInArrow(enter, "k bigint, f bigint, entry boolean, ask boolean, used bigint")


@lru_cache(maxsize=None)
def finer(used: int) -> list[int]:
    """The bits outside ``used`` in MOST + 1 parts."""
    rest = [b for b in range(BITS) if not used >> b & 1]
    return [mask_of(rest[j::MOST + 1]) for j in range(MOST + 1)]


def deal(members: DataFrame) -> DataFrame:
    """Members of larger buckets dealt to smaller ones, by the bits of each part of those not used yet."""
    def dealt(batches):
        for batch in batches:
            f, k, used = (batch.column(c).to_numpy().view(np.uint64) for c in ("f", "k", "used"))
            masks, which = np.unique(used, return_inverse=True)
            split = np.array([finer(int(x)) for x in masks], np.uint64).reshape(-1, MOST + 1)
            for j in range(MOST + 1):
                part = split[which, j]
                key = mix(mix(k + _U(j + 1)) ^ (f & part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), batch.column("f"), batch.column("entry"), batch.column("ask"),
                     pa.array((used | part).view(np.int64))], names=["k", "f", "entry", "ask", "used"])

    return members.select("k", "f", "entry", "ask", "used").mapInArrow(
        dealt, "k bigint, f bigint, entry boolean, ask boolean, used bigint")


def apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def mixed(members: DataFrame, rooted: DataFrame | None) -> DataFrame:
    """Members of the buckets that hold several components, with their component, the bucket's size and two members."""
    if rooted is None:
        own = members.withColumn("root", F.col("f"))
    else:
        own = members.join(rooted.select(F.col("c").alias("f"), "root"), "f", "left").withColumn(
            "root", F.coalesce("root", "f"))
    some = F.struct(F.xxhash64("k", "f").alias("h"), F.col("f").alias("f"))
    buckets = own.groupBy("k").agg(
        F.count(F.lit(1)).alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi"),
        F.min(some).alias("x"), F.max(some).alias("y"), F.max("entry").alias("has_entry"), F.max("ask").alias("has_ask"))
    buckets = buckets.where("lo != hi and has_entry and has_ask").select(
        "k", "size", F.col("x.f").alias("x"), F.col("y.f").alias("y"))
    return own.join(buckets, "k")


def known(links: DataFrame) -> DataFrame:
    """``c, root``: a fingerprint that each linked one is known to reach; not always the component's only one.

    Two steps to the least neighbour, which for the links to a bucket's members is most of the way.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy(F.col("a").alias("c")).agg(F.least(F.min("b"), F.col("c")).alias("root")), "simhash-known")
    above = least.select(F.col("c").alias("root"), F.col("root").alias("above"))
    return least.join(above, "root").select("c", F.col("above").alias("root"))


def links_of(members: DataFrame) -> DataFrame:
    """All that components need of the links among the members of each bucket: ``a, b``."""
    links, rooted, most = None, None, SMALL
    while True:
        live = stored(mixed(members, rooted), "simhash-buckets")
        few = (F.col("size") <= most) | (F.lit(BITS) - F.bit_count("used") <= MOST)
        star = live.where(~few).select("f", F.explode(F.array("x", "y")).alias("x")).where(
            (F.col("f") != F.col("x")) & (apart("f", "x") <= MOST))
        side = live.where(few)
        asks = side.where("ask").select("k", F.col("f").alias("a"), F.col("root").alias("root_a"))
        other = side.where("entry").select("k", F.col("f").alias("b"), F.col("root").alias("root_b"))
        met = asks.join(other, (asks["k"] == other["k"]) & (F.col("root_a") != F.col("root_b"))
                        & (apart("a", "b") <= MOST)).select("a", "b")
        new = star.toDF("a", "b").unionByName(met).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        links = stored(new if links is None else links.unionByName(new), "simhash-links")
        rest = live.where(~few).select("k", "f", "entry", "ask", "used")
        if not rest.take(1):
            return links
        if most == SMALL:  # the same buckets again, with what is known now
            rooted, members, most = known(links), rest, LARGE
        else:
            rooted = components(links)
            members = deal(mixed(rest, rooted))


def join(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document."""
    found = stored(fingerprints(docs), "simhash-documents")
    classes = stored(found.groupBy("f").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    n, together = bit_counts(classes)
    if n < 2:
        rooted = classes.select(F.col("f").alias("c"), F.col("f").alias("root"))
    else:
        parts = choose_partitions(together, n)
        p = np.diag(together) / n
        chance = np.array([within(2 * p[b] * (1 - p[b])) for b in parts])
        rooted = components(links_of(stored(entries(classes, parts, chance / chance[:, :1]), "simhash-entries")))
    named = classes.join(rooted.withColumnRenamed("c", "f"), "f", "left").withColumn("root", F.coalesce("root", "f"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    component = named.join(least, "root").select("f", "component_id")
    return found.join(component, "f").select(
        "doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")
