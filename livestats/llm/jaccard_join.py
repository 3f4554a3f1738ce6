"""Set similarity join of documents over word shingles, by universe partition and pigeonhole.

A document's set holds its distinct five-word shingles.  Two sets r, s of
Jaccard similarity >= 3/4 differ in at most (|r| + |s|) / 7 shingles.  Sets
are joined by size band (sizes from one power of two to the next; a set also
visits the band below if a partner of 3/4 its size lies there).  In a band the
universe of shingle hashes is cut into 2**p ranges, the segments, and a set's
segment is the shingles it has there.

Pigeonhole: give the segments of r allowances v of 1 (equal) or 2 (at most one
shingle more or less).  If every segment differed by its allowance or more, r
and s would differ in sum(v) shingles.  So with sum(v) > 2 |r| / 7 >= (|r| +
|s|) / 7 for the larger set r, some segment of a similar pair has a difference
below its allowance: its subset is equal, or equal after one deletion on one
side.  Every set is therefore indexed under the hash of each nonempty segment,
and of each of its one-deletion neighbours where the allowance is 2 (a segment
of one shingle counts 1).  Which p and which segments get allowance 2 is
decided for each band by cost, from counts over all documents: of the layouts
that suffice for every set of the band, the one with the least cost in index
entries and in sets that a passage shared with many documents would leave
without enough other entries.

Candidates are verified by the sets themselves.  Sets that share an index
entry form a group; of equal sets one stands for all.  First every set is
compared with the first set of the group it shares most entries with, and
links are contracted to components.  Groups that still hold several components
are then settled, by a second allocation: a set need not look into groups whose
allowances sum up to no more than it has to spare, as a similar partner would
still share one of its other entries.  It leaves out its largest groups, and is
compared with the members of the rest that are in other components.  Parity
sketches, whose distance never exceeds the difference of two sets, refute most
candidates before sets are fetched.  In a group of very many sets that are
alike but not similar, each pair has to be refuted; such a group is cut into
blocks, whose sketches are compared as matrices, so that a pair becomes a row
only if its sketches leave it open.  First each block gives a forest of such
pairs; those are verified, and what hangs together then is not compared again.

Defined cases: a NULL text or one without words has an empty set and links
with nothing; fewer words than a shingle make one shingle of the sequence;
rows of equal or NULL doc_id are documents of their own, a component's id is
the smallest doc_id in it (NULL if there is none); an empty table yields no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release, shuffle_partitions, stored, text_slices
from .words import mix, words

SHINGLE = 5
#: Similarity as a fraction.
NUMERATOR, DENOMINATOR = 3, 4
#: A passage of so many shingles is taken to be shared with many documents, in the cost of a layout.
PASSAGE = 64
#: The cost of a set that such a passage exposes, in index entries.
EXPOSED = 400
#: Index entries of a bucket at the aim.
BUCKET_ENTRIES = 2_000_000
#: Bits of the filter that picks the documents whose sets are fetched.
FILTER_BITS = 1 << 22
SLICE_BYTES = 1_000_000
#: Members of a group that is paired as rows, at most.
SMALL = 16
#: Members of a block of a larger group; two blocks meet in a cell.
BLOCK = 2048
#: Bytes of a sketch in a cell, at most; longer ones are folded.
CELL_SKETCH = 4096
#: Members of a cell that are compared with the others at once.
CELL_ROWS = 256

# Layouts of a band, as (p - band, share of segments with allowance 2).
LAYOUTS = ((-1, 1.0), (-1, 0.6), (0, 0.0), (0, 0.3), (1, 0.0), (2, 0.0), (4, 0.0), (8, 0.0), (64, 0.0))

_U = np.uint64
_FACTORS = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                            0xA0761D6478BD642F)]


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The ascending distinct shingle hashes of each text."""
    w = words(texts)
    hashes = w.keys()
    n = len(hashes)
    grams = np.zeros(n, np.uint64)
    for d in range(min(SHINGLE, n)):
        grams[:n - d] += hashes[d:] * _FACTORS[d]
    grams = mix(grams)
    at = 0
    for count in w.counts.tolist():
        if count >= SHINGLE:
            s = np.sort(grams[at:at + count - SHINGLE + 1])
            yield s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif count:
            short = sum((hashes[at + d:at + d + 1] * _FACTORS[d] for d in range(count)), np.zeros(1, np.uint64))
            yield mix(short + _U(count))
        else:
            yield np.empty(0, np.uint64)
        at += count


def class_keys(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A 128-bit digest of each nonempty set, as two signed integers."""
    if not sets:
        return []
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    halves = (np.add.reduceat(mix(flat ^ f), starts).view(np.int64).tolist() for f in _FACTORS[:2])
    return list(zip(*halves, strict=True))


def class_key(s: np.ndarray) -> tuple[int, int]:
    return class_keys([s])[0]


def band_of(n: int) -> int:
    return n.bit_length() - 1


def bands_of(n: int) -> list[int]:
    """The band of a set of ``n``, and the one below if a similar set can lie there."""
    k = band_of(n)
    least = -(-n * NUMERATOR // DENOMINATOR)
    return [k, k - 1] if least < 1 << k else [k]


def most_different(n: int) -> int:
    """How many shingles a set of ``n`` and a similar set that is no larger differ in at most."""
    return 2 * n * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


def segments(s: np.ndarray, band: int, layout: tuple[int, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of a set's nonempty segments, their lengths, and which have allowance 2."""
    p = min(max(band + layout[0], 0), 64)
    number = s >> _U(64 - p) if p else np.zeros(len(s), np.uint64)
    starts = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
    lengths = np.diff(starts, append=len(s))
    two = (number[starts] < _U(int(layout[1] * (1 << p)))) & (lengths > 1) if layout[1] else np.zeros(len(starts), bool)
    return starts, lengths, two


def layout_counts_of(sets: list[np.ndarray], bands: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each nonempty set in its band and each layout: by how much the allowances exceed what the set needs, its index
    entries, and its cost."""
    sizes, band = np.fromiter(map(len, sets), np.int64, len(sets)), np.array(bands, np.int64)
    flat = np.concatenate(sets)
    starts = np.cumsum(sizes) - sizes
    first = np.zeros(len(flat), bool)
    first[starts] = True
    change = np.concatenate((flat[:1], flat[1:] ^ flat[:-1]))
    share = np.log(np.minimum(PASSAGE / sizes, 2 / 3))
    needed = most_different(sizes) + 1
    spare, n_entries, cost = (np.empty((len(sets), len(LAYOUTS)), np.int64) for _ in range(3))
    cut: dict[int, tuple] = {}  # layouts that differ in allowances alone have the same segments
    for i, (finer, part) in enumerate(LAYOUTS):
        p = np.clip(band + finer, 0, 64)
        if finer not in cut:
            same = np.where(p < 64, _U((1 << 64) - 1) >> np.minimum(p, 63).astype(np.uint64), _U(0))
            at = np.flatnonzero(first | (change > np.repeat(same, sizes)))
            lengths = np.diff(at, append=len(flat))
            begin = np.searchsorted(at, starts)
            n = np.diff(begin, append=len(at))
            cut[finer] = at, lengths, begin, n, np.exp(lengths * np.repeat(share, n))
        at, lengths, begin, n, lost = cut[finer]
        allowed, total = n, n
        if part:
            least = np.array([int(part * (1 << x)) for x in p.tolist()], np.uint64)
            shift = np.repeat(64 - p, n).astype(np.uint64)
            number = np.where(shift < 64, flat[at] >> np.minimum(shift, _U(63)), _U(0))
            two = (number < np.repeat(least, n)) & (lengths > 1)
            allowed = n + np.add.reduceat(two.astype(np.int64), begin)
            total = n + np.add.reduceat(lengths * two, begin)
            lost = lost * (1 + two)
        spare[:, i], n_entries[:, i] = allowed - needed, total
        # allowances of the segments that lie in the passage as a whole, as expected
        cost[:, i] = total + EXPOSED * (spare[:, i] < np.add.reduceat(lost, begin))
    return spare, n_entries, cost


def layout_counts(s: np.ndarray, band: int) -> list[tuple[int, int, int]]:
    return list(zip(*(x[0].tolist() for x in layout_counts_of([s], [band])), strict=True))


def entries(s: np.ndarray, band: int, layout: tuple[int, float]) -> np.ndarray:
    """The set's index entries in a band; the lowest bit says that the allowance is 2."""
    starts, lengths, two = segments(s, band, layout)
    p = min(max(band + layout[0], 0), 64)
    number = s[starts] >> _U(64 - p) if p else np.zeros(len(starts), np.uint64)
    place = mix(number + _U((band + 1) * int(_FACTORS[2]) & (1 << 64) - 1))
    own = mix(s ^ _FACTORS[3])
    total = np.add.reduceat(own, starts)
    whole = mix(total ^ place) & ~_U(1) | two.astype(np.uint64)
    if not two.any():
        return whole
    inside = np.repeat(two, lengths)
    less = mix((np.repeat(total, lengths) - own)[inside] ^ np.repeat(place, lengths)[inside]) | _U(1)
    return np.concatenate((whole, less))


def sketch(s: np.ndarray) -> bytes:
    """Parities of the counts of shingles in cells by their lowest bits, two to four cells for each shingle."""
    bits = 1 << max(band_of(len(s)) + 2, 3)
    odd = np.bincount((s & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """At most the number of shingles that two sets differ in."""
    x, y = (np.frombuffer(z, np.uint8) for z in (a, b))
    while len(x) > len(y):  # cells are counted modulo their number, so halves add up
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both) and both > 0


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _sets(batches) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for part in text_slices(batch, most=SLICE_BYTES):
            yield part, list(shingle_sets(part.column("text").fill_null("")))


def describe(docs: DataFrame) -> DataFrame:
    """``doc_id, row, n, c, d, sketch`` and the layout counts of every document; (c, d) names its set."""
    schema = ("doc_id bigint, row bigint, n bigint, c bigint, d bigint, sketch binary, band int, visited int, "
              "spare array<int>, n_entries array<int>, cost array<int>")

    def found(batches):
        for part, sets in _sets(batches):
            full = [s for s in sets if len(s)]
            keys, bands = iter(class_keys(full)), [bands_of(len(s)) if len(s) else [None] for s in sets]
            keys = [next(keys) if len(s) else (None, None) for s in sets]
            counts: list[list] = [[None] * len(sets) for _ in range(3)]
            if full:
                each = [(i, s, b) for i, (s, own) in enumerate(zip(sets, bands, strict=True)) if len(s) for b in own]
                found_counts = layout_counts_of([s for _, s, _ in each], [b for _, _, b in each])
                for out, got in zip(counts, found_counts, strict=True):
                    for (i, _, _), x in zip(each, got.tolist(), strict=True):
                        out[i] = x if out[i] is None else out[i] + x
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("row"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([a for a, _ in keys], pa.int64()), pa.array([b for _, b in keys], pa.int64()),
                pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([b[0] for b in bands], pa.int32()),
                pa.array([b[1] if len(b) > 1 else None for b in bands], pa.int32()),
                pa.array(counts[0], pa.list_(pa.int32())),
                pa.array(counts[1], pa.list_(pa.int32())),
                pa.array(counts[2], pa.list_(pa.int32()))],
                names=["doc_id", "row", "n", "c", "d", "sketch", "band", "visited", "spare", "n_entries", "cost"])
        release()

    return _rows(docs).withColumn("row", text_hash()).mapInArrow(found, schema)


def choose_layouts(described: DataFrame, forced: int | None = None) -> tuple[dict[int, int], int]:
    """The layout of each band by cost, and the number of index entries in all."""
    k = len(LAYOUTS)
    both = described.where("n > 0").select(F.explode(F.filter(F.array(
        F.struct(F.col("band"), F.lit(0).alias("at")), F.struct(F.col("visited").alias("band"), F.lit(k).alias("at"))),
        lambda b: b["band"].isNotNull())).alias("b"), "spare", "n_entries", "cost")
    counts = both.groupBy("b.band").agg(
        *[F.min(F.get("spare", F.col("b.at") + i)).alias(f"spare{i}") for i in range(k)],
        *[F.sum(F.get("n_entries", F.col("b.at") + i)).alias(f"n{i}") for i in range(k)],
        *[F.sum(F.get("cost", F.col("b.at") + i)).alias(f"cost{i}") for i in range(k)])
    layouts, total = {}, 0
    for r in counts.collect():  # a row for each band: at most 64
        fits = [i for i in range(k) if r[f"spare{i}"] >= 0]
        if forced in fits:
            fits = [forced]
        layouts[r["band"]] = min(fits, key=lambda i: r[f"cost{i}"])
        total += r[f"n{layouts[r['band']]}"]
    return layouts, total


def groups(docs: DataFrame, layouts: dict[int, int], n_buckets: int) -> DataFrame:
    """``g, weight, size, c, n, first, n_first``: groups of different sets that share entries, a row for each member.

    ``first`` is the group's smallest member.  Groups of the same members in a bucket are one; ``weight`` is the sum of
    the allowances of their entries.
    """
    schema = "bucket int, c binary, n binary, counts binary, entries binary"

    def index(batches):
        seen: set[int] = set()  # copies within a task are indexed once
        for _, sets in _sets(batches):
            cs, ns, counts, found = [], [], [], []
            full = [s for s in sets if len(s)]
            for s, (c, _) in zip(full, class_keys(full), strict=True):
                if c in seen:
                    continue
                seen.add(c)
                own = np.concatenate([entries(s, b, LAYOUTS[layouts[b]]) for b in bands_of(len(s))])
                cs.append(c)
                ns.append(len(s))
                counts.append(len(own))
                found.append(own)
            if not cs:
                continue
            e = np.concatenate(found)
            row = np.repeat(np.arange(len(cs)), counts)
            bucket = ((e >> _U(32)) % _U(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            e, row, bucket = e[order], row[order], bucket[order]
            cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            own_c, own_n = np.array(cs, np.int64), np.array(ns, np.int32)
            out = []
            for lo, hi in zip(cut, np.append(cut[1:], len(e)), strict=True):
                some, first, n = np.unique(row[lo:hi], return_index=True, return_counts=True)
                low = e[lo:hi].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                out.append((int(bucket[lo]), own_c[some].tobytes(), own_n[some].tobytes(),
                            n.astype(np.int32).tobytes(), np.ascontiguousarray(low).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out, strict=True), [pa.int32()] + [pa.binary()] * 4, strict=True)],
                names=["bucket", "c", "n", "counts", "entries"])
        release()

    out_schema = pa.schema([("g", pa.int64()), ("weight", pa.int32()), ("size", pa.int32()), ("c", pa.int64()),
                            ("n", pa.int32()), ("first", pa.int64()), ("n_first", pa.int32())])

    def meet(table: pa.Table) -> pa.Table:
        cs, ns, es = [], [], []
        for r in table.select(["c", "n", "counts", "entries"]).to_batches():
            for c, n, k, e in zip(*(r.column(i).to_pylist() for i in range(4)), strict=True):
                k = np.frombuffer(k, np.int32)
                cs.append(np.repeat(np.frombuffer(c, np.int64), k))
                ns.append(np.repeat(np.frombuffer(n, np.int32), k))
                wide = np.zeros((int(k.sum()), 8), np.uint8)
                wide[:, :6] = np.frombuffer(e, np.uint8).reshape(-1, 6)
                es.append(wide.view("<u8").ravel())
        c, n, e = (np.concatenate(x) for x in (cs, ns, es))
        order = np.lexsort((c, e >> _U(1)))
        c, n, e = c[order], n[order], e[order]
        key = e >> _U(1)
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (c[1:] != c[:-1])))
        c, n, e, key = c[new], n[new], e[new], key[new]
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(start, append=len(key))
        live = np.repeat(size > 1, size)
        c, n, weight = c[live], n[live], 1 + (e[live] & _U(1)).astype(np.int32)
        size = size[size > 1]
        if not len(size):
            return out_schema.empty_table()
        start = np.cumsum(size) - size
        weight = np.maximum.reduceat(weight, start)
        name = np.add.reduceat(mix(c.view(np.uint64)), start) ^ mix(size.astype(np.uint64))  # names the members
        _, first, same = np.unique(name, return_index=True, return_inverse=True)
        total = np.bincount(same, weight).astype(np.int32)
        keep = np.concatenate([np.arange(start[i], start[i] + size[i]) for i in first])
        size = size[first]
        bucket = table.column("bucket")[0].as_py()
        g = bucket * np.int64(1 << 40) + np.arange(len(first), dtype=np.int64)
        start = start[first]
        return pa.table([pa.array(np.repeat(g, size)), pa.array(np.repeat(total, size)),
                         pa.array(np.repeat(size, size).astype(np.int32)), pa.array(c[keep]), pa.array(n[keep]),
                         pa.array(np.repeat(c[start], size)), pa.array(np.repeat(n[start], size))], schema=out_schema)

    packed = _rows(docs).select("doc_id", "text").mapInArrow(index, schema)
    return packed.groupBy("bucket").applyInArrow(
        meet, "g bigint, weight int, size int, c bigint, n int, first bigint, n_first int")


def _can_be_similar(n: str, m: str) -> str:
    return f"{DENOMINATOR} * least({n}, {m}) >= {NUMERATOR} * greatest({n}, {m})"


def verify(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The linked ones of candidate pairs ``a, b``; ``classes`` has ``c, first_id, sketch``."""
    spark = docs.sparkSession
    sketches = classes.select("c", "n", "sketch")
    both = pairs.join(sketches.toDF("a", "n_a", "s_a"), "a").join(sketches.toDF("b", "n_b", "s_b"), "b").where(
        _can_be_similar("n_a", "n_b"))

    def possible(batches):
        for batch in batches:
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            far = [sketch_distance(x, y) for x, y in zip(
                batch.column("s_a").to_pylist(), batch.column("s_b").to_pylist(), strict=True)]
            at = np.flatnonzero(np.array(far) * (DENOMINATOR + NUMERATOR) <= n * (DENOMINATOR - NUMERATOR))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(pa.array(at)), batch.column("b").take(pa.array(at))], names=["a", "b"])

    likely = stored(both.mapInArrow(possible, "a bigint, b bigint"), "join-likely")
    wanted = likely.select(F.explode(F.array("a", "b")).alias("c")).distinct().join(classes, "c")
    hashed = F.pmod(F.xxhash64("first_id"), F.lit(FILTER_BITS))
    # a filter of fixed size; at most FILTER_BITS numbers
    bits = np.zeros(FILTER_BITS, bool)
    bits[wanted.select(hashed.alias("x")).distinct().toArrow().column("x").to_numpy()] = True
    filter_ = spark.sparkContext.broadcast(np.packbits(bits))

    def fetch(batches):
        for batch in batches:
            at = batch.column("x").to_numpy()
            picked = np.unpackbits(filter_.value)[at].astype(bool)
            some = batch.filter(pa.array(picked))
            for part, sets in _sets([some]):
                full = [i for i, s in enumerate(sets) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c for c, _ in class_keys([sets[i] for i in full])], pa.int64()),
                     part.column("doc_id").take(pa.array(full, pa.int64())),
                     pa.array([sets[i].tobytes() for i in full], pa.binary())], names=["c", "doc_id", "items"])

    texts = _rows(docs).withColumn("x", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)))
    fetched = texts.mapInArrow(fetch, "c bigint, doc_id bigint, items binary")
    sets = wanted.select("c", "first_id").join(fetched, "c").where(F.col("first_id").eqNullSafe(F.col("doc_id")))
    sets = stored(sets.select("c", "items").dropDuplicates(["c"]), "join-sets")

    def linked(batches):
        for batch in batches:
            sides = (batch.column(c).to_pylist() for c in ("i_a", "i_b"))
            ok = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(*sides, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    met = likely.join(sets.toDF("a", "i_a"), "a").join(sets.toDF("b", "i_b"), "b").select("a", "b", "i_a", "i_b")
    return stored(met.mapInArrow(linked, "a bigint, b bigint"), "join-links")


def components(links: DataFrame) -> DataFrame:
    """``c, root``: the smallest node that each linked node reaches (large and small stars in turn)."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(
        "u != v").distinct(), "join-edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(small, "join-edges")
        new = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if new == state:
            break
        state = new
    roots = edges.select(F.col("v").alias("c")).distinct().select("c", F.col("c").alias("root"))
    return edges.select(F.col("u").alias("c"), F.col("v").alias("root")).unionByName(roots)


def first_pairs(live: DataFrame) -> DataFrame:
    """Each set with the first set of a group, by the most shared entries."""
    shared = live.where("c != first").where(_can_be_similar("n_first", "n")).groupBy(
        F.col("first").alias("a"), F.col("c").alias("b")).agg(F.sum("weight").alias("weight"))
    best = shared.groupBy("b").agg(F.max(F.struct("weight", F.col("a"))).alias("best"))
    return best.select(F.col("best.a").alias("a"), "b")


def open_members(live: DataFrame, rooted: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of the groups with several components: ``g, size, c, n, root, asks``.

    A set asks in all of them but the largest whose allowances sum up to no
    more than it has to spare; groups in which no set asks are settled.
    """
    own = live.select("g", "weight", "size", "c", "n").join(rooted, "c", "left").withColumn(
        "root", F.coalesce("root", "c"))
    mixed = own.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("g")
    own = own.join(mixed, "g")
    largest_first = Window.partitionBy("c").orderBy(F.desc("size"), "g")
    own = own.withColumn("left_out", F.sum("weight").over(largest_first)).join(
        classes.select("c", "spare"), "c").withColumn("asks", F.col("left_out") > F.col("spare"))
    return stored(own.select("g", "size", "c", "n", "root", "asks"), "join-mixed")


def folded(sketches: list[bytes]) -> np.ndarray:
    """The sketches as rows of one width, that of the shortest, in words of 64 bits."""
    width = min(CELL_SKETCH, min(map(len, sketches)))
    out = np.zeros((len(sketches), -(-width // 8) * 8), np.uint8)
    by_size: dict[int, list[int]] = {}
    for i, x in enumerate(sketches):
        by_size.setdefault(len(x), []).append(i)
    for size, at in by_size.items():  # cells are counted modulo their number, so parts add up
        rows = np.frombuffer(b"".join([sketches[i] for i in at]), np.uint8).reshape(len(at), size // width, width)
        out[at, :width] = np.bitwise_xor.reduce(rows, axis=1)
    return out.view(np.uint64)


def uniting(i: np.ndarray, j: np.ndarray, root: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Which of the pairs, in turn, unite two components, and the components after that."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while x in parent:
            if parent[x] in parent:
                parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    used = []
    for k, (a, b) in enumerate(zip(root[i].tolist(), root[j].tolist(), strict=True)):
        a, b = top(a), top(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
            used.append(k)
    return used, np.array([top(x) for x in root.tolist()], np.int64) if used else root


def cell_pairs(c, n, root, asks, sketches, side, forest: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a cell's members that may be similar: of different components and sides, the larger set asks.

    With ``forest`` only as many as would unite the components if all were similar, the likeliest of some rows first.
    """
    words = folded(sketches)
    # the larger set asks; of two of one size either
    left, right = np.flatnonzero(asks), np.arange(len(c))
    some, others = [], []
    for lo in range(0, len(left), CELL_ROWS):
        x = left[lo:lo + CELL_ROWS]
        far = np.zeros((len(x), len(right)), np.uint32)
        for w in range(words.shape[1]):
            far += np.bitwise_count(words[x, w][:, None] ^ words[None, :, w])
        n_x = n[x][:, None]
        ok = (far * (DENOMINATOR + NUMERATOR) <= (n_x + n[None]) * (DENOMINATOR - NUMERATOR))
        ok &= (n_x >= n[None]) & (DENOMINATOR * n[None] >= NUMERATOR * n_x) & (root[x][:, None] != root[None])
        if side is not None:
            ok &= side[x][:, None] != side[None]
        i, j = np.nonzero(ok)
        if forest and len(i):
            likeliest = np.argsort(far[i, j] / (n[x[i]] + n[j]), kind="stable")
            i, j = i[likeliest], j[likeliest]
            used, root = uniting(x[i], j, root)
            i, j = i[used], j[used]
        some.append(x[i])
        others.append(j)
    if not some:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(some), np.concatenate(others)


def merged(large: DataFrame) -> DataFrame:
    """``g, size, c, n, root, asks`` with groups of largely the same members as one, where that compares fewer pairs.

    A set that is like very many others shares another group with them for each
    segment.  The groups whose least member, by a hash, is one set are taken
    together if their distinct members, squared, are at most the sum of their
    squared sizes.  Every two members of a group still meet.
    """
    groups_ = large.groupBy("g").agg(F.min(F.xxhash64("c")).alias("least"), F.count(F.lit(1)).alias("size"))
    apart = groups_.groupBy("least").agg(F.sum(F.col("size") * F.col("size")).alias("apart"), F.count(F.lit(1)).alias(
        "n_groups")).where("n_groups > 1")
    together = large.select("g", "c").join(groups_, "g").select("least", "c").distinct().groupBy("least").agg(
        F.count(F.lit(1)).alias("members")).join(apart, "least").where("members * members <= apart").select(
        "least", "members")
    named = groups_.join(together, "least", "left").select(
        "g", F.when(F.isnull("members"), F.col("g")).otherwise(F.col("least")).alias("name"),
        F.coalesce("members", "size").alias("size"))
    return large.drop("size").join(named, "g").groupBy(F.col("name").alias("g"), "size", "c").agg(
        F.first("n").alias("n"), F.first("root").alias("root"), F.max("asks").alias("asks"))


def small_pairs(members: DataFrame) -> DataFrame:
    """Pairs across components of the small groups that hold several, as rows."""
    asked = members.where("asks").select(
        "g", "size", F.col("c").alias("c_a"), F.col("n").alias("n_a"), F.col("root").alias("root_a"))
    other = members.select("g", F.col("c").alias("c_b"), F.col("n").alias("n_b"), F.col("root").alias("root_b"))
    # the larger set of a pair asks: its allowances are the ones that count
    few = asked.where(F.col("size") <= SMALL).drop("size").join(other, "g").where(
        "root_a != root_b and n_a >= n_b").where(_can_be_similar("n_a", "n_b"))
    return few.select(F.least("c_a", "c_b").alias("a"), F.greatest("c_a", "c_b").alias("b"))


def large_groups(members: DataFrame) -> DataFrame:
    """The larger groups with several components; those with largely the same members are one."""
    large = members.where(F.col("size") > SMALL)
    alive = large.where("asks").groupBy("g").agg(F.max("n").alias("most"))
    large = large.join(alive, "g").where(F.col("asks") | (F.col("n") <= F.col("most"))).drop("most")
    return stored(merged(large), "join-large")


def large_pairs(large: DataFrame, classes: DataFrame, forest: bool) -> DataFrame:
    """Pairs across components that larger groups still have to settle, and that may be similar.

    A group is cut into blocks of about ``BLOCK`` members; two blocks at a time
    meet in a cell, where sketches are compared as matrices, and only pairs that
    those do not refute become rows.  With ``forest`` a cell gives no more
    pairs than it has members.
    """
    large = large.join(classes.select("c", "sketch"), "c")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    large = large.withColumn("h", F.pmod(F.xxhash64("c"), blocks).cast("int"))
    cells = large.select("g", "h", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("j"), "c", "n", "root", "asks", "sketch")
    cells = cells.select("g", F.least("h", "j").alias("lo"), F.greatest("h", "j").alias("hi"), "h", "c", "n", "root", "asks",
                         "sketch").repartition("g", "lo", "hi").sortWithinPartitions("g", "lo", "hi")

    def meet(batches):
        kept: list[pa.RecordBatch] = []  # the rows of the cell that is still open

        def found(rows: pa.Table) -> pa.RecordBatch:
            c, n, root, h = (rows.column(x).to_numpy() for x in ("c", "n", "root", "h"))
            asks = rows.column("asks").to_numpy(zero_copy_only=False)
            i, j = cell_pairs(c, n.astype(np.int64), root, asks, rows.column("sketch").to_pylist(),
                              h if rows.column("lo")[0] != rows.column("hi")[0] else None, forest)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(c[i], c[j])), pa.array(np.maximum(c[i], c[j]))],
                                              names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.column_stack([batch.column(x).to_numpy() for x in ("g", "lo", "hi")])
            cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo or kept and any(kept[-1].column(x)[-1] != batch.column(x)[0] for x in ("g", "lo", "hi")):
                    yield found(pa.Table.from_batches(kept))
                    kept.clear()
                kept.append(batch.slice(lo, hi - lo))
        if kept:
            yield found(pa.Table.from_batches(kept))

    return cells.mapInArrow(meet, "a bigint, b bigint").distinct()


def still_open(large: DataFrame, rooted: DataFrame) -> DataFrame:
    """The larger groups that hold several components after more links."""
    own = large.drop("root").join(rooted, "c", "left").withColumn("root", F.coalesce("root", "c"))
    mixed = own.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("g")
    return own.join(mixed, "g")


def rooted_rows(docs: DataFrame, forced_layout: int | None = None) -> DataFrame:
    """``doc_id, row, n_shingles, root, component_id`` of every document; ``row`` hashes its text.

    ``root`` names the component also where no document in it has an id; NULL for the empty set.
    """
    described = stored(describe(docs), "join-documents")
    layouts, n_entries = choose_layouts(described, forced_layout)
    ids = described.select("doc_id", "row", F.col("n").alias("n_shingles"), "c", "d")
    if not layouts:
        return ids.select("doc_id", "row", "n_shingles", F.lit(None).cast("long").alias("root"),
                          F.col("doc_id").alias("component_id"))
    chosen = F.create_map(*[F.lit(x) for kv in layouts.items() for x in kv])
    own = F.get("spares", chosen[F.col("band")])
    below = F.get("spares", chosen[F.col("visited")] + len(LAYOUTS))
    # equal sets are one class
    classes = described.where("n > 0").groupBy("c", "d").agg(
        F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
        F.first("band").alias("band"), F.first("visited").alias("visited"), F.first("spare").alias("spares"))
    classes = stored(classes.withColumn("spare", F.coalesce(F.least(own, below), own)).drop(
        "band", "visited", "spares"), "join-classes")
    n_buckets = max(shuffle_partitions(docs.sparkSession), -(-n_entries // BUCKET_ENTRIES))
    live = stored(groups(docs, layouts, n_buckets), "join-groups")
    links = verify(docs, classes, first_pairs(live))
    members = open_members(live, components(links), classes)
    large = large_groups(members)
    # what hangs together by one pair for each member is not compared again
    links = links.unionByName(verify(docs, classes, small_pairs(members).unionByName(
        large_pairs(large, classes, True)).distinct()))
    rooted = components(links)
    more = verify(docs, classes, large_pairs(still_open(large, rooted), classes, False))
    rooted = components(links.unionByName(more))
    named = classes.select("c", "d", "first_id").join(rooted, "c", "left").withColumn("root", F.coalesce("root", "c"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    component = named.join(least, "root").select("c", "d", "root", "component_id")
    return ids.join(component, ["c", "d"], "left").select(
        "doc_id", "row", "n_shingles", "root",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def join(docs: DataFrame, forced_layout: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    return rooted_rows(docs, forced_layout).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, with its columns: that of the smallest doc_id, ties to the smallest text hash.

    Rows without an id come last.  Documents without words are no near
    duplicates; of equal rows (doc_id and text) one stays.
    """
    rows = rooted_rows(docs).select("root", F.struct(F.isnull("doc_id").alias("no_id"), F.coalesce(
        "doc_id", F.lit(0)).alias("id"), "row").alias("at"))
    kept = rows.where("root is not null").groupBy("root").agg(F.min("at").alias("at")).select("at").unionByName(
        rows.where("root is null").select("at")).distinct()
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), F.isnull("doc_id").alias("no_id"),
                      F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), text_hash().alias("row"))
    met = own.join(kept.select("at.no_id", "at.id", "at.row"), ["no_id", "id", "row"], "left_semi")
    return met.dropDuplicates(["no_id", "id", "row"]).select("document.*")
