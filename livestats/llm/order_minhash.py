"""Document fingerprints by Order MinHash, in column expressions only.

The k-mers of a text are runs of ``k`` words, one at every word (shorter at the
end).  Each is numbered by its occurrence, so the n-th repeat of a k-mer is an
item of its own.  A hash deals the items to ``SLOTS`` slots; a slot takes its
``PER_SLOT`` smallest items.  A slot with fewer takes the smallest of all other
items under a hash of its own, so in a short text too every slot has
``PER_SLOT`` items (or all there are) and in a long text hardly any item is
hashed again.  A slot's items are put back in text order and the tuple is
hashed.  Two fingerprints are as alike as the share of slots that agree.  As
the tuples keep the order, moving words apart changes slots although the words
stay, which follows edit distance and not only the set of k-mers.

Defined cases: a NULL text is the empty text; a text without words has an
empty fingerprint, alike 1 to another empty one and 0 to any other; equal
texts have equal fingerprints; NULL ids come first and rows of equal doc_id
follow by text; the document after the last is the first; a single document
follows itself; an empty table yields no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, whole

K = 3
SLOT_BITS = 6
SLOTS = 1 << SLOT_BITS
PER_SLOT = 2

_PLACE_BITS = 30  # a string has fewer words than that
_HASH_BITS = 33
_PRINT_BITS = 32 - SLOT_BITS
_PLACE_MASK, _HASH_MASK, _PRINT_MASK = ((1 << b) - 1 for b in (_PLACE_BITS, _HASH_BITS, _PRINT_BITS))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _item(hashed: Column, place: Column) -> Column:
    """A hash in front of a place, as one positive integer."""
    return F.shiftleft(hashed.bitwiseAND(F.lit(_HASH_MASK)), _PLACE_BITS).bitwiseOR(place)


def _hash(item: Column) -> Column:
    return F.shiftright(item, _PLACE_BITS)


def _place(item: Column) -> Column:
    return item.bitwiseAND(F.lit(_PLACE_MASK))


def _slot(item: Column) -> Column:
    return F.shiftright(item, _PLACE_BITS + _HASH_BITS - SLOT_BITS)


def _before(items: Column, j: Column, back: int = 1) -> Column:
    return F.get(items, j - back)


def _repeats(items: Column) -> Column:
    """Items of second and later occurrences, hashed anew with their number."""

    def numbered(later: Column) -> Column:
        starts = F.filter(F.transform(later, lambda x, j: F.when(
            (j == 0) | (_hash(x) != _hash(_before(later, j))), j)), lambda j: j.isNotNull())
        return let(starts, lambda s: F.flatten(F.transform(s, lambda at, t: F.transform(
            F.slice(later, at + 1, F.coalesce(F.get(s, t + 1), F.size(later)) - at),
            lambda x, i: _item(F.xxhash64(_hash(x), i + 1), _place(x))))))

    later = F.filter(items, lambda x, j: (j > 0) & (_hash(x) == _hash(_before(items, j))))
    return let(later, lambda r: F.when(F.size(r) > 0, numbered(r)).otherwise(r))


def _tuples(items: Column, kept: Column, per_slot: int) -> Column:
    """A print for each slot: its items in text order, hashed.  ``kept`` has the smallest items of each slot."""

    def printed(slot: Column, own: Column) -> Column:
        in_order = F.sort_array(F.transform(own, lambda y: F.shiftleft(_place(y), _HASH_BITS).bitwiseOR(_hash(y))))
        hashed = F.aggregate(in_order, F.lit(0).cast("long"),
                             lambda s, y: F.xxhash64(s, y.bitwiseAND(F.lit(_HASH_MASK))))
        return F.shiftleft(slot, _PRINT_BITS).bitwiseOR(hashed.bitwiseAND(F.lit(_PRINT_MASK)))

    def filled(slot: Column, own: Column) -> Column:
        others = F.sort_array(F.transform(
            F.array_except(items, own), lambda y: _item(F.xxhash64(_hash(y), slot), _place(y))))
        return F.when(F.size(own) == per_slot, own).otherwise(F.concat(own, F.slice(others, 1, per_slot - F.size(own))))

    def of_slot(x: Column, j: Column) -> Column:
        own = F.filter(F.slice(kept, j + 1, per_slot), lambda y: _slot(y) == _slot(x))
        return let(own, lambda o: printed(_slot(x), filled(_slot(x), o)))

    starts = F.filter(F.transform(kept, lambda x, j: F.when(
        (j == 0) | (_slot(x) != _slot(_before(kept, j))), of_slot(x, j))), lambda p: p.isNotNull())
    none = F.array().cast("array<bigint>")
    empty = F.array_except(F.sequence(F.lit(0).cast("long"), F.lit(SLOTS - 1).cast("long")), F.transform(kept, _slot))
    return F.when(F.size(kept) == 0, none).otherwise(F.sort_array(F.concat(
        starts, F.transform(empty, lambda slot: printed(slot, filled(slot, none))))))


def prints(text: Column, k: int = K, per_slot: int = PER_SLOT) -> Column:
    """The slots of a text, ascending: slot number and tuple hash in one integer each; none without words."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def items(w: Column) -> Column:
        return F.sort_array(F.transform(w, lambda x, i: _item(
            F.xxhash64(x, *(F.get(w, i + d) for d in range(1, k))), i.cast("long"))))

    def numbered(s: Column) -> Column:
        first = F.filter(s, lambda x, j: (j == 0) | (_hash(x) != _hash(_before(s, j))))
        return F.sort_array(F.concat(first, _repeats(s)))

    def smallest(s: Column) -> Column:
        return F.filter(s, lambda x, j: (j < per_slot) | (_slot(x) != _slot(_before(s, j, per_slot))))

    return let(words, lambda w: let(items(w), lambda s: let(numbered(s), lambda n: let(
        smallest(n), lambda kept: _tuples(n, kept, per_slot)))))


def written(p: Column) -> Column:
    """Prints as a string: eight hexadecimal digits each."""
    return F.array_join(F.transform(p, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of slots that agree."""
    slots = F.size(F.array_union(F.transform(a, lambda x: F.shiftright(x, _PRINT_BITS)),
                                 F.transform(b, lambda x: F.shiftright(x, _PRINT_BITS))))
    return F.when(slots == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / slots)


def _bucket(value: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at most the value (a binary search); 0 for NULL."""
    if not bounds:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = [1 << s for s in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        F.get(table, at + step - 1) <= value, at + step).otherwise(at))


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``doc_id, text, prints`` of each row and ``next_text, next_prints`` of the row after it by doc_id.

    Rows are dealt to ranges of doc_id of about equal size, one shuffle; the
    first row of a range also goes to the range before it.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().cast("string").alias("text"))
    n = buckets or 4 * shuffle_partitions(docs.sparkSession)
    ids = rows.select("doc_id")
    bounds = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0]
    bounds = sorted(set(bounds or []))
    rows = rows.withColumn("bucket", _bucket(F.col("doc_id"), bounds))
    # one row for each bucket
    firsts = sorted((r["bucket"], -1 if r["nulls"] else 0, None if r["nulls"] else r["least"]) for r in rows.groupBy(
        "bucket").agg(F.min("doc_id").alias("least"), F.count_if(F.isnull("doc_id")).alias("nulls")).collect())
    heads = [(firsts[i - 1][0], first) for i, (_, _, first) in enumerate(firsts)]
    spark = docs.sparkSession
    heads = spark.createDataFrame(heads, "before int, least bigint")
    # bounded by the number of buckets
    head_rows = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("least"))).groupBy(
        "before", "doc_id").agg(F.min("text").alias("text"))
    own = rows.select("bucket", "doc_id", "text", F.lit(0).alias("is_head"))
    extra = head_rows.select(F.col("before").alias("bucket"), "doc_id", "text", F.lit(1).alias("is_head"))
    both = own.unionByName(extra).withColumn("prints", prints(F.col("text")))
    order = Window.partitionBy("bucket").orderBy("is_head", F.asc_nulls_first("doc_id"), "text")
    return both.select(
        "doc_id", "text", "prints", "is_head", F.lead("text").over(order).alias("next_text"),
        F.lead("prints").over(order).alias("next_prints")).where("is_head = 0").drop("is_head")


def fingerprints(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has the last half of its code points replaced by as many
    of the next document's first ones.
    """
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(
        F.col("next_text"), F.lit(1), half))
    rows = with_next(docs, buckets).select(
        "doc_id", n.cast("long").alias("n_chars"), "prints", "next_prints", edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", "prints", "next_prints", let(F.col("edited"), lambda e: F.struct(
        F.sha2(e, 256).alias("sha256"), prints(e).alias("prints"))).alias("edited"))
    return rows.select(
        "doc_id", "n_chars", F.col("edited.sha256").alias("edited_sha256"), written(F.col("prints")).alias("fingerprint"),
        written(F.col("edited.prints")).alias("edited_fingerprint"),
        likeness(F.col("prints"), F.col("edited.prints")).alias("near_edited"),
        likeness(F.col("prints"), F.col("next_prints")).alias("near_next"))
