"""Groups of spelling variants: words that differ by one code point, by pairs of trie nodes.

A word is a path of the forward trie (its prefixes) and of the reversed trie
(its suffixes).  Two words are near if one code point is inserted, deleted or
replaced, that is if around some position they have the same prefix and the
same suffix.  So each word of length L is entered under pairs (prefix node,
suffix node):

* ``skip`` i: the nodes before and after code point i.  Words that share such a
  pair differ in that point only.  Words of equal length with one replaced point
  share exactly one.
* ``whole`` i: the nodes before and from point i on.  A word has it in common
  with the skips of the words that have one point more there.  Deleting any
  point of a row of equal ones gives the same word, so only the last one's skip
  is ``alone`` and counts.

The number of a node is a sum of 64-bit random numbers of the code points at
their places from the root, so every task numbers the nodes of its words alike
without a shuffle, and no root is a hot key.  A pair of numbers has 128 bits.

Entries of a pair meet in one group, in a partition sorted by the pairs.  It holds
at most one whole word, which the pair spells out, and one skip for each letter of
the alphabet, so at most ``LETTERS`` + 1 entries whatever the data; a word has as many near words at most as
its length times the alphabet allows, which bounds the later joins too.  Words
are numbered in code-point order by a range-sorted, stored table, so that groups
and ties work on integers.  A form has ten times its word's count, so a chain of
forms is shorter than the digits of a count; roots are found by doubling.

Defined cases: a NULL text has no words; a run of a NULL doc_id loses no point;
rows of equal doc_id count one by one; runs of any length are words; an empty
table yields no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored, text_slices
from .words import mix

#: Code points of a word at least, its occurrences at least, and how often a form occurs for each time its word does.
LEAST_LENGTH, LEAST_COUNT, FORM_RATIO = 7, 2, 10
#: Different letters of a word: a-z, and U+00C0 to U+00FF.
LETTERS = 26 + 64
_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
#: Different words that a task counts before it hands them on.
COUNTED = 200_000
SLICE_CHARS = 500_000

_U = np.uint64

#: Changes a lower-cased run of a document, or leaves it.
Edit = Callable[[int | None, str], str]


def drop_some(doc_id: int | None, run: str) -> str:
    """The edit of the contract: some runs lose a code point."""
    if doc_id is None:
        return run
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % 31:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def count_words(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """``word, n`` of the runs of all texts, lower-cased in A-Z, edited, and long and frequent enough."""
    def count(batches):
        counts: Counter[str] = Counter()

        def rows():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for part in text_slices(batch):
                texts = part.column("text").fill_null("")
                for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                    lower = text.as_py().encode().lower().decode()  # bytes: only A-Z change
                    own = Counter(_RUN.findall(lower))
                    if edit:
                        for run, n in own.items():
                            word = edit(doc_id, run)
                            if len(word) >= LEAST_LENGTH:
                                counts[word] += n
                    else:
                        counts.update(own)
                    if len(counts) >= COUNTED:
                        yield rows()
        if counts:
            yield rows()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def node_pairs(texts: list[str]) -> tuple[np.ndarray, ...]:
    """The entries of words: numbers of the prefix and suffix node, which are skips and alone, and whose they are."""
    c = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    end = np.cumsum(length)
    start = end - length
    word = np.repeat(np.arange(len(texts)), length)
    at = np.arange(len(c))
    from_start, to_end = (at - start[word] + 1).astype(np.uint64), (end[word] - at).astype(np.uint64)
    forward, reverse = np.zeros(len(c) + 1, np.uint64), np.zeros(len(c) + 1, np.uint64)
    np.cumsum(mix(from_start << _U(32) | c), out=forward[1:])
    np.cumsum(mix(~(to_end << _U(32) | c)), out=reverse[1:])
    alone = np.append(c[1:] != c[:-1], True)
    alone[end - 1] = True
    # before each point, and behind the last one
    whole = np.repeat(np.arange(len(texts)), length + 1)
    place = np.arange(len(whole)) - whole
    p = np.concatenate((forward[at] - forward[start[word]], forward[place] - forward[start[whole]]))
    s = np.concatenate((reverse[end[word]] - reverse[at + 1], reverse[end[whole]] - reverse[place]))
    return (p, s, np.repeat([True, False], [len(at), len(place)]), np.append(alone, np.ones(len(place), bool)),
            np.append(word, whole))


def entries(vocabulary: DataFrame) -> DataFrame:
    """``p, s, skip, alone, id, n``: the words under their pairs of trie nodes."""
    def enter(batches):
        for batch in batches:
            for part in text_slices(batch, "word", SLICE_CHARS):
                if not part.num_rows:
                    continue
                p, s, skip, alone, word = node_pairs(part.column("word").to_pylist())
                id_, n = (part.column(c).to_numpy()[word] for c in ("id", "n"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (p.view(np.int64), s.view(np.int64), skip, alone, id_, n)],
                    names=["p", "s", "skip", "alone", "id", "n"])

    # the sorted table can have few files, and a word has many entries
    spread = vocabulary.select("id", "word", "n").repartition(shuffle_partitions(vocabulary.sparkSession), "id")
    return spread.mapInArrow(enter, "p bigint, s bigint, skip boolean, alone boolean, id bigint, n bigint")


def _first(group: np.ndarray, n_groups: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows in ``order`` (by group): how many each group has, its first one and its second one (-1: none)."""
    own = group[order]
    count = np.bincount(own, minlength=n_groups)
    start = np.cumsum(count) - count
    padded = np.append(order, (-1, -1))
    return count, np.where(count > 0, padded[start], -1), np.where(count > 1, padded[np.minimum(start + 1, len(order))], -1)


def met(group: np.ndarray, skip: np.ndarray, alone: np.ndarray, n: np.ndarray, id_: np.ndarray):
    """For each entry of groups numbered from 0: how many near words it meets, and the row of the first by count and order.

    Skips meet each other; the whole word meets the skips that are alone.
    """
    n_groups = int(group[-1]) + 1 if len(group) else 0
    order = np.lexsort((id_, -n, group))
    skips, best, second = _first(group, n_groups, order[skip[order]])
    alones, best_alone, _ = _first(group, n_groups, order[(skip & alone)[order]])
    wholes, whole, _ = _first(group, n_groups, order[~skip[order]])
    row = np.arange(len(group))
    k = np.where(skip, skips[group] - 1 + (alone & (wholes[group] > 0)), alones[group])
    other = np.where(best[group] == row, second[group], best[group])
    mine = np.where(alone, whole[group], -1)
    # the whole word comes first if it is more frequent, or equally frequent and smaller
    leads = (mine >= 0) & ((other < 0) | (n[mine] > n[other]) | ((n[mine] == n[other]) & (id_[mine] < id_[other])))
    return k, np.where(skip, np.where(leads, mine, other), best_alone[group])


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """``id, n_near, less, form``: the number of a word's near words, and count (negative) and id of the first of them."""
    def meet(batches):
        kept: list[np.ndarray] | None = None

        def rows(columns):
            p, s, skip, alone, id_, n = columns
            new = np.concatenate(([True], (p[1:] != p[:-1]) | (s[1:] != s[:-1])))
            group = np.cumsum(new) - 1
            several = (np.bincount(group) > 1)[group]
            skip, alone, id_, n = (x[several] for x in (skip, alone, id_, n))
            _, group = np.unique(group[several], return_inverse=True)
            k, best = met(group, skip, alone, n, id_)
            some = k > 0
            best = best[some]
            return pa.RecordBatch.from_arrays([pa.array(id_[some]), pa.array(k[some].astype(np.int64)), pa.array(-n[best]),
                                               pa.array(id_[best])], names=["id", "k", "less", "form"])

        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            if kept is not None:
                columns = [np.concatenate(x) for x in zip(kept, columns, strict=True)]
            p, s = columns[:2]
            if not len(p):
                continue
            # the last group may go on; it is short
            last = int(np.flatnonzero((p != p[-1]) | (s != s[-1])).max(initial=-1)) + 1
            kept = [x[last:] for x in columns]
            if last:
                yield rows([x[:last] for x in columns])
        if kept is not None:
            yield rows(kept)

    dealt = entries(vocabulary).select("p", "s", "skip", "alone", "id", "n").repartition("p", "s").sortWithinPartitions("p", "s")
    found = dealt.mapInArrow(meet, "id bigint, k bigint, less bigint, form bigint")
    best = found.groupBy("id").agg(F.sum("k").alias("n_near"), F.min(F.struct("less", "form")).alias("best"))
    return best.select("id", "n_near", "best.less", "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """``id, root`` of each word with a form, by doubling: ``forms`` has ``id, form``."""
    up = stored(forms.select("id", F.col("form").alias("root")), "variants-roots")
    while True:
        above = up.select(F.col("id").alias("root"), F.col("root").alias("above"))
        joined = up.join(above, "root", "left")
        up = stored(joined.select("id", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")),
                    "variants-roots")
        if not up.where("moved").take(1):
            return up.select("id", "root")
        up = up.select("id", "root")


def variants(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    counted = count_words(docs, edit)
    # numbers in the order of the words: the partitions of the sorted table ascend
    numbered = stored(counted.orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"),
                      "variants-words")
    near = neighbours(numbered)
    with_form = (F.col("form_n") >= FORM_RATIO * F.col("n"))
    linked = numbered.select("id", "n").join(near, "id").select(
        "id", "n", "n_near", (-F.col("less")).alias("form_n"), "form")
    linked = stored(linked.select("id", "n_near", F.when(with_form, F.col("form_n")).alias("form_n"),
                                  F.when(with_form, F.col("form")).alias("form")), "variants-near")
    rooted = roots(linked.where("form is not null"))
    names = numbered.select("id", "word")
    # a form's variants are bounded by its length and the alphabet
    named = linked.join(rooted, "id", "left").join(names.toDF("form", "form_word"), "form", "left").join(
        names.toDF("root", "root_word"), "root", "left").select("id", "n_near", "form_n", "form_word", "root_word")
    return numbered.join(named, "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")


def word_variants(docs: DataFrame) -> DataFrame:
    """The contract's rows: the words of the runs of which some lose a point."""
    return variants(docs, drop_some)
