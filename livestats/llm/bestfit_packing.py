"""Best-fit packing with large-item matching.

Every document becomes its ids plus an end id.  A document longer than a
sequence is cut into full pieces behind a shorter first piece.  Pieces above
one third of a sequence are large: a large piece is matched greedily, longest
first, with the longest large piece that still fits beside it, so at most two
share a sequence.  Smaller pieces then go, longest first, to the sequence with
the tightest gap that holds them, or open a new one.

Only lengths matter to the packing, and there are at most ``capacity`` of
them.  So the packing is solved on the histogram of lengths: classes of equal
sequences with a multiplicity, whatever the number of documents.  The plan is
a table of runs ("pieces ranked a to b of length s go to sequences n, n + 1,
... at this offset"); the documents find their place in it by their rank among
the pieces of their length, counted per task and summed over tasks.

Defined cases: a NULL or empty text is a piece of its end id alone; rows of
equal or NULL doc_id are separate documents; an empty table yields no rows;
other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, stored, text_slices
from .tokenizing import default_vocabulary, encoder

CAPACITY = 1024
END_ID = 2


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
              with_ids: bool = False) -> DataFrame:
    """The pieces of every document, each with its rank among its task's pieces of that length."""
    schema = ("part int, nth bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
              + ", ids binary" * with_ids)

    def cut(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for some in text_slices(batch):
                ids, lens = encoder(vocabulary).encode(some.column("text"))
                ids = np.insert(ids, np.cumsum(lens), end_id).astype("<u4")
                lens = lens + 1
                n_pieces = -(-lens // capacity)
                doc = np.repeat(np.arange(len(lens)), n_pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                first = lens - (n_pieces - 1) * capacity
                length = np.where(piece == 0, first[doc], capacity)
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
                order = np.argsort(length, kind="stable")
                sizes, begin, n = np.unique(length[order], return_index=True, return_counts=True)
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(length)) - np.repeat(begin - seen[sizes], n)
                seen[sizes] += n
                at = 4 * ((np.cumsum(lens) - lens)[doc] + start)
                data = memoryview(ids.tobytes())
                runs = [data[a:a + 4 * m] for a, m in zip(at.tolist(), length.tolist(), strict=True)]
                columns = [pa.array(np.full(len(doc), part, np.int32)), pa.array(nth),
                           some.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                           pa.array(start), pa.array(length), pa.array([zlib.crc32(r) for r in runs], pa.int64())]
                if with_ids:
                    columns.append(pa.array([bytes(r) for r in runs], pa.binary()))
                names = ["part", "nth", "doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, schema)


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Classes of sequences ``(multiplicity, piece lengths in order)`` for a histogram of lengths."""
    left = {s: n for s, n in counts.items() if n}
    open_bins: list[list] = []  # [gap, multiplicity, lengths]
    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        a = large[-1]
        b = bisect_left(large, capacity - a + 1) - 1
        if b < 0:  # nothing large fits beside it
            open_bins.append([capacity - a, left.pop(a), [a]])
            large.pop()
            continue
        b = large[b]
        n = left[a] // 2 if a == b else min(left[a], left[b])
        if n == 0:  # the last one of its length finds no second
            n, lengths = 1, [a]
            lower = bisect_left(large, a) - 1
            if lower >= 0:
                lengths = [a, large[lower]]
        else:
            lengths = [a, b]
        for s in lengths:
            left[s] -= n
            if not left[s]:
                del left[s]
                large.remove(s)
        open_bins.append([capacity - sum(lengths), n, lengths])
    gaps: dict[int, list[list]] = {}
    keys: list[int] = []

    def put(bin_):
        if bin_[0] not in gaps:
            gaps[bin_[0]] = []
            insort(keys, bin_[0])
        gaps[bin_[0]].append(bin_)

    for bin_ in open_bins:
        put(bin_)
    for s in sorted(left, reverse=True):
        n = left[s]
        while n:
            at = bisect_left(keys, s)
            if at == len(keys):  # no gap holds it: new sequences, as full as they get
                each = min(capacity // s, n)
                m = n // each
                put([capacity - each * s, m, [s] * each])
                n -= m * each
                continue
            gap = keys[at]
            bin_ = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                keys.pop(at)
            # best fit goes on with the same sequence while the piece fits: its gap is now the tightest
            each = min(gap // s, n)
            m = min(bin_[1], n // each)
            if m < bin_[1]:
                put([gap, bin_[1] - m, bin_[2]])
            put([gap - each * s, m, bin_[2] + [s] * each])
            n -= m * each
    return [(m, lengths) for group in gaps.values() for _, m, lengths in group]


def plan_runs(classes: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first rank, count, first sequence, offset)``; ranks ascend within a length."""
    runs, next_rank, sequence = [], {}, 0
    for m, lengths in classes:
        offset = 0
        for s in lengths:
            runs.append((s, next_rank.get(s, 0), m, sequence, offset))
            next_rank[s] = next_rank.get(s, 0) + m
            offset += s
        sequence += m
    return sorted(runs)


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece (and its ids)."""
    spark = docs.sparkSession
    pieces = stored(pieces_of(docs, vocabulary or default_vocabulary(), capacity, end_id, with_ids), "pieces")
    per_task = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # at most one row for each length: bounded by the capacity
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.sparkContext.broadcast(np.array(plan_runs(pack_lengths(counts, capacity)), np.int64).reshape(-1, 5))
    before = per_task.select("length", "part", (F.sum("n").over(
        Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = pieces.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))

    def place(batches):
        table = runs.value
        span = int(table[:, 1].max(initial=0) + table[:, 2].max(initial=0)) + 1
        keys = table[:, 0] * span + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            run = table[np.searchsorted(keys, length * span + rank, side="right") - 1]
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])],
                names=[*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
              + ", ids binary" * with_ids + ", sequence_id bigint, offset bigint")
    return ranked.select(*names, "rank").mapInArrow(place, schema)
