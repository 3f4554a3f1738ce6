"""Token-id files: canonical length-limited Huffman coding of ids.

``write_ids`` tokenizes every whole text, counts all ids, builds one canonical
code of at most ``MAX_BITS`` bits (package-merge) from the global counts and
writes the ids in ascending doc_id order.  ``read_ids`` decodes the files.

File format, two Parquet folders under one path:

- ``codebook``: ``id int, bits int``, the code length of each id that occurs.
  Codes are canonical: ascending by (bits, id).
- ``blocks``: ``part int, block int, doc_ids array<bigint>, n_tokens
  array<int>, checkpoints binary, payload binary``.  Parts ascend in doc_id,
  blocks ascend in a part.  A block holds whole documents and decodes by
  itself.  ``payload`` is the bit string of its ids, high bit first;
  ``checkpoints`` has the bit offset (unsigned 32 bits, little endian) of
  every ``CHECKPOINT_IDS``-th id, so decoding can start at any of them.

Defined cases: a NULL text is the empty text and yields its end id alone;
NULL doc_ids sort first; rows of equal doc_id sort by text and stay separate;
an empty table yields an empty codebook and no block; other columns are not
read.  The only driver-held data are the code lengths, at most one entry for
each id of the vocabulary.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import release, stored, text_slices
from .tokenizing import default_vocabulary, encoder

END_ID = 0
MAX_BITS = 20
BLOCK_IDS = 1 << 17
CHECKPOINT_IDS = 128

_IDS_SCHEMA = "part int, block int, doc_ids array<bigint>, n_tokens array<int>, ids binary"
_BLOCK_SCHEMA = ("part int, block int, doc_ids array<bigint>, n_tokens array<int>, "
                 "checkpoints binary, payload binary")


def id_blocks(docs: DataFrame, vocabulary: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Packed 32-bit ids of whole documents, in blocks that ascend in doc_id."""

    def blocks(batches):
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def row(held):
            nonlocal block
            ids = np.concatenate([x[2] for x in held])
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()),
                 pa.array([[d for x in held for d in x[0]]], pa.list_(pa.int64())),
                 pa.array([np.concatenate([x[1] for x in held])], pa.list_(pa.int32())),
                 pa.array([ids.tobytes()], pa.binary())],
                names=["part", "block", "doc_ids", "n_tokens", "ids"])
            block += 1
            return out

        size = 0
        for batch in batches:
            for some in text_slices(batch):
                ids, lens = encoder(vocabulary).encode(some.column("text"))
                ids = np.insert(ids, np.cumsum(lens), end_id)
                lens = lens + 1
                doc_ids = some.column("doc_id").to_pylist()
                ends = np.cumsum(lens)
                lo = 0
                while lo < len(lens):  # whole documents until the block is full
                    base = ends[lo - 1] if lo else 0
                    hi = max(lo + 1, int(np.searchsorted(ends, base + block_ids - size, side="right")))
                    held.append((doc_ids[lo:hi], lens[lo:hi], ids[base:ends[hi - 1]]))
                    size += int(ends[hi - 1] - base)
                    if size >= block_ids or hi < len(lens):
                        yield row(held)
                        held, size = [], 0
                    lo = hi
        if held:
            yield row(held)
        held.clear()
        release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(blocks, _IDS_SCHEMA)


def id_dtype(vocabulary: str) -> np.dtype:
    return encoder(vocabulary).dtype


def count_ids(blocks: DataFrame, dtype: str) -> DataFrame:
    """``id, n`` over all blocks: counted in each task before the shuffle."""

    def counts(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                n = np.bincount(np.frombuffer(ids.as_buffer(), dtype))
                if len(n) > len(total):
                    total = np.concatenate((total, np.zeros(len(n) - len(total), np.int64)))
                total[:len(n)] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["id", "n"])

    each = blocks.select("ids").mapInArrow(counts, "id int, n bigint")
    return each.groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for positive counts (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError("more ids than codes of that length")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    merged, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        m = len(merged) // 2 * 2
        both = np.concatenate((leaves, merged[0:m:2] + merged[1:m:2]))
        at = np.argsort(both, kind="stable")
        merged = both[at]
        is_leaf.append(at < n)
    bits = np.zeros(n, np.int64)
    take = 2 * n - 2
    for level in reversed(is_leaf):
        own = int(level[:take].sum())
        bits[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = bits
    return out


class Code:
    """Canonical code of ``ids`` (ascending) with their lengths."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        self.ids, self.bits = np.asarray(ids, np.int64), np.asarray(bits, np.int64)
        self.max_bits = int(self.bits.max()) if len(self.bits) else 1
        order = np.lexsort((self.ids, self.bits))
        width = np.int64(1) << (self.max_bits - self.bits[order])
        first = np.cumsum(width) - width
        size = int(self.ids.max()) + 1 if len(self.ids) else 1
        self.code_of, self.bits_of = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code_of[self.ids[order]] = (first >> (self.max_bits - self.bits[order])).astype(np.uint64)
        self.bits_of[self.ids] = self.bits
        entry = (self.ids[order] << 5 | self.bits[order]).astype(np.uint32)
        self.table = np.zeros(1 << self.max_bits, np.uint32)
        self.table[:int(width.sum())] = np.repeat(entry, width)

    def encode(self, ids: np.ndarray, step: int = CHECKPOINT_IDS) -> tuple[bytes, bytes]:
        """The payload and the checkpoints of ids."""
        n = self.bits_of[ids]
        ends = np.cumsum(n)
        at = ends - n
        total = int(ends[-1]) if len(ends) else 0
        if total >= 1 << 32:
            raise ValueError("a block's payload must stay under 2**32 bits")
        value = self.code_of[ids] << (64 - (at & 31) - n).astype(np.uint64)
        words = total // 32 + 2
        word = at >> 5
        # the bits of different ids are disjoint, so their sums are exact
        out = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), words)
        out += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), words)
        return out.astype(">u4").tobytes()[:(total + 7) // 8], at[::step].astype("<u4").tobytes()

    def decode(self, payload: bytes, checkpoints: bytes, n_ids: int, step: int = CHECKPOINT_IDS) -> np.ndarray:
        """All ids, a table look-up for each, from all checkpoints side by side."""
        b = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
        windows = b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]
        at = np.frombuffer(checkpoints, "<u4").astype(np.int64)
        last = len(windows) - 1
        out = np.empty((step, len(at)), np.uint32)
        for k in range(min(step, n_ids)):
            w = windows[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)
            entry = self.table[w >> np.uint32(32 - self.max_bits)]
            out[k] = entry >> np.uint32(5)
            at += entry & np.uint32(31)
        return out.T.ravel()[:n_ids]


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> None:
    """Tokenize all documents and write the id files under ``path``."""
    spark = docs.sparkSession
    dtype = id_dtype(vocabulary).str
    blocks = stored(id_blocks(docs, vocabulary, end_id), "token-ids", "none")
    # bounded by the size of the vocabulary
    counts = count_ids(blocks, dtype).orderBy("id").toPandas()
    bits = code_lengths(counts["n"].to_numpy(np.int64)) if len(counts) else np.empty(0, np.int64)
    book = pd.DataFrame({"id": counts["id"].astype("int32"), "bits": bits.astype("int32")})
    spark.createDataFrame(book, "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    code = spark.sparkContext.broadcast((book["id"].to_numpy(), book["bits"].to_numpy()))

    def encode(batches):
        own = Code(*code.value)
        for batch in batches:
            coded = [own.encode(np.frombuffer(x.as_buffer(), dtype)) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("part", "block", "doc_ids", "n_tokens")),
                 pa.array([c[1] for c in coded], pa.binary()), pa.array([c[0] for c in coded], pa.binary())],
                names=["part", "block", "doc_ids", "n_tokens", "checkpoints", "payload"])

    blocks.mapInArrow(encode, _BLOCK_SCHEMA).write.option("compression", "none").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and the ids of each document in the files.

    ``start`` counts the ids of all documents before it; ``ids`` (left out
    with ``with_ids=False``) holds unsigned 32-bit little-endian integers.
    """
    book = spark.read.parquet(f"{path}/codebook").orderBy("id").toPandas()  # bounded by the vocabulary
    code = spark.sparkContext.broadcast((book["id"].to_numpy(), book["bits"].to_numpy()))
    blocks = spark.read.schema(_BLOCK_SCHEMA).parquet(f"{path}/blocks")
    schema = "part int, block int, doc_id bigint, ahead bigint, n_tokens bigint, ids_crc32 bigint"

    def decode(batches):
        own = Code(*code.value)
        for batch in batches:
            for row in range(batch.num_rows):
                part, block, doc_ids, n, marks, payload = (batch.column(i)[row].as_py() for i in range(6))
                ends = np.cumsum(np.array(n, np.int64))
                ids = own.decode(payload, marks, int(ends[-1])).astype("<u4")
                data = memoryview(ids.tobytes())
                cuts = [0, *(4 * ends).tolist()]
                docs = [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(n), pa.int32()), pa.array([block] * len(n), pa.int32()),
                     pa.array(doc_ids, pa.int64()), pa.array(ends - n), pa.array(n, pa.int64()),
                     pa.array([zlib.crc32(d) for d in docs], pa.int64()),
                     *([pa.array([bytes(d) for d in docs], pa.binary())] if with_ids else [])],
                    names=["part", "block", "doc_id", "ahead", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    docs = blocks.mapInArrow(decode, schema + ", ids binary" * with_ids)
    sizes = blocks.select("part", "block", F.aggregate(
        "n_tokens", F.lit(0).cast("long"), lambda s, n: s + n).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before_part = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before_part"))
    within = Window.partitionBy("part").orderBy("block")
    before = sizes.withColumn("before", F.sum("n").over(within) - F.col("n")).drop("n").join(before_part, "part")
    return docs.join(before, ["part", "block"]).select(
        "doc_id", (F.col("before_part") + F.col("before") + F.col("ahead")).alias("start"), "n_tokens", "ids_crc32",
        *["ids"] * with_ids)


def token_id_files(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write the id files to the shared folder and return what reading them back gives."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/livestats-llm/id-files-{uuid.uuid4().hex}"
    write_ids(docs, path, vocabulary or default_vocabulary())
    return read_ids(spark, path, with_ids=False)
