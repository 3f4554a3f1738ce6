import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from livestats.llm.huffman_ids import Code, code_lengths, read_ids, write_ids
from livestats.llm.queries import QUERIES
from livestats.llm.tokenizing import IdEncoder, default_vocabulary

from ..conftest import SF_SMALL
from .helpers import documents, odd_rows

ENCODER = IdEncoder(default_vocabulary(), table_units=300)


PLAIN = Tokenizer.from_file(default_vocabulary())


def library_ids(text):
    """The ids of a tokenizer that only the library has touched."""
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def test_added_tokens_in_a_text_are_the_library_ids():
    texts = ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> \n<|endoftext|>x <|endoftext", "<|endof", "a b c"]
    ids, lens = ENCODER.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in library_ids(t)] and lens.tolist() == [len(library_ids(t)) for t in texts]
    (end,) = (i for i, t in PLAIN.get_added_tokens_decoder().items() if t.content == "<|endoftext|>")
    assert library_ids(texts[1]) == [end]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t'sreS.,!?0159éñ×÷ 　\x1c\x85\x01日本🙂<|endoftext|>́ǅ\r-_`~"),
                        max_size=30), max_size=20))
def test_ids_equal_the_library(texts):
    ids, lens = ENCODER.encode(pa.array(texts, pa.string()))
    assert ids.tolist() == [i for t in texts for i in library_ids(t)]
    assert lens.tolist() == [len(library_ids(t)) for t in texts]


def test_ids_of_real_texts(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    for batch in (texts, texts[::-1], [t.replace("\n", "\n\n") for t in texts[:50]]):
        ids, lens = ENCODER.encode(pa.array(batch))
        assert ids.tolist() == [i for t in batch for i in library_ids(t)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10 ** 6), min_size=1, max_size=40), st.integers(6, 20))
def test_code_lengths_are_valid_and_best(counts, most):
    bits = code_lengths(np.array(counts), most)
    assert bits.max() <= most
    assert sum(2.0 ** -b for b in bits) <= 1
    if most == 20 and len(counts) <= 16:  # the limit can't bind: as good as plain Huffman
        heap, total = sorted(counts), 0
        while len(heap) > 1:
            a = heap.pop(0) + heap.pop(0)
            total += a
            heap = sorted([*heap, a])
        assert int((bits * counts).sum()) == (total if len(counts) > 1 else counts[0])


@pytest.mark.parametrize("n", [1, 2, 127, 128, 129, 5000])
def test_round_trip(n):
    r = np.random.default_rng(n)
    ids = np.minimum(r.geometric(0.01, n), 50_000)
    book, counts = np.unique(ids, return_counts=True)
    code = Code(book, code_lengths(counts))
    payload, marks = code.encode(ids)
    assert code.decode(payload, marks, n).tolist() == ids.tolist()
    # decoding can start at any checkpoint
    at = np.frombuffer(marks, "<u4")
    assert len(at) == -(-n // 128) and at[0] == 0


def check(spark, docs, got):
    rows = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for doc_id, text in rows:
        ids = [*library_ids(text), 0]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got.collect()), key=lambda r: r[1]) == want


def test_query(spark):
    check(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"), QUERIES["op6_token_id_files"](spark, SF_SMALL))


def test_odd_rows_and_ids(spark, tmp_dir):
    docs = documents(spark, odd_rows())
    write_ids(docs, f"{tmp_dir}/f", default_vocabulary())
    back = read_ids(spark, f"{tmp_dir}/f")
    check(spark, docs, back)
    for r in back.collect():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens
    write_ids(docs.limit(0), f"{tmp_dir}/none", default_vocabulary())
    assert read_ids(spark, f"{tmp_dir}/none").collect() == []


def test_units_that_come_back_stay_in_a_full_table():
    own, learned = IdEncoder(default_vocabulary(), table_units=300), []
    learn = own._learn
    own._learn = lambda units: (learned.append(units.to_pylist()), learn(units))
    for k in range(6):
        text = " ".join([f"common{i}" for i in range(100)] + [f"q{k}x{i}" for i in range(150)])
        assert own.encode(pa.array([text]))[0].tolist() == library_ids(text)
        assert len(own.units) <= 400
    assert [sum("common" in u for u in units) for units in learned] == [100, 0, 0, 0, 0, 0]


def test_words_are_encoded_in_small_calls(monkeypatch):
    texts = [" ".join(f"wort{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(9000))]
    own, most = IdEncoder(default_vocabulary()), []
    between = own.merges

    class Watched:
        def encode_batch_fast(self, some, **kw):
            most.append((len(some), max(map(len, some))))
            return between.encode_batch_fast(some, **kw)

    own.merges = Watched()
    assert own.encode(pa.array(texts))[0].tolist() == library_ids(texts[0])
    assert max(n for n, _ in most) <= 64 and max(x for _, x in most) < 1000
