import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa

from livestats.llm import nbsvm_quality
from livestats.llm.common import release
from livestats.llm.nbsvm_quality import Rows, features, fit, fit_linear, score
from livestats.llm.queries import QUERIES
from livestats.llm.words import words

from .helpers import documents, odd_rows, prose

SF = "/root/testdata/sf0.01"


def test_words_and_features():
    texts = pa.array(["Hello  World\tfoo", "", "Éa bé\n cc", "x" * 200 + " " + "x" * 199 + "y"])
    w = words(texts)
    assert w.counts.tolist() == [3, 0, 3, 2]
    assert len(set(w.hashes().tolist())) == 8
    whole, counts = features(texts)
    assert counts.sum() == len(whole) and counts[1] > 0
    # a slice of an array has the features of its own rows
    part, n = features(texts.slice(2, 1))
    assert part.tolist() == np.split(whole, np.cumsum(counts)[:-1])[2].tolist() and n.tolist() == [counts[2]]


def test_dual_coordinate_descent_separates():
    r = np.random.default_rng(0)
    labels = (np.arange(200) % 4 > 0).astype(np.int64)
    lists = [np.unique(np.concatenate((r.integers(100, 200, 20), [7 if y else 8]))) for y in labels]
    rows = Rows(np.concatenate(lists), np.array([len(x) for x in lists]), labels)
    model = fit_linear(rows)
    assert ((model.margins(rows.features, rows.counts) > 0) == (labels == 1)).all()
    scores = fit(rows).scores(rows.features, rows.counts)
    assert scores[labels == 1].min() > scores[labels == 0].max()


def test_held_out_accuracy(spark):
    got = QUERIES["op3_nbsvm_quality"](spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(got) == docs
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in got.doc_id]).all()
    assert ((got.score >= 0.3) == (got.predicted == 1)).all()
    both = got[got.held_out].merge(labels, on="doc_id")
    assert (both.predicted == both.quality).mean() > 0.95


def test_labels_are_no_inputs_of_a_score(spark):
    """Changing held-out labels changes nothing; equal texts have equal scores."""
    texts = [(i, prose(60, i) if i % 4 else " | ".join(prose(30, i).upper().split()) + "!!") for i in range(200)]
    labels = [(i, 1 if i % 4 else 0) for i in range(200)]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    docs = documents(spark, [*texts, (900, texts[1][1])])
    a, b = ({r.doc_id: r.score for r in score(docs, spark.createDataFrame(x, "doc_id long, quality int")).collect()}
            for x in (labels, flipped))
    assert a == b and a[900] == a[1] and a[1] > 0.3 > a[4]


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = score(docs, none).collect()
    assert len(got) == len(odd_rows()) and {r.score for r in got} == {0.5}
    one = spark.createDataFrame([(6, 1), (6, 1), (None, 0), (9, None)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in score(docs, one).collect())
    assert score(docs.limit(0), one).collect() == []
    kept = score(docs, one, keep=tuple(c for c in docs.columns if c != "score"))
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in odd_rows()}


def test_driver_gives_the_memory_of_the_fit_back(spark, monkeypatch):
    r = np.random.default_rng(1)

    def rows(*_):
        counts = r.integers(200, 600, nbsvm_quality.MAX_ROWS)
        return Rows((r.zipf(1.3, counts.sum()) % nbsvm_quality.N_FEATURES).astype(np.int64), counts,
                    (np.arange(len(counts)) % 4 > 0).astype(np.int64))

    def own_mb():
        return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024

    monkeypatch.setattr(nbsvm_quality, "sample_rows", rows)
    docs = documents(spark, [(1, "one text")])
    release()
    before = own_mb()
    scored = score(docs, docs)  # the sample is not read
    assert own_mb() - before < 50
    assert scored.count() == 1
