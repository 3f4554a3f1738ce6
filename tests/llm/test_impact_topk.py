import numpy as np
import pytest

from livestats.llm.impact_topk import Index, top_k
from livestats.llm.queries import QUERIES

from ..conftest import SF_SMALL


def brute(rows, k=20, every=20):
    own = [(i, np.floor(np.array(v, float) * 64).astype(int)) for i, v in rows
           if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in own:
        if q % every:
            continue
        best = sorted((-int(v[:min(len(v), len(x))] @ x[:min(len(v), len(x))]), i) for i, x in own if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def rows_of(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert rows_of(QUERIES["op5_impact_topk"](spark, SF_SMALL)) == brute(rows)


@pytest.mark.parametrize("blocks", [(16384, 1024), (150, 8)])
def test_ties_and_odd_vectors(spark, blocks):
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.round(r.normal(0, 0.2, 8), 1)]) for i in range(700)]
    rows += [(700 + i, [0.1] * 8) for i in range(300)]
    rows += [(1000, None), (1020, []), (1040, [None] * 8), (1060, [float("nan")] * 8), (1080, [float("inf")] + [0.0] * 7),
             (None, [0.1] * 8), (1100, [0.5] * 3), (1120, [0.0] * 8)]
    table = spark.createDataFrame([(*x, 1, 2.0) for x in rows],
                                  "vec_id long, embedding array<float>, v int, score double").repartition(4)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = rows_of(top_k(table, vector_block=blocks[0], query_block=blocks[1]))
    assert got == brute(rows)


def test_few_and_no_rows(spark):
    table = spark.createDataFrame([(0, [1.0]), (20, [2.0]), (3, [3.0])], "vec_id long, embedding array<float>")
    assert rows_of(top_k(table)) == [(0, 1, 3, 64 * 192), (0, 2, 20, 64 * 128), (20, 1, 3, 128 * 192), (20, 2, 0, 128 * 64)]
    assert top_k(table.limit(0)).collect() == []


def test_members_are_proved_and_few():
    r = np.random.default_rng(2)
    vectors = np.floor(r.normal(0, 0.125, (3000, 64)) * 64).astype(np.int64)
    ids = np.arange(3000)
    found = Index(vectors).search(vectors[:40], ids[:40], ids, 20)
    for q, at in enumerate(found):
        scores = vectors @ vectors[q]
        scores[q] = np.iinfo(np.int64).min
        best = np.lexsort((ids, -scores))[:20]
        assert set(best) <= set(at)
    assert np.mean([len(at) for at in found]) < 1500  # it stops before all are possible
