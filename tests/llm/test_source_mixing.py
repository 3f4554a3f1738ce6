import numpy as np
import pytest
from pyspark.sql import functions as F

from livestats.llm import source_mixing
from livestats.llm.queries import QUERIES
from livestats.llm.source_mixing import TARGETS, domain_labels, fit_rates, mix, places_of, resample
from livestats.llm.source_mixing import _rate as rate

from .helpers import documents, odd_rows, prose

SF = "/root/testdata/sf0.01"


def brute_rates(p, n, targets, steps):
    """Projected gradient on single documents."""
    p, n, targets = (np.asarray(x, float) for x in (p, n, targets))
    total, w = n.sum(), np.ones(len(n))
    share = p.T @ n / total
    for _ in range(steps):
        error = p.T @ (w * n) / total - targets
        if np.abs(error).max() < 1e-7:
            break
        w = np.maximum(0, w - p @ (error / share))
    return w


def test_rates_equal_brute_force(spark):
    r = np.random.default_rng(0)
    p = np.round(r.dirichlet([0.3, 0.3, 0.3], 200), 1)
    p /= p.sum(axis=1, keepdims=True)
    n = r.integers(0, 50, 200)
    rows = spark.createDataFrame([(i, int(t), x.tolist()) for i, (t, x) in enumerate(zip(n, p, strict=True))],
                                 "doc_id long, n_tokens long, p array<double>")
    targets = {"a": 0.5, "b": 0.3, "c": 0.2}
    steps = fit_rates(rows, ["a", "b", "c"], targets)
    got = np.array([x.w for x in rows.withColumn("w", rate(F.col("p"), steps)).orderBy("doc_id").collect()])
    assert np.allclose(got, brute_rates(p, n, [0.5, 0.3, 0.2], 60), atol=1e-9)
    assert np.allclose(p.T @ (got * n) / n.sum(), [0.5, 0.3, 0.2], atol=1e-3) and (got >= 0).all()


def test_query(spark):
    df = QUERIES["op8_soft_mixing"](spark, SF)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = df.toPandas()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert (got.rate >= 0).all() and np.allclose(got[[f"p_{k}" for k in TARGETS]].sum(axis=1), 1)
    for k, target in TARGETS.items():  # nearly: with few labels a plain text's posteriors are not that sure
        share = (got.rate * got.n_tokens * got[f"p_{k}"]).sum() / got.n_tokens.sum()
        assert share == pytest.approx(target, abs=0.05)
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().merge(got, on="doc_id")
    assert labels[(labels.quality == 1) & (labels.toxic == 0)].rate.mean() > 2 * labels[labels.toxic == 1].rate.mean()


def labelled(spark):
    rows = [(i, prose(40, i) + (" stupid moron idiot" if i % 3 == 0 else "")) for i in range(240)]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(0, 240, 2)]
    return documents(spark, [*rows, *[(d if d is None else 1000 + d, t) for d, t in odd_rows()]]), spark.createDataFrame(
        labels + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")


def test_odd_rows(spark):
    docs, labels = labelled(spark)
    got = mix(docs, domain_labels(labels), {"clean": 0.9, "toxic": 0.1}).collect()
    assert len(got) == docs.count()
    of = {r.doc_id: r for r in got}
    assert of[0].p_toxic > 0.9 > 0.5 > of[1].p_toxic and of[1002].n_tokens == 0
    assert mix(docs.limit(0), domain_labels(labels), TARGETS).collect() == []
    alone = mix(docs, domain_labels(labels.limit(0)), TARGETS).collect()
    assert {(r.p_all, r.rate) for r in alone} == {(1.0, 1.0)}


def test_resample_keeps_columns_and_clean_rows(spark):
    docs, labels = labelled(spark)
    out = resample(docs, domain_labels(labels), {"clean": 0.97, "toxic": 0.03})
    assert out.schema == docs.schema
    n = {r.doc_id: r.n for r in out.where("doc_id < 240").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert all(n.get(i, 0) >= 1 for i in range(240) if i % 3)  # rates of clean texts are 1 at least
    assert sum(n.get(i, 0) for i in range(0, 240, 3)) < 60
    assert sorted(map(str, out.collect())) == sorted(map(str, out.collect()))


def test_marks_of_majority_and_rare_domains(spark):
    # the majority's own word is the only mark there is; a domain of three rows has one too
    rows = [(i, prose(40, i) + (" shibboleth" if i % 5 else "")) for i in range(400)]
    labels = [(i, "most" if i % 5 else "rest") for i in range(0, 400, 2)]
    rare = [(1000 + i, prose(40, 1000 + i) + " xylograph quagga okapi") for i in range(6)]
    names = spark.createDataFrame([*labels, *[(d, "rare") for d, _ in rare[:3]]], "doc_id long, domain string")
    got = {r.doc_id: r for r in mix(documents(spark, rows + rare), names, {"most": 0.8, "rest": 0.19, "rare": 0.01}).collect()}
    assert all((got[i].p_most > 0.9) == bool(i % 5) and (got[i].p_rest > 0.5) == (not i % 5) for i in range(400))
    assert min(got[d].p_rare for d, _ in rare) > 5 * max(got[i].p_rare for i in range(400))


def test_perfect_hash():
    r = np.random.default_rng(5)
    for n in (0, 1, 700, 20_000):
        hashes = sorted({int(x) for x in r.integers(-2**63, 2**63 - 1, n)})
        shifts, place = places_of(hashes)
        for k, x in enumerate(hashes, 1):
            assert place[(((x & 2**64 - 1) >> 24) + shifts[x % len(shifts)]) % len(place)] == k


def test_small_posteriors_keep_their_mass(spark):
    # no text belongs to the rare domain by more than 0.8 %
    r = np.random.default_rng(9)
    p = np.array([[1 - x - y, x, y] for x, y in zip(r.random(300), r.random(300) * 0.0078, strict=True)])
    p[:, 0] = np.maximum(p[:, 0], 0)
    p /= p.sum(axis=1, keepdims=True)
    n = r.integers(1, 50, 300)
    rows = spark.createDataFrame([(i, int(t), x.tolist()) for i, (t, x) in enumerate(zip(n, p, strict=True))],
                                 "doc_id long, n_tokens long, p array<double>")
    targets, natural = [0.5, 0.494, 0.006], (p.T @ n / n.sum())[2]
    with pytest.warns(UserWarning, match="miss their targets.*c has"):  # not met yet: reported
        steps = fit_rates(rows, ["a", "b", "c"], dict(zip("abc", targets, strict=True)))
    got = np.array([x.w for x in rows.withColumn("w", rate(F.col("p"), steps)).orderBy("doc_id").collect()])
    assert np.allclose(got, brute_rates(p, n, targets, 300), atol=1e-2)
    assert natural < (p.T @ (got * n) / n.sum())[2] < 0.006 and all(s[2] < 0 for s in steps)


def test_posteriors_are_exact(spark):
    docs, labels = labelled(spark)
    got = mix(docs, domain_labels(labels), {"clean": 0.9, "toxic": 0.1}).where("n_tokens > 0").toPandas()
    assert (got[["p_clean", "p_toxic"]] > 0).all(axis=None)
    share = [(got.rate * got.n_tokens * got[f"p_{k}"]).sum() / got.n_tokens.sum() for k in ("clean", "toxic")]
    assert share == pytest.approx([0.9, 0.1], abs=1e-3)


def test_mostly_clean_corpus_is_not_thinned_out(spark):
    rows = [(i, prose(40, i) + (" stupid moron idiot" if i % 100 == 0 else "")) for i in range(1000)]
    rows += [(2000 + i, prose(60, 2000 + i) + " stupid") for i in range(4)]  # in between
    labels = [(i, "toxic" if i % 100 == 0 else "clean") for i in range(1000)]
    docs = documents(spark, rows)
    names = spark.createDataFrame(labels, "doc_id long, domain string")
    kept = [r.doc_id for r in resample(docs, names, {"clean": 0.97, "toxic": 0.03}, gains="clean").collect()]
    assert {i for i in range(1000) if i % 100} <= set(kept)
    assert sum(not i % 100 for i in kept if i < 1000) <= 10  # toxic texts are not repeated


@pytest.mark.parametrize("most", [1 << 16, 12, 1])
def test_few_cells_fit_the_documents_themselves(spark, monkeypatch, most):
    # merged cells hold texts of different posteriors; the targets are met by the texts nevertheless
    monkeypatch.setattr(source_mixing, "MAX_CELLS", most)
    r = np.random.default_rng(3)
    p, n = r.dirichlet([0.4, 0.3, 0.2], 500), r.integers(1, 50, 500)
    rows = spark.createDataFrame([(i, int(t), x.tolist()) for i, (t, x) in enumerate(zip(n, p, strict=True))],
                                 "doc_id long, n_tokens long, p array<double>").coalesce(1)
    targets = [0.35, 0.35, 0.3]
    steps = fit_rates(rows, ["a", "b", "c"], dict(zip("abc", targets, strict=True)))
    got = np.array([x.w for x in rows.withColumn("w", rate(F.col("p"), steps)).orderBy("doc_id").collect()])
    assert np.allclose(p.T @ (got * n) / n.sum(), targets, atol=2e-6) and (got >= 0).all()
