"""Topic models: invariants, planted topics, repeatability, save/load."""

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from termflow.operators.topics import (describe_topics, fit_numeric_topics, fit_text_topics,
                                       load_model, save_model, topics_matrix)
from termflow.plans.topics import topic_scores

from conftest import SF_SMALL

def _group(prefix: str, n: int = 40) -> list[str]:
    letters = "abcdefghijklmnopqrstuvwxyz"
    return [prefix + letters[i // 26] + letters[i % 26] for i in range(n)]


# Three planted topics with disjoint words (enough of them that dropping
# the 20 rarest terms leaves most of each group).
GROUPS = [_group("fru"), _group("too"), _group("mus")]


@pytest.fixture(scope="module")
def planted(spark):
    rnd = random.Random(1)
    rows, i = [], 0
    for g in GROUPS:
        for _ in range(300):
            rows.append((i, " ".join(rnd.choice(g) for _ in range(40))))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("optimizer", ["online", "em"])
def test_planted_topics_recovered(spark, planted, optimizer):
    fit = fit_text_topics(planted, k=3, optimizer=optimizer, max_iter=30, seed=3)
    d = describe_topics(fit, 5).collect()
    by_topic = {}
    for r in d:
        by_topic.setdefault(r.topic, []).append(r.term)
    assert len(by_topic) == 3
    groups_hit = set()
    for terms in by_topic.values():
        owners = {gi for gi, g in enumerate(GROUPS) for t in terms if t in g}
        assert len(owners) == 1, terms
        groups_hit |= owners
    assert groups_hit == {0, 1, 2}


def test_text_lda_invariants(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    fit = fit_text_topics(docs, k=10, optimizer="em", max_iter=5, seed=42)
    d = describe_topics(fit)
    rows = d.collect()
    assert {r.topic for r in rows} == set(range(10))
    vocab = {r.term_idx: r.term for r in fit.vocab.collect()}
    assert fit.vocab_size == len(vocab)
    for t in range(10):
        tr = sorted((r for r in rows if r.topic == t), key=lambda r: r.rank)
        assert len(tr) == 10 and len({r.term for r in tr}) == 10
        w = [r.weight for r in tr]
        assert all(x > 0 for x in w) and w == sorted(w, reverse=True)
        assert all(vocab[r.term_idx] == r.term for r in tr)
    scores = topic_scores(d).collect()
    assert len(scores) == 10
    assert [s.score for s in scores] == sorted((s.score for s in scores), reverse=True)


def test_seed_fixes_em_whatever_the_partitions(spark, planted):
    """The features' partitions and order are fixed, so the input's do not matter."""
    def weights(docs):
        fit = fit_text_topics(docs, k=3, max_iter=8, seed=5)
        return {(r.topic, r.term_idx): r.weight for r in topics_matrix(fit.model, spark).collect()}
    a, b = weights(planted.repartition(2)), weights(planted.repartition(5))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-6 for k in a)


def test_online_reads_every_document():
    from termflow.operators.topics import lda

    assert lda(3, "online").getSubsamplingRate() == 1.0


def test_em_keeps_each_terms_count(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    fit = fit_text_topics(docs, k=4, max_iter=3)
    mass = {r.term_idx: r.m for r in topics_matrix(fit.model, spark).groupBy("term_idx").agg(F.sum("weight").alias("m")).collect()}
    assert len(mass) == fit.vocab_size
    assert all(abs(mass[r.term_idx] - r.cnt) < 1e-6 for r in fit.vocab.collect())


def test_numeric_lda_and_save_load(spark, tmp_dir):
    rnd = random.Random(11)
    # a 12 x 11 matrix of small counts, the shape of the original sample
    rows = [(i, [float(rnd.randint(0, 9)) for _ in range(11)]) for i in range(12)]
    vec = spark.createDataFrame(rows, "id long, values array<double>")
    model = fit_numeric_topics(vec, k=3, seed=1, optimizer="ml-em")
    assert model.vocabSize() == 11
    m = topics_matrix(model, spark)
    assert m.count() == 33
    dense = model.topicsMatrix().toArray()
    for r in m.collect():
        assert r.weight == dense[r.term_idx, r.topic]
    path = f"{tmp_dir}/lda"
    save_model(model, path)
    again = load_model(path)
    assert np.allclose(model.topicsMatrix().toArray(), again.topicsMatrix().toArray())
    ours = topics_matrix(fit_numeric_topics(vec.drop("id"), k=3, seed=1), spark)
    mass = {r.term_idx: r.m for r in ours.groupBy("term_idx").agg(F.sum("weight").alias("m")).collect()}
    assert all(abs(mass[p] - sum(v[p] for _, v in rows)) < 1e-9 for p in range(11))


def test_empty_document_kept(spark):
    from termflow.operators.vectors import sparse_vectors

    tf = spark.createDataFrame([(1, 0, 2), (1, 3, 1), (2, 1, 5)], "doc_id long, term_idx long, tf long")
    ids = spark.createDataFrame([(0,), (1,), (2,), (2,)], "doc_id long")
    got = {r.doc_id: r.features for r in sparse_vectors(tf, ids, 4, 3).collect()}
    assert {k: v.toArray().tolist() for k, v in got.items()} == {
        0: [0, 0, 0, 0], 1: [2, 0, 0, 1], 2: [0, 5, 0, 0]}
    assert got[0].numNonzeros() == 0


@pytest.mark.parametrize("shape, whole", [("lda_topic_shape", "lda_text_topics"), ("topic_score_shape", "lda_scores")])
def test_shapes_are_of_the_published_fit(monkeypatch, shape, whole):
    """Both ask for the same fit; nothing is fitted here."""
    from termflow.plans import topics

    class Asked(Exception):
        pass

    def asked(docs, **settings):
        raise Asked(settings)

    monkeypatch.setattr(topics, "documents", lambda spark, sf_dir: None)
    monkeypatch.setattr(topics, "fit_text_topics", asked)
    settings = []
    for name in (shape, whole):
        with pytest.raises(Asked) as e:
            topics.QUERIES[name](None, "")
        settings.append(e.value.args[0])
    assert settings[0] == settings[1]
