"""EM as joins, model bundles and fold-in, against numpy and pyspark.ml."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from termflow.operators import em
from termflow.operators.em import fit_tables, fold_in, log_likelihood, next_tables
from termflow.operators.topics import (TopicFit, describe_topics, fit_text_topics, fold_in_documents, load_fit,
                                       load_model, save_fit, save_model, topics_matrix)

ROWS = "doc_id long, term_idx long, tf long"


def counts(seed, docs=40, terms=30):
    rng = random.Random(seed)
    return [(d * 7919, t, rng.randint(1, 5)) for d in range(docs) for t in range(terms) if rng.random() < 0.9 / (1 + t / 6)]


def start(rows, k, seed):
    out = []
    for d, t, tf in rows:
        at = (d % em.PRIME * em.DOC_FACTOR + t * em.TERM_FACTOR + seed) % em.PRIME
        u = np.array([((at * em.ROW_FACTOR + em.TOPIC_FACTOR * j + em.SHIFT) % em.PRIME) ** 2 % em.PRIME % 1000 + 1 for j in range(k)], float)
        out.append(tf * u / u.sum())
    return np.array(out)


def numpy_em(rows, k, seed, rounds, alpha=None, eta=em.ETA):
    """(term table, doc table, log likelihood) by dense arrays."""
    alpha = alpha or 50 / k + 1
    ds, d = np.unique([r[0] for r in rows], return_inverse=True)
    ts, t = np.unique([r[1] for r in rows], return_inverse=True)
    tf, g = np.array([r[2] for r in rows], float), start(rows, k, seed)
    for i in range(rounds + 1):
        n_t, n_d = np.zeros((len(ts), k)), np.zeros((len(ds), k))
        np.add.at(n_t, t, g)
        np.add.at(n_d, d, g)
        p = (n_t + eta - 1) / (n_t.sum(axis=0) + len(ts) * (eta - 1))
        theta = (n_d + alpha - 1) / (n_d + alpha - 1).sum(axis=1, keepdims=True)
        w = p[t] * theta[d]
        if i < rounds:
            g = tf[:, None] * w / w.sum(axis=1, keepdims=True)
    return dict(zip(ts.tolist(), n_t)), dict(zip(ds.tolist(), n_d)), float((tf * np.log(w.sum(axis=1))).sum())


@pytest.mark.parametrize("k,rounds,bound", [(2, 0, 64 << 20), (3, 4, 64 << 20), (5, 3, 0), (3, 3, 400)])
def test_rounds_as_numpy(spark, k, rounds, bound):
    rows = counts(k)
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    size = len({r[1] for r in rows})
    model = fit_tables(df, k, size, rounds, seed=9, max_broadcast_bytes=bound)
    terms, docs, likelihood = numpy_em(rows, k, 9, rounds)
    for r in model.terms.collect():
        assert np.allclose([r[f"n{t}"] for t in range(k)], terms[r.term_idx])
    for r in model.docs.collect():
        assert np.allclose([r[f"n{t}"] for t in range(k)], docs[r.doc_id])
    assert abs(log_likelihood(df, model, bound) - likelihood) < 1e-6 * abs(likelihood)


def test_posterior_rises_every_round(spark):
    model = fit_tables(spark.createDataFrame(counts(1), ROWS), 4, 30, 8, watch=True)
    seen = model.log_posteriors
    assert len(seen) == 9 and all(b > a - 1e-7 for a, b in zip(seen, seen[1:])) and seen[-1] > seen[0]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(6)
    groups = [[f"{p}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)] for p in ("fru", "too", "mus")]
    rows = [(i, " ".join(rng.choice(groups[i % 3]) for _ in range(40))) for i in range(300)]
    return spark.createDataFrame(rows, "doc_id long, text string"), groups


def test_likelihood_near_that_of_spark_ml(spark, corpus):
    docs, _ = corpus
    # A start may take its time (seed 3 needs some 40 rounds here), so both get 50.
    ours = fit_text_topics(docs, k=3, max_iter=50, seed=3)
    theirs = fit_text_topics(docs, k=3, max_iter=50, seed=3, optimizer="ml-em")
    from termflow.operators.vectors import doc_term_table

    tf, _, _ = doc_term_table(docs)
    mine = log_likelihood(tf.withColumn("tf", F.col("tf").cast("double")), ours.model)
    assert mine > theirs.model.trainingLogLikelihood() * 1.01  # both are negative: within 1 %, or better


def test_same_fit_for_3_and_300_partitions(spark, corpus):
    docs, _ = corpus

    def fitted(n):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            model = fit_text_topics(docs.repartition(n), k=3, max_iter=4).model
            return {(r.topic, r.term_idx): r.weight for r in model.matrix().collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)

    a, b = fitted(3), fitted(300)
    assert a.keys() == b.keys() and max(abs(a[x] - b[x]) for x in a) < 1e-7


def test_nothing_but_the_last_tables_stays(spark, tmp_path):
    rows = spark.createDataFrame(counts(2), ROWS)
    model = fit_tables(rows, 2, 30, 3)
    from termflow.session import path_exists

    assert len(model.paths) == 2 and all(path_exists(spark, p) for p in model.paths)
    again = next_tables(rows.withColumn("tf", F.col("tf").cast("double")), model)
    model.delete()
    assert not any(path_exists(spark, p) for p in model.paths) and again.terms.count() == 30
    assert model.vocab_size == 30


def test_rows_that_take_no_part(spark):
    rows = counts(3)
    more = [(1, 2, 0), (1, 3, -4), (None, 3, 5), (5, None, 2)]
    a = fit_tables(spark.createDataFrame(rows, ROWS), 2, 30, 2).terms.collect()
    b = fit_tables(spark.createDataFrame(rows + more, ROWS), 2, 30, 2).terms.collect()
    for x, y in zip(sorted(a), sorted(b)):
        assert np.allclose(x, y)
    empty = fit_tables(spark.createDataFrame([], ROWS), 2, 0, 2)
    assert empty.terms.count() == 0 and empty.docs.count() == 0 and empty.described(5).count() == 0


def test_a_saved_fit_names_its_terms_and_folds_in(spark, corpus, tmp_dir):
    docs, groups = corpus
    fit = fit_text_topics(docs, k=3, max_iter=15)
    path = f"{tmp_dir}/bundle"
    assert save_fit(fit, path, source="test") == 1
    again = load_fit(spark, path)
    assert sorted(map(tuple, describe_topics(again).collect())) == sorted(map(tuple, describe_topics(fit).collect()))
    new = spark.createDataFrame([(1, " ".join(groups[0][:30])), (2, " ".join(groups[1][:30])), (3, " ".join(groups[0][5:20])),
                                 (4, "nothing known here"), (5, None)], "doc_id long, text string")
    shares = {}
    for r in fold_in_documents(again, new).collect():
        shares.setdefault(r.doc_id, {})[r.topic] = r.share
    best = {d: max(s, key=s.get) for d, s in shares.items()}
    assert set(shares) == {1, 2, 3} and best[1] == best[3] != best[2]
    assert all(abs(sum(s.values()) - 1) < 1e-9 for s in shares.values())


def test_fold_in_as_numpy(spark):
    rows = counts(4)
    model = fit_tables(spark.createDataFrame(rows, ROWS), 3, 30, 3)
    p = {r.term_idx: np.array([r[f"p{t}"] for t in range(3)]) for r in model.term_probabilities().collect()}
    new = [(1, 0, 3), (1, 5, 1), (1, 99, 7), (2, 4, 2), (3, 99, 1)]
    got = {(r.doc_id, r.topic): r.share for r in fold_in(spark.createDataFrame(new, ROWS), model, rounds=6).collect()}
    a, want = model.alpha - 1, {}
    for d in (1, 2):
        mine = [(p[t], tf) for x, t, tf in new if x == d and t in p]
        n = np.full(3, sum(tf for _, tf in mine) / 3)
        for _ in range(6):
            n = sum(tf * q * (n + a) / (q * (n + a)).sum() for q, tf in mine)
        want |= {(d, t): (n[t] + a) / (n + a).sum() for t in range(3)}
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-12 for x in got)


def test_versions_and_unfinished_ones(spark, corpus, tmp_dir):
    docs, _ = corpus
    path = f"{tmp_dir}/bundle"
    with pytest.raises(FileNotFoundError):
        load_fit(spark, path)
    one, two = (fit_text_topics(docs, k=k, max_iter=1) for k in (2, 3))
    save_fit(one, path)
    save_fit(two, path)
    two.model.terms.write.parquet(f"{path}/version=3/topics")  # stopped before its settings
    assert load_fit(spark, path).model.k == 3 and load_fit(spark, path, 1).model.k == 2
    with pytest.raises(FileNotFoundError):
        load_fit(spark, path, 3)
    assert save_fit(one, path) == 3 and load_fit(spark, path).model.k == 2


def test_models_of_spark_ml_as_bundles(spark, corpus, tmp_dir):
    docs, _ = corpus
    fit = fit_text_topics(docs, k=3, max_iter=5, optimizer="online")
    save_fit(fit, f"{tmp_dir}/b")
    again = load_fit(spark, f"{tmp_dir}/b")
    a = {(r.topic, r.term_idx): r.weight for r in topics_matrix(fit.model, spark).collect()}
    b = {(r.topic, r.term_idx): r.weight for r in topics_matrix(again.model, spark).collect()}
    assert a == b
    assert {r.term for r in describe_topics(again).collect()} == {r.term for r in describe_topics(fit).collect()}


def test_models_without_vocabulary(spark, tmp_dir):
    model = fit_tables(spark.createDataFrame(counts(5), ROWS), 2, 30, 2)
    save_model(model, f"{tmp_dir}/m")
    again = load_model(f"{tmp_dir}/m")
    assert sorted(map(tuple, again.matrix().collect())) == sorted(map(tuple, model.matrix().collect()))
    assert load_fit(spark, f"{tmp_dir}/m").vocab is None and isinstance(TopicFit(again, None, 30), TopicFit)


def test_the_term_table_is_broadcast_only_within_its_bound(spark):
    rows = spark.createDataFrame(counts(6), ROWS).withColumn("tf", F.col("tf").cast("double"))
    model = fit_tables(rows, 2, 30, 1)
    plan = em.with_terms(rows, model.terms, 2, 1 << 40, 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint" not in plan.replace("strategy=broadcast", "") or plan.count("broadcast") <= 1
    head = em.with_terms(rows, model.terms, 2, 30, 10 * 32)
    assert head.count() == rows.count()
