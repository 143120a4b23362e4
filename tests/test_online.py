"""Online variational Bayes in blocks: equal to a plain numpy loop, on any number of blocks, with nothing whole on the driver."""

import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from termflow.operators import blocks, counted, online, topics
from termflow.operators.em import TopicTables
from termflow.operators.tokens import doc_terms
from termflow.operators.topics import describe_topics, fit_term_topics, fit_text_topics, load_model, save_model, topics_matrix
from test_counted import texts


def plain_online(docs, vocab, k, seed, rounds, offset=1024.0, decay=0.51):
    """The optimizer of ``pyspark.ml`` over all documents, one at a time; ``docs``: {id: {number: count}}."""
    def logs(x):
        return online.digamma(x) - online.digamma(x.sum())

    lines, alpha, eta = online.starts(np.arange(vocab), k, seed, 0).T, np.full(k, 1 / k), 1 / k
    for turn in range(1, rounds + 1):
        beta = np.exp(np.array([logs(x) for x in lines]))
        sums, expected = np.zeros((k, vocab)), []
        for doc, counts in docs.items():
            at, tf = np.array(list(counts)), np.array(list(counts.values()), float)
            gamma = online.starts(np.array([doc]), k, seed, turn)[0]
            theta = np.exp(logs(gamma))
            norm, change = theta @ beta[:, at] + 1e-100, 1.0
            while change > 1e-3:
                last = gamma
                gamma = theta * (beta[:, at] @ (tf / norm)) + alpha
                theta = np.exp(logs(gamma))
                norm = theta @ beta[:, at] + 1e-100
                change = np.abs(gamma - last).sum() / k
            sums[:, at] += np.outer(theta, tf / norm)
            expected.append(logs(gamma))
        rate = (offset + turn) ** -decay
        lines = (1 - rate) * lines + rate * (sums * beta + eta)
        alpha = online.newton_step(alpha, np.mean(expected, axis=0), rate)
    return lines, alpha


@pytest.mark.parametrize("many", [1, 8])
@pytest.mark.parametrize("rounds", [1, 7])
def test_blocks_as_a_plain_loop(spark, monkeypatch, many, rounds):
    rows = texts(60, 9)
    if many > 1:
        monkeypatch.setattr(blocks, "BLOCK_ROWS", sum(len(t or "") for _, t in rows) // counted.BYTES_OF_COUNT // many)
        monkeypatch.setattr(blocks, "SLICE", 16)
        monkeypatch.setattr(online, "BATCH_ROWS", 64)
    fit = fit_text_topics(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), k=3, optimizer="online",
                          max_iter=rounds, seed=6, learningOffset=2.0)
    numbers = {r.term: r.term_idx for r in fit.vocab.collect()}
    docs = {}
    for i, t in rows:
        for w in (t or "").split():
            if i is not None and w in numbers:
                of = docs.setdefault(i, {})
                of[numbers[w]] = of.get(numbers[w], 0) + 1
    lines, alpha = plain_online(docs, fit.vocab_size, 3, 6, rounds, 2.0)
    got = np.zeros_like(lines)
    cells = topics_matrix(fit.model, spark).collect()
    for r in cells:
        got[r.topic, r.term_idx] = r.weight
    # Also the terms that only a document without an id has.
    assert len(cells) == lines.size and np.allclose(got, lines, rtol=1e-7)
    assert abs(fit.model.alpha - 1 - alpha[0]) < 1e-7


def test_no_matrix_on_the_driver(spark, monkeypatch):
    """The text fit does not use the estimator that keeps k x vocabulary numbers there; texts and stored terms give one fit."""
    def none(*a, **k):
        raise AssertionError("pyspark.ml")

    monkeypatch.setattr(topics, "lda", none)
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    a, b = fit_text_topics(docs, k=2, optimizer="online", max_iter=3), fit_term_topics(doc_terms(docs), k=2, optimizer="online", max_iter=3)
    assert isinstance(a.model, TopicTables)
    a, b = ({(r.topic, r["rank"], r.term): r.weight for r in describe_topics(x).collect()} for x in (a, b))
    assert a.keys() == b.keys() and all(abs(a[x] - b[x]) < 1e-9 for x in a)


def test_saved_and_loaded(spark, tmp_dir):
    fit = fit_text_topics(spark.createDataFrame(texts(), "doc_id long, text string"), k=2, optimizer="online", max_iter=2)
    save_model(fit.model, f"{tmp_dir}/online")
    again = load_model(f"{tmp_dir}/online")
    assert sorted(again.terms.collect()) == sorted(fit.model.terms.collect()) and again.alpha == fit.model.alpha


def test_other_settings_are_those_of_the_estimator(spark):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    assert not isinstance(fit_text_topics(docs, k=2, optimizer="online", max_iter=2, subsamplingRate=0.5).model, TopicTables)
    assert not isinstance(fit_text_topics(docs, k=2, optimizer="ml-online", max_iter=2).model, TopicTables)


def test_functions():
    x, h = np.array([0.05, 0.3, 1.0, 7.5, 300.0]), 1e-5
    assert np.allclose(online.digamma(x), [(math.lgamma(v + h) - math.lgamma(v - h)) / (2 * h) for v in x], atol=1e-5)
    assert np.allclose(online.trigamma(x), (online.digamma(x + h) - online.digamma(x - h)) / (2 * h), rtol=1e-5)
    s = online.starts(np.arange(-20_000, 20_000), 4, 1, 2)
    assert abs(s.mean() - 1) < 0.002 and abs(s.std() - 0.1) < 0.002 and abs(np.corrcoef(s.T)[0, 1]) < 0.02
    assert not np.allclose(s[:5], online.starts(np.arange(-20_000, 20_000), 4, 1, 3)[:5])


def test_rectangles_hold_each_row_once():
    sizes = np.array([3, 1, 1, 50, 7, 2, 1, 20])
    seen = [at[there] for _, at, there in online.by_size(sizes)]
    assert sorted(np.concatenate(seen).tolist()) == list(range(sizes.sum()))
    docs = np.concatenate([d for d, _, _ in online.by_size(sizes)])
    assert sorted(docs.tolist()) == list(range(len(sizes)))
