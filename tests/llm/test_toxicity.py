import zlib

import numpy as np
import pyarrow as pa
import pytest

from termflow.llm.toxicity import BREAKS, Ftrl, distinct, features, fit, op8_toxicity, reject_toxic, toxic_scores, train
from termflow.llm.words import cut


def hash_free_features(text):
    """Words, pairs and skip-grams by plain Python, as a set of tuples."""
    words = "".join(c if c.isalnum() or c == "'" or ord(c) > 127 else " " for c in text.lower()).split()
    return ({("w", a) for a in words} | {("p", a, b) for a, b in zip(words, words[1:])}
            | {("s", a, b) for a, b in zip(words, words[2:])})


@pytest.mark.parametrize("text", ["", "  ", "one", "one two", "a b c a b c", "Don't, DON'T! it's###x", "é à é", "x " * 500])
def test_features_are_those_of_plain_python(text):
    row, index = distinct(*features(cut(pa.array(["before me", text, "after"]), True, BREAKS), 40), 40)
    assert (row == 1).sum() == len(hash_free_features(text))


def test_train_against_one_coordinate_at_a_time():
    rng = np.random.default_rng(1)
    rows = [(np.unique(rng.integers(0, 16, 5)), int(rng.integers(0, 2))) for _ in range(60)]
    s = Ftrl(bits=4, l1=0.5, epochs=2)
    z, n, zb, nb = [0.0] * 16, [0.0] * 16, 0.0, 0.0

    def weight(i):
        if abs(z[i]) <= s.l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * s.l1) / ((s.beta + n[i]**0.5) / s.alpha + s.l2)

    for index, y in rows * 2:
        wb = -zb / ((s.beta + nb**0.5) / s.alpha)
        w = {i: weight(i) for i in index}
        g = 1 / (1 + np.exp(-(wb + sum(w.values())))) - y
        for i in index:
            sigma = ((n[i] + g * g)**0.5 - n[i]**0.5) / s.alpha
            z[i] += g - sigma * w[i]
            n[i] += g * g
        zb += g - ((nb + g * g)**0.5 - nb**0.5) / s.alpha * wb
        nb += g * g
    got = train([(np.asarray(index).astype("<u4").tobytes(), y) for index, y in rows], s)
    assert got.index.tolist() == [i for i in range(16) if abs(z[i]) > s.l1]
    assert np.allclose(got.weight, [weight(i) for i in got.index])
    assert np.isclose(got.intercept, -zb / ((s.beta + nb**0.5) / s.alpha))


def test_held_out_accuracy(spark):
    """Scores of rows that were not learned from tell toxic from other texts."""
    sf = "/root/testdata/sf0.1"
    got = op8_toxicity(spark, sf).toPandas()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got.held_out.tolist() == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    rows = got.merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    rows = rows[rows.held_out]
    bad, good = rows[rows.toxic == 1], rows[rows.toxic == 0]
    assert (bad.predicted == 1).mean() > 0.65 and (good.predicted == 1).mean() < 0.01
    order = np.concatenate([bad.score, good.score]).argsort(kind="stable").argsort(kind="stable")[:len(bad)]
    assert (order.sum() - len(bad) * (len(bad) - 1) / 2) / (len(bad) * len(good)) > 0.95


@pytest.fixture()
def small(spark):
    rows = [(i, f"nice words number {i} {'you idiot' if i % 2 else 'dear friend'}", "s", i) for i in range(60)]
    rows += [(None, None, "s", 0), (99, "", "t", 1), (7, rows[7][1], "u", 2), (8, "idiot " * 20_000, "v", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, label int")
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(0, 60)] + [(None, 1, "x"), (5, None, "x")],
                                   "doc_id long, toxic int, text string")
    return docs, labels


def test_edge_rows(spark, small):
    docs, labels = small
    got = toxic_scores(docs, labels, Ftrl(l1=0.1), column="p").collect()
    by = {(r.doc_id, r.score): r.p for r in got}
    assert len(got) == docs.count()
    assert by[(None, "s")] == by[(99, "t")]  # the intercept alone
    assert by[(7, "s")] == by[(7, "u")]
    assert by[(7, "s")] > by[(6, "s")] and by[(8, "v")] > by[(8, "s")]
    assert reject_toxic(docs, labels).columns == docs.columns
    assert reject_toxic(docs, labels.limit(0)).count() == docs.count()
    assert toxic_scores(docs.limit(0), labels).collect() == []


def test_the_sample_is_bounded(spark, small):
    docs, labels = small
    assert len(fit(docs, labels, Ftrl(max_rows=1, l1=0.0)).index) < 40
