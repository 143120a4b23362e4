"""Documents counted in blocks: the counts, vocabulary and fit of the rows they stand for."""

import random
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from termflow.operators import blocks, counted, topics
from termflow.operators.tokens import doc_terms, explode_items
from termflow.operators.em import fit_tables
from termflow.operators.topics import describe_topics, fit_term_topics, fit_text_topics, topics_matrix
from termflow.operators.vectors import term_table

WORDS = [f"word{a}{b}" for a in "abcdefgh" for b in "abcdefghij"]


def texts(n=70, seed=4):
    """Repeated ids, ids and texts that are null, empty texts, a word of documents without an id."""
    rnd = random.Random(seed)
    rows = [(rnd.choice([i, i, i // 2, None]), " ".join(rnd.choice(WORDS).replace("word", "wort") for _ in range(rnd.randint(0, 30))))
            for i in range(n)]
    return rows + [(1, None), (None, None), (3, ""), (None, "onlyhere onlyhere onlyhere"), (n, "")]


@pytest.fixture(params=[1, 9])
def docs(spark, request, monkeypatch):
    rows = texts()
    if request.param > 1:
        size = sum(len(t or "") for _, t in rows) // counted.BYTES_OF_COUNT
        monkeypatch.setattr(blocks, "BLOCK_ROWS", size // request.param)
        monkeypatch.setattr(blocks, "SLICE", 16)
        monkeypatch.setattr(counted, "WORDS", 7)
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_counts_of_blocks_are_those_of_rows(spark, docs):
    rows, n = counted.dealt(docs.withColumnRenamed("doc_id", "id"), "text", F.octet_length("text"), 2)
    got = counted.CountedBlocks(doc_terms(rows, "text", "id", keep=("block",)), n)
    want = Counter(w for _, t in texts() for w in (t or "").split())
    assert {r.term: r.cnt for r in got.term_counts().collect()} == want
    assert got.words().count() == got.words().select("block", "term").distinct().count()
    assert got.words().select("block").distinct().count() >= n - 1
    got.delete()


@pytest.mark.parametrize("stored_terms", [False, True])
def test_fit_is_that_of_the_rows(spark, docs, stored_terms):
    if stored_terms:
        fit = fit_term_topics(doc_terms(docs), k=3, max_iter=4)
    else:
        fit = fit_text_topics(docs, k=3, max_iter=4)
    tf, vocab, size = term_table(explode_items(doc_terms(docs), "terms", "term", keep=("doc_id",)))
    rows = fit_tables(tf, 3, size, 4)
    assert fit.vocab_size == size and sorted(fit.vocab.collect()) == sorted(vocab.select("term", "cnt", "term_idx").collect())
    weights = [{(r.topic, r.term_idx): r.weight for r in topics_matrix(m, spark).collect()} for m in (fit.model, rows)]
    assert weights[0].keys() == weights[1].keys() and all(abs(w - weights[1][x]) < 1e-9 for x, w in weights[0].items())
    both = [{r.doc_id: (r.n0, r.n1, r.n2) for r in m.docs.collect()} for m in (fit.model, rows)]
    assert both[0].keys() == both[1].keys() and all(np.allclose(both[0][x], both[1][x]) for x in both[0])
    assert describe_topics(fit).count() == 30


def test_ids_that_are_texts(spark):
    rows = [(f"d{i}" if i is not None else None, t) for i, t in texts()]
    fit = fit_text_topics(spark.createDataFrame(rows, "doc_id string, text string"), k=2, max_iter=2)
    known = {r.term for r in fit.vocab.collect()}
    assert {r.doc_id for r in fit.model.docs.collect()} == {i for i, t in rows if i and set((t or "").split()) & known}


def test_no_row_of_a_document_and_a_term_is_shuffled(spark, docs, monkeypatch):
    """The whole text path reads each text once and never makes the table of (document, term) rows."""
    def none(*a, **k):
        raise AssertionError("a table of all rows")

    monkeypatch.setattr(topics, "term_table", none)
    assert fit_text_topics(docs, k=2, max_iter=1).vocab_size > 0


def test_terms_of_blocks_are_not_broadcast(spark, docs, tmp_dir):
    """Their lists look small to Spark, their rows grow with the corpus."""
    rows, n = counted.dealt(docs.withColumnRenamed("doc_id", "id"), "text", F.octet_length("text"), 2)
    got = counted.CountedBlocks(doc_terms(rows, "text", "id", keep=("block",)), n)
    vocab = spark.createDataFrame([("a", 0)], "term string, term_idx long").localCheckpoint()
    assert "Broadcast" not in got.numbered(vocab, tmp_dir)._jdf.queryExecution().executedPlan().toString()
    got.delete()


def test_blocks_fill_the_cores():
    """No round ends with one block on one core, and blocks grow by a quarter at most."""
    assert [blocks.whole_waves(n, 8) for n in (1, 5, 8, 9, 10, 11, 16, 100)] == [1, 5, 8, 8, 8, 16, 16, 80]
    assert blocks.whole_waves(18, 12) == 24
    assert all(blocks.whole_waves(n, c) % c == 0 and 5 * blocks.whole_waves(n, c) >= 4 * n for c in (1, 3, 8, 12) for n in range(c + 1, 200))
