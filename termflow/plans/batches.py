"""Registered queries over a corpus that comes in batches: signed count deltas
and vocabulary numbers of changed terms. A document's batch is its number modulo 4;
every batch is read whole."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from termflow.operators.deltas import CountState
from termflow.operators.ranks import OrderIndex
from termflow.operators.tokens import term_tokens
from termflow.plans.corpus import documents
from termflow.plans.oracle import _NORMALIZED, _tokens
from termflow.session import delete_path, ensure_checkpoint_dir, stored

BATCHES, WITHDRAWN = 4, 2


def batch_tokens(spark, sf_dir):
    return term_tokens(documents(spark, sf_dir), keep=()).withColumn("batch", F.pmod("doc_id", F.lit(BATCHES)))


def q_corpus_counts_after_withdrawal(spark, sf_dir):
    """Term counts after four batches, merges, a replay, and a batch withdrawn again."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/counts-{uuid.uuid4().hex}"
    state = CountState(spark, path, merge_every=2)
    tokens = batch_tokens(spark, sf_dir)
    for b in range(BATCHES):
        state.add(b, tokens.where(F.col("batch") == b))
    state.add(1, tokens.where(F.col("batch") == 1))  # a replay
    state.withdraw(WITHDRAWN)
    counts, _ = stored(state.counts(), "corpus-counts")
    delete_path(spark, path)
    return counts


def q_vocab_numbers_of_last_batch(spark, sf_dir):
    """Number and count of each term that the last of four batches changed."""
    tokens = batch_tokens(spark, sf_dir).groupBy("batch", "term").agg(F.count("*").alias("delta"))
    tokens, path = stored(tokens, "batch-counts")
    index = OrderIndex.of(tokens.where("batch = 0").select("term", F.col("delta").alias("cnt")))
    for b in range(1, BATCHES):
        old = index
        index, numbers = old.changed_by(tokens.where(F.col("batch") == b).select("term", "delta"))
        old.delete()
    out, _ = stored(numbers, "numbers")
    index.delete()
    delete_path(spark, path)
    return out


QUERIES = {
    "corpus_counts_after_withdrawal": q_corpus_counts_after_withdrawal,
    "vocab_numbers_of_last_batch": q_vocab_numbers_of_last_batch,
}

_BATCH_TOKENS = _tokens(_NORMALIZED.replace("SELECT doc_id,", f"SELECT doc_id % {BATCHES} AS batch,"), "batch")
ORACLE = {
    "corpus_counts_after_withdrawal": f"""
        SELECT term, count(*) AS cnt FROM ({_BATCH_TOKENS}) t WHERE batch <> {WITHDRAWN} GROUP BY term""",
    "vocab_numbers_of_last_batch": f"""
        SELECT term, cnt, number FROM (
            SELECT term, cnt, last, row_number() OVER (ORDER BY cnt DESC, term ASC) - 1 AS number
            FROM (SELECT term, count(*) AS cnt, max(batch) AS last FROM ({_BATCH_TOKENS}) t GROUP BY term) c) r
        WHERE last = {BATCHES - 1}""",
}
