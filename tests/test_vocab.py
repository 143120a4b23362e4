"""Vocabulary: order, tail drop, guard, distributed numbering."""

import random

import pytest
from pyspark.sql import Window, functions as F

from termflow.operators.tokens import term_counts
from termflow.operators.vocab import (CorpusTooSmall, dropped_terms, ordered_index, rank_terms,
                                      tail_terms, vocabulary, vocabulary_from_ranked)


def _words(n):
    # n distinct letter-only words of length 5
    out, i = [], 0
    while len(out) < n:
        w, k = "", i
        for _ in range(5):
            w += chr(ord("a") + k % 26)
            k //= 26
        out.append(w)
        i += 1
    return out


def _docs(spark, words_with_counts):
    text = " ".join(w for w, c in words_with_counts for _ in range(c))
    return spark.createDataFrame([(0, text)], "doc_id long, text string")


def test_guard_40_raises_41_gives_21(spark):
    w40 = [(w, 1) for w in _words(40)]
    with pytest.raises(CorpusTooSmall, match="Doc too small: 40"):
        vocabulary(term_counts(_docs(spark, w40)))
    w41 = [(w, 1) for w in _words(41)]
    v = vocabulary(term_counts(_docs(spark, w41)))
    assert v.count() == 21


def test_tail_drop_and_ties(spark):
    words = _words(60)
    # counts 3 for the first 20, 2 for the next 20, 1 for the last 20 (ties)
    wc = [(w, 3 if i < 20 else 2 if i < 40 else 1) for i, w in enumerate(words)]
    counts = term_counts(_docs(spark, wc))
    ranked = rank_terms(counts)
    v = vocabulary_from_ranked(ranked).orderBy("term_idx").collect()
    expected = sorted(((-c, w) for w, c in wc))[:40]
    assert [(r.term, r.cnt, r.term_idx) for r in v] == [(w, -c, i) for i, (c, w) in enumerate(expected)]
    dropped = {r.term for r in dropped_terms(ranked).collect()}
    assert dropped == {w for w, c in wc if c == 1}
    assert {r.term for r in tail_terms(counts).collect()} == dropped


def test_head_drop(spark):
    words = _words(50)
    wc = [(w, 50 - i) for i, w in enumerate(words)]
    v = vocabulary(term_counts(_docs(spark, wc)), end="head").orderBy("term_idx").collect()
    assert [r.term for r in v] == words[20:]
    assert [r.term_idx for r in v] == list(range(30))


def test_ordered_index_equals_row_number(spark):
    rnd = random.Random(7)
    rows = [(f"t{i:05d}", rnd.randint(1, 30)) for i in range(5000)]
    df = spark.createDataFrame(rows, "term string, cnt long").repartition(7)
    idx = ordered_index(df, (F.desc("cnt"), F.asc("term")), "idx", num_partitions=6)
    assert idx.total == 5000
    w = Window.orderBy(F.desc("cnt"), F.asc("term"))
    ref = df.withColumn("idx", F.row_number().over(w) - 1)
    got = {(r.term, r.idx) for r in idx.df.collect()}
    assert got == {(r.term, r.idx) for r in ref.collect()}


def test_empty_corpus(spark):
    df = spark.createDataFrame([(0, "a b c")], "doc_id long, text string")
    ranked = rank_terms(term_counts(df))
    assert ranked.total == 0
    with pytest.raises(CorpusTooSmall):
        vocabulary_from_ranked(ranked)


def test_index_documents(spark):
    from termflow.operators.vocab import index_documents

    rows = [(b, f"doc{i:03d}", "text") for b in range(3) for i in range(40)]
    df = spark.createDataFrame(rows, "batch_id int, doc_name string, content string").repartition(5)
    got = index_documents(df, (F.asc("batch_id"), F.asc("doc_name"))).collect()
    want = {(b, n): i for i, (b, n, _) in enumerate(sorted(rows))}
    assert {(r.batch_id, r.doc_name): r.doc_idx for r in got} == want


def test_ordered_index_with_coalesced_ranges(spark):
    """No explicit partition count: AQE coalesces neighbouring ranges and the
    numbering still follows the global order."""
    rnd = random.Random(9)
    rows = [(f"t{i:05d}", rnd.randint(1, 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "term string, cnt long").repartition(5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        idx = ordered_index(df, (F.desc("cnt"), F.asc("term")), "idx")
        got = {(r.term, r.idx) for r in idx.df.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert got == {(t, i) for i, (t, _) in enumerate(want)}


def test_scale_conf():
    from termflow.session import scale_conf

    c = scale_conf(100 << 40)  # 100 TiB
    assert int(c["spark.sql.shuffle.partitions"]) == 200_000
    assert c["spark.sql.adaptive.enabled"] == "true"
    small = scale_conf(1 << 30)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    mid = scale_conf(10 << 40)  # 10 TiB -> 40960 scan splits -> 81920 shuffle partitions
    assert int(mid["spark.sql.shuffle.partitions"]) == 81920
