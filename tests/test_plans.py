"""Physical-plan properties the design relies on at scale."""


from termflow.operators import prices as P
from termflow.operators import scores as sc
from termflow.operators.tokens import term_counts, term_tokens
from termflow.plans import QUERIES

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_term_counts_partial_aggregate_and_single_tokenising(spark):
    plan = _plan(QUERIES["term_counts"](spark, SF_SMALL))
    assert "partial_count" in plan
    # no filter inferred from explode: the tokenising expression is not
    # evaluated a second time at the scan
    assert "size(filter" not in plan
    assert "ReadSchema: struct<text:string>" in plan or "struct<doc_id:bigint,text:string>" in plan


def test_top_terms_limit_before_shuffle(spark):
    topics = spark.createDataFrame([(t % 2, f"w{t}", float(t)) for t in range(100)],
                                   "topic int, term string, weight double")
    plan = _plan(sc.top_terms(topics, 10))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_daily_bars_hash_aggregate(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    plan = _plan(P.daily_bars(ev))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_doc_term_tf_broadcasts_checked_vocabulary(spark):
    plan = _plan(QUERIES["doc_term_tf"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_hot_term_and_hot_label(spark):
    """One term is a third of all tokens and one label holds most documents:
    results stay exact."""
    rows = [(i, "lang_a" if i % 10 else "lang_b",
             " ".join(["hotterm"] * 20 + [f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}"] * 40))
            for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    counts = dict(term_counts(docs).collect())
    assert counts["hotterm"] == 600 * 20
    assert sum(counts.values()) == 600 * 60
    top = sc.top_terms(sc.label_topics(term_tokens(docs, keep=("lang",)), "lang"), 1).collect()
    assert {(r.topic, r.term) for r in top} == {("lang_a", "hotterm"), ("lang_b", "hotterm")}
    w = {r.topic: r.weight for r in top}
    assert abs(w["lang_a"] - 1 / 3) < 1e-12 and abs(w["lang_b"] - 1 / 3) < 1e-12


def test_doc_term_table_shuffle_path_equals_broadcast_path(spark):
    """A vocabulary above the broadcast limit takes a shuffle join; the rows
    are the same."""
    from termflow.operators.vectors import doc_term_table

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    small, _, n = doc_term_table(docs)
    want = sorted(map(tuple, small.collect()))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:  # a large vocabulary: Spark's own size check would not broadcast it either
        spark.conf.set(k, "-1")
    try:
        big, _, _ = doc_term_table(docs, max_broadcast_bytes=250)
        assert n > 10
        plan = _plan(big)
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        got = sorted(map(tuple, big.collect()))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == want


def test_doc_term_tf_head_tail_equals_broadcast(spark):
    from termflow.operators.tokens import term_counts as tc
    from termflow.operators.vectors import doc_term_tf
    from termflow.operators.vocab import rank_terms, vocabulary_from_ranked

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    ranked = rank_terms(tc(docs))
    vocab = vocabulary_from_ranked(ranked)
    a = doc_term_tf(term_tokens(docs), vocab, vocab_rows=ranked.total)
    b = doc_term_tf(term_tokens(docs), vocab, vocab_rows=ranked.total, max_broadcast_bytes=600)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_top_label_terms_equals_full_topic_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    tokens = term_tokens(docs, keep=("lang",))
    full = sc.top_terms(sc.label_topics(tokens, "lang")).select("topic", "rank", "term", "tf", "weight")
    fast = sc.top_label_terms(tokens, "lang")
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, fast.collect()))
    plan = _plan(fast)
    assert "WindowGroupLimit" in plan


def test_broadcast_head_is_bounded_by_bytes(spark):
    from termflow.operators.joins import head_that_fits

    vocab = spark.createDataFrame([(i, "x" * (1000 if i == 2 else 4)) for i in range(64)], "term_idx long, term string")
    assert head_that_fits(vocab, 64, 10_000) == 64
    assert head_that_fits(vocab, 64, 1100) == 4      # 1000 + 3 * 4 + 4 * 16
    assert head_that_fits(vocab, 64, 900) == 2
    assert head_that_fits(vocab, 64, 1) == 0 and head_that_fits(vocab.limit(0), 0) == 0


def test_tail_is_a_top_k_and_labels_meet_folded_rows(spark):
    assert "TakeOrderedAndProject" in _plan(QUERIES["tail_dropped_terms"](spark, SF_SMALL))
    plan = _plan(QUERIES["quality_term_counts"](spark, SF_SMALL))
    join = plan[plan.index("Join"):]
    assert "partial_count" in join  # the texts are folded below the join
