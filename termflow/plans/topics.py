"""Registered topic-model queries. The topics depend on the optimizer and the
seed and have no SQL; what holds for any fit does: EM keeps each term's count
over the topics, and described topics are distinct terms of the vocabulary in
descending order of weight."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from termflow.functions.constants import TOP_SCORES
from termflow.operators import scores as sc
from termflow.operators.em import (DOC_FACTOR, ETA, PRIME, ROW_FACTOR, SHIFT, TERM_FACTOR, TOPIC_FACTOR, TopicTables,
                                   fit_tables)
from termflow.operators.tokens import term_tokens
from termflow.operators.topics import (TopicFit, describe_topics, fit_numeric_topics, fit_text_topics,
                                       fold_in_documents, load_fit, save_fit, topics_matrix)
from termflow.operators.vectors import doc_term_table
from termflow.operators.vocab import vocabulary
from termflow.plans.corpus import documents
from termflow.plans.oracle import CORPUS_SQL, _NORMALIZED as NORMALIZED_SQL, _tokens as tokens_sql
from termflow.session import delete_path, ensure_checkpoint_dir
from termflow.sources.tables import read_table
from termflow.sources.text import numeric_vectors

SEED = 42


def q_lda_text_topics(spark, sf_dir):
    """Text LDA as the original jobs ran it (EM, k=10), described."""
    return describe_topics(fit_text_topics(documents(spark, sf_dir), optimizer="em", seed=SEED))


def q_lda_text_topics_online(spark, sf_dir):
    """The same with the online optimizer, every document in every iteration."""
    return describe_topics(fit_text_topics(documents(spark, sf_dir), optimizer="online",
                                           seed=SEED))


def topic_scores(described, n: int = TOP_SCORES):
    """Described topics → ``term, score``: merged (last topic wins), top n."""
    return sc.top_scores(sc.merge_scores(described, "last"), n)


def q_lda_scores(spark, sf_dir):
    return topic_scores(q_lda_text_topics(spark, sf_dir))


def q_lda_term_mass(spark, sf_dir):
    """Each term's weight over all topics of the EM model: its count in the
    corpus, if every token of every document entered the fit."""
    fit = fit_text_topics(documents(spark, sf_dir), optimizer="em", seed=SEED)
    mass = topics_matrix(fit.model, spark).groupBy("term_idx").agg(F.round(F.sum("weight"), 6).alias("mass"))
    return fit.vocab.select("term_idx", "term").join(mass, "term_idx")


def q_lda_topic_shape(spark, sf_dir):
    """Of each described topic: distinct terms, those whose name and number agree
    with the vocabulary, and whether weights are positive and descend."""
    fit = fit_text_topics(documents(spark, sf_dir), optimizer="em", seed=SEED)
    vocab = fit.vocab.select("term", F.col("term_idx").alias("number"))
    rows = describe_topics(fit).join(vocab, "term")
    order = F.transform(F.sort_array(F.collect_list(F.struct("rank", "weight"))), lambda x: x["weight"])
    return rows.groupBy("topic").agg(
        F.countDistinct("term").alias("terms"), F.sum((F.col("number") == F.col("term_idx")).cast("int")).alias("named"),
        ((F.min("weight") > 0) & (order == F.sort_array(F.collect_list("weight"), asc=False))).alias("descending"))


def q_topic_score_shape(spark, sf_dir):
    """The published scores: how many, how many of the vocabulary, in order."""
    fit = fit_text_topics(documents(spark, sf_dir), optimizer="em", seed=SEED)
    scores = topic_scores(describe_topics(fit))
    return scores.join(fit.vocab.select("term"), "term").agg(
        F.count("*").alias("scores"), F.countDistinct("term").alias("terms"), (F.min("score") > 0).alias("positive"))


def q_numeric_lines(spark, sf_dir):
    """Lines of space-separated counts: one per user, the user's number of
    events of each type (types in name order), as a text matrix."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_type")
    counts = ev.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    # The types of events in order, which is the width of every line: one value.
    types = ev.agg(F.sort_array(F.collect_set("event_type")).alias("types")).scalar()
    of = counts.groupBy("user_id").agg(F.map_from_entries(
        F.collect_list(F.struct("event_type", "n"))).alias("of"))
    line = F.array_join(F.transform("types", lambda t: F.coalesce(F.col("of")[t], F.lit(0)).cast("string")), " ")
    return of.withColumn("types", types).select("user_id", line.alias("value"))


def q_numeric_vectors(spark, sf_dir):
    vec = numeric_vectors(q_numeric_lines(spark, sf_dir), id_col="user_id")
    return vec.select(F.col("id").alias("user_id"),
                      F.posexplode("values").alias("pos", "value"))


def q_lda_numeric(spark, sf_dir):
    """Numeric LDA (EM, k=3) on the count lines; the weight of each place over
    the topics, which is its total count."""
    vec = numeric_vectors(q_numeric_lines(spark, sf_dir), id_col="user_id")
    matrix = topics_matrix(fit_numeric_topics(vec, seed=SEED), spark)
    return matrix.groupBy("term_idx").agg(F.count("*").alias("topics"), F.round(F.sum("weight"), 6).alias("mass"))


#: Topics, seed and priors of the checked EM rounds.
ROUND_TOPICS, FOLD_ROUNDS = 3, 3


def one_round(spark, sf_dir):
    """The state of EM over all documents after its start and one round."""
    tf, vocab, size = doc_term_table(documents(spark, sf_dir))
    return fit_tables(tf, ROUND_TOPICS, size, rounds=1, seed=SEED), vocab


def q_lda_em_round(spark, sf_dir):
    """The topic-term matrix after the start and one EM round."""
    model, _ = one_round(spark, sf_dir)
    return model.matrix().select("topic", "term_idx", F.round("weight", 6).alias("weight"))


def q_lda_round_topics(spark, sf_dir):
    """The ten heaviest terms of each topic after one round, by name."""
    model, vocab = one_round(spark, sf_dir)
    return describe_topics(TopicFit(model, vocab, model.vocab_size)).select(
        "topic", "rank", "term_idx", "term", F.round("weight", 9).alias("weight"))


def q_lda_fold_in(spark, sf_dir):
    """Topic shares of the conversations in topics that are the documents' languages,
    from a model bundle that was saved and loaded again."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    tokens = term_tokens(docs, keep=("lang",))
    vocab = vocabulary(tokens.groupBy("term").agg(F.count("*").alias("cnt")))
    langs = [r["lang"] for r in docs.select("lang").distinct().orderBy("lang").collect()]  # one topic each
    counts = tokens.join(vocab.select("term", "term_idx"), "term").groupBy("term_idx").agg(
        *[F.sum(F.col("lang").eqNullSafe(lang).cast("double")).alias(f"n{t}") for t, lang in enumerate(langs)])
    size = vocab.count()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bundle-{uuid.uuid4().hex}"
    save_fit(TopicFit(TopicTables(counts, len(langs), size, FOLD_ALPHA), vocab, size), path)
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "text")
    shares = fold_in_documents(load_fit(spark, path), turns, id_col="conv_id", rounds=FOLD_ROUNDS)
    delete_path(spark, path)
    return shares.select("conv_id", "topic", F.round("share", 9).alias("share"))


FOLD_ALPHA = 1.5

QUERIES = {
    "lda_em_round": q_lda_em_round,
    "lda_round_topics": q_lda_round_topics,
    "lda_fold_in": q_lda_fold_in,
    "numeric_lines": q_numeric_lines,
    "numeric_vectors": q_numeric_vectors,
    "lda_numeric": q_lda_numeric,
    "lda_text_topics": q_lda_text_topics,
    "lda_text_topics_online": q_lda_text_topics_online,
    "lda_scores": q_lda_scores,
    "lda_term_mass": q_lda_term_mass,
    "lda_topic_shape": q_lda_topic_shape,
    "topic_score_shape": q_topic_score_shape,
}

_NUMERIC_LINES = """
    SELECT user_id,
           array_to_string(list_transform(
               (SELECT list(DISTINCT event_type ORDER BY event_type) FROM events),
               lambda t: CAST(coalesce(counts[t], 0) AS VARCHAR)), ' ') AS value
    FROM (SELECT user_id, map(list(event_type), list(n)) AS counts
          FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) c
          GROUP BY user_id) m"""

def _share(value: str, of: str, key: str) -> str:
    return f"{value} / sum({value}) OVER (PARTITION BY {key}) {of}"


# EM in long form: a row for each (document, term, topic).
_START = f"""
    SELECT doc_id, term_idx, tf, t AS topic,
           (m * m % {PRIME} % 1000 + 1)::DOUBLE AS u
    FROM (SELECT doc_id, term_idx, tf, t,
                 (((doc_id % {PRIME}) * {DOC_FACTOR} + term_idx * {TERM_FACTOR} + {SEED}) % {PRIME} * {ROW_FACTOR}
                  + {TOPIC_FACTOR} * t + {SHIFT}) % {PRIME} AS m
          FROM (SELECT doc_id, term_idx, tf, unnest(range({ROUND_TOPICS})) AS t FROM ({CORPUS_SQL['doc_term_tf']}) c) x) y"""
_EM_ROUND = f"""
    WITH s AS (
        SELECT doc_id, term_idx, tf, topic, tf * {_share('u', 'AS s', 'doc_id, term_idx')} FROM ({_START}) z
    ), terms AS (
        SELECT term_idx, topic, sum(s) AS n FROM s GROUP BY 1, 2
    ), docs AS (
        SELECT doc_id, topic, sum(s) AS n FROM s GROUP BY 1, 2
    ), p AS (
        SELECT term_idx, topic, (n + {ETA} - 1) / (sum(n) OVER (PARTITION BY topic)
               + (SELECT count(DISTINCT term_idx) FROM terms) * ({ETA} - 1)) AS p FROM terms
    ), w AS (
        SELECT s.doc_id, s.term_idx, s.tf, s.topic, p.p * (docs.n + {50 / ROUND_TOPICS}) AS w
        FROM s JOIN p USING (term_idx, topic) JOIN docs USING (doc_id, topic)
    )
    SELECT term_idx, topic, sum(g) AS weight
    FROM (SELECT term_idx, topic, tf * {_share('w', 'AS g', 'doc_id, term_idx')} FROM w) q GROUP BY 1, 2"""
_CONV_TF = f"""
    SELECT conv_id, term_idx, count(*) AS tf FROM ({tokens_sql(NORMALIZED_SQL.replace('doc_id', 'conv_id').replace(
        'documents', 'conversations'), 'conv_id')}) t JOIN ({CORPUS_SQL['vocabulary']}) v USING (term) GROUP BY 1, 2"""
_LANG_COUNTS = f"""
    SELECT term_idx, lang, count(*) AS c FROM ({tokens_sql(NORMALIZED_SQL.replace(
        'SELECT doc_id,', 'SELECT lang,'), 'lang')}) t JOIN ({CORPUS_SQL['vocabulary']}) v USING (term) GROUP BY 1, 2"""


def _fold(rounds: int) -> str:
    step = "".join(f""", w{i} AS (
        SELECT b.conv_id, b.term_idx, b.topic, b.tf * (b.p * (d.n + {FOLD_ALPHA} - 1))
               / sum(b.p * (d.n + {FOLD_ALPHA} - 1)) OVER (PARTITION BY b.conv_id, b.term_idx) AS g
        FROM b JOIN d{i} d USING (conv_id, topic)
    ), d{i + 1} AS (SELECT conv_id, topic, sum(g) AS n FROM w{i} GROUP BY 1, 2)""" for i in range(rounds))
    return f"""
    WITH langs AS (
        SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS topic FROM (SELECT DISTINCT lang FROM documents) x
    ), c AS MATERIALIZED ({_LANG_COUNTS}), v AS (SELECT count(*) AS size FROM ({CORPUS_SQL['vocabulary']}) x
    ), p AS (
        SELECT t.term_idx, l.topic, (coalesce(c.c, 0) + {ETA} - 1) / (sum(coalesce(c.c, 0)) OVER (PARTITION BY l.topic)
               + (SELECT size FROM v) * ({ETA} - 1)) AS p
        FROM (SELECT DISTINCT term_idx FROM c) t CROSS JOIN langs l LEFT JOIN c ON c.term_idx = t.term_idx AND c.lang = l.lang
    ), b AS MATERIALIZED (
        SELECT x.conv_id, x.term_idx, x.tf, p.topic, p.p FROM ({_CONV_TF}) x JOIN p USING (term_idx)
    ), d0 AS (
        SELECT conv_id, topic, sum(tf) / (SELECT count(*) FROM langs) AS n FROM b GROUP BY 1, 2
    ){step}
    SELECT conv_id, CAST(topic AS INTEGER) AS topic, round(share, 9) AS share
    FROM (SELECT conv_id, topic, (n + {FOLD_ALPHA} - 1) / sum(n + {FOLD_ALPHA} - 1) OVER (PARTITION BY conv_id) AS share
          FROM d{rounds}) z"""


ORACLE = {
    "lda_em_round": f"SELECT CAST(topic AS INTEGER) AS topic, term_idx, round(weight, 6) AS weight FROM ({_EM_ROUND}) r",
    "lda_round_topics": f"""
        SELECT CAST(topic AS INTEGER) AS topic, CAST(rank AS INTEGER) AS rank, term_idx, term, round(share, 9) AS weight FROM (
            SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term_idx) - 1 AS rank FROM (
                SELECT topic, term_idx, weight, weight / sum(weight) OVER (PARTITION BY topic) AS share FROM ({_EM_ROUND}) r) x) y
        JOIN ({CORPUS_SQL['vocabulary']}) v USING (term_idx) WHERE rank < 10""",
    "lda_fold_in": _fold(FOLD_ROUNDS),
    "lda_term_mass": f"SELECT term_idx, term, CAST(cnt AS DOUBLE) AS mass FROM ({CORPUS_SQL['vocabulary']}) v",
    "lda_topic_shape": """
        SELECT CAST(unnest(range(10)) AS INTEGER) AS topic, CAST(10 AS BIGINT) AS terms,
               CAST(10 AS BIGINT) AS named, true AS descending""",
    "topic_score_shape": "SELECT CAST(10 AS BIGINT) AS scores, CAST(10 AS BIGINT) AS terms, true AS positive",
    "lda_numeric": """
        SELECT row_number() OVER (ORDER BY event_type) - 1 AS term_idx, CAST(3 AS BIGINT) AS topics,
               CAST(count(*) AS DOUBLE) AS mass FROM events GROUP BY event_type""",
    "numeric_lines": _NUMERIC_LINES,
    "numeric_vectors": f"""
        SELECT user_id, CAST(unnest(range(len(parts))) AS INTEGER) AS pos,
               unnest(list_transform(parts, lambda x: CAST(x AS DOUBLE))) AS value
        FROM (SELECT user_id, string_split(trim(value), ' ') AS parts
              FROM ({_NUMERIC_LINES}) l) p""",
}
