"""From topics to published scores.

    topic table (topic, term, weight)
      -> top terms per topic          row_number() <= 10 per topic
      -> one score per term           last topic wins (or the max)
      -> top 10 scores                top-k
      -> {term: score} JSON           one message
      -> display words                size = 10 + score * 1000, by size

Top-k per topic uses ``row_number() <= k``: Spark plans a partial
``WindowGroupLimit`` before the shuffle, so each map task sends at most k
rows per topic and a topic holding most of the terms costs no more than a
small one. The merge is a hash aggregate with partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from termflow.functions.constants import TERMS_PER_TOPIC, TOP_SCORES
from termflow.functions.json import decode_scores, encode_scores
from termflow.functions.text import display_size


def label_topics(tokens: DataFrame, label_col: str) -> DataFrame:
    """A deterministic topic table from labelled term occurrences: the label
    is the topic and a term's weight is its share of the label's tokens.
    ``topic, term, tf, weight``."""
    tf = tokens.groupBy(label_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    # Totals come from the (label, term) aggregate, so the tokens are read
    # once (the exchange is reused). A window over the label would put every
    # term of a label in one task; the join instead lets AQE broadcast the
    # one-row-per-label side from its measured size.
    totals = tf.groupBy(label_col).agg(F.sum("tf").alias("_total"))
    return (tf.join(totals, label_col)
            .select(F.col(label_col).alias("topic"), "term", "tf",
                    (F.col("tf") / F.col("_total")).alias("weight")))


def top_label_terms(tokens: DataFrame, label_col: str, k: int = TERMS_PER_TOPIC) -> DataFrame:
    """The k heaviest terms of each label topic (see :func:`label_topics`),
    ``topic, rank, term, tf, weight``, without a join on the label over all
    terms.

    Within a label the share ``tf / total`` orders exactly like ``tf`` (one
    positive divisor), so the top k are picked by ``tf`` (partial group
    limit before the shuffle), and only those k rows per label meet the
    per-label totals. A label holding most of the corpus never becomes a
    hot join key.
    """
    tf = tokens.groupBy(label_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    picked = top_terms(tf.select(F.col(label_col).alias("topic"), "term", "tf",
                                 F.col("tf").alias("weight")), k).drop("weight")
    totals = (tf.groupBy(label_col).agg(F.sum("tf").alias("_total"))
              .withColumnRenamed(label_col, "topic"))
    return picked.join(totals, "topic").select(
        "topic", "rank", "term", "tf", (F.col("tf") / F.col("_total")).alias("weight"))


def top_terms(topics: DataFrame, k: int = TERMS_PER_TOPIC) -> DataFrame:
    """The k heaviest terms of each topic (ties by term ascending), with
    ``rank`` 0..k-1."""
    w = Window.partitionBy("topic").orderBy(F.desc("weight"), F.asc("term"))
    # The filter must be on row_number() itself for Spark to plan the
    # partial WindowGroupLimit (top k per map task) before the shuffle.
    return (topics.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= F.lit(k))
            .withColumn("rank", F.col("_rn") - 1).drop("_rn"))


def merge_scores(described: DataFrame, overlap: str = "last") -> DataFrame:
    """One score per term, ``term, score``. A term described in several
    topics keeps the weight of the last topic (``overlap='last'``, as the
    original map did) or its largest weight (``overlap='max'``).

    The input is the described topics, at most k rows per topic, so the
    plan's aggregate (sort-based when topics are strings) is small at any
    corpus size."""
    if overlap == "last":
        agg = F.max_by("weight", "topic")
    elif overlap == "max":
        agg = F.max("weight")
    else:
        raise ValueError(f"overlap must be 'last' or 'max', not {overlap!r}")
    return described.groupBy("term").agg(agg.alias("score"))


def top_scores(scores: DataFrame, n: int = TOP_SCORES) -> DataFrame:
    """The n highest scores (ties by term ascending)."""
    return scores.orderBy(F.desc("score"), F.asc("term")).limit(n)


def score_message(scores: DataFrame) -> DataFrame:
    """One row, ``value``: the JSON object ``{term: score}`` of the given
    (already limited) scores. An empty input gives ``{}``."""
    return scores.agg(F.coalesce(encode_scores("term", "score"), F.lit("{}")).alias("value"))


def read_score_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse score messages; a value that is not a JSON object of numbers
    gives a NULL ``scores`` map and keeps ``raw``."""
    return messages.select(F.col(value_col).alias("raw"),
                           decode_scores(value_col).alias("scores"))


def display_words(scores: DataFrame) -> DataFrame:
    """``text, size`` for the word cloud, largest first."""
    return (scores.select(F.col("term").alias("text"), display_size("score").alias("size"))
            .orderBy(F.desc("size"), F.asc("text")))
