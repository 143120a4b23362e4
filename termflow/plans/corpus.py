"""Registered corpus queries: each takes ``(spark, sf_dir)`` and returns a
DataFrame over the given tables (``documents``, ``conversations``,
``pages``, ``labels``), whole tables and whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from termflow.functions.json import decode_scores
from termflow.functions.text import is_not_blank, normalize_lines, notice
from termflow.operators import scores as sc
from termflow.operators.tokens import term_counts, term_tokens, word_count_raw
from termflow.operators.vectors import doc_term_table
from termflow.operators.vocab import (index_documents, rank_terms, tail_terms, vocab_size,
                                      vocabulary_from_ranked)
from termflow.session import spread
from termflow.sources.tables import read_table
from termflow.sources.text import lines_of


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    cols = cols or ("doc_id", "text")
    return spread(read_table(spark, sf_dir, "documents").select(*cols))


def q_term_counts(spark, sf_dir):
    return term_counts(documents(spark, sf_dir))


def q_term_rank(spark, sf_dir):
    r = rank_terms(term_counts(documents(spark, sf_dir)))
    return r.df.select("term", "cnt", "rank")


def q_tail_dropped_terms(spark, sf_dir):
    return tail_terms(term_counts(documents(spark, sf_dir)))


def q_vocabulary(spark, sf_dir):
    return vocabulary_from_ranked(rank_terms(term_counts(documents(spark, sf_dir))))


def q_vocab_size(spark, sf_dir):
    return vocab_size(term_counts(documents(spark, sf_dir)))


def q_doc_term_tf(spark, sf_dir):
    tf, _, _ = doc_term_table(documents(spark, sf_dir))
    return tf


def q_word_count_raw(spark, sf_dir):
    return word_count_raw(lines_of(documents(spark, sf_dir)))


def q_doc_lines(spark, sf_dir):
    return lines_of(documents(spark, sf_dir), keep=("doc_id",))


def q_nonblank_lines(spark, sf_dir):
    lines = lines_of(documents(spark, sf_dir), keep=("doc_id",))
    return lines.filter(is_not_blank("value")).select("doc_id", "line_no")


def q_doc_filter(spark, sf_dir):
    """Documents that are not blank in Java terms (null or only chars
    <= U+0020 are dropped)."""
    return documents(spark, sf_dir).filter(is_not_blank("text")).select("doc_id")


def q_normalized_docs(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", normalize_lines("text").alias("content"))


def q_arrival_notices(spark, sf_dir):
    pages = spread(read_table(spark, sf_dir, "pages").select("page_id", "url"))
    return (pages.filter(F.col("url").isNotNull())
            .select("page_id", notice("url").alias("value")))


def q_conversation_term_counts(spark, sf_dir):
    conv = spread(read_table(spark, sf_dir, "conversations").select("text"))
    return term_counts(conv)


def _top_label_terms(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    return sc.top_label_terms(term_tokens(docs, keep=("lang",)), "lang")


def q_top_terms_by_label(spark, sf_dir):
    return _top_label_terms(spark, sf_dir).select(
        "topic", F.col("rank").cast("int").alias("rank"), "term", "tf", "weight")


def q_merged_scores_last(spark, sf_dir):
    return sc.merge_scores(_top_label_terms(spark, sf_dir), "last")


def q_merged_scores_max(spark, sf_dir):
    return sc.merge_scores(_top_label_terms(spark, sf_dir), "max")


def q_top_scores(spark, sf_dir):
    return sc.top_scores(q_merged_scores_last(spark, sf_dir))


def q_score_json_roundtrip(spark, sf_dir):
    msg = sc.score_message(q_top_scores(spark, sf_dir))
    parsed = sc.read_score_messages(msg)
    return parsed.select(F.explode("scores").alias("term", "score"))


def q_display_words(spark, sf_dir):
    return sc.display_words(q_top_scores(spark, sf_dir))


def q_quality_term_counts(spark, sf_dir):
    """Term counts per quality label of the labelled documents. Texts are folded
    to (document, term, count) before they meet the labels."""
    per_doc = (term_tokens(documents(spark, sf_dir)).groupBy("doc_id", "term")
               .agg(F.count(F.lit(1)).alias("tf")))
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return per_doc.join(labels, "doc_id").groupBy("quality", "term").agg(F.sum("tf").alias("cnt"))


def _edge_texts(spark, sf_dir):
    """Texts of the documents with each kind of edge: blank, null, carriage
    returns, adjacent and trailing spaces, control characters."""
    n = F.col("doc_id") % 7
    return documents(spark, sf_dir).select("doc_id", (
        F.when(n == 0, F.lit(None).cast("string")).when(n == 1, F.lit(" \t\r\n\x00 "))
        .when(n == 2, F.regexp_replace("text", "\n", "\r")).when(n == 3, F.regexp_replace("text", "\n", "\r\n"))
        .when(n == 4, F.regexp_replace("text", " ", "  ")).when(n == 5, F.concat("text", F.lit("  \n\n")))
        .otherwise(F.col("text"))).alias("text"))


def q_edge_doc_filter(spark, sf_dir):
    return _edge_texts(spark, sf_dir).filter(is_not_blank("text")).select("doc_id")


def q_edge_normalized_docs(spark, sf_dir):
    return _edge_texts(spark, sf_dir).select("doc_id", normalize_lines("text").alias("content"))


def q_edge_word_count_raw(spark, sf_dir):
    return word_count_raw(lines_of(_edge_texts(spark, sf_dir)))


def q_edge_arrival_notices(spark, sf_dir):
    """Notices of pages of which every third has no name."""
    pages = spread(read_table(spark, sf_dir, "pages").select("page_id", "url"))
    named = pages.withColumn("url", F.when(F.col("page_id") % 3 != 0, F.col("url")))
    return (named.filter(F.col("url").isNotNull())
            .select("page_id", notice("url").alias("value")))


def _source_terms(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text", "source")
    return sc.top_label_terms(term_tokens(docs, keep=("source",)), "source")


def q_source_scores_last(spark, sf_dir):
    """Sources share many of their top terms, so the overlap rule decides."""
    return sc.merge_scores(_source_terms(spark, sf_dir), "last")


def q_source_scores_max(spark, sf_dir):
    return sc.merge_scores(_source_terms(spark, sf_dir), "max")


def q_batch_union_counts(spark, sf_dir):
    """Term counts of a corpus that arrived in four batches: the union of the
    batches up to each one."""
    per_batch = (term_tokens(documents(spark, sf_dir).withColumn("batch_id", F.col("doc_id") % 4), keep=("batch_id",))
                 .groupBy("batch_id", "term").agg(F.count(F.lit(1)).alias("n")))
    upto = per_batch.select("term", "n", F.explode(F.sequence("batch_id", F.lit(3).cast("long"))).alias("batch_id"))
    return upto.groupBy("batch_id", "term").agg(F.sum("n").alias("cnt"))


def q_document_index(spark, sf_dir):
    """Conversations' turns numbered in the order of conversation and turn."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return index_documents(turns, [F.col("conv_id"), F.col("turn")])


def q_score_messages(spark, sf_dir):
    """Good and bad score messages: objects of numbers are parsed, all others
    keep their text alone."""
    n = F.col("doc_id") % 6
    word = F.concat(F.lit("w"), F.col("doc_id").cast("string"))
    good = F.to_json(F.map_from_arrays(F.array(word), F.array(F.col("doc_id") / 8)))
    value = (F.when(n == 0, F.concat(good, F.lit(" junk"))).when(n == 1, F.concat(F.lit("["), good, F.lit("]")))
             .when(n == 2, word).when(n == 3, F.concat(F.lit('{"'), word, F.lit('":"x"}')))
             .when(n == 4, F.lit("{}")).otherwise(good))
    rows = read_table(spark, sf_dir, "documents").select("doc_id", value.alias("value"))
    return rows.select("doc_id", F.col("value").alias("raw"), F.size(decode_scores("value")).alias("n_scores"),
                       decode_scores("value")[word].alias("score"))


QUERIES = {
    "term_counts": q_term_counts,
    "term_rank": q_term_rank,
    "tail_dropped_terms": q_tail_dropped_terms,
    "vocabulary": q_vocabulary,
    "vocab_size": q_vocab_size,
    "doc_term_tf": q_doc_term_tf,
    "word_count_raw": q_word_count_raw,
    "doc_lines": q_doc_lines,
    "nonblank_lines": q_nonblank_lines,
    "doc_filter": q_doc_filter,
    "normalized_docs": q_normalized_docs,
    "arrival_notices": q_arrival_notices,
    "conversation_term_counts": q_conversation_term_counts,
    "quality_term_counts": q_quality_term_counts,
    "top_terms_by_label": q_top_terms_by_label,
    "merged_scores_last": q_merged_scores_last,
    "merged_scores_max": q_merged_scores_max,
    "top_scores": q_top_scores,
    "score_json_roundtrip": q_score_json_roundtrip,
    "display_words": q_display_words,
    "edge_doc_filter": q_edge_doc_filter,
    "edge_normalized_docs": q_edge_normalized_docs,
    "edge_word_count_raw": q_edge_word_count_raw,
    "edge_arrival_notices": q_edge_arrival_notices,
    "source_scores_last": q_source_scores_last,
    "source_scores_max": q_source_scores_max,
    "batch_union_counts": q_batch_union_counts,
    "document_index": q_document_index,
    "score_messages": q_score_messages,
}
