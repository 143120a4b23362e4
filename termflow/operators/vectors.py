"""Documents as term-count vectors.

Two forms:

* SQL form, ``doc_id, term_idx, tf`` (coordinate rows): fully distributed,
  any vocabulary size, checked exactly against SQL.
* ML form, ``doc_id, features`` (sparse ``Vector``) for Spark ML, assembled
  from the coordinate rows; no vocabulary passes through one task or the driver.
"""

from __future__ import annotations

import uuid

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from termflow.functions.constants import TAIL_DROP
from termflow.operators.joins import MAX_BROADCAST_BYTES, head_that_fits
from termflow.operators.tokens import term_tokens
from termflow.operators.vocab import rank_terms, vocabulary_from_ranked
from termflow.session import checkpoint, ensure_checkpoint_dir


def doc_term_tf(tokens: DataFrame, vocab: DataFrame, id_col: str = "doc_id",
                vocab_rows: int = 0, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Term occurrences ``id_col, term`` → ``id_col, term_idx, tf`` for terms
    in the vocabulary of ``vocab_rows`` rows.

    With a broadcastable vocabulary the join runs map-side first, so the
    aggregate shuffles small ``(doc, number)`` keys and out-of-vocabulary tokens
    never reach the shuffle. Otherwise tokens are first folded per
    ``(doc, term)`` and looked up with :func:`head_tail_lookup`.
    """
    head = head_that_fits(vocab, vocab_rows, max_broadcast_bytes)
    if 0 < vocab_rows <= head:
        joined = tokens.join(F.broadcast(vocab.select("term", "term_idx")), "term")
        return joined.groupBy(id_col, "term_idx").agg(F.count(F.lit(1)).alias("tf"))
    per_doc = tokens.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    return head_tail_lookup(per_doc, vocab, head).select(id_col, "term_idx", "tf")


def term_table(tokens: DataFrame, id_col: str = "doc_id", drop: int = TAIL_DROP, end: str = "tail",
               max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, DataFrame, int]:
    """Term occurrences ``id_col, term`` → ``(tf, vocab, vocab_rows)``.

    Occurrences are folded once per ``(doc, term)`` and that table is
    checkpointed; the corpus counts (a sum over it), the vocabulary and the
    final lookup all read it, so the text is read and tokenised once.
    ``tf`` is ``id_col, term_idx, tf``; ``vocab`` is ``term, cnt, term_idx``.
    """
    per_doc = checkpoint(tokens.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))
    ranked = rank_terms(per_doc.groupBy("term").agg(F.sum("tf").alias("cnt")))
    vocab = vocabulary_from_ranked(ranked, drop, end)
    rows = max(ranked.total - drop, 0)
    head = head_that_fits(vocab, rows, max_broadcast_bytes)
    if rows <= head:
        tf = per_doc.join(F.broadcast(vocab.select("term", "term_idx")), "term")
    else:
        tf = head_tail_lookup(per_doc, vocab, head)
    return tf.select(id_col, "term_idx", "tf"), vocab, rows


def doc_term_table(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                   normalize: bool = True, drop: int = TAIL_DROP, end: str = "tail",
                   max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                   ) -> tuple[DataFrame, DataFrame, int]:
    """Documents → ``(tf, vocab, vocab_rows)`` with one pass over the corpus;
    see :func:`term_table`."""
    return term_table(term_tokens(docs, text_col, id_col, normalize), id_col, drop, end,
                      max_broadcast_bytes)


def sparse_vectors(tf: DataFrame, ids: DataFrame, size: int, partitions: int | None = None,
                   id_col: str = "doc_id") -> DataFrame:
    """``id_col, features``: each document's counts as a sparse vector of
    ``size`` places; a document without terms has an empty one and is kept.

    A vector is assembled from its own rows and written in the columns that
    Spark ML stores a vector in, so reading the files back gives vectors. The
    frame has ``partitions`` partitions (None: as many as a shuffle), dealt by id and sorted
    by it: the EM of ``pyspark.ml`` draws its start from partition numbers and row
    order, so with both fixed a seed gives the same start on any machine.
    """
    spark = tf.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (tf.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct(
        F.col("term_idx").cast("int").alias("i"), F.col("tf").cast("double").alias("v")))).alias("e")))
    rows = ids.select(id_col).distinct().join(rows, id_col, "left")
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
                      F.coalesce(F.col("e.i"), F.array().cast("array<int>")).alias("indices"),
                      F.coalesce(F.col("e.v"), F.array().cast("array<double>")).alias("values"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vectors-{uuid.uuid4().hex}"
    rows.select(id_col, vector.alias("features")).write.parquet(path)
    schema = StructType([StructField(id_col, tf.schema[id_col].dataType),
                         StructField("features", VectorUDT())])
    return (spark.read.schema(schema).parquet(path).repartition(partitions, id_col)
            .sortWithinPartitions(id_col))


def head_tail_lookup(keyed: DataFrame, vocab: DataFrame, head_rows: int) -> DataFrame:
    """Join ``keyed`` (with a ``term`` column) to a vocabulary too large to
    broadcast, without a hot join key.

    Vocabulary indices follow frequency, so the hot terms are the head. The
    first ``head_rows`` terms (as many as fit the byte bound) are broadcast; only
    the rows they do not match go through a shuffle join with the tail. The
    k-th most frequent term occurs at most total/k times, so no tail key
    holds more than a 1/``head_rows`` share of the rows; this holds without
    relying on AQE's skew handling.
    """
    head = (vocab.filter(F.col("term_idx") < F.lit(head_rows))
            .select("term", F.col("term_idx").alias("_head_idx")))
    tagged = keyed.join(F.broadcast(head), "term", "left")
    hot = tagged.filter(F.col("_head_idx").isNotNull()).withColumnRenamed("_head_idx", "term_idx")
    tail = vocab.filter(F.col("term_idx") >= F.lit(head_rows)).select("term", "term_idx")
    rest = tagged.filter(F.col("_head_idx").isNull()).drop("_head_idx").join(tail, "term")
    return hot.unionByName(rest)
