"""Topic models (Spark ML LDA) and their description as DataFrames.

The whole text path is

    documents -> terms -> term counts -> vocabulary (drop the 20 rarest)
              -> count vectors -> LDA(k) -> top terms per topic -> term names

The RDD LDA the original jobs used defaults to the EM optimizer while
``pyspark.ml`` LDA defaults to online; ``optimizer`` therefore defaults to
``"em"`` here: EM in blocks (``operators/em.py``). ``"online"`` on texts is variational Bayes in the same
blocks (``operators/online.py``); ``"ml-em"`` and ``"ml-online"`` are those of ``pyspark.ml``. The original set no seed; ours is a parameter so results repeat.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.ml.clustering import LDA, DistributedLDAModel, LocalLDAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from termflow.functions.constants import (NUMERIC_TOPIC_COUNT, TAIL_DROP, TERMS_PER_TOPIC,
                                          TOPIC_COUNT)
from termflow.operators.counted import CountedBlocks, dealt
from termflow.operators.em import TopicTables, fit_blocks, fit_tables, fold_in
from termflow.operators.online import fit_online
from termflow.operators.tokens import doc_terms, explode_items
from termflow.operators.vectors import doc_term_tf, sparse_vectors, term_table
from termflow.operators.vocab import rank_terms, vocabulary_from_ranked
from termflow.session import checkpoint, ensure_checkpoint_dir, hadoop_fs, hadoop_path, path_exists


@dataclass
class TopicFit:
    """A fitted text topic model with the vocabulary it was fitted on."""
    model: object            # TopicTables, or an LDAModel of pyspark.ml
    vocab: DataFrame         # term, cnt, term_idx
    vocab_size: int


def lda(k: int, optimizer: str = "em", max_iter: int = 20, seed: int | None = 42,
        checkpoint_interval: int = 10, **params) -> LDA:
    if optimizer.removeprefix("ml-") == "online":
        params = {"subsamplingRate": 1.0, **params}  # every document in every iteration
    est = LDA(k=k, optimizer=optimizer.removeprefix("ml-"), maxIter=max_iter,
              checkpointInterval=checkpoint_interval, featuresCol="features", **params)
    if seed is not None:
        est = est.setSeed(seed)
    return est


def fit_text_topics(docs: DataFrame, text_col: str = "text", id_col: str | None = "doc_id",
                    k: int = TOPIC_COUNT, optimizer: str = "em", max_iter: int = 20,
                    seed: int | None = 42, drop: int = TAIL_DROP, end: str = "tail",
                    normalize: bool = True, partitions: int | None = None, **lda_params) -> TopicFit:
    """Fit LDA on a corpus of documents, with its whole vocabulary minus the
    dropped terms. Rows of one id are one document."""
    if in_blocks(optimizer, lda_params) and id_col is not None:
        ensure_checkpoint_dir(docs.sparkSession)
        # Texts are dealt, not their terms: they are shorter.
        texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        rows, blocks = dealt(texts, "text", F.octet_length("text"), k)
        return fit_counted(CountedBlocks(doc_terms(rows, "text", "id", normalize, keep=("block",)), blocks), id_col, k,
                           optimizer, max_iter, seed, drop, end, **lda_params)
    terms = doc_terms(docs, text_col, id_col, normalize)
    return fit_term_topics(terms, id_col, k, optimizer, max_iter, seed, drop, end, partitions,
                           **lda_params)


def fit_term_topics(terms: DataFrame, id_col: str | None = "doc_id", k: int = TOPIC_COUNT,
                    optimizer: str = "em", max_iter: int = 20, seed: int | None = 42,
                    drop: int = TAIL_DROP, end: str = "tail", partitions: int | None = None,
                    **lda_params) -> TopicFit:
    """:func:`fit_text_topics` from already tokenised documents
    (``terms ARRAY<STRING>``, e.g. stored with a stream's corpus).

    All comes from the documents' counts of terms; neither those nor the
    vocabulary passes through the driver, nor do the topics' numbers of terms. ``pyspark.ml``
    (``ml-em``, ``ml-online``, or ``online`` with its other settings)
    fits vectors in ``partitions`` partitions (None: as many as a shuffle has), which with
    the seed fix the start of its EM, and its online optimizer keeps k x vocabulary
    numbers on the driver.
    """
    ensure_checkpoint_dir(terms.sparkSession)  # EM / long fits checkpoint their state
    if id_col is None:
        id_col = "_doc"
        terms = checkpoint(terms.withColumn(id_col, F.monotonically_increasing_id()))
    if in_blocks(optimizer, lda_params):
        rows, blocks = dealt(terms.select(F.col(id_col).alias("id"), "terms"), "terms", F.octet_length(F.array_join("terms", " ")), k)
        return fit_counted(CountedBlocks(rows, blocks), id_col, k, optimizer, max_iter, seed, drop, end, **lda_params)
    tf, vocab, size = term_table(explode_items(terms, "terms", "term", keep=(id_col,)), id_col,
                                 drop, end)
    if optimizer == "em":
        return TopicFit(fit_tables(tf, k, size, max_iter, 42 if seed is None else seed, id_col, **lda_params), vocab, size)
    features = sparse_vectors(tf, terms, size, partitions, id_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = lda(k, optimizer, max_iter, seed, **lda_params).fit(features)
    finally:
        features.unpersist()
    return TopicFit(model, vocab, size)


def in_blocks(optimizer: str, params: dict) -> bool:
    """Whether documents are counted in blocks. What watches its rounds reads a table of all rows;
    other settings of the online optimizer than its step's are those of ``pyspark.ml``."""
    if optimizer == "online":
        return params.keys() <= {"learningOffset", "learningDecay"}
    return optimizer == "em" and not params.keys() & {"watch", "max_broadcast_bytes"}


def fit_counted(counted: CountedBlocks, id_col: str, k: int, optimizer: str, max_iter: int, seed: int | None, drop: int,
                end: str, **lda_params) -> TopicFit:
    """Number the vocabulary of counted documents and fit."""
    ranked = rank_terms(counted.term_counts())
    vocab, size = vocabulary_from_ranked(ranked, drop, end), max(ranked.total - drop, 0)
    fit = fit_online if optimizer == "online" else fit_blocks
    model = fit(counted, vocab, size, k, max_iter, 42 if seed is None else seed, id_col, **lda_params)
    return TopicFit(model, vocab, size)


def describe_topics(fit: TopicFit, terms_per_topic: int = TERMS_PER_TOPIC) -> DataFrame:
    """``topic, rank, term_idx, term, weight``: the heaviest terms of each
    topic, heaviest first, with their names.

    The described side (k x terms_per_topic rows) is what is broadcast; the
    vocabulary streams past it, so its size does not matter.
    """
    if isinstance(fit.model, TopicTables):
        rows = fit.model.described(terms_per_topic)
        return (fit.vocab.select("term_idx", "term").join(F.broadcast(rows), "term_idx")
                .select("topic", "rank", "term_idx", "term", "weight"))
    desc = fit.model.describeTopics(terms_per_topic)
    rows = desc.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights"))
                       .alias("rank", "tw")).select(
        "topic", "rank", F.col("tw.termIndices").alias("term_idx"),
        F.col("tw.termWeights").alias("weight"))
    return (fit.vocab.select("term_idx", "term").join(F.broadcast(rows), "term_idx")
            .select("topic", "rank", "term_idx", "term", "weight"))


def topics_matrix(model, spark: SparkSession) -> DataFrame:
    """The vocab x k topic matrix in long form ``topic, term_idx, weight``.

    An EM fit has it as a table. An EM model of ``pyspark.ml`` is saved to the checkpoint folder and its term vertices are
    read back as a table, so the matrix never meets in one place. (A saved
    model keeps a term's vertex under the number ``-term_idx - 1``.) An online
    model has its matrix on the driver, which hands it to Spark.
    """
    if isinstance(model, TopicTables):
        return model.matrix()
    if isinstance(model, DistributedLDAModel):
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lda-{uuid.uuid4().hex}"
        model.write().save(path)
        vertices = spark.read.parquet(f"{path}/oldModel/data/topicCounts").where("id < 0")
        return vertices.select(
            (-F.col("id") - 1).alias("term_idx"),
            F.posexplode(vector_to_array("topicWeights")).alias("topic", "weight")).select(
            "topic", "term_idx", "weight")
    import numpy as np
    import pandas as pd

    m = model.topicsMatrix().toArray()
    v, k = m.shape
    pdf = pd.DataFrame({"topic": np.repeat(np.arange(k, dtype=np.int32), v),
                        "term_idx": np.tile(np.arange(v, dtype=np.int64), k),
                        "weight": m.T.reshape(-1).astype(np.float64)})
    return spark.createDataFrame(pdf, "topic int, term_idx long, weight double")


def fit_numeric_topics(vectors: DataFrame, values_col: str = "values",
                       k: int = NUMERIC_TOPIC_COUNT, optimizer: str = "em",
                       max_iter: int = 20, seed: int | None = 42, id_col: str = "id",
                       partitions: int | None = None, **lda_params):
    """LDA on rows of numeric term counts ``ARRAY<DOUBLE>`` (dense). EM reads them as a
    ``(row, place, count)`` table; a row without an id column gets a number."""
    ensure_checkpoint_dir(vectors.sparkSession)
    if optimizer == "em":
        rows, key = vectors, id_col
        if id_col not in vectors.columns:
            rows, key = checkpoint(vectors.withColumn("_row", F.monotonically_increasing_id())), "_row"
        size = rows.agg(F.max(F.size(values_col))).first()[0] or 0
        tf = rows.select(key, F.posexplode(values_col).alias("term_idx", "tf")).groupBy(key, "term_idx").agg(F.sum("tf").alias("tf"))
        return fit_tables(tf, k, size, max_iter, 42 if seed is None else seed, key, **lda_params)
    key = [id_col] if id_col in vectors.columns else []
    partitions = partitions or int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    feats = (vectors.withColumn("features", array_to_vector(values_col))
             .repartition(partitions, *key or [values_col])
             .sortWithinPartitions(*key, values_col).persist())
    try:
        return lda(k, optimizer, max_iter, seed, **lda_params).fit(feats)
    finally:
        feats.unpersist()


def save_model(model, path: str) -> None:
    """Save a model: EM fits as a bundle without a vocabulary, ``pyspark.ml`` models in
    their own format."""
    if isinstance(model, TopicTables):
        save_fit(TopicFit(model, None, model.vocab_size), path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str):
    """Load a model saved by :func:`save_model`: a bundle, or a ``pyspark.ml`` model (EM →
    distributed, online → local) by the class that its metadata names."""
    from pyspark.ml.util import DefaultParamsReader

    spark = SparkSession.getActiveSession()
    if not path_exists(spark, f"{path.rstrip('/')}/metadata"):
        return load_fit(spark, path).model
    kind = DefaultParamsReader.loadMetadata(path, spark)["class"]
    return (DistributedLDAModel if kind.endswith("DistributedLDAModel") else LocalLDAModel).load(path)


BUNDLE_FORMAT = 1


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The whole versions of a bundle: those whose settings, written last, are there."""
    if not path_exists(spark, path):
        return []
    names = [s.getPath().getName() for s in hadoop_fs(spark, path).listStatus(hadoop_path(spark, path))]
    found = sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))
    return [v for v in found if path_exists(spark, f"{path}/version={v}/settings/_SUCCESS")]


def save_fit(fit: TopicFit, path: str, **settings) -> int:
    """Save a fitted model with its vocabulary as the next version of the bundle
    ``path``: tables ``topics`` (term_idx, n0..), ``vocab`` (term, cnt, term_idx) and one row of
    ``settings``. A version without settings was not finished and is never read. Works
    for EM and for the models of ``pyspark.ml``; returns the version."""
    path = path.rstrip("/")
    spark = SparkSession.getActiveSession() if fit.vocab is None else fit.vocab.sparkSession
    spark = spark or fit.model.terms.sparkSession
    model = fit.model
    if not isinstance(model, TopicTables):
        k = model.getK()
        # A variational prior a smooths like a MAP prior of a + 1.
        alpha = float(model.estimatedDocConcentration()[0]) + (0.0 if isinstance(model, DistributedLDAModel) else 1.0)
        wide = topics_matrix(model, spark).groupBy("term_idx").pivot("topic", list(range(k))).agg(F.first("weight"))
        wide = wide.select("term_idx", *[F.coalesce(F.col(str(t)), F.lit(0.0)).alias(f"n{t}") for t in range(k)])
        model = TopicTables(wide, k, fit.vocab_size, alpha)
    used = _versions(spark, path)
    version = (used[-1] if used else 0) + 1
    here = f"{path}/version={version}"
    model.terms.write.mode("overwrite").parquet(f"{here}/topics")
    if fit.vocab is not None:
        fit.vocab.select("term", "cnt", "term_idx").write.mode("overwrite").parquet(f"{here}/vocab")
    row = {"format": BUNDLE_FORMAT, "k": model.k, "vocab_size": fit.vocab_size, "alpha": model.alpha, "eta": model.eta,
           "has_vocab": fit.vocab is not None, "more": json.dumps(settings, sort_keys=True)}
    spark.createDataFrame([tuple(row.values())], "format int, k int, vocab_size long, alpha double, eta double, has_vocab boolean, "
                          "more string").coalesce(1).write.mode("overwrite").json(f"{here}/settings")
    return version


def load_fit(spark: SparkSession, path: str, version: int | None = None) -> TopicFit:
    """The newest whole version of a bundle, or the named one, as it was saved: it
    describes topics by name and folds in new documents."""
    path = path.rstrip("/")
    versions = _versions(spark, path)
    if not versions or version is not None and version not in versions:
        raise FileNotFoundError(f"{path} has no whole model" + (f" of version {version}" if version else ""))
    here = f"{path}/version={version or versions[-1]}"
    s = spark.read.schema("format int, k int, vocab_size long, alpha double, eta double, has_vocab boolean, more string").json(
        f"{here}/settings").first()
    if s["format"] != BUNDLE_FORMAT:
        raise ValueError(f"{here} has format {s['format']}, this is {BUNDLE_FORMAT}")
    terms = spark.read.schema("term_idx long, " + ", ".join(f"n{t} double" for t in range(s["k"]))).parquet(f"{here}/topics")
    vocab = spark.read.schema("term string, cnt long, term_idx long").parquet(f"{here}/vocab") if s["has_vocab"] else None
    return TopicFit(TopicTables(terms, s["k"], s["vocab_size"], s["alpha"], s["eta"]), vocab, s["vocab_size"])


def fold_in_documents(fit: TopicFit, docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", rounds: int = 10,
                      normalize: bool = True) -> DataFrame:
    """Topic shares of documents that were not fitted: ``id_col, topic, share``. Rows of
    one id are one document; one without a term of the vocabulary has no rows."""
    tokens = explode_items(doc_terms(docs, text_col, id_col, normalize), "terms", "term", keep=(id_col,))
    return fold_in(doc_term_tf(tokens, fit.vocab, id_col, fit.vocab_size), fit.model, rounds, id_col)
