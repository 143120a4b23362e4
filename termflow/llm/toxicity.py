"""FTRL-proximal logistic regression over hashed words, word pairs and skip-grams.

A text's features are its distinct lower-case words, neighbouring word pairs and
pairs with one word between, hashed to ``2 ** bits`` coordinates. Each coordinate
has its own learning rate and L1 keeps all but the telling ones at zero, so the
fitted weights are a short list that every task gets.

Fitting reads a bounded sample: the ``max_rows`` labelled texts that come first
by a hash of their id. Scoring reads every text whole.

Defined results: a null or empty text has the score of the intercept; rows
without a label or with a null one are not learned from; without any labelled
text every score is 0; repeated rows are scored alike; ids are compared as
given, and several labels of one id all count. Other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termflow.llm.common import free_name, source, whole_text
from termflow.llm.words import Words, cut, mix

#: Letters, digits, apostrophes and all bytes of other scripts make words.
BREAKS = np.array([not (b >= 0x80 or chr(b).isalnum() or b == 0x27) for b in range(256)])
_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Ftrl:
    """The settings of a fit."""

    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 1.0
    epochs: int = 4
    max_rows: int = 16_384
    #: Coordinates of all rows together that one task holds, 4 bytes each; rows that
    #: follow in the order of their hash are not learned from.
    max_coordinates: int = 1 << 26


@dataclass
class Weights:
    """The coordinates whose weight is not zero; at most ``2 ** bits``."""

    bits: int
    intercept: float
    index: np.ndarray
    weight: np.ndarray


def features(words: Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The text number and coordinate of every feature occurrence of a batch."""
    h = words.hashes()
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    pair = mix(h[:-1] * _PAIR + h[1:])
    skip = mix(h[:-2] * _SKIP + h[2:])
    in_pair, in_skip = text[:-1] == text[1:], text[:-2] == text[2:]
    return (np.concatenate([text, text[:-1][in_pair], text[:-2][in_skip]]),
            (np.concatenate([h, pair[in_pair], skip[in_skip]]) >> np.uint64(64 - bits)).astype(np.int64))


def distinct(text: np.ndarray, index: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    key = np.sort(text << bits | index)
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    return key >> bits, key & ((1 << bits) - 1)


def train(rows: list[tuple[bytes, int]], s: Ftrl) -> Weights:
    """Rows of (coordinates as 4-byte numbers, label 0 or 1), in the order given,
    ``s.epochs`` times; one row's numbers are widened at a time."""
    z, n = np.zeros(1 << s.bits), np.zeros(1 << s.bits)
    zb = nb = 0.0
    for _ in range(s.epochs):
        for packed, label in rows:
            index = np.frombuffer(packed, "<u4").astype(np.int64)
            zi, ni = z[index], n[index]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) > s.l1, -(zi - np.sign(zi) * s.l1) / ((s.beta + root) / s.alpha + s.l2), 0.0)
            wb = -zb / ((s.beta + nb**0.5) / s.alpha)
            g = 1 / (1 + np.exp(-np.clip(wb + w.sum(), -35, 35))) - label
            z[index] = zi + g - (np.sqrt(ni + g * g) - root) / s.alpha * w
            n[index] = ni + g * g
            zb += g - ((nb + g * g)**0.5 - nb**0.5) / s.alpha * wb
            nb += g * g
    index = np.flatnonzero(np.abs(z) > s.l1)
    w = -(z[index] - np.sign(z[index]) * s.l1) / ((s.beta + np.sqrt(n[index])) / s.alpha + s.l2)
    return Weights(s.bits, float(-zb / ((s.beta + nb**0.5) / s.alpha)), index, w)


def fit(docs: DataFrame, labels: DataFrame, settings: Ftrl = Ftrl(), doc_id: str = "doc_id",
        text: str = "text", label: str = "toxic") -> Weights:
    """Weights learned from the labelled texts. ``labels`` has the id and the
    label, 0 or 1, of some of ``docs``; both sides of the join are cut to the
    sample of ``max_rows`` rows, which is its size bound for the broadcast."""
    s = settings
    order = F.xxhash64(F.col("id"))
    known = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
             .where("id IS NOT NULL AND label IS NOT NULL"))
    known = known.orderBy(order, "id", "label").limit(s.max_rows)

    @F.arrow_udf("binary")
    def coordinates(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            row, index = distinct(*features(cut(texts, True, BREAKS), s.bits), s.bits)
            ends = np.searchsorted(row, np.arange(len(texts) + 1))
            index = index.astype("<u4")
            yield pa.array([index[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())

    rows = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
            .join(F.broadcast(known), "id")
            .select("id", "label", coordinates(whole_text("text")).alias("index"))
            .orderBy(order, "id", "label", F.length("index")).limit(s.max_rows))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, room = [], 4 * s.max_coordinates
        for b in batches:
            for i, y in zip(b["index"], b["label"].to_pylist()):
                room -= len(i.as_buffer())
                if room >= 0:
                    got.append((i.as_py(), int(y > 0)))
        if got:
            w = train(got, s)
            yield pa.RecordBatch.from_pydict({"intercept": [w.intercept], "index": [w.index.astype("<i8").tobytes()],
                                              "weight": [w.weight.astype("<f8").tobytes()]})

    made = rows.select("label", "index").mapInArrow(learn, "intercept double, index binary, weight binary").collect()
    if not made:
        return Weights(s.bits, -np.inf, np.empty(0, np.int64), np.empty(0))
    intercept, index, weight = made[0]
    return Weights(s.bits, intercept, np.frombuffer(index, "<i8"), np.frombuffer(weight, "<f8"))


def score(spark: SparkSession, text: Column, weights: Weights) -> Column:
    """The probability of label 1 of each text, from 0 to 1."""
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def ftrl_score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w = shared.value
        table = np.zeros(1 << w.bits, np.float32)
        table[w.index] = w.weight
        for texts in batches:
            row, index = features(cut(texts, True, BREAKS), w.bits)
            telling = table[index] != 0
            row, index = distinct(row[telling], index[telling], w.bits)
            total = w.intercept + np.bincount(row, table[index], len(texts))
            yield pa.array(1 / (1 + np.exp(-np.clip(total, -700, 700))) if np.isfinite(w.intercept)
                           else np.zeros(len(texts)))

    return ftrl_score(whole_text(text))


def toxic_scores(docs: DataFrame, labels: DataFrame, settings: Ftrl = Ftrl(), column: str = "score") -> DataFrame:
    """``docs`` with the toxicity score of each text, learned from ``labels``."""
    weights = fit(docs, labels, settings)
    return docs.withColumn(column, score(docs.sparkSession, F.col("text"), weights))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: the CRC-32 of its id's digits mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


#: Scores from here on count as toxic.
THRESHOLD = 0.3


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document, learned from the rows that are not held out."""
    labels = source(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out(F.col("doc_id")))
    docs = source(spark, sf_dir, "documents", "doc_id", "text")
    return toxic_scores(docs, labels).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those whose score reaches the threshold; same columns."""
    name = free_name(docs, "score")
    return toxic_scores(docs, labels, column=name).where(F.col(name) < threshold).drop(name)
