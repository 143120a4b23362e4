"""Topic models fitted by EM over a ``(doc, term, tf)`` table.

The model is the smoothed one of Asuncion et al. (2009), MAP estimation of LDA with
priors ``alpha`` and ``eta`` over 1, as ``pyspark.ml``'s EM has it. Its state is two
tables, a row of ``k`` numbers for each document and for each term:

    share of topic t in one occurrence of term w in document d
        ~ (N_wt + eta - 1) / (N_t + V (eta - 1)) * (N_dt + alpha - 1)

A round looks up both rows for each row of the term table, divides ``tf`` by
the shares, and sums by document and by term. :func:`fit_tables` does so block by
block of documents (``operators/blocks.py``): a block gets each of its terms once and sends
its sum once. The same as joins (:func:`next_tables`, :func:`log_likelihood`) goes on
from any two tables: the term table is broadcast only up to a byte bound; beyond it
the most frequent terms are (numbers follow frequency), and the rest, none of which
is hot, meets in a shuffle join. Nothing of either lies on the driver or in one task.

The start comes from a hash of (document, term, topic, seed), not from partition
numbers, so a seed gives one result on any number of partitions (but for the
order of floating-point sums).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from termflow.operators.blocks import Block, Rounds
from termflow.operators.counted import CountedBlocks
from termflow.operators.joins import MAX_BROADCAST_BYTES
from termflow.session import delete_path, let_workers_import, stored

#: Fixed values of the start: a prime modulus and factors.
PRIME = 2147483647
DOC_FACTOR, TERM_FACTOR, ROW_FACTOR, TOPIC_FACTOR, SHIFT = 48271, 16807, 69621, 40692, 12345
ETA = 1.1
#: Counts that a step divides at once: their numbers stay in a core's cache.
STEP_ROWS = 1 << 14


def default_alpha(k: int) -> float:
    return 50.0 / k + 1


def names(stem: str, k: int) -> list[str]:
    return [f"{stem}{t}" for t in range(k)]


def summed(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return rows.groupBy(key).agg(*[F.sum(c).alias(c) for c in columns])


def start_shares(at: np.ndarray, topic: int) -> np.ndarray:
    """The first share of a topic, not yet scaled: 1 to 1000."""
    m = np.fmod(at * ROW_FACTOR + (TOPIC_FACTOR * topic + SHIFT), PRIME)
    return (np.fmod(m * m, PRIME) % 1000 + 1).astype(float)


def first_sums(k: int, seed: int):
    """The sums of a block's terms and documents before the first round."""

    def first(block: Block) -> tuple[np.ndarray, np.ndarray]:
        at = np.fmod(block.to_rows(block.docs % PRIME) * DOC_FACTOR + block.terms[block.local] * TERM_FACTOR + seed, PRIME)
        shares = np.empty((k, len(at)), np.int16)
        for t in range(k):
            shares[t] = start_shares(at, t)
        scale = block.tf / shares.sum(axis=0)
        parts = (scale * s for s in shares)
        of_terms, of_docs = zip(*((block.by_term(g), block.by_doc(g)) for g in parts))
        return np.array(of_terms), np.array(of_docs)

    return first


def em_step(k: int, vocab_size: int, alpha: float, eta: float):
    """The sums of a block's terms and documents after one more round."""

    def step(block: Block, of_terms: np.ndarray, totals: np.ndarray, of_docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # A line for each term and document, which a count reads at once.
        p = np.ascontiguousarray(((of_terms + (eta - 1)) / (totals + vocab_size * (eta - 1))[:, None]).T)
        d = np.ascontiguousarray((of_docs + (alpha - 1)).T)
        doc, ones = block.to_rows(np.arange(len(d))), np.ones(k)
        scale, new_docs = np.empty(len(doc)), np.zeros_like(d)
        for i in range(0, len(doc), STEP_ROWS):
            part = slice(i, i + STEP_ROWS)
            of = doc[part]
            w = p.take(block.local[part], axis=0)
            w *= d.take(of, axis=0)
            scale[part] = block.tf[part] / (w @ ones)
            w *= scale[part, None]
            first = np.flatnonzero(np.diff(of, prepend=-1))
            new_docs[of[first]] += np.add.reduceat(w, first, axis=0)
        # A term's probabilities are the same in all its rows.
        new_terms = np.array([p[:, t] * block.by_term(scale * block.to_rows(d[:, t])) for t in range(k)])
        return new_terms, new_docs.T

    return step


@dataclass
class TopicTables:
    """A fitted model: ``terms`` (term_idx, n0..), and ``docs`` (the id, n0..) of the
    fitted documents, if kept."""

    terms: DataFrame
    k: int
    vocab_size: int
    alpha: float
    eta: float = ETA
    docs: DataFrame | None = None
    id_col: str = "doc_id"
    log_posteriors: list[float] = field(default_factory=list)
    paths: list[str] = field(default_factory=list)

    def totals(self) -> DataFrame:
        """One row: ``k`` sums of the term table."""
        return self.terms.agg(*[F.sum(c).alias(f"sum_{c}") for c in names("n", self.k)])

    def term_probabilities(self) -> DataFrame:
        """``term_idx, p0..``: the smoothed probability of each term in each topic."""
        n = names("n", self.k)
        # One row meets all terms, as an equality join on a constant.
        rows = self.terms.withColumn("_one", F.lit(0)).join(F.broadcast(self.totals().withColumn("_one", F.lit(0))), "_one")
        return rows.select("term_idx", *[
            ((F.col(c) + (self.eta - 1)) / (F.col(f"sum_{c}") + self.vocab_size * (self.eta - 1))).alias(f"p{t}")
            for t, c in enumerate(n)])

    def all_terms(self) -> DataFrame:
        """``term_idx, n0..`` of each number of the vocabulary, 0 for those that occur
        nowhere. Where none is missing, as in any text fit, that is the table."""
        weights = F.array(*names("n", self.k))
        odd = F.exists(weights, lambda x: x.isNull() | F.isnan(x))
        known = self.terms.agg(F.count("*"), F.count_distinct("term_idx"), F.min("term_idx"), F.max("term_idx"), F.count_if(odd)).first()
        if tuple(known) == (self.vocab_size, self.vocab_size, 0, self.vocab_size - 1, 0):
            return self.terms
        numbers = self.terms.sparkSession.range(self.vocab_size).select(F.col("id").alias("term_idx"))
        return numbers.join(self.terms, "term_idx", "left").fillna(0.0)

    def matrix(self) -> DataFrame:
        """``topic, term_idx, weight``: the tokens of each term in each topic, 0 for
        numbers that occur nowhere."""
        terms = self.all_terms()
        pairs = F.array(*[F.struct(F.lit(t).alias("topic"), F.col(c).alias("weight")) for t, c in enumerate(names("n", self.k))])
        return terms.select("term_idx", F.explode(pairs).alias("x")).select("x.topic", "term_idx", "x.weight")

    def described(self, n: int) -> DataFrame:
        """``topic, rank, term_idx, weight``: the ``n`` heaviest terms of each topic
        with their share of the topic's tokens; ties to the smaller number."""
        from pyspark.sql import Window

        k = self.k
        let_workers_import(self.terms.sparkSession)

        def heaviest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Of each topic the candidates of one task: ``n`` terms are kept at a time."""
            terms, weights = np.empty((k, 0), np.int64), np.empty((k, 0))
            for b in batches:
                idx = b.column("term_idx").to_numpy()
                of = [(np.append(terms[t], idx), np.append(weights[t], b.column(f"n{t}").to_numpy())) for t in range(k)]
                best = [np.lexsort((i, -w))[:n] for i, w in of]
                terms = np.array([i[o] for (i, _), o in zip(of, best)])
                weights = np.array([w[o] for (_, w), o in zip(of, best)])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k, dtype=np.int32), terms.shape[1])), pa.array(terms.ravel()),
                                              pa.array(weights.ravel())], ["topic", "term_idx", "weight"])

        whole = self.all_terms()
        totals = whole.agg(*[F.sum(c).alias(c) for c in names("n", k)]).select(F.explode(F.array(*[
            F.struct(F.lit(t).alias("topic"), F.col(c).alias("total")) for t, c in enumerate(names("n", k))])).alias("x")).select("x.*")
        best = Window.partitionBy("topic").orderBy(F.desc("weight"), "term_idx")
        top = whole.mapInArrow(heaviest, "topic int, term_idx long, weight double")
        top = top.withColumn("rank", F.row_number().over(best) - 1).where(F.col("rank") < n)
        return top.join(F.broadcast(totals), "topic").select(
            "topic", "rank", "term_idx", F.when(F.col("total") > 0, F.col("weight") / F.col("total")).otherwise(0.0).alias("weight"))

    def delete(self) -> None:
        """Delete the tables' folders under the checkpoint folder."""
        for p in self.paths:
            delete_path(self.terms.sparkSession, p)


def with_terms(rows: DataFrame, terms: DataFrame, k: int, vocab_size: int, max_broadcast_bytes: int) -> DataFrame:
    """``rows`` with the ``k`` numbers of their term. Terms are numbered by falling
    frequency: the head of them is broadcast, as far as it fits."""
    head = max_broadcast_bytes // (8 * k + 16)
    if vocab_size <= head:
        return rows.join(F.broadcast(terms), "term_idx")
    near, far = F.col("term_idx") < head, F.col("term_idx") >= head
    return (rows.where(near).join(F.broadcast(terms.where(near)), "term_idx")
            .unionByName(rows.where(far).join(terms.where(far), "term_idx")))


def shares(rows: DataFrame, model: TopicTables, max_broadcast_bytes: int) -> DataFrame:
    """``rows`` (id, term_idx, tf) with ``s0..``: ``tf`` divided over the topics, and
    ``likelihood``: the probability of the term in the document."""
    k = model.k
    both = with_terms(rows, model.term_probabilities(), k, model.vocab_size, max_broadcast_bytes).join(model.docs, model.id_col)
    weight = [F.col(f"p{t}") * (F.col(f"n{t}") + (model.alpha - 1)) for t in range(k)]
    size = sum((F.col(f"n{t}") + (model.alpha - 1) for t in range(1, k)), F.col("n0") + (model.alpha - 1))
    both = both.select(model.id_col, "term_idx", "tf", size.alias("_size"), *[w.alias(f"w{t}") for t, w in enumerate(weight)])
    total = sum((F.col(f"w{t}") for t in range(1, k)), F.col("w0"))
    return both.select(model.id_col, "term_idx", "tf", (total / F.col("_size")).alias("likelihood"),
                       *[(F.col("tf") * F.col(f"w{t}") / total).alias(f"s{t}") for t in range(k)])


def kept_tables(s: DataFrame, k: int, vocab_size: int, alpha: float, eta: float, id_col: str) -> TopicTables:
    n = names("n", k)
    terms, a = stored(summed(s, "term_idx", n), "em-terms")
    docs, b = stored(summed(s, id_col, n), "em-docs")
    return TopicTables(terms, k, vocab_size, alpha, eta, docs, id_col, paths=[a, b])


def next_tables(rows: DataFrame, model: TopicTables, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> TopicTables:
    """The state after one more round."""
    s = shares(rows, model, max_broadcast_bytes).withColumnsRenamed({f"s{t}": f"n{t}" for t in range(model.k)})
    return kept_tables(s, model.k, model.vocab_size, model.alpha, model.eta, model.id_col)


def log_likelihood(rows: DataFrame, model: TopicTables, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> float:
    """Of all tokens, given the topics and the documents' shares of them."""
    return shares(rows, model, max_broadcast_bytes).agg(F.sum(F.col("tf") * F.log("likelihood"))).first()[0] or 0.0


def log_prior(model: TopicTables) -> float:
    """Of the topics and the documents' shares, up to a constant."""
    k, a, e = model.k, model.alpha - 1, model.eta - 1
    of_terms = model.term_probabilities().agg(F.sum(sum((F.log(f"p{t}") for t in range(1, k)), F.log("p0")))).first()[0]
    size = sum((F.col(f"n{t}") + a for t in range(1, k)), F.col("n0") + a)
    of_docs = model.docs.agg(F.sum(sum((F.log((F.col(f"n{t}") + a) / size) for t in range(1, k)), F.log((F.col("n0") + a) / size)))).first()[0]
    return e * (of_terms or 0.0) + a * (of_docs or 0.0)


def fit_tables(rows: DataFrame, k: int, vocab_size: int, rounds: int = 20, seed: int = 42, id_col: str = "doc_id",
               alpha: float | None = None, eta: float = ETA, watch: bool = False,
               max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> TopicTables:
    """Fit ``rounds`` rounds on ``rows`` (id, term_idx, tf; each pair once). ``watch``
    keeps the log posterior before every round and after the last (two more
    passes each). Defined results: rows without a positive ``tf`` or with a null id or
    term take no part; no rows give empty tables."""
    rows, path = stored(rows.where((F.col("tf") > 0) & F.col("term_idx").isNotNull() & F.col(id_col).isNotNull())
                        .select(id_col, F.col("term_idx").cast("long").alias("term_idx"), F.col("tf").cast("double").alias("tf")), "em-rows")
    alpha = alpha or default_alpha(k)
    integral = dict(rows.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint")
    doc = F.col(id_col).cast("long") if integral else F.xxhash64(id_col)
    run = Rounds(rows.withColumn("doc", doc), id_col, k, rows.count(), first_sums(k, seed), em_step(k, vocab_size, alpha, eta))

    def model() -> TopicTables:
        terms, docs = run.tables()
        return TopicTables(terms, k, vocab_size, alpha, eta, docs, id_col)

    def seen() -> float:
        return log_likelihood(rows, model(), max_broadcast_bytes) + log_prior(model())

    posteriors = []
    for _ in range(rounds):
        if watch:
            posteriors.append(seen())
        run.more(1)
    if watch:
        posteriors.append(seen())
    made = finished(run, vocab_size, alpha, eta)
    made.log_posteriors = posteriors
    delete_path(rows.sparkSession, path)
    return made


def finished(run: Rounds, vocab_size: int, alpha: float, eta: float) -> TopicTables:
    """The state after the last round, written; the rounds' own data is deleted."""
    (terms, a), (docs, b) = (stored(t, name) for t, name in zip(run.tables(), ("em-terms", "em-docs")))
    run.close()
    return TopicTables(terms, run.k, vocab_size, alpha, eta, docs, run.id_col, paths=[a, b])


def fit_blocks(counted: CountedBlocks, vocab: DataFrame, vocab_size: int, k: int, rounds: int = 20, seed: int = 42,
               id_col: str = "doc_id", alpha: float | None = None, eta: float = ETA) -> TopicTables:
    """:func:`fit_tables` on documents that are counted in blocks; the counts are deleted."""
    alpha = alpha or default_alpha(k)
    run = counted.rounds(vocab, id_col, k, first_sums(k, seed), em_step(k, vocab_size, alpha, eta))
    run.more(rounds)
    return finished(run, vocab_size, alpha, eta)


def fold_in(rows: DataFrame, model: TopicTables, rounds: int = 10, id_col: str = "doc_id",
            max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Topic shares of documents that the model has not seen: ``id_col, topic, share``.
    Topics stay as they are; a document starts with equal shares and takes ``rounds``
    EM steps. Terms outside the model take no part; a document of ``rows`` without
    other terms has none (equal shares say nothing)."""
    k = model.k
    rows = rows.where((F.col("tf") > 0) & F.col(id_col).isNotNull()).select(
        id_col, F.col("term_idx").cast("long").alias("term_idx"), F.col("tf").cast("double").alias("tf"))
    probabilities = model.term_probabilities()
    rows, path = stored(with_terms(rows, probabilities, k, model.vocab_size, max_broadcast_bytes), "fold-rows")
    docs = rows.groupBy(id_col).agg(*[(F.sum("tf") / k).alias(f"n{t}") for t in range(k)])
    for _ in range(rounds):
        both = rows.join(docs, id_col)
        weight = [F.col(f"p{t}") * (F.col(f"n{t}") + (model.alpha - 1)) for t in range(k)]
        both = both.select(id_col, "tf", *[w.alias(f"w{t}") for t, w in enumerate(weight)])
        total = sum((F.col(f"w{t}") for t in range(1, k)), F.col("w0"))
        docs = both.select(id_col, *[(F.col("tf") * F.col(f"w{t}") / total).alias(f"n{t}") for t in range(k)])
        docs = summed(docs, id_col, names("n", k))
    size = sum((F.col(f"n{t}") + (model.alpha - 1) for t in range(1, k)), F.col("n0") + (model.alpha - 1))
    out, _ = stored(docs.select(id_col, F.explode(F.array(*[
        F.struct(F.lit(t).alias("topic"), ((F.col(f"n{t}") + (model.alpha - 1)) / size).alias("share")) for t in range(k)])).alias("x"))
        .select(id_col, "x.topic", "x.share"), "fold-shares")
    delete_path(rows.sparkSession, path)
    return out
