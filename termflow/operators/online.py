"""Topic models fitted by online variational Bayes (Hoffman et al. 2010) over blocks of documents.

A round infers the topic shares of every document under the topics so far and moves the
topics towards what the documents gave, by the step ``(offset + round) ** -decay``; the documents' prior
``alpha`` takes a Newton step of that size. That is the online optimizer of ``pyspark.ml`` with all
documents in a batch, its priors, steps, starts' distribution and end of a document's inference. It differs in
two points: each document is in a round once, where that draws them with replacement, and the random
starts follow from the numbers of documents, terms and rounds and the seed instead of one
sequence, so that no task needs the others' and partitions do not matter.

The matrix of topics and terms is nowhere whole: a block keeps the lines of its own terms, which travel
with its messages, and a shard adds up what the blocks gave for its terms (``operators/blocks.py``).
What is one value for each topic goes as two more terms: the sum of the documents' expected logarithms of shares,
and the number of documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from termflow.operators.blocks import Block
from termflow.operators.counted import CountedBlocks
from termflow.operators.em import TopicTables, names
from termflow.session import let_workers_import, stored

#: Shape of the starts' Gamma distribution (mean 1).
START_SHAPE = 100.0
#: A document's inference ends when its numbers move less than this, on average.
STILL = 1e-3
#: Counts of the documents inferred at once: their numbers stay in a core's cache.
BATCH_ROWS = 1 << 14


def digamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers: six steps up, then the asymptotic series."""
    y = x + 6
    r = 1 / (y * y)
    out = np.log(y) - 0.5 / y - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r / 132))))
    for i in range(6):
        out -= 1 / (x + i)
    return out


def trigamma(x: np.ndarray) -> np.ndarray:
    y = x + 6
    r = 1 / (y * y)
    out = 1 / y + r / 2 + r / y * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r * (1 / 30 - r * 5 / 66))))
    return out + sum(1 / (x + i) ** 2 for i in range(6))


def expected_logs(x: np.ndarray) -> np.ndarray:
    """Of the shares in each line's Dirichlet distribution."""
    return digamma(x) - digamma(x.sum(axis=-1, keepdims=True))


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits, well spread (the last steps of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def starts(numbers: np.ndarray, k: int, seed: int, turn: int) -> np.ndarray:
    """A line of ``k`` Gamma numbers for each of ``numbers`` (by Wilson and Hilferty's cube of
    a normal number, good to a thousandth at this shape)."""
    with np.errstate(over="ignore"):
        key = mixed(numbers.astype(np.int64).view(np.uint64) + mixed(np.array([seed, turn], np.int64).view(np.uint64)).sum())
        at = mixed(key[:, None] + np.arange(1, 2 * k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    u = ((at >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
    normal = np.sqrt(-2 * np.log(u[:, :k])) * np.cos(2 * np.pi * u[:, k:])
    return (1 - 1 / (9 * START_SHAPE) + normal / (3 * np.sqrt(START_SHAPE))) ** 3


def by_size(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents of like size together: their places, the places of their rows in a
    rectangle, and which of these there are."""
    order = np.argsort(sizes, kind="stable")
    begin = np.cumsum(sizes, dtype=np.int64) - sizes
    sorted_sizes, i = sizes[order].astype(np.int64), 0
    while i < len(order):
        area = sorted_sizes[i:i + BATCH_ROWS]
        area = area * np.arange(1, len(area) + 1)
        j = i + max(1, int(np.searchsorted(area, BATCH_ROWS, side="right")))
        docs, width = order[i:j], np.arange(sorted_sizes[j - 1])
        there = width < sorted_sizes[i:j, None]
        yield docs, np.where(there, begin[docs][:, None] + width, 0), there
        i = j


def infer(block: Block, beta: np.ndarray, alpha: np.ndarray, seed: int, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row its count by its probability, of each document the topics' weights, and the sum
    over documents of the expected logarithms; ``beta``: a line for each term."""
    k = beta.shape[1]
    ratio, theta, logs = np.zeros(len(block.tf)), np.empty((len(block.sizes), k)), np.zeros(k)
    for docs, at, there in by_size(block.sizes):
        p, tf = beta.take(block.local.take(at), axis=0), np.where(there, block.tf.take(at), 0.0)
        gamma = starts(block.docs[docs], k, seed, turn)
        weights = np.exp(expected_logs(gamma))
        norm = np.matmul(p, weights[:, :, None])[:, :, 0] + 1e-100
        moving = np.ones(len(docs), bool)
        while moving.any():
            last = gamma
            gamma = weights * np.matmul((tf / norm)[:, None, :], p)[:, 0, :] + alpha
            e = expected_logs(gamma)
            weights = np.exp(e)
            norm = np.matmul(p, weights[:, :, None])[:, :, 0] + 1e-100
            still = np.abs(gamma - last).mean(axis=1) <= STILL
            done = moving & still
            if done.any():
                ratio[at[done][there[done]]] = (tf[done] / norm[done])[there[done]]
                theta[docs[done]] = weights[done]
                logs += e[done].sum(axis=0)
                moving &= ~still
                # Documents that stand still are left out once they are many.
                if 4 * moving.sum() <= 3 * len(moving):
                    docs, at, there, p, tf, gamma, weights, norm = (x[moving] for x in (docs, at, there, p, tf, gamma, weights, norm))
                    moving = moving[moving]
    return ratio, theta, logs


def newton_step(alpha: np.ndarray, logs: np.ndarray, rate: float) -> np.ndarray:
    """The documents' prior after a step; ``logs``: the mean expected logarithms."""
    gradient = logs - expected_logs(alpha)
    c, q = trigamma(alpha.sum()), -trigamma(alpha)
    b = (gradient / q).sum() / (1 / c + (1 / q).sum())
    moved = alpha - rate * (gradient - b) / q
    return moved if (moved > 0).all() else alpha


class OnlineSteps:
    """The steps of a fit. A block's own state is, of each topic, the lines of its terms, the sum
    over all terms, and alpha."""

    def __init__(self, k: int, vocab_size: int, totals: np.ndarray, seed: int, offset: float, decay: float):
        self.k, self.vocab_size, self.totals, self.seed, self.offset, self.decay = k, vocab_size, totals, seed, offset, decay
        self.prior = 1.0 / k

    def more(self) -> tuple[int, int]:
        """Numbers of the two terms besides."""
        return self.vocab_size, self.vocab_size + 1

    def gives(self, block: Block, lines: np.ndarray, totals: np.ndarray, alpha: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
        beta = np.ascontiguousarray(np.exp(digamma(lines) - digamma(totals)[:, None]).T)
        ratio, theta, logs = infer(block, beta, alpha, self.seed, turn)
        sums = np.array([beta[:, t] * block.by_term(ratio * block.to_rows(theta[:, t])) for t in range(self.k)])
        for number, value in zip(self.more(), (logs, len(block.sizes))):
            sums[:, block.terms == number] = np.reshape(value, (-1, 1))
        return sums, np.column_stack([lines, totals, alpha])

    def first(self) -> Callable:
        def first(block: Block) -> tuple[np.ndarray, np.ndarray]:
            return self.gives(block, starts(block.terms, self.k, self.seed, 0).T, self.totals, np.full(self.k, self.prior), 1)

        return first

    def moved(self, block: Block, sums: np.ndarray, totals: np.ndarray, own: np.ndarray, turn: int):
        """A block's state after the round ``turn``, whose sums these are."""
        lines, before, alpha = own[:, :-2], own[:, -2], own[:, -1]
        logs, count = (sums[:, block.terms == number][:, 0] for number in self.more())
        rate = (self.offset + turn) ** -self.decay
        if count[0] > 0:
            totals = (1 - rate) * before + rate * (totals - logs - count + self.vocab_size * self.prior)
            lines = (1 - rate) * lines + rate * (sums + self.prior)
            alpha = newton_step(alpha, logs / count[0], rate)
        else:
            totals = before
        # The terms besides have no line.
        return np.where(block.terms < self.vocab_size, lines, 1.0), totals, alpha

    def step(self, turn: int) -> Callable:
        """After the round ``turn``: the next."""
        def step(block: Block, sums: np.ndarray, totals: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return self.gives(block, *self.moved(block, sums, totals, own, turn), turn + 1)

        return step

    def last(self, turn: int) -> Callable:
        """After the last round: the lines themselves, and alpha as that of a term besides."""
        def last(block: Block, sums: np.ndarray, totals: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            lines, _, alpha = self.moved(block, sums, totals, own, turn) if turn else (own[:, :-2], None, own[:, -1])
            return np.where(block.terms == self.vocab_size, alpha[:, None], lines), own

        return last


def start_totals(spark: SparkSession, vocab_size: int, k: int, seed: int) -> np.ndarray:
    """The sums of the terms' starts: one number for each topic."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of = starts(b.column("id").to_numpy(), k, seed, 0).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in of], names("n", k))

    let_workers_import(spark)
    rows = spark.range(vocab_size).mapInArrow(sums, ", ".join(f"n{t} double" for t in range(k)))
    return np.array([x or 0.0 for x in rows.agg(*[F.sum(c) for c in names("n", k)]).first()])


def fit_online(counted: CountedBlocks, vocab: DataFrame, vocab_size: int, k: int, rounds: int = 20, seed: int = 42,
               id_col: str = "doc_id", learningOffset: float = 1024.0, learningDecay: float = 0.51) -> TopicTables:
    """Fit ``rounds`` rounds on documents that are counted in blocks; the counts are deleted. The table of
    terms has each topic's expected counts."""
    spark = vocab.sparkSession
    steps = OnlineSteps(k, vocab_size, start_totals(spark, vocab_size, k, seed), seed, learningOffset, learningDecay)
    run = counted.rounds(vocab, id_col, k, steps.first(), None, steps.more())
    for turn in range(1, rounds):
        run.step = steps.step(turn)
        run.more(1)
    run.step = steps.last(rounds)
    run.more(1)
    terms, path = stored(run.tables(means=True)[0], "online-terms")
    run.close()
    alpha = terms.where(F.col("term_idx") == vocab_size).first()["n0"]
    # A variational prior a smooths like a MAP prior of a + 1.
    return TopicTables(terms.where(F.col("term_idx") < vocab_size), k, vocab_size, alpha + 1.0, id_col=id_col, paths=[path])
