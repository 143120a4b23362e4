"""The document stream job.

    documents stream --foreachBatch--> per batch:
        nothing arrived           -> no run
        named documents           -> arrival notices           (notice sink)
        non-blank documents       -> corpus table, batch_id=N  (name, contents, terms;
                                                                overwrite: replay-safe)
        whole corpus (all batches)-> vocabulary, LDA, top terms, merged top scores
                                  -> one {term: score} message (score sink)

Every step inside a batch is a DataFrame job; nothing per row runs in
Python and no Spark call is made from inside a task. A replayed batch id
rewrites the same corpus partition (or finds it in the table), and messages go
through an outbox: what was sent is not sent or computed again.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from termflow.functions.constants import TOP_SCORES, TOPIC_COUNT
from termflow.functions.text import is_not_blank, notice
from termflow.operators.scores import score_message
from termflow.operators.tokens import doc_terms
from termflow.operators.topics import describe_topics, fit_term_topics
from termflow.operators.vocab import CorpusTooSmall
from termflow.plans.topics import topic_scores
from termflow.session import path_exists, stream_checkpoint
from termflow.sinks.messages import NOTICE_TOPIC, SCORE_TOPIC, write_messages
from termflow.sinks.outbox import Outbox, with_headers
from termflow.streaming.snapshots import SnapshotTable

log = logging.getLogger(__name__)


@dataclass
class CorpusJob:
    corpus_path: str                      # corpus table, partitioned by batch_id
    sink_path: str | None = None          # file sinks (when sink_format is not kafka)
    sink_format: str = "json"
    sink_options: dict = field(default_factory=dict)
    notice_topic: str = NOTICE_TOPIC
    score_topic: str = SCORE_TOPIC
    scope: str = "all"                    # 'all' batches, or this 'batch' only
    on_small: str = "skip"                # too few terms: 'skip' the run or 'raise'
    normalize: bool = False               # contents already arrive as sent
    k: int = TOPIC_COUNT
    optimizer: str = "em"
    max_iter: int = 20
    seed: int | None = 42
    top: int = TOP_SCORES
    # Refit only once this many documents arrived since the last published
    # fit (1: every batch with documents, as the original did). A refit reads
    # the whole corpus, so a larger value bounds the cost of a fast stream;
    # documents after the last refit then stay unpublished until the next one.
    min_new_docs: int = 1
    # Small batches from which the corpus is compacted: it is then a table with versions
    # (streaming/snapshots.py) instead of a folder for each batch. 0: never.
    compact_after: int = 0

    @property
    def _marker(self) -> str:
        return f"{self.corpus_path.rstrip('/')}_last_fit"

    def _last_fit(self, spark) -> int:
        if not path_exists(spark, self._marker):
            return -1
        return int(spark.read.json(self._marker).first()["batch_id"])

    def _outbox(self, spark) -> Outbox:
        return Outbox(spark, f"{self.corpus_path.rstrip('/')}_outbox")

    def _write(self, df: DataFrame | None, topic: str, batch_id: int, spark) -> None:
        """Send a batch's messages, once: a replay sends what the outbox has, or nothing."""
        def deliver(messages: DataFrame) -> None:
            messages = with_headers(messages) if self.sink_format == "kafka" else messages.drop("message_id")
            write_messages(messages, self.sink_format, topic=topic, options=self.sink_options,
                           path=self.sink_path, batch_id=batch_id)
        self._outbox(spark).send(topic, batch_id, df, deliver)

    def _keep(self, docs: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """Store the batch's documents; the batch and the corpus as of it."""
        spark = docs.sparkSession
        if self.compact_after:
            table = SnapshotTable(spark, self.corpus_path, self.compact_after)
            table.append(batch_id, docs)
            table.vacuum()
            corpus = table.read()
        else:
            docs.write.mode("overwrite").parquet(f"{self.corpus_path.rstrip('/')}/batch_id={batch_id}")
            corpus = spark.read.parquet(self.corpus_path)
        return corpus.filter(F.col("batch_id") == F.lit(batch_id)), corpus.filter(F.col("batch_id") <= F.lit(batch_id))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """The per-batch action (``foreachBatch``)."""
        # The batch is read three times (empty check, notices, corpus
        # write); keep it so the source (e.g. Kafka) is fetched once.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._process(batch, batch_id)
        finally:
            batch.unpersist()

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        named = batch.filter(F.col("doc_name").isNotNull())
        self._write(named.select(notice("doc_name").alias("value")), self.notice_topic, batch_id, spark)
        # Each document is tokenised once, when it arrives: its term array is
        # stored next to its contents, and every later refit reads the arrays.
        docs = doc_terms(batch.filter(is_not_blank("content")), "content", None,
                         self.normalize, keep=("doc_name", "content"))
        here, corpus = self._keep(docs, batch_id)  # a replay sees the corpus of its time
        if here.isEmpty():
            return  # only blank documents: nothing new to fit
        if self._outbox(spark).has(self.score_topic, batch_id):
            self._write(None, self.score_topic, batch_id, spark)  # a replay does not fit again
            return
        if self.scope == "batch":
            corpus = here
        if self.min_new_docs > 1:
            last = self._last_fit(spark)
            new_docs = corpus.filter((F.col("batch_id") > F.lit(last))
                                     & (F.col("batch_id") <= F.lit(batch_id))).count()
            if new_docs < self.min_new_docs:
                return
        try:
            fit = fit_term_topics(corpus.select("terms"), id_col=None, k=self.k,
                                  optimizer=self.optimizer, max_iter=self.max_iter,
                                  seed=self.seed)
        except CorpusTooSmall as e:
            if self.on_small == "raise":
                raise
            log.warning("batch %s: %s; no scores published", batch_id, e)
            return
        scores = topic_scores(describe_topics(fit), self.top)
        self._write(score_message(scores), self.score_topic, batch_id, spark)
        if self.min_new_docs > 1:
            spark.createDataFrame([(batch_id,)], "batch_id long").write.mode(
                "overwrite").json(self._marker)


def start(source: DataFrame, job: CorpusJob, checkpoint_location: str | None = None,
          trigger: dict | None = None, query_name: str = "termflow_corpus") -> StreamingQuery:
    """Start the job on a streaming ``doc_name, content`` frame. Default
    trigger: a micro-batch every 5 seconds."""
    loc = stream_checkpoint(source.sparkSession, job.corpus_path, checkpoint_location)
    w = (source.writeStream.queryName(query_name).foreachBatch(job.process)
         .option("checkpointLocation", loc))
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()
