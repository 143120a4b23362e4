"""Streaming jobs on file sources: two waves, replay, empty batch; the
stream result equals the batch computation over the same input."""

import json
import os

import pytest
from pyspark.sql import functions as F

from termflow.operators import prices as P
from termflow.operators.tokens import term_counts
from termflow.streaming import corpus as C
from termflow.streaming import prices as SP
from termflow.streaming.sources import doc_stream

from conftest import SF_SMALL


def _write_jsonl(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


@pytest.fixture(scope="module")
def docs(spark):
    rows = (spark.read.parquet(f"{SF_SMALL}/documents.parquet")
            .select("doc_id", "text").orderBy("doc_id").collect())
    return [(f"doc/{r.doc_id}.txt", r.text) for r in rows]


def _run_available(spark, src_dir, job, ckpt):
    q = C.start(doc_stream(spark, "json", path=src_dir), job, ckpt, {"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None


def test_corpus_stream_two_waves(spark, tmp_dir, docs):
    src = f"{tmp_dir}/in"
    half = len(docs) // 2
    wave1 = [{"doc_name": n, "content": t} for n, t in docs[:half]]
    wave1 += [{"doc_name": None, "content": "unnamed document text here"},
              {"doc_name": "blank.txt", "content": " \t\n"}]
    wave2 = [{"doc_name": n, "content": t} for n, t in docs[half:]]
    job = C.CorpusJob(corpus_path=f"{tmp_dir}/corpus", sink_path=f"{tmp_dir}/out",
                      max_iter=5, optimizer="online")
    ckpt = f"{tmp_dir}/ckpt"
    _write_jsonl(f"{src}/w1.json", wave1)
    _run_available(spark, src, job, ckpt)
    _write_jsonl(f"{src}/w2.json", wave2)
    _run_available(spark, src, job, ckpt)

    corpus = spark.read.parquet(job.corpus_path)
    assert sorted(r.batch_id for r in corpus.select("batch_id").distinct().collect()) == [0, 1]
    # blank content dropped, unnamed kept
    assert corpus.count() == len(docs) + 1
    notices = spark.read.json(f"{tmp_dir}/out/topic=tcmeta")
    assert notices.count() == len(docs) + 1  # named documents only (blank.txt is named)
    assert notices.filter(F.col("value") == "New doc received: blank.txt").count() == 1
    # the stream corpus counts the same terms as a batch job over both waves
    batch_docs = spark.createDataFrame(
        [(n, t) for n, t in docs] + [(None, "unnamed document text here")],
        "doc_name string, content string")
    a = term_counts(corpus, "content", normalize=False)
    b = term_counts(batch_docs, "content", normalize=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # one score message per batch, each a JSON object of <= 10 scores
    msgs = spark.read.json(f"{tmp_dir}/out/topic=tcdata").collect()
    assert len(msgs) == 2
    for m in msgs:
        scores = json.loads(m.value)
        assert 0 < len(scores) <= 10 and all(isinstance(v, float) for v in scores.values())


def test_corpus_replay_and_empty(spark, tmp_dir, docs):
    job = C.CorpusJob(corpus_path=f"{tmp_dir}/corpus", sink_path=f"{tmp_dir}/out",
                      max_iter=3, optimizer="online", scope="batch")
    batch = spark.createDataFrame(docs[:50], "doc_name string, content string")
    job.process(batch, 0)
    job.process(batch, 0)  # replay of the same batch id
    assert spark.read.parquet(job.corpus_path).count() == 50
    assert spark.read.json(f"{tmp_dir}/out/topic=tcmeta").count() == 50
    job.process(batch.limit(0), 1)  # nothing arrived: no run
    assert not os.path.exists(f"{job.corpus_path}/batch_id=1")


def test_corpus_too_small_is_skipped(spark, tmp_dir):
    job = C.CorpusJob(corpus_path=f"{tmp_dir}/corpus", sink_path=f"{tmp_dir}/out", max_iter=2)
    small = spark.createDataFrame([("a", "alpha beta gamma delta")], "doc_name string, content string")
    job.process(small, 0)  # logged and skipped
    assert not os.path.exists(f"{tmp_dir}/out/topic=tcdata")
    job.on_small = "raise"
    with pytest.raises(Exception, match="Doc too small"):
        job.process(small, 1)


def test_price_stream_equals_batch(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    bars = P.daily_bars(ev)
    msgs = P.to_price_json(bars).withColumn("_day", F.get_json_object("value", "$.timestamp"))
    rows = msgs.orderBy("_day", "key").collect()
    days = sorted({r._day for r in rows})
    cut = days[len(days) // 2]
    src = f"{tmp_dir}/prices"
    job = SP.PriceJob(stats_path=f"{tmp_dir}/stats", state_path=f"{tmp_dir}/state",
                      output_path=f"{tmp_dir}/lines")
    ckpt = f"{tmp_dir}/ckpt"
    for wave, sel in (("a", [r for r in rows if r._day < cut]), ("b", [r for r in rows if r._day >= cut])):
        _write_jsonl(f"{src}/{wave}.json", [{"key": r.key, "value": r.value} for r in sel])
        q = SP.start(SP.price_stream(spark, "json", path=src), job, ckpt, {"availableNow": True})
        q.awaitTermination(300)
        assert q.exception() is None
    got = spark.read.json(f"{tmp_dir}/lines").select(
        "lastTimestamp", "stockSymbol", "lastClose", "deltaPercentage", "position")
    recs = bars.withColumn("b", F.when(F.col("timestamp") < F.lit(cut), 0).otherwise(1))
    want = P.positions(P.deltas(P.batch_stats(recs, batch_col="b")))
    assert got.count() == want.count() == bars.select("symbol").distinct().count()
    _same_lines(got, want)
    assert sorted(os.listdir(f"{tmp_dir}/state")) == ["batch_id=0", "batch_id=1"]
    # replaying batch 1 rewrites the same output
    wave_b = P.from_price_json(spark.read.json(f"{src}/b.json"))
    job.process(wave_b, 1)
    again = spark.read.json(f"{tmp_dir}/lines").select(*got.columns)
    _same_lines(again, want)


def _same_lines(a, b):
    """Equal output lines; doubles to 1e-9 relative (means of doubles depend
    on the order rows are summed, which differs between the two plans)."""
    ra, rb = sorted(map(tuple, a.collect())), sorted(map(tuple, b.collect()))
    assert len(ra) == len(rb)
    for x, y in zip(ra, rb):
        assert (x[0], x[1], x[4]) == (y[0], y[1], y[4])
        assert x[2] == pytest.approx(y[2], rel=1e-9) and x[3] == pytest.approx(y[3], rel=1e-9)


def test_price_state_stays_two_batches_deep(spark, tmp_dir):
    recs = [("s", f"2024-01-0{d}", 1.0 * d, 2.0 * d, 0.5 * d, 1.5 * d, 100 * d) for d in range(1, 4)]
    schema = ("symbol string, timestamp string, open double, high double, low double, "
              "close double, volume long")
    job = SP.PriceJob(stats_path=f"{tmp_dir}/stats", state_path=f"{tmp_dir}/state",
                      output_path=f"{tmp_dir}/lines")
    for b, r in enumerate(recs):
        job.process(spark.createDataFrame([r], schema), b)
    assert sorted(os.listdir(f"{tmp_dir}/state")) == ["batch_id=1", "batch_id=2"]
    lines = spark.read.json(f"{tmp_dir}/lines").orderBy("lastTimestamp").collect()
    assert [r.lastTimestamp for r in lines] == ["2024-01-02", "2024-01-03"]


def test_corpus_refit_waits_for_new_documents(spark, tmp_dir, docs):
    job = C.CorpusJob(corpus_path=f"{tmp_dir}/corpus", sink_path=f"{tmp_dir}/out",
                      max_iter=2, optimizer="online", min_new_docs=30)
    schema = "doc_name string, content string"
    job.process(spark.createDataFrame(docs[:40], schema), 0)   # 40 new: fit
    job.process(spark.createDataFrame(docs[40:60], schema), 1)  # 20 new: wait
    job.process(spark.createDataFrame(docs[60:75], schema), 2)  # 35 new since fit: fit
    published = sorted(os.listdir(f"{tmp_dir}/out/topic=tcdata"))
    assert published == ["batch_id=0", "batch_id=2"]
    assert spark.read.parquet(job.corpus_path).count() == 75


def test_text_file_stream_names_documents_by_path(spark, tmp_dir):
    words = " ".join(f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60))
    os.makedirs(f"{tmp_dir}/incoming")
    for i in range(3):
        with open(f"{tmp_dir}/incoming/doc{i}.txt", "w") as f:
            f.write(words.replace(" ", "\n", 20) + "\n")
    job = C.CorpusJob(corpus_path=f"{tmp_dir}/corpus", sink_path=f"{tmp_dir}/out",
                      max_iter=2, optimizer="online")
    q = C.start(doc_stream(spark, "text", path=f"{tmp_dir}/incoming"), job, f"{tmp_dir}/ckpt",
                {"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    names = sorted(os.path.basename(r.doc_name)
                   for r in spark.read.parquet(job.corpus_path).collect())
    assert names == ["doc0.txt", "doc1.txt", "doc2.txt"]
    # a term at a line's end is a term
    assert {len(r.terms) for r in spark.read.parquet(job.corpus_path).collect()} == {60}
    notices = sorted(r.value for r in spark.read.json(f"{tmp_dir}/out/topic=tcmeta").collect())
    assert all(v.startswith("New doc received: ") and v.endswith(".txt") for v in notices)


def test_restart_without_the_checkpoint_is_refused(spark, tmp_dir, docs):
    """Two waves, then a start that has lost the checkpoint: no document twice."""
    src = f"{tmp_dir}/in"
    job = C.CorpusJob(corpus_path=f"{tmp_dir}/corpus", sink_path=f"{tmp_dir}/out", max_iter=2, optimizer="online")
    for i in range(2):
        _write_jsonl(f"{src}/w{i}.json", [{"doc_name": n, "content": t} for n, t in docs[i * 30:i * 30 + 30]])
        _run_available(spark, src, job, None)
    assert os.path.isdir(f"{tmp_dir}/corpus_checkpoint/offsets")
    with pytest.raises(RuntimeError, match="checkpoint"):
        _run_available(spark, src, job, f"{tmp_dir}/new_checkpoint")
    assert spark.read.parquet(job.corpus_path).count() == 60


def test_a_batch_of_blank_documents_does_not_refit(spark, tmp_dir, docs):
    job = C.CorpusJob(corpus_path=f"{tmp_dir}/corpus", sink_path=f"{tmp_dir}/out", max_iter=2, optimizer="online")
    schema = "doc_name string, content string"
    job.process(spark.createDataFrame(docs[:40], schema), 0)
    job.process(spark.createDataFrame([("blank", " \t")], schema), 1)
    assert sorted(os.listdir(f"{tmp_dir}/out/topic=tcdata")) == ["batch_id=0"]
    # a replay of an earlier batch sees the corpus of its time
    job.process(spark.createDataFrame(docs[40:60], schema), 2)
    first = spark.read.json(f"{tmp_dir}/out/topic=tcdata/batch_id=0").first().value
    job.process(spark.createDataFrame(docs[:40], schema), 0)
    assert set(json.loads(spark.read.json(f"{tmp_dir}/out/topic=tcdata/batch_id=0").first().value)) == set(json.loads(first))
