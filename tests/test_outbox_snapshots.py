"""Messages sent once and versions of a growing table, with writers that stop anywhere."""

import os

import pytest

from termflow.sinks.outbox import Outbox, with_headers
from termflow.streaming import snapshots
from termflow.streaming.corpus import CorpusJob
from termflow.streaming.snapshots import Conflict, SnapshotTable


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_a_replay_sends_nothing_that_was_sent(spark, tmp_dir):
    box, sent = Outbox(spark, f"{tmp_dir}/box"), []
    deliver = lambda df: sent.append(sorted((r.message_id, r.value) for r in df.collect()))
    assert box.send("t", 0, messages(spark, "a", "b"), deliver) is True
    assert box.send("t", 0, messages(spark, "other"), deliver) is False
    assert box.send("u", 0, messages(spark, "c"), deliver) and box.send("t", 1, messages(spark), deliver)
    assert [sorted(v for _, v in s) for s in sent] == [["a", "b"], ["c"], []]
    assert len({i for s in sent for i, _ in s}) == 3


def test_stopped_between_sending_and_marker(spark, tmp_dir):
    box, target = Outbox(spark, f"{tmp_dir}/box"), f"{tmp_dir}/out/batch=0"

    def deliver(df):
        df.write.mode("overwrite").json(target)

    def stops(df):
        deliver(df)
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        box.send("t", 0, messages(spark, "a", "b"), stops)
    assert box.has("t", 0) and not box.is_sent("t", 0)
    # What the replay computes differs; what was promised is sent, once, under the same ids.
    before = {(r.message_id, r.value) for r in spark.read.json(target).collect()}
    assert box.send("t", 0, messages(spark, "x"), deliver)
    rows = spark.read.json(target).collect()
    assert {(r.message_id, r.value) for r in rows} == before and len(rows) == 2
    box.forget("t", 1)
    assert box.is_sent("t", 0) and not box.has("t", 0) and not box.send("t", 0, None, deliver)


def test_ids_travel_as_headers(spark):
    df = spark.createDataFrame([("v", "t:1:0")], "value string, message_id string")
    row = with_headers(df).first()
    assert row.headers[0].key == "message_id" and bytes(row.headers[0].value) == b"t:1:0" and "message_id" not in row


def docs(spark, b, n=3):
    return spark.createDataFrame([(f"n{b}-{i}", " ".join(f"{c}{chr(97 + (b + i) % 26)}xyz" for c in "abcdefghijklmnopqrstuvwxyz"))
                                  for i in range(n)], "doc_name string, content string")


@pytest.mark.parametrize("compact_after", [0, 2])
def test_a_stream_stopped_before_its_commit_publishes_once(spark, tmp_dir, monkeypatch, compact_after):
    job = CorpusJob(f"{tmp_dir}/corpus", f"{tmp_dir}/out", k=2, max_iter=1, on_small="raise", compact_after=compact_after)
    job.process(docs(spark, 0), 0)
    send = Outbox.send

    def stops(self, topic, batch_id, df, deliver):
        def then_stop(m):
            deliver(m)
            raise KeyboardInterrupt
        return send(self, topic, batch_id, df, then_stop if topic == job.score_topic else deliver)

    monkeypatch.setattr(Outbox, "send", stops)
    with pytest.raises(KeyboardInterrupt):
        job.process(docs(spark, 1), 1)
    monkeypatch.undo()
    fits = []
    monkeypatch.setattr("termflow.streaming.corpus.fit_term_topics", lambda *a, **k: fits.append(1))
    for _ in range(2):
        job.process(docs(spark, 1), 1)
    assert not fits  # the replay sends the outbox's message and does not fit again
    scores = spark.read.json(f"{tmp_dir}/out/topic={job.score_topic}")
    notices = spark.read.json(f"{tmp_dir}/out/topic={job.notice_topic}")
    assert scores.count() == 2 and notices.count() == 6 and notices.distinct().count() == 6


def test_many_batches_leave_few_folders(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    table = SnapshotTable(spark, path, compact_after=8)
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        pinned = None
        for b in range(60):
            table.append(b, spark.range(b * 10, b * 10 + 10, 1, 1).toDF("x"))
            table.append(b, spark.range(5).toDF("x"))  # a replay
            if b == 20:
                pinned = table.read()
                version = table.latest()
                want = pinned.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert table.read().count() == 600 and {r.x for r in table.read().collect()} == set(range(600))
    assert pinned.count() == want == 210 == table.read(version).count()
    assert len(table.read().inputFiles()) <= 8
    table.vacuum(keep=2)
    assert len(os.listdir(f"{path}/data")) <= 10 and table.read().count() == 600
    assert sum(f.endswith(".json") for f in os.listdir(f"{path}/versions")) == 2


def test_writers_that_meet_or_stop(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    one, two = SnapshotTable(spark, path), SnapshotTable(spark, path)
    assert one.read(schema="x long, batch_id long").count() == 0
    with pytest.raises(FileNotFoundError):
        one.read()
    one.append(0, spark.range(3).toDF("x"))
    # Another writer is first each time that this one is about to commit, twice.
    commit, meet = SnapshotTable._commit, [1, 2]

    def late(self, state, version):
        if self is one and meet:
            two.append(meet.pop(0), spark.range(2).toDF("x"))
        return commit(self, state, version)

    monkeypatch.setattr(SnapshotTable, "_commit", late)
    one.append(3, spark.range(4).toDF("x"))
    monkeypatch.undo()
    assert {(r.batch_id, r["count"]) for r in one.read().groupBy("batch_id").count().collect()} == {(0, 3), (1, 2), (2, 2), (3, 4)}
    with pytest.raises(Conflict):
        one._commit(one._state(one.latest()), one.latest())
    # A writer that stopped before its version leaves a folder that nobody reads.
    monkeypatch.setattr(SnapshotTable, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        two.append(9, spark.range(7).toDF("x"))
    monkeypatch.undo()
    assert one.read().count() == 11 and not one.has(9)
    one.vacuum()
    assert len(os.listdir(f"{path}/data")) == 4
    monkeypatch.setattr(snapshots, "SMALL_BYTES", 1)
    assert one.compact() == one.latest()  # nothing is small
