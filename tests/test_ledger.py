"""The poll job's offsets: deleted heads, empty polls, polls that stop."""

import pytest

from termflow.streaming.ledger import OffsetLedger, poll

SCHEMA = "topic string, partition int, offset bigint, value string"


def _messages(spark, *spans):
    return spark.createDataFrame([(t, p, o, f"{t}{p}-{o}") for t, p, a, b in spans for o in range(a, b)], SCHEMA)


@pytest.fixture
def job(spark, tmp_dir):
    ledger, sent = OffsetLedger(spark, f"{tmp_dir}/ledger"), {}

    def publish(rows, batch):
        sent[batch] = sorted((r.topic, r.partition, r.offset) for r in rows.collect())
    return ledger, sent, publish


def _span(t, p, a, b):
    return [(t, p, o) for o in range(a, b)]


def test_polls_continue_and_an_empty_one_has_no_batch(spark, job):
    ledger, sent, publish = job
    assert poll(_messages(spark), ledger, publish) is None
    assert poll(_messages(spark, ("a", 0, 0, 5), ("a", 1, 0, 2)), ledger, publish) == 0
    assert poll(_messages(spark, ("a", 0, 0, 5), ("a", 1, 0, 2)), ledger, publish) is None
    # one partition goes on, one stays, one is new
    assert poll(_messages(spark, ("a", 0, 0, 7), ("a", 1, 0, 2), ("b", 0, 3, 5)), ledger, publish) == 1
    assert sent == {0: _span("a", 0, 0, 5) + _span("a", 1, 0, 2), 1: _span("a", 0, 5, 7) + _span("b", 0, 3, 5)}
    ledger.forget()
    # a partition that stood out one batch has not been forgotten
    assert poll(_messages(spark, ("a", 0, 0, 7), ("a", 1, 0, 3), ("b", 0, 3, 5)), ledger, publish) == 2
    assert sent[2] == [("a", 1, 2)]


def test_out_of_range_falls_back_to_the_earliest(spark, job):
    ledger, sent, publish = job
    poll(_messages(spark, ("a", 0, 0, 5), ("a", 1, 0, 9), ("a", 2, 0, 4)), ledger, publish)
    # 0: the head is deleted beyond what was read; 1: begins anew; 2: all messages gone for a while
    poll(_messages(spark, ("a", 0, 8, 11), ("a", 1, 0, 2)), ledger, publish)
    assert sent[1] == _span("a", 0, 8, 11) + _span("a", 1, 0, 2)
    poll(_messages(spark, ("a", 0, 8, 11), ("a", 1, 0, 2), ("a", 2, 4, 6)), ledger, publish)
    assert sent[2] == _span("a", 2, 4, 6)


def test_a_poll_that_stops_is_repeated_over_the_same_offsets(spark, job):
    ledger, sent, publish = job

    def stops(rows, batch):
        publish(rows, batch)
        raise RuntimeError("stop")
    with pytest.raises(RuntimeError):
        poll(_messages(spark, ("a", 0, 0, 3)), ledger, stops)
    assert sent.pop(0) == _span("a", 0, 0, 3)
    # more has come meanwhile: it waits for the next batch
    more = _messages(spark, ("a", 0, 0, 6))
    assert poll(more, ledger, publish) == 0 and poll(more, ledger, publish) == 1
    assert sent == {0: _span("a", 0, 0, 3), 1: _span("a", 0, 3, 6)}


def test_null_offsets_repeats_and_clashing_columns(spark, job):
    ledger, _, _ = job
    rows = spark.createDataFrame([("a", 0, 1, 7), ("a", 0, 1, 7), ("a", 0, None, 8)],
                                 "topic string, partition int, offset bigint, first int")
    got = []
    assert poll(rows, ledger, lambda r, _: got.extend(r.collect())) == 0
    assert [tuple(r) for r in got] == [("a", 0, 1, 7)] * 2
