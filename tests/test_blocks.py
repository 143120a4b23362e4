"""Blocks of documents: equal to numpy on any number of blocks, each term sent once."""

from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from termflow.operators import blocks, em, parcels
from termflow.operators.em import fit_tables
from test_em import ROWS, counts, numpy_em


@pytest.mark.parametrize("k,rounds", [(3, 0), (4, 7)])
def test_many_blocks_as_numpy(spark, monkeypatch, k, rounds):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 40)
    monkeypatch.setattr(blocks, "SLICE", 16)
    rows = counts(k, 60)
    assert blocks.block_count(len(rows), 1) > 10
    model = fit_tables(spark.createDataFrame(rows, ROWS).repartition(5), k, len({r[1] for r in rows}), rounds, seed=9)
    terms, docs, _ = numpy_em(rows, k, 9, rounds)
    got_terms = {r.term_idx: [r[f"n{t}"] for t in range(k)] for r in model.terms.collect()}
    got_docs = {r.doc_id: [r[f"n{t}"] for t in range(k)] for r in model.docs.collect()}
    assert got_terms.keys() == terms.keys() and got_docs.keys() == docs.keys()
    assert all(np.allclose(got_terms[x], terms[x]) for x in terms) and all(np.allclose(got_docs[x], docs[x]) for x in docs)


def test_ids_that_are_texts_and_repeated_rows(spark, monkeypatch):
    rows = [(f"d{d}", t, tf) for d, t, tf in counts(2, 20)]
    rows += rows[:30]

    def fitted(most):
        monkeypatch.setattr(blocks, "BLOCK_ROWS", most)
        model = fit_tables(spark.createDataFrame(rows, ROWS.replace("doc_id long", "doc_id string")), 2, 30, 3)
        return {r.term_idx: (r.n0, r.n1) for r in model.terms.collect()}, {r.doc_id: (r.n0, r.n1) for r in model.docs.collect()}

    for one, many in zip(fitted(1 << 20), fitted(25)):
        assert one.keys() == many.keys() and all(np.allclose(one[x], many[x]) for x in one)
    assert set(one) == {r[0] for r in rows}
    assert all(abs(sum(one[d]) - sum(tf for i, _, tf in rows if i == d)) < 1e-9 for d in one)


def test_blocks_are_bounded_and_grow_with_the_rows():
    assert blocks.block_count(0, 8) == blocks.block_count(1000, 8) == 1
    assert blocks.block_count(10 * blocks.SMALL_BLOCK_ROWS, 8) == 8
    assert blocks.block_count(100 * blocks.BLOCK_ROWS, 8) == 100


def test_a_block_sends_each_of_its_terms_once():
    """However often a term occurs, one number of each topic goes to its shard."""
    n, k, shards = 5000, 3, 4
    rng = np.random.default_rng(5)
    rows = pa.table({"block": pa.array([0] * n, pa.int32()), "doc_id": rng.integers(0, 400, n), "doc": np.zeros(n, np.int64),
                     "term_idx": rng.integers(0, 25, n), "tf": np.ones(n)})
    block = blocks.Block.of(0, blocks.cutter("doc_id", shards)((pa.scalar(0),), rows))
    sent = blocks.messages(block, shards, *em.first_sums(k, 1)(block))
    terms = blocks.flat(sent["terms"])
    assert sorted(terms.tolist()) == sorted(set(rows["term_idx"].to_pylist())) and len(sent) == shards + 1
    assert abs(sum(x.values.to_numpy().sum() for x, d in zip(sent["n"], sent["of_docs"].to_pylist()) if not d) - n) < 1e-6


def test_numbers_travel_as_bytes():
    """Lists of numbers become bytes and come back the same, empty ones and parts of columns too."""
    table = pa.table({"shard": pa.array([3, 1, 2], pa.int32()), "terms": pa.array([[5, 6], [], [7]], pa.list_(pa.int64())),
                      "n": pa.array([[0.5], [1.5, -2.0, 3.0], []], pa.list_(pa.float64()))})
    there = blocks.packed(table)
    assert there["terms"].type == there["n"].type == pa.binary()
    assert blocks.unpacked(there).to_pydict() == table.to_pydict()
    cut = pa.concat_tables([there.slice(1, 2), there.slice(0, 1), there.slice(0, 0)])
    assert blocks.unpacked(cut).to_pydict() == pa.concat_tables([table.slice(1), table.slice(0, 1)]).to_pydict()
    assert blocks.unpacked(blocks.packed(table.slice(0, 0))).num_rows == 0


def test_a_round_moves_messages_alone(spark, monkeypatch):
    """Blocks are not dealt again in a round, and each has a partition of its own."""
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 200)
    rows = counts(2, 60)
    run = blocks.Rounds(spark.createDataFrame(rows, ROWS).selectExpr("*", "doc_id AS doc"), "doc_id", 2, len(rows),
                        em.first_sums(2, 1), em.em_step(2, 30, 2.0, 1.1))
    run.more(1)
    round_of_blocks = run.sent._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert "FlatMapCoGroupsInArrow" in round_of_blocks and "Exchange" not in round_of_blocks
    assert run.blocks > 2 and run.table.rdd.getNumPartitions() == run.sent.rdd.getNumPartitions() == run.blocks
    run.close()


def test_files_of_earlier_rounds_are_gone(spark, monkeypatch):
    """Disk holds two sets of messages at most, however many rounds there were."""
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 3000)
    k, rows = 40, [(d, t, 1) for d in range(60) for t in range(d % 7, 400, 2)]

    def sizes():
        local = [Path(x) for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
        shared = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
        return (sum(f.stat().st_size for d in local for f in d.rglob("shuffle_*.data")),
                {str(f): f.stat().st_size for d in shared.glob("em-*") for f in d.rglob("*") if f.is_file()})

    run = blocks.Rounds(spark.createDataFrame(rows, ROWS).selectExpr("*", "doc_id AS doc"), "doc_id", k, len(rows),
                        em.first_sums(k, 1), em.em_step(k, 400, 2.0, 1.1))
    assert run.blocks > 1
    run.keep()
    shuffled, there = sizes()
    messages = sum(there[f] for f in there if "/em-up-" in f)
    assert messages > run.blocks * 300 * k * 8
    run.more(6)
    run.keep()
    after, now = sizes()
    assert after - shuffled < messages
    assert abs(sum(now.values()) - sum(there.values())) < messages / 2
    run.close()
    assert sum(sizes()[1].values()) <= sum(there.values()) - messages


def test_parcels_come_back_as_they_were(tmp_dir):
    tables = [pa.table({"a": [1, 2], "b": pa.array([[0.5], None], pa.list_(pa.float64()))}), pa.table({"c": ["x"]}),
              pa.table({"a": pa.array([], pa.int64())})]
    for compression in (None, "lz4"):
        sent = parcels.put(f"file:{tmp_dir}/par cels%", tables, compression)
        assert parcels.get(sent) == tables and parcels.get(sent.take([2, 0])) == [tables[2], tables[0]]
    assert len(set(sent["file"].to_pylist())) == 1 and len(list(Path(tmp_dir, "par cels%").iterdir())) == 2
    assert parcels.put(tmp_dir, []).num_rows == 0


@pytest.mark.parametrize("size", [7, 9])
def test_described_topics_rank_as_a_sort(spark, size):
    """Ties to the smaller number, over several tasks; numbers that occur nowhere count as 0."""
    weights = [(t, float(t % 3), float(5 - t % 2)) for t in range(7)]
    model = em.TopicTables(spark.createDataFrame(weights, "term_idx long, n0 double, n1 double").repartition(4), 2, size, 2.0)
    got = {(r.topic, r["rank"]): (r.term_idx, r.weight) for r in model.described(8).collect()}
    full = weights + [(t, 0.0, 0.0) for t in range(7, size)]
    for topic in (0, 1):
        best = sorted(full, key=lambda r: (-r[1 + topic], r[0]))[:8]
        total = sum(r[1 + topic] for r in full)
        assert [got[topic, i] for i in range(len(best))] == [(r[0], r[1 + topic] / total) for r in best]
    assert len(got) == 2 * min(8, size)
