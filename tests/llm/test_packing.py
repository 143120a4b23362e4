import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from termflow.llm.packing import LocalSearch, best_fit, op10_best_fit_packing, pack, pack_documents, pack_shard

PATH = public_tokenizers.path("word_bpe_49k.json")


def bins(where, length):
    return np.bincount(where, length)


@pytest.mark.parametrize("seed", range(6))
def test_search_keeps_pieces_and_never_opens_bins(seed):
    rng = np.random.default_rng(seed)
    length = rng.integers(1, 101, 60)
    first = best_fit(length, 100)
    search = LocalSearch(length, first, 100)
    after = search.run()
    assert bins(after, length).max() <= 100 and (bins(after, length) > 0).sum() <= (bins(first, length) > 0).sum()
    assert np.array_equal(search.fill, np.bincount(after, length, len(search.fill)))
    assert (bins(after, length)**2).sum() >= (bins(first, length)**2).sum()


def test_search_empties_a_bin_that_best_fit_leaves():
    # Best fit opens three bins; an exchange of one for two fills two of them.
    length = np.array([6, 4, 4, 2, 2, 2])
    start = np.array([0, 1, 1, 0, 2, 2])  # fills 8, 8, 4
    assert (bins(LocalSearch(length, start, 10).run(), length) > 0).sum() == 2


@pytest.mark.parametrize("kind, length, start", [
    ("move", [5, 3, 2], [0, 0, 1]),
    ("one_for_one", [7, 2, 5, 3], [0, 0, 1, 1]),
    ("two_for_one", [6, 3, 2, 2], [0, 0, 1, 1]),
    ("one_for_two", [5, 2, 2, 5], [0, 0, 0, 1])])
def test_each_exchange_grows_the_sum_of_squares(kind, length, start):
    s = LocalSearch(np.array(length), np.array(start), 10)
    own, others = np.flatnonzero(s.where == 1), np.flatnonzero(s.where == 0)
    give, take, target = getattr(s, kind)(1, own, others, np.array([0]))
    d = sum(length[i] for i in give) - sum(length[i] for i in take)
    assert target == 0 and 0 < d <= 10 - s.fill[0] and s.fill[0] + d > s.fill[1]


def test_offsets_are_gapless():
    length = np.random.default_rng(3).integers(1, 50, 200)
    where, offset, fill = pack_shard(length, 64)
    for b in set(where.tolist()):
        mine = np.flatnonzero(where == b)
        mine = mine[np.argsort(offset[mine])]
        assert offset[mine].tolist() == (np.cumsum(length[mine]) - length[mine]).tolist()
        assert set(fill[mine].tolist()) == {length[mine].sum()}


def test_many_shards(spark):
    rng = random.Random(5)
    rows = [(i // 2, rng.choice([1, 5, 40, 90, 99, 100]) if i % 3 else 7, "x") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, length long, bin string").repartition(5)
    got = pack(df, 100, shard=64).toPandas()
    assert sorted(zip(got.doc_id, got.length)) == sorted((a, b) for a, b, _ in rows)
    fills = got.groupby("sequence_id").length.sum()
    assert fills.max() <= 100 and len(fills) <= 1.03 * -(-sum(r[1] for r in rows) // 100)
    for _, g in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert g.offset.tolist() == (g.length.cumsum() - g.length).tolist()
    assert pack(df.limit(0), 100).collect() == []


def test_equal_rows_are_dealt_apart(spark):
    df = spark.createDataFrame([(None, 30)] * 640, "doc_id long, length long")
    got = pack(df, 100, shard=64).toPandas()
    # Ten shards in the first round, numbered from bit 52 on.
    first = got.sequence_id[got.sequence_id < 2 << 56]
    shards = (first % (1 << 56)) // (1 << 52)
    assert shards.nunique() == 10 and shards.value_counts().max() <= 128
    assert len(got) == 640 and got.groupby("sequence_id").length.sum().max() <= 100


def checked(packed, rows, capacity=2048):
    library = Tokenizer.from_file(PATH)
    want = []
    for d, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(d, k, a, len(ids[a:a + capacity]), zlib.crc32(ids[a:a + capacity].tobytes()))
                 for k, a in enumerate(range(0, len(ids), capacity))]
    got = packed.toPandas()
    columns = zip(got.doc_id, got.piece, got.start, got.length, got.ids_crc32)
    assert sorted([(None if d != d else d, *r) for d, *r in columns], key=str) == sorted(want, key=str)
    fills = got.groupby("sequence_id").length.sum()
    assert fills.max() <= capacity
    for _, g in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert g.offset.tolist() == (g.length.cumsum() - g.length).tolist()
    return len(fills), -(-int(got.length.sum()) // capacity)


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    n, least = checked(op10_best_fit_packing(spark, sf), rows)
    assert n <= 1.01 * least + 1


def test_edge_rows(spark):
    rows = [(1, None, 4), (2, "", 5), (3, "word " * 7, 6), (3, "word " * 7, 6), (None, "a b", 7), (4, "x " * 15, 8), (5, "y " * 50, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    checked(pack_documents(docs, PATH, capacity=16), [r[:2] for r in rows], 16)
