import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from termflow.llm.common import shared_folder
from termflow.llm.wavelet import (WaveletMatrix, file_reader, op9_wavelet_token_files, read_documents, shard_bytes,
                                  shard_starts, write_shards)

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.mark.parametrize("n, top", [(1, 0), (1, 9), (700, 3), (5000, 49407), (1537, 100_000), (512, 1)])
def test_queries_against_the_plain_ids(n, top):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.4, n), top).astype(np.uint32)
    data = b"".join(shard_bytes(ids, [4, None], np.array([n // 2, n])))
    m = WaveletMatrix(lambda at, size: data[at:at + size])
    assert m.tokens().tolist() == ids.tolist()
    assert m.doc_ids == [4, None] and m.ends.tolist() == [n // 2, n]
    for i in {0, n // 3, n // 2, n - 1}:
        assert m.access(i) == ids[i]
    for token in [*{int(x) for x in ids[:5]}, top + 1, 2]:
        where = np.flatnonzero(ids == token)
        assert m.count(token) == len(where)
        assert m.count(token, n // 4, n // 2) == ((where >= n // 4) & (where < n // 2)).sum()
        assert [m.select(token, k) for k in range(min(4, len(where)))] == where[:4].tolist()
        with pytest.raises(IndexError):
            m.select(token, len(where))
    with pytest.raises(IndexError):
        m.access(n)


def expected(rows):
    start, out = 0, []
    for doc_id, text in rows:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_documents_against_the_library(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = op9_wavelet_token_files(spark, SF).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected(rows)


def test_small_shards_nulls_repeats_and_extra_columns(spark):
    rows = [(3, "b a", 1), (1, None, 2), (2, "", 3), (2, "", 4), (5, "long " * 300, 5), (None, "x", 6), (4, "c", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    folder = shared_folder(spark, "wavelet-test")
    shards = write_shards(docs, folder, PATH, 2, shard_tokens=2)
    got = [tuple(r) for r in read_documents(shard_starts(shards)).orderBy("start").collect()]
    assert got == expected(sorted([r[:2] for r in rows], key=lambda r: (r[0] is not None, r[0] or 0)))
    some = shards.first()["file"]
    assert WaveletMatrix(file_reader(some)).n > 0
    none = write_shards(docs.limit(0), folder, PATH, 2)
    assert read_documents(shard_starts(none)).collect() == []
