import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from termflow.llm.secrets import ASSIGN, MASK

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    """Each stage against what plain Python makes of its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF).cache()
        kept.append(docs.toPandas())
        if i < 3:
            assert docs.columns == columns
    calm, single, masked, packed = kept
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    whole = spark.read.parquet(f"{SF}/documents.parquet").toPandas()

    gone = set(whole.doc_id) - set(calm.doc_id)
    toxic = set(labels.doc_id[labels.toxic == 1])
    clean = set(labels.doc_id[labels.toxic == 0])
    assert len(gone & toxic) > 10 and len(gone & clean) < 0.02 * len(clean)

    sets = {}
    for d, text in zip(calm.doc_id, calm.text):
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    where = {}
    for d in sorted(sets):
        near = {}
        for s in sets[d]:
            for o in where.setdefault(s, []):
                near[o] = near.get(o, 0) + 1
            where[s].append(d)
        for o, n in near.items():
            if 100 * n >= 80 * (len(sets[d]) + len(sets[o]) - n):
                a, b = find(d), find(o)
                root[max(a, b)] = min(a, b)
    assert set(single.doc_id) == {d for d in sets if find(d) == d}
    assert len(single) == single.doc_id.nunique() < len(calm)

    texts = dict(zip(single.doc_id, single.text))
    assert set(masked.doc_id) == set(texts) and (masked.text.str.len() == masked.n_chars).all()
    rule = re.compile(ASSIGN, re.ASCII)
    had = {d for d, t in texts.items() if any(len(m[2]) >= 6 for m in rule.finditer(t))}
    assert had
    for d, t in zip(masked.doc_id, masked.text):
        assert not any(len(m[2]) >= 6 for m in rule.finditer(t)) and not re.search("[0-9a-f]{24}|AKIA[A-Z0-9]{16}", t)
        assert (MASK in t) == (t != texts[d])
        assert d not in had or MASK in t

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = packed.sort_values(["doc_id", "piece"])
    for d, t in zip(masked.doc_id, masked.text):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        mine = packed[packed.doc_id == d]
        assert mine.length.sum() == len(ids)
        for start, n, crc in zip(mine.start, mine.length, mine.ids_crc32):
            assert zlib.crc32(ids[start:start + n].tobytes()) == crc
    total = packed.length.sum()
    assert packed.groupby("sequence_id").length.sum().max() <= 2048
    assert packed.sequence_id.nunique() <= 1.01 * -(-total // 2048)


def test_empty_and_null_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0)], docs.schema)
    for some in (docs.limit(0), odd):
        rows = some
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, SF)
        assert rows.count() == some.count()


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 150
