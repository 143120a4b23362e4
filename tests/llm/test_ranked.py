import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from termflow.llm.ranked import Best, Shard, op13_ranked_search, ranked_search, search_shard

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    tfs = [(d, Counter(terms(t))) for d, t in docs]
    tfs = [(d, c, sum(c.values())) for d, c in tfs if c]
    n, total = len(tfs), sum(s for _, _, s in tfs)
    df = Counter(t for _, c, _ in tfs for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, ts in asked.items():
        w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in ts}
        scored = []
        for d, c, size in tfs:
            m = 10 + 90 * size * n // total
            s = sum(w[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if s > 0 and d is not None:
                scored.append((-s, d))
        out += [(i, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(80)] + ["é", "中文", "A", "a", "x1"]
    pick = lambda k: " ".join(words[min(int(rng.expovariate(0.06)), len(words) - 1)] for _ in range(k))
    docs = [(i, pick(rng.choice((0, 1, 5, 30, 200)))) for i in range(n)]
    docs += [(1000 + i, docs[i % 5][1]) for i in range(n // 2)]  # ties
    docs += [(3, docs[3][1]), (None, "w0 w1 w2"), (None, None), (5000, ""), (5001, "-- ,.")]
    items = [(i, pick(rng.choice((1, 4, 30)))) for i in range(25)] + [(0, "w70 w71"), (90, None), (91, ""), (92, "nowhere"), (None, "w3")]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("options", [{}, {"shard_docs": 37}, {"item_bytes": 200}, {"top": 3, "shard_postings": 500}])
def test_as_brute_force(spark, options):
    docs, items = corpus(len(options))
    got = ranked_search(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS), **options)
    assert found(got) == brute(docs, items, options.get("top", 10))


def test_empty_tables_and_other_columns(spark):
    docs, items = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([(1, "a")], ITEMS)
    none, nothing = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert ranked_search(none, items).count() == 0
    assert ranked_search(docs, nothing).count() == 0
    named = spark.createDataFrame([(1, "a b", 9, "x"), (2, "c", 9, "x"), (3, "d", 9, "x")], "doc_id long, text string, n int, terms string")
    assert found(ranked_search(named, items)) == brute([(1, "a b"), (2, "c"), (3, "d")], [(1, "a")])


def test_long_text(spark):
    docs = [(1, "rare " + "common " * 300_000), (2, "rare common"), (3, "common")] + [(i, f"other{i}") for i in range(4, 40)]
    items = [(1, "rare common"), (2, "common")]
    got = ranked_search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert found(got) == brute(docs, items)


@pytest.mark.parametrize("short", [0, 1 / 32, 0.2, 1])
@pytest.mark.parametrize("window", [1, 7, 64, 5000])
def test_hybrid_is_exact_for_any_split(short, window):
    rng = np.random.default_rng(window)
    docs, n_terms = 900, 12
    held = rng.random((docs, n_terms)) < np.linspace(0.005, 0.7, n_terms)
    row, term = np.nonzero(held)
    tf = rng.integers(1, 5, len(row)).astype("<u4")
    weight = rng.integers(0, 9000, n_terms)
    ids = rng.permutation(docs) * 3
    shard = Shard(ids, rng.integers(20, 300, docs), np.bincount(row, minlength=docs), term, tf, weight)
    scores = np.zeros(docs, np.int64)
    np.add.at(scores, shard.doc, shard.value)
    best = Best(10)
    search_shard(shard, np.arange(n_terms), best, window, short)
    order = np.lexsort((shard.ids, -scores))[:10]
    assert best.ids.tolist() == shard.ids[order].tolist() and best.scores.tolist() == scores[order].tolist()


def test_windows_and_lists_are_skipped():
    rng = np.random.default_rng(1)
    docs = 60_000
    rare, common = np.flatnonzero(rng.random(docs) < 0.001), np.flatnonzero(rng.random(docs) < 0.8)
    row = np.concatenate([rare, common])
    term = np.concatenate([np.zeros(len(rare), int), np.ones(len(common), int)])
    order = np.argsort(row, kind="stable")
    shard = Shard(np.arange(docs), np.full(docs, 100), np.bincount(row, minlength=docs), term[order], np.ones(len(row), "<u4"),
                  np.array([7000, 200]))
    best = Best(10)
    assert search_shard(shard, np.array([0, 1]), best, 64) < 0.2 * len(row)
    assert len(best.ids) == 10 and set(best.ids.tolist()) <= set(rare.tolist())


def test_query_on_the_tables(spark):
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").select(*c).collect()]
    got = found(op13_ranked_search(spark, "/root/testdata/sf0.001"))
    assert got == brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
