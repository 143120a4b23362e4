import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from termflow.llm import substrings
from termflow.llm.substrings import op12_substring_dedup, without_repeats


def brute(rows, window):
    """(doc_id, n_words, n_removed, text) of each row, all windows in one dict."""
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    where = {}
    for d, w in enumerate(texts):
        for i in range(len(w) - window + 1):
            where.setdefault(tuple(w[i:i + window]), []).append((d, i))
    gone = [set() for _ in texts]
    for at in where.values():
        if len(at) > 1:
            for d, i in at:
                gone[d].update(range(i, i + window))
    return sorted((repr(i), len(w), len(g), " ".join(x for k, x in enumerate(w) if k not in g))
                  for (i, _), w, g in zip(rows, texts, gone))


def found(df):
    return sorted((repr(r["doc_id"]), r["n_words"], r["n_removed"], r["text"]) for r in df.collect())


def corpus(rng, n=120):
    words = [f"w{k}" for k in range(60)] + ["é", "中文", " x", "A", "a"]
    passages = [[rng.choice(words) for _ in range(rng.randint(8, 60))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.choice((0, 3, 20, 80)))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(w))
            p = rng.choice(passages)
            a = rng.randint(0, 5)
            w[at:at] = p[a:len(p) - rng.randint(0, 3)]
        if rng.random() < 0.1:
            w += ["same"] * rng.randint(5, 40)
        rows.append((i, rng.choice((" ", "\n", " \t ", "\x0b")).join(w)))
    rows += rows[:10]  # rows given twice
    rows += [(None, None), (None, rows[5][1]), (n + 1, ""), (n + 2, "  \n")]
    hot = " ".join(passages[0] * 2)
    return rows + [(1000 + i, f"{i} {hot} {i}") for i in range(80)]


@pytest.mark.parametrize("window,gram,sent", [(10, None, 64 << 20), (10, None, 0), (35, 16, 64 << 20), (2, 1, 64 << 20),
                                              (7, 7, 0)])
def test_as_brute_force(spark, window, gram, sent):
    rows = corpus(random.Random(window))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(without_repeats(df, window=window, gram=gram, broadcast_bytes=sent)) == brute(rows, window)


def test_small_batches_and_forgetful_tasks_lose_nothing(spark, monkeypatch):
    # Closures carry these values to the workers.
    rows = corpus(random.Random(3), 300)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert found(without_repeats(df, window=12)) == brute(rows, 12)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert without_repeats(empty).columns == ["doc_id", "text", "n_words", "n_removed"]
    assert without_repeats(empty).count() == 0
    df = spark.createDataFrame([(1, "a b c", 5, "x"), (2, "a b c", 6, "y")], "doc_id long, text string, n_words int, mark string")
    assert found(without_repeats(df, window=3)) == [("1", 3, 3, ""), ("2", 3, 3, "")]


def test_very_long_text(spark):
    rng = random.Random(1)
    w = [str(rng.random()) for _ in range(200_000)]
    rows = [(1, " ".join(w + w[500:540] + ["end"])), (2, " ".join(w[100_000:100_035]))]
    got = found(without_repeats(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [(r[0], r[1], r[2]) for r in got] == [("1", 200_041, 115), ("2", 35, 35)]


def test_hot_windows_are_few_rows(spark):
    passage = " ".join(f"p{k}" for k in range(50))
    df = spark.createDataFrame([(i, f"{passage} own{i}") for i in range(3000)], "doc_id long, text string").repartition(4)
    texts = df.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("mark"), "text")
    sketch = substrings.merged_sketch(texts, 35, 16, 5, 20)
    likely = substrings.joined_estimates(texts, sketch, 35, 16, 5, 20)
    runs = substrings.candidate_runs(likely.coalesce(4), 35, 16, 5, 20)
    grouped = runs.where("repeated = 0").groupBy("anchor").count().agg(F.max("count")).first()[0]
    assert grouped <= 2 * 4  # two rows of a window for each task, whatever their number
    assert without_repeats(df).where("n_removed <> 50").count() == 0


def test_query_on_the_tables(spark):
    out = op12_substring_dedup(spark, "/root/testdata/sf0.001")
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    want = [(a, b, c, hashlib.sha256(t.encode()).hexdigest()) for a, b, c, t in brute(docs, 35)]
    got = sorted((repr(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out.collect())
    assert got == want
    assert any(r[2] for r in want)
