"""Command-line entry points, run in-process on the test session."""

import json
import os
import random

from termflow.__main__ import main


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_word_count(spark, tmp_dir):
    _write(f"{tmp_dir}/in.txt", "a b a\nb  c\n")
    main(["word-count", f"{tmp_dir}/in.txt", "--output", f"{tmp_dir}/out"])
    got = {r.value for r in spark.read.json(f"{tmp_dir}/out").collect()}
    assert got == {"a: 2", "b: 2", ": 1", "c: 1"}


def test_lda_numeric_with_save_load(spark, tmp_dir):
    rnd = random.Random(3)
    _write(f"{tmp_dir}/m.txt", "\n".join(" ".join(str(rnd.randint(0, 9)) for _ in range(11))
                                          for _ in range(12)) + "\n")
    main(["lda-numeric", f"{tmp_dir}/m.txt", "--model-path", f"{tmp_dir}/model",
          "--output", f"{tmp_dir}/out"])
    assert spark.read.json(f"{tmp_dir}/out").count() == 33


def test_lda_text_lines(spark, tmp_dir):
    words = [f"term{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)]
    rnd = random.Random(5)
    _write(f"{tmp_dir}/t.txt", "\n".join(" ".join(rnd.choice(words) for _ in range(30))
                                          for _ in range(200)) + "\n")
    main(["lda-text", f"{tmp_dir}/t.txt", "--optimizer", "online", "--max-iter", "5",
          "--output", f"{tmp_dir}/out"])
    msg = spark.read.json(f"{tmp_dir}/out").first().value
    scores = json.loads(msg)
    assert 0 < len(scores) <= 10 and set(scores) <= set(words)


def test_feed_then_corpus_stream(spark, tmp_dir):
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(80)]
    paths = []
    for i in range(6):
        p = f"{tmp_dir}/docs/{i}.txt"
        _write(p, " ".join(words[(i * 13 + j) % 80] for j in range(60)) + "\n")
        paths.append(p)
    _write(f"{tmp_dir}/manifest.txt", "\n".join(paths) + "\n")
    main(["feed", f"{tmp_dir}/manifest.txt", "--format", "json", "--path", f"{tmp_dir}/bus"])
    # the published messages are (key, value); the stream reads them as documents
    msgs = spark.read.json(f"{tmp_dir}/bus/topic=docs")
    msgs.selectExpr("key AS doc_name", "value AS content").write.json(f"{tmp_dir}/stream_in")
    main(["corpus-stream", "--source", "json", "--path", f"{tmp_dir}/stream_in",
          "--corpus", f"{tmp_dir}/corpus", "--sink-format", "json", "--sink-path",
          f"{tmp_dir}/sink", "--checkpoint", f"{tmp_dir}/ckpt", "--available-now",
          "--max-iter", "3"])
    assert spark.read.parquet(f"{tmp_dir}/corpus").count() == 6
    assert spark.read.json(f"{tmp_dir}/sink/topic=tcmeta").count() == 6
    assert spark.read.json(f"{tmp_dir}/sink/topic=tcdata").count() == 1


def test_price_stream_command(spark, tmp_dir):
    from termflow.operators import prices as P

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    P.to_price_json(P.daily_bars(ev)).write.json(f"{tmp_dir}/prices_in")
    main(["price-stream", "--source", "json", "--path", f"{tmp_dir}/prices_in",
          "--stats", f"{tmp_dir}/stats", "--state", f"{tmp_dir}/state",
          "--output-path", f"{tmp_dir}/lines", "--checkpoint", f"{tmp_dir}/ckpt",
          "--available-now"])
    # one micro-batch: statistics for every symbol, no previous batch, no lines yet
    stats = spark.read.parquet(f"{tmp_dir}/stats")
    assert stats.count() == ev.select("event_type").distinct().count()
    assert not os.path.exists(f"{tmp_dir}/lines")
