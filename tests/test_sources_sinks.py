"""Text sources (lines, whole files, manifest), the feeder, message sinks
and the printable outputs."""

import json
import os


from termflow.sinks import messages as M
from termflow.sinks.text import topic_lines, word_count_lines
from termflow.sources.text import (lines_of, manifest_documents, numeric_vectors, text_lines,
                                   whole_text_files)
from termflow.streaming.feeder import feed
from termflow.streaming.sources import doc_stream, read_documents_once


def _write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_text_lines_match_lines_of(spark, tmp_dir):
    raw = "alpha beta\r\ngamma\rdelta\n\nlast line\n"
    _write(f"{tmp_dir}/a.txt", raw.encode())
    from_file = [r.value for r in text_lines(spark, f"{tmp_dir}/a.txt").collect()]
    df = spark.createDataFrame([(raw,)], "text string")
    from_col = [r.value for r in lines_of(df).orderBy("line_no").collect()]
    assert from_file == from_col == ["alpha beta", "gamma", "delta", "", "last line"]


def test_whole_text_files(spark, tmp_dir):
    _write(f"{tmp_dir}/d/one.txt", b"first doc\nline two\n")
    _write(f"{tmp_dir}/d/two.txt", b"second")
    got = {os.path.basename(r.doc_name): r.content
           for r in whole_text_files(spark, f"{tmp_dir}/d/*.txt").collect()}
    assert got == {"one.txt": "first doc\nline two\n", "two.txt": "second"}


def test_manifest_and_feeder(spark, tmp_dir):
    a, b = f"{tmp_dir}/docs/a.txt", f"{tmp_dir}/docs/b.txt"
    _write(a, b"Hello world\r\nsecond line\n")
    _write(b, b"only line")
    _write(f"{tmp_dir}/manifest.txt", f"{a}\n{b}\n".encode())
    docs = {r.doc_name: r.content for r in manifest_documents(spark, f"{tmp_dir}/manifest.txt").collect()}
    assert docs == {a: "Hello world second line ", b: "only line "}
    _write(f"{tmp_dir}/docs/not_listed.txt", b"other")
    rooted = manifest_documents(spark, f"{tmp_dir}/manifest.txt", root=f"{tmp_dir}/docs")
    assert {r.doc_name: r.content for r in rooted.collect()} == docs
    n = feed(spark, f"{tmp_dir}/manifest.txt", fmt="json", path=f"{tmp_dir}/out")
    assert n == 2
    back = spark.read.json(f"{tmp_dir}/out/topic=docs")
    assert {r.key: r.value for r in back.collect()} == docs


def test_read_documents_once_and_stream_schema(spark, tmp_dir):
    _write(f"{tmp_dir}/in/x.json", (json.dumps({"doc_name": "n", "content": "c"}) + "\n").encode())
    once = read_documents_once(spark, "json", path=f"{tmp_dir}/in")
    assert [tuple(r) for r in once.collect()] == [("n", "c")]
    s = doc_stream(spark, "json", path=f"{tmp_dir}/in")
    assert s.isStreaming and s.columns == ["doc_name", "content"]


def test_numeric_vectors_source(spark, tmp_dir):
    _write(f"{tmp_dir}/m.txt", b"1 2 6 0\n 3 1 1 0 \n")
    lines = text_lines(spark, f"{tmp_dir}/m.txt")
    got = [r.values for r in numeric_vectors(lines).collect()]
    assert got == [[1.0, 2.0, 6.0, 0.0], [3.0, 1.0, 1.0, 0.0]]


def test_per_topic_fan_out(spark, tmp_dir):
    msgs = spark.createDataFrame([("tcdata", '{"a": 1.0}'), ("tcmeta", "New doc received: x"),
                                  ("tcdata", "[1, 2]")], "topic string, value string")
    M.write_messages(msgs, "json", path=f"{tmp_dir}/bus", batch_id=3)
    assert os.path.isdir(f"{tmp_dir}/bus/topic=tcdata/batch_id=3")
    parts = M.fan_out(spark.read.json(f"{tmp_dir}/bus"), ["tcdata", "tcmeta"])
    assert parts["tcdata"].count() == 2 and parts["tcmeta"].count() == 1


def test_printable_lines(spark):
    wc = spark.createDataFrame([("word", 3)], "word string, cnt long")
    assert word_count_lines(wc).first().value == "word: 3"
    d = spark.createDataFrame([(0, 0, 12, "term", 0.0123456789)],
                              "topic int, rank int, term_idx int, term string, weight double")
    assert topic_lines(d).first().value == "12: term : 0.012346"


def test_kafka_options():
    o = M.kafka_options("h:9092", subscribe_pattern="(?i)docs")
    assert o["subscribePattern"] == "(?i)docs" and o["startingOffsets"] == "earliest"
    assert o["failOnDataLoss"] == "false"
