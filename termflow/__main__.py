"""Command-line entry points (``python -m termflow <command> ...`` or
``spark-submit termflow/__main__.py <command> ...``).

    word-count     text lines → ``word: count`` lines
    lda-numeric    lines of counts → LDA (k=3) topic matrix
    lda-text       text (one document per line or per file) → topics, top scores
    feed           manifest of files → document messages
    corpus-stream  document stream → notices, corpus table, refit, score messages
    price-stream   price messages → statistics, delta, position lines

Each command uses the active session (or builds one), so cluster settings
come from ``spark-submit``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession, functions as F

from termflow.functions.constants import DOC_TOPIC, POSITION_THRESHOLD, PRICE_TOPIC


def _session() -> SparkSession:
    return SparkSession.builder.appName("termflow").getOrCreate()


def _out(df, args) -> None:
    if getattr(args, "output", None):
        df.write.mode("overwrite").format(args.output_format).save(args.output)
    else:
        df.show(args.show, truncate=False)


def cmd_word_count(args) -> None:
    from termflow.operators.tokens import word_count_raw
    from termflow.sinks.text import word_count_lines
    from termflow.sources.text import text_lines

    spark = _session()
    _out(word_count_lines(word_count_raw(text_lines(spark, args.input))), args)


def cmd_lda_numeric(args) -> None:
    from termflow.operators.topics import (fit_numeric_topics, load_model, save_model,
                                           topics_matrix)
    from termflow.sources.text import numeric_vectors, text_lines

    spark = _session()
    vec = numeric_vectors(text_lines(spark, args.input), strict=True)
    model = fit_numeric_topics(vec, k=args.k, optimizer=args.optimizer,
                               max_iter=args.max_iter, seed=args.seed)
    if args.model_path:
        save_model(model, args.model_path)
        model = load_model(args.model_path)
    _out(topics_matrix(model, spark).orderBy("topic", "term_idx"), args)


def cmd_lda_text(args) -> None:
    from termflow.operators.scores import score_message
    from termflow.operators.topics import describe_topics, fit_text_topics
    from termflow.plans.topics import topic_scores
    from termflow.sinks.text import topic_lines
    from termflow.sources.text import text_lines, whole_text_files

    spark = _session()
    if args.unit == "file":
        docs = whole_text_files(spark, args.input).select(F.col("content").alias("text"))
    else:
        docs = text_lines(spark, args.input).select(F.col("value").alias("text"))
    fit = fit_text_topics(docs, id_col=None, k=args.k, optimizer=args.optimizer,
                          max_iter=args.max_iter, seed=args.seed, normalize=False)
    described = describe_topics(fit)
    topic_lines(described).orderBy("topic", "rank").select("topic", "value").show(
        args.k * 10, truncate=False)
    _out(score_message(topic_scores(described)), args)


def cmd_feed(args) -> None:
    from termflow.streaming.feeder import feed

    n = feed(_session(), args.manifest, fmt=args.format, topic=args.topic,
             options={"kafka.bootstrap.servers": args.bootstrap} if args.format == "kafka"
             else None, path=args.path)
    print(f"sent {n} documents")


def _trigger(args) -> dict:
    return {"availableNow": True} if args.available_now else {
        "processingTime": f"{args.trigger_seconds} seconds"}


def cmd_corpus_stream(args) -> None:
    from termflow.streaming import corpus
    from termflow.streaming.sources import doc_stream

    spark = _session()
    src = doc_stream(spark, args.source, path=args.path, bootstrap=args.bootstrap)
    job = corpus.CorpusJob(corpus_path=args.corpus, sink_path=args.sink_path,
                           sink_format=args.sink_format,
                           sink_options={"kafka.bootstrap.servers": args.bootstrap}
                           if args.sink_format == "kafka" else {},
                           scope=args.scope, optimizer=args.optimizer, k=args.k,
                           max_iter=args.max_iter, seed=args.seed,
                           min_new_docs=args.min_new_docs)
    corpus.start(src, job, args.checkpoint, _trigger(args)).awaitTermination()


def cmd_price_stream(args) -> None:
    from termflow.streaming import prices

    spark = _session()
    src = prices.price_stream(spark, args.source, path=args.path, topic=args.topic,
                              bootstrap=args.bootstrap)
    job = prices.PriceJob(stats_path=args.stats, state_path=args.state,
                          output_path=args.output_path, threshold=args.threshold)
    prices.start(src, job, args.checkpoint, _trigger(args)).awaitTermination()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="termflow")
    sub = p.add_subparsers(dest="command", required=True)

    def out_args(sp):
        sp.add_argument("--output", help="write the result here instead of showing it")
        sp.add_argument("--output-format", default="json")
        sp.add_argument("--show", type=int, default=50)

    def lda_args(sp, k, optimizer):
        sp.add_argument("--k", type=int, default=k)
        sp.add_argument("--optimizer", default=optimizer, choices=["em", "online"])
        sp.add_argument("--max-iter", type=int, default=20)
        sp.add_argument("--seed", type=int, default=42)

    sp = sub.add_parser("word-count")
    sp.add_argument("input")
    out_args(sp)
    sp.set_defaults(fn=cmd_word_count)

    sp = sub.add_parser("lda-numeric")
    sp.add_argument("input")
    sp.add_argument("--model-path", help="save the model here and load it back")
    lda_args(sp, 3, "em")
    out_args(sp)
    sp.set_defaults(fn=cmd_lda_numeric)

    sp = sub.add_parser("lda-text")
    sp.add_argument("input")
    sp.add_argument("--unit", choices=["line", "file"], default="line")
    lda_args(sp, 10, "em")
    out_args(sp)
    sp.set_defaults(fn=cmd_lda_text)

    sp = sub.add_parser("feed")
    sp.add_argument("manifest")
    sp.add_argument("--format", default="kafka")
    sp.add_argument("--topic", default=DOC_TOPIC)
    sp.add_argument("--bootstrap", default="localhost:9092")
    sp.add_argument("--path", help="output folder for file formats")
    sp.set_defaults(fn=cmd_feed)

    def stream_args(sp):
        sp.add_argument("--source", default="kafka")
        sp.add_argument("--path", help="input folder for file sources")
        sp.add_argument("--bootstrap", default="localhost:9092")
        sp.add_argument("--checkpoint")
        sp.add_argument("--trigger-seconds", type=int, default=5)
        sp.add_argument("--available-now", action="store_true")

    sp = sub.add_parser("corpus-stream")
    stream_args(sp)
    sp.add_argument("--corpus", required=True)
    sp.add_argument("--sink-format", default="kafka")
    sp.add_argument("--sink-path")
    sp.add_argument("--scope", choices=["all", "batch"], default="all")
    sp.add_argument("--min-new-docs", type=int, default=1,
                    help="refit only after this many new documents")
    lda_args(sp, 10, "em")
    sp.set_defaults(fn=cmd_corpus_stream)

    sp = sub.add_parser("price-stream")
    stream_args(sp)
    sp.add_argument("--topic", default=PRICE_TOPIC)
    sp.add_argument("--stats", required=True)
    sp.add_argument("--state", required=True)
    sp.add_argument("--output-path", required=True)
    sp.add_argument("--threshold", type=float, default=POSITION_THRESHOLD)
    sp.set_defaults(fn=cmd_price_stream)
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main(sys.argv[1:])
