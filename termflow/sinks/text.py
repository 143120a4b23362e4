"""Printable text forms of results (one ``value`` line per row), for a
console sink, ``show()`` or a text file."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from termflow.functions.constants import TOPIC_TERM_FORMAT, WORD_COUNT_FORMAT


def word_count_lines(counts: DataFrame, word_col: str = "word") -> DataFrame:
    """``word: count`` lines."""
    return counts.select(
        F.format_string(WORD_COUNT_FORMAT, F.col(word_col), F.col("cnt")).alias("value"))


def topic_lines(described: DataFrame) -> DataFrame:
    """``index: term : weight`` lines per topic, heaviest first, with the
    topic and rank kept for ordering."""
    return described.select(
        "topic", "rank",
        F.format_string(TOPIC_TERM_FORMAT, F.col("term_idx"), F.col("term"), F.col("weight"))
        .alias("value"))
