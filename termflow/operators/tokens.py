"""Tokenising and counting.

    documents --normalise--> content --terms_of--> ARRAY<STRING> --explode--> (doc, term)
                                                       |
                                           groupBy(term).count()  (partial + final aggregate)

Everything is Spark SQL: one regex extraction per document, explode, hash
aggregate. A hot term (say one third of all tokens) costs nothing extra: the
partial aggregate folds it to one row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from termflow.functions.text import java_split_space, normalize_lines, terms_of


def doc_terms(docs: DataFrame, text_col: str = "text", id_col: str | None = "doc_id",
              normalize: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``[id_col,] *keep, terms ARRAY<STRING>``.

    ``normalize`` first joins the lines of a text with spaces, as the file
    feeder did before a document entered the stream; without it a token that
    spans a line break is not a term.
    """
    text = normalize_lines(text_col) if normalize else F.col(text_col)
    ids = [id_col] if id_col else []
    return docs.select(*ids, *keep, terms_of(text).alias("terms"))


def explode_items(df: DataFrame, array_col: str, name: str, keep: list[str] | tuple = (),
                  with_pos: str | None = None) -> DataFrame:
    """One row per array element (empty and NULL arrays give no row).

    Written as ``explode_outer`` + ``IS NOT NULL`` on purpose: for a plain
    ``explode`` Catalyst infers ``size(array) > 0`` and pushes that filter
    down to the scan, which evaluates the whole tokenising expression a
    second time (and, below a repartition, in the scan's few tasks).
    Elements are never NULL here (split or regex-extract results), so the
    rows are the same.
    """
    if with_pos:
        gen = F.posexplode_outer(array_col).alias(with_pos, name)
    else:
        gen = F.explode_outer(array_col).alias(name)
    return df.select(*keep, gen).filter(F.col(name).isNotNull())


def term_tokens(docs: DataFrame, text_col: str = "text", id_col: str | None = "doc_id",
                normalize: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per term occurrence: ``[id_col,] *keep, term``."""
    ids = [id_col] if id_col else []
    return explode_items(doc_terms(docs, text_col, id_col, normalize, keep), "terms", "term",
                         [*ids, *keep])


def term_counts(docs: DataFrame, text_col: str = "text", normalize: bool = True) -> DataFrame:
    """Corpus frequency of every term: ``term, cnt``."""
    return (term_tokens(docs, text_col, None, normalize)
            .groupBy("term").agg(F.count(F.lit(1)).alias("cnt")))


def word_count_raw(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Raw word count of lines: split on single spaces with Java rules,
    count every token (the empty one too), no case folding, no filter:
    ``word, cnt``."""
    words = explode_items(lines.select(java_split_space(value_col).alias("words")), "words", "word")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
