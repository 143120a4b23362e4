"""Column expressions for the corpus text rules.

Every function returns a plain Spark ``Column`` built from SQL built-ins, so
it stays inside whole-stage code generation; no Python runs per row.

The rules copy Java string semantics, because the documents of the original
pipeline were cut and filtered with ``String.split``, ``String.trim`` and
``Character.isLetter``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from termflow.functions.constants import (DISPLAY_BASE, DISPLAY_SCALE,
                                          MIN_TERM_LENGTH, NOTICE_FORMAT)

# A token is a term when every UTF-16 unit is a letter. Supplementary code
# points (U+10000 and up) are surrogate pairs in Java, and a lone surrogate
# is not a letter, so they are taken out of the letter class.
_LETTERS_ONLY = r"\A[\p{L}&&[^\x{10000}-\x{10FFFF}]]+\z"
# The same rule applied inside a whole text: a run of such letters with a
# space or an end of text on both sides, length > MIN_TERM_LENGTH.
_TERM_IN_TEXT = (r"(?<![^ ])[\p{L}&&[^\x{10000}-\x{10FFFF}]]{%d,}(?![^ ])"
                 % (MIN_TERM_LENGTH + 1))
# Line terminators of a Java / Hadoop line reader.
_LINE_BREAK = r"\r\n|\r|\n"
_FINAL_LINE_BREAK = r"(\r\n|\r|\n)\z"
# Java trim() strips every char up to U+0020; a text is blank when nothing
# else is left.
_NOT_BLANK = r"[^\x00-\x20]"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split_space(s: str | Column) -> Column:
    """``s.split(" ")`` with Java rules: only U+0020 cuts, empty tokens
    between two spaces are kept, trailing empties are dropped, ``""`` gives
    ``[""]`` and a string of only spaces gives ``[]``."""
    s = _col(s)
    trimmed = F.rtrim(s)  # Spark's rtrim removes U+0020 only
    return (F.when(s == F.lit(""), F.array(F.lit("")))
            .when(trimmed == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, " ")))


def is_term(token: Column) -> Column:
    """Token filter: longer than three chars and letters only."""
    return (F.length(token) > MIN_TERM_LENGTH) & token.rlike(_LETTERS_ONLY)


def terms_of(text: str | Column) -> Column:
    """Lower-case, split on single spaces, keep the term tokens: the
    ``ARRAY<STRING>`` of one document's terms, in order, with repeats.

    Computed in one regex pass per document rather than split + a regex per
    token: a term is a maximal run between spaces (or the ends) made only of
    BMP letters, at least 4 long, which is what ``_TERM_IN_TEXT`` matches.
    :func:`is_term` over :func:`java_split_space` gives the same arrays
    (the property tests check both against a model of the Java rules).
    """
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(_TERM_IN_TEXT), 0)


def normalize_lines(text: str | Column) -> Column:
    """Contents as the file feeder sent them: each line followed by one
    space. A final terminator adds no empty line; an empty text stays empty.
    """
    t = _col(text)
    body = F.regexp_replace(F.regexp_replace(t, _FINAL_LINE_BREAK, ""), _LINE_BREAK, " ")
    return F.when(t == F.lit(""), F.lit("")).otherwise(F.concat(body, F.lit(" ")))


def split_lines(text: str | Column) -> Column:
    """Lines of a text as a line reader returns them (``\\n``, ``\\r`` or
    ``\\r\\n`` end a line; a final terminator adds no empty line; an empty
    text has no lines)."""
    t = _col(text)
    return (F.when(t == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(F.regexp_replace(t, _FINAL_LINE_BREAK, ""), _LINE_BREAK, -1)))


def is_not_blank(text: str | Column) -> Column:
    """``text != null && !text.trim().isEmpty()`` in Java terms."""
    t = _col(text)
    return t.isNotNull() & t.rlike(_NOT_BLANK)


def java_trim(text: str | Column) -> Column:
    """Java ``trim()``: strips every leading/trailing char <= U+0020."""
    return F.regexp_replace(_col(text), r"\A[\x00-\x20]+|[\x00-\x20]+\z", "")


def parse_doubles(text: str | Column, strict: bool = True) -> Column:
    """A line of space-separated numbers as ``ARRAY<DOUBLE>`` (Java
    ``trim().split(" ")`` then ``Double.parseDouble`` on each part).

    ``strict`` keeps the failure of a bad number (the ANSI cast raises);
    otherwise a bad number becomes NULL.
    """
    parts = F.split(java_trim(text), " ")
    if strict:
        return F.transform(parts, lambda x: x.cast("double"))
    return F.transform(parts, lambda x: x.try_cast("double"))


def notice(name: str | Column) -> Column:
    """Arrival notice text for a named document."""
    return F.format_string(NOTICE_FORMAT, _col(name))


def display_size(score: str | Column) -> Column:
    """Word size in the cloud: ``10 + weight * 1000`` truncated toward 0."""
    return (F.lit(DISPLAY_BASE) + _col(score) * F.lit(DISPLAY_SCALE)).cast("int")
