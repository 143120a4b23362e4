"""Java string rules as Spark expressions, on hand-made edge tables."""

import pytest
from pyspark.sql import functions as F

from termflow.functions import text as T


def _java_split(s: str) -> list[str]:
    """String.split(" ") of Java: trailing empty strings removed; a string
    without any space is returned whole."""
    if " " not in s:
        return [s]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _java_is_letter_token(t: str) -> bool:
    # Character.isLetter on each UTF-16 unit: supplementary chars are surrogates.
    return len(t.encode("utf-16-le")) // 2 > 3 and all(
        ord(c) < 0x10000 and c.isalpha() for c in t)


def _eval(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("s"))).collect()]


def test_split_edges(spark):
    cases = ["", "  ", "a b  ", " a", "a  b", "a", "a b c"]
    got = _eval(spark, cases, T.java_split_space)
    assert got == [_java_split(c) for c in cases]


def test_token_filter_edges(spark):
    cases = ["café", "ab1cd", "a\nbcd", "abcd\n", "\U0001D400\U0001D401\U0001D402\U0001D403",
             "the", "word", "Ærøskøbing", "naïve"]
    got = _eval(spark, cases, T.is_term)
    assert got == [_java_is_letter_token(c) for c in cases]
    assert got[:5] == [True, False, False, False, False]


def test_terms_of_lowercases_and_filters(spark):
    got = _eval(spark, ["The Quick  brown fox JUMPS over-the lazy dog "], T.terms_of)
    assert got == [["quick", "brown", "jumps", "lazy"]]


def test_blank_edges(spark):
    cases = [None, "", " \t\n", " ", " x "]
    got = _eval(spark, cases, T.is_not_blank)
    assert got == [False, False, False, True, True]


@pytest.mark.parametrize("text,lines,normal", [
    ("", [], ""),
    ("\n", [""], " "),
    ("a\n", ["a"], "a "),
    ("a\n\n", ["a", ""], "a  "),
    ("a\r\nb", ["a", "b"], "a b "),
    ("a\rb\n", ["a", "b"], "a b "),
])
def test_newline_edges(spark, text, lines, normal):
    assert _eval(spark, [text], T.split_lines) == [lines]
    assert _eval(spark, [text], T.normalize_lines) == [normal]


def test_parse_doubles(spark):
    assert _eval(spark, [" 1 2 6.5 0 "], T.parse_doubles) == [[1.0, 2.0, 6.5, 0.0]]
    assert _eval(spark, ["1 x 3"], lambda c: T.parse_doubles(c, strict=False)) == [[1.0, None, 3.0]]
    with pytest.raises(Exception):
        _eval(spark, ["1 x 3"], T.parse_doubles)


def test_notice_and_display(spark):
    assert _eval(spark, ["data/a.txt"], T.notice) == ["New doc received: data/a.txt"]
    df = spark.createDataFrame([(0.0123,), (-0.0119,), (0.5,)], "w double")
    assert [r[0] for r in df.select(T.display_size("w")).collect()] == [22, -1, 510]
