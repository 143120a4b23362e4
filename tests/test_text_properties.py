"""Property tests: the Spark expressions equal Python models of the Java
string rules on random strings over an alphabet full of edge cases."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from termflow.functions import text as T

# spaces, line breaks, a tab, NBSP (kept by trim: above U+0020), a digit,
# letters inside and outside ASCII, a supplementary letter, punctuation
ALPHABET = [" ", " ", "\n", "\r", "\t", " ", "1", "a", "B", "é", "Ж", "\U0001D400", "-", "x"]
TEXTS = st.lists(st.text(alphabet=st.sampled_from(ALPHABET), max_size=12), min_size=1, max_size=40)


def java_split(s: str) -> list[str]:
    if " " not in s:
        return [s]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def java_is_term(t: str) -> bool:
    units = len(t.encode("utf-16-le")) // 2
    return units > 3 and all(ord(c) < 0x10000 and c.isalpha() for c in t)


def java_trim(s: str) -> str:
    i, j = 0, len(s)
    while i < j and ord(s[i]) <= 0x20:
        i += 1
    while j > i and ord(s[j - 1]) <= 0x20:
        j -= 1
    return s[i:j]


def java_lines(s: str) -> list[str]:
    """BufferedReader.readLine over the whole text."""
    out, cur, i = [], [], 0
    while i < len(s):
        c = s[i]
        if c in "\r\n":
            out.append("".join(cur))
            cur = []
            if c == "\r" and i + 1 < len(s) and s[i + 1] == "\n":
                i += 1
        else:
            cur.append(c)
        i += 1
    if cur:
        out.append("".join(cur))
    return out


def _eval(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("s"))).collect()]


SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(TEXTS)
def test_split_and_terms(spark, texts):
    assert _eval(spark, texts, T.java_split_space) == [java_split(t) for t in texts]
    want = [[w for w in java_split(t.lower()) if java_is_term(w)] for t in texts]
    assert _eval(spark, texts, T.terms_of) == want


@SETTINGS
@given(TEXTS)
def test_lines_normalise_blank_trim(spark, texts):
    assert _eval(spark, texts, T.split_lines) == [java_lines(t) for t in texts]
    want_norm = ["" if t == "" else "".join(line + " " for line in java_lines(t)) for t in texts]
    assert _eval(spark, texts, T.normalize_lines) == want_norm
    assert _eval(spark, texts, T.is_not_blank) == [java_trim(t) != "" for t in texts]
    assert _eval(spark, texts, T.java_trim) == [java_trim(t) for t in texts]
