"""The label scoring chain against a brute-force Python computation on
random corpora with a hot label and a hot term."""

from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st

from termflow.operators import scores as sc
from termflow.operators.tokens import term_tokens

WORDS = ["alpha", "bravo", "charlie", "delta", "echo", "foxtrot", "golf", "hotel",
         "india", "juliet", "kilo", "lima", "mike", "november", "oscar", "papa"]
LABELS = ["la", "lb", "lc"]

DOC = st.tuples(
    st.sampled_from(LABELS + ["la"] * 4),  # label "la" is hot
    st.lists(st.sampled_from(WORDS + ["alpha"] * 8), min_size=1, max_size=15))  # "alpha" is hot
CORPUS = st.lists(DOC, min_size=3, max_size=40)


def brute(corpus, k=10, n=10):
    tf = {}
    for label, words in corpus:
        tf.setdefault(label, Counter()).update(words)
    described = []
    for label, c in tf.items():
        total = sum(c.values())
        ranked = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:k]
        described += [(label, w, cnt / total) for w, cnt in ranked]
    merged = {}
    for label, w, weight in sorted(described):  # ascending topic: the last topic wins
        merged[w] = weight
    return sorted(merged.items(), key=lambda kv: (-kv[1], kv[0]))[:n]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(CORPUS)
def test_scoring_chain(spark, corpus):
    rows = [(i, label, " ".join(words)) for i, (label, words) in enumerate(corpus)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    top = sc.top_label_terms(term_tokens(docs, keep=("lang",)), "lang")
    got = [(r.term, r.score) for r in sc.top_scores(sc.merge_scores(top, "last")).collect()]
    assert got == brute(corpus)
