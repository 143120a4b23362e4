"""Score merge, top scores, JSON in/out, display words on a fixed topic table."""

from termflow.operators import scores as sc

TOPICS = [(0, "alpha", 0.5), (0, "beta", 0.3), (1, "alpha", 0.2), (1, "gamma", 0.4),
          (2, "beta", 0.1), (2, "delta", 0.05)]


def _described(spark):
    return spark.createDataFrame(TOPICS, "topic int, term string, weight double")


def test_merge_last_topic_wins(spark):
    got = dict(sc.merge_scores(_described(spark), "last").collect())
    assert got == {"alpha": 0.2, "beta": 0.1, "gamma": 0.4, "delta": 0.05}


def test_merge_max(spark):
    got = dict(sc.merge_scores(_described(spark), "max").collect())
    assert got == {"alpha": 0.5, "beta": 0.3, "gamma": 0.4, "delta": 0.05}


def test_top_scores_ties_and_limit(spark):
    rows = [(0, f"t{i:02d}", 0.1) for i in range(15)]
    df = spark.createDataFrame(rows, "topic int, term string, weight double")
    top = sc.top_scores(sc.merge_scores(df), 10).collect()
    assert [r.term for r in top] == [f"t{i:02d}" for i in range(10)]


def test_score_message_roundtrip(spark):
    scores = sc.merge_scores(_described(spark), "max")
    msg = sc.score_message(scores)
    back = sc.read_score_messages(msg).collect()[0]
    assert back.scores == {"alpha": 0.5, "beta": 0.3, "gamma": 0.4, "delta": 0.05}


def test_bad_messages_keep_raw(spark):
    df = spark.createDataFrame([('["a","b"]',), ("hello",), ("{}",), ('{"x": 1.5}',)], "value string")
    got = [(r.raw, r.scores) for r in sc.read_score_messages(df).collect()]
    assert got[0] == ('["a","b"]', None)
    assert got[1] == ("hello", None)
    assert got[2] == ("{}", {})
    assert got[3] == ('{"x": 1.5}', {"x": 1.5})


def test_display_words_order(spark):
    scores = spark.createDataFrame([("a", 0.01), ("b", 0.02), ("c", 0.0199)], "term string, score double")
    got = [(r.text, r.size) for r in sc.display_words(scores).collect()]
    assert got == [("b", 30), ("c", 29), ("a", 20)]


def test_top_terms_per_topic(spark):
    rows = [(t, f"w{i}", float(i)) for t in range(3) for i in range(30)]
    df = spark.createDataFrame(rows, "topic int, term string, weight double")
    got = sc.top_terms(df, 10).collect()
    assert len(got) == 30
    for r in got:
        assert r.term == f"w{29 - r.rank}"


def test_only_whole_objects_of_numbers_are_scores(spark):
    good = ['{}', ' {"a": 1} ', '{"a":-1.5e3,"b":0}', '{"q\\"u":1}']
    bad = ['{"a":1} junk', '{"a":1,"b":"x"}', '[{"a":1}]', 'a', '', '{"a":01}', '{"a":1,}', '{"a":null}', '{a:1}', None]
    df = spark.createDataFrame([(v,) for v in good + bad], "value string")
    from termflow.operators.scores import read_score_messages
    got = {r.raw: r.scores for r in read_score_messages(df).collect()}
    assert [v for v in good if got[v] is None] == [] and [v for v in bad if got[v] is not None] == []
    assert got['{"a":-1.5e3,"b":0}'] == {"a": -1500.0, "b": 0.0}
