import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from termflow.llm.components import star_roots
from termflow.llm import jaccard
from termflow.llm.jaccard import drop_near_duplicates, near_duplicates, op2_ngram_jaccard_join, shingle_sets


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """doc_id -> (set size of each row, smallest reachable id), all pairs compared."""
    sets = [(d, shingles(t)) for d, t in rows]
    root = {d: d for d, _ in sets if d is not None}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    where = {}
    for k, (d, s) in enumerate(sets):
        near = {}
        for x in s:
            for o in where.setdefault(x, []):
                near[o] = near.get(o, 0) + 1
            where[x].append(k)
        for o, n in near.items():
            e, r = sets[o]
            if d is not None and e is not None and 100 * n >= 80 * (len(s) + len(r) - n):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in sets), key=str)


def checked(spark, rows, **more):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, class string, n int").repartition(3)
    got = near_duplicates(df, **more)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


@pytest.mark.parametrize("text", ["", " \t\n", "One", "a b c d", "a b c d e", "A b\x0bC d\x0ce F", "a b c d e a b c d e a b",
                                  "É é ÉÉ\xa0x y z w", "w " * 3000, "longword" * 40 + " x"])
def test_set_sizes(text):
    value, ends = shingle_sets(pa.array(["before that", text, "after this one"], pa.string()))
    assert ends[2] - ends[1] == len(shingles(text))
    assert ends[1] == 1 and len(value) - ends[2] == 1


def test_lower_case_and_white_space_make_no_difference():
    value, ends = shingle_sets(pa.array(["A b\tC d\ne f", "a B c  D e F\r\n"], pa.string()))
    assert value[:ends[1]].tolist() == value[ends[1]:].tolist()


def test_random_groups(spark):
    """Copies, near copies around the threshold, a shared passage, chains of links."""
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(25)]
    rows, doc = [], 0
    base = [[word() for _ in range(rng.randrange(5, 60))] for _ in range(25)]
    for text in base:
        for _ in range(rng.choice([1, 1, 2, 8])):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((doc, " ".join(copy)))
            doc += 1
    chain = [word() for _ in range(60)]
    for _ in range(8):
        rows.append((doc, " ".join(chain)))
        doc += 1
        chain = chain[4:] + [word() for _ in range(4)]
    for _ in range(15):
        rows.append((doc, " ".join([word() for _ in range(20)] + passage)))
        doc += 1
    rng.shuffle(rows)
    rows = [(d * 7 % 1009, t) for d, t in rows]
    checked(spark, rows)


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(9)
    text = [f"t{i}" for i in range(40)]
    rows = []
    for d in range(150):
        copy = list(text)
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(40)] = f"n{rng.randrange(10**6)}"
        rows.append((d, " ".join(copy)))
    rows += [(1000 + d, "the same words in every one of these") for d in range(60)]
    checked(spark, rows)


def test_what_meets_at_a_shingle_has_a_fixed_size(spark, monkeypatch):
    """No set's early shingles are sent to each bucket where it stands."""
    rng = random.Random(5)
    rows = []
    for g in range(8):
        text = [f"g{g}w{i}" for i in range(60)]
        for _ in range(6):
            copy = list(text)
            for _ in range(rng.randrange(6)):
                copy[rng.randrange(60)] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    sent = []

    def plan_of(df):
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        found = re.findall(r"\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\(([^)]*)", plan)
        sent.extend(x for x in found if "salt" in x[1])

    made = jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, name: plan_of(df) or made(df, name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        checked(spark, rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sent) == 2 and all("bits0" in columns and "early" not in columns for columns, _ in sent)


def test_edge_rows(spark):
    same = "one two three four five six seven"
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "short text"), (9, "Short  TEXT"), (5, same), (None, same), (6, same.upper()),
            (7, same), (7, "quite another text of seven words here"), (8, "quite another text of seven words here"),
            (8, "quite another text of seven words here"), (None, None)]
    checked(spark, rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).collect() == []


def test_one_document_of_each_group_stays(spark):
    rows = [(3, "a b c d e f", 1), (2, "A B C D E F", 2), (5, "other words are here in it", 3), (None, "a b c d e f", 4), (6, None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = drop_near_duplicates(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0, r.component_id) for r in got.collect()) == [(0, 4), (2, 2), (5, 3), (6, 5)]


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in op2_ngram_jaccard_join(spark, sf).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=str) == brute(rows)


def test_components_of_long_paths_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 50)] + [(7, 7), (3, 160)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    df = spark.createDataFrame([(a, b) if rng.random() < .5 else (b, a) for a, b in edges], "x long, y long")
    got = {r.node: r.root for r in star_roots(df).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
    assert star_roots(df.limit(0)).agg(F.count("*")).first()[0] == 0
