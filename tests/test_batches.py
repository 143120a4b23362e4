"""Signed count deltas and the order index, against whole recounts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from termflow.operators.deltas import CountState, ranges, within
from termflow.operators.ranks import OrderIndex
from termflow.operators.vocab import rank_terms
from termflow.session import delete_path, path_exists


def tokens(seed, n=400):
    rng = random.Random(seed)
    return [rng.choice("abcdefgh") + rng.choice("xyz") * int(rng.expovariate(0.5)) for _ in range(n)]


def frame(spark, terms):
    return spark.createDataFrame([(t,) for t in terms], "term string")


def got(state):
    return {r.term: r.cnt for r in state.counts().collect()}


@pytest.mark.parametrize("merge_every", [0, 1, 3])
def test_counts_after_adds_replays_and_withdrawals(spark, tmp_dir, merge_every):
    state = CountState(spark, f"{tmp_dir}/c", merge_every)
    assert got(state) == {}
    batches = {b: tokens(b) for b in (0, 1, 2, 5, 7)}
    want = Counter()
    for b, terms in batches.items():
        state.add(b, frame(spark, [*terms, None]))
        want.update(terms)
        assert got(state) == want
    state.add(1, frame(spark, batches[1]))  # a replay
    assert got(state) == want
    for b in (2, 2, 0):
        state.withdraw(b)
    want = sum((Counter(t) for b, t in batches.items() if b not in (0, 2)), Counter())
    assert got(state) == want
    state.merge()
    state.add(3, frame(spark, tokens(3)))  # a number that was left out
    state.add(2, frame(spark, batches[2]))  # a replay of a withdrawn batch
    assert got(state) == want + Counter(tokens(3))


def test_unfinished_entries_and_bases_are_not_read(spark, tmp_dir):
    path = f"{tmp_dir}/c"
    state = CountState(spark, path)
    state.add(0, frame(spark, tokens(0)))
    frame(spark, tokens(1)).groupBy("term").agg(F.count("*").alias("delta")).write.parquet(f"{path}/add=1")
    delete_path(spark, f"{path}/add=1/_SUCCESS")  # stopped before its commit
    spark.createDataFrame([("a", 5)], "term string, delta long").write.parquet(f"{path}/base=1/counts")
    assert got(state) == Counter(tokens(0))
    state.add(1, frame(spark, tokens(1)))
    state.merge()
    assert got(state) == Counter(tokens(0)) + Counter(tokens(1))


def test_merges_replace_bases_and_spare_entries(spark, tmp_dir):
    state = CountState(spark, f"{tmp_dir}/c", merge_every=2)
    for b in range(6):
        state.add(b, frame(spark, tokens(b)))
    assert [path_exists(spark, f"{tmp_dir}/c/base={n}") for n in (1, 2, 3)] == [False, False, True]
    files = state.deltas().inputFiles()
    assert all("base=3" in f for f in files)  # the batches' own tables are not read again
    state.forget(3)
    with pytest.raises(KeyError):
        state.withdraw(2)
    with pytest.raises(KeyError):
        state.withdraw(99)
    state.withdraw(5)
    assert got(state) == sum((Counter(tokens(b)) for b in range(5)), Counter())


def test_ranges():
    spans = ranges([3, 1, 2, 9], [[4, 6]])
    assert spans == [[1, 6], [9, 9]] and within(5, spans) and not within(7, spans)


@pytest.mark.parametrize("letters", [1, 3])
def test_numbers_after_each_batch(spark, letters):
    words = [f"{a}{b}{'é' * c}" for a in "abz" for b in "xyZ" for c in range(12)] + ["中", "😀a", "￿b"]
    rng = random.Random(letters)
    total = Counter(rng.choices(words, k=300))
    as_rows = lambda c: spark.createDataFrame(list(c.items()), "term string, delta long")
    index = OrderIndex.of(as_rows(total).select("term", F.col("delta").alias("cnt")), letters)
    for step in range(4):
        delta = Counter(rng.choices(words, k=25))
        for w in rng.sample(sorted(total), 6):  # some leave, whole or in part
            delta[w] -= rng.choice([total[w], 1])
        index, numbers = index.changed_by(as_rows(delta))
        total = Counter({w: n for w, n in ((w, total[w] + delta[w]) for w in {*total, *delta}) if n > 0})
        whole = rank_terms(as_rows(total).select("term", F.col("delta").alias("cnt"))).df
        want = {r.term: (r.cnt, r["rank"]) for r in whole.collect()}
        changed = {w for w, d in delta.items() if d}
        assert {r.term: (r.cnt, r.number) for r in numbers.collect()} == {w: x for w, x in want.items() if w in changed}
        assert {r.term: (r.cnt, r.number) for r in index.numbers(index.terms).collect()} == want
        assert index.size() == len(total)


def test_only_cells_asked_for_are_sorted(spark):
    counts = spark.range(20_000).select(F.concat(F.lit("t"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("term"),
                                        (F.col("id") % 5 + 1).alias("cnt"))
    index = OrderIndex.of(counts, letters=5)
    asked = spark.createDataFrame([("t001234", 1234 % 5 + 1)], "term string, cnt long")
    numbers = index.numbers(asked)
    plan = numbers._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and plan.count("LeftSemi") == 2  # windows over the members of the asked cells
    want = counts.where("cnt > 5 or cnt = 5 and term < 't001234'").count()
    assert numbers.first().number == want
    empty, none = OrderIndex.of(counts.limit(0)).changed_by(spark.createDataFrame([], "term string, delta long"))
    assert empty.size() == 0 and none.count() == 0
