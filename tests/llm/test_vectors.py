import math

import duckdb
import numpy as np
import pytest

from termflow.llm import ann, topk

SF = "/root/testdata/sf0.01"


def rows_of(df):
    return {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in df.collect()}


def test_exact_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = {(q, r): (v, s) for q, r, v, s in con.execute(
        f"SELECT query_id, rank, vec_id, score FROM ({topk.ORACLE_SQL})").fetchall()}
    assert rows_of(topk.op6_exact_top_k(spark, SF)) == want


def brute(ids, vectors, score, k=5):
    out = {}
    for q, v in zip(ids, vectors):
        if q % 50 == 0:
            best = {}
            for i, w in zip(ids, vectors):
                if i != q and len(w) == len(v):
                    best[i] = max(best.get(i, -math.inf), score(v, w))
            for r, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1):
                out[q, r] = (i, s)
    return out


@pytest.mark.parametrize("seed, copies", [(0, 0), (1, 40), (2, 150)])
def test_bit_slices_on_ties_signs_and_many_shards(spark, seed, copies):
    rng = np.random.default_rng(seed)
    v = np.round(rng.normal(size=(200, 7)) * rng.choice([0, .01, 1, 30], size=(200, 7)), 2)
    v[:copies] = v[0]
    table = spark.createDataFrame([(i * 5, x.tolist(), "s", 0) for i, x in enumerate(v)],
                                  "vec_id long, embedding array<double>, score string, shard int")
    got = rows_of(topk.exact_top_k(table, table.where("vec_id % 50 = 0"), shard_rows=60))
    ints = np.floor(256 * v).astype(int)
    assert got == brute([i * 5 for i in range(200)], ints.tolist(), lambda a, b: sum(x * y for x, y in zip(a, b)))


ODD = [(0, [1.0, 2.0]), (50, [1.0, 2.0]), (1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 1.0]),
       (5, [float("inf"), 1.0]), (6, [0.0, 0.0]), (7, [3.0, 1.0]), (7, [3.0, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 2.0]),
       (9, [-1.0, -2.0]), (100, None), (150, [1.0])]


def test_odd_rows(spark):
    table = spark.createDataFrame(ODD, "vec_id long, embedding array<double>")
    asked = table.where("vec_id % 50 = 0")
    exact = rows_of(topk.exact_top_k(table, asked))
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in ODD if i is not None and v and all(
        x is not None and math.isfinite(x) for x in v)]
    assert exact == brute(*zip(*ok), lambda a, b: sum(x * y for x, y in zip(a, b)))
    near = rows_of(ann.nearest(table, asked))
    ok = [(i, v) for i, v in ODD if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    want = brute(*zip(*ok), lambda a, b: np.dot(a, b) / math.sqrt(np.dot(a, a) * np.dot(b, b)))
    assert {k: v[0] for k, v in near.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(near[k][1] - want[k][1]) < 1e-12 for k in want)
    for f in (topk.exact_top_k, ann.nearest):
        assert f(table.limit(0), asked).collect() == [] and f(table, asked.limit(0)).collect() == []


@pytest.mark.parametrize("operator", [ann.nearest, topk.exact_top_k])
def test_query_blocks_copied_to_every_shard_are_not_broadcast(spark, operator):
    rng = np.random.default_rng(3)
    vectors = [(i, v) for i, v in enumerate(rng.normal(size=(240, 4)).tolist())]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(2).localCheckpoint()
    found = operator(table, table.where("vec_id % 2 = 0"), shard_rows=8)
    assert len(found.collect()) == 120 * 5
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_large_components(spark):
    rows = [(0, [1.5, 0.0]), (1, [2.0**17, 1e300]), (2, [2.0**40, -1e300]), (3, [-2.0**44, 5.0]), (4, [1.0, 1.0]), (5, [2.0**17, 7.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = [[int(256 * x) if x < 1e200 else int(x) * 256 for x in v] for _, v in rows]
    got = rows_of(topk.exact_top_k(table, table.where("vec_id = 0")))
    assert got == brute(range(6), ints, lambda a, b: sum(x * y for x, y in zip(a, b)))
    with pytest.raises(OverflowError):
        list(topk.find(topk.build(np.arange(2), np.full((2, 1), 2.0**40)), np.array([9]), np.full((1, 1), 2.0**40)))


def cosine_hits(ids, v, k=5):
    u = v / np.linalg.norm(v, axis=1)[:, None]
    out = {}
    for n in np.flatnonzero(ids % 50 == 0):
        s = np.where(ids == ids[n], -9, u @ u[n])
        out[ids[n]] = ids[np.lexsort((ids, -s))[:k]].tolist()
    return out


def test_recall(spark):
    t = spark.read.parquet(f"/root/testdata/sf0.1/embeddings.parquet").toPandas()
    want = cosine_hits(t.vec_id.to_numpy(), np.stack(t.embedding).astype(float))
    got = ann.op5_nearest_neighbours(spark, "/root/testdata/sf0.1").toPandas()
    found = sum(len(set(want[q]) & set(g.vec_id)) for q, g in got.groupby("query_id"))
    assert found / (5 * len(want)) >= 0.95
    vectors = dict(zip(t.vec_id, t.embedding))
    for r in got.head(40).itertuples():
        a, b = (np.asarray(vectors[x], float) for x in (r.query_id, r.vec_id))
        assert abs(r.score - a @ b / math.sqrt((a @ a) * (b @ b))) < 1e-12
    assert (got.groupby("query_id")["rank"].apply(list).map(lambda x: x == [1, 2, 3, 4, 5])).all()


def test_recall_with_a_large_group_of_copies_and_small_shards(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(900, 16))
    v[rng.choice(900, 300, replace=False)] = v[11]
    ids = np.arange(900)
    table = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)], "vec_id long, embedding array<double>")
    want = cosine_hits(ids, v)
    got = ann.nearest(table, table.where("vec_id % 50 = 0"), shard_rows=200).toPandas()
    scores = {q: g.score.tolist() for q, g in got.groupby("query_id")}
    found = sum(len(set(want[q]) & set(g.vec_id)) for q, g in got.groupby("query_id"))
    assert found / (5 * len(want)) >= 0.95 and all(len(s) == 5 and s == sorted(s, reverse=True) for s in scores.values())


def crowded(kind, n=4096, dim=64):
    """Vectors of which a third are near or scaled copies of one, and which ones."""
    rng = np.random.default_rng(1)
    v = rng.normal(size=(n, dim))
    copies = rng.choice(n, n // 3, replace=False)
    v[copies] = v[copies[0]]
    if kind == "scaled":
        v[copies] *= rng.uniform(.1, 10, size=(len(copies), 1))
    else:
        v[copies] += kind * rng.normal(size=(len(copies), dim))
    return v, np.isin(np.arange(n), copies)


@pytest.mark.parametrize("kind", [.01, .1, .3, .8, "scaled"])
def test_recall_beside_a_crowd_in_a_full_shard(kind):
    v, copies = crowded(kind)
    ids = np.arange(len(v))
    asked = ids[::20]
    hits = {}
    for found in ann.find(ann.build(ids, v), asked, v[asked], 5, ann.Settings().query_beam):
        for q, i, score in zip(*found):
            if i != q:
                hits.setdefault(int(q), {})[int(i)] = score
    u = ann.unit(v)
    recall = []
    for q in asked.tolist():
        best = np.sort(np.delete(u @ u[q], q))[::-1][:5]
        got = np.sort(list(hits[q].values()))[::-1][:5]
        recall.append((got >= best[-1] - 1e-12).sum() / 5)
    recall = np.array(recall)
    assert recall.mean() >= 0.95 and recall[~copies[asked]].mean() >= 0.95


def test_pruning_keeps_diverse_edges():
    nodes = ann.unit(np.array([[1, 0], [1, .01], [1, .02], [0, 1], [1, -.3]])).astype(np.float32)
    kept = ann.robust_prune(nodes, np.array([0]), np.array([[0, 1, 2, 3, 4, -1]]), 4, 1.2)
    assert kept[0].tolist()[:1] == [1] and 2 not in kept[0] and 4 in kept[0]


def test_one_id_with_many_near_vectors_leaves_room_for_others():
    rng = np.random.default_rng(3)
    for own in (30, 300):
        base = rng.normal(size=16)
        v = np.concatenate([base + 0.001 * rng.normal(size=(own, 16)), rng.normal(size=(20, 16))])
        ids = np.array([1] * own + list(range(2, 22)))
        got = list(ann.find(ann.build(ids, v), np.array([0]), base[None], 5, 96))
        near = {}
        for i, w in zip(ids.tolist(), v):
            near[i] = max(near.get(i, -2), float(ann.cosines(base, w[None])[0]))
        want = sorted(near, key=lambda i: (-near[i], i))[:5]
        assert np.concatenate([g[1] for g in got]).tolist() == want


@pytest.mark.parametrize("dim, clusters, mean", [(64, 0, 0), (256, 0, 0), (768, 0, 0), (64, 40, 0), (768, 40, 0), (256, 0, 2)])
def test_recall_by_dimension(dim, clusters, mean):
    rng = np.random.default_rng(dim + clusters)
    v = rng.normal(size=(2000, dim)) + mean
    if clusters:
        v = rng.normal(size=(clusters, dim))[rng.integers(0, clusters, 2000)] + 0.5 * v
    q = v[::50]
    s = ann.Settings()
    u = ann.unit(v)
    found = dict()
    for who, vec, _ in ann.find(ann.build(np.arange(2000), v), np.arange(0, 2000, 50), q, 5, s.beam_for(dim)):
        for a, b in zip(who.tolist(), vec.tolist()):
            found.setdefault(a, set()).add(b)
    hit = 0
    for a in range(0, 2000, 50):
        cos = u @ u[a]
        cos[a] = -2
        hit += len(set(np.argsort(-cos)[:5].tolist()) & found[a])
    assert hit / (5 * len(q)) >= 0.9
