"""Approximate nearest neighbours over a robust-pruned directed graph per shard.

A shard's distinct vectors, scaled to length 1, are inserted in batches: a greedy
beam search from the medoid proposes neighbours, and robust pruning keeps the
nearest of them and drops each one that some kept neighbour is nearer to by the
factor ``alpha``, so the edges stay few and diverse. Kept neighbours get an edge
back and are pruned again when they have too many. A query runs a beam search in
every shard of its dimension; the cosines of what it finds are then computed in
double precision on the original vectors.

Every row is indexed. Equal vectors are one node, which stands for all its ids.
A crowd, more vectors close together than a node has edges, would fill its edges
and the beam with itself; so one of its vectors stands for it in the graph, and
the crowd has an index of its own, with crowds of a smaller radius in turn. A
query also searches each crowd that can hold one of its nearest by the angles to
its leader and from there to its farthest member. A crowd of about one direction
(near or scaled copies) is compared whole.

Defined results: rows whose vector is null, empty or zero, or holds a null or a
non-finite component, take no part; a query sees rows of its own dimension only,
and no row of its own id; ties go to the smaller vec_id; repeated rows of one id
are one candidate with the best of their scores; with fewer candidates than
``k`` all are found; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from termflow.llm.common import source
from termflow.llm.vectors import search, usable

K = 5
SHARD_ROWS, BLOCK_ROWS = 4096, 1024


@dataclass(frozen=True)
class Settings:
    degree: int = 32
    beam: int = 48
    alpha: float = 1.44
    batch: int = 512
    query_beam: int = 96
    same_gap: float = 1e-3

    def beam_for(self, dim: int) -> int:
        """The beam of a query: distances say less in more dimensions."""
        return max(self.query_beam, dim // 2)

    def crowd_gap(self, dim: int) -> float:
        """How near the members of the widest crowds are to their leader: nearer
        than random directions of that dimension are to each other."""
        return 1 - min(max(3.2 / dim**0.5, 0.4), 0.7)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; powers of two are taken out first, so none overflows."""
    shift = np.frexp(np.abs(vectors).max(1, initial=0))[1][:, None]
    scaled = np.ldexp(vectors, -shift)
    return scaled / np.sqrt((scaled * scaled).sum(1))[:, None]


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The cosine of one vector with each of several, in double precision."""
    def scaled(x: np.ndarray) -> np.ndarray:
        return np.ldexp(x, -np.frexp(np.abs(x).max(-1, keepdims=True))[1])
    q, v = scaled(query), scaled(vectors)
    return (v * q).sum(1) / (np.sqrt((q * q).sum()) * np.sqrt((v * v).sum(1)))


def beam_search(nodes: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int,
                visited: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For each query, in lockstep, the nodes of its beam, nearest first (-1 where
    fewer), or all nodes that the search expanded; and their similarities."""
    b, m = len(queries), len(nodes)
    rows = np.arange(b)
    ids = np.full((b, beam), -1, np.int32)
    sims = np.full((b, beam), -np.inf, np.float32)
    open_ = np.zeros((b, beam), bool)
    seen = np.zeros((b, m), bool)
    ids[:, 0], sims[:, 0], open_[:, 0] = start, queries @ nodes[start], True
    seen[:, start] = True
    expanded: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while True:
        live = rows[open_.any(1)]
        if not len(live):
            break
        at = open_[live].argmax(1)
        node = ids[live, at]
        open_[live, at] = False
        if visited:
            expanded.append((live, node, sims[live, at]))
        near = edges[node]
        fresh = (near >= 0) & ~seen[live[:, None], near]
        seen[live[:, None], np.where(fresh, near, start)] = True
        sim = np.einsum("bd,brd->br", queries[live], nodes[near], optimize=False)
        sim = np.where(fresh, sim, -np.inf)
        all_ids = np.concatenate([ids[live], np.where(fresh, near, -1)], 1)
        all_sims = np.concatenate([sims[live], sim], 1)
        all_open = np.concatenate([open_[live], fresh], 1)
        order = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
        ids[live] = np.take_along_axis(all_ids, order, 1)
        sims[live] = np.take_along_axis(all_sims, order, 1)
        open_[live] = np.take_along_axis(all_open, order, 1)
    if not visited:
        return ids, sims
    row = np.concatenate([e[0] for e in expanded])
    order = np.argsort(row, kind="stable")
    row = row[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    out = np.full((b, int(place.max()) + 1), -1, np.int32)
    out_sims = np.full(out.shape, -np.inf, np.float32)
    out[row, place] = np.concatenate([e[1] for e in expanded])[order]
    out_sims[row, place] = np.concatenate([e[2] for e in expanded])[order]
    return out, out_sims


def robust_prune(nodes: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` of each point's candidates (-1: none): the nearest that is
    left, again and again, without those that it is nearer to by ``alpha``."""
    b = len(points)
    place = nodes[candidates]
    gap = np.where(candidates < 0, np.inf, 1 - np.einsum("bd,bcd->bc", nodes[points], place, optimize=False))
    gap[candidates == points[:, None]] = np.inf
    kept = np.full((b, degree), -1, np.int32)
    rows = np.arange(b)
    for r in range(degree):
        best = gap.argmin(1)
        some = np.isfinite(gap[rows, best])
        if not some.any():
            break
        kept[some, r] = candidates[rows, best][some]
        between = 1 - np.einsum("bd,bcd->bc", place[rows, best], place, optimize=False)
        gap[alpha * between <= gap] = np.inf
        gap[candidates == candidates[rows, best][:, None]] = np.inf
    return kept


def build_graph(nodes: np.ndarray, s: Settings) -> tuple[np.ndarray, int]:
    """The edges of each node, -1 where fewer, and the node that searches start from."""
    m = len(nodes)
    start = int((nodes @ nodes.mean(0)).argmax())
    edges = np.full((m, s.degree), -1, np.int32)
    order = np.random.default_rng(0).permutation(m)
    order = order[order != start]
    at = 0
    while at < len(order):
        points = order[at:at + min(s.batch, at + 1)]
        at += len(points)
        found, _ = beam_search(nodes, edges, start, nodes[points], s.beam, visited=True)
        edges[points] = robust_prune(nodes, points, found, s.degree, s.alpha)
        # Edges back: those of a node are added together, and pruned where they don't fit.
        to = edges[points]
        back = np.repeat(points, (to >= 0).sum(1)).astype(np.int32)
        target = to[to >= 0]
        by = np.argsort(target, kind="stable")
        target, back = target[by], back[by]
        owner, first, count = np.unique(target, return_index=True, return_counts=True)
        for some in np.array_split(np.argsort(count), max(1, len(owner) // 512)):
            if not len(some):
                continue
            width = int(count[some].max())
            new = np.full((len(some), width), -1, np.int32)
            for j in range(width):
                has = count[some] > j
                new[has, j] = back[first[some][has] + j]
            pool = np.concatenate([edges[owner[some]], new], 1)
            full = (pool >= 0).sum(1) > s.degree
            edges[owner[some][full]] = robust_prune(nodes, owner[some][full], pool[full], s.degree, s.alpha)
            roomy = np.sort(pool[~full], 1)[:, ::-1][:, :s.degree]
            edges[owner[some][~full]] = roomy
    return edges, start


@dataclass(frozen=True)
class Part:
    """The index of some of a shard's vectors. ``members`` are their numbers; a part
    without edges is compared whole. A crowd is its leader, the similarity of its
    farthest member with the leader, and its part."""
    members: np.ndarray
    edges: np.ndarray | None = None
    start: int = 0
    crowds: tuple[tuple[int, float, Part], ...] = ()


def crowds_of(nodes: np.ndarray, gap: float, least: int) -> list[tuple[int, np.ndarray]]:
    """Disjoint sets of more than ``least`` nodes within ``gap`` of one of them, and
    that one first; nodes with the most others around them come first."""
    near = np.concatenate([(nodes[a:a + 512] @ nodes.T >= 1 - gap).sum(1) for a in range(0, len(nodes), 512)])
    free = np.ones(len(nodes), bool)
    found = []
    for leader in np.argsort(-near, kind="stable").tolist():
        if near[leader] <= least:
            break
        if free[leader]:
            own = np.flatnonzero(free & (nodes @ nodes[leader] >= 1 - gap))
            if len(own) > least:
                free[own] = False
                found.append((leader, own))
    return found


def build_part(nodes: np.ndarray, members: np.ndarray, gap: float, s: Settings) -> Part:
    place = nodes[members]
    alone, crowds = np.ones(len(members), bool), []
    for leader, own in crowds_of(place, gap, s.degree):
        alone[own], alone[leader] = False, True
        least = float((place[own] @ place[leader]).min())
        radius = max(0.0, 1 - least)
        part = Part(members[own]) if radius < s.same_gap else build_part(nodes, members[own], radius / 4, s)
        crowds.append((int(members[leader]), least, part))
    edges, start = build_graph(place[alone], s)
    return Part(members[alone], edges, start, tuple(crowds))


def build(ids: np.ndarray, vectors: np.ndarray, s: Settings = Settings()) -> bytes:
    """A shard's index: the graph over its distinct vectors, and the ids of each."""
    distinct, node = np.unique(vectors, axis=0, return_inverse=True)
    pairs = np.unique(np.column_stack([node.ravel(), ids]), axis=0)  # an id once for each of its vectors
    nodes = unit(distinct).astype(np.float32)
    part = build_part(nodes, np.arange(len(nodes)), s.crowd_gap(nodes.shape[1]), s)
    return pickle.dumps((distinct, nodes, part, pairs[:, 1].copy(), np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))))


class Found:
    """The nodes found for each query of a block, and a bound of its nearest."""

    def __init__(self, queries: np.ndarray, least: int):
        self.near: list[list[np.ndarray]] = [[] for _ in queries]
        self.best = np.full((len(queries), least), -np.inf, np.float32)

    def add(self, rows: np.ndarray, found: np.ndarray, sims: np.ndarray, known: np.ndarray) -> None:
        """Nodes of some of the queries (-1: none); ``known`` ones count only once."""
        for r, near in zip(rows.tolist(), found):
            self.near[r].append(near[near >= 0])
        sims = np.where(np.isin(found, known), -np.inf, sims)
        self.best[rows] = -np.sort(-np.concatenate([self.best[rows], sims], 1), axis=1)[:, :self.best.shape[1]]


def explore(part: Part, nodes: np.ndarray, queries: np.ndarray, rows: np.ndarray, beam: int, found: Found,
            leader: int = -1) -> None:
    """Search a part for the queries of the given rows, then its crowds."""
    known = np.array([leader])
    if part.edges is None:
        near = np.broadcast_to(part.members, (len(rows), len(part.members)))
        found.add(rows, near, queries[rows] @ nodes[part.members].T, known)
        return
    local, sims = beam_search(nodes[part.members], part.edges, part.start, queries[rows], beam)
    found.add(rows, np.where(local < 0, -1, part.members[local]), sims, known)
    if not part.crowds:
        return
    leaders = nodes[[c[0] for c in part.crowds]]
    angle = np.arccos(np.clip(queries[rows] @ leaders.T, -1, 1))
    # The most promising crowds come first, so that the others are more often ruled out.
    for c in np.argsort(angle.min(0), kind="stable").tolist():
        top, least, inner = part.crowds[c]
        reach = np.cos(np.maximum(0, angle[:, c] - np.arccos(np.clip(least, -1, 1)) - 1e-3))
        some = rows[reach >= found.best[rows, -1]]
        if len(some):
            explore(inner, nodes, queries, some, beam, found, top)


def best_ids(near: np.ndarray, cos: np.ndarray, ids: np.ndarray, first: np.ndarray, query: int, k: int) -> dict[int, float]:
    """The cosines of the nearest ``k`` ids other than the query's (of equal ones as
    many more as tie), each with its nearest vector; ``ids`` ascend within a node."""
    best: dict[int, float] = {}
    for n, c in sorted(zip(near.tolist(), cos.tolist()), key=lambda x: -x[1]):
        if len(best) >= k and c < sorted(best.values(), reverse=True)[k - 1]:
            break
        new = 0  # of equal vectors the k smallest new ids are enough
        for i in ids[first[n]:first[n + 1]]:
            i = int(i)
            if i != query and i not in best:
                best[i] = c
                new += 1
                if new == k:
                    break
    return dict(sorted(best.items(), key=lambda h: (-h[1], h[0]))[:k])


def find(data: bytes, query_ids: np.ndarray, vectors: np.ndarray, k: int, beam: int) -> Iterator[tuple]:
    distinct, nodes, part, ids, first = pickle.loads(data)
    beam, every = max(beam, k + 1), set(ids.tolist())
    for at in range(0, len(vectors), 256):
        asked = vectors[at:at + 256]
        found = Found(asked, k + 1)
        explore(part, nodes, unit(asked).astype(np.float32), np.arange(len(asked)), beam, found)
        who, vec, score = [], [], []
        for q, v, parts in zip(query_ids[at:at + 256], asked, found.near):
            near = np.unique(np.concatenate(parts))
            cos = cosines(v, distinct[near])
            hits = best_ids(near, cos, ids, first, q, k)
            if len(hits) < min(k, len(every) - (q in every)):
                # Vectors of few ids have filled the beam: compare all.
                near = np.arange(len(distinct))
                hits = best_ids(near, cosines(v, distinct), ids, first, q, k)
            for i, c in hits.items():
                who.append(q)
                vec.append(i)
                score.append(c)
        yield np.array(who, np.int64), np.array(vec, np.int64), np.array(score, np.float64)


def nearest(table: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", k: int = K,
            settings: Settings = Settings(), shard_rows: int = SHARD_ROWS) -> DataFrame:
    """About the ``k`` rows of largest cosine with each query row."""
    def indexer(ids, vectors):
        return build(ids, vectors, settings)

    def finder(data, query_ids, vectors):
        return find(data, query_ids, vectors, k, settings.beam_for(vectors.shape[1]))
    return search(usable(table, vec_id, vec, zero=False), usable(queries, vec_id, vec, zero=False).distinct(),
                  indexer, finder, "double", k, shard_rows, BLOCK_ROWS)


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found to every fiftieth, among all others."""
    table = source(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest(table, table.where(F.col("vec_id") % 50 == 0))
