"""Embedding near-duplicates by hierarchical navigable small-world graphs.

Equal vectors collapse to the smallest id.  The rest is dealt by hash into
shards of about ``SHARD_ROWS`` vectors, each indexed by a graph of geometric
levels: a node's edges come from its nearest nodes in the shard and among the
sparser upper levels (the long links), thinned by the usual rule that a
neighbour must be nearer to the node than to any neighbour already taken.
Every vector then queries every shard: a beam descends level by level and
returns all nodes it met at or above the threshold.  A beam that is still full
of such nodes at its end is widened until it is not, so a large group of copies
is found whole.  Each task also audits itself: for a hashed sample of its
queries and of the shard's own nodes the exact answer is computed, and while
the recall falls short all beams are widened and the search is repeated.  Found
links are verified by cosine in double precision.

A task holds one shard and one block of queries.  It returns the number of
links per vector and a spanning forest of its links, at most one row per
vector, never the pairs of a group; components join the forests.

Defined results: a vector that is null, empty or zero or has null or non-finite
components is linked with nothing; only vectors of equal length are compared;
equal vectors count as linked with one another; rows that share a vec_id are
one node of the graph; a null vec_id is linked with nothing and kept; other
columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.llm.common import connected_components, stage, ship_package

THRESHOLD = 0.9
SHARD_ROWS = 32768
QUERY_ROWS = 16384
DEGREE = 24
REVERSE = 12  # places for reverse edges
BEAM = 24
UPPER_BEAM = 8  # above the lowest level
EXPAND = 4
LANES = 512
AUDIT = 96
LINK_RECALL = 0.995
SELF_RECALL = 0.98
#: Beams of this share of a shard or more are run as a scan of the shard.
WIDEST = 1 / 16
#: Single-precision sums may fall short of the double-precision cosine by this much.
SLACK = 1e-3


def _level(ids: np.ndarray) -> np.ndarray:
    """Geometric level of each node, from its hash."""
    x = ids.astype(np.uint64)
    for c in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(29))) * np.uint64(c)
    u = ((x >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53
    return np.minimum(np.floor(-np.log(u) / math.log(16)), 6).astype(np.int64)


def _nearest(v: np.ndarray, rows: np.ndarray, pool: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` members of ``pool`` nearest to each of ``rows`` (itself left out), -1 where there are fewer."""
    out = np.full((len(rows), k), -1, np.int32)
    if len(pool) < 2:
        return out
    m = min(k, len(pool) - 1)
    for at in range(0, len(rows), 512):
        r = rows[at:at + 512]
        sim = v[r] @ v[pool].T
        sim[pool[None, :] == r[:, None]] = -2
        best = np.argpartition(sim, sim.shape[1] - m, axis=1)[:, -m:]
        out[at:at + 512, :m] = pool[best]
    return out


def _thin(v: np.ndarray, rows: np.ndarray, cand: np.ndarray, degree: int) -> np.ndarray:
    """Neighbours of ``rows`` among ``cand``: nearest first, each nearer to the node than to those taken."""
    out = np.full((len(rows), degree), -1, np.int32)
    for at in range(0, len(rows), 256):
        c, r = cand[at:at + 256], rows[at:at + 256]
        c = np.sort(c, axis=1)
        c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
        x = v[c]
        sim = np.einsum("nd,nkd->nk", v[r], x)
        sim[c < 0] = -3
        order = np.argsort(-sim, axis=1)
        c, sim = np.take_along_axis(c, order, 1), np.take_along_axis(sim, order, 1)
        x = np.take_along_axis(x, order[:, :, None], 1)
        among = x @ x.transpose(0, 2, 1)
        taken = np.zeros(c.shape, bool)
        for j in range(c.shape[1]):
            near = np.where(taken, among[:, j, :], -3).max(axis=1)
            taken[:, j] = (c[:, j] >= 0) & ((near < sim[:, j]) | (j < 2)) & (taken.sum(axis=1) < degree)
        # Places left over go to the nearest of the others.
        rank = np.argsort(np.where(taken, 0, np.where(c >= 0, 1, 2)), axis=1, kind="stable")[:, :degree]
        pick = np.take_along_axis(c, rank, 1)
        out[at:at + 256, :pick.shape[1]] = pick
    return out


class Graph:
    """One shard's index: unit vectors, levels and, per level, neighbours."""

    def __init__(self, v: np.ndarray, level: np.ndarray, edges: list[np.ndarray]):
        self.v, self.level, self.edges = v, level, edges

    @classmethod
    def build(cls, v: np.ndarray, ids: np.ndarray, degree: int = DEGREE) -> Graph:
        level = _level(ids)
        edges = []
        for lev in range(int(level.max(initial=0)) + 1):
            nodes = np.flatnonzero(level >= lev)
            pools = [np.flatnonzero(level >= up) for up in range(lev, int(level.max(initial=0)) + 1)]
            cand = np.concatenate([_nearest(v, nodes, p, 40 if k == 0 else 10) for k, p in enumerate(pools)], axis=1)
            near = _thin(v, nodes, cand, degree)
            edges.append(cls._both_ways(len(v), nodes, near, degree))
        return cls(v, level, edges)

    @staticmethod
    def _both_ways(n: int, nodes: np.ndarray, near: np.ndarray, degree: int) -> np.ndarray:
        """Add the reverse of each edge, as far as ``REVERSE`` more places go."""
        src = np.repeat(nodes, near.shape[1])
        dst = near.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        begin = np.searchsorted(dst, dst)
        rank = np.arange(len(dst)) - begin
        out = np.full((n, degree + REVERSE), -1, np.int32)
        out[nodes, :degree] = near
        fits = rank < REVERSE
        out[dst[fits], degree + rank[fits]] = src[fits]
        return out

    def _beam(self, adj: np.ndarray, q: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and similarities (best first in no order) that a beam of width ``ef`` ends with."""
        lanes, n = len(q), len(self.v)
        ids = np.full((lanes, ef), -1, np.int32)
        sim = np.full((lanes, ef), -9.0, np.float32)
        done = np.ones((lanes, ef), bool)
        seen = np.zeros((lanes, n + 1), bool)
        w = min(entry.shape[1], ef)
        ids[:, :w] = entry[:, :w]
        sim[:, :w] = np.where(ids[:, :w] >= 0, np.einsum("nd,nkd->nk", q, self.v[ids[:, :w]]), -9)
        done[:, :w] = ids[:, :w] < 0
        seen[np.arange(lanes)[:, None], ids[:, :w]] = True
        live = np.arange(lanes)
        while len(live):
            open_sim = np.where(done[live], -9.0, sim[live])
            more = open_sim.max(axis=1) > -9
            live, open_sim = live[more], open_sim[more]
            if not len(live):
                break
            e = max(EXPAND, ef // 64)
            pick = np.argpartition(open_sim, open_sim.shape[1] - e, axis=1)[:, -e:]
            real = np.take_along_axis(open_sim, pick, 1) > -9
            done[live[:, None], pick] = True
            node = np.where(real, ids[live[:, None], pick], -1)
            new = np.where((node >= 0)[:, :, None], adj[node], -1).reshape(len(live), -1)
            new = np.sort(new, axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            new[seen[live[:, None], new]] = -1
            seen[live[:, None], new] = True
            seen[:, -1] = False
            width = max(1, int((new >= 0).sum(axis=1).max()))
            new = -np.partition(-new, min(width, new.shape[1] - 1), axis=1)[:, :width]
            s = np.where(new >= 0, np.einsum("nd,nkd->nk", q[live], self.v[new]), -9.0).astype(np.float32)
            all_ids = np.concatenate((ids[live], new), axis=1)
            all_sim = np.concatenate((sim[live], s), axis=1)
            all_done = np.concatenate((done[live], new < 0), axis=1)
            keep = np.argpartition(all_sim, all_sim.shape[1] - ef, axis=1)[:, -ef:]
            ids[live] = np.take_along_axis(all_ids, keep, 1)
            sim[live] = np.take_along_axis(all_sim, keep, 1)
            done[live] = np.take_along_axis(all_done, keep, 1)
        return ids, sim

    def search(self, q: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        top = len(self.edges) - 1
        first = np.flatnonzero(self.level >= top)[:32].astype(np.int32)
        entry = np.repeat(first[None, :], len(q), axis=0)
        for lev in range(top, 0, -1):
            ids, sim = self._beam(self.edges[lev], q, entry, UPPER_BEAM)
            entry = np.take_along_axis(ids, np.argsort(-sim, axis=1), 1)
        return self._beam(self.edges[0], q, entry, ef)

    def links(self, q: np.ndarray, ef: int, least: float) -> Iterator[tuple[int, np.ndarray]]:
        """(query, nodes at or above ``least``).  Full beams are widened; a beam as wide as
        ``WIDEST`` of the shard covers all of it."""
        todo = np.arange(len(q))
        while len(todo):
            again = [np.empty(0, np.int64)]
            whole = ef >= WIDEST * len(self.v)
            for at in range(0, len(todo), LANES):
                rows = todo[at:at + LANES]
                if whole:
                    sim = q[rows] @ self.v.T
                    ids = np.broadcast_to(np.arange(len(self.v), dtype=np.int32), sim.shape)
                else:
                    ids, sim = self.search(q[rows], ef)
                hit = (sim >= least) & (ids >= 0)
                full = hit.all(axis=1) & (not whole)
                again.append(rows[full])
                for k in np.flatnonzero(hit.any(axis=1) & ~full):
                    yield int(rows[k]), ids[k][hit[k]]
            todo = np.concatenate(again)
            ef *= 4

    def audited_beam(self, q: np.ndarray, ids: np.ndarray, least: float) -> int:
        """The beam width at which the audit passes."""
        ef = BEAM
        own = np.argsort(ids * np.int64(2654435761) % np.int64(1 << 31), kind="stable")[:AUDIT]
        probe = q[:: max(1, len(q) // AUDIT)][:AUDIT]
        exact = probe @ self.v.T >= least + 2 * SLACK
        same = self.v[own] @ self.v.T >= 1 - SLACK
        while ef < WIDEST * len(self.v):
            found, sim = self.search(self.v[own], ef)
            selfs = (np.where(found >= 0, np.take_along_axis(same, np.maximum(found, 0), 1), False)).any(axis=1).mean()
            got = np.zeros_like(exact)
            for k, nodes in self.links(probe, ef, least):
                got[k, nodes] = True
            if selfs >= SELF_RECALL and (got & exact).sum() >= LINK_RECALL * exact.sum():
                break
            ef *= 2
        return ef


def _matrix(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares within range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _join(parent: np.ndarray, nodes: np.ndarray) -> None:
    """Join ``nodes`` in the union-find array ``parent``, whose roots are their trees' smallest nodes."""
    roots = parent[nodes]
    while (up := parent[roots]).tobytes() != roots.tobytes():
        roots = up
    parent[roots] = parent[nodes] = roots.min()


def join_links(g: Graph, unit: np.ndarray, rep: np.ndarray, copies: np.ndarray, x: np.ndarray, own: np.ndarray, ef: int,
               threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the queries ``x`` (ids ``own``) that have links: ids and numbers of links; and the forest of all
    links, as nodes and the smallest node of each.  Links are joined as they are found, none is kept."""
    names = np.unique(np.concatenate((rep, own)))
    at, own_at = np.searchsorted(names, rep), np.searchsorted(names, own)
    parent, others = np.arange(len(names)), np.zeros(len(own), np.int64)
    for k, nodes in g.links(x.astype(np.float32), ef, threshold - SLACK):
        nodes = nodes[rep[nodes] != own[k]]
        # A few thousand vectors at a time are gathered in double precision.
        near = [part[unit[part] @ x[k] >= threshold] for part in np.split(nodes, range(4096, len(nodes), 4096))]
        nodes = np.concatenate(near)
        if len(nodes):
            others[k] = copies[nodes].sum()
            _join(parent, np.append(at[nodes], own_at[k]))
    while (up := parent[parent]).tobytes() != parent.tobytes():
        parent = up
    some, child = np.flatnonzero(others), np.flatnonzero(parent != np.arange(len(names)))
    return own[some], others[some], names[child], names[parent[child]]


def link_embeddings(vectors: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS,
                    query_rows: int = QUERY_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    ship_package(vectors.sparkSession)
    e = F.col("embedding").cast("array<double>")
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(e, lambda x: x != 0), F.lit(False))
    rows = vectors.select("vec_id", F.col("embedding").alias("v"), usable.alias("ok"))
    id_type = rows.schema["vec_id"].dataType.simpleString()
    good = rows.where("ok").select("vec_id", F.transform(F.col("v"), lambda x: x.cast("double") + 0.0).alias("v"))
    classes = stage(good.groupBy("v").agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("copies")), "hnsw_classes")
    n = classes.count()
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(n / query_rows))
    dim = F.size("v")
    index_rows = classes.select(dim.alias("dim"), F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int").alias("shard"), "rep", "v", "copies")

    def build(t: pa.Table) -> pa.Table:
        d = t["dim"][0].as_py()
        unit = _unit(_matrix(t["v"], d))
        g = Graph.build(unit.astype(np.float32), t["rep"].to_numpy().astype(np.int64))
        packed = [pa.array([row.tobytes() for row in edge], pa.binary()) for edge in g.edges]
        lists = pa.array([[packed[lev][k].as_py() for lev in range(int(g.level[k]) + 1)] for k in range(len(unit))], pa.list_(pa.binary()))
        return pa.table({"dim": t["dim"], "shard": t["shard"], "pos": pa.array(np.arange(len(unit)), pa.int32()), "rep": t["rep"],
                         "v": pa.array(list(unit), pa.list_(pa.float64())), "copies": t["copies"], "edges": lists})

    index = stage(index_rows.groupBy("dim", "shard").applyInArrow(
        build, f"dim int, shard int, pos int, rep {id_type}, v array<double>, copies bigint, edges array<binary>"), "hnsw_index")
    block = F.pmod(F.xxhash64("rep", F.lit("query")), F.lit(blocks)).cast("int")
    queries = index.select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block.alias("block"),
                           "rep", "v", "copies")
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(q: pa.Table, t: pa.Table) -> pa.Table:
        kind = q["rep"].type if q.num_rows else t["rep"].type
        ids, others, child, root = [], [], [], []
        if q.num_rows and t.num_rows:
            d = q["dim"][0].as_py()
            t = t.sort_by("pos")
            unit, rep = _matrix(t["v"], d), t["rep"].to_numpy()
            copies = t["copies"].to_numpy()
            stored = t["edges"].to_pylist()
            level = np.array([len(x) - 1 for x in stored])
            edges = []
            for lev in range(int(level.max()) + 1):
                adj = np.full((len(stored), DEGREE + REVERSE), -1, np.int32)
                for k in np.flatnonzero(level >= lev):
                    adj[k] = np.frombuffer(stored[k][lev], np.int32)
                edges.append(adj)
            g = Graph(unit.astype(np.float32), level, edges)
            x, own = _matrix(q["v"], d), q["rep"].to_numpy()
            ef = g.audited_beam(x.astype(np.float32), rep.astype(np.int64), threshold - SLACK)
            ids, others, child, root = join_links(g, unit, rep, copies, x, own, ef, threshold)
        return pa.table({"a": pa.concat_arrays([pa.array(ids, kind), pa.array(child, kind)]),
                         "b": pa.concat_arrays([pa.nulls(len(ids), kind), pa.array(root, kind)]),
                         "n": pa.concat_arrays([pa.array(others, pa.int64()), pa.nulls(len(child), pa.int64())])})

    found = stage(queries.groupBy("dim", "shard", "block").cogroup(spread.groupBy("dim", "shard", "block")).applyInArrow(
        search, f"a {id_type}, b {id_type}, n bigint"), "hnsw_found")
    comp = stage(connected_components(found.where("b is not null")), "hnsw_comp")
    links = found.where("b is null").groupBy("a").agg(F.sum("n").alias("others"))
    info = (classes.select("rep", "copies").join(links, F.col("rep") == F.col("a"), "left")
            .join(comp, F.col("rep") == F.col("node"), "left")
            .select("rep", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                    F.coalesce("component_id", "rep").alias("component_id")))
    members = good.join(classes.select(F.col("v").alias("cv"), "rep"), F.col("v") == F.col("cv")).select("vec_id", F.col("rep").alias("r"))
    linked = members.join(info, F.col("r") == F.col("rep")).select("vec_id", "n_links", "component_id")
    lone = rows.where("not ok").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(lone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
