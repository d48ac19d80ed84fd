"""Approximate nearest neighbours with one small-world graph per shard.

Rows are dealt to shards of bounded size by a hash of their id.  A shard keeps
its distinct vectors in one matrix and its graph in flat arrays: per layer, the
nodes in it and a rectangle of neighbour indices.  Layers hold nodes by the
usual geometric draw; neighbours are chosen from exact nearest candidates by the
diversity rule (a candidate nearer to a chosen neighbour than to the node is
skipped), linked both ways and filled up.  Equal vectors are one node with all
ids, so copies neither cut the graph apart nor crowd out neighbours.

Tight clusters larger than the candidate pools have no links leading out of
them.  So each layer keeps entry points: one in every component of its graph of
nearest neighbours, and more until links lead from them to every node.  A search
of a layer begins at the nearest of these and of what the layer above found.

Queries travel in blocks to every shard, are searched together (each step
expands the best unexpanded candidate of every query at once), and the shards'
results are merged by exact distance, ties to the smaller id.  Graphs are built
and searched in double precision on centred, scaled vectors.

Vectors that are null, zero, of another length than most rows of their shard's
index, or hold null or non-finite components take no part.  Rows without id
take no part.  Repeated rows are candidates each.  With fewer candidates than
k, all are returned.  Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, task, written

SHARD = 8192  # vectors of a shard, about
QUERIES = 512  # queries of a block
NEAREST = 4  # neighbours that tie rows to a component


def valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col)
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return (
        df.where(F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, ok) & F.exists(v, lambda x: x != 0))
        .select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("vec"))
    )


def _entries(x: np.ndarray, near: np.ndarray, links: np.ndarray) -> np.ndarray:
    """Rows to begin at: the one nearest to the mean of every component of the
    graph ``near``, and as many more as it takes to reach all along ``links``."""
    n = len(x)
    a, b = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            break
        label = low
    label = np.unique(label, return_inverse=True)[1]
    mean = np.zeros((label.max() + 1, x.shape[1]))
    np.add.at(mean, label, x)
    mean /= np.bincount(label)[:, None]
    o = np.lexsort((((x - mean[label]) ** 2).sum(1), label))
    entries = list(o[np.searchsorted(label[o], np.arange(len(mean)))])
    seen = np.zeros(n, bool)
    new = np.array(entries)
    while True:
        while len(new):
            seen[new] = True
            new = np.unique(links[new])
            new = new[new >= 0]
            new = new[~seen[new]]
        if seen.all():
            return np.array(entries)
        new = np.flatnonzero(~seen)[:1]
        entries.append(new[0])


def framed(vecs: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Vectors in the frame of ``like``, its largest component 1 and its mean 0:
    squares neither overflow nor cancel, and the order of distances is kept."""
    size = float(np.abs(like).max(initial=0)) or 1.0
    return vecs / size - (like / size).mean(axis=0)


class Graph:
    """Flat arrays of one shard's graph.  ``layers``: (nodes, neighbours, entry
    points) from the bottom up; the latter two index the matrix, -1 fills a row."""

    def __init__(self, vecs: np.ndarray, layers: list):
        self.vecs, self.layers = vecs, layers
        self.norms = np.einsum("ij,ij->i", vecs, vecs)

    @classmethod
    def build(cls, vecs: np.ndarray, m: int = 16, seed: int = 7) -> "Graph":
        n = len(vecs)
        level = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(m)).astype(int)
        layers, nodes, k = [], np.arange(n), 0
        while True:
            layers.append((nodes, *cls._link(vecs, nodes, 2 * m if k == 0 else m)))
            k += 1
            upper = nodes[level[nodes] >= k]
            if len(nodes) <= m or not len(upper):
                return cls(vecs, layers)
            nodes = upper

    @staticmethod
    def _link(vecs: np.ndarray, nodes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        x = vecs[nodes]
        n, pool = len(nodes), min(len(nodes) - 1, 2 * width)
        if pool < 1:
            return np.full((n, 1), -1, np.int32), nodes
        sq = np.einsum("ij,ij->i", x, x)
        near = np.empty((n, pool), np.int64)
        far = np.empty((n, pool), x.dtype)
        for i in range(0, n, 256):
            d = sq[i : i + 256, None] + sq[None] - 2 * x[i : i + 256] @ x.T
            d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
            p = np.argpartition(d, pool - 1, axis=1)[:, :pool]
            dp = np.take_along_axis(d, p, 1)
            o = np.argsort(dp, axis=1)
            near[i : i + 256], far[i : i + 256] = np.take_along_axis(p, o, 1), np.take_along_axis(dp, o, 1)
        keep = np.zeros((n, pool), bool)
        half = max(1, width // 2)
        for i in range(0, n, 256):  # diversity rule, candidates from near to far
            c = near[i : i + 256]
            y = x[c]
            g = sq[c][:, :, None] + sq[c][:, None, :] - 2 * np.einsum("bid,bjd->bij", y, y)
            chosen = np.zeros(c.shape, bool)
            for j in range(pool):
                blocked = (chosen & (g[:, j, :] < far[i : i + 256, j, None])).any(1)
                chosen[:, j] = ~blocked & (chosen.sum(1) < half)
            short = half - chosen.sum(1)  # fill up with the nearest skipped ones
            rest = ~chosen & ((~chosen).cumsum(1) <= short[:, None])
            keep[i : i + 256] = chosen | rest
        a, b = np.nonzero(keep)[0], near[keep]
        # both ways, nearest first, at most ``width`` per node
        u, v = np.concatenate([a, b]), np.concatenate([b, a])
        uv = np.unique(u * n + v)
        u, v = uv // n, uv % n
        d = np.empty(len(u), x.dtype)
        for i in range(0, len(u), 1 << 16):
            s = slice(i, i + (1 << 16))
            d[s] = ((x[u[s]] - x[v[s]]) ** 2).sum(1)
        o = np.lexsort((d, u))
        u, v = u[o], v[o]
        first = np.searchsorted(u, np.arange(n))
        rank = np.arange(len(u)) - first[u]
        own = np.isin(u * n + v, a * n + b)  # chosen links stay, reverse links as space allows
        rank = np.where(own, rank * 0, rank)
        o = np.lexsort((d[o], ~own, u))
        u, v = u[o], v[o]
        first = np.searchsorted(u, np.arange(n))
        rank = np.arange(len(u)) - first[u]
        out = np.full((n, width), -1, np.int32)
        ok = rank < width
        out[u[ok], rank[ok]] = v[ok]
        entries = nodes[_entries(x, near[:, :NEAREST], out)]
        return np.where(out >= 0, nodes[out], -1).astype(np.int32), entries

    def _distance(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances of each query to its row of nodes."""
        d = self.norms[nodes] - 2 * np.einsum("bd,bkd->bk", q, self.vecs[nodes]) + np.einsum("ij,ij->i", q, q)[:, None]
        return np.maximum(d, 0)

    def search(self, q: np.ndarray, k: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, squared distances) of about the k nearest of every query;
        -1 fills rows of small shards."""
        n, b = len(self.vecs), len(q)
        ef = min(max(ef, k), n)
        pool, dist = np.full((b, 0), -1), np.full((b, 0), np.inf)
        for nodes, links, entries in self.layers[::-1]:
            row = np.full(n, -1)
            row[nodes] = np.arange(len(nodes))
            pool, dist = self._beam(q, links, row, entries, pool, dist, ef)
        return pool[:, :k], dist[:, :k]

    def _beam(self, q: np.ndarray, links: np.ndarray, row: np.ndarray, entries: np.ndarray, pool: np.ndarray, dist: np.ndarray, ef: int):
        """The ``ef`` best of one layer, from its entry points and the nodes of
        ``pool``, nearest first."""
        b = len(q)
        seen = np.zeros((b, len(self.vecs)), bool)
        i, c = np.nonzero(pool >= 0)
        seen[i, pool[i, c]] = True
        d = self.norms[entries] - 2 * q @ self.vecs[entries].T + np.einsum("ij,ij->i", q, q)[:, None]
        d = np.where(seen[:, entries], np.inf, np.maximum(d, 0))
        seen[:, entries] = True
        pool, dist = np.concatenate([pool, np.where(np.isfinite(d), entries, -1)], 1), np.concatenate([dist, d], 1)
        if pool.shape[1] < ef:
            more = ((0, 0), (0, ef - pool.shape[1]))
            pool, dist = np.pad(pool, more, constant_values=-1), np.pad(dist, more, constant_values=np.inf)
        o = np.argsort(dist, axis=1, kind="stable")[:, :ef]
        pool, dist = np.take_along_axis(pool, o, 1), np.take_along_axis(dist, o, 1)
        done = ~np.isfinite(dist)
        live = np.arange(b)
        while len(live):
            open_d = np.where(done[live], np.inf, dist[live])
            j = open_d.argmin(1)
            going = np.isfinite(open_d[np.arange(len(live)), j])
            live, j = live[going], j[going]
            if not len(live):
                break
            done[live, j] = True
            near = links[row[pool[live, j]]]
            ok = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
            i, c = np.nonzero(ok)
            seen[live[i], near[i, c]] = True
            d = np.where(ok, self._distance(q[live], np.maximum(near, 0)), np.inf)
            allp = np.concatenate([pool[live], np.where(ok, near, -1)], 1)
            alld = np.concatenate([dist[live], d], 1)
            alldone = np.concatenate([done[live], ~ok], 1)
            o = np.argsort(alld, axis=1, kind="stable")[:, :ef]
            pool[live], dist[live], done[live] = (np.take_along_axis(x, o, 1) for x in (allp, alld, alldone))
        return pool, dist


INDEX = "shard int, ids binary, owner binary, vecs binary, dim int, layers binary"


def build_index(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = SHARD) -> DataFrame:
    """A written table of shards: every valid row is in one of them."""
    import pickle

    good = valid(rows, id_col, vec_col)
    shards = max(1, -(-good.count() // shard_rows))
    dealt = good.withColumn("shard", F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(shards)).cast("int"))

    def run(key, table):
        lists = table.column("vec").combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        ids = table.column("id").to_numpy()
        dims = np.bincount(size)
        dim = int(dims.argmax())
        keep = size == dim
        vecs = lists.filter(pa.array(keep)).flatten().to_numpy().reshape(-1, dim)
        ids = ids[keep]
        order = np.argsort(ids, kind="stable")
        ids, vecs = ids[order], vecs[order]
        raw = np.ascontiguousarray(vecs + 0.0).view(f"V{8 * dim}").ravel()
        _, first, owner = np.unique(raw, return_index=True, return_inverse=True)
        graph = Graph.build(framed(vecs[first], vecs[first]))
        return pa.table(
            {
                "shard": pa.array([key[0].as_py()], pa.int32()), "ids": [ids.astype("<i8").tobytes()], "owner": [owner.astype("<i4").tobytes()],
                "vecs": [vecs[first].astype("<f8").tobytes()], "dim": pa.array([dim], pa.int32()), "layers": [pickle.dumps(graph.layers)],
            }
        )

    return written(dealt.groupBy("shard").applyInArrow(run, INDEX), "hnsw")


def search(index: DataFrame, queries: DataFrame, k: int = 10, ef: int = 128, id_col: str = "vec_id", vec_col: str = "embedding", skip_own: bool = True) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance) of each
    query's k nearest; a query's own row (same id) is none of them where
    ``skip_own``."""
    import pickle

    good = valid(queries, id_col, vec_col)
    n_blocks = max(1, -(-good.count() // QUERIES))
    shards = index.select("shard")
    blocks = (
        good.withColumn("block", F.pmod(F.xxhash64(F.lit(6), "id"), F.lit(n_blocks)).cast("int"))
        .groupBy("block").agg(F.collect_list(F.struct("id", "vec")).alias("q"))
    )
    # every block meets every shard: a query set against all rows, in blocks
    sent = blocks.select("q").join(F.broadcast(shards.agg(F.collect_list("shard").alias("s"))), how="cross").select("q", F.explode("s").alias("shard"))
    met = sent.join(index, "shard")

    def run(batches):
        kept = (None, None)
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1)
                name = column(r, "shard")[0].as_py()
                if kept[0] != name:
                    dim = column(r, "dim")[0].as_py()
                    vecs = np.frombuffer(column(r, "vecs")[0].as_py(), "<f8").reshape(-1, dim)
                    ids = np.frombuffer(column(r, "ids")[0].as_py(), "<i8")
                    owner = np.frombuffer(column(r, "owner")[0].as_py(), "<i4")
                    by = np.argsort(owner, kind="stable")  # ids ascending within a node
                    first = np.searchsorted(owner[by], np.arange(len(vecs) + 1))
                    graph = Graph(framed(vecs, vecs), pickle.loads(column(r, "layers")[0].as_py()))
                    kept = (name, (dim, vecs, ids[by], first, graph))
                dim, vecs, ids, first, graph = kept[1]
                q = column(r, "q").flatten()
                size = np.diff(q.field("vec").offsets.to_numpy())
                use = np.flatnonzero(size == dim)
                if not len(use):
                    continue
                qid = q.field("id").to_numpy()[use]
                qv = q.field("vec").take(pa.array(use)).flatten().to_numpy().reshape(-1, dim)
                nodes, _ = graph.search(framed(qv, vecs), k + 1, ef)
                out_q, out_v, out_d = [], [], []
                for j in range(len(use)):
                    near = nodes[j][nodes[j] >= 0]
                    d = np.sqrt(((vecs[near] - qv[j]) ** 2).sum(1))
                    got = [(x, v) for x, c in sorted(zip(d.tolist(), near.tolist())) for v in ids[first[c] : first[c] + min(k + 1, first[c + 1] - first[c])].tolist()]
                    got = sorted(x for x in got if not (skip_own and x[1] == qid[j]))[:k]
                    out_q += [int(qid[j])] * len(got)
                    out_v += [v for _, v in got]
                    out_d += [x for x, _ in got]
                yield pa.RecordBatch.from_arrays([pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array(out_d, pa.float64())], ["query_id", "vec_id", "score"])

    found = met.mapInArrow(task(run), "query_id long, vec_id long, score double")
    # merge: the k smallest of (distance, id) per query
    top = found.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("t"))
    return top.select("query_id", F.posexplode("t").alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")
    )
