"""Operator 8, approximate nearest neighbours: robust-pruned directed graphs.

Vectors are dealt to shards of about ``SHARD_ROWS`` by a hash of their id and components. In each
shard equal vectors share a node (with the smallest ids they stand for), and a
directed graph is built: greedy searches from the medoid propose neighbours, and
relaxed distance pruning (a candidate is dropped if a kept one is ``alpha`` times
closer to it than the node is) keeps at most ``DEGREE`` diverse edges; back edges
are added and pruned alike; a second pass repeats this with ``alpha`` above 1. All
rows are indexed. The index is a table (node, vector, edges) in the shared
checkpoint folder. Queries are cut into blocks; each (shard, block) is one task
that runs beam searches for its block over its shard's graph, and the partial
results of a query are merged by a window. Both sides of a task are bounded by
``SHARD_ROWS`` and ``BLOCK_ROWS``, whatever the size of the table.

Distances are Euclidean in double precision on the original vectors.

Defined cases: null, all-zero and empty vectors, and such with null or non-finite
components, take no part, nor do vectors of another length than most (the smaller
length on a tie); ties go to the smaller vec_id; rows that repeat a vec_id with the
same vector count once, with another vector both count; null vec_ids take no part;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.text import write_table

SHARD_ROWS = 4096
BLOCK_ROWS = 2048
DEGREE = 32
BEAM_BUILD, BEAM_QUERY = 48, 96
ALPHA = 1.2
NEAREST = 10
QUERY_EVERY = 100


def _distances(x: np.ndarray, norms: np.ndarray, at: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of points ``x[at]`` (rows of indexes) to the query of each row."""
    d = norms[at] - 2 * np.einsum("bkd,bd->bk", x[at], q) + np.einsum("bd,bd->b", q, q)[:, None]
    return np.maximum(d, 0)


def beam_search(x: np.ndarray, norms: np.ndarray, edges: np.ndarray, entry: int, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and squared distances of each query's beam (nearest first; -1 where it is
    not full). ``edges`` is -1 where a node has fewer."""
    n, b = len(x), len(q)
    rows = np.arange(b)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True  # edge -1
    ids = np.full((b, beam), -1)
    dist = np.full((b, beam), np.inf)
    open_ = np.zeros((b, beam), bool)
    ids[:, 0] = entry
    dist[:, 0] = _distances(x, norms, np.full((b, 1), entry), q)[:, 0]
    open_[:, 0] = True
    seen[:, entry] = True
    live = rows
    while len(live):
        best = np.where(open_[live], dist[live], np.inf).argmin(1)
        on = open_[live, best]
        live, best = live[on], best[on]
        if not len(live):
            break
        open_[live, best] = False
        nxt = edges[ids[live, best]]
        new = ~seen[live[:, None], nxt]
        nxt = np.where(new, nxt, 0)
        seen[live[:, None], np.where(new, nxt, n)] = True
        d = np.where(new, _distances(x, norms, nxt, q[live]), np.inf)
        all_d = np.concatenate([dist[live], d], 1)
        keep = np.argsort(all_d, 1, kind="stable")[:, :beam]
        pick = lambda old, more: np.take_along_axis(np.concatenate([old[live], more], 1), keep, 1)
        all_ids = pick(ids, np.where(new, nxt, -1))
        all_open = pick(open_, new)
        ids[live], open_[live], dist[live] = all_ids, all_open, np.take_along_axis(all_d, keep, 1)
    return ids, dist


def robust_prune(x: np.ndarray, norms: np.ndarray, p: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Diverse neighbours of each node ``p[i]`` from ``cand[i]`` (-1: none; no node twice)."""
    cand = np.where(cand == p[:, None], -1, cand)
    d = np.where(cand >= 0, _distances(x, norms, np.maximum(cand, 0), x[p]), np.inf)
    order = np.argsort(d, 1, kind="stable")
    cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
    y = x[np.maximum(cand, 0)]
    yn = norms[np.maximum(cand, 0)]
    between = np.maximum(yn[:, :, None] + yn[:, None, :] - 2 * np.matmul(y, y.transpose(0, 2, 1)), 0)
    out = np.full((len(p), degree), -1)
    alive = cand >= 0
    rows = np.arange(len(p))
    for k in range(degree):
        first = alive.argmax(1)
        ok = alive[rows, first]
        if not ok.any():
            break
        out[ok, k] = cand[rows, first][ok]
        alive &= ~((alpha * alpha * between[rows, first] <= d) & ok[:, None])
        alive[rows, first] = False
    return out


def _unique_rows(cand: np.ndarray) -> np.ndarray:
    """Each row's values once (repeats become -1)."""
    s = np.sort(cand, 1)
    s[:, 1:][s[:, 1:] == s[:, :-1]] = -1
    return s


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM_BUILD, alpha: float = ALPHA, batch: int = 256,
                seed: int = 1) -> tuple[np.ndarray, int]:
    """Edges (one row per node, -1 where there are fewer) and the entry node."""
    n = len(x)
    norms = np.einsum("nd,nd->n", x, x)
    mean = x.mean(0)
    entry = int((norms - 2 * x @ mean).argmin())
    if n <= degree + 1:  # few nodes: everyone knows everyone
        return np.array([[j for j in range(n) if j != i] + [-1] * (degree - n + 1) for i in range(n)], np.int64), entry
    rng = np.random.default_rng(seed)
    edges = np.stack([rng.integers(0, n, n) for _ in range(min(degree, 8))], 1)
    edges = np.concatenate([edges, np.full((n, degree - edges.shape[1]), -1)], 1)
    for a in (1.0, alpha):
        order = rng.permutation(n)
        for s in range(0, n, batch):
            p = order[s:s + batch]
            found, _ = beam_search(x, norms, edges, entry, x[p], beam)
            edges[p] = robust_prune(x, norms, p, _unique_rows(np.concatenate([found, edges[p]], 1)), degree, a)
            # Back edges, gathered by the node they lead to.
            src = np.repeat(p, degree)
            dst = edges[p].ravel()
            on = dst >= 0
            src, dst = src[on], dst[on]
            by = np.argsort(dst, kind="stable")
            src, dst = src[by], dst[by]
            node, first, count = np.unique(dst, return_index=True, return_counts=True)
            wide = np.full((len(node), count.max()), -1)
            wide[np.repeat(np.arange(len(node)), count), np.arange(len(dst)) - np.repeat(first, count)] = src
            for t in range(0, len(node), batch):
                q = node[t:t + batch]
                cand = _unique_rows(np.concatenate([edges[q], wide[t:t + batch]], 1))
                full = (cand >= 0).sum(1) > degree
                cand = -np.sort(-cand, 1)
                edges[q[~full]] = cand[~full, :degree]
                if full.any():
                    edges[q[full]] = robust_prune(x, norms, q[full], cand[full], degree, a)
    return edges, entry


def _valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    q = lambda c: F.col(f"`{c}`")
    v = F.transform(q(vec_col), lambda e: e.cast("double"))
    d = df.select(q(id_col).cast("long").alias("vec_id"), v.alias("vec")).where(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
    bad = F.exists("vec", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return d.where(~bad & F.exists("vec", lambda e: e != 0))


def _index_task(degree: int, keep: int):
    def build(key, pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(pdf["vec"].tolist(), np.float64)
        x, node = np.unique(x, axis=0, return_inverse=True)
        ids = pd.DataFrame({"node": node.ravel(), "id": pdf["vec_id"].to_numpy()}).drop_duplicates().sort_values(["node", "id"])
        members = ids.groupby("node")["id"].apply(lambda s: s.head(keep).tolist()).tolist()
        edges, entry = build_graph(x, degree)
        return pd.DataFrame({"shard": key[0], "node": np.arange(len(x)), "entry": entry, "members": members,
                             "vec": list(x), "edges": list(edges)})
    return build


def build_index(vectors: DataFrame, n: int, nearest: int = NEAREST, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``shard, node, entry, members, vec, edges``: the graphs of all shards."""
    shards = max(1, -(-n // shard_rows))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(shards)).cast("int"))
    index = dealt.groupBy("shard").applyInPandas(
        _index_task(DEGREE, nearest + 1),
        "shard int, node int, entry int, members array<long>, vec array<double>, edges array<int>")
    return write_table(index, "graph")


def _search_task(nearest: int, beam: int):
    def search(key, graph: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "query_key": [], "vec_id": [], "score": []}
        if len(graph) and len(queries):
            graph = graph.sort_values("node")
            x = np.array(graph["vec"].tolist(), np.float64)
            edges = np.array(graph["edges"].tolist(), np.int64)
            members = graph["members"].tolist()
            norms = np.einsum("nd,nd->n", x, x)
            entry = int(graph["entry"].iloc[0])
            q = np.array(queries["vec"].tolist(), np.float64)
            for s in range(0, len(q), 128):
                found, near = beam_search(x, norms, edges, entry, q[s:s + 128], beam)
                for i, (nodes, d) in enumerate(zip(found, near)):
                    nodes = nodes[nodes >= 0]
                    exact = np.sqrt(((x[nodes] - q[s + i]) ** 2).sum(1))
                    own = int(queries["vec_id"].iloc[s + i])
                    hits = [(float(e), int(m)) for e, v in zip(exact, nodes) for m in members[v] if m != own]
                    for e, m in sorted(hits)[:nearest]:
                        out["query_id"].append(own)
                        out["query_key"].append(int(queries["query_key"].iloc[s + i]))
                        out["vec_id"].append(m)
                        out["score"].append(e)
        return pd.DataFrame(out)
    return search


def nearest(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", query_every: int = QUERY_EVERY,
            k: int = NEAREST, beam: int = BEAM_QUERY, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row whose id
    ``query_every`` divides."""
    vectors = _valid(df, id_col, vec_col)
    size = vectors.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    dim, n = (size["dim"], size["n"]) if size else (0, 0)
    vectors = vectors.where(F.size("vec") == dim).dropDuplicates(["vec_id", "vec"])
    index = build_index(vectors, n, k, shard_rows)
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-(n // query_every + 1) // block_rows))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    queries = vectors.where(F.col("vec_id") % query_every == 0).withColumn("query_key", F.xxhash64("vec"))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(blocks)).cast("int")).withColumn("shard", every(shards))
    graphs = index.withColumn("block", every(blocks))
    found = graphs.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInPandas(
        _search_task(k, beam), "query_id long, query_key long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id")

    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
