"""Approximate nearest neighbours (largest cosine) with robust-pruned graph shards.

Equal vectors are one node, named by a hash of the vector; a node keeps its few
smallest ids, as many as any result can need, so copies cost nothing and are never
lost. An id with several vectors stands in several nodes; its best score counts.
Nodes are dealt by hash into shards of about ``SHARD`` nodes, and every node is
indexed.

Build (one task a shard): from a random graph, each node's greedy search from
a few entry nodes spread over the shard proposes neighbours; walking them from the nearest, a proposal goes if
a kept neighbour is closer to it than the node is by the factor ``ALPHA``
(relaxed distance pruning); edges back are added and pruned the same way. Two
passes over the nodes.

Search: queries go in blocks to every shard (a stated query set against all
rows) and walk its graph with a beam of ``BEAM``; the shards' best are scored
anew in double precision on the original vectors and merged per query. Work grows
with queries times shards; rows that leave a task are at most k + 1 a query (as
often as the most repeated id has vectors, for which the beam is widened too).

Greedy searches run for a block of nodes or queries at once in numpy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, starts_of

SHARD = 2048
DEGREE = 24
BUILD_BEAM = 64
BEAM = 64
ENTRIES = 32
ALPHA = 1.2
#: Nodes of a build step, queries of a search step, queries of a block.
STEP, BLOCK = 256, 4096


def spread_entries(x: np.ndarray, count: int = ENTRIES) -> np.ndarray:
    """Entry nodes: the medoid, then always the node farthest from those taken.

    A dense cluster (say, near copies of one vector) can then not hide the rest
    of the shard behind it.
    """
    out = [int((x @ x.mean(axis=0)).argmax())]
    far = 2 - 2 * (x @ x[out[0]])
    while len(out) < min(count, len(x)):
        out.append(int(far.argmax()))
        far = np.minimum(far, 2 - 2 * (x @ x[out[-1]]))
    return np.unique(out)


def beam_search(x: np.ndarray, nbr: np.ndarray, start: np.ndarray, q: np.ndarray, beam: int) -> tuple:
    """(node ids, squared distances) of each query's beam, nearest first.

    Walks start from the entry nodes ``start`` (no more than ``beam``).

    ``nbr`` is padded with -1, and so is the result if fewer nodes are met.
    """
    b, n = len(q), len(x)
    ids = np.full((b, beam), -1, np.int64)
    dist = np.full((b, beam), np.inf, np.float32)
    open_ = np.zeros((b, beam), bool)
    seen = np.zeros((b, n), bool)
    m = len(start)
    ids[:, :m], open_[:, :m], seen[:, start] = start, True, True
    dist[:, :m] = 2 - 2 * (q @ x[start].T)
    rows = np.arange(b)
    while True:
        near = np.where(open_, dist, np.inf)
        best = near.argmin(axis=1)
        go = np.isfinite(near[rows, best])
        if not go.any():
            return ids, dist
        r = rows[go]
        at = best[go]
        open_[r, at] = False
        new = nbr[ids[r, at]]
        ok = (new >= 0) & ~seen[r[:, None], new]
        seen[r[:, None], np.where(ok, new, ids[r, at][:, None])] = True
        d = 2 - 2 * np.einsum("brd,bd->br", x[new], q[r])
        d = np.where(ok, d, np.inf).astype(np.float32)
        alld = np.concatenate([dist[r], d], axis=1)
        order = np.argsort(alld, axis=1, kind="stable")[:, :beam]
        ids[r] = np.take_along_axis(np.concatenate([ids[r], np.where(ok, new, -1)], axis=1), order, 1)
        dist[r] = np.take_along_axis(alld, order, 1)
        open_[r] = np.take_along_axis(np.concatenate([open_[r], ok], axis=1), order, 1)


def robust_prune(x: np.ndarray, p: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Out-edges (padded with -1) of nodes ``p`` from their candidates (padded with -1)."""
    cand = np.sort(cand, axis=1)
    dead = (cand < 0) | (cand == p[:, None])
    dead[:, 1:] |= cand[:, 1:] == cand[:, :-1]
    d = 2 - 2 * np.einsum("bmd,bd->bm", x[cand], x[p])
    d = np.where(dead, np.inf, d)
    order = np.argsort(d, axis=1, kind="stable")
    cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
    vec = x[cand]
    alive = np.isfinite(d)
    out = np.full((len(p), degree), -1, np.int64)
    rows = np.arange(len(p))
    for i in range(degree):
        best = alive.argmax(axis=1)
        has = alive[rows, best]
        if not has.any():
            break
        out[has, i] = cand[rows, best][has]
        between = 2 - 2 * np.einsum("bmd,bd->bm", vec, vec[rows, best])
        alive &= ~has[:, None] | (alpha * alpha * between > d)
        alive[rows, best] = False
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA,
                seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(neighbours padded with -1, entry nodes) over unit vectors (float32)."""
    n = len(x)
    rnd = np.random.default_rng(seed)
    start = spread_entries(x)
    nbr = rnd.integers(0, n, (n, degree))
    nbr[nbr == np.arange(n)[:, None]] = -1
    if n <= degree + 1:  # a complete graph
        full = np.tile(np.arange(n), (n, 1))
        return np.where(full == np.arange(n)[:, None], -1, full), start
    for relax in (1.0, alpha):
        todo = rnd.permutation(n)
        for a in range(0, n, STEP):
            p = todo[a:a + STEP]
            met, _ = beam_search(x, nbr, start, x[p], beam)
            nbr[p] = robust_prune(x, p, np.concatenate([met, nbr[p]], axis=1), degree, relax)
            _add_back(x, nbr, p, degree, relax)
    return nbr, start


def _add_back(x: np.ndarray, nbr: np.ndarray, p: np.ndarray, degree: int, alpha: float) -> None:
    """Edges from the new neighbours of ``p`` back to ``p``, pruned where too many."""
    to, frm = nbr[p].ravel(), np.repeat(p, degree)
    to, frm = to[to >= 0], frm[to >= 0]
    known = (nbr[to] == frm[:, None]).any(axis=1)
    to, frm = to[~known], frm[~known]
    if not len(to):
        return
    order = np.argsort(to, kind="stable")
    to, frm = to[order], frm[order]
    head = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
    size = np.diff(np.append(head, len(to)))
    extra = np.full((len(head), size.max()), -1, np.int64)
    extra[np.repeat(np.arange(len(head)), size), np.arange(len(to)) - np.repeat(head, size)] = frm
    node = to[head]
    for a in range(0, len(node), STEP):
        q = node[a:a + STEP]
        both = np.concatenate([nbr[q], extra[a:a + STEP]], axis=1)
        count = (both >= 0).sum(axis=1)
        few = count <= degree
        if few.any():
            packed = -np.sort(-both[few], axis=1)[:, :degree]
            nbr[q[few]] = packed
        if not few.all():
            nbr[q[~few]] = robust_prune(x, q[~few], both[~few], degree, alpha)


def _matrix(col) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths, in double precision."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


def _scaled(v: np.ndarray) -> np.ndarray:
    """Rows times a power of two each (exact), their largest component in [0.5, 1): no
    square overflows or vanishes."""
    _, e = np.frexp(np.abs(v).max(axis=1, keepdims=True))
    return np.ldexp(v, -e)


def _unit(v: np.ndarray) -> np.ndarray:
    v = _scaled(v)
    return (v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]).astype(np.float32)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of row pairs in double precision."""
    a, b = _scaled(a), _scaled(b)
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a))
                                          * np.sqrt(np.einsum("ij,ij->i", b, b)))


def nodes_of(vectors: DataFrame, k: int, id_col: str, vector_col: str) -> DataFrame:
    """(node, h2, ids, dim, vector) per distinct usable vector: its k + 1 smallest ids.

    ``node`` and ``h2`` are two hashes of the vector; ``node`` is its name.

    Left out: null ids, and vectors that are null, empty, zero or hold null or
    non-finite components.
    """
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.col(vector_col).alias("vector")).where("id IS NOT NULL")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.where((F.size(v) > 0) & ~bad & F.exists(v, lambda c: c != 0))
    rows = rows.select("id", "vector", *_hashes(v))
    per = Window.partitionBy("node", "h2").orderBy("id")
    few = rows.withColumn("i", F.dense_rank().over(per)).where(F.col("i") <= k + 1)
    return few.groupBy("node", "h2").agg(
        F.array_sort(F.collect_set("id")).alias("ids"), F.first("vector").alias("vector")) \
        .select("node", "h2", "ids", F.size("vector").alias("dim"), "vector")


def _hashes(vector) -> tuple:
    return F.xxhash64(vector).alias("node"), F.xxhash64(vector, F.lit(1)).alias("h2")


def build_index(nodes: DataFrame, shard_rows: int = SHARD) -> DataFrame:
    """(dim, shard, node, vector, edges, entry): the graph of every shard."""
    dims = {r["dim"]: -(-r["count"] // shard_rows) for r in nodes.groupBy("dim").count().collect()}
    shards = F.lit(1)
    for d, s in dims.items():
        shards = F.when(F.col("dim") == d, s).otherwise(shards)
    dealt = nodes.select("dim", F.pmod(F.xxhash64("node", "h2"), shards).cast("int").alias("shard"),
                         "node", "vector")

    def build(t: pa.Table) -> pa.Table:
        t = t.sort_by("node")  # the same graph whatever order the rows came in
        nbr, start = build_graph(_unit(_matrix(t.column("vector"))))
        lens = (nbr >= 0).sum(axis=1)
        entry = np.zeros(len(nbr), bool)
        entry[start] = True
        edges = pa.ListArray.from_arrays(pa.array(starts_of(lens), pa.int32()),
                                         pa.array(nbr[nbr >= 0].astype(np.int32)))
        return t.select(["dim", "shard", "node", "vector"]).append_column("edges", edges) \
            .append_column("entry", pa.array(entry))

    kind = dict(nodes.dtypes)["vector"]
    return checkpoint(dealt.groupBy("dim", "shard").applyInArrow(
        build, f"dim int, shard int, node long, vector {kind}, edges array<int>, entry boolean"))


def search(index: DataFrame, queries: DataFrame, keep: int, beam: int = BEAM) -> DataFrame:
    """(query, node, score): each query node's ``keep`` best nodes of every shard.

    ``queries``: (query, dim, vector). Queries meet the shards of their dimension.
    """
    shards = index.groupBy("dim").agg(F.countDistinct("shard").alias("shards"))
    n = queries.count()
    blocks = max(1, -(-n // BLOCK))
    asked = queries.join(shards, "dim").select(
        "dim", F.explode(F.sequence(F.lit(0), F.col("shards").cast("int") - 1)).alias("shard"),
        F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block"), "query", "vector")
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def walk(graph: pa.Table, ask: pa.Table) -> pa.Table:
        empty = pa.table({"query": pa.array([], pa.int64()), "node": pa.array([], pa.int64()),
                          "score": pa.array([], pa.float64())})
        if not len(graph) or not len(ask):
            return empty
        graph = graph.sort_by("node")
        v, node = _matrix(graph.column("vector")), graph.column("node").to_numpy()
        edges = graph.column("edges").combine_chunks()
        lens = edges.value_lengths().to_numpy()
        nbr = np.full((len(v), max(1, int(lens.max()))), -1, np.int64)
        row = np.repeat(np.arange(len(v)), lens)
        nbr[row, np.arange(len(row)) - np.repeat(starts_of(lens)[:-1], lens)] = edges.flatten().to_numpy()
        start = np.flatnonzero(graph.column("entry").to_numpy(zero_copy_only=False))
        x, q = _unit(v), _matrix(ask.column("vector"))
        name = ask.column("query").to_numpy()
        wide = max(beam, min(keep, len(x)))
        out = [[], [], []]
        for a in range(0, len(q), STEP):
            ids, _ = beam_search(x, nbr, start, _unit(q[a:a + STEP]), wide)
            r, c = np.nonzero(ids >= 0)
            at = ids[r, c]
            score = cosine(q[a:a + STEP][r], v[at])
            order = np.lexsort((node[at], -score, r))
            r, at, score = r[order], at[order], score[order]
            head = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
            rank = np.arange(len(r)) - np.repeat(head, np.diff(np.append(head, len(r))))
            top = rank < keep
            out[0].append(name[a:a + STEP][r[top]])
            out[1].append(node[at[top]])
            out[2].append(score[top])
        return pa.table({"query": np.concatenate(out[0]), "node": np.concatenate(out[1]),
                         "score": np.concatenate(out[2])})

    return held.groupBy("dim", "shard", "block").cogroup(asked.groupBy("dim", "shard", "block")) \
        .applyInArrow(walk, "query long, node long, score double")


def nearest(vectors: DataFrame, queries, k: int = 5, shard_rows: int = SHARD, beam: int = BEAM,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where the condition ``queries`` holds.

    Nearest first, ties to the smaller vec_id; every row but those of the query's
    own id is a candidate, within the query's dimension. Fewer than k candidates
    give fewer rows. Unusable vectors (see ``nodes_of``) take no part; repeated
    rows count once per id. Of an id with several vectors, as query or candidate,
    the nearest pair counts.
    """
    nodes = checkpoint(nodes_of(vectors, k, id_col, vector_col))
    index = build_index(nodes, shard_rows)
    usable = vectors.where(queries).select(F.col(id_col).cast("long").alias("query_id"),
                                           F.col(vector_col).alias("vector")) \
        .where("query_id IS NOT NULL AND vector IS NOT NULL")
    own = usable.select("query_id", *_hashes(F.col("vector"))).distinct()
    asked = checkpoint(own.join(nodes.select("node", "h2"), ["node", "h2"]).select("query_id", "node"))
    wanted = nodes.join(asked.select("node").distinct(), "node").select(
        F.col("node").alias("query"), "dim", "vector")
    # k + 1 ids stand in the best (k + 1) * most nodes, if no id stands in more than ``most``.
    per_id = nodes.select(F.explode("ids").alias("id")).groupBy("id").count()
    most = per_id.agg(F.max("count")).first()[0] or 1
    hits = search(index, wanted, (k + 1) * most, beam)
    least = F.element_at("ids", 1)
    named = hits.join(nodes.select("node", "ids"), "node")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), least)
    merged = named.withColumn("i", F.row_number().over(best)).where(F.col("i") <= (k + 1) * most)
    near = merged.select("query", F.explode("ids").alias("vec_id"), "score")
    each = asked.join(near, F.col("node") == F.col("query")).where("vec_id <> query_id") \
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    top = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return each.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
