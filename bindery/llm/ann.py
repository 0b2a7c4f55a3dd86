"""Approximate nearest neighbours by inner product over robust-pruned directed graphs.

Vectors are dealt into cells around pivots, and cells into shards of bounded size; each shard builds one
graph in a task and hands it on as a single row. Greedy searches propose a vector's neighbours; relaxed
distance pruning keeps an edge only if no kept neighbour is nearer to its end by the factor ALPHA, which
leaves diverse edges. A beam search then answers a query on each shard of the cells nearest to it, and the
shards' answers are merged per query. Inner product becomes distance by one more dimension that gives all
vectors of a shard the same length. Equal vectors are one node that lists the ids which any answer can need.

How many cells a query visits is measured, not guessed: exact neighbours of a bounded sample of the
queries, from one pass over all vectors, tell how many of the nearest cells hold the share COVERAGE of them.
Vectors without any structure so visit all cells; with it, work grows with the vectors, not with their square.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bindery.llm.common import cut, pieces_for, table

SHARD, DEGREE, BUILD_BEAM, BEAM, ALPHA, QUERY_BLOCK, ENTRIES, BATCH = 8192, 24, 40, 64, 1.2, 2048, 8, 256
#: Pivots are fitted on at most CELLS * PER_CELL vectors; larger cells are split into shards. ASKED queries measure how many cells to visit.
CELLS, PER_CELL, ASKED, COVERAGE, SALTS = 4096, 32, 128, 0.98, 64


def beam_search(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances (less inner product is farther) of the beam of each query, all queries in step."""
    n, width = len(q), max(width, len(entries))
    rows = np.arange(n)
    ids = np.full((n, width), -1, np.int64)
    dist = np.full((n, width), np.inf, np.float32)
    ids[:, : len(entries)] = entries
    dist[:, : len(entries)] = -(q @ x[entries].T)
    done = np.zeros((n, width), bool)
    live = rows
    while live.size:
        d = np.where(done[live], np.inf, dist[live])
        pick = d.argmin(1)
        some = np.isfinite(d[np.arange(len(live)), pick])
        live, pick = live[some], pick[some]
        if not live.size:
            break
        done[live, pick] = True
        near = graph[ids[live, pick]]
        gap = -np.einsum("bd,brd->br", q[live], x[near])
        gap[(near < 0) | (near[:, :, None] == ids[live][:, None, :]).any(2)] = np.inf
        all_d, all_i = np.concatenate([dist[live], gap], 1), np.concatenate([ids[live], near], 1)
        all_done = np.concatenate([done[live], np.zeros_like(near, bool)], 1)
        order = np.argsort(all_d, 1, kind="stable")[:, :width]
        dist[live], ids[live], done[live] = (np.take_along_axis(a, order, 1) for a in (all_d, all_i, all_done))
    return ids, dist


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to `degree` diverse neighbours of each point out of its candidates (-1: none)."""
    d = np.einsum("bcd,bcd->bc", x[candidates] - x[points][:, None, :], x[candidates] - x[points][:, None, :])
    first = np.sort(candidates, 1)
    d[(candidates < 0) | (candidates == points[:, None])] = np.inf
    order = np.argsort(candidates, 1, kind="stable")
    again = np.zeros_like(candidates, bool)
    np.put_along_axis(again, order[:, 1:], first[:, 1:] == first[:, :-1], 1)
    d[again] = np.inf
    out = np.full((len(points), degree), -1, np.int64)
    rows = np.arange(len(points))
    for k in range(degree):
        pick = d.argmin(1)
        alive = np.isfinite(d[rows, pick])
        if not alive.any():
            break
        chosen = candidates[rows, pick]
        out[alive, k] = chosen[alive]
        between = x[candidates] - x[chosen][:, None, :]
        d[np.einsum("bcd,bcd->bc", between, between) * alpha * alpha <= d] = np.inf
        d[rows, pick] = np.inf
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(graph, entries) of vectors of equal length."""
    n, rng = len(x), np.random.default_rng(seed)
    if n <= degree + 1:
        return np.array([[j for j in range(n) if j != i] + [-1] * (degree - n + 1) for i in range(n)], np.int64).reshape(n, degree), np.arange(n)
    graph = np.full((n, degree), -1, np.int64)
    graph[:, : degree // 2] = rng.integers(0, n, (n, degree // 2))
    entries = np.unique(np.r_[np.argmax(x @ x.mean(0)), rng.choice(n, min(n, ENTRIES), replace=False)])
    for a in (1.0, alpha):
        order = rng.permutation(n)
        for s in range(0, n, BATCH):
            p = order[s : s + BATCH]
            ids, _ = beam_search(x, graph, entries, x[p], beam)
            graph[p] = robust_prune(x, p, np.concatenate([ids, graph[p]], 1), degree, a)
            # Each new edge is offered back; a full node prunes its neighbours together with what was offered.
            ends, starts = graph[p].reshape(-1), np.repeat(p, degree)
            ends, starts = ends[ends >= 0], starts[graph[p].reshape(-1) >= 0]
            by = np.argsort(ends, kind="stable")
            ends, starts = ends[by], starts[by]
            nodes, at, size = np.unique(ends, return_index=True, return_counts=True)
            offered = np.full((len(nodes), int(size.max(initial=0))), -1, np.int64)
            offered[np.repeat(np.arange(len(nodes)), size), np.arange(len(ends)) - np.repeat(at, size)] = starts
            graph[nodes] = robust_prune(x, nodes, np.concatenate([graph[nodes], offered], 1), degree, a)
    return graph, entries


def _lifted(x: np.ndarray) -> np.ndarray:
    square = (x.astype(np.float64) ** 2).sum(1)
    return np.c_[x, np.sqrt(np.maximum(square.max() - square, 0))].astype(np.float32)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.iloc[np.argsort(pdf["ids"].map(lambda i: i[0]).to_numpy(np.int64))]
    vectors = np.array(pdf["v"].tolist(), np.float64)
    graph, entries = build_graph(_lifted(vectors / max(np.abs(vectors).max(), 1e-300)))
    sizes = pdf["ids"].map(len).to_numpy(np.int64)
    packed = {"ids": np.concatenate(pdf["ids"].tolist()).astype(np.int64), "sizes": sizes, "vectors": vectors, "graph": graph.astype(np.int32), "entries": entries.astype(np.int64)}
    return pd.DataFrame({**{c: pdf[c].iloc[:1].to_numpy() for c in SHARD_KEY}, **{c: [a.tobytes()] for c, a in packed.items()}})


SHARD_KEY = ["dim", "cell", "sub"]
BUILT = "dim int, cell int, sub int, ids binary, sizes binary, vectors binary, graph binary, entries binary"


def _search(k: int, beam: int):
    def run(shards: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        if shards.empty or queries.empty:
            return empty
        s = shards.iloc[0]
        ids, sizes = np.frombuffer(s["ids"], np.int64), np.frombuffer(s["sizes"], np.int64)
        x = np.frombuffer(s["vectors"]).reshape(len(sizes), -1)
        graph = np.frombuffer(s["graph"], np.int32).reshape(len(sizes), -1).astype(np.int64)
        scale = max(np.abs(x).max(), 1e-300)
        lifted, entries, start = _lifted(x / scale), np.frombuffer(s["entries"], np.int64), np.cumsum(sizes) - sizes
        own, q = queries["vec_id"].to_numpy(np.int64), np.array(queries["v"].tolist(), np.float64)
        out = []
        for b in range(0, len(q), BATCH):
            part = q[b : b + BATCH]
            unit = part / np.maximum(np.abs(part).max(1, keepdims=True), 1e-300)
            found, _ = beam_search(lifted, graph, entries, np.c_[unit, np.zeros(len(part))].astype(np.float32), max(beam, k + 1))
            rows, cols = np.nonzero(found >= 0)
            node = found[rows, cols]
            score = np.einsum("nd,nd->n", part[rows], x[node])
            best = np.lexsort((-score, rows))
            rows, node, score = rows[best], node[best], score[best]
            rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
            rows, node, score = rows[rank <= k], node[rank <= k], score[rank <= k]
            take = sizes[node]
            at = np.repeat(start[node], take) + np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)
            out.append(pd.DataFrame({"query_id": own[b : b + BATCH][np.repeat(rows, take)], "vec_id": ids[at], "score": np.repeat(score, take)}))
        got = pd.concat(out)
        got = got[got["query_id"] != got["vec_id"]].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return got.groupby("query_id").head(k)[["query_id", "vec_id", "score"]]

    return run


def _floats(batches):
    """dim, v -> dim, v as single-precision bytes."""
    for batch in batches:
        v = batch.column(1)
        flat, at = v.values.to_numpy(zero_copy_only=False).astype(np.float32), v.offsets.to_numpy()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([flat[at[k] : at[k + 1]].tobytes() for k in range(len(v))], pa.binary())], names=["dim", "v"])


def pivots_of(sample: np.ndarray, cells: int, rounds: int = 6, seed: int = 11) -> np.ndarray:
    """Centres of `cells` groups of a sample, by a few rounds of k-means."""
    centres = sample[np.sort(np.random.default_rng(seed).permutation(len(sample))[:cells])].astype(np.float32)
    for _ in range(rounds if len(centres) > 1 else 0):
        own = cell_of(sample, centres)
        n = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def cell_of(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row."""
    half = (centres.astype(np.float64) ** 2).sum(1) / 2
    return np.concatenate([(x[s : s + 4096] @ centres.T - half).argmax(1) for s in range(0, len(x), 4096)]) if len(x) else np.empty(0, np.int64)


class Cells:
    """Pivots by the length of vectors; lengths without pivots have one cell."""

    def __init__(self, sample: list[tuple[int, bytes]], cells: int):
        by: dict[int, list[np.ndarray]] = {}
        for dim, v in sample:
            by.setdefault(dim, []).append(np.frombuffer(v, np.float32))
        self.pivots = {dim: pivots_of(np.array(v), max(1, round(cells * len(v) / len(sample)))) for dim, v in by.items()}

    def own(self, rows: list[np.ndarray]) -> np.ndarray:
        """The cell of each vector."""
        return self._by_dim(rows, lambda x, p: cell_of(x, p))

    def order(self, q: np.ndarray) -> np.ndarray:
        """Cells by the inner product of their pivots with a query, largest first."""
        p = self.pivots.get(len(q))
        return np.array([0]) if p is None else np.argsort(-(p @ q.astype(np.float32)), kind="stable")

    def _by_dim(self, rows: list[np.ndarray], f) -> np.ndarray:
        out, dims = np.zeros(len(rows), np.int32), np.array([len(r) for r in rows])
        for dim in np.unique(dims):
            if int(dim) in self.pivots:
                at = np.flatnonzero(dims == dim)
                out[at] = f(np.array([rows[k] for k in at], np.float32), self.pivots[int(dim)])
        return out


def _exact(asked: list[tuple[int, np.ndarray]], cells: Cells, k: int):
    """The k best vectors of a task for each of a few queries, with their cells."""

    def run(batches):
        by: dict[int, list[tuple[int, np.ndarray]]] = {}
        for q in asked:
            by.setdefault(len(q[1]), []).append(q)
        best: dict[int, list[tuple[float, int]]] = {i: [] for i, _ in asked}
        for batch in batches:
            rows = [np.array(v) for v in batch.column(0).to_pylist()]
            own, dims = cells.own(rows), np.array([len(r) for r in rows])
            for dim, queries in by.items():
                at = np.flatnonzero(dims == dim)
                if len(at):
                    scores = np.array([q for _, q in queries]) @ np.array([rows[j] for j in at]).T
                    for (i, _), s in zip(queries, scores, strict=True):
                        top = np.argsort(-s)[: k + 1]
                        best[i] = sorted([*best[i], *((-float(s[j]), int(own[at[j]])) for j in top)])[: k + 1]
        rows = [(i, -s, c) for i, found in best.items() for s, c in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.float64(), pa.int32()))], names=["query_id", "score", "cell"])

    return run


def _visits(distinct: DataFrame, asked: DataFrame, cells: Cells, k: int, coverage: float) -> dict[int, int]:
    """How many of the nearest cells a query of each length visits, and one more than the sample needs."""
    some = [(r["vec_id"], np.array(r["v"])) for r in asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(ASKED).collect()]
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "cell")
    found = distinct.select("v").mapInArrow(_exact(some, cells, k), "query_id bigint, score double, cell int").withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1).collect()  # ASKED * (k + 1) rows
    place = {i: {int(c): n for n, c in enumerate(cells.order(q))} for i, q in some}
    dims = {i: len(q) for i, q in some}
    out = {}
    for dim, p in cells.pivots.items():
        depth = np.sort([place[r["query_id"]][r["cell"]] for r in found if dims[r["query_id"]] == dim])
        out[dim] = min(len(p), int(depth[max(0, math.ceil(coverage * len(depth)) - 1)]) + 2) if len(depth) else len(p)
    return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD, beam: int = BEAM, coverage: float = COVERAGE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query by inner product, ties to smaller ids.

    Vectors that are null, empty or zero, hold null or non-finite components, or have a null id take no
    part; of several vectors with one id the smallest does. Vectors are compared with queries of their
    length only. A query's own id is never its neighbour. A query visits at least as many cells as hold k + 1
    different vectors, if there are so many. Other columns are not read, whatever their names. Empty tables
    give no rows.
    """

    def usable(df: DataFrame) -> DataFrame:
        v = F.col(vector_col).cast("array<double>")
        fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & F.exists(v, lambda c: c != 0)
        return df.where(F.col(id_col).isNotNull() & fine).groupBy(F.col(id_col).cast("long").alias("vec_id")).agg(F.min(v).alias("v")).withColumn("dim", F.size("v"))

    # Of equal vectors the k + 1 smallest ids suffice: ties go to smaller ids and one may be the query's own. Salts first.
    ranked = usable(vectors).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    for by in (["v", "salt"], ["v"]):
        ranked = ranked.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("vec_id"))).where(F.col("r") <= k + 1)
    distinct = cut(ranked.groupBy("v", "dim").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    asked = cut(usable(queries))
    n = distinct.count()
    wanted = min(CELLS, pieces_for(n, shard, 1))
    sample = distinct.orderBy(F.xxhash64("v"), F.element_at("ids", 1)).limit(wanted * PER_CELL if wanted > 1 else 0)
    cells = Cells([tuple(r) for r in sample.select("dim", "v").mapInArrow(_floats, "dim int, v binary").collect()], wanted)
    own_cell = F.pandas_udf(lambda v: pd.Series(cells.own(v.tolist())), "int")
    placed = distinct.withColumn("cell", own_cell("v"))
    sizes = {(r["dim"], r["cell"]): r["count"] for r in placed.groupBy("dim", "cell").count().collect()}  # one row a cell
    visits = _visits(distinct, asked, cells, k, coverage) if wanted > 1 else {}
    subs = lambda dim, cell: -(-sizes.get((dim, cell), 0) // shard)

    def routed(v: pd.Series) -> pd.Series:
        out = []
        for q in v:
            shards, held, dim = [], 0, len(q)
            for place, c in enumerate(cells.order(q).tolist()):
                if place >= visits.get(dim, 1) and held > k:
                    break
                held += sizes.get((dim, c), 0)
                shards += [{"cell": c, "sub": s} for s in range(subs(dim, c))]
            out.append(shards)
        return pd.Series(out)

    sub = F.pandas_udf(lambda dim, cell, h: pd.Series([x % max(1, subs(d, c)) for d, c, x in zip(dim, cell, h, strict=True)]), "int")
    dealt = placed.withColumn("sub", sub("dim", "cell", F.xxhash64("v").bitwiseAND((1 << 62) - 1)))
    built = dealt.groupBy(*SHARD_KEY).applyInPandas(_build, BUILT)
    route = F.pandas_udf(routed, "array<struct<cell:int,sub:int>>")
    going = asked.withColumn("to", F.explode(route("v"))).select("vec_id", "v", "dim", "to.cell", "to.sub")
    blocks = going.groupBy(*SHARD_KEY).agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks"))
    going = going.join(blocks, SHARD_KEY).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).drop("blocks")
    built = built.join(blocks, SHARD_KEY).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    keys = [*SHARD_KEY, "block"]
    found = built.groupBy(*keys).cogroup(going.groupBy(*keys)).applyInPandas(_search(k, beam), "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))
