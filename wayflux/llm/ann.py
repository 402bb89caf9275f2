"""Nearest neighbours by learned partitions: a balanced cut of a neighbour graph, a classifier that routes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayflux.llm.common import Stages, add_column

FIT_ROWS = 16_384
ROWS_PER_PARTITION = 2_000
NEIGHBOURS = 10
CHUNK = 4_096
ROUTED = 0.98


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def unit(m: np.ndarray) -> np.ndarray:
    return m / np.sqrt((m * m).sum(1, keepdims=True)) if len(m) else m


def neighbour_graph(u: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """The k nearest other rows of every row, by blocks."""
    n, k = len(u), min(k, len(u) - 1)
    out = np.zeros((n, max(k, 0)), np.int64)
    f = u.astype(np.float32)
    for a in range(0, n if k > 0 else 0, 512):
        s = f[a : a + 512] @ f.T
        s[np.arange(len(s)), a + np.arange(len(s))] = -2
        top = np.argpartition(-s, k - 1, axis=1)[:, :k]
        out[a : a + 512] = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1, kind="stable"), 1)
    return out


def _halves(u: np.ndarray, v: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Two sides of equal size with few edges (u, v) between them: the slowest mode of a walk on the graph,
    cut at its median, then swaps of pairs of nodes while they save edges."""
    degree = np.bincount(u, minlength=n).astype(float)
    scale = 1 / np.maximum(degree, 1)
    x = rng.normal(size=n)
    total = max(degree.sum(), 1)
    for _ in range(60):
        x = 0.5 * x + 0.5 * np.bincount(u, x[v], n) * scale
        x -= (x * degree).sum() / total
        x /= max(np.abs(x).max(), 1e-12)
    side = np.zeros(n, bool)
    side[np.argsort(x, kind="stable")[n // 2 :]] = True
    for _ in range(12):
        across = np.bincount(u, side[u] != side[v], n)
        gain = 2 * across - degree
        a, b = np.flatnonzero(~side), np.flatnonzero(side)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b))
        good = np.flatnonzero(gain[a[:m]] + gain[b[:m]] > 0)
        if not len(good):
            break
        good = good[: max(1, len(good) // 2)]
        side[a[good]], side[b[good]] = True, False
    return side


def balanced_cut(near: np.ndarray, parts: int, seed: int = 5) -> np.ndarray:
    """Partition of every node of the neighbour graph, `parts` (a power of two) of equal size."""
    n = len(near)
    rng = np.random.default_rng(seed)
    u, v = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    u, v = np.concatenate([u, v]), np.concatenate([v, u])
    part = np.zeros(n, np.int64)
    size = 1
    while size < parts:
        nxt = part * 2
        for p in range(size):
            own = np.flatnonzero(part == p)
            place = np.full(n, -1, np.int64)
            place[own] = np.arange(len(own))
            inside = (place[u] >= 0) & (place[v] >= 0)
            nxt[own] += _halves(place[u[inside]], place[v[inside]], len(own), rng)
        part, size = nxt, size * 2
    return part


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


class Router:
    """One hidden layer from a unit vector to partition probabilities, and how many partitions to ask."""

    def __init__(self, sample: np.ndarray, parts: int, hidden: int = 96, steps: int = 400, seed: int = 9):
        self.parts, self.probes = parts, 1
        if parts == 1:
            return
        u = unit(sample)
        near = neighbour_graph(u)
        cut = balanced_cut(near, parts)
        target = np.zeros((len(u), parts))
        np.add.at(target, (np.arange(len(u)), cut), 1.0)
        for k in range(near.shape[1]):
            np.add.at(target, (np.arange(len(u)), cut[near[:, k]]), 1.0)
        target /= target.sum(1, keepdims=True)
        rng = np.random.default_rng(seed)
        self.w = [rng.normal(0, 1 / np.sqrt(u.shape[1]), (u.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), (hidden, parts)), np.zeros(parts)]
        mean, sq = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        x = u * np.sqrt(u.shape[1])
        for t in range(1, steps + 1):
            rows = rng.integers(0, len(x), min(2048, len(x)))
            h = np.tanh(x[rows] @ self.w[0] + self.w[1])
            d = (_softmax(h @ self.w[2] + self.w[3]) - target[rows]) / len(rows)
            back = (d @ self.w[2].T) * (1 - h * h)
            for k, g in enumerate((x[rows].T @ back, back.sum(0), h.T @ d, d.sum(0))):
                mean[k] = 0.9 * mean[k] + 0.1 * g
                sq[k] = 0.99 * sq[k] + 0.01 * g * g
                self.w[k] = self.w[k] - 0.01 * (1 - t / steps) * (mean[k] / (1 - 0.9**t)) / (np.sqrt(sq[k] / (1 - 0.99**t)) + 1e-9)
        ranked = self.rank(sample)
        place = np.empty_like(ranked)
        np.put_along_axis(place, ranked, np.arange(parts)[None, :].repeat(len(ranked), 0), 1)
        home = ranked[:, 0]
        asked = np.take_along_axis(place, home[near[:, :5]], 1).ravel()  # at which probe a sample row's neighbour turns up
        self.probes = int(np.searchsorted(np.cumsum(np.bincount(asked, minlength=parts)) / max(1, len(asked)), ROUTED)) + 1
        self.probes = min(self.probes, parts)

    def rank(self, vectors: np.ndarray) -> np.ndarray:
        """Partitions of every vector, the most probable first."""
        if self.parts == 1:
            return np.zeros((len(vectors), 1), np.int64)
        x = unit(vectors)
        x = x * np.sqrt(x.shape[1])
        return np.argsort(-(np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]), axis=1, kind="stable")


def usable_vectors(rows: DataFrame, id_col: str, vector: str, keep: Column | None = None) -> DataFrame:
    """(id, v, kept) with v array<double>: no null id, no null or non-finite component, not zero, of the commonest
    length; `kept` says whether `keep` holds."""
    v = F.col(vector).cast("array<double>")
    fine = v.isNotNull() & F.col(id_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    kept = F.coalesce(F.lit(False) if keep is None else keep, F.lit(False))
    good = rows.filter(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), v.alias("v"), kept.alias("kept"))
    size = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.filter(F.size("v") == (size["n"] if size else 0))


def search(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", fit_rows: int = FIT_ROWS, router: Router | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found by cosine for every row where `is_query` holds.

    Fit on at most about `fit_rows` distinct vectors (hash sample); every row is indexed under the partition
    that the classifier gives it, and a query asks its most probable partitions, as many as the sample needs
    for ROUTED of its neighbours. Found rows are ranked by their cosine in double precision, ties to the
    smaller id; the query's own rows (its id) do not count. A query that finds fewer than k goes on to all
    other partitions, so it only returns fewer where there are no more.

    Equal vectors are one entry with their k + 1 smallest ids, since no other of them can be in a result.
    Partitions and their queries are cut in chunks of CHUNK rows. Null ids and vectors that are null, empty,
    zero, of another length than most, or with null or non-finite components take no part; rows that
    repeat an id and a vector are one; an empty table gives no rows.
    """
    spark = rows.sparkSession
    stages = Stages(spark, "ann")
    usable = usable_vectors(rows, id_col, vector, is_query)
    base = usable.select("id", "v").distinct()
    least = Window.partitionBy("h", "v").orderBy("id")
    entries = base.withColumn("h", F.xxhash64("v")).withColumn("n", F.row_number().over(least)).filter(F.col("n") <= k + 1)
    entries = stages.keep(entries.groupBy("h", "v").agg(F.array_sort(F.collect_list("id")).alias("ids")), "entries")
    n = entries.count()
    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    if n == 0:
        return spark.createDataFrame([], schema)
    if router is None:
        share = min(1.0, fit_rows / n)
        got = entries.filter(F.pmod(F.xxhash64("h", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30))).select("h", "v").toArrow().sort_by("h")
        parts = 1 << max(0, int(np.ceil(np.log2(n / ROWS_PER_PARTITION))))
        while parts > 1 and parts * 64 > got.num_rows:
            parts //= 2
        router = Router(_matrix(got["v"]), parts)
    shared = spark.sparkContext.broadcast(router)

    def route(probes: int):
        def make():
            r = shared.value
            return lambda b: pa.array(list(r.rank(_matrix(b.column("v")))[:, :probes].astype(np.int32)), pa.list_(pa.int32()))

        return make

    parts_of = T.ArrayType(T.IntegerType())
    index = add_column(entries, "parts", parts_of, route(1)).select("v", "ids", "h", F.get("parts", F.lit(0)).alias("part"))
    index = stages.keep(index, "index")
    asking = usable.filter("kept").select("id", "v").distinct()
    asking = stages.keep(add_column(asking, "parts", parts_of, route(router.parts)).withColumnRenamed("id", "query_id"), "queries")

    def rerank(entries: pa.Table, asks: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if entries.num_rows and asks.num_rows:
            x, q = _matrix(entries["v"]), _matrix(asks["v"])
            nx, nq = np.sqrt((x * x).sum(1)), np.sqrt((q * q).sum(1))
            ids, own = entries["ids"].to_pylist(), asks["query_id"].to_pylist()
            top = min(k + 1, len(x))
            for a in range(0, len(q), 256):
                s = (q[a : a + 256] @ x.T) / nx
                kth = np.partition(s, len(x) - top, axis=1)[:, len(x) - top]
                for r in range(len(s)):
                    near = np.flatnonzero(s[r] >= kth[r] - 1e-9 * nq[a + r])
                    score = (x[near] * q[a + r]).sum(1) / (nx[near] * nq[a + r])
                    found = sorted((-c, i) for c, e in zip(score.tolist(), near.tolist(), strict=True) for i in ids[e] if i != own[a + r])[:k]
                    out += [(own[a + r], i, -c) for c, i in found]
        return pa.table({"query_id": pa.array([o[0] for o in out], pa.int64()), "vec_id": pa.array([o[1] for o in out], pa.int64()), "score": pa.array([o[2] for o in out], pa.float64())})

    grid = ["part", "chunk", "block"]
    spread = lambda n: F.pmod(F.col("_at"), F.col(n))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def nearest(queries: DataFrame) -> DataFrame:
        """The k nearest entries of the partitions asked by rows (query_id, v, part)."""
        # at most one row per partition of the model
        count = index.groupBy("part").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")).join(queries.groupBy("part").agg(F.ceil(F.count("*") / CHUNK).alias("blocks")), "part")
        left = index.withColumn("_at", F.xxhash64("h")).join(F.broadcast(count), "part").select("part", spread("chunks").alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "v", "ids")
        right = queries.withColumn("_at", F.xxhash64("query_id")).join(F.broadcast(count), "part").select("part", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), spread("blocks").alias("block"), "query_id", "v")
        return left.groupBy(*grid).cogroup(right.groupBy(*grid)).applyInArrow(rerank, "query_id long, vec_id long, score double")

    def ranked(found: DataFrame) -> DataFrame:
        found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(best))
        return found.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    first = asking.select("query_id", "v", F.explode(F.slice("parts", 1, router.probes)).alias("part"))
    found = stages.keep(ranked(nearest(first)), "found")
    if router.probes >= router.parts:
        return found
    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= k)
    more = asking.join(enough, "query_id", "left_anti").select("query_id", "v", F.explode(F.slice("parts", router.probes + 1, router.parts)).alias("part"))
    more = stages.keep(more, "more")
    if more.isEmpty():
        return found
    return ranked(found.drop("rank").unionByName(nearest(more)))
