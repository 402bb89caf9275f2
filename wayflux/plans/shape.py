"""Distances between daily graphs and the mapper skeleton over them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayflux.functions.geo import KM_PER_DEGREE


def transport_cost(a: np.ndarray, b: np.ndarray, cost: np.ndarray) -> float:
    """Smallest cost of moving mass a to mass b, by shortest augmenting paths.

    Mass present in both stays (the cost is a metric), so only surplus and lack take part.
    """
    stay = np.minimum(a, b)
    supply, need = a - stay, b - stay
    src, dst = np.flatnonzero(supply > 1e-15), np.flatnonzero(need > 1e-15)
    if not len(src) or not len(dst):
        return 0.0
    s, d, c = supply[src].copy(), need[dst].copy(), cost[np.ix_(src, dst)]
    flow = np.zeros_like(c)
    for _ in range(4 * c.size + 16):
        if s.sum() <= 1e-13:
            break
        left = np.where(s > 1e-15, 0.0, np.inf)
        right = np.full(len(dst), np.inf)
        via_l, via_r = np.full(len(src), -1), np.full(len(dst), -1)
        for _ in range(len(src) + len(dst)):
            reach = left[:, None] + c
            best = reach.argmin(axis=0)
            new = reach[best, np.arange(len(dst))]
            better = new < right - 1e-12
            right[better], via_r[better] = new[better], best[better]
            back = np.where(flow > 1e-15, right[None, :] - c, np.inf)
            bb = back.argmin(axis=1)
            newl = back[np.arange(len(src)), bb]
            bl = newl < left - 1e-12
            left[bl], via_l[bl] = newl[bl], bb[bl]
            if not better.any() and not bl.any():
                break
        j = int(np.where(d > 1e-15, right, np.inf).argmin())
        if not np.isfinite(right[j]):
            break
        path, amount, end = [], d[j], j
        while True:
            i = int(via_r[j])
            path.append((i, j, 1))
            if via_l[i] < 0:
                amount = min(amount, s[i])
                break
            j = int(via_l[i])
            path.append((i, j, -1))
            amount = min(amount, flow[i, j])
        for p, q, sign in path:
            flow[p, q] += sign * amount
        s[path[-1][0]] -= amount
        d[end] -= amount
    return float((flow * c).sum())


def day_distances(nodes: DataFrame, locations: DataFrame) -> DataFrame:
    """Transport distance in km between the case distributions of every two days.

    Days become one row each (a vector over the areas, uniform when the day is empty); the
    pairs are spread over the cluster by a hash of both days.
    """
    day = nodes.groupBy("day", "node_id").agg(F.sum("num_cases").alias("c"))
    placed = day.join(locations.select("node_id", "lon", "lat"), "node_id")
    vec = placed.groupBy("day").agg(F.array_sort(F.collect_list(F.struct("node_id", "lon", "lat", "c"))).alias("v"))
    left = vec.select(F.col("day").alias("day_a"), F.col("v").alias("va"))
    right = vec.select(F.col("day").alias("day_b"), F.col("v").alias("vb"))
    later = vec.select("day").agg(F.sort_array(F.collect_set("day")).alias("days"))  # list of days
    pairs = (
        left.join(later).select("day_a", "va", F.explode(F.filter("days", lambda x: x > F.col("day_a"))).alias("day_b"))
        .repartition("day_a", "day_b")
        .join(right, "day_b")
    )

    @F.pandas_udf("double")
    def emd(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            xy = np.array([(p["lon"], p["lat"]) for p in x], float)
            cost = np.sqrt(((xy[:, None, :] - xy[None, :, :]) ** 2).sum(axis=2)) * KM_PER_DEGREE
            m, k = np.array([p["c"] for p in x], float), np.array([p["c"] for p in y], float)
            m = np.ones(len(m)) if m.sum() == 0 else m
            k = np.ones(len(k)) if k.sum() == 0 else k
            out.append(transport_cost(m / m.sum(), k / k.sum(), cost))
        return pd.Series(out)

    return pairs.select("day_a", "day_b", emd("va", "vb").alias("distance"))


def interval_cover(values: DataFrame, filters: dict[str, int], overlap: float = 0.4) -> DataFrame:
    """Days in every overlapping interval (or box of intervals) of their filter values: (bin, day)."""
    stats = values.agg(*[f(c).alias(f"{n}_{c}") for c in filters for n, f in (("lo", F.min), ("hi", F.max))])
    out = values.select("day", *filters).join(stats)  # one-row side
    parts = []
    for c, k in filters.items():
        length = (F.col(f"hi_{c}") - F.col(f"lo_{c}")) / (k - (k - 1) * overlap)
        step = length * (1 - overlap)
        lo = F.col(f"lo_{c}")
        hits = F.filter(
            F.sequence(F.lit(0), F.lit(k - 1)),
            lambda i: (F.col(c) >= lo + i * step - 1e-9) & (F.col(c) <= lo + i * step + length + 1e-9),
        )
        out = out.withColumn(f"_b_{c}", F.explode(hits))
        parts.append(F.col(f"_b_{c}").cast("string"))
    return out.select(F.concat_ws(":", *parts).alias("bin"), "day")


def average_linkage(dist: np.ndarray, height: float) -> np.ndarray:
    """Cluster numbers from average linkage, cut at the height."""
    n = len(dist)
    groups = [[i] for i in range(n)]
    d = dist.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    while len(groups) > 1:
        i, j = divmod(int(d.argmin()), len(groups))
        if d[i, j] > height:
            break
        i, j = min(i, j), max(i, j)
        a, b = len(groups[i]), len(groups[j])
        merged = (a * d[i] + b * d[j]) / (a + b)
        groups[i] += groups.pop(j)
        d[i], d[:, i] = merged, merged
        d[i, i] = np.inf
        d = np.delete(np.delete(d, j, axis=0), j, axis=1)
    out = np.zeros(n, int)
    for g, members in enumerate(sorted(groups, key=min)):
        out[members] = g
    return out


def mapper_nodes(values: DataFrame, distances: DataFrame, filters: dict[str, int], overlap: float = 0.4, height: float = 70.0) -> DataFrame:
    """(node, day): clusters of days inside each interval of the cover, one interval per task."""
    cover = interval_cover(values, filters, overlap)
    both = distances.unionByName(distances.select(F.col("day_b").alias("day_a"), F.col("day_a").alias("day_b"), "distance"))
    a = cover.select("bin", F.col("day").alias("day_a"))
    b = cover.select("bin", F.col("day").alias("day_b"))
    inside = both.join(a, "day_a").join(b, ["bin", "day_b"])
    alone = cover.select("bin", F.col("day").alias("day_a"), F.col("day").alias("day_b"), F.lit(0.0).alias("distance"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        days = np.sort(pdf["day_a"].unique())
        at = {d: i for i, d in enumerate(days)}
        m = np.zeros((len(days), len(days)))
        m[pdf["day_a"].map(at), pdf["day_b"].map(at)] = pdf["distance"]
        lab = average_linkage(m, height)
        return pd.DataFrame({"node": [f"{pdf['bin'].iloc[0]}/{k}" for k in lab], "day": days})

    return inside.select("bin", "day_a", "day_b", "distance").unionByName(alone).groupBy("bin").applyInPandas(run, "node string, day long")


def mapper_edges(nodes: DataFrame) -> DataFrame:
    """Pairs of clusters that share a day."""
    other = nodes.select(F.col("node").alias("node_b"), "day")
    return nodes.withColumnRenamed("node", "node_a").join(other, "day").filter("node_a < node_b").groupBy("node_a", "node_b").agg(F.count("*").alias("shared_days"))
