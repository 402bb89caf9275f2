"""Mixing overlapping sources to target weights by a min-cost flow over membership patterns."""

from __future__ import annotations

from bisect import bisect_left
from collections import deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PATTERNS = 200_000
ROWS_PER_CUT = 4096


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; null has none."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.coalesce(F.when(F.octet_length(bare) == 0, F.lit(0)).otherwise(F.size(F.split(bare, "[ \t-\r]+"))), F.lit(0)).cast("long")


def shares(sizes: dict, weights: dict, total: float, most: float) -> dict:
    """Shares of `total` by weight; none above `most` times its size, the excess going to the others by weight."""
    left, open_, out = float(total), {s for s in sizes if weights.get(s, 0) > 0}, dict.fromkeys(sizes, 0.0)
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if unit * weights[s] > most * sizes[s]}
        if not full:
            for s in open_:
                out[s] = unit * weights[s]
            break
        for s in full:
            out[s] = most * float(sizes[s])
            left -= out[s]
        open_ -= full
    return out


def min_cost_flow(patterns: list[tuple[int, tuple[int, ...]]], quotas: list[float], costs: list[float]) -> list[dict[int, float]]:
    """Words that each pattern (its size, the sources its documents belong to) sends to each source.

    Arcs: start -> pattern once per repetition, each with the pattern's size and a cost that rises with the
    repetition; pattern -> its sources; source -> end with its quota. Costs sit on the first arcs only, so
    shortest augmenting paths come in the order of the costs: opening the repetitions from the cheapest on
    and augmenting to a maximum flow each time (blocking flows on level graphs) gives a flow of largest
    size and, among those, of least cost.
    """
    n, m = len(patterns), len(quotas)
    begin, finish = n + m, n + m + 1
    to: list[int] = []
    room: list[float] = []
    arcs: list[list[int]] = [[] for _ in range(n + m + 2)]

    def arc(u: int, v: int, capacity: float) -> int:
        arcs[u].append(len(to))
        to.append(v)
        room.append(capacity)
        arcs[v].append(len(to))
        to.append(u)
        room.append(0.0)
        return len(to) - 2

    first = [arc(begin, p, 0.0) for p in range(n)]
    middle = [[(s, arc(p, n + s, float("inf"))) for s in own] for p, (_, own) in enumerate(patterns)]
    for s, quota in enumerate(quotas):
        arc(n + s, finish, quota)
    least = 1e-6
    for _ in sorted(costs):
        for p, (size, _) in enumerate(patterns):
            room[first[p]] += size
        while True:
            level = [-1] * (n + m + 2)
            level[begin] = 0
            queue = deque([begin])
            while queue:
                u = queue.popleft()
                for a in arcs[u]:
                    if room[a] > least and level[to[a]] < 0:
                        level[to[a]] = level[u] + 1
                        queue.append(to[a])
            if level[finish] < 0:
                break
            at = [0] * (n + m + 2)
            path: list[int] = []
            u = begin
            while True:
                if u == finish:
                    push = min(room[a] for a in path)
                    for a in path:
                        room[a] -= push
                        room[a ^ 1] += push
                    cut = next(k for k, a in enumerate(path) if room[a] <= least)
                    u = to[path[cut] ^ 1]
                    del path[cut:]
                    continue
                while at[u] < len(arcs[u]):
                    a = arcs[u][at[u]]
                    if room[a] > least and level[to[a]] == level[u] + 1:
                        break
                    at[u] += 1
                if at[u] < len(arcs[u]):
                    path.append(arcs[u][at[u]])
                    u = to[path[-1]]
                elif path:
                    u = to[path.pop() ^ 1]
                    at[u] += 1
                else:
                    break
    return [{s: room[a ^ 1] for s, a in own if room[a ^ 1] > least} for own in middle]


def fill_gap(sizes: list[int], taken: list[int], gap: int, turns: int = 8) -> int:
    """Bring what is taken nearer to its target, `gap` words away: take one more document, or one in place of
    another, while that lessens the distance. Changes `taken`, returns the gap that is left."""
    for _ in range(turns):
        ins = sorted((x, k) for k, x in enumerate(sizes) if x and not taken[k])
        outs = [(0, -1)] + [(x, k) for k, x in enumerate(taken) if x]
        best = (abs(gap), -1, -1)
        for x, k in outs if ins else []:
            at = bisect_left(ins, (x + gap, -1))
            for y, j in ins[max(0, at - 1) : at + 1]:
                best = min(best, (abs(gap - (y - x)), j, k))
        if best[1] < 0 or best[0] >= abs(gap):
            break
        _, j, k = best
        taken[j] = sizes[j]
        gap -= sizes[j]
        if k >= 0:
            gap += taken[k]
            taken[k] = 0
    return gap


def mix_sources(docs: DataFrame, members: Column, weights, size: Column, key: list[str], into: str = "taken", repeats: int = 3, total: float | None = None, seed: int = 11) -> tuple[DataFrame, dict, dict]:
    """Documents with the words that the mix takes of each, source sizes, and source targets.

    `members`: array of the names of the sources that a document belongs to (repeats and order do not
    matter); `weights(sources)`: their weights; `size`: words; `key`: columns that seed the choice. The mix
    has `total` words (default: all sizes), shared by weight, at most `repeats` times a source's size.
    Documents are summed by membership pattern, and the flow routes patterns to quotas: a repetition
    costs more than the one before. A pattern's share is whole repetitions of all its documents, then
    documents in an order seeded by the key until it is used up.

    That order is cut into stretches of about `ROWS_PER_CUT` rows by a hash; stretches before the cut are
    taken, and in the stretch of the cut a document is taken if it still fits, with a few swaps at the end. `into` is a multiple of size.
    A null size is 0 words, a null or empty member list belongs to no source and is never taken; equal rows
    are chosen one by one; an empty table gives no rows. Patterns, a few per source, are brought to the
    driver: more than MAX_PATTERNS is an error.
    """
    spark = docs.sparkSession
    pat, words, place, rank = "pattern", "size", "place", "rank"
    sources = F.array_sort(F.array_distinct(F.coalesce(members, F.array().cast("array<string>"))))
    rows = docs.select(F.struct(*docs.columns).alias("row"), sources.alias(pat), F.coalesce(size.cast("long"), F.lit(0)).alias(words), F.xxhash64(F.lit(seed), *key).alias("_h"))
    found = rows.groupBy(pat).agg(F.sum(words).alias("size"), F.count("*").alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    found.sort(key=lambda r: [(m is None, m or "") for m in r[pat]])
    names = sorted({m for r in found for m in r[pat]}, key=lambda m: (m is None, m or ""))
    sizes = {s: sum(r["size"] for r in found if s in r[pat]) for s in names}
    everything = float(sum(r["size"] for r in found if len(r[pat]))) if total is None else total
    targets = shares(sizes, weights(names), everything, repeats)
    number = {s: k for k, s in enumerate(names)}
    flow = min_cost_flow([(r["size"], tuple(number[s] for s in r[pat])) for r in found], [targets[s] for s in names], [float(k * k) for k in range(repeats)])
    plan = []
    for r, sent in zip(found, flow, strict=True):
        words_sent = min(sum(sent.values()), float(repeats * r["size"]))
        whole = int(words_sent // r["size"]) if r["size"] else 0
        plan.append((r[pat], whole, int(round(words_sent - whole * r["size"])), max(1, -(-r["n"] // ROWS_PER_CUT))))
    table = spark.createDataFrame(plan, f"`{pat}` array<string>, whole long, rest long, cuts long")
    # the null source is a name too, so patterns are compared as one text
    name = F.array_join(F.transform(pat, lambda m: F.coalesce(F.concat(F.length(m).cast("string"), F.lit(":"), m), F.lit("-"))), "")
    table = table.withColumn(rank, name).drop(pat)
    rows = rows.withColumn(rank, name)
    seeded = rows.join(F.broadcast(table), rank).withColumn(place, F.pmod(F.col("_h"), F.col("cuts")))
    per_stretch = seeded.groupBy(rank, place).agg(F.sum(words).alias("_n"), F.first("rest").alias("_rest"))
    before = per_stretch.withColumn("_before", F.sum("_n").over(_running(rank, place)) - F.col("_n"))
    cut = before.filter((F.col("_before") <= F.col("_rest")) & (F.col("_before") + F.col("_n") > F.col("_rest"))).groupBy(rank).agg(F.min(place).alias("_cut"), F.max("_before").alias("_b"))
    # patterns whose rest takes every stretch do not occur: the rest is below the pattern's size
    placed = seeded.join(F.broadcast(cut), rank, "left")
    left = F.col("rest") - F.col("_b")
    out_cols = ["row"]
    took = (F.col("whole") + F.when(F.col(place) < F.col("_cut"), 1).otherwise(0)) * F.col(words)
    plain = placed.filter(F.coalesce(F.col(place) != F.col("_cut"), F.lit(True))).select(*out_cols, took.alias("taken"))
    edge = placed.filter(F.col(place) == F.col("_cut")).withColumn("_left", left)
    schema = edge.select(*out_cols).schema.add("taken", "long")

    def fill(group: pa.Table) -> pa.Table:
        group = group.sort_by([("_h", "ascending"), (words, "ascending")])
        n = group[words].to_pylist()
        gap, taken = group["_left"][0].as_py(), []
        for x in n:
            taken.append(x if x <= gap else 0)
            gap -= taken[-1]
        gap = fill_gap(n, taken, gap)
        both = [w * x + t for w, x, t in zip(group["whole"].to_pylist(), n, taken, strict=True)]
        return group.select(out_cols).append_column("taken", pa.array(both, pa.int64()))

    both = plain.unionByName(edge.groupBy(rank).applyInArrow(fill, schema))
    return both.select(*(F.col("row")[c].alias(c) for c in docs.columns if c != into), F.col("taken").alias(into)), sizes, targets


def _running(part: str, order: str):
    from pyspark.sql import Window

    return Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def cycled(names: list) -> dict:
    """Weights 1, 2, 3, 1, 2, 3, … in the order of the names."""
    return {s: k % 3 + 1 for k, s in enumerate(names)}
