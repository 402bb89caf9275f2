"""Daily origin–destination graphs, their summaries, page rank and community detection."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayflux.session import cut_lineage


def shared_span(cases: DataFrame, flows: DataFrame) -> DataFrame:
    """One row: days both tables cover, and the first case day."""
    c = cases.agg(F.min("date_time").alias("c0"), F.max("date_time").alias("c1"))
    m = flows.agg(F.min("date_time").alias("m0"), F.max("date_time").alias("m1"))
    return c.crossJoin(m).select(  # one row each
        F.greatest("c0", "m0").alias("first_date"), F.least("c1", "m1").alias("last_date"), F.col("c0").alias("first_case")
    )


def build_nodes(polygons: DataFrame, cases: DataFrame, flows: DataFrame, population: DataFrame | None = None) -> DataFrame:
    """One row per area and day: cases, population and inner flow.

    Cases and inner flow are two tags of one grouping, so that a single shuffle on
    (area, day) serves both; the calendar grid is the third tag.
    """
    span = shared_span(cases, flows)
    grid = polygons.select(F.col("poly_id").alias("node_id")).crossJoin(span).select(  # one-row side
        "node_id", F.explode(F.sequence("first_date", "last_date")).alias("date_time"),
        F.lit(None).cast("double").alias("c"), F.lit(None).cast("double").alias("m"), F.lit(None).cast("double").alias("p"),
        F.lit(1).alias("g"),
    )
    null = F.lit(None).cast("double")
    c = cases.select(F.col("poly_id").alias("node_id"), "date_time", F.col("num_cases").alias("c"), null.alias("m"), null.alias("p"), F.lit(0).alias("g"))
    m = flows.filter("start_poly_id = end_poly_id").select(
        F.col("end_poly_id").alias("node_id"), "date_time", null.alias("c"), F.col("movement").alias("m"), null.alias("p"), F.lit(0).alias("g")
    )
    parts = grid.unionByName(c).unionByName(m)
    if population is not None:
        parts = parts.unionByName(
            population.select(F.col("poly_id").alias("node_id"), "date_time", null.alias("c"), null.alias("m"), F.col("population").alias("p"), F.lit(0).alias("g"))
        )
    return (
        parts.groupBy("date_time", "node_id")
        .agg(F.sum("c").alias("c"), F.sum("p").alias("population"), F.sum("m").alias("inner_movement"), F.max("g").alias("g"))
        .filter("g = 1")
        .crossJoin(span.select("first_case"))
        .select(
            "date_time", F.datediff("date_time", "first_case").cast("bigint").alias("day"), "node_id",
            F.coalesce("c", F.lit(0.0)).alias("num_cases"), "population", "inner_movement",
        )
    )


def build_edges(cases: DataFrame, flows: DataFrame) -> DataFrame:
    span = shared_span(cases, flows)
    return (
        flows.filter("start_poly_id <> end_poly_id")
        .groupBy("date_time", F.col("start_poly_id").alias("start_id"), F.col("end_poly_id").alias("end_id"))
        .agg(F.sum("movement").alias("movement"))
        .join(span, F.col("date_time").between(F.col("first_date"), F.col("last_date")))
        .select("date_time", F.datediff("date_time", "first_case").cast("bigint").alias("day"), "start_id", "end_id", "movement")
    )


def node_locations(polygons: DataFrame) -> DataFrame:
    return polygons.select(
        F.col("poly_id").alias("node_id"), F.col("poly_name").alias("node_name"),
        F.col("poly_lon").alias("lon"), F.col("poly_lat").alias("lat"),
    )


def build_graphs(polygons, cases, flows, population=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    return build_nodes(polygons, cases, flows, population), build_edges(cases, flows), node_locations(polygons)


def graph_values(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    inner = nodes.groupBy("day").agg(
        F.coalesce(F.sum("inner_movement"), F.lit(0.0)).alias("inner_movement"), F.sum("num_cases").alias("cases")
    )
    outer = edges.groupBy("day").agg(F.sum("movement").alias("external_movement"))
    return inner.join(outer, "day", "left").na.fill(0.0)


def _arcs(edges: DataFrame, keys: list[str], rows_per_task: int) -> DataFrame:
    """Both directions of the undirected edges with the share of the source's strength.

    A source with very many arcs gets several salts, so that joining its rank with its
    arcs is spread over as many tasks.
    """
    both = edges.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("id1").alias("src"), F.col("id2").alias("dst")),
                F.struct(F.col("id2").alias("src"), F.col("id1").alias("dst")),
            )
        ).alias("a"),
        "weight",
    ).select(*keys, "a.src", "a.dst", "weight")
    both = both.groupBy(*keys, "src", "dst").agg(F.sum("weight").alias("weight"))
    size = both.groupBy(*keys, "src").agg(
        F.sum("weight").alias("strength"), F.ceil(F.count("*") / rows_per_task).cast("int").alias("salts")
    )
    return both.join(size, [*keys, "src"]).select(
        *keys, "src", "dst", (F.col("weight") / F.col("strength")).alias("share"), "salts",
        F.pmod(F.xxhash64("dst"), F.col("salts")).cast("int").alias("salt"),
    )


def _chebyshev(source: np.ndarray, inflow: Callable[[np.ndarray], np.ndarray], tolerance: float, damping: float) -> np.ndarray:
    """The rank that equals source + damping * inflow(rank), to the tolerance; checked every five rounds."""
    rank, before, omega, done = source, np.zeros(len(source)), 1.0, 0
    while len(source):
        rank, before = omega * (damping * inflow(rank) + source - before) + before, rank
        omega = 1 / (1 - damping**2 / (2 if done == 0 else 4 / omega))
        done += 1
        if done % 5 == 0 and np.abs(rank - before).max() <= tolerance * rank.max():
            break
    return rank


def _rank_small(base: DataFrame, arcs: DataFrame, keys: list[str], tolerance: float, damping: float) -> DataFrame:
    """(keys, identifier, rank) of slices whose arcs fit one task: each goes all its rounds in one place."""
    schema = T.StructType([*(base.schema[k] for k in [*keys, "identifier"]), T.StructField("rank", T.DoubleType())])

    def run(nodes: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        at = pd.Index(nodes["identifier"])
        src, dst = at.get_indexer(links["src"]), at.get_indexer(links["dst"])
        known = (src >= 0) & (dst >= 0)
        src, dst, share = src[known], dst[known], links["share"].to_numpy()[known]
        rank = _chebyshev(nodes["source"].to_numpy(), lambda r: np.bincount(dst, r[src] * share, len(nodes)), tolerance, damping)
        return nodes[[*keys, "identifier"]].assign(rank=rank)

    sides = base.select(*keys, "identifier", "source").groupBy(*keys), arcs.select(*keys, "src", "dst", "share").groupBy(*keys)
    return sides[0].cogroup(sides[1]).applyInPandas(run, schema)


def _rank_large(joined: DataFrame, arcs: DataFrame, keys: list[str], tolerance: float, damping: float) -> DataFrame:
    """(keys, identifier, rank) of slices of any size: a round is one join and one grouping."""
    # an arc from every node to itself brings the node's own values to the grouping
    own = joined.select(
        *keys, F.col("identifier").alias("src"), F.col("identifier").alias("dst"), F.lit(0.0).alias("share"), "salts",
        F.pmod(F.xxhash64("identifier"), F.col("salts")).cast("int").alias("salt"), F.lit(True).alias("own"),
    )
    # kept in the layout the rounds join on, so that only ranks are shuffled in a round
    arcs = arcs.withColumn("own", F.lit(False)).unionByName(own).drop("salts").repartition(*keys, "src", "salt").persist()
    state = joined.withColumns({"rank": F.col("source"), "before": F.lit(0.0)})
    omega, done = 1.0, 0
    while True:
        spread = state.select(
            *keys, F.col("identifier").alias("src"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "salts", "source", "rank", "before"
        )
        mine = [F.max(F.when(F.col("own"), F.col(c))).alias(c) for c in ("salts", "source", "rank", "before")]
        moved = (
            arcs.join(spread, [*keys, "src", "salt"])
            .groupBy(*keys, F.col("dst").alias("identifier"))
            .agg(F.sum(F.col("rank") * F.col("share")).alias("inflow"), *mine)
            .filter("source is not null")
        )
        step = omega * (damping * F.col("inflow") + F.col("source") - F.col("before")) + F.col("before")
        state = moved.select(*keys, "identifier", "salts", "source", step.alias("_next"), F.col("rank").alias("before")).withColumnRenamed("_next", "rank")
        omega = 1 / (1 - damping**2 / (2 if done == 0 else 4 / omega))
        done += 1
        if done % 5 == 0:
            state = cut_lineage(state)
            change = state.groupBy(*keys).agg(F.max(F.abs(F.col("rank") - F.col("before"))).alias("c"), F.max("rank").alias("r"))
            if change.filter(F.col("c") > tolerance * F.col("r")).isEmpty():
                break
    arcs.unpersist()
    return state.select(*keys, "identifier", "rank")


def personalised_rank(
    nodes: DataFrame, edges: DataFrame, keys: list[str], tolerance: float = 1e-12, damping: float = 0.85, rows_per_task: int = 1_000_000
) -> DataFrame:
    """Personalised page rank of every graph slice at once, until it stands still.

    nodes(keys, identifier, weight), edges(keys, id1, id2, weight), undirected. Reset
    shares come from `weight` (all zero: uniform); mass of isolated nodes goes back by reset.
    Returns nodes with `centrality`, which sums to 1 in every slice.

    The mass of isolated nodes has a closed form. On the linked ones the walk of an undirected
    graph has real eigenvalues within the damping, so Chebyshev steps apply: the error falls by
    0.56 a round in every slice where plain rounds give 0.85. Rounds go on until no rank changes by more than
    `tolerance` times the largest of its slice. Slices with up to `rows_per_task` arcs go their rounds each in one
    task; larger ones go by rounds of a join and a grouping, spread over all tasks.
    """
    sums = nodes.groupBy(*keys).agg(F.sum("weight").alias("_w"), F.count("*").alias("_n"))
    reset = F.when(F.col("_w") > 0, F.col("weight") / F.col("_w")).otherwise(1.0 / F.col("_n"))
    arcs = cut_lineage(_arcs(edges, keys, rows_per_task))
    linked = arcs.groupBy(*keys, F.col("src").alias("identifier")).agg(F.max("salts").alias("salts"))
    base = nodes.join(sums, keys).select(*keys, "identifier", reset.alias("reset")).join(linked, [*keys, "identifier"], "left")
    loose = base.groupBy(*keys).agg(F.coalesce(F.sum(F.when(F.col("salts").isNull(), F.col("reset"))), F.lit(0.0)).alias("_s"))
    back = 1 - damping + damping * (1 - damping) * F.col("_s") / (1 - damping * F.col("_s"))
    base = cut_lineage(base.join(loose, keys).select(*keys, "identifier", "salts", (F.col("reset") * back).alias("source")))
    joined = base.filter("salts is not null")
    large = cut_lineage(arcs.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_task).select(*keys))
    if large.isEmpty():
        rank = _rank_small(joined, arcs, keys, tolerance, damping)
    else:
        few = _rank_small(joined.join(large, keys, "left_anti"), arcs.join(large, keys, "left_anti"), keys, tolerance, damping)
        rank = few.unionByName(_rank_large(joined.join(large, keys, "left_semi"), arcs.join(large, keys, "left_semi"), keys, tolerance, damping))
    return base.join(rank, [*keys, "identifier"], "left").select(*keys, "identifier", F.coalesce("rank", "source").alias("centrality"))


def mean_flow_graph(flows: DataFrame) -> DataFrame:
    """Undirected mean flow per pair: both directions added, loops dropped."""
    days = flows.agg(F.count_distinct("date_time").alias("_days"))
    a, b = F.least("start_poly_id", "end_poly_id"), F.greatest("start_poly_id", "end_poly_id")
    return (
        flows.filter("start_poly_id <> end_poly_id")
        .groupBy(a.alias("id1"), b.alias("id2"))
        .agg(F.sum("movement").alias("m"))
        .crossJoin(days)  # one-row side
        .select("id1", "id2", (F.col("m") / F.col("_days")).alias("weight"))
    )


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("id1", "id2", "weight").unionByName(
        edges.select(F.col("id2").alias("id1"), F.col("id1").alias("id2"), "weight")
    )


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Modularity of a labelling, as one row. labels(id, label)."""
    la = labels.select(F.col("id").alias("id1"), F.col("label").alias("l1"))
    lb = labels.select(F.col("id").alias("id2"), F.col("label").alias("l2"))
    e = _both(edges).join(la, "id1").join(lb, "id2")
    per = e.groupBy(F.col("l1").alias("label")).agg(
        F.sum("weight").alias("k"), F.sum(F.when(F.col("l1") == F.col("l2"), F.col("weight")).otherwise(0.0)).alias("inner")
    )
    return per.agg(F.sum("inner").alias("i"), F.sum("k").alias("m2"), F.sum(F.col("k") * F.col("k")).alias("kk")).select(
        (F.col("i") / F.col("m2") - F.col("kk") / (F.col("m2") * F.col("m2"))).alias("modularity")
    )


def _local_moves(edges: DataFrame, ids: DataFrame, patience: int) -> tuple[DataFrame, float]:
    """Labels (id, label) after modularity moves, and their modularity; never below that of singletons.

    Half of the nodes (by hash) move at a time, so that neighbours do not swap for ever. It
    ends when no node gains by a move, or when `patience` full moves brought nothing better
    than the best labelling seen, which is returned. Every step is a join and a grouping.
    """
    arcs = cut_lineage(_both(edges))
    strength = arcs.groupBy(F.col("id1").alias("id")).agg(F.sum("weight").alias("k"))
    m2 = strength.agg(F.sum("k").alias("m2"))
    nodes = ids.select("id").distinct().join(strength, "id", "left").na.fill(0.0)
    labels = cut_lineage(nodes.select("id", F.col("id").alias("label"), "k"))
    best, best_q, stale, r = labels, modularity(edges, labels).first()["modularity"], 0, 0
    while best_q is not None and stale < patience:
        wishes = 0
        for half in range(2):
            mass = labels.groupBy("label").agg(F.sum("k").alias("s"))
            pull = (
                arcs.filter("id1 <> id2").join(labels.select(F.col("id").alias("id2"), "label"), "id2")
                .groupBy(F.col("id1").alias("id"), "label")
                .agg(F.sum("weight").alias("w"))
            )
            own = labels.select("id", "label", F.lit(0.0).alias("w"))
            options = pull.unionByName(own).groupBy("id", "label").agg(F.sum("w").alias("w"))
            here = labels.select("id", F.col("label").alias("old"), "k")
            s_rest = F.col("s") - F.when(F.col("label") == F.col("old"), F.col("k")).otherwise(0.0)
            gain = F.col("w") - F.col("k") * s_rest / F.col("m2")
            choice = (
                options.join(here, "id").join(mass, "label").crossJoin(m2)  # one-row side
                .groupBy("id")
                .agg(F.min(F.struct((-F.round(gain, 9)).alias("g"), (F.col("label") != F.col("old")).alias("moved"), "label")).alias("b"))
                .select("id", F.col("b.label").alias("new"), F.col("b.moved").alias("wish"))
            )
            turn = F.pmod(F.xxhash64("id", F.lit(r)), F.lit(2)) == half
            moved = cut_lineage(labels.join(choice, "id", "left").select(
                "id", F.when(turn, F.coalesce("new", "label")).otherwise(F.col("label")).alias("label"), "k", F.coalesce("wish", F.lit(False)).alias("wish")
            ))
            wishes += moved.filter("wish").count()
            labels = moved.drop("wish")
        r += 1
        q = modularity(edges, labels).first()["modularity"]
        if q > best_q + 1e-12:
            best, best_q, stale = labels, q, 0
        else:
            stale += 1
        if wishes == 0:
            break
    return best.select("id", "label"), best_q


def detect_communities(edges: DataFrame, ids: DataFrame, patience: int = 3) -> DataFrame:
    """Partition of the areas into flow communities: (id, label).

    Modularity moves of single areas; then communities become the nodes of a smaller graph
    (inner flow as loops) and move as a whole, level by level, until a level gains nothing.
    """
    labels, q = _local_moves(edges, ids, patience)
    while q is not None:
        a = labels.select(F.col("id").alias("id1"), F.col("label").alias("l1"))
        b = labels.select(F.col("id").alias("id2"), F.col("label").alias("l2"))
        merged = edges.join(a, "id1").join(b, "id2")
        merged = merged.groupBy(F.least("l1", "l2").alias("id1"), F.greatest("l1", "l2").alias("id2")).agg(F.sum("weight").alias("weight"))
        upper, upper_q = _local_moves(cut_lineage(merged), labels.select(F.col("label").alias("id")), patience)
        if upper_q <= q + 1e-12:
            break
        q = upper_q
        labels = cut_lineage(labels.join(upper.select(F.col("id").alias("label"), F.col("label").alias("_up")), "label").select("id", F.col("_up").alias("label")))
    return labels
