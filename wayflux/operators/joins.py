"""Joins on keys and dates, and neighbour sums over flow graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayflux.schema import counters


def locate_cases(cases: DataFrame, places: DataFrame) -> DataFrame:
    """Case counters joined with the place register and summed per day and place.

    Counters are summed before the join: the shuffle carries one row per day and id.
    """
    nums = counters(cases)
    daily = cases.groupBy("date_time", "geo_id").agg(*[F.sum(c).alias(c) for c in nums])
    return (
        daily.join(places.select("geo_id", "lon", "lat", "location"), "geo_id")
        .groupBy("date_time", "geo_id", "location", "lon", "lat")
        .agg(*[F.sum(c).alias(c) for c in nums])
    )


def keep_empty_places(cases: DataFrame, places: DataFrame, key: str) -> DataFrame:
    """Right join on the place list; places without cases get the first date and zeros."""
    nums = counters(cases)
    first = cases.agg(F.min("date_time").alias("_first"))
    out = cases.join(places, key, "right").crossJoin(first)  # one-row side
    return out.withColumn("date_time", F.coalesce("date_time", "_first")).drop("_first").na.fill(0.0, subset=nums)


def missing_places(cases: DataFrame, places: DataFrame, keys: list[str], show: list[str]) -> DataFrame:
    return cases.select(*keys, *[c for c in show if c not in keys]).distinct().join(places, keys, "left_anti").select(*show)


def known_flows(flows: DataFrame, areas: DataFrame) -> DataFrame:
    """Flows whose two ends are known areas."""
    ids = areas.select("poly_id").distinct()
    a = ids.withColumnRenamed("poly_id", "start_poly_id")
    b = ids.withColumnRenamed("poly_id", "end_poly_id")
    return flows.join(a, "start_poly_id", "left_semi").join(b, "end_poly_id", "left_semi")


def remap_flows(flows: DataFrame, mapping: DataFrame, old: str, new: str) -> DataFrame:
    """Both flow ends mapped to a coarser id, flows summed."""
    a = mapping.select(F.col(old).alias("start_poly_id"), F.col(new).alias("_s"))
    b = mapping.select(F.col(old).alias("end_poly_id"), F.col(new).alias("_e"))
    return (
        flows.join(a, "start_poly_id")
        .join(b, "end_poly_id")
        .groupBy("date_time", F.col("_s").alias("start_poly_id"), F.col("_e").alias("end_poly_id"))
        .agg(F.sum("movement").alias("movement"))
    )


def calendar(df: DataFrame, col: str = "date_time") -> DataFrame:
    """Every day between the first and last date of a table."""
    span = df.agg(F.min(col).alias("a"), F.max(col).alias("b"))
    return span.select(F.explode(F.sequence("a", "b")).alias(col))


def densify(df: DataFrame, ids: DataFrame, key: str, values: list[str], col: str = "date_time") -> DataFrame:
    """One row per area and day of the table's span, missing values 0.

    The grid is exploded from the id list (each id makes its own days), so the id table is
    the only thing shuffled; the one-row span joins it.
    """
    span = df.agg(F.min(col).alias("a"), F.max(col).alias("b"))
    grid = ids.select(key).distinct().join(span).select(key, F.explode(F.sequence("a", "b")).alias(col))
    return grid.join(df, [key, col], "left").na.fill(0.0, subset=values)


def nearest_date(left: DataFrame, right_dates: DataFrame, col: str = "date") -> DataFrame:
    """For every date of `left` the closest date of `right_dates`; the earlier one wins a tie.

    Only distinct dates take part. The closest one is either the last date at or before or
    the first one at or after, both found by a running window over the merged calendar,
    which has one row per day.
    """
    from pyspark.sql import Window as W

    ask = left.select(F.col(col).alias("d")).distinct().withColumn("have", F.lit(None).cast("date"))
    have = right_dates.select(F.col(col).alias("d")).distinct().withColumn("have", F.col("d"))
    days = ask.unionByName(have).groupBy("d").agg(F.max("have").alias("have"), F.max(F.col("have").isNull()).alias("asked"))
    w = W.orderBy("d")
    both = days.select(
        "d", "asked",
        F.last("have", ignorenulls=True).over(w).alias("before"),
        F.first("have", ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing)).alias("after"),
    ).filter("asked")
    gap_b, gap_a = F.datediff("d", "before"), F.datediff("after", "d")
    pick = F.when(F.col("after").isNull() | (gap_b <= gap_a), F.col("before")).otherwise(F.col("after"))
    return both.select(F.col("d").alias(col), F.coalesce(pick, "after").alias("nearest_date"))


def undirected(flows: DataFrame, start: str, end: str, date: str = "date_time") -> DataFrame:
    """Distinct (node, neighbour, date) pairs in both directions, loops left out."""
    pairs = flows.select(F.col(date), F.col(start).alias("_a"), F.col(end).alias("_b")).filter("_a <> _b").distinct()
    both = F.array(
        F.struct(F.col("_a").alias("node_id"), F.col("_b").alias("neighbor_id")),
        F.struct(F.col("_b").alias("node_id"), F.col("_a").alias("neighbor_id")),
    )
    return pairs.select(date, F.explode(both).alias("p")).select(date, "p.node_id", "p.neighbor_id").distinct()


def neighbour_totals(
    flows: DataFrame, values: DataFrame, key: str, value: str,
    start: str = "start_poly_id", end: str = "end_poly_id", how: str = "sum",
) -> DataFrame:
    """Per node and date, the sum (or mean) of a value over that date's flow neighbours."""
    near = undirected(flows, start, end)
    vals = values.select("date_time", F.col(key).alias("neighbor_id"), F.col(value).alias("_v"))
    joined = near.join(vals, ["date_time", "neighbor_id"], "left")
    total = F.sum(F.coalesce("_v", F.lit(0.0)))
    out = total if how == "sum" else total / F.count("*")
    return joined.groupBy("date_time", "node_id").agg(out.alias(f"neighbor_{value}"))


def overlap_span(a: DataFrame, b: DataFrame, key: str, col: str = "date_time") -> DataFrame:
    """Per group, the days both series cover."""
    sa = a.groupBy(key).agg(F.min(col).alias("a0"), F.max(col).alias("a1"))
    sb = b.groupBy(key).agg(F.min(col).alias("b0"), F.max(col).alias("b1"))
    return (
        sa.join(sb, key)
        .select(key, F.greatest("a0", "b0").alias("first_date"), F.least("a1", "b1").alias("last_date"))
        .filter("first_date <= last_date")
    )


def connected_neighbours(edges: DataFrame, num_days: int = 30) -> DataFrame:
    """Per node, the nodes it exchanged a positive mean flow with in the last days."""
    last = edges.agg(F.max("date_time").alias("_last"))
    recent = edges.join(last, F.col("date_time") >= F.date_sub(F.col("_last"), num_days))
    mean = recent.groupBy("date_time", "start_id", "end_id").agg(F.avg("movement").alias("m")).filter("m > 0")
    return undirected(mean, "start_id", "end_id").select("node_id", "neighbor_id").distinct()


def neighbours_or_touching(edges: DataFrame, touching: DataFrame, num_days: int = 30) -> DataFrame:
    """Flow neighbours; where the flow table is empty, the touching areas."""
    near = connected_neighbours(edges, num_days)
    any_edge = edges.limit(1).select(F.lit(1).alias("_e"))
    fallback = touching.select("node_id", "neighbor_id").join(any_edge, F.lit(True), "left_anti")
    return near.unionByName(fallback)


def assemble(frames: list[DataFrame], key: str, fill: float = 0.0) -> DataFrame:
    """Full join of several per-area measures."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, key, "full")
    return out.na.fill(fill)


def full_with_zeros(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b, keys, "full").na.fill(0.0)


def expand_to_members(values: DataFrame, mapping: DataFrame) -> DataFrame:
    """Community values handed to every member area (null where the community has none)."""
    vals = values.withColumnRenamed("poly_id", "community_id")
    return mapping.select("poly_id", "community_id").join(vals, "community_id", "left").drop("community_id")
