"""The three ways to group areas: by geometry, by community map, by radius."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from wayflux.functions import dates, geo
from wayflux.operators import aggregates, joins, ranking, rules, spatial
from wayflux.operators.cover import greedy_heads
from wayflux.schema import attributes, counters
from wayflux.session import cut_lineage


def check_geometry(areas: DataFrame) -> None:
    if "geometry" not in areas.columns:
        raise ValueError("areas need a geometry column with POLYGON or MULTIPOLYGON text")


def cases_by_geometry(cases: DataFrame, areas: DataFrame, size: float = 0.25) -> DataFrame:
    """Located cases summed per day and the area they lie within.

    Copies of a place collapse before the spatial join, which then sees distinct places.
    """
    check_geometry(areas)
    nums = counters(cases)
    daily = cases.groupBy("date_time", "lon", "lat").agg(*[F.sum(c).alias(c) for c in nums])
    placed = spatial.points_in_areas(daily, spatial.with_rings(areas), "lon", "lat", ["poly_id", "poly_name"], size)
    return placed.groupBy("date_time", F.col("poly_name").alias("location"), "poly_id").agg(*[F.sum(c).alias(c) for c in nums])


def flows_by_geometry(tiles: DataFrame, areas: DataFrame, known: DataFrame | None = None, size: float = 0.25) -> DataFrame:
    """Tile flows summed per rounded day and (start, end) area.

    tiles(date_time, start_movement_lon/lat, end_movement_lon/lat, n_crisis); `known`
    restricts both ends to areas that have cases.
    """
    check_geometry(areas)
    ringed = spatial.with_rings(areas)
    ends = ["start_movement_lon", "start_movement_lat", "end_movement_lon", "end_movement_lat"]
    # kept, as the joins read them several times and the ends may come from texts
    daily = cut_lineage(tiles.groupBy(dates.round_to_day(F.col("date_time")).alias("date_time"), *ends).agg(F.sum("n_crisis").alias("movement")))
    a = spatial.points_in_areas(daily, ringed, ends[0], ends[1], ["poly_id"], size).withColumnRenamed("poly_id", "start_poly_id")
    a = cut_lineage(a.groupBy("date_time", "start_poly_id", *ends[2:]).agg(F.sum("movement").alias("movement")))
    b = spatial.points_in_areas(a, ringed, ends[2], ends[3], ["poly_id"], size).withColumnRenamed("poly_id", "end_poly_id")
    out = b.groupBy("date_time", "start_poly_id", "end_poly_id").agg(F.sum("movement").alias("movement"))
    return out if known is None else joins.known_flows(out, known)


def areas_with_counts(areas: DataFrame, cases: DataFrame) -> DataFrame:
    """Areas that have cases, with their total counters."""
    return areas.join(aggregates.sum_counters(cases.select("poly_id", *counters(cases)), ["poly_id"]), "poly_id")


def by_community(
    areas: DataFrame, cases: DataFrame, flows: DataFrame, mapping: DataFrame,
    scheme: list[rules.Rule], ranges: DataFrame | None = None, population: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All tables moved from areas to communities, each column by its rule."""
    m = mapping.select("poly_id", "community_id")
    names = mapping.select(F.col("community_id").alias("poly_id"), F.col("community_name").alias("location")).distinct()
    nums = counters(cases)
    out = {}
    out["cases"] = rules.agglomerate(
        cases.join(m, "poly_id").drop("poly_id").withColumnRenamed("community_id", "poly_id"), scheme, ["date_time", "poly_id"], nums
    ).join(names, "poly_id")
    out["movement"] = joins.remap_flows(flows, mapping, "poly_id", "community_id")
    total = aggregates.sum_counters(cases.select("poly_id", *nums), ["poly_id"])
    cols = [c for c in areas.columns if c in ("poly_name", "poly_lon", "poly_lat", "geometry") or c in attributes(areas)]
    full = areas.join(total, "poly_id", "left").na.fill(0.0, subset=nums).join(m, "poly_id")
    out["polygons"] = rules.agglomerate(
        full.drop("poly_id").withColumnRenamed("community_id", "poly_id"), scheme, ["poly_id"], cols + nums
    )
    if ranges is not None:
        out["movement_range"] = aggregates.factor_average(ranges, areas, mapping)
    if population is not None:
        out["population"] = rules.agglomerate(
            population.join(m, "poly_id").drop("poly_id").withColumnRenamed("community_id", "poly_id"),
            scheme, ["date_time", "poly_id"], ["population"],
        )
    return out


def place_totals(cases: DataFrame) -> DataFrame:
    """Distinct case places with their totals and their order (most cases first)."""
    places = cases.groupBy("location", "lon", "lat").agg(F.sum("num_cases").alias("num_cases"))
    keyed = places.withColumn("_tie", F.xxhash64("location", "lon", "lat"))
    return ranking.distributed_rank(keyed, [], "num_cases", "_tie").withColumnRenamed("rank", "ord").drop("_tie", "n")


def radial_centres(cases: DataFrame, areas: DataFrame, radius_km: float) -> tuple[DataFrame, DataFrame]:
    """Places assigned to centres, and the centres.

    Places are taken from most to least cases. A place proposes its nearest area; the
    proposal becomes a centre unless a centre nearer than 2 × radius exists already, in which
    case the place joins the nearest such centre. Which proposals win is a greedy ordered
    cover of the distinct proposals; everything else is a join.
    """
    places = cut_lineage(place_totals(cases))
    near = spatial.nearest_centre(places, areas)
    geo_of = areas.select("poly_id", "poly_name", "poly_lon", "poly_lat")
    proposed = cut_lineage(
        places.join(near, ["lon", "lat"]).join(geo_of, "poly_id")
    )
    nodes = proposed.groupBy(F.col("poly_id").alias("id"), "poly_name", "poly_lon", "poly_lat").agg(F.min("ord").alias("ord"))
    nodes = cut_lineage(nodes)
    reach = 2 * radius_km
    sites = nodes.select("id", F.col("poly_lon").alias("lon"), F.col("poly_lat").alias("lat"))
    pairs = cut_lineage(_planar_pairs(sites, reach))
    heads = greedy_heads(nodes, pairs.select("a", "b"))
    centres = cut_lineage(nodes.join(heads, "id"))
    # candidate centres of a proposal: itself when it is a head, and heads closer than the reach
    self_pairs = centres.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("gap"))
    options = pairs.join(heads.withColumnRenamed("id", "b"), "b", "left_semi").select("a", "b", "gap").unionByName(self_pairs)
    options = options.join(centres.select(F.col("id").alias("b"), F.col("ord").alias("c_ord"), F.col("poly_name").alias("c_name"), F.col("poly_lon").alias("c_lon"), F.col("poly_lat").alias("c_lat")), "b")
    pick = F.min(F.struct("gap", "c_ord", F.col("b").alias("id"), "c_name", "c_lon", "c_lat"))
    chosen = (
        proposed.join(options.withColumnRenamed("a", "poly_id"), "poly_id")
        .filter(F.col("c_ord") <= F.col("ord"))
        .groupBy("location", "lon", "lat", "num_cases", "ord", "poly_distance")
        .agg(pick.alias("p"))
    )
    first = F.col("p.c_ord") == F.col("ord")
    assigned = chosen.select(
        "location", "lon", "lat", "num_cases", "ord",
        F.col("p.id").alias("poly_id"), F.col("p.c_name").alias("poly_name"),
        F.col("p.c_lon").alias("poly_lon"), F.col("p.c_lat").alias("poly_lat"),
        F.when(first, F.col("poly_distance")).otherwise(
            geo.planar_km(F.col("lon"), F.col("lat"), F.col("p.c_lon"), F.col("p.c_lat"))
        ).alias("poly_distance"),
        (~first).alias("poly_merged"),
    )
    return assigned, centres


def _planar_pairs(sites: DataFrame, reach_km: float) -> DataFrame:
    """Pairs of sites closer than the reach in the planar metric, with their gap."""
    step = reach_km / geo.KM_PER_DEGREE
    home = sites.withColumn("cx", geo.cell(F.col("lon"), step)).withColumn("cy", geo.cell(F.col("lat"), step))
    probe = spatial._neighbourhood(
        sites.select(F.col("id").alias("_b"), F.col("lon").alias("_x"), F.col("lat").alias("_y")), "_x", "_y", step
    )
    gap = geo.planar_km(F.col("lon"), F.col("lat"), F.col("_x"), F.col("_y"))
    return (
        spatial._join_cells(probe, home).filter("id <> _b").withColumn("gap", gap).filter(F.col("gap") < reach_km)
        .select(F.col("id").alias("a"), F.col("_b").alias("b"), "gap")
    )


def by_radius(cases: DataFrame, areas: DataFrame, tiles: DataFrame | None, population: DataFrame | None, radius_km: float) -> dict[str, DataFrame]:
    """Cases, flows and population grouped around the chosen centres."""
    assigned, _ = radial_centres(cases, areas, radius_km)
    assigned = cut_lineage(assigned)
    points = F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("lon", "lat"))), lambda p: F.concat(p["lon"].cast("string"), F.lit(" "), p["lat"].cast("string"))), ",")
    polygons = assigned.groupBy("poly_id", "poly_name", "poly_lon", "poly_lat").agg(
        F.sum("num_cases").alias("num_cases"), F.concat(F.lit("MULTIPOINT ("), points, F.lit(")")).alias("geometry")
    )
    out = {"polygons": polygons, "places": assigned}
    cols = ["poly_id", "poly_name", "poly_lon", "poly_lat", "poly_distance", "poly_merged"]
    out["cases"] = cases.join(assigned.select("location", "lon", "lat", *cols), ["location", "lon", "lat"])
    if tiles is not None:
        moved = cut_lineage(tiles)  # read by both sides, and its ends may come from texts
        for side in ("start", "end"):
            lon, lat = f"{side}_movement_lon", f"{side}_movement_lat"
            spots = spatial.nearest_within(moved.select(F.col(lon).alias("lon"), F.col(lat).alias("lat")), polygons, radius_km)
            moved = moved.join(
                spots.select(F.col("lon").alias(lon), F.col("lat").alias(lat), F.col("poly_id").alias(f"{side}_poly_id"), F.col("poly_distance").alias(f"{side}_poly_distance")),
                [lon, lat],
            )
        out["movement"] = moved
    if population is not None:
        spots = spatial.nearest_within(population, polygons, radius_km)
        out["population"] = population.join(spots, ["lon", "lat"])
    return out
