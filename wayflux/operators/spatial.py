"""Spatial joins keyed by grid cells, so that each is an equi-join with a local test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayflux.functions import geo
from wayflux.operators import cells
from wayflux.session import cut_lineage, salted_join


def with_rings(areas: DataFrame, wkt: str = "geometry") -> DataFrame:
    return areas.withColumn("rings", geo.rings_from_wkt(F.col(wkt)))


def _span(lo: Column, hi: Column, size: float) -> Column:
    return F.sequence(geo.cell(lo, size), geo.cell(hi, size))


def _deal(df: DataFrame, seg: str, size: float, margin: float = 0.0) -> DataFrame:
    """Rows repeated for each cell that their segment passes, or comes as near as the margin."""
    x1, x2, y1, y2 = (F.col(f"{seg}.{c}") for c in ("x1", "x2", "y1", "y2"))
    dealt = df.withColumn("cx", F.explode(_span(F.least(x1, x2) - margin, F.greatest(x1, x2) + margin, size))).withColumn(
        "cy", F.explode(_span(F.least(y1, y2) - margin, F.greatest(y1, y2) + margin, size))
    )
    # a cell that lies wholly on one side of the segment's line is not passed
    off = (x2 - x1) * ((F.col("cy") + 0.5) * size - y1) - (y2 - y1) * ((F.col("cx") + 0.5) * size - x1)
    return dealt.filter(F.abs(off) <= (F.abs(x2 - x1) + F.abs(y2 - y1)) * (size * (0.5 + 1e-9) + margin) * (1 + 1e-12))


def _segment_cells(areas: DataFrame, key: Column, size: float, margin: float = 0.0) -> DataFrame:
    """One row (key, seg, cx, cy) per border segment and cell it passes, widened by a margin."""
    return _deal(areas.select(key, F.explode(geo.edges_of(F.col("rings"))).alias("seg")), "seg", size, margin)


def _refine(seg: str, margin: float = 0.0) -> cells.Refine:
    return lambda df, size: cells.within(df, lambda rows: _deal(rows, seg, size, margin))


def _at(lon: str, lat: str) -> cells.Refine:
    return lambda df, size: cells.in_cell(df, lon, lat, size)


def _ring_starts(areas: DataFrame, key: Column) -> DataFrame:
    return areas.select(key, F.explode("rings").alias("_r")).select("*", F.col("_r")[0]["lon"].alias("lon"), F.col("_r")[0]["lat"].alias("lat")).drop("_r")


def _join_cells(many: DataFrame, few: DataFrame) -> DataFrame:
    """Join on the cell; rows of a hot cell are dealt to several tasks, the other side repeated for each."""
    return salted_join(many, few, cells.CELL, rows_per_task=cells.ROWS_PER_CELL)


def points_in_areas(
    points: DataFrame, areas: DataFrame, lon: str, lat: str, keep: list[str], size: float = 0.25
) -> DataFrame:
    """Points joined with the areas they lie within (borders excluded).

    `keep` names the area columns to add. Distinct places go down the cell tree, from cells of `size` on, and the
    points follow their place; points whose place is null or not finite are in no area.
    """
    keep = list(dict.fromkeys(keep))
    placed = points.filter((F.abs(lon) < float("inf")) & (F.abs(lat) < float("inf")))
    places = cut_lineage(placed.groupBy(F.col(lon).alias("lon"), F.col(lat).alias("lat")).agg(F.count("*").alias("_n")))
    found = cells.places_in_areas(places.select("lon", "lat"), areas, keep, size)

    def named(df):
        return df.withColumnsRenamed({"lon": lon, "lat": lat})

    return salted_join(placed, named(found), [lon, lat], counts=named(places)).select(*points.columns, *keep)


def _neighbourhood(df: DataFrame, lon: str, lat: str, size: float) -> DataFrame:
    """Each row repeated for its own cell and the eight around it."""
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    return (
        df.withColumn("dx", F.explode(around))
        .withColumn("dy", F.explode(around))
        .withColumn("cx", geo.cell(F.col(lon), size) + F.col("dx"))
        .withColumn("cy", geo.cell(F.col(lat), size) + F.col("dy"))
        .drop("dx", "dy")
    )


def _closest_in_reach(coords: DataFrame, centres: DataFrame, reach_deg: float) -> DataFrame:
    """Closest centre within `reach_deg` degrees, per distinct coordinate.

    Only coordinates and (id, place) travel; the minimum is combined map-side.
    """
    c = centres.select(F.col("poly_id").alias("_id"), F.col("poly_lon").alias("_lon"), F.col("poly_lat").alias("_lat"))
    homes = cells.in_cell(c, "_lon", "_lat", reach_deg)
    gap = geo.planar_km(F.col("lon"), F.col("lat"), F.col("_lon"), F.col("_lat"))
    pairs = _join_cells(_neighbourhood(coords, "lon", "lat", reach_deg), homes)
    return (
        pairs.withColumn("poly_distance", gap)
        .filter(F.col("poly_distance") <= reach_deg * geo.KM_PER_DEGREE)
        .groupBy("lon", "lat")
        .agg(F.min(F.struct("poly_distance", F.col("_id").alias("poly_id"))).alias("_best"))
        .select("lon", "lat", "_best.poly_id", "_best.poly_distance")
    )


def nearest_within(coords: DataFrame, centres: DataFrame, radius_km: float) -> DataFrame:
    """Closest centre within a radius for every distinct (lon, lat); the smaller id wins a tie."""
    return _closest_in_reach(coords.select("lon", "lat").distinct(), centres, radius_km / geo.KM_PER_DEGREE)


def nearest_centre(coords: DataFrame, centres: DataFrame, first_reach: float = 0.25) -> DataFrame:
    """Closest centre at any distance, by widening the reach for coordinates not served yet.

    A hit within the reach is exact. Each round doubles the reach and takes only what is
    left, so the number of rounds grows with the log of the extent. Coordinates or centres
    that are null or not finite take no part; without centres nothing is returned.
    """
    def finite(c):
        return F.abs(c) < float("inf")

    todo = coords.select("lon", "lat").filter(finite(F.col("lon")) & finite(F.col("lat"))).distinct()
    centres = centres.select("poly_id", "poly_lon", "poly_lat").filter(finite(F.col("poly_lon")) & finite(F.col("poly_lat"))).distinct()
    if centres.isEmpty():
        return _closest_in_reach(todo, centres, first_reach)
    reach, done = first_reach, None
    while True:
        hit = cut_lineage(_closest_in_reach(todo, centres, reach))
        done = hit if done is None else done.unionByName(hit)
        todo = cut_lineage(todo.join(hit, ["lon", "lat"], "left_anti"))
        if todo.isEmpty():
            return done
        reach *= 2


def touching_areas(areas: DataFrame, size: float = 0.25, key: str = "poly_id") -> DataFrame:
    """Pairs of areas that share border points but no interior.

    Segments, not areas, are the unit: each is keyed by the cells it passes through.
    """
    segs = _segment_cells(areas, F.col(key).alias("id"), size)
    other = segs.select(F.col("id").alias("id2"), F.col("seg").alias("seg2"), "cx", "cy")
    pairs = cells.meet(segs, other, size, _refine("seg"), _refine("seg2"), cells.many_pairs()).filter("id <> id2")
    met = (
        pairs.filter(geo.segments_meet(F.col("seg"), F.col("seg2")))
        .groupBy("id", "id2")
        .agg(F.max(geo.segments_cross(F.col("seg"), F.col("seg2"))).alias("crossing"))
    )
    mids = segs.select("id", F.col("seg.x1").alias("lon"), F.col("seg.y1").alias("lat")).distinct()
    inner = points_in_areas(mids, areas.select(F.col(key).alias("_other"), "rings"), "lon", "lat", ["_other"], size)
    nested = inner.filter(F.col("id") != F.col("_other")).select("id", F.col("_other").alias("id2")).distinct()
    nested = nested.unionByName(nested.select(F.col("id2").alias("id"), F.col("id").alias("id2")))
    return (
        met.filter(~F.col("crossing"))
        .join(nested, ["id", "id2"], "left_anti")
        .select(F.col("id").alias("node_id"), F.col("id2").alias("neighbor_id"))
    )


def overlap_weights(areas: DataFrame, outer: DataFrame, key: str, outer_key: str, size: float) -> DataFrame:
    """Shared area in km² of each overlapping pair, exact on the equal-area plane.

    Summed over cells of about `size` degrees, which are cut where borders are dense. Pairs that
    only touch are left out: less than 1e-9 of the smaller area is taken as rounding.
    """
    def flat(df, k):
        return df.select(k, geo.equal_area(F.col("rings")).alias("rings"))

    def whole(df, k, out):
        return df.select(k, geo.area(F.col("rings")).alias(out))

    a, b = flat(areas, key), flat(outer, outer_key)
    shared = cells.shared_areas(a, b, key, outer_key, size * geo.KM_PER_DEGREE)
    sized = shared.join(whole(a, key, "_wa"), key).join(whole(b, outer_key, "_wb"), outer_key)
    return sized.filter(F.col("shared") > 1e-9 * F.least("_wa", "_wb")).select(key, outer_key, F.col("shared").alias("area_overlap"))


def own_share(weights: DataFrame, areas: DataFrame, key: str) -> DataFrame:
    """Overlap as a share of the area itself."""
    own = areas.select(key, geo.area(geo.equal_area(F.col("rings"))).alias("_area"))
    return weights.join(own, key).withColumn("area_share", F.col("area_overlap") / F.col("_area")).drop("_area")


def transfer_density(weights: DataFrame, areas: DataFrame, key: str, outer_key: str) -> DataFrame:
    """Population density of outer areas from the areas they overlap."""
    dens = areas.select(key, (F.col("attr_population") / geo.area(geo.equal_area(F.col("rings")))).alias("_d"))
    return (
        weights.join(dens, key)
        .groupBy(outer_key)
        .agg((F.sum(F.col("area_overlap") * F.col("_d")) / F.sum("area_overlap")).alias("population_density"))
    )


def meeting_pairs(areas: DataFrame, layer: DataFrame, key: str, name: str, size: float) -> DataFrame:
    """Distinct (key, name) pairs whose shapes share a point.

    Either two border segments meet, or a ring of one begins inside the other.
    """
    layer = layer.select(F.col(name).alias("_n"), "rings")
    left = _segment_cells(areas, F.col(key), size)
    right = _segment_cells(layer, F.col("_n"), size).withColumnRenamed("seg", "seg2")
    met = cells.meet(left, right, size, _refine("seg"), _refine("seg2"), cells.many_pairs()).filter(geo.segments_meet(F.col("seg"), F.col("seg2"))).select(key, "_n")
    within = points_in_areas(_ring_starts(areas, F.col(key)), layer, "lon", "lat", ["_n"], size).select(key, "_n")
    around = points_in_areas(_ring_starts(layer, F.col("_n")), areas, "lon", "lat", [key], size).select(key, "_n")
    return met.unionByName(within).unionByName(around).distinct().withColumnRenamed("_n", name)


def intersecting_names(
    areas: DataFrame, layer: DataFrame, key: str, name: str, size: float, out: str
) -> DataFrame:
    """Per area, the distinct names of layer areas that meet it, sorted and joined by ', '."""
    found = meeting_pairs(areas, layer.select(F.col(name).alias("_name"), "rings"), key, "_name", size)
    return found.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("_name")), ", ").alias(out))


def circles_meeting_areas(places: DataFrame, areas: DataFrame, key: str, name: str, radius_m: float, size: float) -> DataFrame:
    """(place, area name) pairs where the circle around the place meets the area.

    The distance from the place to each border segment is taken in a local plane.
    """
    margin = radius_m / 1000.0 / geo.KM_PER_DEGREE * 1.2
    named = areas.select(F.col(name).alias("_n"), "rings")
    spots = places.select(key, "lon", "lat")
    keyed = cells.in_cell(spots, "lon", "lat", size)
    kx = F.cos(F.radians("lat")) * geo.KM_PER_DEGREE

    def near(e):
        ax, ay = (e["x1"] - F.col("lon")) * kx, (e["y1"] - F.col("lat")) * geo.KM_PER_DEGREE
        bx, by = (e["x2"] - F.col("lon")) * kx, (e["y2"] - F.col("lat")) * geo.KM_PER_DEGREE
        dx, dy = bx - ax, by - ay
        t = F.coalesce(-(ax * dx + ay * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
        t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
        px, py = ax + t * dx, ay + t * dy
        return px * px + py * py <= (radius_m / 1000.0) ** 2

    borders = _segment_cells(named, F.col("_n"), size, margin)
    met = cells.meet(keyed, borders, size, _at("lon", "lat"), _refine("seg", margin), cells.many_pairs())
    close = met.filter(near(F.col("seg"))).select(key, "_n")
    return close.unionByName(points_in_areas(spots, named, "lon", "lat", ["_n"], size).select(key, "_n")).distinct()


def areas_on_line(areas: DataFrame, lines: DataFrame, key: str, size: float, buffer_deg: float = 0.0) -> DataFrame:
    """Areas met by a line (given as segments x1,y1,x2,y2 with line_id and preference).

    The line of the smallest preference wins where several meet an area.
    """
    seg = F.struct("x1", "y1", "x2", "y2")
    dealt = _deal(lines.select("line_id", "preference", seg.alias("seg2")), "seg2", size, buffer_deg)
    seg_c = F.col("seg2")
    if buffer_deg > 0:
        def gap2(px, py, e):
            dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
            t = F.coalesce(((px - e["x1"]) * dx + (py - e["y1"]) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
            t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
            ux, uy = e["x1"] + t * dx - px, e["y1"] + t * dy - py
            return ux * ux + uy * uy

        def close(e):
            lim = buffer_deg * buffer_deg
            return (
                geo.segments_meet(e, seg_c)
                | (gap2(e["x1"], e["y1"], seg_c) <= lim)
                | (gap2(e["x2"], e["y2"], seg_c) <= lim)
                | (gap2(seg_c["x1"], seg_c["y1"], e) <= lim)
                | (gap2(seg_c["x2"], seg_c["y2"], e) <= lim)
            )
    else:
        def close(e):
            return geo.segments_meet(e, seg_c)

    met = cells.meet(dealt, _segment_cells(areas, F.col(key), size), size, _refine("seg2", buffer_deg), _refine("seg"), cells.many_pairs())
    border = met.filter(close(F.col("seg"))).select(key, "preference", "line_id")
    starts = lines.select("line_id", "preference", F.col("x1").alias("lon"), F.col("y1").alias("lat"))
    started = points_in_areas(starts, areas, "lon", "lat", [key], size).select(key, "preference", "line_id")
    return (
        border.unionByName(started)
        .groupBy(key)
        .agg(F.min(F.struct("preference", "line_id")).alias("m"))
        .select(key, "m.line_id")
    )


def close_pairs(places: DataFrame, key: str, reach_km: float, others: DataFrame | None = None) -> DataFrame:
    """Pairs of places no farther apart than `reach_km`, both directions, self left out; with `others`, b is one of those.

    A place is keyed by one cell and probes the nine around it, so each pair is met once.
    Cells are narrowed with latitude so that one step always covers the reach.
    """
    step = reach_km / 111.0
    band = geo.cell(F.col("lat"), step)
    # longitude step of the band above and below differ: probe with the band's own step
    def lon_step(b):
        widest = F.greatest(F.abs((b - 1) * step), F.abs((b + 2) * step))
        return step / F.greatest(F.cos(F.radians(F.least(widest, F.lit(89.0)))), F.lit(0.01))

    base = places.select(key, "lon", "lat").withColumn("cy", band)
    home = base.withColumn("cx", F.floor(F.col("lon") / lon_step(F.col("cy"))))
    there = base if others is None else others.select(key, "lon", "lat").withColumn("cy", band)
    probe = there.select(F.col(key).alias("_k2"), F.col("lon").alias("_lon2"), F.col("lat").alias("_lat2"), F.col("cy").alias("_cy"))
    probe = probe.withColumn("cy", F.explode(F.array(F.col("_cy") - 1, F.col("_cy"), F.col("_cy") + 1)))
    at = F.floor(F.col("_lon2") / lon_step(F.col("cy")))
    probe = probe.withColumn("cx", F.explode(F.array(at - 1, at, at + 1)))
    gap = geo.haversine_km(F.col("lon"), F.col("lat"), F.col("_lon2"), F.col("_lat2"))
    return (
        salted_join(home, probe.drop("_cy"), ["cx", "cy"])
        .filter(F.col(key) != F.col("_k2"))
        .filter(gap <= reach_km)
        .select(F.col(key).alias("a"), F.col("_k2").alias("b"))
    )
