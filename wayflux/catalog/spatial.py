"""Geometry functions and spatial joins."""

from pyspark.sql import functions as F

from wayflux.catalog.base import query
from wayflux.functions import geo
from wayflux.operators import rules, spatial
from wayflux.plans import agglomerate, ranges

IN_SQUARE = "x > w AND x < e AND y > s AND y < n"


def located_cases(t):
    """One case per event at its user's place."""
    return t.points.select(
        F.concat(F.lit("u"), "user_id").alias("location"), "lon", "lat", F.lit(1.0).alias("num_cases"), F.col("value").alias("num_weight"),
        F.col("ts").cast("date").alias("date_time"),
    )


def located_tiles(t):
    from wayflux.sources.files import with_endpoints

    return with_endpoints(t.tiles)


def region_squares(t):
    """Outer layer: one shifted square per nation, half a square east."""
    lon, lat = F.col("poly_lon") + 0.25, F.col("poly_lat")
    from wayflux.sources.testdata import square_wkt

    return spatial.with_rings(t.polygons.select(F.concat(F.lit("X"), "poly_id").alias("external_polygon_id"), square_wkt(lon, lat, 0.25).alias("geometry")))


@query("ring_corners", """
    SELECT poly_id, w AS first_lon, s AS first_lat, 5 AS corners, 0.25e0 AS surface, poly_lon AS lon, poly_lat AS lat, c.n FROM squares
    JOIN (SELECT poly_id, sum(num_cases) AS n FROM cases GROUP BY 1) c USING (poly_id)""", r="first_lon first_lat surface lon lat", i="corners", covers="I1 I4 A10")
def _(t):
    r, first = F.col("rings"), F.col("rings")[0]
    c = geo.centroid(r)
    shapes = t.ringed.select(
        "poly_id", first[0]["lon"].alias("first_lon"), first[0]["lat"].alias("first_lat"), F.size(first).alias("corners"), geo.area(r).alias("surface"),
        c["lon"].alias("lon"), c["lat"].alias("lat"),
    )
    return shapes.join(t.cases.groupBy("poly_id").agg(F.sum("num_cases").alias("n")), "poly_id")


@query("trip_lengths", """
    SELECT event_id, sqrt((start_movement_lon - end_movement_lon) ** 2 + (start_movement_lat - end_movement_lat) ** 2) * 110.567e0 AS planar_km,
           2 * 6371e0 * asin(sqrt(least(1e0, sin(radians(end_movement_lat - start_movement_lat) / 2) ** 2 + cos(radians(start_movement_lat)) * cos(radians(end_movement_lat)) * sin(radians(end_movement_lon - start_movement_lon) / 2) ** 2))) AS great_circle_km
    FROM tiles""", r="planar_km great_circle_km", covers="I2 I3")
def _(t):
    from wayflux.sources.testdata import user_point

    x, y = user_point(F.col("user_id"))
    ex, ey = user_point(F.col("user_id").bitwiseXOR(F.col("event_id") % 7 + 1))
    return t.raw("events").select("event_id", geo.planar_km(x, y, ex, ey).alias("planar_km"), geo.haversine_km(x, y, ex, ey).alias("great_circle_km"))


@query("points_near_centre", """
    SELECT event_id FROM points WHERE 2 * 6371e0 * asin(sqrt(least(1e0, sin(radians(5e0 - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(5e0)) * sin(radians(-74e0 - lon) / 2) ** 2))) <= 60""", covers="I5")
def _(t):
    return t.points.filter(geo.within_circle(F.col("lon"), F.col("lat"), F.lit(-74.0), F.lit(5.0), 60_000)).select("event_id")


@query("cases_in_areas", f"""
    SELECT CAST(ts AS DATE) AS date_time, poly_name AS location, poly_id, CAST(count(*) AS DOUBLE) AS num_cases, sum(value) AS num_weight
    FROM (SELECT *, lon AS x, lat AS y FROM points) JOIN squares ON {IN_SQUARE} GROUP BY 1, 2, 3""", d="date_time", r="num_weight", covers="C7 J2 D12")
def _(t):
    return agglomerate.cases_by_geometry(located_cases(t), t.polygons)


@query("flows_between_areas", f"""
    SELECT CAST(date_time + INTERVAL 12 HOUR AS DATE) AS date_time, a.poly_id AS start_poly_id, b.poly_id AS end_poly_id, sum(n_crisis) AS movement
    FROM tiles JOIN squares a ON {IN_SQUARE.replace('x ', 'start_movement_lon ').replace('y ', 'start_movement_lat ').replace('> w', '> a.w').replace('< e', '< a.e').replace('> s', '> a.s').replace('< n', '< a.n')}
    JOIN squares b ON {IN_SQUARE.replace('x ', 'end_movement_lon ').replace('y ', 'end_movement_lat ').replace('> w', '> b.w').replace('< e', '< b.e').replace('> s', '> b.s').replace('< n', '< b.n')} GROUP BY 1, 2, 3""",
       d="date_time", r="movement", covers="C7 C6 J2 H4")
def _(t):
    known = agglomerate.areas_with_counts(t.polygons, t.cases)
    return agglomerate.flows_by_geometry(located_tiles(t), t.polygons, known)


NEAREST = """SELECT x, y, poly_id, d FROM (
        SELECT lon AS x, lat AS y, poly_id, sqrt((lon - poly_lon) ** 2 + (lat - poly_lat) ** 2) * 110.567e0 AS d,
               row_number() OVER (PARTITION BY lon, lat ORDER BY sqrt((lon - poly_lon) ** 2 + (lat - poly_lat) ** 2), poly_id) AS k
        FROM (SELECT DISTINCT lon, lat FROM points), polygons) WHERE k = 1"""


@query("nearest_centre_in_radius", f"SELECT x AS lon, y AS lat, poly_id, d AS poly_distance FROM ({NEAREST}) WHERE d <= 20", r="lon lat poly_distance", covers="C8")
def _(t):
    return spatial.nearest_within(t.points, t.polygons, 20.0)


@query("nearest_centre", f"SELECT x AS lon, y AS lat, poly_id, d AS poly_distance FROM ({NEAREST})", r="lon lat poly_distance", covers="C9")
def _(t):
    return spatial.nearest_centre(t.points, t.polygons)


@query("touching_areas", """
    SELECT a.poly_id AS node_id, b.poly_id AS neighbor_id FROM squares a JOIN squares b ON a.poly_id <> b.poly_id
    AND a.w <= b.e AND b.w <= a.e AND a.s <= b.n AND b.s <= a.n""", covers="C11")
def _(t):
    return spatial.touching_areas(t.ringed)


def _km2(w: str, e: str, s: str, n: str) -> str:
    """Area on the sphere of a box in degrees, 0 where it is empty."""
    return f"{geo.GRID_RADIUS_KM}e0 * {geo.GRID_RADIUS_KM}e0 * greatest(0e0, radians({e}) - radians({w})) * greatest(0e0, sin(radians({n})) - sin(radians({s})))"


OWN = _km2("a.w", "a.e", "a.s", "a.n")
OVERLAP = f"""SELECT a.poly_id, 'X' || b.poly_id AS external_polygon_id, {_km2("greatest(a.w, b.w + 0.25)", "least(a.e, b.e + 0.25)", "greatest(a.s, b.s)", "least(a.n, b.n)")} AS area_overlap, {OWN} AS own, a.attr_population
        FROM squares a JOIN squares b ON a.w < b.e + 0.25 AND b.w + 0.25 < a.e AND a.s < b.n AND b.s < a.n"""


@query("overlap_shares", f"SELECT poly_id, external_polygon_id, area_overlap, area_overlap / own AS area_share FROM ({OVERLAP})", r="area_overlap area_share", covers="C12")
def _(t):
    w = spatial.overlap_weights(t.ringed, region_squares(t), "poly_id", "external_polygon_id", 0.5)
    return spatial.own_share(w, t.ringed, "poly_id")


@query("density_of_outer_areas", f"SELECT external_polygon_id, sum(area_overlap * attr_population / own) / sum(area_overlap) AS population_density FROM ({OVERLAP}) GROUP BY 1", r="population_density", covers="C13")
def _(t):
    w = spatial.overlap_weights(t.ringed, region_squares(t), "poly_id", "external_polygon_id", 0.5)
    return spatial.transfer_density(w, t.ringed, "poly_id", "external_polygon_id")


@query("ranges_for_areas", f"""
    WITH o AS ({OVERLAP}), dens AS (SELECT external_polygon_id, sum(area_overlap * attr_population / own) / sum(area_overlap) AS pd FROM o GROUP BY 1),
         f AS (SELECT poly_id, external_polygon_id, area_overlap * pd AS factor FROM o JOIN dens USING (external_polygon_id)),
         r AS (SELECT start_poly_id, date_time, sum(movement) AS v FROM movement GROUP BY 1, 2)
    SELECT d.date_time, p.poly_id, sum(factor * v) / sum(factor) FILTER (WHERE v IS NOT NULL) AS movement_change
    FROM (SELECT DISTINCT date_time FROM r) d CROSS JOIN polygons p JOIN f ON f.poly_id = p.poly_id
    LEFT JOIN r ON r.date_time = d.date_time AND 'X' || r.start_poly_id = f.external_polygon_id GROUP BY 1, 2""", d="date_time", r="movement_change", covers="K17 C12 C13")
def _(t):
    w = ranges.range_weights(t.ringed, region_squares(t), 0.5)
    r = t.movement.groupBy(F.col("date_time").alias("ds"), F.concat(F.lit("X"), "start_poly_id").alias("external_polygon_id")).agg(
        F.sum("movement").alias("all_day_bing_tiles_visited_relative_change")
    )
    return ranges.extrapolate_ranges(r, w, t.polygons)


@query("names_meeting_areas", """
    SELECT poly_id, string_agg(nm, ', ' ORDER BY nm) AS names FROM (SELECT DISTINCT a.poly_id, c.community_name AS nm FROM squares a
        JOIN squares b ON a.w <= b.e + 0.125 AND b.w + 0.125 <= a.e AND a.s <= b.n AND b.s <= a.n JOIN community_map c ON c.poly_id = b.poly_id) GROUP BY 1""", covers="C10")
def _(t):
    from wayflux.sources.testdata import square_wkt

    layer = t.polygons.select("poly_id", square_wkt(F.col("poly_lon") + 0.125, F.col("poly_lat"), 0.25).alias("geometry"))
    layer = spatial.with_rings(layer.join(t.community_map.select("poly_id", "community_name"), "poly_id"))
    return spatial.intersecting_names(t.ringed, layer, "poly_id", "community_name", 0.25, "names")


@query("close_user_pairs", """
    WITH u AS (SELECT DISTINCT user_id, lon, lat FROM points)
    SELECT x.user_id AS a, y.user_id AS b FROM u x JOIN u y ON x.user_id <> y.user_id AND abs(x.lat - y.lat) < 0.08
    AND 2 * 6371e0 * asin(sqrt(least(1e0, sin(radians(y.lat - x.lat) / 2) ** 2 + cos(radians(x.lat)) * cos(radians(y.lat)) * sin(radians(y.lon - x.lon) / 2) ** 2))) <= 8""", covers="C19")
def _(t):
    return spatial.close_pairs(t.points.select("user_id", "lon", "lat").distinct(), "user_id", 8.0)


@query("areas_on_trip_lines", f"""
    SELECT poly_id, min(user_id) AS line_id FROM (SELECT DISTINCT user_id, lon, lat FROM points) JOIN squares ON lat > s AND lat < n AND lon < e AND lon + 0.6e0 > w GROUP BY 1""", covers="C26")
def _(t):
    """Horizontal lines of 0.6 degrees starting at each user's place; the smallest user wins."""
    lines = t.points.select(F.col("user_id").alias("line_id"), F.col("user_id").alias("preference"), F.col("lon").alias("x1"), F.col("lat").alias("y1"), (F.col("lon") + 0.6).alias("x2"), F.col("lat").alias("y2")).distinct()
    return spatial.areas_on_line(t.ringed, lines, "poly_id", 0.25)


@query("community_outlines", """
    WITH seg AS (SELECT poly_id, unnest([w, e, w, w]) AS x1, unnest([s, s, n, s]) AS y1, unnest([e, e, e, w]) AS x2, unnest([s, n, n, n]) AS y2 FROM squares),
         band AS (SELECT *, CASE WHEN community_id IN ('0', '1') THEN 'west' ELSE 'east' END AS band FROM seg JOIN community_map USING (poly_id))
    SELECT band, x1, y1, x2, y2 FROM band GROUP BY ALL HAVING count(*) % 2 = 1""", r="x1 y1 x2 y2", covers="D11")
def _(t):
    band = F.when(F.col("community_id").isin("0", "1"), "west").otherwise("east").alias("band")
    m = t.ringed.join(t.community_map.select("poly_id", "community_id"), "poly_id").select(band, "rings")
    return rules.outline(m, "band")


@query("radial_places", covers="J1 C8")
def _(t):
    out = agglomerate.by_radius(located_cases(t), t.polygons, None, None, 30.0)
    return out["places"].drop("ord")


@query("radial_flows", covers="J1 C8")
def _(t):
    tiles = located_tiles(t).withColumn("date_time", F.col("date_time").cast("date")).drop("geometry")
    out = agglomerate.by_radius(located_cases(t), t.polygons, tiles, None, 30.0)["movement"]
    return out.groupBy("date_time", "start_poly_id", "end_poly_id").agg(F.sum("n_crisis").alias("movement"))


@query("radial_distances_described", covers="D30 J1")
def _(t):
    from wayflux.operators.aggregates import describe_column

    places = agglomerate.by_radius(located_cases(t), t.polygons, None, None, 30.0)["places"]
    return describe_column(places, "poly_distance", ["poly_merged"])


def _box(lon, lat, half: float):
    def p(x, y):
        return F.concat_ws(" ", x.cast("string"), y.cast("string"))

    w, e, s, n = lon - half, lon + half, lat - half, lat + half
    return F.concat(F.lit("("), F.concat_ws(", ", p(w, s), p(e, s), p(e, n), p(w, n), p(w, s)), F.lit(")"))


def pierced(t):
    """Areas of two parts: a square with a hole, and an island east of the middle of the hole."""
    lon, lat = F.col("poly_lon"), F.col("poly_lat")
    text = F.concat(F.lit("MULTIPOLYGON (("), _box(lon, lat, 0.25), F.lit(", "), _box(lon, lat, 0.125), F.lit("), ("), _box(lon + 0.0625, lat, 0.03125), F.lit("))"))
    return t.polygons.withColumn("geometry", text)


HOLE = "abs(x - poly_lon) <= 0.125 AND abs(y - poly_lat) <= 0.125"
ISLAND = "abs(x - poly_lon - 0.0625) < 0.03125 AND abs(y - poly_lat) < 0.03125"
PIERCED = f"""SELECT a.poly_id, 'X' || b.poly_id AS external_polygon_id, {" ".join(f"{sign} " + _km2(f"greatest(a.poly_lon + {dx} - {h}, b.w + 0.25)", f"least(a.poly_lon + {dx} + {h}, b.e + 0.25)", f"greatest(a.poly_lat - {h}, b.s)", f"least(a.poly_lat + {h}, b.n)") for sign, dx, h in (("", 0, 0.25), ("-", 0, 0.125), ("+", 0.0625, 0.03125)))} AS area_overlap
        FROM squares a JOIN squares b ON a.w < b.e + 0.25 AND b.w + 0.25 < a.e AND a.s < b.n AND b.s < a.n"""


@query("pierced_shapes", """
    SELECT poly_id, 2 AS holes_and_parts_more, 0.25e0 - 0.0625e0 + 0.00390625e0 AS surface, poly_lon + 0.0625e0 * 0.00390625e0 / 0.19140625e0 AS lon, poly_lat AS lat, n
    FROM polygons JOIN (SELECT poly_id, sum(num_cases) AS n FROM cases GROUP BY 1) USING (poly_id)""", r="surface lon lat", i="holes_and_parts_more", covers="I1 I4 A10")
def _(t):
    r = F.col("rings")
    c = geo.centroid(r)
    shapes = spatial.with_rings(pierced(t)).select("poly_id", (F.size(r) - 1).alias("holes_and_parts_more"), geo.area(r).alias("surface"), c["lon"].alias("lon"), c["lat"].alias("lat"))
    return shapes.join(t.cases.groupBy("poly_id").agg(F.sum("num_cases").alias("n")), "poly_id")


@query("cases_in_pierced_areas", f"""
    SELECT CAST(ts AS DATE) AS date_time, poly_name AS location, poly_id, CAST(count(*) AS DOUBLE) AS num_cases, sum(value) AS num_weight
    FROM (SELECT *, lon AS x, lat AS y FROM points) JOIN squares ON {IN_SQUARE} AND (NOT ({HOLE}) OR {ISLAND}) GROUP BY 1, 2, 3""", d="date_time", r="num_weight", covers="C7 J2 A10")
def _(t):
    return agglomerate.cases_by_geometry(located_cases(t), pierced(t))


@query("pierced_overlap", f"SELECT poly_id, external_polygon_id, area_overlap FROM ({PIERCED})", r="area_overlap", covers="C12")
def _(t):
    return spatial.overlap_weights(spatial.with_rings(pierced(t)), region_squares(t), "poly_id", "external_polygon_id", 0.5)


@query("users_meeting_pierced_areas", f"""
    SELECT DISTINCT poly_id, user_id FROM (SELECT DISTINCT user_id, lon AS x, lat AS y FROM points) JOIN squares ON x + 0.03e0 >= w AND x - 0.03e0 <= e AND y + 0.03e0 >= s AND y - 0.03e0 <= n
    AND NOT (abs(x - poly_lon) + 0.03e0 < 0.125 AND abs(y - poly_lat) + 0.03e0 < 0.125 AND NOT (abs(x - poly_lon - 0.0625) <= 0.06125e0 AND abs(y - poly_lat) <= 0.06125e0))""", covers="C10")
def _(t):
    """A small square around each user's place against areas with holes and islands."""
    from wayflux.sources.testdata import square_wkt

    u = t.points.select("user_id", "lon", "lat").distinct()
    boxes = spatial.with_rings(u.select("user_id", square_wkt(F.col("lon"), F.col("lat"), 0.03).alias("geometry")))
    return spatial.meeting_pairs(spatial.with_rings(pierced(t)), boxes, "poly_id", "user_id", 0.25)


@query("merged_geometry_read_back", """
    WITH RECURSIVE m AS (SELECT * FROM squares JOIN community_map USING (poly_id)),
    l AS (SELECT a.community_id, a.poly_id AS p, b.poly_id AS q FROM m a JOIN m b ON a.community_id = b.community_id AND abs(a.poly_lon - b.poly_lon) + abs(a.poly_lat - b.poly_lat) <= 0.5),
    r AS (SELECT * FROM l UNION SELECT r.community_id, r.p, l.q FROM r JOIN l ON l.p = r.q),
    parts AS (SELECT community_id, count(DISTINCT root) AS parts FROM (SELECT community_id, p, min(q) AS root FROM r GROUP BY 1, 2) GROUP BY 1)
    SELECT community_id, parts, sum((e - w) * (n - s)) AS surface FROM m JOIN parts USING (community_id) GROUP BY 1, 2""", r="surface", i="parts", covers="D11 A10 I4")
def _(t):
    df = t.polygons.join(t.community_map.select("poly_id", "community_id"), "poly_id")
    merged = rules.agglomerate(df, [rules.Rule("geometry", "merge_geometry")], ["community_id"], ["geometry"])
    return spatial.with_rings(merged).select("community_id", F.size("rings").alias("parts"), geo.area(F.col("rings")).alias("surface"))


@query("union_of_overlapping_areas", """
    WITH c AS (SELECT DISTINCT community_id, CAST((poly_lon - 0.375) * 8 AS BIGINT) + i AS x, CAST((poly_lat - 0.375) * 8 AS BIGINT) + j AS y
               FROM polygons JOIN (SELECT poly_id, community_id FROM community_map) USING (poly_id), range(6) a(i), range(6) b(j)),
    side AS (SELECT c.community_id, count(*) AS sides FROM c, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) v(dx, dy)
             WHERE NOT EXISTS (SELECT 1 FROM c o WHERE o.community_id = c.community_id AND o.x = c.x + dx AND o.y = c.y + dy) GROUP BY 1)
    SELECT community_id, count(*) / 64e0 AS surface, any_value(sides) / 8e0 AS border FROM c JOIN side USING (community_id) GROUP BY 1""", r="surface border", covers="D11 J3")
def _(t):
    """Squares half as large again as their grid, so that neighbours overlap."""
    from wayflux.operators.dissolve import dissolve
    from wayflux.sources.testdata import square_wkt

    wide = t.polygons.select("poly_id", square_wkt(F.col("poly_lon"), F.col("poly_lat"), 0.375).alias("geometry")).join(t.community_map.select("poly_id", "community_id"), "poly_id")
    merged = spatial.with_rings(dissolve(wide, ["community_id"], size=0.5))
    length = F.aggregate(geo.edges_of(F.col("rings")), F.lit(0.0), lambda acc, e: acc + F.abs(e["x2"] - e["x1"]) + F.abs(e["y2"] - e["y1"]))
    return merged.select("community_id", geo.area(F.col("rings")).alias("surface"), length.alias("border"))
