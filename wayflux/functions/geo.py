"""Geometry column functions on WKT text and on the rings of a shape (ARRAY<ARRAY<STRUCT<lon,lat>>>)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KM_PER_DEGREE = 110.567
EARTH_RADIUS_KM = 6371.0
GRID_RADIUS_KM = 6371.228  # sphere of the equal-area plane
_NUM = r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"


def line_point(wkt: Column, pos: int, axis: str) -> Column:
    """Longitude or latitude of the pos-th point (1-based) of a LINESTRING text."""
    pairs = F.regexp_extract_all(wkt, F.lit(f"{_NUM} {_NUM}"), F.lit(0))
    part = F.split(F.get(pairs, F.lit(pos - 1)), " ")
    return F.get(part, F.lit(0 if axis == "lon" else 1)).cast("double")


def rings_from_wkt(wkt: Column) -> Column:
    """All rings of a POLYGON or MULTIPOLYGON text: parts counter-clockwise, holes clockwise.

    A ring that opens a part follows a second '('; the others of the part are holes. The order
    lets areas and centroids be signed sums over all edges. A null text gives null, an empty
    shape or text without coordinates an empty array.
    """
    texts = F.regexp_extract_all(wkt, F.lit(r"(\(\s*)?\([^()]+\)"), F.lit(0))
    rings = F.transform(texts, lambda t, i: F.struct((t.rlike(r"^\(\s*\(") | (i == 0)).alias("part"), _points(t).alias("points")))
    rings = F.filter(rings, lambda r: F.size(r["points"]) > 1)
    return F.transform(
        rings, lambda r: F.when((_twice_area(_segments(r["points"]), r["points"][0]) > 0) == r["part"], r["points"]).otherwise(F.reverse(r["points"]))
    )


def _points(text: Column) -> Column:
    pairs = F.regexp_extract_all(text, F.lit(rf"{_NUM}\s+{_NUM}"), F.lit(0))
    split = F.transform(pairs, lambda p: F.split(p, r"\s+"))
    return F.transform(split, lambda p: F.struct(p[0].cast("double").alias("lon"), p[1].cast("double").alias("lat")))


def _segments(ring: Column) -> Column:
    return F.zip_with(
        F.slice(ring, F.lit(1), F.size(ring) - 1),
        F.slice(ring, F.lit(2), F.size(ring) - 1),
        lambda a, b: F.struct(
            a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2")
        ),
    )


def _twice_area(edges: Column, origin: Column) -> Column:
    """Signed, taken about `origin` to keep the digits."""
    x0, y0 = origin["lon"], origin["lat"]
    return F.aggregate(
        edges,
        F.lit(0.0),
        lambda acc, e: acc + (e["x1"] - x0) * (e["y2"] - y0) - (e["x2"] - x0) * (e["y1"] - y0),
    )


def edges_of(rings: Column) -> Column:
    """Segments of all closed rings as structs x1,y1,x2,y2."""
    return F.flatten(F.transform(rings, _segments))


def inside(lon: Column, lat: Column, edges: Column) -> Column:
    """Even-odd ray test over the edges of a shape with parts and holes, borders left out."""
    def crosses(e):
        at = e["x1"] + (lat - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
        return ((e["y1"] > lat) != (e["y2"] > lat)) & (lon < at)

    def on_edge(e):
        side = (e["x2"] - e["x1"]) * (lat - e["y1"]) - (e["y2"] - e["y1"]) * (lon - e["x1"])
        return (
            (side == 0.0)
            & lon.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & lat.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        )

    odd = F.size(F.filter(edges, crosses)) % 2 == 1
    return odd & ~F.exists(edges, on_edge)


def _origin(rings: Column) -> Column:
    return F.get(F.get(rings, F.lit(0)), F.lit(0))


def centroid(rings: Column) -> Column:
    """Planar centroid of the whole shape (shoelace), taken about the first vertex to keep the digits."""
    x0, y0 = _origin(rings)["lon"], _origin(rings)["lat"]
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def step(acc, e):
        x1, y1, x2, y2 = e["x1"] - x0, e["y1"] - y0, e["x2"] - x0, e["y2"] - y0
        w = x1 * y2 - x2 * y1
        return F.struct(
            (acc["a"] + w).alias("a"), (acc["x"] + (x1 + x2) * w).alias("x"), (acc["y"] + (y1 + y2) * w).alias("y")
        )

    return F.aggregate(
        edges_of(rings),
        zero,
        step,
        lambda s: F.struct(
            (x0 + s["x"] / (3 * s["a"])).alias("lon"), (y0 + s["y"] / (3 * s["a"])).alias("lat")
        ),
    )


def area(rings: Column) -> Column:
    """Area of all parts less their holes, in the square of the coordinates' unit."""
    return _twice_area(edges_of(rings), _origin(rings)) / 2


def equal_area(rings: Column) -> Column:
    """Rings in km on the cylindrical equal-area plane: areas there are areas on the sphere."""
    def project(p):
        return F.struct((GRID_RADIUS_KM * F.radians(p["lon"])).alias("lon"), (GRID_RADIUS_KM * F.sin(F.radians(p["lat"]))).alias("lat"))

    return F.transform(rings, lambda r: F.transform(r, project))


def shared_area(a: Column, b: Column) -> Column:
    """Exact area of the overlap of two shapes given by the edges of their turned rings.

    A shape is the signed sum of the regions above its edges, so the overlap is the signed sum,
    over pairs of edges, of the region above both within their common span.
    """
    top = F.array_max(F.transform(a, lambda e: F.greatest(e["y1"], e["y2"])))

    def height(e, x):
        return e["y1"] + (x - e["x1"]) * (e["y2"] - e["y1"]) / F.nullif(e["x2"] - e["x1"], F.lit(0.0))

    def above(e, f):
        lo = F.greatest(F.least(e["x1"], e["x2"]), F.least(f["x1"], f["x2"]))
        hi = F.least(F.greatest(e["x1"], e["x2"]), F.greatest(f["x1"], f["x2"]))
        el, er, fl, fr = height(e, lo), height(e, hi), height(f, lo), height(f, hi)
        dl, dr = F.abs(el - fl), F.abs(er - fr)
        # the mean of the larger line is the mean of both plus half the mean gap
        cut = (dl * dl + dr * dr) / F.nullif(dl + dr, F.lit(0.0)) / 2
        gap = F.when((el - fl) * (er - fr) >= 0, (dl + dr) / 2).otherwise(cut)
        mean = (el + er + fl + fr) / 4 + gap / 2
        sign = F.signum(e["x2"] - e["x1"]) * F.signum(f["x2"] - f["x1"])
        return F.when(hi > lo, sign * (hi - lo) * (top - mean)).otherwise(0.0)

    return F.aggregate(a, F.lit(0.0), lambda acc, e: acc + F.aggregate(b, F.lit(0.0), lambda s, f: s + above(e, f)))


def planar_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    return F.sqrt((lon1 - lon2) * (lon1 - lon2) + (lat1 - lat2) * (lat1 - lat2)) * KM_PER_DEGREE


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def within_box(lon: Column, lat: Column, min_lat: float, max_lat: float, min_lon: float, max_lon: float) -> Column:
    return lat.between(min_lat, max_lat) & lon.between(min_lon, max_lon)


def within_circle(lon: Column, lat: Column, clon: Column, clat: Column, metres: float) -> Column:
    """The buffer around a point, kept as a distance predicate."""
    return haversine_km(lon, lat, clon, clat) <= metres / 1000.0


def cell(v: Column, size: float) -> Column:
    return F.floor(v / size).cast("bigint")


def segments_meet(a: Column, b: Column) -> Column:
    """True when two segments share at least one point."""
    def side(s, x, y):
        return F.signum((s["x2"] - s["x1"]) * (y - s["y1"]) - (s["y2"] - s["y1"]) * (x - s["x1"]))

    def covers(s, x, y):
        return (
            (side(s, x, y) == 0)
            & x.between(F.least(s["x1"], s["x2"]), F.greatest(s["x1"], s["x2"]))
            & y.between(F.least(s["y1"], s["y2"]), F.greatest(s["y1"], s["y2"]))
        )

    a1, a2 = side(b, a["x1"], a["y1"]), side(b, a["x2"], a["y2"])
    b1, b2 = side(a, b["x1"], b["y1"]), side(a, b["x2"], b["y2"])
    proper = (a1 * a2 < 0) & (b1 * b2 < 0)
    return (
        proper
        | covers(b, a["x1"], a["y1"])
        | covers(b, a["x2"], a["y2"])
        | covers(a, b["x1"], b["y1"])
        | covers(a, b["x2"], b["y2"])
    )


def segments_cross(a: Column, b: Column) -> Column:
    """True when two segments cross at an inner point of both."""
    def side(s, x, y):
        return F.signum((s["x2"] - s["x1"]) * (y - s["y1"]) - (s["y2"] - s["y1"]) * (x - s["x1"]))

    return (side(b, a["x1"], a["y1"]) * side(b, a["x2"], a["y2"]) < 0) & (
        side(a, b["x1"], b["y1"]) * side(a, b["x2"], b["y2"]) < 0
    )
