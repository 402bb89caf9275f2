"""Areas merged into one shape: borders noded, inner ones cancelled, the rest chained to rings."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayflux.functions import geo
from wayflux.operators import cells, spatial

EMPTY = "MULTIPOLYGON EMPTY"
Point = tuple[float, float]


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def _cut_points(s: Column, o: Column) -> Column:
    """Where segment `o` cuts segment `s`: ends of `o` on it, and the point where both cross.

    The crossing point is reckoned from the pair in a fixed order, so both segments get the same digits.
    """
    def on(x, y):
        across = (s["x2"] - s["x1"]) * (y - s["y1"]) - (s["y2"] - s["y1"]) * (x - s["x1"])
        return (across == 0) & x.between(F.least(s["x1"], s["x2"]), F.greatest(s["x1"], s["x2"])) & y.between(F.least(s["y1"], s["y2"]), F.greatest(s["y1"], s["y2"]))

    a, b = F.least(s, o), F.greatest(s, o)
    ax, ay, bx, by = a["x2"] - a["x1"], a["y2"] - a["y1"], b["x2"] - b["x1"], b["y2"] - b["y1"]
    t = ((b["x1"] - a["x1"]) * by - (b["y1"] - a["y1"]) * bx) / F.nullif(ax * by - ay * bx, F.lit(0.0))
    crossing = F.when(geo.segments_cross(s, o), _point(a["x1"] + t * ax, a["y1"] + t * ay))
    ends = [F.when(on(o[f"x{k}"], o[f"y{k}"]), _point(o[f"x{k}"], o[f"y{k}"])) for k in (1, 2)]
    return F.filter(F.array(crossing, *ends), lambda p: p.isNotNull())


def noded(segs: DataFrame, keys: list[str], size: float) -> DataFrame:
    """(keys, seg, p, q): the pieces of each distinct segment between the points where others of its group meet it."""
    own = segs.select(*keys, "seg").distinct()
    other = own.withColumnRenamed("seg", "seg2")
    met = cells.meet(
        spatial._deal(own, "seg", size), spatial._deal(other, "seg2", size), size, spatial._refine("seg"), spatial._refine("seg2"),
        cells.many_pairs(), within_keys=keys,
    ).filter("seg <> seg2")
    cuts = met.select(*keys, "seg", F.explode(_cut_points(F.col("seg"), F.col("seg2"))).alias("at")).groupBy(*keys, "seg").agg(F.collect_set("at").alias("cuts"))
    s = F.col("seg")
    dx, dy = s["x2"] - s["x1"], s["y2"] - s["y1"]
    points = F.array_union(F.array(_point(s["x1"], s["y1"]), _point(s["x2"], s["y2"])), F.coalesce("cuts", F.array().cast("array<struct<x:double,y:double>>")))
    along = F.array_sort(F.transform(points, lambda p: F.struct(((p["x"] - s["x1"]) * dx + (p["y"] - s["y1"]) * dy).alias("t"), p["x"].alias("x"), p["y"].alias("y"))))
    joined = own.join(cuts, [*keys, "seg"], "left").withColumn("along", along)
    steps = F.arrays_zip(F.slice("along", F.lit(1), F.size("along") - 1).alias("p"), F.slice("along", F.lit(2), F.size("along") - 1).alias("q"))
    pieces = joined.select(*keys, "seg", F.explode(steps).alias("step"))
    return pieces.select(*keys, "seg", *(_point(F.col(f"step.{k}.x"), F.col(f"step.{k}.y")).alias(k) for k in "pq"))


def union_borders(areas: DataFrame, keys: list[str], rings: str = "rings", size: float = 0.25) -> DataFrame:
    """(keys, x1, y1, x2, y2): the border of each group's union, as directed segments with the inside on their left.

    A piece of border stays if all shapes it bounds are on one side of it, and no other shape of its group lies over it.
    """
    member = F.md5(F.to_json(F.col(rings)))
    known = areas.filter(F.size(rings) > 0).select(*keys, member.alias("_m"), F.col(rings).alias("rings"))
    segs = known.select(*keys, "_m", F.explode(geo.edges_of(F.col("rings"))).alias("seg")).filter("seg.x1 <> seg.x2 OR seg.y1 <> seg.y2")
    owned = segs.groupBy(*keys, "seg").agg(F.collect_set("_m").alias("owners"))
    pieces = noded(segs, keys, size).join(owned, [*keys, "seg"])
    forth = F.col("p") < F.col("q")
    both = pieces.groupBy(*keys, F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).agg(
        F.max(forth).alias("forth"), F.max(~forth).alias("back"), F.array_distinct(F.flatten(F.collect_set("owners"))).alias("owners")
    )
    border = both.filter(F.col("forth") != F.col("back"))
    mid = border.select(*keys, "a", "b", "owners", ((F.col("a.x") + F.col("b.x")) / 2).alias("_x"), ((F.col("a.y") + F.col("b.y")) / 2).alias("_y"))
    shapes = known.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_m", "rings")
    over = spatial.points_in_areas(mid, shapes, "_x", "_y", [*(f"_k{i}" for i in range(len(keys))), "_m"], size)
    for i, k in enumerate(keys):
        over = over.filter(F.col(k) == F.col(f"_k{i}"))
    hidden = over.filter(~F.array_contains("owners", F.col("_m"))).select(*keys, "a", "b").distinct()
    kept = border.join(hidden, [*keys, "a", "b"], "left_anti")
    p, q = (F.when(F.col("forth"), F.col(x)).otherwise(F.col(y)) for x, y in (("a", "b"), ("b", "a")))
    return kept.select(*keys, p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2"))


def _area(ring: list[Point]) -> float:
    x0, y0 = ring[0]
    return sum((a[0] - x0) * (b[1] - y0) - (b[0] - x0) * (a[1] - y0) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def _holds(ring: list[Point], x: float, y: float) -> bool:
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


def chained(segments: Iterator[tuple[float, float, float, float]]) -> list[list[Point]]:
    """Closed rings of directed segments with the inside on their left, without points on straight lines.

    Where several go on from a point, the next is the first one clockwise from where the last came: the inside between
    both is one corner. Rings begin at their smallest point.
    """
    away: dict[Point, list[Point]] = defaultdict(list)
    for x1, y1, x2, y2 in segments:
        away[x1, y1].append((x2, y2))
    rings = []
    for start in sorted(away):
        while away[start]:
            ring, at, before = [], start, None
            while True:
                ways = away[at]
                if not ways:
                    break  # borders that do not close, from shapes that cross themselves
                if before is None or len(ways) == 1:
                    k = 0
                else:
                    back = math.atan2(before[1] - at[1], before[0] - at[0])
                    turns = [(back - math.atan2(w[1] - at[1], w[0] - at[0])) % (2 * math.pi) for w in ways]
                    k = turns.index(min(turns))
                ring.append(at)
                before, at = at, ways.pop(k)
                if at == start and not any(_comes_before(w, ring[1], before, at) for w in away[at]):
                    break
            ring = _straightened(ring)
            if len(ring) > 2:
                k = ring.index(min(ring))
                rings.append(ring[k:] + ring[:k])
    return rings


def _comes_before(way: Point, first: Point, before: Point, at: Point) -> bool:
    """Whether `way` comes before `first`, clockwise from `before`, around `at`: then the ring has not closed yet."""
    back = math.atan2(before[1] - at[1], before[0] - at[0])
    turn = [(back - math.atan2(p[1] - at[1], p[0] - at[0])) % (2 * math.pi) for p in (way, first)]
    return turn[0] < turn[1]


def _straightened(ring: list[Point]) -> list[Point]:
    out = ring
    while len(out) > 2:
        kept = [
            b for a, b, c in zip(out[-1:] + out[:-1], out, out[1:] + out[:1], strict=True)
            if (b[0] - a[0]) * (c[1] - b[1]) != (b[1] - a[1]) * (c[0] - b[0])
        ]
        if len(kept) == len(out):
            break
        out = kept
    return out


def shape_text(rings: list[list[Point]]) -> str:
    """MULTIPOLYGON text: each part (turned left) with the holes (turned right) that lie in no smaller part."""
    parts = sorted((r for r in rings if _area(r) > 0), key=lambda r: (_area(r), r))
    holes: dict[int, list] = defaultdict(list)
    for hole in sorted(r for r in rings if _area(r) < 0):
        # a point just inside the hole's first corner would do; the middle of its first edge lies on no part's border but at touching points
        x, y = (hole[0][0] + hole[1][0]) / 2, (hole[0][1] + hole[1][1]) / 2
        around = [k for k, p in enumerate(parts) if _holds(p, x, y)]
        if around:
            holes[around[0]].append(hole)

    def text(ring):
        return "(" + ", ".join(f"{x!r} {y!r}" for x, y in [*ring, ring[0]]) + ")"

    order = sorted(range(len(parts)), key=lambda k: parts[k])
    return "MULTIPOLYGON (" + ", ".join("(" + ", ".join(map(text, [parts[k], *holes[k]])) + ")" for k in order) + ")" if parts else EMPTY


def dissolve(areas: DataFrame, keys: list[str], geometry: str = "geometry", size: float = 0.25) -> DataFrame:
    """(keys, geometry): one MULTIPOLYGON text per group, the union of its areas.

    Borders are noded and cancelled over cells of `size`; what is left of a group, which its one row holds anyway, is chained
    in one place. Null and empty shapes add nothing; a group without any other is empty.
    """
    shapes = areas.select(*keys, geo.rings_from_wkt(F.col(geometry)).alias("rings"))
    schema = T.StructType([*(areas.schema[k] for k in keys), T.StructField(geometry, T.StringType())])

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        lines = zip(*(pdf[c].tolist() for c in ("x1", "y1", "x2", "y2")), strict=True)
        return pd.DataFrame([[*(pdf[k].iloc[0] for k in keys), shape_text(chained(lines))]], columns=[*keys, geometry])

    merged = union_borders(shapes, keys, size=size).groupBy(*keys).applyInPandas(one, schema)
    found = areas.select(*keys).distinct().join(merged, keys, "left")
    return found.select(*keys, F.coalesce(geometry, F.lit(EMPTY)).alias(geometry))
