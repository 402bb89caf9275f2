"""Cell tree, overlap per cell, merged shapes, and ranks over ranges, against plain computation."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayflux.functions import geo
from wayflux.operators import cells, dissolve, ranking, spatial, windows


def text(ring):
    return "(" + ", ".join(f"{x!r} {y!r}" for x, y in [*ring, ring[0]]) + ")"


def star(rng, x, y, corners, low, high, digits=None):
    turn = np.sort(rng.uniform(0, 2 * np.pi, corners))
    reach = rng.uniform(low, high, corners)
    out = [(float(x + r * np.cos(t)), float(y + r * np.sin(t))) for t, r in zip(turn, reach)]
    return out if digits is None else [(round(a * digits) / digits, round(b * digits) / digits) for a, b in out]


def shapes(spark, rows, key="k string"):
    return spatial.with_rings(spark.createDataFrame(rows, f"{key}, geometry string"))


@pytest.mark.parametrize("size, rows, edges", [(0.5, 10**6, 64), (0.5, 12, 3), (2.0, 5, 1), (0.3, 1, 2)])
def test_points_go_down_the_tree(spark, monkeypatch, size, rows, edges):
    """Half of the points lie in one cell; corners and borders lie on cell borders; shapes have parts and holes."""
    monkeypatch.setattr(cells, "ROWS_PER_CELL", rows)
    monkeypatch.setattr(cells, "EDGES_PER_CELL", edges)
    rng = np.random.default_rng(8)
    areas = [("square", "POLYGON ((0.0 0.0, 2.0 0.0, 2.0 2.0, 0.0 2.0, 0.0 0.0))")]
    areas.append(("pierced", f"MULTIPOLYGON (({text([(-3.0, -3.0), (5.0, -3.0), (5.0, 5.0), (-3.0, 5.0)])}, {text([(1.0, 1.0), (1.0, 3.0), (3.0, 3.0), (3.0, 1.0)])}), ({text([(1.5, 1.5), (2.5, 1.5), (2.0, 2.5)])}))"))
    areas += [(f"star{k}", "POLYGON (" + text(star(rng, *rng.uniform(-2, 4, 2), 40, 0.2, 2.5, 8)) + ")") for k in range(4)]
    areas += [("none", None), ("empty", "POLYGON EMPTY")]
    points = [(float(x), float(y)) for x, y in rng.integers(-28, 44, (150, 2)) / 8]
    points += [(float(x), float(y)) for x, y in rng.uniform(1.0, 1.5, (150, 2))] + [(1.25, 1.25)] * 30
    points += [(None, 1.0), (float("nan"), 1.0), (1.0, float("inf"))]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "i int, x double, y double")
    ringed = shapes(spark, areas)
    got = sorted((r.i, r.k) for r in spatial.points_in_areas(df, ringed, "x", "y", ["k"], size).collect())
    every = df.filter("x < 100 AND y < 100").crossJoin(ringed.select("k", geo.edges_of(F.col("rings")).alias("e")))
    want = sorted((r.i, r.k) for r in every.filter(geo.inside(F.col("x"), F.col("y"), F.col("e"))).select("i", "k").collect())
    assert got == want and len({k for _, k in want}) == 6


def test_cells_hold_few_edges_and_inside_cells_none():
    ring = np.array(star(np.random.default_rng(1), 0.0, 0.0, 400, 3.0, 4.0))
    e = np.hstack([ring, np.roll(ring, -1, axis=0)])
    found = list(cells.cut(e, 0, np.inf, -20, -20, 40, 40, 0.25))
    inside = [c for c in found if c[3] is None]
    assert max(len(c[3]) for c in found if c[3] is not None) < 40 and len(inside) > 300
    area = sum(0.25 * 0.25 for _ in inside)
    turned = abs(float((e[:, 0] * e[:, 3] - e[:, 2] * e[:, 1]).sum())) / 2
    border = sum((c[3] is not None) * 0.25 * 0.25 for c in found)
    assert area < turned < area + border


@pytest.mark.parametrize("size, edges", [(1.0, 64), (0.75, 4), (5.0, 8)])
def test_overlap_by_cell_equals_whole_shapes(spark, monkeypatch, size, edges):
    monkeypatch.setattr(cells, "EDGES_PER_CELL", edges)
    rng = np.random.default_rng(3)
    one = [(f"a{k}", "POLYGON (" + text(star(rng, *rng.uniform(-2, 2, 2), 30, 0.5, 3.0)) + ")") for k in range(5)]
    one.append(("box", "POLYGON ((0.0 0.0, 3.0 0.0, 3.0 3.0, 0.0 3.0, 0.0 0.0), (1.0 1.0, 2.0 1.0, 2.0 2.0, 1.0 2.0, 1.0 1.0))"))
    two = [(f"b{k}", "POLYGON (" + text(star(rng, *rng.uniform(-2, 2, 2), 20, 0.5, 3.0)) + ")") for k in range(5)]
    two += [("same", one[-1][1]), ("hole", "POLYGON ((1.0 1.0, 2.0 1.0, 2.0 2.0, 1.0 2.0, 1.0 1.0))"), ("far", "POLYGON ((50.0 50.0, 51.0 50.0, 51.0 51.0, 50.0 50.0))")]
    a, b = shapes(spark, one), shapes(spark, two, "o string")
    got = {(r.k, r.o): r.shared for r in cells.shared_areas(a, b, "k", "o", size).collect()}
    both = a.crossJoin(b.withColumnRenamed("rings", "rings2"))
    want = both.select("k", "o", geo.shared_area(geo.edges_of(F.col("rings")), geo.edges_of(F.col("rings2"))).alias("s")).collect()
    assert all(abs(got.get((r.k, r.o), 0.0) - r.s) < 1e-9 for r in want)
    assert abs(got["box", "same"] - 8.0) < 1e-12 and abs(got.get(("box", "hole"), 0.0)) < 1e-12


def test_overlap_of_two_shapes_of_ten_thousand_edges(spark):
    turn = 2 * np.pi * np.arange(10_000) / 10_000
    round_ = lambda x: "POLYGON (" + text([(float(x + np.cos(t)), float(np.sin(t))) for t in turn]) + ")"
    a, b = shapes(spark, [("a", round_(0.0))]), shapes(spark, [("b", round_(0.8))], "o string")
    got = cells.shared_areas(a, b, "k", "o", 0.5).first().shared
    lens = 2 * math.acos(0.4) - 0.4 * math.sqrt(4 - 0.64)
    assert abs(got - lens) < 1e-6


def raster(boxes):
    return {(i, j) for x, y, w, h in boxes for i in range(x, x + w) for j in range(y, y + h)}


def box(x, y, w, h):
    return "POLYGON (" + text([(float(x), float(y)), (float(x + w), float(y)), (float(x + w), float(y + h)), (float(x), float(y + h))]) + ")"


def test_merged_boxes_equal_their_raster(spark):
    """Overlaps, touching corners, holes, borders that share a part of their length, equal shapes."""
    rng = np.random.default_rng(4)
    groups = {f"g{k}": [tuple(int(v) for v in (*rng.integers(0, 9, 2), *rng.integers(1, 5, 2))) for _ in range(n)] for k, n in enumerate((1, 3, 6, 10, 14, 20))}
    groups["frame"] = [(0, 0, 9, 2), (0, 7, 9, 2), (0, 0, 2, 9), (7, 0, 2, 9), (4, 4, 1, 1)]
    groups["corners"] = [(0, 0, 1, 1), (1, 1, 1, 1), (0, 2, 1, 1), (2, 2, 3, 3), (2, 2, 3, 3)]
    rows = [(g, box(*b)) for g, bs in groups.items() for b in bs] + [("g1", None), ("g2", "POLYGON EMPTY"), ("bare", None)]
    merged = dissolve.dissolve(spark.createDataFrame(rows, "g string, geometry string"), ["g"], size=2.0)
    read = spatial.with_rings(merged).select("g", "rings", "geometry", geo.area(F.col("rings")).alias("area"), geo.edges_of(F.col("rings")).alias("e")).collect()
    assert {r.g for r in read} == {*groups, "bare"} and next(r.geometry for r in read if r.g == "bare") == dissolve.EMPTY
    for r in read:
        if r.g == "bare":
            continue
        full = raster(groups[r.g])
        assert r.area == len(full)
        around = sum((i + a, j + b) not in full for i, j in full for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1)))
        assert sum(abs(e.x2 - e.x1) + abs(e.y2 - e.y1) for e in r.e) == around
        for i, j in itertools.product(range(-1, 15), repeat=2):
            odd = sum((e.y1 > j + 0.5) != (e.y2 > j + 0.5) and e.x1 > i + 0.5 for e in r.e) % 2 == 1
            assert odd == ((i, j) in full)
        corners = [(p.lon, p.lat) for ring in r.rings for p in ring[:-1]]
        assert all(sum((i + a, j + b) in full for a in (0, -1) for b in (0, -1)) in (1, 2, 3) for i, j in [(int(x), int(y)) for x, y in corners])
        straight = [((a.lon, a.lat), (b.lon, b.lat), (c.lon, c.lat)) for ring in r.rings for a, b, c in zip(ring, ring[1:], [*ring[2:], ring[1]])]
        assert all((b[0] - a[0]) * (c[1] - b[1]) != (b[1] - a[1]) * (c[0] - b[0]) for a, b, c in straight)


def test_merged_triangles_hold_the_same_points(spark):
    rng = np.random.default_rng(9)
    rows = [(g, "POLYGON (" + text([(float(x), float(y)) for x, y in rng.uniform(0, 4, (3, 2))]) + ")") for g in "ab" for _ in range(7)]
    df = spark.createDataFrame(rows, "g string, geometry string")
    merged = spatial.with_rings(dissolve.dissolve(df, ["g"], size=1.0))
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 4, (400, 2)))], "i int, x double, y double")
    got = {(r.i, r.g) for r in spatial.points_in_areas(points, merged, "x", "y", ["g"]).collect()}
    assert got == {(r.i, r.g) for r in spatial.points_in_areas(points, spatial.with_rings(df), "x", "y", ["g"]).collect()}


@pytest.mark.parametrize("limit", [10, 10**6])
def test_ranks_percentiles_and_shares_over_ranges(spark, limit):
    rng = np.random.default_rng(2)
    rows = [(i, ["a", "b", None, "hot"][int(k)], float(v)) for i, (k, v) in enumerate(zip(np.minimum(rng.integers(0, 9, 3000), 3), rng.integers(0, 40, 3000)))]
    df = spark.createDataFrame(rows, "id long, k string, v double")
    for keys in ([], ["k"]):
        want = {}
        for key in {r[1] for r in rows} if keys else {0}:
            own = sorted((r for r in rows if not keys or r[1] == key), key=lambda r: (-r[2], r[0]))
            want |= {r[0]: (i + 1, len(own)) for i, r in enumerate(own) if not keys or key is not None}
        assert {r.id: (r["rank"], r["n"]) for r in ranking.distributed_rank(df, keys, "v", "id", limit).collect()} == want
        got = ranking.exact_percentiles(df, keys, "v", [0.0, 0.3, 0.5, 1.0], rows_per_task=limit).collect()
        for r in got:
            assert np.allclose(r.q, np.quantile([x[2] for x in rows if not keys or x[1] == r.k], [0.0, 0.3, 0.5, 1.0]))
        assert len(got) == (3 if keys else 1)


def test_coverage_equals_a_plain_loop(spark):
    rows = [(i, float(v)) for i, v in enumerate(np.random.default_rng(6).integers(1, 50, 500))]
    plan = windows.coverage(spark.createDataFrame(rows, "id long, v double"), "v", "id", 0.8)
    total, run, want = sum(v for _, v in rows), 0.0, {}
    for i, v in sorted(rows, key=lambda r: (-r[1], r[0])):
        if run / total <= 0.8:
            want[i] = (run + v) / total
        run += v
    got = {r.id: r.coverage for r in plan.collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-12 for i in want)
    assert "SinglePartition" not in plan._jdf.queryExecution().executedPlan().toString()
