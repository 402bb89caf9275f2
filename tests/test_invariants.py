"""Brute-force and invariant checks of the operators that SQL cannot state."""

import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayflux.functions import geo, special
from wayflux.operators import ranking, spatial, windows
from wayflux.operators.cover import greedy_heads
from wayflux.plans import agglomerate, epi, forecast, graphs, places, series, shape
from wayflux.session import salted_join

D0 = dt.date(2020, 1, 1)


def test_distributed_rank_matches_sort(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), str(k), float(v)) for i, (k, v) in enumerate(zip(rng.integers(0, 3, 3000), rng.integers(0, 20, 3000)))]
    rows += [(i, "hot", 1.0) for i in range(3000, 5000)]  # one score for two fifths of the rows
    df = spark.createDataFrame(rows, "id long, k string, v double")
    got = {r.id: (r["rank"], r["n"]) for r in ranking.distributed_rank(df, ["k"], "v", "id", rows_per_task=100).collect()}
    for k, grp in itertools.groupby(sorted(rows, key=lambda r: (r[1], -r[2], r[0])), key=lambda r: r[1]):
        grp = list(grp)
        assert [got[r[0]] for r in grp] == [(i + 1, len(grp)) for i in range(len(grp))]


def test_exact_percentiles(spark):
    v = np.concatenate([np.random.default_rng(5).normal(size=997), np.ones(500)])
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    got = ranking.exact_percentiles(df, [], "v", [0.0, 0.1, 0.5, 0.975, 1.0], rows_per_task=50).first()[0]
    assert np.allclose(got, np.quantile(v, [0.0, 0.1, 0.5, 0.975, 1.0]))


def test_salted_join_keeps_every_row(spark):
    big = spark.range(1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id") % 5).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (3, "d")], "k long, s string")
    want = sorted(tuple(r) for r in big.join(small, "k").collect())
    assert sorted(tuple(r) for r in salted_join(big, small, ["k"], rows_per_task=50).collect()) == want
    assert salted_join(big, small, ["k"], "left", rows_per_task=50).count() == big.join(small, "k", "left").count()


def test_greedy_heads_match_sequential(spark):
    rng = np.random.default_rng(11)
    for n in (1, 30):
        pts = rng.random((n, 2))
        near = {(i, j) for i in range(n) for j in range(n) if i != j and np.hypot(*(pts[i] - pts[j])) < 0.25}
        order = rng.permutation(n)
        heads = []
        for i in order:
            if not any((int(i), h) in near for h in heads):
                heads.append(int(i))
        nodes = spark.createDataFrame([(int(i), int(p)) for p, i in enumerate(order)], "id long, ord long")
        pairs = spark.createDataFrame([(int(a), int(b)) for a, b in near], "a long, b long")
        assert sorted(r.id for r in greedy_heads(nodes, pairs).collect()) == sorted(heads)


def test_radial_centres_match_sequential(spark):
    rng = np.random.default_rng(2)
    areas = [(f"p{i}", f"n{i}", float(x), float(y)) for i, (x, y) in enumerate(rng.random((12, 2)) * 2)]
    spots = [(f"l{i}", float(x), float(y), float(100 - i)) for i, (x, y) in enumerate(rng.random((40, 2)) * 2)]
    radius, km = 20.0, 110.567
    taken, want = [], {}
    for name, x, y, _ in spots:
        p = min(areas, key=lambda a: (math.hypot(a[2] - x, a[3] - y), a[0]))
        gaps = [(math.hypot(p[2] - q[2], p[3] - q[3]) * km, k, q) for k, q in enumerate(taken)]
        if gaps and min(gaps)[0] < 2 * radius:
            want[name] = (min(gaps)[2][0], True)
            taken.append(min(gaps)[2])
        else:
            want[name] = (p[0], False)
            taken.append(p)
    cases = spark.createDataFrame(spots, "location string, lon double, lat double, num_cases double")
    table = spark.createDataFrame(areas, "poly_id string, poly_name string, poly_lon double, poly_lat double")
    got, _ = agglomerate.radial_centres(cases, table, radius)
    assert {r.location: (r.poly_id, r.poly_merged) for r in got.collect()} == want


def test_nearest_centre_beyond_first_reach(spark):
    pts = spark.createDataFrame([(0.0, 0.0), (50.0, 20.0), (-3.0, 7.0)], "lon double, lat double")
    cs = spark.createDataFrame([("a", 0.1, 0.0), ("b", 40.0, 20.0), ("c", 90.0, 0.0)], "poly_id string, poly_lon double, poly_lat double")
    got = {(r.lon, r.lat): r.poly_id for r in spatial.nearest_centre(pts, cs).collect()}
    assert got == {(0.0, 0.0): "a", (50.0, 20.0): "b", (-3.0, 7.0): "a"}


def _clipped_area(subject, clip):
    """Area of a polygon cut by the sides of a convex, counter-clockwise one."""
    for (ax, ay), (bx, by) in zip(clip, clip[1:] + clip[:1]):
        def side(p):
            return (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)

        out = []
        for p, q in zip(subject, subject[1:] + subject[:1]):
            sp, sq = side(p), side(q)
            if sp >= 0:
                out.append(p)
            if sp * sq < 0:
                out.append((p[0] + (q[0] - p[0]) * sp / (sp - sq), p[1] + (q[1] - p[1]) * sp / (sp - sq)))
        subject = out
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(subject, subject[1:] + subject[:1]))) / 2 if subject else 0.0


def test_shared_area_of_triangles(spark):
    rng, rows = np.random.default_rng(5), []
    for _ in range(200):
        a, b = rng.uniform(-1, 1, (2, 3, 2)).round(3).tolist()
        b = b if (b[1][0] - b[0][0]) * (b[2][1] - b[0][1]) > (b[1][1] - b[0][1]) * (b[2][0] - b[0][0]) else b[::-1]
        texts = ["POLYGON ((" + ", ".join(f"{x} {y}" for x, y in [*t, t[0]]) + "))" for t in (a, b)]
        rows.append((*texts, _clipped_area([tuple(p) for p in a], [tuple(p) for p in b])))
    df = spark.createDataFrame(rows, "a string, b string, want double")
    ea, eb = (geo.edges_of(geo.rings_from_wkt(F.col(c))) for c in "ab")
    assert all(abs(r.got - r.want) < 1e-12 for r in df.select("want", geo.shared_area(ea, eb).alias("got")).collect())
    assert sum(r[2] > 0.01 for r in rows) > 50


def test_points_in_areas_match_plain_ray_test(spark):
    rng, areas = np.random.default_rng(6), []
    for k in range(12):
        turn = np.sort(rng.uniform(0, 2 * np.pi, 9))
        reach = rng.uniform(0.3, 2.0, 9)
        p = [(round(3 * (k % 4) + r * np.cos(t), 3), round(2 * (k // 4) + r * np.sin(t), 3)) for t, r in zip(turn, reach)]
        areas.append((k, [*p, p[0]]))
    points = rng.uniform([-3, -3], [13, 8], (600, 2)).tolist()

    def within(x, y, ring):
        return sum((b > y) != (d > y) and x < a + (y - b) * (c - a) / (d - b) for (a, b), (c, d) in zip(ring, ring[1:])) % 2 == 1

    shapes = spatial.with_rings(spark.createDataFrame([(k, "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in r) + "))") for k, r in areas], "k int, geometry string"))
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "i int, x double, y double")
    for size in (0.1, 0.7):
        got = {(r.i, r.k) for r in spatial.points_in_areas(df, shapes, "x", "y", ["k"], size).collect()}
        assert got == {(i, k) for i, (x, y) in enumerate(points) for k, ring in areas if within(x, y, ring)}


@pytest.mark.parametrize("rows_per_task", [1, 6, 1_000_000])
def test_page_rank_sums_to_one_and_matches_numpy(spark, rows_per_task):
    """Slices that go their rounds in one task, over all tasks, and one of each."""
    slices = {"h": ([("a", "b", 2.0), ("b", "c", 1.0), ("a", "d", 1.0)], ["a", "b", "c", "d", "alone"], [1.0, 0.0, 1.0, 0.0, 2.0])}
    slices["i"] = ([(f"n{i}", f"n{(i * 3 + 1) % 9}", 1.0 + i) for i in range(9) if i != (i * 3 + 1) % 9], [f"n{i}" for i in range(9)], [0.0] * 9)
    nodes = spark.createDataFrame([(h, i, x) for h, (_, ids, w) in slices.items() for i, x in zip(ids, w)], "hour string, identifier string, weight double")
    edges = spark.createDataFrame([(h, *x) for h, (e, _, _) in slices.items() for x in e], "hour string, id1 string, id2 string, weight double")
    every = {(r.hour, r.identifier): r.centrality for r in graphs.personalised_rank(nodes, edges, ["hour"], rows_per_task=rows_per_task).collect()}
    for h, (e, ids, w) in slices.items():
        n = len(ids)
        m = np.zeros((n, n))
        for a, b, x in e:
            i, j = ids.index(a), ids.index(b)
            m[i, j] += x
            m[j, i] += x
        reset = np.array(w) / sum(w) if sum(w) else np.full(n, 1 / n)
        s = m.sum(axis=1)
        walk = (m / np.where(s > 0, s, 1)[:, None]).T + np.outer(reset, s == 0)
        r = np.linalg.solve(np.eye(n) - 0.85 * walk, 0.15 * reset)
        got = [every[h, i] for i in ids]
        assert abs(sum(got) - 1) < 1e-9 and np.allclose(got, r, rtol=0, atol=1e-12)


def test_communities_split_two_groups(spark):
    left = [(f"a{i}", f"a{j}", 5.0) for i in range(4) for j in range(i + 1, 4)]
    right = [(f"b{i}", f"b{j}", 5.0) for i in range(4) for j in range(i + 1, 4)]
    edges = spark.createDataFrame(left + right + [("a0", "b0", 0.5)], "id1 string, id2 string, weight double")
    ids = spark.createDataFrame([(f"{g}{i}",) for g in "ab" for i in range(4)] + [("z",)], "id string")
    lab = graphs.detect_communities(edges, ids)
    groups = {}
    for r in lab.collect():
        groups.setdefault(r.label, set()).add(r.id)
    assert sorted(map(sorted, groups.values())) == [["a0", "a1", "a2", "a3"], ["b0", "b1", "b2", "b3"], ["z"]]
    single = ids.select("id", F.col("id").alias("label"))
    assert graphs.modularity(edges, lab).first()[0] >= graphs.modularity(edges, single).first()[0]


def test_communities_merge_by_levels(spark):
    """A ring of triangles: moves of single nodes end with the triangles, whole ones then merge."""
    rows = [(f"{c:02}{i}", f"{c:02}{j}", 1.0) for c in range(12) for i in range(3) for j in range(i + 1, 3)]
    rows += [(f"{c:02}0", f"{(c + 1) % 12:02}1", 1.0) for c in range(12)]
    edges = spark.createDataFrame(rows, "id1 string, id2 string, weight double")
    ids = spark.createDataFrame([(f"{c:02}{i}",) for c in range(12) for i in range(3)], "id string")
    triangles = ids.select("id", F.substring("id", 1, 2).alias("label"))
    lab = graphs.detect_communities(edges, ids)
    assert graphs.modularity(edges, lab).first()[0] > graphs.modularity(edges, triangles).first()[0] + 0.01


def _plain_repair(v, variant):
    """Every pass over the whole series, as often as needed; None where it never settles."""
    v, seen = list(v), set()
    while any(v[i] > v[i + 1] for i in range(1, len(v) - 1)):
        if tuple(v) in seen:
            return None
        seen.add(tuple(v))
        for i in range(1, len(v) - 1):
            if v[i] > v[i + 1]:
                middle = (v[i - 1] + v[i + 1]) // 2
                if variant == "look_ahead" and i + 2 < len(v) and v[i] <= v[i + 2]:
                    v[i + 1] = (v[i] + v[i + 2]) // 2
                else:
                    v[i] = v[i + 1] if variant == "midpoint_or_next" and middle == v[i] else middle
    return v


def test_repair_matches_plain_passes(spark):
    rng = np.random.default_rng(9)
    runs = [np.cumsum(rng.integers(-3, 9, rng.integers(1, 25))).tolist() for _ in range(60)] + [[10, 5, 3], [], [4]]
    df = spark.createDataFrame([(k, i, float(x)) for k, v in enumerate(runs) for i, x in enumerate(v)], "k int, t int, v double")
    for variant in ("midpoint", "midpoint_or_next", "look_ahead"):
        got = {}
        for r in windows.repair_cumulative(df, ["k"], "t", "v", variant).orderBy("k", "t").collect():
            got.setdefault(r.k, []).append(r.v)
        for k, v in enumerate(runs):
            want = _plain_repair(v, variant)
            if want is not None:
                assert got.get(k, []) == want
            assert got.get(k, [])[1:] == sorted(got.get(k, [])[1:])


def test_rt_grid():
    grid, post = epi.rt_posteriors(np.round(10 * 1.1 ** np.arange(30)) + 1)
    assert np.allclose(post.sum(axis=1), 1)
    best = grid[post[-1].argmax()]
    assert abs(best - (1 + 5.5 * math.log(1.1))) < 0.2
    lo, hi = epi.shortest_interval(grid, post[-1], 0.5)
    assert lo <= best <= hi


def test_gamma_numbers():
    # shape 1 is the exponential distribution
    x = np.array([0.5, 1.0, 3.0])
    assert np.allclose(special.gamma_cdf(x, 1.0, 2.0), 1 - np.exp(-x / 2), atol=1e-12)
    q = special.gamma_quantile(0.9, np.array([1.0, 4.0, 250.0, np.nan]), np.array([2.0, 1.0, 0.5, 1.0]))
    assert abs(q[0] + 2 * math.log(0.1)) < 1e-9 and math.isnan(q[3])
    assert abs(special.gamma_cdf(np.array([q[2]]), 250.0, 0.5)[0] - 0.9) < 1e-9
    w = epi.serial_weights(6.48, 3.83, 400)
    assert abs(sum(w) - 1) < 1e-6 and abs(sum(i * v for i, v in enumerate(w)) - 6.48) < 0.05


def simulated(seed, days, start):
    rng = np.random.default_rng(seed)
    mob, onset = rng.random(days), [float(start)]
    for t in range(days - 1):
        onset.append(max(float(rng.poisson(onset[-1] * np.exp((2.6 * np.exp(-0.63 * (1 + mob[t])) - 1) / 4.0))), 1.0))
    return mob, np.array(onset)


@pytest.mark.parametrize("start, close", [(10_000, 0.05), (1_000_000, 0.005)])
def test_threshold_recovers_parameters(start, close):
    mob, onset = simulated(4, 160, start)
    beta, r0 = epi.fit_threshold(mob, onset)
    truth = math.log(2.6) / 0.63 - 1
    assert abs(math.log(r0) / beta - 1 - truth) < close * truth and 2.0 <= r0 <= 5.0


@pytest.mark.parametrize("seed, days, start", [(1, 30, 400), (2, 60, 3000), (3, 15, 5), (5, 120, 1)])
def test_threshold_equals_a_fine_grid(seed, days, start):
    """Also where beta has a long tail up to its bound."""
    mob, onset = simulated(seed, days, start)
    k, base, m = np.round(onset[1:]), onset[:-1], mob[:-1]

    def grid(low, high, n):
        step = (high - low) / n
        return low + step * (np.arange(n) + 0.5)

    r, w = grid(2, 5, 60), grid(math.log(1 / 60), math.log(8), 120)
    ranges = [(-100, -10, 90), (-10, 10, 400), (10, 100, 90)]
    beta, share = np.concatenate([grid(*x) for x in ranges]), np.concatenate([np.full(n, (high - low) / n) for low, high, n in ranges])
    lp = np.empty((len(beta), len(r)))
    v = np.exp(w)
    for i, x in enumerate(beta):
        with np.errstate(over="ignore", invalid="ignore"):
            a = np.minimum(r[:, None] * np.exp(-x * (1 + m)) - 1, 1e6)
            ll = (a @ k)[:, None] * v - sum(b * np.exp(a[:, t, None] * v) for t, b in enumerate(base)) - 6 * w - 1.5 / v
        ll = np.where(np.isfinite(ll), ll, -1e300)
        top = ll.max(axis=1)
        lp[i] = top + np.log(np.exp(ll - top[:, None]).sum(axis=1))
    mass = np.exp(lp - lp.max()) * share[:, None]
    mass /= mass.sum()
    want = math.log((mass.sum(axis=0) * r).sum()) / (mass.sum(axis=1) * beta).sum() - 1
    beta, r0 = epi.fit_threshold(mob, onset)
    assert abs(math.log(r0) / beta - 1 - want) < 2e-3 * max(1.0, abs(want))


def test_weights_are_the_integrated_density():
    mean, std = 6.48, 3.83
    a, b = ((mean - 1) / std) ** 2, std**2 / (mean - 1)
    u = (np.arange(400_000) + 0.5) * 5e-4  # the interval less one day
    f = special.gamma_pdf(u, a, b) * 5e-4
    w = epi.serial_weights(mean, std, 150)
    for k in (1, 2, 5, 9, 40):
        assert abs((f * np.maximum(1 - np.abs(u + 1 - k), 0)).sum() - w[k]) < 1e-7
    assert w[149] == 0


def test_convolution_and_weights_of_long_series():
    x, w = np.random.default_rng(1).random(700), epi.serial_weights(300.0, 120.0, 700)
    plain = [sum(x[t - i] * w[i] for i in range(t + 1)) for t in range(700)]
    assert np.allclose(epi.convolved(x, w), plain, atol=1e-12) and w[400:].sum() > 0.1
    assert np.allclose(epi.convolved(x[:50], w[:50]), plain[:50], atol=1e-12)


def test_warp_distance_matches_table():
    rng = np.random.default_rng(8)
    a, b = rng.random(9), rng.random(7)
    d = np.full((10, 8), np.inf)
    d[0, 0] = 0
    for i in range(1, 10):
        for j in range(1, 8):
            d[i, j] = abs(a[i - 1] - b[j - 1]) + min(d[i - 1, j], d[i, j - 1], d[i - 1, j - 1])
    assert abs(series.warp_distance(a, b) - d[9, 7]) < 1e-12
    assert series.warp_distance(a, a) == 0


def test_transport_matches_line_and_is_symmetric():
    rng = np.random.default_rng(9)
    pos = np.sort(rng.random(12))
    cost = np.abs(pos[:, None] - pos[None, :])
    a, b = rng.random(12), rng.random(12)
    a, b = a / a.sum(), b / b.sum()
    exact = float((np.abs(np.cumsum(a - b))[:-1] * np.diff(pos)).sum())  # closed form on a line
    assert abs(shape.transport_cost(a, b, cost) - exact) < 1e-9
    assert abs(shape.transport_cost(b, a, cost) - exact) < 1e-9
    assert shape.transport_cost(a, a, cost) == 0


def test_average_linkage():
    d = np.array([[0, 1, 9, 9], [1, 0, 9, 9], [9, 9, 0, 2], [9, 9, 2, 0]], float)
    assert list(shape.average_linkage(d, 3)) == [0, 0, 1, 1]
    assert len(set(shape.average_linkage(d, 20))) == 1


def test_merge_places_matches_sequential(spark):
    rng = np.random.default_rng(6)
    pts = [(i, float(x), float(y), float(i + 1)) for i, (x, y) in enumerate(rng.random((40, 2)) * 0.05)]

    def km(p, q):
        la, lb = math.radians(p[2]), math.radians(q[2])
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2
        return 2 * 6371 * math.asin(math.sqrt(h))

    near = {p[0]: [q[0] for q in pts if q[0] != p[0] and km(p, q) <= 0.8] for p in pts}
    skip, want = set(), {}
    for p in pts:
        if p[0] in skip:
            continue
        skip |= set(near[p[0]])
        want[p[0]] = sum(pts[j][3] for j in near[p[0]]) + p[3]
    df = spark.createDataFrame(pts, "id long, lon double, lat double, total double")
    assert {r.id: r.total for r in places.merge_places(df, 400.0).collect()} == want


def test_ridge_from_gram(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3)) * [1, 5, 0.2] + [0, 3, 1]
    y = x @ [1.0, -2.0, 3.0] + rng.normal(size=400) * 0.1
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "id long, a double, b double, c double, y double").repartition(3)
    g = forecast.gram_matrices(df, ["a", "b", "c"], "y", ["id"], rounds=4)
    whole = g[g.r == 0]["g"].iloc[0]
    full = np.column_stack([np.ones(400), x, y])
    assert np.allclose(whole, full.T @ full)
    for r in range(1, 5):
        assert np.allclose(sum(g[g.r == r]["g"]), whole)
    w, b, mean, std = forecast.ridge_from_gram(whole, 10.0)
    z = (x - x.mean(0)) / x.std(0)
    assert np.allclose(w, np.linalg.solve(z.T @ z + 10 * np.eye(3), z.T @ (y - y.mean())))
    res = y - (y.mean() + z @ w)
    r2, rmse = forecast.score_gram(whole, w, b, mean, std)
    assert abs(rmse - np.sqrt((res**2).mean())) < 1e-8 and abs(r2 - (1 - (res**2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-8


def test_partitioning_does_not_change_graphs(spark):
    polys = spark.createDataFrame([("a", "A", 0.0, 0.0), ("b", "B", 1.0, 0.0)], "poly_id string, poly_name string, poly_lon double, poly_lat double")
    cases = spark.createDataFrame([("a", D0, 2.0), ("b", D0 + dt.timedelta(days=2), 1.0)], "poly_id string, date_time date, num_cases double")
    flows = spark.createDataFrame([(D0, "a", "a", 4.0), (D0 + dt.timedelta(days=1), "a", "b", 3.0), (D0 + dt.timedelta(days=3), "b", "b", 1.0)], "date_time date, start_poly_id string, end_poly_id string, movement double")
    one = sorted(map(str, graphs.build_nodes(polys, cases, flows).collect()))
    two = sorted(map(str, graphs.build_nodes(polys, cases.repartition(7), flows.repartition(5)).collect()))
    assert one == two and len(one) == 6
    pop = spark.createDataFrame([("a", D0, 9.0)], "poly_id string, date_time date, population double")
    got = {(r.node_id, r.day): r.population for r in graphs.build_nodes(polys, cases, flows, pop).collect()}
    assert got[("a", 0)] == 9.0 and got[("b", 0)] is None
