"""Hand-written cases for the rule, window, date and epidemic operators."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayflux.functions import dates, geo, text
from wayflux.operators import joins, ranking, rules, spatial, windows
from wayflux.operators.rules import Rule
from wayflux.plans import epi, series

D0 = dt.date(2020, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i)


def test_token_union_and_intersection(spark):
    df = spark.createDataFrame([("k", "1", "1"), ("k", "2,1,4,5,7,2", "2,1,4,5,7,2"), ("k", "2,3", "2,3,1")], "k string, u string, i string")
    scheme = [Rule("u", "attr_union", "", "sep=,"), Rule("i", "attr_intersection", "", "sep=,")]
    row = rules.agglomerate(df, scheme, ["k"], ["u", "i"]).first()
    assert set(row.u.split(",")) == {"1", "2", "3", "4", "5", "7"}
    assert row.i == "1"


def test_intersection_may_be_empty(spark):
    df = spark.createDataFrame([("k", "1|2"), ("k", "3")], "k string, i string")
    assert rules.agglomerate(df, [Rule("i", "attr_intersection")], ["k"], ["i"]).first().i == ""


def test_rules_raise(spark):
    df = spark.createDataFrame([("k", 1.0)], "k string, attr_x_sub double")
    with pytest.raises(ValueError):
        rules.agglomerate(df, rules.DEFAULT_RULES, ["k"], ["attr_x_sub"])  # no implementation
    with pytest.raises(ValueError):
        rules.rule_for("unknown", rules.DEFAULT_RULES)
    with pytest.raises(ValueError):
        rules.parameters(Rule("a", "attr_union", "", "colour=red"), {"sep": "|"})
    assert rules.rule_for("attr_names_append_float", rules.DEFAULT_RULES).fn == "attr_append_float"
    assert rules.rule_for("attr_ids_union_int", rules.DEFAULT_RULES).fn == "attr_union_int"


def test_user_function_and_null_keys(spark):
    rules.register("spread", lambda c, r: F.max(c) - F.min(c))
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), (None, 9.0)], "k string, x double")
    assert [tuple(r) for r in rules.agglomerate(df, [Rule("x", "spread")], ["k"], ["x"]).collect()] == [("a", 3.0)]


def test_vector_mix(spark):
    df = spark.createDataFrame([("k", "0.2|0.8", 1.0), ("k", "0.6|0.4", 3.0)], "k string, v string, w double")
    assert rules.agglomerate(df, [Rule("v", "attr_dist_mix")], ["k"], ["v"]).first().v.startswith("0.4|0.6")
    mixed = rules.agglomerate(df, [Rule("v", "attr_dist_mix_weighted", "w")], ["k"], ["v"]).first().v
    assert [round(float(x), 6) for x in mixed.split("|")] == [0.5, 0.5]


def test_gamma_delay_recovers_shape(spark):
    x = np.random.default_rng(1).gamma(3.0, 2.0, 20000) - 1
    df = spark.createDataFrame([("k", float(v)) for v in x], "k string, attr_time_delay double")
    p = np.array(rules.agglomerate(df, [Rule("attr_time_delay", "estimate_gamma_delay")], ["k"], ["attr_time_delay"]).first()[1])
    want = np.arange(62) ** 2 * np.exp(-np.arange(62) / 2) / (2 * 8)
    assert len(p) == 62 and np.abs(p - want).max() < 0.01


def test_smooth_curve_keeps_total(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([0.0, 2.0, 4.0])], "k string, t int, v double")
    got = [round(r.v, 4) for r in windows.smooth_curve(df, ["k"], "t", "v", 2).orderBy("t").collect()]
    assert got == [0.6667, 1.6667, 3.6667]


def test_round_to_day(spark):
    df = spark.sql("SELECT explode(array(timestamp_ntz'2020-01-01 00:00:00', timestamp_ntz'2020-01-01 08:00:00', timestamp_ntz'2020-01-01 16:00:00')) AS t")
    assert [str(r[0]) for r in df.select(dates.round_to_day(F.col("t"))).collect()] == ["2020-01-01", "2020-01-01", "2020-01-02"]


def test_undo_cumulative(spark):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([3, 5, 5, 9, 7])], "k string, t int, v double")
    got = [r[0] for r in df.select(windows.undo_cumulative(["k"], "t", "v", clip=True), "t").orderBy("t").collect()]
    assert got == [3.0, 2.0, 0.0, 4.0, 0.0]


@pytest.mark.parametrize("variant,want", [("midpoint", [1, 2, 3, 6]), ("midpoint_or_next", [1, 2, 3, 6]), ("look_ahead", [1, 5, 5, 6])])
def test_repair(spark, variant, want):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([1, 5, 3, 6])], "k string, t int, v double")
    got = [r.v for r in windows.repair_cumulative(df, ["k"], "t", "v", variant).orderBy("t").collect()]
    assert got == want and got == sorted(got)


def test_onset_convolution(spark):
    c = spark.createDataFrame([("a", day(3), 10.0)], "poly_id string, date_time date, num_cases double")
    p = spark.createDataFrame([("a", [0.0, 0.5, 0.5])], "poly_id string, p_delay array<double>")
    assert {(str(r.date_time), r.num_cases) for r in epi.confirmed_to_onset(c, p).collect()} == {("2020-01-03", 5.0), ("2020-01-02", 5.0)}


def test_coverage_keeps_one_more(spark):
    df = spark.createDataFrame([("a", 50.0), ("b", 30.0), ("c", 15.0), ("d", 5.0)], "k string, n double")
    assert sorted(r.k for r in windows.coverage(df, "n", "k", 0.8).collect()) == ["a", "b", "c"]


def test_names(spark):
    df = spark.createDataFrame([("Bogotá D.C.-Centro", "south_korea o'neil", "Albury (A)")], "a string, b string, c string")
    row = df.select(text.slug(F.col("a")).alias("a"), text.publication_name(F.col("b")).alias("b"), text.strip_words(F.col("c"), ["(A)"]).alias("c")).first()
    assert row.a == "bogota_dc" and row.b == "South Korea O'Neil" and row.c == "Albury"


def test_ring_tests(spark):
    wkt = "POLYGON ((0 0, 4 0, 4 4, 2 2, 0 4, 0 0))"
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (0.0, 1.0), (3.5, 3.0)], "x double, y double").withColumn("r", geo.rings_from_wkt(F.lit(wkt)))
    assert [r[0] for r in df.select(geo.inside(F.col("x"), F.col("y"), geo.edges_of(F.col("r")))).collect()] == [True, False, False, True]
    assert df.select(geo.area(F.col("r"))).first()[0] == 12.0


def test_parts_and_holes(spark):
    wkt = "MULTIPOLYGON (((0 0, 0 9, 9 9, 9 0, 0 0), (3 3, 6 3, 6 6, 3 6, 3 3)), ((20 0, 22 0, 22 1, 20 1, 20 0)))"
    points = [(1.0, 1.0, True), (4.5, 4.5, False), (3.0, 4.0, False), (21.0, 0.5, True), (15.0, 0.5, False), (6.5, 4.5, True)]
    df = spark.createDataFrame(points, "x double, y double, want boolean").withColumn("r", geo.rings_from_wkt(F.lit(wkt)))
    assert all(r.got == r.want for r in df.select("want", geo.inside(F.col("x"), F.col("y"), geo.edges_of(F.col("r"))).alias("got")).collect())
    c = geo.centroid(F.col("r"))
    row = df.select(geo.area(F.col("r")).alias("a"), c["lon"].alias("x"), c["lat"].alias("y")).first()
    assert row.a == 81 - 9 + 2 and abs(row.x - (72 * 4.5 + 2 * 21) / 74) < 1e-12 and abs(row.y - (72 * 4.5 + 2 * 0.5) / 74) < 1e-12


def test_empty_and_null_shapes(spark):
    areas = spark.createDataFrame([("a", None), ("b", "POLYGON EMPTY"), ("c", "POLYGON ((0 0, 1 0, 1 1, 0 0))"), ("d", "POLYGON ((x))")], "poly_id string, geometry string")
    areas = spatial.with_rings(areas)
    points = spark.createDataFrame([(0.6, 0.3), (5.0, 5.0), (None, 1.0)], "lon double, lat double")
    assert [tuple(r) for r in spatial.points_in_areas(points, areas, "lon", "lat", ["poly_id"]).collect()] == [(0.6, 0.3, "c")]
    assert spatial.touching_areas(areas).isEmpty() and spatial.overlap_weights(areas, areas.withColumnRenamed("poly_id", "o"), "poly_id", "o", 1.0).count() == 1


def test_filler_of_a_hole_touches(spark):
    frame = "POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0), (3 3, 6 3, 6 6, 3 6, 3 3))"
    areas = [("frame", frame), ("filler", "POLYGON ((3 3, 6 3, 6 6, 3 6, 3 3))"), ("loose", "POLYGON ((4 4, 5 4, 5 5, 4 4))"), ("inner", "POLYGON ((1 1, 2 1, 2 2, 1 1))")]
    areas = spatial.with_rings(spark.createDataFrame(areas, "poly_id string, geometry string"))
    assert {tuple(r) for r in spatial.touching_areas(areas, 2.0).collect()} == {("frame", "filler"), ("filler", "frame")}
    pairs = spatial.meeting_pairs(areas, areas.select(F.col("poly_id").alias("o"), "rings"), "poly_id", "o", 2.0)
    got = {tuple(r) for r in pairs.collect() if r.poly_id < r.o}
    assert got == {("filler", "frame"), ("filler", "loose"), ("frame", "inner")}


def test_nearest_date_picks_earlier_on_tie(spark):
    left = spark.createDataFrame([(day(2),), (day(5),), (day(0),)], "date date")
    right = spark.createDataFrame([(day(1),), (day(3),)], "date date")
    got = {str(r.date): str(r.nearest_date) for r in joins.nearest_date(left, right).collect()}
    assert got == {"2020-01-01": "2020-01-02", "2020-01-03": "2020-01-02", "2020-01-06": "2020-01-04"}


def test_top_or_other(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 1.0), ("d", 1.0)], "k string, v double")
    assert {tuple(r) for r in ranking.top_or_other(df, "k", "v", [], 2).collect()} == {("a", 5.0), ("b", 3.0), ("Otros", 2.0)}


def test_areas_on_line_prefers_smallest(spark):
    areas = spatial.with_rings(spark.createDataFrame([("a", "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"), ("b", "POLYGON ((5 5, 6 5, 6 6, 5 6, 5 5))")], "poly_id string, geometry string"))
    lines = spark.createDataFrame([("r1", 2, -1.0, 0.5, 2.0, 0.5), ("r2", 1, 0.5, -1.0, 0.5, 2.0), ("r3", 1, 6.05, 0.0, 6.05, 9.0)], "line_id string, preference int, x1 double, y1 double, x2 double, y2 double")
    assert {tuple(r) for r in spatial.areas_on_line(areas, lines, "poly_id", 1.0).collect()} == {("a", "r2")}
    assert {tuple(r) for r in spatial.areas_on_line(areas, lines, "poly_id", 1.0, 0.1).collect()} == {("a", "r2"), ("b", "r3")}


def test_stitch(spark):
    rows = [("w", 0, day(i), float(v)) for i, v in [(3, 50), (4, 100), (5, 80)]] + [("w", 1, day(i), float(v)) for i, v in [(1, 30), (2, 20), (3, 100), (4, 40)]]
    df = spark.createDataFrame(rows, "k string, piece int, date date, value double")
    got = {str(r.date): r.value for r in series.stitch_pieces(df, ["k"]).collect()}
    # factor of piece 1 is 100 / 100
    assert got == {"2020-01-02": 38.0, "2020-01-03": 25.0, "2020-01-04": 94.0, "2020-01-05": 88.0, "2020-01-06": 100.0}
