"""Joins on keys and dates."""

from pyspark.sql import functions as F

from wayflux.catalog.base import query
from wayflux.operators import joins, reshape
from wayflux.session import salted_join


def _register(t):
    return t.polygons.select(F.col("poly_id").alias("geo_id"), F.col("poly_lon").alias("lon"), F.col("poly_lat").alias("lat"), F.col("poly_name").alias("location"))


@query("cases_located", """
    SELECT date_time, poly_id AS geo_id, poly_name AS location, poly_lon AS lon, poly_lat AS lat, num_cases, num_diseased, num_recovered, num_infected
    FROM cases JOIN polygons USING (poly_id)""", d="date_time", r="lon lat", covers="C1")
def _(t):
    return joins.locate_cases(t.cases.withColumnRenamed("poly_id", "geo_id"), _register(t))


@query("nodes_with_flow_and_people", """
    SELECT c.poly_id, c.date_time, num_cases, f.inner_movement, p.attr_population
    FROM cases c LEFT JOIN daily_flow f USING (poly_id, date_time) LEFT JOIN polygons p USING (poly_id)""",
    d="date_time", covers="C2")
def _(t):
    from wayflux.operators.aggregates import daily_in_out

    f = daily_in_out(t.movement).select("poly_id", "date_time", "inner_movement")
    return t.cases.select("poly_id", "date_time", "num_cases").join(f, ["poly_id", "date_time"], "left").join(t.polygons.select("poly_id", "attr_population"), "poly_id", "left")


@query("empty_places_kept", """
    SELECT p.s_nationkey AS place, coalesce(c.d, (SELECT min(CAST(o_orderdate AS DATE)) FROM orders)) AS date_time, coalesce(c.n, 0) AS num_cases
    FROM (SELECT n_nationkey AS s_nationkey FROM nation) p LEFT JOIN (
        SELECT s_nationkey, CAST(l_shipdate AS DATE) AS d, CAST(count(*) AS DOUBLE) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2) c USING (s_nationkey)
    """.replace("(SELECT min(CAST(o_orderdate AS DATE)) FROM orders)", "(SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem)"), d="date_time", i="place", covers="C3")
def _(t):
    s = t.raw("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("place"))
    c = t.raw("lineitem").select("l_suppkey", F.col("l_shipdate").cast("date").alias("date_time")).join(s, "l_suppkey")
    c = c.groupBy("place", "date_time").agg(F.count("*").cast("double").alias("num_cases"))
    return joins.keep_empty_places(c, t.raw("nation").select(F.col("n_nationkey").alias("place")), "place")


@query("inner_and_outer_flow", """
    SELECT date_time, poly_id, coalesce(i.m, 0) AS inner_movement, coalesce(o.m, 0) AS external_movement
    FROM (SELECT date_time, start_poly_id AS poly_id, movement AS m FROM movement WHERE start_poly_id = end_poly_id) i
    FULL JOIN (SELECT date_time, start_poly_id AS poly_id, sum(movement) AS m FROM movement WHERE start_poly_id <> end_poly_id GROUP BY 1, 2) o USING (date_time, poly_id)""",
    d="date_time", covers="C4 B17")
def _(t):
    i = reshape.internal(t.movement).select("date_time", F.col("start_poly_id").alias("poly_id"), F.col("movement").alias("inner_movement"))
    o = reshape.external(t.movement).groupBy("date_time", F.col("start_poly_id").alias("poly_id")).agg(F.sum("movement").alias("external_movement"))
    return joins.full_with_zeros(i, o, ["date_time", "poly_id"])


@query("places_without_coordinates", """
    SELECT DISTINCT l_partkey AS geo_id, l_suppkey AS hint FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""", covers="C5")
def _(t):
    seen = t.raw("lineitem").select(F.col("l_suppkey").alias("hint"), F.col("l_partkey").alias("geo_id"))
    known = t.raw("supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("hint"))
    return joins.missing_places(seen, known, ["hint"], ["geo_id", "hint"])


@query("flows_between_known_areas", """
    SELECT * FROM movement WHERE start_poly_id IN (SELECT poly_id FROM polygons WHERE attr_area > 2) AND end_poly_id IN (SELECT poly_id FROM polygons WHERE attr_area > 2)""",
    d="date_time", covers="C6")
def _(t):
    return joins.known_flows(t.movement, t.polygons.filter("attr_area > 2"))


@query("nearest_distance_day", """
    SELECT DISTINCT c.date, arg_min(d.date, (abs(date_diff('day', c.date, d.date)), d.date)) AS nearest_date
    FROM (SELECT DISTINCT date FROM contacts) c, (SELECT DISTINCT date FROM distances) d GROUP BY c.date""", d="date nearest_date", covers="C14")
def _(t):
    return joins.nearest_date(t.contacts, t.distances_to_infected)


@query("flows_by_community", """
    SELECT date_time, a.community_id AS start_poly_id, b.community_id AS end_poly_id, sum(movement) AS movement
    FROM movement JOIN community_map a ON a.poly_id = start_poly_id JOIN community_map b ON b.poly_id = end_poly_id GROUP BY 1, 2, 3""",
    d="date_time", covers="C15")
def _(t):
    return joins.remap_flows(t.movement, t.community_map, "poly_id", "community_id")


@query("calendar_of_cases", "SELECT date_time, poly_id, num_cases FROM dense_cases", d="date_time", covers="C16 H5 D19")
def _(t):
    c = t.cases.select("date_time", "poly_id", "num_cases")
    return joins.densify(c, c, "poly_id", ["num_cases"]).select("date_time", "poly_id", "num_cases")


@query("neighbour_case_totals", """
    SELECT b.date_time, node_id, sum(coalesce(num_cases, 0)) AS neighbor_num_cases
    FROM both_ways b LEFT JOIN cases c ON c.date_time = b.date_time AND c.poly_id = neighbor_id GROUP BY 1, 2""", d="date_time", covers="C17")
def _(t):
    return joins.neighbour_totals(t.movement, t.cases, "poly_id", "num_cases")


@query("neighbour_case_means", """
    SELECT b.date_time, node_id, sum(coalesce(num_cases, 0)) / count(*) AS neighbor_num_cases
    FROM both_ways b LEFT JOIN cases c ON c.date_time = b.date_time AND c.poly_id = neighbor_id GROUP BY 1, 2""", d="date_time", r="neighbor_num_cases", covers="C18")
def _(t):
    return joins.neighbour_totals(t.movement, t.cases, "poly_id", "num_cases", how="mean")


@query("shared_days_of_series", """
    SELECT poly_id, greatest(a0, b0) AS first_date, least(a1, b1) AS last_date
    FROM (SELECT poly_id, min(date_time) AS a0, max(date_time) AS a1 FROM cases GROUP BY 1)
    JOIN (SELECT poly_id, min(date_time) AS b0, max(date_time) AS b1 FROM area_range GROUP BY 1) USING (poly_id) WHERE greatest(a0, b0) <= least(a1, b1)""",
    d="first_date last_date", covers="C20")
def _(t):
    return joins.overlap_span(t.cases, t.area_range, "poly_id")


@query("area_measures_side_by_side", """
    SELECT poly_id, coalesce(cases, 0) AS cases, coalesce(flow, 0) AS flow, coalesce(people, 0) AS people
    FROM (SELECT poly_id, sum(num_cases) AS cases FROM cases GROUP BY 1)
    FULL JOIN (SELECT start_poly_id AS poly_id, sum(movement) AS flow FROM movement GROUP BY 1) USING (poly_id)
    FULL JOIN (SELECT poly_id, attr_population AS people FROM polygons) USING (poly_id)""", covers="C21")
def _(t):
    a = t.cases.groupBy("poly_id").agg(F.sum("num_cases").alias("cases"))
    b = t.movement.groupBy(F.col("start_poly_id").alias("poly_id")).agg(F.sum("movement").alias("flow"))
    return joins.assemble([a, b, t.polygons.select("poly_id", F.col("attr_population").alias("people"))], "poly_id")


@query("visits_with_homes", """
    SELECT e.event_type AS location_id, CAST(e.ts AS DATE) AS date, c.c_mktsegment AS type, n.n_name AS name, count(*) AS visits
    FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    WHERE e.event_type = 'view' OR e.event_type = 'click' GROUP BY 1, 2, 3, 4""", d="date", covers="C22 A11")
def _(t):
    from wayflux.sources.files import run_sql

    text = """
        SELECT v.event_type AS location_id, CAST(v.ts AS DATE) AS date, h.c_mktsegment AS type, n.n_name AS name, count(*) AS visits
        FROM wf_visits v JOIN wf_homes h ON v.user_id = h.c_custkey JOIN wf_names n ON h.c_nationkey = n.n_nationkey
        WHERE v.event_type = :a OR v.event_type = :b GROUP BY 1, 2, 3, 4"""
    tables = {"wf_visits": t.raw("events"), "wf_homes": t.raw("customer"), "wf_names": t.raw("nation")}
    return run_sql(t.spark, text, tables, {"a": "view", "b": "click"})


@query("recently_connected_areas", """
    WITH recent AS (SELECT date_time, start_id, end_id, avg(movement) AS m FROM edges
        WHERE date_time >= (SELECT max(date_time) FROM edges) - INTERVAL 30 DAY GROUP BY 1, 2, 3 HAVING avg(movement) > 0)
    SELECT start_id AS node_id, end_id AS neighbor_id FROM recent UNION SELECT end_id, start_id FROM recent""", covers="C24")
def _(t):
    from wayflux.operators.spatial import touching_areas

    return joins.neighbours_or_touching(t.graph[1], touching_areas(t.ringed))


@query("community_values_to_areas", """
    SELECT poly_id, v AS value FROM community_map LEFT JOIN (SELECT community_id, sum(num_cases) AS v FROM cases JOIN community_map USING (poly_id)
        GROUP BY 1 HAVING sum(num_cases) > 0) USING (community_id)""", covers="C25")
def _(t):
    v = t.cases.join(t.community_map, "poly_id").groupBy(F.col("community_id").alias("poly_id")).agg(F.sum("num_cases").alias("value"))
    return joins.expand_to_members(v, t.community_map)


@query("order_values_by_hot_status", """
    SELECT o_orderstatus AS status, l_returnflag AS flag, count(*) AS n, sum(l_quantity) AS quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN (SELECT DISTINCT o_orderstatus AS s FROM orders) x ON x.s = o_orderstatus GROUP BY 1, 2""", covers="C1")
def _(t):
    o = t.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("status"))
    li = t.raw("lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("flag"), "l_quantity").join(o, "l_orderkey")
    kinds = o.select("status").distinct()
    return salted_join(li, kinds, ["status"], rows_per_task=1000, spread=["l_orderkey", "l_linenumber"]).groupBy("status", "flag").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))
