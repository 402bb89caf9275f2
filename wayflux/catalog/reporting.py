"""Alerts, change maps and report tables."""

from pyspark.sql import functions as F

from wayflux.catalog.base import query
from wayflux.operators import ranking, reshape
from wayflux.operators.spatial import touching_areas
from wayflux.plans import alerts, epi, reports

LEVELS = "CASE WHEN {x} > {r} THEN 'ROJO' WHEN {x} > {y} THEN 'AMARILLO' ELSE 'VERDE' END"


@query("flow_alerts", f"""
    WITH s AS (SELECT poly_id, avg(inner_movement) + 1.5e0 * stddev_samp(inner_movement) AS i, avg(external_movement) + 1.5e0 * stddev_samp(external_movement) AS e FROM daily_flow GROUP BY 1),
         p AS (SELECT poly_id, sum(CASE WHEN inner_movement > i THEN 1e0 ELSE 0e0 END) / 7 AS points_inner, sum(CASE WHEN external_movement > e THEN 1e0 ELSE 0e0 END) / 7 AS points_external
               FROM daily_flow JOIN s USING (poly_id) WHERE date_time >= (SELECT max(date_time) FROM movement) - INTERVAL 7 DAY GROUP BY 1)
    SELECT *, {LEVELS.format(x='points_inner', r=0.5, y=0)} AS internal_alert, {LEVELS.format(x='points_external', r=0.5, y=0)} AS external_alert FROM p""", r="points_inner points_external", covers="K15 D13")
def _(t):
    return alerts.flow_alerts(t.movement)


def _windows_sql() -> str:
    spans = {"backward": "d >= back AND d < low", "middle": "d >= low AND d < zero", "forward": "d >= zero AND d <= last", "total": "d > low AND d <= last"}
    aggs = ", ".join(f"avg({v}) FILTER (WHERE {c}) AS {v}_{n}" for n, c in spans.items() for v in ("num_cases", "external_num_cases"))
    deltas = ", ".join(
        f"coalesce(({v}_{b} - {v}_{a}) / nullif({v}_{a}, 0), 0) AS delta_{v}_{n}"
        for n, (a, b) in {"backward": ("backward", "middle"), "forward": ("middle", "forward"), "total": ("backward", "forward")}.items() for v in ("num_cases", "external_num_cases")
    )
    return f"""
    WITH m0 AS (SELECT (SELECT min(date_time) FROM cases) AS c0, least((SELECT max(date_time) FROM cases), (SELECT max(date_time) FROM movement)) AS last),
         m AS (SELECT c0, last, last - 5 AS zero, last - 10 AS low, last - 15 AS back FROM m0),
         g AS (SELECT poly_id, m.*, CAST(unnest(generate_series(greatest(back, c0), last, INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT DISTINCT poly_id FROM cases), m),
         nb AS (SELECT b.date_time AS d, node_id AS poly_id, sum(coalesce(num_cases, 0)) AS external_num_cases FROM both_ways b LEFT JOIN cases c ON c.date_time = b.date_time AND c.poly_id = neighbor_id GROUP BY 1, 2),
         r AS (SELECT g.*, coalesce(c.num_cases, 0) AS num_cases, coalesce(nb.external_num_cases, 0) AS external_num_cases FROM g LEFT JOIN cases c ON c.poly_id = g.poly_id AND c.date_time = d LEFT JOIN nb ON nb.poly_id = g.poly_id AND nb.d = g.d),
         w AS (SELECT poly_id, {aggs} FROM r GROUP BY 1)
    SELECT *, {deltas} FROM w"""


_SPANS = ("backward", "middle", "forward", "total")
_WIN_NUMS = " ".join([f"{v}_{n}" for n in _SPANS for v in ("num_cases", "external_num_cases")] + [f"delta_{v}_{n}" for n in ("backward", "forward", "total") for v in ("num_cases", "external_num_cases")])


@query("case_windows", _windows_sql(), r=_WIN_NUMS, covers="E17 E18 C16 C17")
def _(t):
    return alerts.case_windows(t.cases, t.movement)


@query("case_alerts", f"""SELECT poly_id, {LEVELS.format(x='delta_num_cases_forward', r=1.0, y=0.5)} AS alert_internal_num_cases, {LEVELS.format(x='delta_external_num_cases_forward', r=1.0, y=0.5)} AS alert_external_num_cases FROM ({_windows_sql()})""", covers="K15")
def _(t):
    return alerts.case_alerts(alerts.case_windows(t.cases, t.movement))


@query("range_alerts", """
    SELECT poly_id, CASE WHEN th IS NULL THEN 'BLANCO' WHEN m >= th THEN 'ROJO' ELSE 'VERDE' END AS movement_range_alert
    FROM (SELECT poly_id, avg(movement_change) AS m FROM area_range WHERE date_time >= (SELECT max(date_time) FROM area_range) - INTERVAL 7 DAY GROUP BY 1)
    FULL JOIN (SELECT poly_id, CASE WHEN attr_area > 1 THEN -attr_area / 8 END AS th FROM polygons) USING (poly_id)""", covers="K15")
def _(t):
    th = t.polygons.select("poly_id", F.when(F.col("attr_area") > 1, -F.col("attr_area") / 8).alias("mob_th"))
    return alerts.range_alerts(t.area_range, th)


@query("vulnerability", """
    SELECT node_id AS poly_id, CASE WHEN s = '' THEN '--' ELSE s END AS vulnerability_alert FROM (SELECT node_id, concat_ws(';', CASE WHEN ipm > 19.6 THEN 'IPM' END,
        CASE WHEN porcentaje_sobre_60 * 100 > 12 THEN '>60 ANOS' END, CASE WHEN porcentaje_subsidiado * 100 > 53 THEN 'EPS SUBSIDIADO' END) AS s FROM indicators)""", covers="K15")
def _(t):
    return alerts.vulnerability(t.area_indicators)


@query("alert_table", covers="K15 C25 C4 B16 B18")
def _(t):
    """Full table: community values of the reproductive number and threshold handed to member areas."""
    from wayflux.operators.joins import expand_to_members
    from wayflux.session import cut_lineage

    rt = cut_lineage(epi.rt_by_area(t.community_cases, t.delays))
    th = cut_lineage(epi.mobility_thresholds(epi.threshold_inputs(t.community_cases, t.community_range, t.delays)))
    return alerts.alert_table(
        t.cases, t.movement, t.area_range, expand_to_members(th.select("poly_id", "mob_th"), t.community_map),
        expand_to_members(rt, t.community_map).filter("date_time is not null"), t.area_indicators, t.community_map,
    )


CHANGE = """
    WITH m AS (SELECT max(date_time) AS x FROM movement),
         p AS (SELECT start_poly_id AS poly_id, date_time, CASE WHEN date_time >= x - 7 THEN 'recent' WHEN date_time >= x - 14 THEN 'before' WHEN date_time BETWEEN DATE '1996-04-02' AND DATE '1996-04-09' THEN 'base' END AS part,
                      sum(movement) FILTER (WHERE start_poly_id = end_poly_id) AS i, sum(movement) FILTER (WHERE start_poly_id <> end_poly_id) AS e FROM movement, m GROUP BY 1, 2, 3),
         w AS (SELECT poly_id, """ + ", ".join(f"coalesce(avg({c}) FILTER (WHERE part = '{q}'), 0) AS {c}_{q}" for q in ("base", "before", "recent") for c in ("i", "e")) + ", " + ", ".join(f"bool_or(part = '{q}') AS has_{q}" for q in ("base", "before", "recent")) + """ FROM p WHERE part IS NOT NULL GROUP BY 1)"""


def _change_part(kind: str, early: str) -> str:
    both = f"(coalesce(has_{early}, false) AND coalesce(has_recent, false))"
    d = lambda c: f"CASE WHEN {both} THEN coalesce(({c}_recent - {c}_{early}) / nullif({c}_{early}, 0), 0) ELSE 0 END"
    bad = f"({both} AND ((i_{early} = 0 AND i_recent <> 0) OR (e_{early} = 0 AND e_recent <> 0)))"
    return f"SELECT poly_id, '{kind}' AS kind, {d('i')} AS delta_internal_movement, {d('e')} AS delta_external_movement FROM w WHERE NOT {bad} AND (has_{early} OR has_recent)"


@query("change_maps", f"{CHANGE} {_change_part('recent', 'before')} UNION ALL {_change_part('historic', 'base')}", r="delta_internal_movement delta_external_movement", covers="K16 E18")
def _(t):
    return alerts.change_maps(t.movement, "1996-04-02")


@query("general_statistics", """
    WITH d AS (SELECT 'mov' AS k, date_time, sum(inner_movement) FILTER (WHERE inner_movement > 0) AS v FROM daily_flow GROUP BY 2 UNION ALL SELECT 'out_mov', date_time, sum(external_movement) FILTER (WHERE external_movement > 0) FROM daily_flow GROUP BY 2
               UNION ALL SELECT 'cases', date_time, sum(num_cases) FROM cases GROUP BY 2),
         x AS (SELECT k, 'max' AS s, date_time, v FROM d WHERE v IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY v DESC, date_time) = 1
               UNION ALL SELECT k, 'min', date_time, v FROM d WHERE v IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY v, date_time) = 1)
    SELECT 'day_' || s || '_' || k AS parameter_name, CAST(date_time AS VARCHAR) AS parameter_value FROM x
    UNION ALL SELECT s || '_' || k || '_in_day', printf('%.3f', v) FROM x
    UNION ALL SELECT 'num_first_case', CAST(count(*) AS VARCHAR) FROM (SELECT poly_id FROM cases WHERE num_cases > 0 GROUP BY 1 HAVING min(date_time) >= (SELECT max(date_time) FROM cases) - 5)
    UNION ALL SELECT 'no_case_polygons_last_days', CAST(count(*) AS VARCHAR) FROM (SELECT poly_id FROM cases WHERE num_cases > 0 GROUP BY 1 HAVING max(date_time) < (SELECT max(date_time) FROM cases) - 15)""", covers="D16 D14 D15")
def _(t):
    return reports.general_statistics(t.cases, t.movement)


REL = "SELECT date_time, start_poly_id, end_poly_id, movement, coalesce(movement / b, 1) AS percentage FROM movement LEFT JOIN (SELECT start_poly_id, end_poly_id, avg(movement) AS b FROM movement WHERE date_time <= DATE '1996-12-31' GROUP BY 1, 2) USING (start_poly_id, end_poly_id)"


@query("relative_flows", REL, d="date_time", r="percentage", covers="K24")
def _(t):
    return reports.relative_flow(t.movement, "1996-12-31")


@query("smoothed_inner_flow", f"""
    SELECT date_time, poly_id, percentage FROM (SELECT date_time, start_poly_id AS poly_id, CASE WHEN count(*) OVER w = 5 THEN 100 * avg(percentage) OVER w END AS percentage FROM ({REL}) WHERE start_poly_id = end_poly_id
        WINDOW w AS (PARTITION BY start_poly_id ORDER BY date_time ROWS 4 PRECEDING)) WHERE percentage IS NOT NULL""", d="date_time", r="percentage", covers="K24 E5")
def _(t):
    return reports.smoothed_inner_flow(t.movement, "1996-12-31")


def _sm(src: str) -> str:
    return f"SELECT date_time, m + (sum(value) OVER () - sum(m) OVER ()) / count(*) OVER () AS value FROM (SELECT *, avg(value) OVER (ORDER BY date_time ROWS 4 PRECEDING) AS m FROM ({src}))"


@query("date_type_series", f"""
    WITH r AS (SELECT CAST(o_orderdate AS DATE) AS diagnosis, CAST(l_shipdate AS DATE) AS web, CAST(o_orderdate AS DATE) - CAST(l_linenumber AS INTEGER) AS onset FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
         a AS (SELECT diagnosis AS date_time, CAST(count(*) AS DOUBLE) AS value FROM r GROUP BY 1), b AS (SELECT web AS date_time, CAST(count(*) AS DOUBLE) AS value FROM r GROUP BY 1), c AS (SELECT onset AS date_time, CAST(count(*) AS DOUBLE) AS value FROM r GROUP BY 1)
    SELECT date_time, value, 'diagnosis' AS kind FROM ({_sm('SELECT * FROM a')}) UNION ALL SELECT date_time, value, 'web_report' FROM b WHERE date_time <= (SELECT max(date_time) FROM a)
    UNION ALL SELECT date_time, value, 'onset' FROM ({_sm('SELECT * FROM c WHERE date_time <= (SELECT max(date_time) - 66 FROM c)')})""", d="date_time", r="value", covers="K23 E1")
def _(t):
    o = t.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("diagnosis"))
    r = t.raw("lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("web_report")).join(o, "l_orderkey")
    return reports.date_type_series(r.withColumn("onset", F.date_sub("diagnosis", F.col("l_linenumber"))))


def anchors(t):
    """Twelve days apart, over the whole graph."""
    span = t.graph[0].agg(F.min("date_time").alias("a"), F.max("date_time").alias("b"))
    return span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 12 DAYS"))).alias("anchor"))


ANCHOR = """WITH sp AS (SELECT min(date_time) AS a, max(date_time) AS b FROM nodes), an AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 12 DAY)) AS DATE) AS anchor, a, b FROM sp),
         wn AS (SELECT anchor, anchor + CAST(greatest(7, 14 - (anchor - a)) AS INTEGER) AS hi, anchor - CAST(greatest(7, 14 - (b - anchor)) AS INTEGER) AS lo FROM an)"""


@query("window_nodes", f"{ANCHOR} SELECT anchor, node_id, avg(num_cases) AS num_cases, avg(inner_movement) AS inner_movement FROM nodes JOIN wn ON date_time BETWEEN lo AND hi GROUP BY 1, 2 HAVING avg(num_cases) > 0", d="anchor", r="num_cases inner_movement", covers="K21 E19")
def _(t):
    return reports.window_tables(t.graph[0], t.graph[1], anchors(t))[0]


@query("window_edges_of_graph", (ANCHOR + """, se AS (SELECT min(date_time) AS a, max(date_time) AS b FROM edges),
         we AS (SELECT anchor, anchor + CAST(greatest(7, 14 - (anchor - se.a)) AS INTEGER) AS hi, anchor - CAST(greatest(7, 14 - (se.b - anchor)) AS INTEGER) AS lo FROM an, se)
    SELECT anchor, start_id, end_id, avg(movement) AS movement FROM edges JOIN we ON date_time BETWEEN lo AND hi GROUP BY 1, 2, 3"""), d="anchor", r="movement", covers="K21 E19")
def _(t):
    return reports.window_tables(t.graph[0], t.graph[1], anchors(t))[1]


@query("milestones", "SELECT date_time, measure, row_number() OVER (ORDER BY date_time, measure) AS number FROM (SELECT CAST(min(o_orderdate) AS DATE) AS date_time, o_orderpriority || '/' || o_orderstatus AS measure FROM orders GROUP BY 2)", d="date_time", covers="K22")
def _(t):
    m = t.raw("orders").groupBy(F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("measure")).agg(F.min("o_orderdate").cast("date").alias("date_time"))
    return ranking.numbered(m, [F.col("date_time"), F.col("measure")])


ATTR = """av AS (SELECT event_type AS attribute_name, CAST(c_nationkey AS VARCHAR) AS location_id, CAST(ts AS DATE) AS date, sum(CAST(round(value * 100) AS BIGINT)) / 100e0 AS attribute_value FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2, 3)"""
LATEST = f"""WITH {ATTR} SELECT av.location_id, poly_name AS name, date, attribute_name, attribute_value FROM av JOIN polygons ON poly_id = av.location_id
    WHERE attribute_name = 'click' AND poly_name LIKE '%-A%' AND date = (SELECT max(date) FROM av WHERE attribute_name = 'click')"""


def attributes(t):
    c = t.raw("customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("string").alias("location_id"))
    return t.raw("events").join(c, "user_id").groupBy(F.col("event_type").alias("attribute_name"), "location_id", F.col("ts").cast("date").alias("date")).agg(
        (F.sum(F.round(F.col("value") * 100).cast("bigint")) / F.lit(100.0)).alias("attribute_value")
    )


def latest(t):
    return reports.latest_values(attributes(t), t.polygons.select(F.col("poly_id").alias("location_id"), F.col("poly_name").alias("name")), "click", "%-A%")


@query("latest_attribute_values", LATEST, d="date", r="attribute_value", covers="K27 C23 A11")
def _(t):
    return latest(t)


@query("top_three_phrase", f"WITH x AS ({LATEST}) SELECT string_agg(name, '|' ORDER BY attribute_value DESC, name) AS a FROM (SELECT * FROM x ORDER BY attribute_value DESC, name LIMIT 3)".replace("string_agg(name, '|' ORDER BY attribute_value DESC, name) AS a", "list(name ORDER BY attribute_value DESC, name)[1] || ', ' || list(name ORDER BY attribute_value DESC, name)[2] || ' y ' || list(name ORDER BY attribute_value DESC, name)[3] AS phrase"), covers="K27")
def _(t):
    return reports.top_three_phrase(latest(t), "name", "attribute_value")


@query("communities_of_selection", "SELECT DISTINCT community_id FROM community_map WHERE community_id LIKE '2%' AND poly_id IN (SELECT poly_id FROM cases GROUP BY 1 HAVING sum(num_cases) > 100)", covers="K26")
def _(t):
    busy = t.cases.groupBy("poly_id").agg(F.sum("num_cases").alias("n")).filter("n > 100").select("poly_id")
    return reports.communities_of(t.community_map, busy, "2")


@query("area_report_neighbours", """
    WITH recent AS (SELECT date_time, start_id, end_id, avg(movement) AS m FROM edges WHERE date_time >= (SELECT max(date_time) FROM edges) - INTERVAL 30 DAY GROUP BY 1, 2, 3 HAVING avg(movement) > 0),
         b AS (SELECT start_id AS node_id, end_id AS neighbor_id FROM recent UNION SELECT end_id, start_id FROM recent)
    SELECT * FROM b WHERE node_id IN ('3', '8')""", covers="M5 M4 C24")
def _(t):
    return reports.area_report(t.polygons, t.cases, t.movement, touching_areas(t.ringed), ["3", "8"])["neighbours"]


@query("highlighted_rt", covers="F6 K16")
def _(t):
    rt = alerts.rt_alerts(epi.rt_by_area(t.community_cases, t.delays), 30)
    names = t.community_map.select(F.col("community_id").alias("poly_id"), "community_name").distinct()
    return alerts.highlights(rt, names, {"ml": 0.5})
