"""Daily graphs, page rank, communities, day distances."""

from pyspark.sql import functions as F

from wayflux.catalog.base import query
from wayflux.operators import aggregates, rules
from wayflux.plans import agglomerate, graphs, places, shape
from wayflux.session import cut_lineage

ROUNDS = 220  # of the plain recursion in SQL: what is left is 0.85 ** 220 = 3e-16


@query("daily_graph_nodes", "SELECT date_time, day, node_id, num_cases, CAST(NULL AS DOUBLE) AS population, inner_movement FROM nodes", d="date_time", covers="J6 C2 C16 B16")
def _(t):
    return t.graph[0]


@query("daily_graph_edges", "SELECT date_time, day, start_id, end_id, movement FROM edges", d="date_time", covers="J6 B17")
def _(t):
    return t.graph[1]


@query("daily_graph_places", "SELECT poly_id AS node_id, poly_name AS node_name, poly_lon AS lon, poly_lat AS lat, n FROM polygons JOIN (SELECT poly_id, sum(num_cases) AS n FROM cases GROUP BY 1) USING (poly_id)", covers="J6")
def _(t):
    n = t.cases.groupBy(F.col("poly_id").alias("node_id")).agg(F.sum("num_cases").alias("n"))
    return t.graph[2].join(n, "node_id")


@query("graph_values", """
    SELECT day, inner_movement, cases, coalesce(m, 0) AS external_movement FROM (SELECT day, coalesce(sum(inner_movement), 0) AS inner_movement, sum(num_cases) AS cases FROM nodes GROUP BY 1)
    LEFT JOIN (SELECT day, sum(movement) AS m FROM edges GROUP BY 1) USING (day)""", covers="J7")
def _(t):
    return graphs.graph_values(t.graph[0], t.graph[1])


RANK_CTE = """
    c AS (SELECT * FROM good_contacts WHERE hour BETWEEN 6 AND 21),
    near AS (SELECT c.date, arg_min(d.date, (abs(date_diff('day', c.date, d.date)), d.date)) AS nd FROM (SELECT DISTINCT date FROM c) c, (SELECT DISTINCT date FROM distances) d GROUP BY 1),
    people AS (SELECT DISTINCT date, hour, unnest([id1, id2]) AS identifier FROM c),
    w AS (SELECT p.date, hour, p.identifier, coalesce(ln(1 + exp(-attribute_value / 1200)) / ln(2e0), 0) AS weight FROM people p JOIN near USING (date) LEFT JOIN distances d ON d.date = nd AND d.identifier = p.identifier),
    base AS MATERIALIZED (SELECT *, CASE WHEN sum(weight) OVER g > 0 THEN weight / sum(weight) OVER g ELSE 1e0 / count(*) OVER g END AS reset FROM w WINDOW g AS (PARTITION BY date, hour)),
    arc0 AS (SELECT date, hour, id1 AS src, id2 AS dst FROM c UNION ALL SELECT date, hour, id2, id1 FROM c),
    arcs AS MATERIALIZED (SELECT date, hour, src, dst, n / sum(n) OVER (PARTITION BY date, hour, src) AS share FROM (SELECT date, hour, src, dst, CAST(count(*) AS DOUBLE) AS n FROM arc0 GROUP BY 1, 2, 3, 4)),
    r AS (SELECT 0 AS k, date, hour, identifier, reset AS rank FROM base UNION ALL
        SELECT k + 1, b.date, b.hour, b.identifier, 0.15e0 * reset + 0.85e0 * coalesce(f, 0) FROM base b JOIN (
            SELECT k, a.date, a.hour, dst AS identifier, sum(rank * share) AS f FROM arcs a JOIN r ON r.date = a.date AND r.hour = a.hour AND r.identifier = src WHERE k < {ROUNDS} GROUP BY 1, 2, 3, 4) i USING (date, hour, identifier)),
    ranks AS MATERIALIZED (SELECT date, hour, identifier, rank FROM r WHERE k = {ROUNDS})""".replace("{ROUNDS}", str(ROUNDS))

SCORED = RANK_CTE + """,
    scored AS (SELECT c.*, round(x.rank * y.rank, 12) AS centrality FROM c JOIN ranks x ON x.date = c.date AND x.hour = c.hour AND x.identifier = id1 JOIN ranks y ON y.date = c.date AND y.hour = c.hour AND y.identifier = id2),
    spots AS (SELECT date, hour, lat, lon, CAST(count(*) AS DOUBLE) AS total FROM (SELECT *, row_number() OVER g AS k, count(*) OVER (PARTITION BY date, hour) AS n FROM scored WINDOW g AS (PARTITION BY date, hour ORDER BY centrality DESC, event_id))
        WHERE k <= ceil(0.1 * n) GROUP BY 1, 2, 3, 4)"""


def scored(t):
    return places.scored_contacts(t.good_contacts, t.distances_to_infected)


def hourly(t):
    """The historic table of places: written once, read by every list made from it."""
    return cut_lineage(places.hourly_places(cut_lineage(scored(t))))


@query("contact_node_weights", f"WITH RECURSIVE {RANK_CTE} SELECT date, hour, identifier, weight FROM w", d="date", r="weight", covers="H7 C14 K18")
def _(t):
    c = t.good_contacts.filter(F.col("hour").between(*places.HOURS))
    return places.node_weights(c, t.distances_to_infected)


@query("personalised_rank", f"WITH RECURSIVE {RANK_CTE} SELECT date, hour, identifier, rank AS centrality FROM ranks", d="date", r="centrality", covers="J5")
def _(t):
    c = t.good_contacts.filter(F.col("hour").between(*places.HOURS))
    nodes = places.node_weights(c, t.distances_to_infected)
    edges = c.groupBy("date", "hour", "id1", "id2").agg(F.count("*").cast("double").alias("weight"))
    return graphs.personalised_rank(nodes, edges, ["date", "hour"])


@query("hourly_best_places", f"WITH RECURSIVE {SCORED} SELECT * FROM spots", d="date", r="lat lon", covers="K18 E11 L3")
def _(t):
    return hourly(t)


@query("top_places", f"""
    WITH RECURSIVE {SCORED}, recent AS (SELECT lat, lon, count(*) AS n FROM good_contacts WHERE date >= (SELECT max(date) FROM good_contacts) - INTERVAL 14 DAY GROUP BY 1, 2),
        best AS (SELECT lat, lon, sum(total) AS n FROM spots WHERE date >= (SELECT max(date) FROM spots) - INTERVAL 14 DAY GROUP BY 1, 2)
    SELECT lat, lon, CAST(n AS DOUBLE) AS total, 'Contacts Top' AS type FROM (SELECT * FROM recent ORDER BY n DESC, lat, lon LIMIT 10)
    UNION ALL SELECT lat, lon, n, 'Pagerank Top' FROM (SELECT * FROM best ORDER BY n DESC, lat, lon LIMIT 10)""", r="lat lon", covers="K18 F5 D20 B10")
def _(t):
    return places.top_places(t.good_contacts, hourly(t))


@query("rolling_top_places", f"""
    WITH RECURSIVE {SCORED}, a AS (SELECT min(date) AS d0 FROM spots), win AS (SELECT d0 + CAST(date_diff('day', d0, date) // 16 * 16 AS INTEGER) AS window_start, lat, lon, sum(total) AS total FROM spots, a GROUP BY 1, 2, 3)
    SELECT window_start, total FROM win QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY total DESC, lat, lon) <= 10""", d="window_start", covers="K20")
def _(t):
    return places.rolling_top_places(hourly(t)).select("window_start", "total")


@query("old_and_new_places", f"""
    WITH RECURSIVE {SCORED}, cut AS (SELECT max(date) - INTERVAL 14 DAY AS c FROM spots)
    SELECT lat, lon, sum(total) AS total, CASE WHEN bool_or(date > c) AND bool_or(date <= c) THEN 'both' WHEN bool_or(date > c) THEN 'recent' ELSE 'historic' END AS kind FROM spots, cut GROUP BY 1, 2""", r="lat lon", covers="K19")
def _(t):
    return places.old_and_new(hourly(t))


def user_places(t):
    p = t.good_contacts.groupBy("lat", "lon").agg(F.count("*").cast("double").alias("total"))
    return p.withColumn("id", F.xxhash64("lat", "lon"))


@query("merged_places", covers="K19 C19")
def _(t):
    return places.merge_places(user_places(t), 4000.0)


@query("enriched_places", covers="K19 C10 B14 E15")
def _(t):
    from wayflux.operators.spatial import with_rings
    from wayflux.sources.testdata import square_wkt

    merged = places.merge_places(user_places(t), 4000.0)
    layer = t.ringed.select(F.col("poly_name").alias("name"), "rings")
    uses = with_rings(t.polygons.select(square_wkt(F.col("poly_lon"), F.col("poly_lat"), 0.125).alias("geometry"), F.col("poly_name").alias("name"), F.when(F.col("attr_area") > 4, "SALUD").otherwise("TRANS").alias("class")))
    out = places.enrich_places(merged, {"district": layer}, uses, ["SALUD", "TRANS"])
    return places.presence(out.withColumns({"has_salud": F.col("SALUD"), "has_trans": F.col("TRANS")}), ["has_salud", "has_trans"])


@query("mean_flow_graph", """
    SELECT least(start_poly_id, end_poly_id) AS id1, greatest(start_poly_id, end_poly_id) AS id2, sum(movement) / (SELECT count(DISTINCT date_time) FROM movement) AS weight FROM movement WHERE start_poly_id <> end_poly_id GROUP BY 1, 2""", r="weight", covers="J4")
def _(t):
    return graphs.mean_flow_graph(t.movement)


@query("flow_communities", covers="J4 D26")
def _(t):
    labels = graphs.detect_communities(graphs.mean_flow_graph(t.movement), t.polygons.select(F.col("poly_id").alias("id")))
    members = t.polygons.join(labels.select(F.col("id").alias("poly_id"), F.col("label").alias("community_id")), "poly_id")
    names = aggregates.community_summary(members, "attr_population").select("community_id", "center_id", "community_name")
    return members.select("poly_id", "poly_name", "community_id").join(names, "community_id")


@query("community_cases", """
    SELECT date_time, community_id AS poly_id, community_name AS location, sum(num_cases) AS num_cases, sum(num_diseased) AS num_diseased, sum(num_recovered) AS num_recovered, sum(num_infected) AS num_infected
    FROM cases JOIN community_map USING (poly_id) GROUP BY 1, 2, 3""", d="date_time", covers="J3 D1")
def _(t):
    return agglomerate.by_community(t.polygons, t.cases, t.movement, t.community_map, rules.DEFAULT_RULES + [rules.Rule("attr_area", "attr_addition")])["cases"]


@query("community_areas", """
    WITH f AS (SELECT p.*, community_id, coalesce(n, 0) AS num_cases FROM polygons p JOIN (SELECT poly_id, community_id FROM community_map) m USING (poly_id) LEFT JOIN (SELECT poly_id, sum(num_cases) AS n FROM cases GROUP BY 1) USING (poly_id))
    SELECT community_id AS poly_id, arg_max(poly_name, (num_cases, poly_name)) AS poly_name, arg_max(poly_lon, (num_cases, poly_lon)) AS poly_lon, arg_max(poly_lat, (num_cases, poly_lat)) AS poly_lat,
           sum(attr_population) AS attr_population, sum(attr_area) AS attr_area, sum(num_cases) AS num_cases FROM f GROUP BY 1""", covers="J3 D1 D7")
def _(t):
    scheme = rules.DEFAULT_RULES + [rules.Rule("attr_area", "attr_addition")]
    out = agglomerate.by_community(t.polygons, t.cases.select("date_time", "poly_id", "num_cases"), t.movement, t.community_map, scheme)["polygons"]
    return out.drop("geometry")


def event_graph(t):
    """Daily graph of the located events: cases per area and day, trips as flows."""
    from wayflux.catalog.spatial import located_cases, located_tiles

    cases = agglomerate.cases_by_geometry(located_cases(t), t.polygons)
    flows = agglomerate.flows_by_geometry(located_tiles(t), t.polygons)
    return graphs.build_graphs(t.polygons, cases, flows)


@query("day_distances", covers="J8")
def _(t):
    nodes, _, where = event_graph(t)
    return shape.day_distances(nodes, where)


def skeleton(t):
    nodes, edges, where = event_graph(t)
    nodes = cut_lineage(nodes)
    dist = cut_lineage(shape.day_distances(nodes, where))
    values = graphs.graph_values(nodes, edges)
    return shape.mapper_nodes(values, dist, {"inner_movement": 8, "external_movement": 8}, 0.4, 70.0)


@query("mapper_clusters", covers="J9")
def _(t):
    return skeleton(t)


@query("mapper_links", covers="J9")
def _(t):
    return shape.mapper_edges(cut_lineage(skeleton(t)))
