"""Rule-driven and plain aggregations."""

from pyspark.sql import functions as F

from wayflux.catalog.base import query
from wayflux.functions import vectors
from wayflux.operators import aggregates, rules
from wayflux.operators.rules import Rule


def _parts(t):
    p = t.raw("part")
    return p.select(
        "p_brand", F.col("p_size").cast("double").alias("attr_size_sum"), F.col("p_retailprice").alias("attr_price_avg"),
        F.col("p_type").alias("attr_type_union"), F.col("p_partkey").cast("string").alias("attr_key_append"),
        F.concat_ws("|", F.lit("A"), "p_type", F.substring_index("p_name", " ", 1)).alias("attr_words_intersect"),
        F.col("p_retailprice").alias("attr_price_wvg-pop"), F.col("p_size").cast("double").alias("attr_population"),
        F.col("p_name").alias("poly_name"), F.col("p_retailprice").alias("num_cases"), F.col("p_partkey"),
    )


@query("attributes_by_rule", """
    SELECT p_brand, sum(CAST(p_size AS DOUBLE)) AS attr_size_sum, avg(p_retailprice) AS attr_price_avg, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS attr_type_union,
           md5(string_agg(CAST(p_partkey AS VARCHAR), '|' ORDER BY CAST(p_partkey AS VARCHAR))) AS keys, sum(p_size * p_retailprice) / sum(p_size) AS weighted,
           arg_max(p_name, (p_retailprice, p_name)) AS poly_name FROM part GROUP BY 1""", r="attr_price_avg weighted", covers="D1 D2 D3 D4 D6 D7 M2 M3 H3")
def _(t):
    scheme = rules.override(rules.DEFAULT_RULES, {"^attr.*wvg-pop$": Rule("^attr.*wvg-pop$", "attr_weighted_average", "attr_population")})
    out = rules.agglomerate(_parts(t), scheme, ["p_brand"], ["attr_size_sum", "attr_price_avg", "attr_type_union", "attr_key_append", "attr_price_wvg-pop", "poly_name"])
    return out.withColumn("keys", F.md5("attr_key_append")).withColumnRenamed("attr_price_wvg-pop", "weighted").drop("attr_key_append")


@query("tokens_shared_by_all", """
    WITH tok AS (SELECT p_brand, p_partkey, unnest(list_distinct(['A', p_type, split_part(p_name, ' ', 1)])) AS tk FROM part), n AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1)
    SELECT n.p_brand, coalesce(string_agg(tk, '|' ORDER BY tk), '') AS attr_words_intersect FROM n LEFT JOIN (SELECT p_brand, tk, count(*) AS c FROM tok GROUP BY 1, 2) x
        ON x.p_brand = n.p_brand AND x.c = n.n GROUP BY 1""", covers="D5")
def _(t):
    return rules.agglomerate(_parts(t), rules.DEFAULT_RULES, ["p_brand"], ["attr_words_intersect"])


@query("smallest_by_rule", "SELECT p_brand, arg_min(p_name, (p_retailprice, p_name)) AS cheapest FROM part GROUP BY 1", covers="D7")
def _(t):
    df = t.raw("part").select("p_brand", F.col("p_name").alias("cheapest"), "p_retailprice")
    return rules.agglomerate(df, [Rule("cheapest", "attr_with_min", "p_retailprice")], ["p_brand"], ["cheapest"])


@query("mixed_vectors", """
    WITH v AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i, CAST(vec_id % 5 + 1 AS DOUBLE) AS w FROM embeddings)
    SELECT label, i - 1 AS i, avg(CAST(x AS DOUBLE)) AS mixed, sum(CAST(x AS DOUBLE) * w) / sum(w) AS mixed_weighted FROM v GROUP BY 1, 2""", r="mixed mixed_weighted", i="label i", covers="D9 D10 H8")
def _(t):
    v = F.col("embedding").cast("array<double>")
    df = t.raw("embeddings").select("label", v.alias("attr_a_mix"), v.alias("attr_b_mix"), (F.col("vec_id") % 5 + 1).cast("double").alias("w"))
    scheme = [Rule("attr_a_mix", "attr_dist_mix", "", "sep=|"), Rule("attr_b_mix", "attr_dist_mix_weighted", "w", "sep=|")]
    out = rules.agglomerate(df, scheme, ["label"], ["attr_a_mix", "attr_b_mix"])
    both = F.arrays_zip(F.col("attr_a_mix").alias("a"), F.col("attr_b_mix").alias("b"))
    return out.select("label", F.posexplode(both).alias("i", "z")).select("label", "i", F.col("z")["a"].alias("mixed"), F.col("z")["b"].alias("mixed_weighted"))


@query("delay_curves", covers="D8")
def _(t):
    """Gamma delay density per nation from the order-to-shipping delays."""
    o = t.case_list.select(F.col("o_orderkey").alias("l_orderkey"), "poly_id", "date_time")
    li = t.raw("lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").alias("s")).join(o, "l_orderkey")
    d = li.withColumn("attr_time_delay", F.pmod(F.datediff("s", "date_time"), F.lit(61)).cast("double"))
    out = rules.agglomerate(d, [Rule("attr_time_delay", "estimate_gamma_delay")], ["poly_id"], ["attr_time_delay"])
    return out.select("poly_id", F.posexplode("attr_time_delay").alias("i", "p"))


@query("merged_geometry", """
    WITH RECURSIVE d AS (SELECT community_id AS c, unnest([w, e, e, w]) AS x1, unnest([s, s, n, n]) AS y1, unnest([e, e, w, w]) AS x2, unnest([s, n, n, s]) AS y2 FROM squares JOIN community_map USING (poly_id)),
    b AS (SELECT * FROM d a WHERE NOT EXISTS (SELECT 1 FROM d o WHERE o.c = a.c AND o.x1 = a.x2 AND o.y1 = a.y2 AND o.x2 = a.x1 AND o.y2 = a.y1)),
    f AS (SELECT a.*, o.x2 AS x3, o.y2 AS y3 FROM b a JOIN b o ON o.c = a.c AND o.x1 = a.x2 AND o.y1 = a.y2
          QUALIFY row_number() OVER (PARTITION BY a.c, a.x1, a.y1, a.x2, a.y2 ORDER BY (a.x2 - a.x1) * (o.y2 - o.y1) - (a.y2 - a.y1) * (o.x2 - o.x1) DESC) = 1),
    k AS (SELECT c, x1 AS sx, y1 AS sy, x2 AS tx, y2 AS ty, x2, y2, x3, y3, [{'x': x1, 'y': y1}] AS path FROM f
          UNION ALL SELECT k.c, sx, sy, tx, ty, f.x2, f.y2, f.x3, f.y3, list_append(path, {'x': k.x2, 'y': k.y2}) FROM k JOIN f ON f.c = k.c AND f.x1 = k.x2 AND f.y1 = k.y2 AND f.x2 = k.x3 AND f.y2 = k.y3
          WHERE NOT (k.x2 = sx AND k.y2 = sy AND k.x3 = tx AND k.y3 = ty)),
    r AS (SELECT DISTINCT c, list_filter(path, lambda p, i: (p.x - path[(i + len(path) - 2) % len(path) + 1].x) * (path[i % len(path) + 1].y - p.y) <> (p.y - path[(i + len(path) - 2) % len(path) + 1].y) * (path[i % len(path) + 1].x - p.x)) AS ring
          FROM k WHERE x2 = sx AND y2 = sy AND x3 = tx AND y3 = ty AND {'x': sx, 'y': sy} = list_min(path)),
    t AS (SELECT c, ring, '((' || array_to_string(list_transform(list_append(ring, ring[1]), lambda p: p.x || ' ' || p.y), ', ') || '))' AS part FROM r)
    SELECT c AS community_id, 'MULTIPOLYGON (' || string_agg(part, ', ' ORDER BY ring) || ')' AS geometry FROM t GROUP BY 1""", covers="D11")
def _(t):
    df = t.polygons.join(t.community_map.select("poly_id", "community_id"), "poly_id")
    return rules.agglomerate(df, rules.DEFAULT_RULES, ["community_id"], ["geometry"])


@query("movement_statistics", """
    SELECT poly_id, avg(inner_movement) AS mean_inner_movement, avg(external_movement) AS mean_external_movement, stddev_samp(inner_movement) AS std_inner_movement, stddev_samp(external_movement) AS std_external_movement,
        mean_inner_movement + std_inner_movement AS one_std_over_inner_movement, mean_inner_movement + 1.5e0 * std_inner_movement AS one_half_std_over_inner_movement, mean_inner_movement + 2 * std_inner_movement AS two_std_over_inner_movement,
        mean_external_movement + std_external_movement AS one_std_over_external_movement, mean_external_movement + 1.5e0 * std_external_movement AS one_half_std_over_external_movement, mean_external_movement + 2 * std_external_movement AS two_std_over_external_movement
    FROM daily_flow GROUP BY 1""",
       r="mean_inner_movement mean_external_movement std_inner_movement std_external_movement one_std_over_inner_movement one_half_std_over_inner_movement two_std_over_inner_movement one_std_over_external_movement one_half_std_over_external_movement two_std_over_external_movement", covers="D13")
def _(t):
    return aggregates.movement_stats(aggregates.daily_in_out(t.movement))


@query("extreme_flows", """
    (SELECT 'max' AS kind, poly_id, date_time, external_movement FROM daily_flow ORDER BY external_movement DESC, date_time, poly_id LIMIT 1)
    UNION ALL (SELECT 'min', poly_id, date_time, external_movement FROM daily_flow ORDER BY external_movement, date_time, poly_id LIMIT 1)""", d="date_time", covers="D14")
def _(t):
    return aggregates.extreme_rows(aggregates.daily_in_out(t.movement), "external_movement", ["date_time", "poly_id"], ["poly_id", "date_time", "external_movement"])


@query("extreme_case_days", """
    (SELECT 'max' AS kind, date_time, sum(num_cases) AS num_cases FROM cases GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 1)
    UNION ALL (SELECT 'min', date_time, sum(num_cases) FROM cases GROUP BY 2 ORDER BY 3, 2 LIMIT 1)""", d="date_time", covers="D14")
def _(t):
    return aggregates.extreme_days(t.cases, "num_cases")


@query("areas_with_first_case", """
    SELECT poly_id, min(date_time) AS first_date FROM cases WHERE num_cases > 0 GROUP BY 1 HAVING min(date_time) >= DATE '1995-01-12' - INTERVAL 9 DAY""", d="first_date", covers="D15")
def _(t):
    return aggregates.first_case_areas(t.cases, 9, "1995-01-12")


@query("areas_gone_silent", """
    SELECT poly_id, max(date_time) AS last_date FROM cases WHERE num_cases > 0 GROUP BY 1 HAVING max(date_time) < (SELECT max(date_time) FROM cases) - INTERVAL 1 DAY""", d="last_date", covers="D15")
def _(t):
    return aggregates.silent_areas(t.cases, 1)


@query("smallest_inner_flows", """
    SELECT node_id, avg(inner_movement) FILTER (WHERE k <= 10) AS min_avg_movement, avg(inner_movement) AS mean_movement, stddev_samp(inner_movement) AS std_movement
    FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY inner_movement NULLS LAST, date_time) AS k FROM nodes) GROUP BY 1""", r="min_avg_movement mean_movement std_movement", covers="D17")
def _(t):
    return aggregates.smallest_mean(t.graph[0])


@query("weekly_rates", """
    SELECT poly_id, CAST(date_trunc('week', date_time) AS DATE) + 6 AS week, sum(num_cases) AS num_cases, sum(num_diseased) AS num_diseased,
           sum(num_cases) / max(attr_population) * 10000 AS num_cases_rate, sum(num_diseased) / max(attr_population) * 10000 AS num_diseased_rate
    FROM cases JOIN polygons USING (poly_id) GROUP BY 1, 2""", d="week", r="num_cases_rate num_diseased_rate", covers="D18")
def _(t):
    return aggregates.weekly_rates(t.cases.select("poly_id", "date_time", "num_cases", "num_diseased"), t.polygons)


@query("contacts_by_place", "SELECT lat, lon, count(*) AS total_contacts FROM good_contacts GROUP BY 1, 2", r="lat lon", covers="D20")
def _(t):
    return aggregates.contacts_by_place(t.good_contacts, 4)


@query("mean_daily_counts", "SELECT event_type, avg(n) AS mean_daily FROM (SELECT event_type, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1", r="mean_daily", covers="D21")
def _(t):
    return aggregates.mean_daily_count(t.raw("events").withColumn("d", F.col("ts").cast("date")), "event_type", "d")


@query("weighted_daily_range", """
    SELECT date_time, sum(attr_population * movement_change) / sum(attr_population) AS movement_change FROM area_range JOIN polygons USING (poly_id) GROUP BY 1""", d="date_time", r="movement_change", covers="D22")
def _(t):
    df = t.area_range.join(t.polygons.select("poly_id", "attr_population"), "poly_id")
    return aggregates.weighted_mean_by(df, ["date_time"], "movement_change", "attr_population")


@query("indicators_of_unions", """
    SELECT community_id, sum(poblacion * ipm) / sum(poblacion) AS ipm, sum(poblacion * porcentaje_sobre_60) / sum(poblacion) AS porcentaje_sobre_60, sum(poblacion) AS poblacion, sum(num_camas_UCI) AS num_camas_UCI
    FROM indicators JOIN community_map ON node_id = poly_id GROUP BY 1""", r="ipm porcentaje_sobre_60", covers="D23")
def _(t):
    df = t.area_indicators.join(t.community_map.select(F.col("poly_id").alias("node_id"), "community_id"), "node_id")
    return aggregates.union_indicators(df, ["ipm", "porcentaje_sobre_60"], ["num_camas_UCI"], "poblacion", ["community_id"])


@query("month_week_flows", """
    SELECT start_poly_id, end_poly_id, month(date_time) AS month, least(day(date_time) // 7 + 1, 4) AS week, avg(movement) AS movement FROM movement GROUP BY 1, 2, 3, 4""", r="movement", i="month week", covers="D24")
def _(t):
    return aggregates.month_week_means(t.movement)


@query("recent_flow_means", """
    SELECT start_poly_id, end_poly_id, avg(movement) AS movement FROM movement WHERE date_time > (SELECT max(date_time) FROM movement) - INTERVAL 30 DAY GROUP BY 1, 2""", r="movement", covers="D25")
def _(t):
    return aggregates.recent_pair_means(t.movement, 30)


@query("community_names", """
    WITH m AS (SELECT * FROM polygons JOIN (SELECT poly_id, community_id FROM community_map) USING (poly_id))
    SELECT community_id, arg_max(poly_id, (attr_population, poly_id)) AS center_id, arg_max(poly_name, (attr_population, poly_id)) AS community_name, arg_max(poly_lon, (attr_population, poly_id)) AS lon,
           arg_max(poly_lat, (attr_population, poly_id)) AS lat, string_agg(poly_id, ', ' ORDER BY poly_id) AS member_ids, sum(attr_population) AS attr_population FROM m GROUP BY 1""", covers="D26")
def _(t):
    return aggregates.community_summary(t.polygons.join(t.community_map.select("poly_id", "community_id"), "poly_id"), "attr_population")


@query("community_ranges", """
    SELECT date_time, community_id AS poly_id, sum(v * f) / sum(f) AS movement_change
    FROM (SELECT poly_id, date_time, external_movement / 100 AS v FROM daily_flow) JOIN (SELECT poly_id, attr_population / attr_area AS f FROM polygons) USING (poly_id) JOIN community_map USING (poly_id) GROUP BY 1, 2""",
       d="date_time", r="movement_change", covers="D27 J3")
def _(t):
    r = aggregates.daily_in_out(t.movement).select("poly_id", "date_time", (F.col("external_movement") / 100).alias("movement_change"))
    return aggregates.factor_average(r, t.polygons, t.community_map)


@query("population_classes", """
    WITH q AS (SELECT quantile_cont(round_even(attr_population / 10, 0), [0.3, 0.6, 0.9]) AS q FROM polygons)
    SELECT poly_id, CASE WHEN attr_population / 10 > q[3] THEN 3 WHEN attr_population / 10 >= q[2] THEN 2 WHEN attr_population / 10 >= q[1] THEN 1 ELSE 0 END AS quantile_class FROM polygons, q""", i="quantile_class", covers="D28")
def _(t):
    return aggregates.quantile_class(t.polygons, "attr_population", 10.0).select("poly_id", "quantile_class")


@query("values_described", """
    SELECT event_type, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75, max(value) AS max
    FROM events GROUP BY 1""", r="mean std min q25 q50 q75 max", covers="D30")
def _(t):
    return aggregates.describe_column(t.raw("events"), "value", ["event_type"])


@query("daily_sample_summary", """
    SELECT CAST(ts AS DATE) AS date, avg(value) AS mean, stddev_samp(value) AS std, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.025) AS q025, quantile_cont(value, 0.25) AS q25,
           quantile_cont(value, 0.75) AS q75, quantile_cont(value, 0.975) AS q975 FROM events GROUP BY 1""", d="date", r="mean std median q025 q25 q75 q975", covers="D31")
def _(t):
    return aggregates.sample_summary(t.raw("events").withColumn("date", F.col("ts").cast("date")), ["date"], "value")


@query("areas_and_overall", """
    SELECT poly_id, date_time, sum(num_cases) AS num_cases FROM cases GROUP BY 1, 2 UNION ALL SELECT 'aggregated', date_time, sum(num_cases) FROM cases GROUP BY 2""", d="date_time", covers="D32")
def _(t):
    return aggregates.with_overall(t.cases, "poly_id", "date_time", "num_cases")


@query("flow_shares", """
    WITH p AS (SELECT start_poly_id, end_poly_id, sum(movement) AS movement FROM movement WHERE start_poly_id <> end_poly_id GROUP BY 1, 2)
    SELECT *, movement / sum(movement) OVER (PARTITION BY start_poly_id) AS outgoing_share, movement / sum(movement) OVER (PARTITION BY end_poly_id) AS incoming_share FROM p""", r="outgoing_share incoming_share", covers="D33")
def _(t):
    from wayflux.operators.reshape import external

    return aggregates.od_shares(external(t.movement))


@query("weekday_weekend_flows", """
    WITH r AS (SELECT start_poly_id AS poly_id, 'stay' AS kind, date_time, movement FROM movement WHERE start_poly_id = end_poly_id
               UNION ALL SELECT start_poly_id, 'out', date_time, movement FROM movement WHERE start_poly_id <> end_poly_id
               UNION ALL SELECT end_poly_id, 'in', date_time, movement FROM movement WHERE start_poly_id <> end_poly_id),
         m AS (SELECT poly_id, kind, part, avg(m) AS movement FROM (SELECT poly_id, kind, CASE WHEN isodow(date_time) >= 5 THEN 'weekend' ELSE 'weekday' END AS part, date_time, sum(movement) AS m FROM r GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3)
    SELECT *, (movement - min(movement) OVER (PARTITION BY kind)) / (max(movement) OVER (PARTITION BY kind) - min(movement) OVER (PARTITION BY kind)) AS scaled FROM m""", r="movement scaled", covers="D34")
def _(t):
    return aggregates.weekday_weekend(t.movement)


@query("box_statistics", """
    WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
    SELECT event_type, q1, median, q3, min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)) AS whisker_low, max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)) AS whisker_high FROM events JOIN q USING (event_type) GROUP BY 1, 2, 3, 4""",
       r="q1 median q3 whisker_low whisker_high", covers="D35")
def _(t):
    return aggregates.box_stats(t.raw("events").select("event_type", "value"), ["event_type"], "value")


@query("transits_from_houses", """
    SELECT event_type AS location_id, user_id AS identifier, CAST(ts AS DATE) AS date, count(*) AS total_transits FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD') GROUP BY 1, 2, 3""", d="date", covers="D36")
def _(t):
    tr = t.raw("events").select(F.col("event_type").alias("location_id"), F.col("user_id").alias("identifier"), F.col("ts").cast("date").alias("date"), F.lit(1).cast("bigint").alias("total_transits"))
    homes = t.raw("customer").select(F.col("c_custkey").alias("identifier"), F.when(F.col("c_mktsegment") == "HOUSEHOLD", "HOUSE").otherwise("OTHER").alias("type"))
    return aggregates.transits_from_homes(tr, homes)


@query("city_group_ranges", """
    SELECT coalesce(CASE WHEN community_name IN ('ASIA', 'EUROPE') THEN community_name END, 'Other') AS grp, date_time, avg(movement_change) AS movement_change FROM area_range JOIN community_map USING (poly_id) GROUP BY 1, 2""", d="date_time", r="movement_change", covers="D37")
def _(t):
    m = t.community_map.filter(F.col("community_name").isin("ASIA", "EUROPE")).select("poly_id", F.col("community_name").alias("grp"))
    return aggregates.bucket_means(t.area_range, m, "poly_id", "grp", ["date_time"], "movement_change")


@query("area_ranges_of_values", """
    SELECT poly_id, max_cases, min_cases, max_inner_movement, min_inner_movement, max_external_movement, min_external_movement
    FROM (SELECT poly_id, max(num_cases) AS max_cases, min(num_cases) AS min_cases FROM cases GROUP BY 1) FULL JOIN (SELECT poly_id, max(inner_movement) AS max_inner_movement, min(inner_movement) AS min_inner_movement,
        max(external_movement) AS max_external_movement, min(external_movement) AS min_external_movement FROM daily_flow GROUP BY 1) USING (poly_id)""", covers="D38")
def _(t):
    return aggregates.area_ranges(t.cases, t.movement)


@query("areas_with_cases", "SELECT poly_id, sum(num_cases) AS num_cases FROM cases GROUP BY 1 HAVING sum(num_cases) > 0", covers="D38")
def _(t):
    return aggregates.areas_with_cases(t.cases)


@query("node_flow_statistics", """
    WITH d AS (SELECT node_id, date_time, sum(movement) AS m FROM (SELECT start_id AS node_id, date_time, movement FROM edges UNION ALL SELECT end_id, date_time, movement FROM edges) GROUP BY 1, 2),
         s AS (SELECT node_id, avg(m) AS mean_external_movement, stddev_samp(m) AS std_external_movement FROM d GROUP BY 1)
    SELECT *, mean_external_movement + std_external_movement AS one_std_over_external_movement, mean_external_movement + 1.5e0 * std_external_movement AS one_half_std_over_external_movement, mean_external_movement + 2 * std_external_movement AS two_std_over_external_movement FROM s""",
       r="mean_external_movement std_external_movement one_std_over_external_movement one_half_std_over_external_movement two_std_over_external_movement", covers="D39")
def _(t):
    return aggregates.node_flow_stats(t.graph[1], t.graph[0])


@query("densest_value_intervals", """
    WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS i, count(*) OVER (PARTITION BY event_type) // 2 AS k FROM events)
    SELECT event_type, x[2] AS low, x[3] AS high FROM (SELECT a.event_type, min([round(b.value - a.value, 9), a.value, b.value]) AS x FROM r a JOIN r b ON a.event_type = b.event_type AND b.i = a.i + a.k GROUP BY 1)""", r="low high", covers="D40")
def _(t):
    return aggregates.highest_density(t.raw("events").select("event_id", "event_type", "value"), ["event_type"], "value", "event_id", 0.5)
