"""Projections, filters, reshaping, scalars, sorts and set operations."""

from pyspark.sql import functions as F

from wayflux.catalog.base import query
from wayflux.functions import dates, geo, text, vectors
from wayflux.operators import ranking, reshape


@query("orders_to_contract", "SELECT o_orderkey AS case_id, o_orderdate::DATE AS date_time, o_orderstatus AS status FROM orders", d="date_time", covers="B1")
def _(t):
    df = t.raw("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return reshape.to_contract(df, {"o_orderkey": "case_id", "o_orderdate": "date_time", "o_orderstatus": "status"})


@query("cleaned_part_names", """
    SELECT p_partkey, trim(replace(replace(replace(replace(p_name, 'red ', ''), 'RED ', ''), 'ring', ''), 'RING', '')) AS name,
           split_part(p_brand, '#', 1) AS maker FROM part""", covers="B2 H1")
def _(t):
    return t.raw("part").select("p_partkey", text.strip_words(F.col("p_name"), ["red ", "ring"]).alias("name"), F.substring_index("p_brand", "#", 1).alias("maker"))


TITLE = "array_to_string(list_transform(regexp_extract_all({}, '\\p{{L}}+|[^\\p{{L}}]+'), lambda w: upper(w[1]) || lower(w[2:])), '')"


@query("display_names", f"""
    SELECT c_custkey, replace(replace(lower(split_part(split_part(split_part(replace(c_name, '.', ''), '-', 1), ':', 1), '_', 1)), '   ', ' '), ' ', '_') AS slug,
           replace({TITLE.format("replace(c_name || '-' || c_mktsegment, '_', ' ')")}, '-', ' - ') AS shown FROM customer""", covers="B3 H1")
def _(t):
    full = F.concat_ws("-", "c_name", "c_mktsegment")
    return t.raw("customer").select("c_custkey", text.slug(F.col("c_name")).alias("slug"), text.publication_name(full).alias("shown"))


@query("folded_documents", """
    SELECT doc_id, md5(translate(text, 'áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ', 'aaaaaaeeeeiiiiooooouuuuncAAAAAAEEEEIIIIOOOOOUUUUNC')) AS folded FROM documents""", covers="H2")
def _(t):
    return t.raw("documents").select("doc_id", F.md5(text.fold_accents(F.col("text"))).alias("folded"))


@query("synthetic_ids", """
    SELECT c_custkey, substr(c_name, 1, 3) || '-' || length(c_name) || '-' || right(c_name, 1) AS short_id, upper(c_mktsegment) || '-' || upper(n_name) AS pair_id,
           replace(upper(CASE WHEN c_acctbal > 0 THEN n_name ELSE c_mktsegment END), ' ', '-') AS province_id
    FROM customer JOIN nation ON c_nationkey = n_nationkey""", covers="B4")
def _(t):
    c = t.raw("customer").join(t.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    province = F.when(F.col("c_acctbal") > 0, F.col("n_name"))
    return c.select(
        "c_custkey", text.short_id(F.col("c_name")).alias("short_id"), text.pair_id(F.col("c_mktsegment"), F.col("n_name")).alias("pair_id"),
        text.province_id(province, F.col("c_mktsegment")).alias("province_id"),
    )


@query("tile_end_points", "SELECT event_id, start_movement_lon, start_movement_lat, end_movement_lon, end_movement_lat FROM tiles",
       r="start_movement_lon start_movement_lat end_movement_lon end_movement_lat", covers="B5")
def _(t):
    from wayflux.sources.files import with_endpoints
    from wayflux.sources.testdata import user_point

    x, y = user_point(F.col("user_id"))
    ex, ey = user_point(F.col("user_id").bitwiseXOR(F.col("event_id") % 7 + 1))
    line = F.concat(F.lit("LINESTRING ("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(", "), ex.cast("string"), F.lit(" "), ey.cast("string"), F.lit(")"))
    df = with_endpoints(t.raw("events").select("event_id", line.alias("geometry")))
    return df.drop("geometry")


@query("decimal_comma_prices", "SELECT p_partkey, p_retailprice AS price FROM part", r="price", covers="B6")
def _(t):
    txt = F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(","))
    return t.raw("part").select("p_partkey", text.decimal_comma(txt).alias("price"))


@query("status_counters", """
    SELECT date_time, poly_id, CAST(count(*) AS DOUBLE) AS num_cases, CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS num_recovered,
           CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS num_diseased, CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS num_infected,
           CAST(count(*) FILTER (WHERE o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')) AS DOUBLE) AS num_infected_in_hospital,
           CAST(count(*) FILTER (WHERE o_orderstatus = 'P' AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS DOUBLE) AS num_infected_in_house,
           CAST(count(*) FILTER (WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') AS DOUBLE) AS num_infected_in_icu
    FROM case_list GROUP BY 1, 2""", d="date_time", covers="B7 D12")
def _(t):
    from wayflux.operators.aggregates import sum_counters

    names = {"recovered": "O", "diseased": "F", "infected": "P", "hospital": "2-HIGH", "icu": "1-URGENT"}
    return sum_counters(reshape.status_counters(t.case_list, "o_orderstatus", "o_orderpriority", names), ["date_time", "poly_id"])


@query("cases_up_to_day", "SELECT date_time, poly_id, num_cases FROM cases WHERE date_time <= DATE '1998-12-31'", d="date_time", covers="B8")
def _(t):
    return reshape.up_to(t.cases, "date_time", "1998-12-31").select("date_time", "poly_id", "num_cases")


@query("flows_touching_selection", """
    SELECT * FROM movement WHERE start_poly_id IN (SELECT poly_id FROM community_map WHERE community_name = 'EUROPE')
        OR end_poly_id IN (SELECT poly_id FROM community_map WHERE community_name = 'EUROPE')""", d="date_time", covers="B9 M4")
def _(t):
    return reshape.touching_ids(t.movement, "start_poly_id", "end_poly_id", t.community_map.filter("community_name = 'EUROPE'").select("poly_id"))


@query("points_in_box", "SELECT event_id, lon, lat FROM points WHERE lat BETWEEN 4.0 AND 5.2 AND lon BETWEEN -74.9 AND -73.4", r="lon lat", covers="B10")
def _(t):
    return t.points.filter(geo.within_box(F.col("lon"), F.col("lat"), 4.0, 5.2, -74.9, -73.4)).select("event_id", "lon", "lat")


@query("valid_delays", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS DOUBLE) AS attr_time_delay
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) BETWEEN 1 AND 60""", i="l_linenumber", covers="B11")
def _(t):
    o = t.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("onset"))
    li = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("diagnosis"))
    both = reshape.valid_death_delays(reshape.valid_delays(li.join(o, "l_orderkey"), "onset", "diagnosis"), "onset", "diagnosis")
    return both.select("l_orderkey", "l_linenumber", "l_partkey", "attr_time_delay")


@query("largest_part_per_brand", """
    SELECT p_brand, p_partkey, p_size, p_retailprice FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) = 1""",
       i="p_size", r="p_retailprice", covers="B12")
def _(t):
    return reshape.keep_largest(t.raw("part").select("p_brand", "p_partkey", "p_size", "p_retailprice"), ["p_brand"], "p_size", "p_partkey")


YEARS = [str(y) for y in range(1995, 2002)]
WIDE = "SELECT c_nationkey AS geo_id, " + ", ".join(f"CAST(count(*) FILTER (WHERE year(o_orderdate) <= {y}) AS DOUBLE) AS y{y}" for y in YEARS) + " FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"


def wide_cumulative(t):
    """Cumulative counts per nation, one column per year."""
    o = t.raw("orders").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("y"))
    c = t.raw("customer").select("c_custkey", F.col("c_nationkey").alias("geo_id"))
    return o.join(c, "c_custkey").groupBy("geo_id").agg(*[F.sum(F.when(F.col("y") <= int(y), 1.0).otherwise(0.0)).alias(y) for y in YEARS])


@query("wide_years_to_long", f"""
    SELECT geo_id, y AS date_time, v AS num_cases FROM (SELECT geo_id, unnest([{", ".join(f"'{y}'" for y in YEARS)}]) AS y,
        unnest([y1995, {", ".join(f"y{b} - y{a}" for a, b in zip(YEARS, YEARS[1:]))}]) AS v FROM ({WIDE}))""", i="geo_id", covers="B13 E7")
def _(t):
    return reshape.melt_dates(reshape.undo_cumulative_wide(wide_cumulative(t), YEARS), ["geo_id"], YEARS)


@query("events_wide_by_type", """
    SELECT CAST(ts AS DATE) AS date, sum(value) FILTER (WHERE event_type = 'click') AS click, sum(value) FILTER (WHERE event_type = 'view') AS view
    FROM events GROUP BY 1""", d="date", r="click view", covers="B14")
def _(t):
    df = t.raw("events").withColumn("date", F.col("ts").cast("date"))
    return reshape.widen(df, ["date"], "event_type", ["click", "view"], F.sum("value"))


@query("area_beside_nation", """
    WITH long AS (SELECT node_id, unnest(['poblacion', 'ipm', 'porcentaje_subsidiado']) AS name, unnest([poblacion, ipm, porcentaje_subsidiado]) AS area_value FROM indicators),
         ref AS (SELECT 'ipm' AS name, avg(ipm) AS reference_value FROM indicators UNION ALL SELECT 'other', 1.0)
    SELECT name, node_id, area_value, reference_value FROM long FULL JOIN ref USING (name)""", r="area_value reference_value", covers="B15")
def _(t):
    ind = t.area_indicators.select("node_id", "poblacion", "ipm", "porcentaje_subsidiado")
    ref = ind.agg(F.avg("ipm").alias("value")).select(F.lit("ipm").alias("name"), "value").unionByName(t.spark.range(1).select(F.lit("other").alias("name"), F.lit(1.0).alias("value")))
    return reshape.beside_reference(ind, "node_id", ref)


@query("filled_inner_flow", "SELECT poly_id AS node_id, c.date_time, coalesce(movement, 0) AS movement, CASE WHEN movement IS NULL THEN 'VERDE' ELSE 'ROJO' END AS mark FROM cases c LEFT JOIN movement m ON m.date_time = c.date_time AND start_poly_id = poly_id AND end_poly_id = poly_id",
       d="date_time", covers="B16")
def _(t):
    m = reshape.internal(t.movement).select("date_time", F.col("start_poly_id").alias("poly_id"), "movement", F.lit("ROJO").alias("mark"))
    return t.cases.select("poly_id", "date_time").join(m, ["poly_id", "date_time"], "left").na.fill({"movement": 0.0, "mark": "VERDE"}).withColumnRenamed("poly_id", "node_id")


@query("names_split", "SELECT poly_id, split_part(poly_name, '-', 1) AS municipality, split_part(poly_name, '-', 2) AS department, sum(num_cases) AS n FROM cases JOIN polygons USING (poly_id) GROUP BY 1, 2, 3", covers="B18")
def _(t):
    total = t.cases.groupBy("poly_id").agg(F.sum("num_cases").alias("n"))
    return reshape.split_name(t.polygons.join(total, "poly_id"), "poly_name", "municipality", "department").select("poly_id", "municipality", "department", "n")


@query("prices_without_outliers", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
    WHERE abs(l_extendedprice) BETWEEN (SELECT quantile_cont(abs(l_extendedprice), 0.05) FROM lineitem) AND (SELECT quantile_cont(abs(l_extendedprice), 0.95) FROM lineitem)""",
       r="l_extendedprice", i="l_linenumber", covers="B19")
def _(t):
    return reshape.cut_outliers(t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"), "l_extendedprice", 0.05, 0.95)


@query("jittered_points", covers="B20")
def _(t):
    return reshape.jitter(t.points.select("event_id", "lon", "lat"), ["lon", "lat"], 1e-4, 11)


@query("price_bins", """
    SELECT label, count(*) AS n FROM (SELECT CASE WHEN l_discount <= 0.02 THEN '(-10, 0.02]' WHEN l_discount <= 0.05 THEN '(0.02, 0.05]' WHEN l_discount <= 0.08 THEN '(0.05, 0.08]' ELSE '(-10, 0.02]' END AS label FROM lineitem) GROUP BY 1""", covers="B21")
def _(t):
    from wayflux.plans.alerts import coloured

    return coloured(t.raw("lineitem"), "l_discount", [0.02, 0.05, 0.08], "label").groupBy("label").agg(F.count("*").alias("n"))


@query("flows_scaled", "SELECT date_time, start_poly_id, end_poly_id, movement * 0.7 AS movement FROM movement", d="date_time", r="movement", covers="B22")
def _(t):
    return t.movement.withColumn("movement", F.col("movement") * 0.7)


@query("quality_contacts", """
    SELECT date, hour, count(*) AS n, sum(min_distance) AS d FROM good_contacts GROUP BY 1, 2""", d="date", covers="B23")
def _(t):
    return t.good_contacts.groupBy("date", "hour").agg(F.count("*").alias("n"), F.sum("min_distance").alias("d"))


@query("infected_distance_slice", "SELECT identifier, date, attribute_value FROM distances WHERE date BETWEEN DATE '2024-01-04' AND DATE '2024-01-22'", d="date", covers="B23")
def _(t):
    return reshape.attribute_between(t.distances_to_infected, "distance_to_infected", "2024-01-04", "2024-01-22").select("identifier", "date", "attribute_value")


@query("stacked_layers", f"""
    SELECT 'USE ' || c_custkey AS label, {TITLE.format('c_mktsegment')} AS name, 'land' AS kind FROM customer
    UNION ALL SELECT 'STATION ' || s_suppkey, s_name, 'station' FROM supplier""", covers="B24")
def _(t):
    a = t.raw("customer").select(F.format_string("USE %d", "c_custkey").alias("label"), text.title_case(F.col("c_mktsegment")).alias("name"), F.lit("land").alias("kind"))
    b = t.raw("supplier").select(F.format_string("STATION %d", "s_suppkey").alias("label"), F.col("s_name").alias("name"), F.lit("station").alias("kind"))
    return reshape.stack([a, b])


@query("country_slice", "SELECT c_custkey, c_name FROM customer WHERE upper(c_mktsegment) = 'MACHINERY'", covers="B25")
def _(t):
    return reshape.country_slice(t.raw("customer"), "c_mktsegment", "Machinery").select("c_custkey", "c_name")


@query("method_labels", """
    SELECT m AS method, CASE m WHEN 'radial' THEN 'Radiales' WHEN 'geometry' THEN 'Administrativas' ELSE 'Funcionales' END AS label, count(*) AS n
    FROM (SELECT CASE c_custkey % 3 WHEN 0 THEN 'radial' WHEN 1 THEN 'geometry' ELSE 'community' END AS m FROM customer) GROUP BY 1, 2""", covers="B26")
def _(t):
    k = F.col("c_custkey") % 3
    m = t.raw("customer").select(F.when(k == 0, "radial").when(k == 1, "geometry").otherwise("community").alias("method"))
    return m.withColumn("label", text.method_label(F.col("method"), plural=True)).groupBy("method", "label").agg(F.count("*").alias("n"))


@query("flows_sorted", "SELECT start_poly_id, end_poly_id, sum(movement) AS movement FROM movement GROUP BY 1, 2", covers="F1")
def _(t):
    return t.movement.groupBy("start_poly_id", "end_poly_id").agg(F.sum("movement").alias("movement")).orderBy(F.col("movement").desc(), "start_poly_id", "end_poly_id")


@query("first_ten_flows", "SELECT start_poly_id, end_poly_id, sum(movement) AS movement FROM movement GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10", covers="F2")
def _(t):
    df = t.movement.groupBy("start_poly_id", "end_poly_id").agg(F.sum("movement").alias("movement"))
    return ranking.first_k(df.orderBy(F.col("movement").desc(), "start_poly_id", "end_poly_id"), 10)


@query("top_brands_and_others", """
    WITH top AS (SELECT p_brand FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY sum(l_quantity) DESC, p_brand LIMIT 5)
    SELECT CASE WHEN p_brand IN (SELECT p_brand FROM top) THEN p_brand ELSE 'Otros' END AS p_brand, l_returnflag, sum(l_quantity) AS l_quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""", covers="F3")
def _(t):
    p = t.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    df = t.raw("lineitem").select("l_partkey", "l_returnflag", "l_quantity").join(p, "l_partkey")
    return ranking.top_or_other(df, "p_brand", "l_quantity", ["l_returnflag"], 5)


@query("rows_of_frequent_users", """
    SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 10)""", covers="F4")
def _(t):
    return ranking.most_frequent(t.raw("events").select("event_id", "user_id"), "user_id", 10)


@query("ten_largest_incidences", """
    SELECT poly_id, poly_name, 100 * n / attr_population AS incidence FROM polygons JOIN (SELECT poly_id, sum(num_cases) AS n FROM cases GROUP BY 1) USING (poly_id)
    ORDER BY 3 DESC, poly_id LIMIT 10""", r="incidence", covers="F5 D29")
def _(t):
    from wayflux.operators.aggregates import scaled_incidence

    n = t.polygons.join(t.cases.groupBy("poly_id").agg(F.sum("num_cases").alias("n")), "poly_id")
    return ranking.top_rows(scaled_incidence(n, "n", "attr_population"), "incidence", ["poly_id"], 10).select("poly_id", "poly_name", "incidence")


@query("areas_above_cutoffs", """
    WITH m AS (SELECT poly_id, avg(num_cases) AS mean_cases, max(num_cases) AS max_cases FROM cases GROUP BY 1)
    SELECT poly_id, measure, value, poly_name FROM (SELECT poly_id, 'mean_cases' AS measure, mean_cases AS value FROM m WHERE mean_cases > 1
        UNION ALL SELECT poly_id, 'max_cases', max_cases FROM m WHERE max_cases > 2) JOIN community_map USING (poly_id)""", r="value", covers="F6")
def _(t):
    from wayflux.plans.alerts import highlights

    m = t.cases.groupBy("poly_id").agg(F.avg("num_cases").alias("mean_cases"), F.max("num_cases").alias("max_cases"))
    return highlights(m, t.community_map.select("poly_id", "poly_name"), {"mean_cases": 1.0, "max_cases": 2.0})


@query("users_in_both_kinds", "SELECT user_id FROM events WHERE event_type = 'click' INTERSECT SELECT user_id FROM events WHERE event_type = 'signup'", covers="G3")
def _(t):
    e = t.raw("events")
    return e.filter("event_type = 'click'").select("user_id").intersect(e.filter("event_type = 'signup'").select("user_id"))


@query("orders_not_yet_shipped", "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem", covers="G4")
def _(t):
    done = t.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.raw("orders").select("o_orderkey").join(done, "o_orderkey", "left_anti")


@query("path_rows", """
    SELECT start_poly_id AS node_id, 0 AS seq, start_poly_id AS start, end_poly_id AS end, movement FROM (SELECT start_poly_id, end_poly_id, sum(movement) AS movement FROM movement GROUP BY 1, 2)
    UNION ALL SELECT end_poly_id, 1, start_poly_id, end_poly_id, movement FROM (SELECT start_poly_id, end_poly_id, sum(movement) AS movement FROM movement GROUP BY 1, 2)""", i="seq", covers="G5")
def _(t):
    e = t.movement.groupBy("start_poly_id", "end_poly_id").agg(F.sum("movement").alias("movement"))
    return reshape.path_rows(e, "start_poly_id", "end_poly_id", ["movement"])


@query("date_parts", """
    SELECT event_id, CAST(ts + INTERVAL 12 HOUR AS DATE) AS rounded, strftime(date_trunc('day', ts) + to_hours(CAST(hour(ts) // 8 * 8 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS slot,
           least(day(ts) // 7 + 1, 4) AS week_of_month, isodow(ts) >= 5 AS weekend, CAST(date_trunc('week', ts) AS DATE) + 6 AS week_end FROM events""",
       d="rounded week_end", i="week_of_month weekend", covers="H4")
def _(t):
    ts = F.col("ts")
    return t.raw("events").select(
        "event_id", dates.round_to_day(ts).alias("rounded"), dates.slot_of_day(ts).alias("slot"), dates.week_of_month(ts).alias("week_of_month"),
        dates.is_weekend(ts).alias("weekend"), dates.week_end(ts).alias("week_end"),
    )


@query("scalar_math", """
    SELECT event_id, exp(-value) AS e, ln(value) AS l, sqrt(value) AS s, floor(value) AS f, ceil(value) AS c, least(greatest(value, 5), 50) AS clipped,
           coalesce(ln(1 + exp(-value / 1200)) / ln(2e0), 0) AS weight FROM events""", r="e l s f c clipped weight", covers="H6 H7")
def _(t):
    v = F.col("value")
    return t.raw("events").select(
        "event_id", F.exp(-v).alias("e"), F.log(v).alias("l"), F.sqrt(v).alias("s"), F.floor(v).cast("double").alias("f"), F.ceil(v).cast("double").alias("c"),
        F.least(F.greatest(v, F.lit(5.0)), F.lit(50.0)).alias("clipped"), vectors.softplus_weight(v).alias("weight"),
    )


@query("vector_text", """
    SELECT vec_id, len(embedding) AS n, list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS last_sum, CAST(embedding[len(embedding)] AS DOUBLE) AS last, len(embedding) + 3 AS padded FROM embeddings""",
       r="last_sum last", covers="H8")
def _(t):
    v = vectors.parse_vector(vectors.format_vector(F.col("embedding").cast("array<double>")))
    return t.raw("embeddings").select("vec_id", v.alias("v")).select(
        "vec_id", F.size("v").cast("bigint").alias("n"), F.element_at(vectors.running_sum(F.col("v")), -1).alias("last_sum"),
        F.reverse("v")[0].alias("last"), F.size(vectors.pad_with(F.col("v"), F.size("v") + 3)).cast("bigint").alias("padded"),
    )
