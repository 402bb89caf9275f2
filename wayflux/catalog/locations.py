"""Location adapters fed with raw tables of their own shape, derived from the supplied ones."""

from pyspark.sql import functions as F

from wayflux.catalog.base import query
from wayflux.catalog.reshaping import WIDE, YEARS, wide_cumulative
from wayflux.operators import rules, windows
from wayflux.sources.adapters import adapter


def _places(t):
    return t.polygons.select(F.col("poly_id").alias("geo_id"), F.col("poly_lon").alias("lon"), F.col("poly_lat").alias("lat"), F.col("poly_name").alias("location"))


def _raw_cases(t):
    """Case list with dates and a care text."""
    o = t.case_list
    care = F.when(F.col("o_orderpriority") == "1-URGENT", "Hospital UCI").when(F.col("o_orderpriority") == "2-HIGH", "Hospital").when(F.col("o_orderstatus") == "F", "Fallecido").when(F.col("o_orderstatus") == "O", "Recuperado").otherwise("Casa")
    return o.select("o_orderkey", F.col("poly_id").alias("geo_id"), F.col("date_time").alias("diagnosis"), care.alias("attention"), "o_orderstatus", "o_orderpriority")


@query("bogota_cases", """
    WITH r AS (SELECT date_time, poly_id AS geo_id, CASE WHEN o_orderstatus = 'F' THEN 'Fallecido' WHEN o_orderstatus = 'O' THEN 'Recuperado' ELSE 'Infectado' END AS st, o_orderpriority AS p FROM case_list WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW'))
    SELECT date_time, geo_id, poly_name AS location, poly_lon AS lon, poly_lat AS lat, CAST(count(*) AS DOUBLE) AS num_cases, CAST(count(*) FILTER (WHERE st = 'Recuperado') AS DOUBLE) AS num_recovered, CAST(count(*) FILTER (WHERE st = 'Fallecido') AS DOUBLE) AS num_diseased,
           CAST(count(*) FILTER (WHERE st = 'Infectado') AS DOUBLE) AS num_infected, CAST(count(*) FILTER (WHERE st = 'Infectado' AND p IN ('1-URGENT', '2-HIGH')) AS DOUBLE) AS num_infected_in_hospital,
           CAST(count(*) FILTER (WHERE st = 'Infectado' AND p NOT IN ('1-URGENT', '2-HIGH')) AS DOUBLE) AS num_infected_in_house, CAST(count(*) FILTER (WHERE st = 'Infectado' AND p = '1-URGENT') AS DOUBLE) AS num_infected_in_icu
    FROM r JOIN polygons ON poly_id = geo_id GROUP BY 1, 2, 3, 4, 5""", d="date_time", covers="N1 B6 B7 A12")
def _(t):
    c = t.case_list.withColumnRenamed("poly_id", "geo_id").join(_places(t), "geo_id")
    st = F.when(F.col("o_orderstatus") == "F", "Falle cido").when(F.col("o_orderstatus") == "O", "Recuperado").when(F.col("o_orderpriority") == "5-LOW", "Otro").when(F.col("o_orderpriority") == "2-HIGH", " ")
    care = F.when(F.col("o_orderpriority") == "1-URGENT", "Hospital UCI").when(F.col("o_orderpriority") == "2-HIGH", "Hospital").otherwise("Casa")
    comma = lambda c: F.replace(F.col(c).cast("string"), F.lit("."), F.lit(","))
    raw = c.select("date_time", "geo_id", "location", comma("lon").alias("lon"), comma("lat").alias("lat"), st.alias("status"), care.alias("care"))
    return adapter("bogota").cases(raw)


@query("bogota_blocks", "SELECT p_brand AS poly_id, 'Manzana ' || p_brand AS poly_name, p_retailprice AS attr_area, p_name AS geometry FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) = 1", r="attr_area", covers="N1 B12")
def _(t):
    raw = t.raw("part").select(F.col("p_brand").alias("code"), F.col("p_retailprice").alias("shape_area"), F.col("p_partkey").alias("shape_id"), F.col("p_name").alias("geometry"))
    return adapter("bogota").blocks(raw)


@query("brazil_cases", """
    SELECT CAST(1000 + n_nationkey * 50 AS VARCHAR) AS geo_id, date_time, num_cases, n_name AS location, poly_lon AS lon, poly_lat AS lat FROM cases JOIN polygons USING (poly_id) JOIN nation ON CAST(n_nationkey AS VARCHAR) = poly_id WHERE num_cases > 0 AND n_nationkey <> 3""", d="date_time", covers="N2 M1 C1 B2")
def _(t):
    code = F.when(F.col("poly_id") == "3", F.lit("3")).otherwise((1000 + F.col("poly_id").cast("int") * 50).cast("string"))
    raw = t.cases.select("date_time", code.alias("geo_id"), "num_cases")
    places = t.polygons.select(code.alias("geo_id"), F.concat(F.substring_index("poly_name", "-", 1), F.lit("/XX")).alias("location"), F.col("poly_lon").alias("lon"), F.col("poly_lat").alias("lat"))
    return adapter("brazil").cases(raw, places=places)


def _cumulative(t):
    c = t.cases.select(F.col("poly_id").alias("geo_id"), "date_time", "num_cases")
    return windows.accumulate(c, ["geo_id"], "date_time", "num_cases", "total").select("geo_id", "date_time", F.col("total").alias("num_cases"))


@query("chile_cases", "SELECT date_time, poly_id AS geo_id, poly_name AS location, poly_lon AS lon, poly_lat AS lat, num_cases FROM cases JOIN polygons USING (poly_id)", d="date_time", covers="N3 E8 E7 C1")
def _(t):
    """Cumulative counts that never fall: the repair must leave them alone."""
    return adapter("chile").cases(_cumulative(t), places=_places(t))


@query("chile_missing_places", "SELECT DISTINCT poly_id AS geo_id FROM cases WHERE poly_id NOT IN (SELECT poly_id FROM polygons WHERE attr_area > 3)", covers="N3 C5")
def _(t):
    known = t.polygons.filter("attr_area > 3").select(F.col("poly_id").alias("geo_id"))
    return adapter("chile").missing(_cumulative(t), known, ["geo_id"])


@query("colombia_cases", """
    WITH r AS (SELECT date_time, poly_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'U' WHEN o_orderpriority = '2-HIGH' THEN 'H' WHEN o_orderstatus = 'F' THEN 'F' WHEN o_orderstatus = 'O' THEN 'R' ELSE 'C' END AS a FROM case_list)
    SELECT date_time, poly_id AS geo_id, poly_name AS location, poly_lon AS lon, poly_lat AS lat, CAST(count(*) AS DOUBLE) AS num_cases, CAST(count(*) FILTER (WHERE a = 'F') AS DOUBLE) AS num_diseased, CAST(count(*) FILTER (WHERE a = 'R') AS DOUBLE) AS num_recovered,
           CAST(count(*) FILTER (WHERE a IN ('U', 'H', 'C')) AS DOUBLE) AS num_infected, CAST(count(*) FILTER (WHERE a IN ('U', 'H')) AS DOUBLE) AS num_infected_in_hospital, CAST(count(*) FILTER (WHERE a = 'C') AS DOUBLE) AS num_infected_in_house
    FROM r JOIN polygons USING (poly_id) GROUP BY 1, 2, 3, 4, 5""", d="date_time", covers="N4 C3 B7")
def _(t):
    a = adapter("colombia")
    return a.cases(_raw_cases(t), areas=a.centres(t.polygons))


@query("colombia_delay_curves", covers="N4 D8 B11")
def _(t):
    o = t.case_list.select(F.col("o_orderkey").alias("l_orderkey"), F.col("poly_id").alias("geo_id"), F.col("date_time").alias("onset"))
    raw = t.raw("lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").alias("death")).join(o, "l_orderkey").withColumn("diagnosis", F.date_add("onset", F.pmod("l_orderkey", F.lit(41)).cast("int")))
    out = adapter("colombia").delay_vectors(raw)
    return out.select("geo_id", F.posexplode("attr_time_delay").alias("i", "p"))


@query("colombia_scheme", "SELECT community_id, sum(attr_area) AS attr_area, arg_max(poly_name, (attr_population, poly_name)) AS poly_name FROM polygons JOIN (SELECT poly_id, community_id FROM community_map) USING (poly_id) GROUP BY 1", covers="N4 M2")
def _(t):
    df = t.polygons.join(t.community_map.select("poly_id", "community_id"), "poly_id")
    return rules.agglomerate(df, adapter("colombia").scheme(), ["community_id"], ["attr_area", "poly_name"])


def _germany_raw(t):
    """One column per nation with running totals; a day without news repeats the last total."""
    c = _cumulative(t)
    days = c.agg(F.min("date_time").alias("a"), F.max("date_time").alias("b")).select(F.explode(F.sequence("a", "b")).alias("date_time"))
    from pyspark.sql import Window as W

    ids = sorted(r["poly_id"] for r in t.polygons.select("poly_id").distinct().collect())  # the columns of a wide table
    wide = c.groupBy("date_time").pivot("geo_id", ids).agg(F.max("num_cases"))
    w = W.orderBy("date_time").rowsBetween(W.unboundedPreceding, 0)  # one row per day
    full = days.join(wide, "date_time", "left")
    return full.select(F.col("date_time").cast("timestamp_ntz").alias("date_time"), *[F.coalesce(F.last(i, True).over(w), F.lit(0.0)).alias(i) for i in ids])


@query("germany_cases", "SELECT date_time, poly_id AS geo_id, poly_name AS location, poly_lon AS lon, poly_lat AS lat, num_cases FROM cases JOIN polygons USING (poly_id)", d="date_time", covers="N5 B13 E8 E7")
def _(t):
    return adapter("germany").cases(_germany_raw(t), places=_places(t))


@query("germany_names", "SELECT c_custkey AS geo_id, trim(replace(c_name, 'LK ', '')) AS geo_name FROM customer", covers="N5 A17 B2")
def _(t):
    reg = t.raw("customer").select(F.col("c_custkey").alias("geo_id"), F.concat(F.lit("LK "), "c_name").alias("name"))
    return adapter("germany").names(reg)


@query("mexico_cases", f"""
    SELECT y AS date_time, geo_id, poly_name AS location, poly_lon AS lon, poly_lat AS lat, v AS num_cases FROM (SELECT geo_id, unnest([{", ".join(f"'{y}'" for y in YEARS)}]) AS y, unnest([{", ".join(f"y{y}" for y in YEARS)}]) AS v FROM ({WIDE}))
    JOIN polygons ON poly_id = CAST(geo_id AS VARCHAR)""", i="geo_id", covers="N6 B13 C2")
def _(t):
    return adapter("mexico").cases(wide_cumulative(t), places=_places(t))


@query("new_south_wales_cases", """
    SELECT date_time, substr(c, 1, 3) || '-' || length(c) || '-' || right(c, 1) AS geo_id, c AS location, poly_lon AS lon, poly_lat AS lat, num_cases
    FROM (SELECT *, split_part(poly_name, '-', 1) AS c FROM polygons) JOIN (SELECT date_time, poly_id AS pid, sum(num_cases) AS num_cases FROM cases GROUP BY 1, 2) ON pid = poly_id
    QUALIFY true""".replace("QUALIFY true", "").replace("substr(c, 1, 3) || '-' || length(c) || '-' || right(c, 1)", "poly_id"), d="date_time", covers="N7 B2 B4")
def _(t):
    """Names carry council marks; ids are made of the name, made unique by the area key."""
    name = F.concat(F.substring_index("poly_name", "-", 1), F.lit(" (A)"))
    raw = t.case_list.join(t.polygons.select("poly_id", name.alias("geo_name")), "poly_id").select("date_time", "geo_name", "poly_id")
    a = adapter("new_south_wales")
    daily = a.daily(raw)
    names = t.polygons.select(F.substring_index("poly_name", "-", 1).alias("geo_name"), "poly_id", F.col("poly_lon").alias("lon"), F.col("poly_lat").alias("lat"))
    places = names.select(F.col("poly_id").alias("geo_id"), "lon", "lat", F.col("geo_name").alias("location"))
    from wayflux.operators.joins import locate_cases

    keyed = daily.join(names.select("geo_name", "poly_id"), "geo_name").select("date_time", F.col("poly_id").alias("geo_id"), "num_cases")
    return locate_cases(keyed, places)


@query("peru_cases", """
    SELECT date_time, upper(r_name) || '-' || upper(n_name) AS geo_id, n_name AS location, poly_lon AS lon, poly_lat AS lat, num_cases
    FROM cases JOIN polygons USING (poly_id) JOIN nation ON CAST(n_nationkey AS VARCHAR) = poly_id JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 7""", d="date_time", covers="N8 A9 B4")
def _(t):
    parts = t.polygons.select("poly_id", F.substring_index("poly_name", "-", -1).alias("departement"), F.substring_index("poly_name", "-", 1).alias("n"), "poly_lon", "poly_lat")
    province = F.when(F.col("poly_id") == "7", "EN INVESTIGACIÓN").otherwise(F.col("n"))
    raw = t.case_list.join(parts, "poly_id").select(F.date_format("date_time", "yyyyMMdd").alias("date_time"), "departement", province.alias("province"))
    places = parts.select(F.concat_ws("-", F.upper("departement"), F.upper("n")).alias("geo_id"), F.col("n").alias("location"), F.col("poly_lon").alias("lon"), F.col("poly_lat").alias("lat"))
    return adapter("peru").cases(raw, places=places)


@query("italy_cases", "SELECT poly_id AS geo_id, date_time, poly_name AS location, CASE WHEN poly_lon = -74 THEN NULL ELSE poly_lon END AS lon, poly_lat AS lat, num_cases FROM cases JOIN polygons USING (poly_id) WHERE poly_lon <> -74 AND poly_lon <> -73", d="date_time", covers="N9 E8 E7 A2")
def _(t):
    lon = F.when(F.col("lon") == -74.0, F.lit(None)).when(F.col("lon") == -73.0, 0.0).otherwise(F.col("lon"))
    raw = _cumulative(t).join(_places(t).withColumn("lon", lon), "geo_id")
    files = raw.withColumn("file_name", F.lit("province-20200224.csv")).unionByName(raw.withColumn("file_name", F.lit("province-latest.csv")))
    return adapter("italy").cases(files.select("geo_id", "date_time", "location", "lon", "lat", "num_cases", "file_name"))


@query("us_state_cases", f"""
    SELECT geo_id, poly_lat AS lat, poly_lon AS lon, poly_name AS location, y AS date_time, v AS num_cases FROM (SELECT geo_id, unnest([{", ".join(f"'{y}'" for y in YEARS)}]) AS y,
        unnest([y1995, {", ".join(f"y{b} - y{a}" for a, b in zip(YEARS, YEARS[1:]))}]) AS v FROM ({WIDE})) JOIN polygons ON poly_id = CAST(geo_id AS VARCHAR) JOIN community_map USING (poly_id) WHERE community_name = 'ASIA' AND v > 0""".replace("poly_name AS location", "polygons.poly_name AS location"), i="geo_id", covers="N10 B25 B13 E7")
def _(t):
    names = t.community_map.select(F.col("poly_id").cast("int").alias("geo_id"), F.col("community_name").alias("state"))
    p = _places(t).withColumn("geo_id", F.col("geo_id").cast("int"))
    return adapter("usa_state").cases(wide_cumulative(t).join(p, "geo_id").join(names, "geo_id"), state="Asia")


@query("global_series_cases", f"""
    WITH l AS (SELECT geo_id AS k, unnest([{", ".join(f"'{y}'" for y in YEARS)}]) AS date_time, unnest([y1995, {", ".join(f"y{b} - y{a}" for a, b in zip(YEARS, YEARS[1:]))}]) AS num_cases FROM ({WIDE}))
    SELECT CASE WHEN k % 2 = 0 THEN upper(n_name) ELSE 'EUROPE' END AS geo_id, CASE WHEN k % 2 = 0 THEN n_name ELSE 'EUROPE' END AS location, poly_lat AS lat, poly_lon AS lon, date_time, num_cases
    FROM l JOIN nation ON n_nationkey = k JOIN region ON n_regionkey = r_regionkey JOIN polygons ON poly_id = CAST(k AS VARCHAR) WHERE r_name = 'EUROPE'""", covers="N11 B4 B13 E7")
def _(t):
    p = t.polygons.select(
        F.col("poly_id").cast("int").alias("geo_id"), F.substring_index("poly_name", "-", 1).alias("n"), F.substring_index("poly_name", "-", -1).alias("country"),
        F.col("poly_lat").alias("lat"), F.col("poly_lon").alias("lon"),
    )
    raw = wide_cumulative(t).join(p, "geo_id").withColumn("province", F.when(F.col("geo_id") % 2 == 0, F.col("n"))).drop("geo_id", "n")
    return adapter("global_series").cases(raw, country="EUROPE")
