"""Sources, sinks, audits."""

import hashlib
import os

from pyspark.sql import functions as F

from wayflux import schema
from wayflux.catalog.base import query
from wayflux.operators import reshape
from wayflux.session import shared_folder
from wayflux.sources import files


def _folder(t, name: str) -> str:
    """Folder for a written stage table, next to the checkpoints of the session."""
    tag = hashlib.md5(f"{t.root}{name}".encode()).hexdigest()[:10]
    return f"{shared_folder(t.spark)}/wayflux-{tag}-{os.getpid()}-{name}"


@query("flows_through_csv", "SELECT * FROM movement", d="date_time", covers="A1 A13")
def _(t):
    path = _folder(t, "movement_csv")
    t.movement.write.mode("overwrite").option("header", True).csv(path)
    return files.scan_csv(t.spark, path, schema.MOVEMENT)


@query("tile_directory", """
    SELECT date_time, count(*) AS n, sum(n_crisis) AS n_crisis FROM tiles WHERE n_crisis IS NOT NULL GROUP BY 1""".replace("date_time, count", "strftime(date_time, '%Y-%m-%d %H:%M:%S') AS date_time, count"),
    r="n_crisis", covers="A2 A4 A13")
def _(t):
    path = _folder(t, "tile_parts")
    t.tiles.withColumn("date_time", F.date_format("date_time", "yyyy-MM-dd HHmm")).write.mode("overwrite").option("header", True).csv(path)
    df = files.scan_csv(t.spark, path, "geometry STRING, date_time STRING, n_crisis DOUBLE", drop_null=True)
    ts = F.try_to_timestamp("date_time", F.lit("yyyy-MM-dd HHmm")).cast("timestamp_ntz")
    return df.groupBy(ts.alias("date_time")).agg(F.count("*").alias("n"), F.sum("n_crisis").alias("n_crisis"))


@query("tiles_ingested", """
    SELECT max(date_time) AS last, count(*) AS n, sum(start_movement_lon) AS lon, sum(end_movement_lat) AS lat, sum(n_crisis) AS n_crisis
    FROM tiles WHERE date_time < (SELECT max(date_time) FROM tiles)""".replace("max(date_time) AS last", "strftime(max(date_time), '%Y-%m-%d %H:%M:%S') AS last"),
    r="lon lat n_crisis", covers="A3 B5 B8")
def _(t):
    path = _folder(t, "raw_tiles")
    cols = [c.strip().split(" ") for c in schema.MOVEMENT_TILES.split(",")]
    src = t.tiles.withColumn("date_time", F.date_format("date_time", "yyyy-MM-dd HHmm"))
    full = src.select(*[F.col(n) if n in src.columns else F.lit("1").alias(n) for n, _ in cols])
    full.write.mode("overwrite").option("header", True).csv(path + "/good")
    src.write.mode("overwrite").option("header", True).csv(path + "/bad")  # other columns: must be left out
    last = t.tiles.agg(F.max("date_time").cast("string")).first()[0]
    ok = files.ingest_tiles(t.spark, [path + "/good", path + "/bad"], last)
    return ok.agg(
        F.max("date_time").alias("last"), F.count("*").alias("n"), F.sum("start_movement_lon").alias("lon"),
        F.sum("end_movement_lat").alias("lat"), F.sum("n_crisis").alias("n_crisis"),
    )


def _tiles_by_weekday(t):
    """A folder with a file of tiles per weekday; in Monday's, some rows have a letter for a number."""
    path = _folder(t, "weekday_tiles")
    cols = [c.strip().split(" ") for c in schema.MOVEMENT_TILES.split(",")]
    src = t.tiles.withColumn("weekday", F.dayofweek("date_time"))
    broken = (F.col("weekday") == 2) & (F.col("n_crisis") > 50)
    src = src.withColumn("n_crisis", F.when(broken, F.lit("x")).otherwise(F.col("n_crisis").cast("string"))).withColumn("date_time", F.date_format("date_time", "yyyy-MM-dd HHmm"))
    dealt = src.repartition("weekday")
    full = dealt.select(*[F.col(n) if n in src.columns else F.lit("1").alias(n) for n, _ in cols], "weekday")
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    prev = t.spark.conf.get(writers)
    t.spark.conf.set(writers, "7")  # a file open per weekday, instead of a sort of all rows
    try:
        full.write.mode("overwrite").option("header", True).partitionBy("weekday").csv(path)
    finally:
        t.spark.conf.set(writers, prev)
    return [f"{path}/weekday={k}" for k in range(1, 8)]


@query("tiles_without_bad_files", """
    SELECT dayofweek(date_time) + 1 AS weekday, count(*) AS n, sum(n_crisis) AS n_crisis FROM tiles WHERE dayofweek(date_time) <> 1 GROUP BY 1""", r="n_crisis", i="weekday", covers="A3")
def _(t):
    ok, _ = files.checked_tiles(t.spark, _tiles_by_weekday(t))
    return ok.groupBy(F.dayofweek("date_time").alias("weekday")).agg(F.count("*").alias("n"), F.sum("n_crisis").alias("n_crisis"))


@query("rejected_tile_files", """
    SELECT 'rows' AS reason, 2 AS weekday, count(*) AS bad_rows FROM tiles WHERE dayofweek(date_time) = 1 AND n_crisis > 50""", i="weekday", covers="A3")
def _(t):
    _, rejected = files.checked_tiles(t.spark, _tiles_by_weekday(t))
    return rejected.select("reason", F.regexp_extract("file", "weekday=([0-9])", 1).cast("int").alias("weekday"), "bad_rows")


@query("mixed_encodings_read_back", "SELECT lang || 'é' AS lang, count(*) AS n FROM documents GROUP BY 1", covers="A8")
def _(t):
    """One folder with a file in latin-1 and one in UTF-8, no encoding given."""
    path = _folder(t, "mixed")
    named = t.raw("documents").select("doc_id", F.concat("lang", F.lit("é")).alias("lang"))
    for k, encoding in enumerate(("ISO-8859-1", "UTF-8")):
        named.filter(F.col("doc_id") % 2 == k).write.mode("overwrite").option("header", True).option("encoding", encoding).csv(f"{path}/{k}")
    return files.decoded_csv(t.spark, [f"{path}/0", f"{path}/1"], "doc_id BIGINT, lang STRING").groupBy("lang").agg(F.count("*").alias("n"))


@query("population_tiles", """
    SELECT CAST(ts AS DATE) AS ds, round(lat, 2) AS lat, round(lon, 2) AS lon, count(DISTINCT user_id) AS n FROM points GROUP BY 1, 2, 3""", d="ds", r="lat lon", covers="A5")
def _(t):
    """People per rounded place and day, stacked under the empty population contract."""
    p = t.points.groupBy(F.col("ts").cast("date").alias("ds"), F.round("lat", 2).alias("lat"), F.round("lon", 2).alias("lon")).agg(
        F.count_distinct("user_id").cast("double").alias("n_crisis")
    )
    return files.empty_population(t.spark).unionByName(p, allowMissingColumns=True).select("ds", "lat", "lon", F.col("n_crisis").cast("bigint").alias("n"))


@query("movement_range_table", "SELECT ds, external_polygon_id, change AS all_day_bing_tiles_visited_relative_change FROM movement_range",
       d="ds", r="all_day_bing_tiles_visited_relative_change", covers="A6")
def _(t):
    return files.movement_range_table(t.movement_range)


@query("names_with_separator", """
    SELECT n_nationkey AS k, n_name || ' D.C.' AS place, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""", i="k", covers="A7")
def _(t):
    """Text lines whose place name holds the separator are cleaned before they are parsed."""
    c = t.raw("customer").join(t.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    lines = c.select(F.concat_ws(",", "n_nationkey", F.concat("n_name", F.lit(", D.C.")), "c_custkey").alias("value"))
    clean = lines.withColumn("value", F.replace("value", F.lit(", D.C."), F.lit(" D.C.")))
    return files.parse_lines(clean, "k INT, place STRING, c BIGINT").groupBy("k", "place").agg(F.count("*").alias("n"))


@query("latin_text_read_back", "SELECT lang, count(*) AS n FROM documents GROUP BY 1", covers="A8")
def _(t):
    """Sources written and read as latin-1."""
    path = _folder(t, "latin")
    t.raw("documents").select("doc_id", F.concat("lang", F.lit("é")).alias("lang")).write.mode("overwrite").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    df = files.scan_csv(t.spark, path, "doc_id BIGINT, lang STRING", encoding="ISO-8859-1")
    return df.filter(F.col("lang").endswith("é")).groupBy(F.replace("lang", F.lit("é"), F.lit("")).alias("lang")).agg(F.count("*").alias("n"))


@query("lenient_order_dates", """
    SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders WHERE day(o_orderdate) <> 13 GROUP BY 1""", d="day", covers="A9 B8")
def _(t):
    """Day-first text dates; an unreadable one (month 13) turns to null and drops out."""
    d = F.col("o_orderdate")
    txt = F.when(F.dayofmonth(d) == 13, F.date_format(d, "'31/13/'yyyy")).otherwise(F.date_format(d, "dd/MM/yyyy"))
    return files.parse_dates(t.raw("orders").select(txt.alias("day")), "day", "dd/MM/yyyy").groupBy("day").agg(F.count("*").alias("n"))


@query("protected_columns_restored", "SELECT c_custkey, c_name, c_mktsegment, true AS hidden FROM customer", i="hidden", covers="A12")
def _(t):
    key = "0123456789abcdef"
    closed = files.encrypt_columns(t.raw("customer").select("c_custkey", "c_name", F.col("c_name").alias("plain"), "c_mktsegment"), ["c_name", "c_mktsegment"], key)
    return files.decrypt_columns(closed.withColumn("hidden", F.col("c_name") != F.col("plain")).drop("plain"), ["c_name", "c_mktsegment"], key)


@query("table_freshness", """
    SELECT 'cases' AS table_name, min(date_time) AS first_date, max(date_time) AS last_date FROM cases
    UNION ALL SELECT 'movement', min(date_time), max(date_time) FROM movement
    UNION ALL SELECT 'tiles', CAST(min(date_time) AS DATE), CAST(max(date_time) AS DATE) FROM tiles""", d="first_date last_date", covers="A14")
def _(t):
    return files.freshness({"cases": (t.cases, "date_time"), "movement": (t.movement, "date_time"), "tiles": (t.tiles, "date_time")})


@query("missing_slots_per_type", """
    SELECT strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot FROM (
        SELECT unnest(generate_series((SELECT CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) FROM events), (SELECT CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) + INTERVAL 16 HOUR FROM events), INTERVAL 8 HOUR)) AS slot)
    WHERE slot NOT IN (SELECT date_time FROM tiles WHERE n_crisis > 95 AND hour(date_time) < 16)""", covers="A15")
def _(t):
    heavy = t.tiles.filter((F.col("n_crisis") > 95) & (F.hour("date_time") < 16))
    span = t.raw("events").agg(F.min(F.col("ts").cast("date")).cast("string"), F.max(F.col("ts").cast("date")).cast("string")).first()
    return files.missing_slots(heavy, "date_time", span[0], span[1])


@query("nation_names_from_map", "SELECT CAST(n_nationkey AS VARCHAR) AS geo_id, n_name AS name, r_name AS state, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2, 3", covers="A17")
def _(t):
    """One map-shaped JSON text per nation, exploded to rows, then counted by customers."""
    n = t.raw("nation").join(t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    js = n.select(F.to_json(F.create_map(F.col("n_nationkey").cast("string"), F.struct(F.col("n_name").alias("name"), F.col("r_name").alias("state")))).alias("j"))
    rows = files.map_rows(js, "j", "geo_id", "struct<name:string,state:string>")
    return rows.join(t.raw("customer"), F.col("c_nationkey").cast("string") == F.col("geo_id")).groupBy("geo_id", "name", "state").agg(F.count("*").alias("n"))


@query("history_resumed", "SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS n FROM events GROUP BY 1, 2", d="date", covers="A18")
def _(t):
    daily = t.raw("events").groupBy(F.col("ts").cast("date").alias("date"), "event_type").agg(F.count("*").alias("n"))
    mid = daily.agg(F.min("date").alias("a"), F.max("date").alias("b")).select(F.date_add("a", (F.datediff("b", "a") / 2).cast("int")).alias("mid"))
    history = daily.join(mid, F.col("date") <= F.col("mid")).drop("mid")
    return files.resume_after(history, daily)


@query("locations_merged", "SELECT poly_id, date_time, num_cases FROM cases", d="date_time", covers="A19 G1 G2")
def _(t):
    c = t.cases.select("poly_id", "date_time", "num_cases")
    return files.merge_locations([c, c.filter("num_cases > 1")])


@query("last_flow_day_per_method", """
    SELECT 'geometry' AS agglomeration, max(date_time) AS last_date FROM movement""", d="last_date", covers="A20 A21")
def _(t):
    """The radial table is absent, so its stand-in answers."""
    known = t.movement.withColumn("agglomeration", F.lit("geometry")).withColumn("location", F.lit("here"))
    picked = files.choose_variant(known, "radial")
    return files.last_covered_date(picked, "agglomeration", "geometry", "date_time").select(F.lit("geometry").alias("agglomeration"), "last_date")


@query("schema_changes", """
    SELECT * FROM (VALUES ('l_extra', NULL, 'string', 'added'), ('l_quantity', 'double', 'int', 'changed'), ('l_tax', 'double', NULL, 'removed')) v(column_name, old_type, new_type, change)
    WHERE (SELECT count(*) FROM lineitem) > 0""", covers="A16")
def _(t):
    old = t.raw("lineitem")
    new = old.drop("l_tax").withColumn("l_extra", F.lit("x")).withColumn("l_quantity", F.col("l_quantity").cast("int"))
    return files.schema_drift(old, new)


@query("selected_area_cases", "SELECT * FROM cases WHERE poly_id IN (SELECT poly_id FROM community_map WHERE community_name = 'ASIA')", d="date_time", covers="B9 M4 A10")
def _(t):
    return reshape.only_ids(t.cases, "poly_id", t.community_map.filter("community_name = 'ASIA'").select("poly_id"))
