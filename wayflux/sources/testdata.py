"""Canonical tables derived from the supplied star-schema and event tables.

All derivations are row-wise expressions, equi-joins and groupings, so that they hold at
any size: the only rows that survive a shuffle are pruned to the columns needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DELAY_DAYS = 62


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def centre(key: Column) -> tuple[Column, Column]:
    lon = F.lit(-75.0) + F.lit(0.5) * (key % 5)
    lat = F.lit(4.0) + F.lit(0.5) * F.floor(key / 5)
    return lon.cast("double"), lat.cast("double")


def square_wkt(lon: Column, lat: Column, half: float) -> Column:
    def p(x, y):
        return F.concat(x.cast("string"), F.lit(" "), y.cast("string"))

    w, e, s, n = lon - half, lon + half, lat - half, lat + half
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", p(w, s), p(e, s), p(e, n), p(w, n), p(w, s)), F.lit("))"))


def polygons(spark: SparkSession, root: str) -> DataFrame:
    nation, region = table(spark, root, "nation"), table(spark, root, "region")
    people = (
        table(spark, root, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").cast("double").alias("attr_population"))
    )
    lon, lat = centre(F.col("n_nationkey"))
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey)
        .join(people, "n_nationkey", "left")
        .select(
            F.col("n_nationkey").cast("string").alias("poly_id"),
            F.concat_ws("-", "n_name", "r_name").alias("poly_name"),
            lon.alias("poly_lon"),
            lat.alias("poly_lat"),
            square_wkt(lon, lat, 0.25).alias("geometry"),
            F.coalesce("attr_population", F.lit(0.0)).alias("attr_population"),
            (1 + F.col("n_nationkey") % 7).cast("double").alias("attr_area"),
        )
    )


def community_map(spark: SparkSession, root: str) -> DataFrame:
    nation, region = table(spark, root, "nation"), table(spark, root, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("poly_id"),
        F.concat_ws("-", "n_name", "r_name").alias("poly_name"),
        F.col("r_regionkey").cast("string").alias("community_id"),
        F.col("r_name").alias("community_name"),
    )


def _customer_area(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("poly_id"))


def case_list(spark: SparkSession, root: str) -> DataFrame:
    """One row per case: order joined with the area of its customer."""
    o = table(spark, root, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.col("o_orderdate").cast("date").alias("date_time"),
    )
    return o.join(_customer_area(spark, root), "c_custkey")


def cases(spark: SparkSession, root: str) -> DataFrame:
    def flag(s):
        return F.sum(F.when(F.col("o_orderstatus") == s, 1.0).otherwise(0.0))

    return (
        case_list(spark, root)
        .groupBy("date_time", "poly_id")
        .agg(
            F.count("*").cast("double").alias("num_cases"),
            flag("F").alias("num_diseased"),
            flag("O").alias("num_recovered"),
            flag("P").alias("num_infected"),
        )
    )


def movement(spark: SparkSession, root: str) -> DataFrame:
    """Flows supplier area → customer area by shipping date."""
    o = table(spark, root, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    ends = o.join(_customer_area(spark, root), "c_custkey").select("l_orderkey", F.col("poly_id").alias("end_poly_id"))
    starts = table(spark, root, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("string").alias("start_poly_id")
    )
    li = table(spark, root, "lineitem").select(
        "l_orderkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("date_time"), "l_quantity"
    )
    return (
        li.join(ends, "l_orderkey")
        .join(starts, "l_suppkey")
        .groupBy("date_time", "start_poly_id", "end_poly_id")
        .agg(F.sum("l_quantity").alias("movement"))
    )


def user_point(user: Column) -> tuple[Column, Column]:
    """Fixed place of a user inside the tiling, never on a border."""
    lon = F.lit(-75.25) + ((user * 7919) % 99991 + F.lit(0.5)) * F.lit(2.5) / 99991
    lat = F.lit(3.75) + ((user * 104729) % 99989 + F.lit(0.5)) * F.lit(2.5) / 99989
    return lon, lat


def points(spark: SparkSession, root: str) -> DataFrame:
    """Located events: one row per event with its slot of the day."""
    lon, lat = user_point(F.col("user_id"))
    return table(spark, root, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", lon.alias("lon"), lat.alias("lat")
    )


def tiles(spark: SparkSession, root: str) -> DataFrame:
    """Tile flows: every event is a trip from its user's place to the place of a related user."""
    lon, lat = user_point(F.col("user_id"))
    other = F.col("user_id").bitwiseXOR(F.col("event_id") % 7 + 1)
    elon, elat = user_point(other)
    hours = (F.floor(F.hour("ts") / 8) * 8).cast("int")
    return table(spark, root, "events").select(
        F.concat(
            F.lit("LINESTRING ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(", "),
            elon.cast("string"), F.lit(" "), elat.cast("string"), F.lit(")"),
        ).alias("geometry"),
        (F.col("ts").cast("date").cast("timestamp_ntz") + F.make_dt_interval(hours=hours)).alias("date_time"),
        F.col("value").alias("n_crisis"),
    )


def contacts(spark: SparkSession, root: str) -> DataFrame:
    """Contact edges; places are user places rounded to three decimals."""
    lon, lat = user_point(F.col("user_id"))
    k = F.regexp_extract("props", r"([0-9]+)", 1).cast("bigint")
    return table(spark, root, "events").select(
        "event_id",
        F.col("user_id").alias("id1"),
        F.col("user_id").bitwiseXOR(F.col("event_id") % 7 + 1).alias("id2"),
        F.round(lat, 3).alias("lat"),
        F.round(lon, 3).alias("lon"),
        F.col("ts").cast("date").alias("date"),
        F.hour("ts").alias("hour"),
        (k % 8).cast("double").alias("min_id1_device_accuracy"),
        (k % 7).cast("double").alias("min_id2_device_accuracy"),
        (F.col("event_id") % 5).cast("double").alias("min_distance"),
        (F.col("event_id") % 4).cast("double").alias("min_time_difference"),
    )


def distances_to_infected(spark: SparkSession, root: str) -> DataFrame:
    """Per person and day, every third day only, a distance in metres."""
    e = table(spark, root, "events").filter(F.col("event_type") == "view")
    return (
        e.groupBy(F.col("user_id").alias("identifier"), F.col("ts").cast("date").alias("date"))
        .agg((F.sum(F.round(F.col("value") * 100).cast("bigint")).cast("double") / 2).alias("attribute_value"))
        .filter(F.dayofmonth("date") % 3 == 1)
        .select("identifier", "date", F.lit("distance_to_infected").alias("attribute_name"), "attribute_value")
    )


def movement_range(spark: SparkSession, root: str, mov: DataFrame | None = None) -> DataFrame:
    """Relative change of a region's outgoing flow against the mean of its first 45 days."""
    mov = movement(spark, root) if mov is None else mov
    daily = (
        mov.join(community_map(spark, root).select(F.col("poly_id").alias("start_poly_id"), "community_id"), "start_poly_id")
        .groupBy(F.col("date_time").alias("ds"), F.col("community_id").alias("external_polygon_id"))
        .agg(F.sum("movement").alias("m"))
    )
    first = daily.agg(F.min("ds").alias("d0"))
    base = (
        daily.join(first, F.col("ds") < F.date_add("d0", 45))
        .groupBy("external_polygon_id")
        .agg(F.avg("m").alias("base"))
    )
    return daily.join(base, "external_polygon_id").select(
        "ds", "external_polygon_id", (F.col("m") / F.col("base") - 1).alias("all_day_bing_tiles_visited_relative_change")
    )


def delays(spark: SparkSession, root: str) -> DataFrame:
    """Delay vector of every area but each fifth: a discretised gamma whose shape follows the area key."""
    shape = F.col("k") % 3 + 1
    w = F.transform(
        F.sequence(F.lit(0), F.lit(DELAY_DAYS - 1)), lambda i: F.pow(i.cast("double"), shape.cast("double")) * F.exp(-i / 3.0)
    )
    raw = table(spark, root, "nation").select(F.col("n_nationkey").alias("k"), w.alias("w")).filter(F.col("k") % 5 != 4)
    total = F.aggregate("w", F.lit(0.0), lambda a, b: a + b)
    return raw.select(F.col("k").cast("string").alias("poly_id"), F.transform("w", lambda x: x / total).alias("p_delay"))


def area_indicators(spark: SparkSession, root: str) -> DataFrame:
    """Socio-economic stand-in per area, from customers and suppliers."""
    c = table(spark, root, "customer")
    poor = F.avg(F.when(F.col("c_acctbal") < 0, 1.0).otherwise(0.0))
    return (
        c.groupBy(F.col("c_nationkey").cast("string").alias("node_id"))
        .agg(
            F.count("*").cast("double").alias("poblacion"),
            F.avg(F.when(F.col("c_mktsegment") == "HOUSEHOLD", 1.0).otherwise(0.0)).alias("porcentaje_sobre_60"),
            (poor * 200).alias("ipm"),
            F.sum(F.when(F.col("c_mktsegment") == "MACHINERY", 1.0).otherwise(0.0)).alias("num_camas_UCI"),
            F.avg(F.when(F.col("c_mktsegment").isin("FURNITURE", "BUILDING", "AUTOMOBILE"), 1.0).otherwise(0.0)).alias(
                "porcentaje_subsidiado"
            ),
        )
    )
