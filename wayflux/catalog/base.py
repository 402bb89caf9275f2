"""Registry, canonical tables for queries, and the SQL text of the same tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayflux.sources import testdata

# SQL of the canonical tables, in terms of the supplied ones and of each other
CANON = {
    "polygons": """
        SELECT CAST(n_nationkey AS VARCHAR) AS poly_id, n_name || '-' || r_name AS poly_name,
               CAST(-75 + 0.5 * (n_nationkey % 5) AS DOUBLE) AS poly_lon, CAST(4 + 0.5 * (n_nationkey // 5) AS DOUBLE) AS poly_lat,
               CAST(coalesce(p.n, 0) AS DOUBLE) AS attr_population, CAST(1 + n_nationkey % 7 AS DOUBLE) AS attr_area
        FROM nation JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) p ON p.c_nationkey = n_nationkey""",
    "squares": """
        SELECT *, poly_lon - 0.25 AS w, poly_lon + 0.25 AS e, poly_lat - 0.25 AS s, poly_lat + 0.25 AS n FROM polygons""",
    "community_map": """
        SELECT CAST(n_nationkey AS VARCHAR) AS poly_id, n_name || '-' || r_name AS poly_name,
               CAST(r_regionkey AS VARCHAR) AS community_id, r_name AS community_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "case_list": """
        SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, CAST(o_orderdate AS DATE) AS date_time, CAST(c_nationkey AS VARCHAR) AS poly_id, c_custkey
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "cases": """
        SELECT date_time, poly_id, CAST(count(*) AS DOUBLE) AS num_cases,
               CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS num_diseased,
               CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS num_recovered,
               CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS num_infected
        FROM case_list GROUP BY 1, 2""",
    "movement": """
        SELECT CAST(l_shipdate AS DATE) AS date_time, CAST(s_nationkey AS VARCHAR) AS start_poly_id,
               CAST(c_nationkey AS VARCHAR) AS end_poly_id, sum(l_quantity) AS movement
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3""",
    "points": """
        SELECT event_id, ts, user_id, event_type, value,
               -75.25e0 + ((user_id * 7919) % 99991 + 0.5e0) * 2.5e0 / 99991 AS lon,
               3.75e0 + ((user_id * 104729) % 99989 + 0.5e0) * 2.5e0 / 99989 AS lat
        FROM events""",
    "tiles": """
        SELECT event_id, date_trunc('day', ts) + to_hours(CAST(hour(ts) // 8 * 8 AS BIGINT)) AS date_time, value AS n_crisis,
               -75.25e0 + ((user_id * 7919) % 99991 + 0.5e0) * 2.5e0 / 99991 AS start_movement_lon,
               3.75e0 + ((user_id * 104729) % 99989 + 0.5e0) * 2.5e0 / 99989 AS start_movement_lat,
               -75.25e0 + ((xor(user_id, event_id % 7 + 1) * 7919) % 99991 + 0.5e0) * 2.5e0 / 99991 AS end_movement_lon,
               3.75e0 + ((xor(user_id, event_id % 7 + 1) * 104729) % 99989 + 0.5e0) * 2.5e0 / 99989 AS end_movement_lat
        FROM events""",
    "contacts": """
        SELECT event_id, user_id AS id1, xor(user_id, event_id % 7 + 1) AS id2, round(lat, 3) AS lat, round(lon, 3) AS lon,
               CAST(ts AS DATE) AS date, CAST(hour(ts) AS BIGINT) AS hour,
               CAST(k % 8 AS DOUBLE) AS min_id1_device_accuracy, CAST(k % 7 AS DOUBLE) AS min_id2_device_accuracy,
               CAST(event_id % 5 AS DOUBLE) AS min_distance, CAST(event_id % 4 AS DOUBLE) AS min_time_difference
        FROM (SELECT p.*, CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT) AS k FROM points p JOIN events e USING (event_id))""",
    "good_contacts": """
        SELECT * FROM contacts WHERE min_id1_device_accuracy <= 5 AND min_id2_device_accuracy <= 5 AND min_distance <= 3 AND min_time_difference <= 2""",
    "distances": """
        SELECT user_id AS identifier, CAST(ts AS DATE) AS date, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 2 AS attribute_value
        FROM events WHERE event_type = 'view' GROUP BY 1, 2 HAVING day(CAST(ts AS DATE)) % 3 = 1""",
    "region_flow": """
        SELECT date_time AS ds, community_id AS external_polygon_id, sum(movement) AS m
        FROM movement JOIN community_map ON start_poly_id = poly_id GROUP BY 1, 2""",
    "movement_range": """
        SELECT ds, external_polygon_id, m / base - 1 AS change
        FROM region_flow JOIN (SELECT external_polygon_id, avg(m) AS base FROM region_flow
             WHERE ds < (SELECT min(ds) FROM region_flow) + INTERVAL 45 DAY GROUP BY 1) USING (external_polygon_id)""",
    "area_range": """
        SELECT ds AS date_time, poly_id, change AS movement_change FROM movement_range JOIN community_map ON community_id = external_polygon_id""",
    "delays_raw": """
        SELECT n_nationkey AS k, i, power(CAST(i AS DOUBLE), CAST(n_nationkey % 3 + 1 AS DOUBLE)) * exp(-i / 3.0e0) AS w
        FROM nation, range(0, 62) t(i) WHERE n_nationkey % 5 <> 4""",
    "delays": """
        SELECT CAST(k AS VARCHAR) AS poly_id, i, w / sum(w) OVER (PARTITION BY k) AS p FROM delays_raw""",
    "indicators": """
        SELECT CAST(c_nationkey AS VARCHAR) AS node_id, CAST(count(*) AS DOUBLE) AS poblacion,
               avg(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1e0 ELSE 0e0 END) AS porcentaje_sobre_60,
               200 * avg(CASE WHEN c_acctbal < 0 THEN 1e0 ELSE 0e0 END) AS ipm,
               CAST(count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS DOUBLE) AS num_camas_UCI,
               avg(CASE WHEN c_mktsegment IN ('FURNITURE', 'BUILDING', 'AUTOMOBILE') THEN 1e0 ELSE 0e0 END) AS porcentaje_subsidiado
        FROM customer GROUP BY 1""",
    "daily_flow": """
        SELECT start_poly_id AS poly_id, date_time, sum(CASE WHEN start_poly_id = end_poly_id THEN movement ELSE 0 END) AS inner_movement,
               sum(CASE WHEN start_poly_id <> end_poly_id THEN movement ELSE 0 END) AS external_movement FROM movement GROUP BY 1, 2""",
    "span": """
        SELECT greatest((SELECT min(date_time) FROM cases), (SELECT min(date_time) FROM movement)) AS a,
               least((SELECT max(date_time) FROM cases), (SELECT max(date_time) FROM movement)) AS b, (SELECT min(date_time) FROM cases) AS c0""",
    "nodes": """
        SELECT d.date_time, date_diff('day', c0, d.date_time) AS day, poly_id AS node_id, coalesce(num_cases, 0) AS num_cases, m.movement AS inner_movement
        FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date_time, c0 FROM span) d CROSS JOIN (SELECT poly_id FROM polygons) p
        LEFT JOIN cases c USING (date_time, poly_id)
        LEFT JOIN (SELECT date_time, end_poly_id AS poly_id, movement FROM movement WHERE start_poly_id = end_poly_id) m USING (date_time, poly_id)""",
    "edges": """
        SELECT date_time, date_diff('day', c0, date_time) AS day, start_poly_id AS start_id, end_poly_id AS end_id, movement
        FROM movement, span WHERE start_poly_id <> end_poly_id AND date_time BETWEEN a AND b""",
    "ccases": """
        SELECT community_id AS poly_id, date_time, sum(num_cases) AS num_cases FROM cases JOIN community_map USING (poly_id) GROUP BY 1, 2""",
    "crange": """
        SELECT ds AS date_time, external_polygon_id AS poly_id, change AS movement_change FROM movement_range""",
    "dense_cases": """
        SELECT d.date_time, poly_id, coalesce(num_cases, 0) AS num_cases
        FROM (SELECT CAST(unnest(generate_series(min(date_time), max(date_time), INTERVAL 1 DAY)) AS DATE) AS date_time FROM cases) d
        CROSS JOIN (SELECT DISTINCT poly_id FROM cases) LEFT JOIN cases USING (date_time, poly_id)""",
    "both_ways": """
        SELECT date_time, start_poly_id AS node_id, end_poly_id AS neighbor_id FROM movement WHERE start_poly_id <> end_poly_id
        UNION SELECT date_time, end_poly_id, start_poly_id FROM movement WHERE start_poly_id <> end_poly_id""",
}


def _needs(sql: str) -> list[str]:
    import re

    words = set(re.findall(r"[a-z_]+", sql))
    return [n for n in CANON if n in words]


def with_canon(sql: str) -> str:
    """The query preceded by the canonical tables it mentions."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for dep in _needs(CANON[name]):
            if dep != name:
                add(dep)
        if name not in wanted:
            wanted.append(name)

    for n in _needs(sql):
        add(n)
    if not wanted:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CANON[n]})" for n in wanted) + f"\nSELECT * FROM (\n{sql}\n)"


def _typed(sql: str, dates: str, nums: str, ints: str) -> str:
    parts = [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()]
    parts += [f"round(CAST({c} AS DOUBLE), 6) + 0.0 AS {c}" for c in nums.split()]
    parts += [f"CAST({c} AS BIGINT) AS {c}" for c in ints.split()]
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM (\n{sql}\n)" if parts else sql


def present(df: DataFrame) -> DataFrame:
    """Plain output types: text dates, 6-decimal doubles, 64-bit integers."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "date":
            c = c.cast("string")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind in ("double", "float") or kind.startswith("decimal"):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif kind in ("int", "smallint", "tinyint", "boolean"):
            c = c.cast("bigint")
        out.append(c.alias(name))
    return df.select(*out)


class Tables:
    """Canonical tables of one folder. Day-level tables are kept, as stage outputs are."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def raw(self, name: str) -> DataFrame:
        return testdata.table(self.spark, self.root, name)

    def __getattr__(self, name: str) -> DataFrame:
        return getattr(testdata, name)(self.spark, self.root)

    @cached_property
    def cases(self) -> DataFrame:
        return testdata.cases(self.spark, self.root).persist()

    @cached_property
    def movement(self) -> DataFrame:
        return testdata.movement(self.spark, self.root).persist()

    @cached_property
    def movement_range(self) -> DataFrame:
        return testdata.movement_range(self.spark, self.root, self.movement)

    @cached_property
    def area_range(self) -> DataFrame:
        m = self.community_map.select("poly_id", F.col("community_id").alias("external_polygon_id"))
        r = self.movement_range.join(m, "external_polygon_id")
        return r.select(F.col("ds").alias("date_time"), "poly_id", F.col("all_day_bing_tiles_visited_relative_change").alias("movement_change"))

    @cached_property
    def community_cases(self) -> DataFrame:
        """Cases per community: the level at which reproductive numbers are estimated."""
        m = self.community_map.select("poly_id", "community_id")
        c = self.cases.join(m, "poly_id").groupBy(F.col("community_id").alias("poly_id"), "date_time")
        return c.agg(F.sum("num_cases").alias("num_cases"))

    @cached_property
    def community_range(self) -> DataFrame:
        r = self.movement_range
        return r.select(F.col("ds").alias("date_time"), F.col("external_polygon_id").alias("poly_id"), F.col("all_day_bing_tiles_visited_relative_change").alias("movement_change"))

    @cached_property
    def graph(self):
        from wayflux.plans import graphs

        return graphs.build_graphs(self.polygons, self.cases, self.movement)

    @cached_property
    def ringed(self) -> DataFrame:
        from wayflux.operators.spatial import with_rings

        return with_rings(self.polygons)

    @cached_property
    def good_contacts(self) -> DataFrame:
        from wayflux.operators.reshape import good_contacts

        return good_contacts(self.contacts, 5, 3, 2)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: str


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, d: str = "", r: str = "", i: str = "", covers: str = ""):
    """Register a query: `sql` is its equivalent, d / r / i name date, double and integer columns."""

    def deco(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        text = _typed(with_canon(sql), d, r, i) if sql else None
        QUERIES[name] = Query(lambda spark, root: present(fn(Tables(spark, root))), text, covers)
        return fn

    return deco
