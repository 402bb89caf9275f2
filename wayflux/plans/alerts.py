"""Alert tables, case windows and change maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayflux.functions.vectors import binned, ratio
from wayflux.operators import aggregates, joins, reshape, windows
from wayflux.session import cut_lineage

RED, YELLOW, GREEN, WHITE = "ROJO", "AMARILLO", "VERDE", "BLANCO"

# fixed values: display colour of each level and the national reference values
COLOURS = {"ROJO": "#b30000", "AMARILLO": "#ffcc00", "VERDE": "#006600", "BLANCO": "#d4d4d4"}
NATIONAL = {"ipm": 19.6, "porcentaje_sobre_60": 12.0, "porcentaje_subsidiado": 53.0}
VULNERABILITY_NAMES = {"ipm": "IPM", "porcentaje_sobre_60": ">60 ANOS", "porcentaje_subsidiado": "EPS SUBSIDIADO"}


def level(x: Column, red: float, yellow: float, inclusive: bool = False) -> Column:
    over = (lambda c: x >= c) if inclusive else (lambda c: x > c)
    return F.when(over(red), F.lit(RED)).when(over(yellow), F.lit(YELLOW)).otherwise(F.lit(GREEN))


def case_windows(cases: DataFrame, flows: DataFrame, window_size: int = 5) -> DataFrame:
    """Mean own and neighbour cases per area in the windows around day zero, and their changes."""
    c = cases.agg(F.min("date_time").alias("c0"), F.max("date_time").alias("c1"))
    m = flows.agg(F.max("date_time").alias("m1"))
    marks = c.crossJoin(m).select(  # one row each
        "c0", F.least("c1", "m1").alias("last"), F.date_sub(F.least("c1", "m1"), window_size).alias("zero")
    ).withColumn("low", F.date_sub("zero", window_size)).withColumn("back", F.date_sub("low", window_size))
    daily = cases.groupBy("poly_id", "date_time").agg(F.sum("num_cases").alias("num_cases"))
    grid = daily.select("poly_id").distinct().crossJoin(marks).withColumn("date_time", F.explode(F.sequence(F.greatest("back", "c0"), "last")))
    near = joins.neighbour_totals(flows, daily, "poly_id", "num_cases").withColumnRenamed("node_id", "poly_id")
    rows = (
        grid.join(daily, ["poly_id", "date_time"], "left")
        .join(near.withColumnRenamed("neighbor_num_cases", "external_num_cases"), ["poly_id", "date_time"], "left")
        .na.fill(0.0, subset=["num_cases", "external_num_cases"])
    )
    d = F.col("date_time")
    spans = {
        "backward": (d >= F.col("back")) & (d < F.col("low")),
        "middle": (d >= F.col("low")) & (d < F.col("zero")),
        "forward": (d >= F.col("zero")) & (d <= F.col("last")),
        "total": (d > F.col("low")) & (d <= F.col("last")),
    }
    aggs = [
        F.avg(F.when(cond, F.col(v))).alias(f"{v}_{name}")
        for name, cond in spans.items() for v in ("num_cases", "external_num_cases")
    ]
    wide = rows.groupBy("poly_id").agg(*aggs)
    pairs = {}
    for name, (a, b) in {"backward": ("backward", "middle"), "forward": ("middle", "forward"), "total": ("backward", "forward")}.items():
        for v in ("num_cases", "external_num_cases"):
            pairs[f"delta_{v}_{name}"] = (f"{v}_{a}", f"{v}_{b}")
    return windows.window_deltas(wide, pairs)


def flow_alerts(flows: DataFrame, days: int = 7) -> DataFrame:
    """Share of the last days on which a flow exceeded its mean by 1.5 deviations, as a level."""
    daily = aggregates.daily_in_out(flows)
    stats = aggregates.movement_stats(daily)
    last = flows.agg(F.date_sub(F.max("date_time"), days).alias("_first"))
    recent = daily.join(last, F.col("date_time") >= F.col("_first"))

    def point(kind):
        return F.sum(F.when(F.col(kind) > F.col(f"one_half_std_over_{kind}"), 1.0).otherwise(0.0)) / days

    pts = recent.join(stats, "poly_id").groupBy("poly_id").agg(
        point("inner_movement").alias("points_inner"), point("external_movement").alias("points_external")
    )
    return pts.select(
        "poly_id", "points_inner", "points_external",
        level(F.col("points_inner"), 0.5, 0).alias("internal_alert"), level(F.col("points_external"), 0.5, 0).alias("external_alert"),
    )


def range_alerts(ranges: DataFrame, thresholds: DataFrame, days: int = 7) -> DataFrame:
    """Mean range of the last days against the area's threshold."""
    last = ranges.agg(F.date_sub(F.max("date_time"), days).alias("_first"))
    mean = ranges.join(last, F.col("date_time") >= F.col("_first")).groupBy("poly_id").agg(F.avg("movement_change").alias("movement_change"))
    th = thresholds.select("poly_id", F.nanvl("mob_th", F.lit(None).cast("double")).alias("threshold"))
    alert = (
        F.when(F.col("threshold").isNull(), F.lit(WHITE))
        .when(F.col("movement_change") >= F.col("threshold"), F.lit(RED))
        .otherwise(F.lit(GREEN))
    )
    return mean.join(th, "poly_id", "full").select("poly_id", alert.alias("movement_range_alert"))


def rt_alerts(rt: DataFrame, days: int = 7) -> DataFrame:
    rt = cut_lineage(rt)  # estimated once
    last = rt.agg(F.date_sub(F.max("date_time"), days).alias("_first"))
    mean = rt.join(last, F.col("date_time") >= F.col("_first")).groupBy("poly_id").agg(F.avg("ml").alias("ml"))
    return mean.select(
        "poly_id", "ml", F.when(F.col("ml").isNull(), F.lit(WHITE)).otherwise(level(F.col("ml"), 1.0, 0.8, inclusive=True)).alias("rt_alert")
    )


def case_alerts(windows_table: DataFrame) -> DataFrame:
    return windows_table.select(
        "poly_id",
        level(F.col("delta_num_cases_forward"), 1.0, 0.5).alias("alert_internal_num_cases"),
        level(F.col("delta_external_num_cases_forward"), 1.0, 0.5).alias("alert_external_num_cases"),
    )


def vulnerability(indicators: DataFrame, key: str = "node_id") -> DataFrame:
    """Every national reference value an area exceeds; '--' when there is none."""
    def over(col):
        scale = 100.0 if col.startswith("porcentaje") else 1.0
        return F.when(F.col(col) * scale > NATIONAL[col], F.lit(VULNERABILITY_NAMES[col]))

    text = F.concat_ws(";", *[over(c) for c in ("ipm", "porcentaje_sobre_60", "porcentaje_subsidiado")])
    return indicators.select(F.col(key).alias("poly_id"), F.when(text == "", F.lit("--")).otherwise(text).alias("vulnerability_alert"))


def strongest(cols: list[str]) -> Column:
    """Strongest of several levels: red over yellow over green over white."""
    order = F.greatest(*[F.when(F.col(c) == RED, 3).when(F.col(c) == YELLOW, 2).when(F.col(c) == GREEN, 1).otherwise(0) for c in cols])
    return F.when(order == 3, F.lit(RED)).when(order == 2, F.lit(YELLOW)).when(order == 1, F.lit(GREEN)).otherwise(F.lit(WHITE))


DEFAULTS = {
    "external_alert": GREEN, "internal_alert": GREEN, "movement_range_alert": WHITE, "alert_first_case": GREEN,
    "alert_internal_num_cases": GREEN, "alert_external_num_cases": GREEN, "rt_alert": WHITE,
}
COMBINED = [
    "external_alert", "movement_range_alert", "alert_first_case", "alert_internal_num_cases", "alert_external_num_cases", "rt_alert",
]


def alert_table(
    cases: DataFrame, flows: DataFrame, ranges: DataFrame, thresholds: DataFrame, rt: DataFrame, indicators: DataFrame,
    mapping: DataFrame, days: int = 7, ids: DataFrame | list[str] | None = None,
) -> DataFrame:
    """All alerts of every area with names, vulnerability and the strongest level."""
    first = aggregates.first_case_areas(cases, days).select("poly_id", F.lit(RED).alias("alert_first_case"))
    parts = [
        flow_alerts(flows, days).select("poly_id", "internal_alert", "external_alert"),
        range_alerts(ranges, thresholds, days), first, rt_alerts(rt, days).select("poly_id", "rt_alert"),
        case_alerts(case_windows(cases, flows)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "poly_id", "full")
    out = out.join(mapping.select("poly_id", "poly_name", "community_name"), "poly_id", "full").na.fill(DEFAULTS)
    out = out.withColumn("max_alert", strongest(COMBINED)).join(vulnerability(indicators), "poly_id", "left")
    out = reshape.split_name(out, "poly_name", "municipality", "department").drop("poly_name").na.fill(GREEN)
    for c in ["max_alert", *DEFAULTS]:
        colour = F.create_map(*[F.lit(x) for kv in COLOURS.items() for x in kv])
        out = out.withColumn(f"{c}_color", colour[F.col(c)])
    return reshape.only_ids(out, "poly_id", ids)


def change_windows(flows: DataFrame, base_day: str, days: int = 7) -> DataFrame:
    """Mean internal flow and mean daily external flow per area in three windows, with changes.

    Windows: from the base day, the week before the last, the last week.
    """
    m = flows.agg(F.max("date_time").alias("d")).select(
        F.date_sub("d", days).alias("t3"), F.date_sub("d", 2 * days).alias("t2"),
        F.lit(base_day).cast("date").alias("t0"), F.date_add(F.lit(base_day).cast("date"), days).alias("t1"),
    )
    d, own = F.col("date_time"), F.col("start_poly_id") == F.col("end_poly_id")
    part = (
        F.when(d >= F.col("t3"), F.lit("recent")).when((d >= F.col("t2")) & (d < F.col("t3")), F.lit("before"))
        .when(d.between(F.col("t0"), F.col("t1")), F.lit("base"))
    )
    daily = (
        flows.join(m).withColumn("part", part).filter("part is not null")  # one-row side
        .groupBy(F.col("start_poly_id").alias("poly_id"), "part", "date_time")
        .agg(F.sum(F.when(own, F.col("movement"))).alias("i"), F.sum(F.when(~own, F.col("movement"))).alias("e"))
    )
    aggs = []
    for p in ("base", "before", "recent"):
        for c, name in (("i", "internal_movement"), ("e", "external_movement")):
            aggs.append(F.coalesce(F.avg(F.when(F.col("part") == p, F.col(c))), F.lit(0.0)).alias(f"{name}_{p}"))
        aggs.append(F.max(F.when(F.col("part") == p, 1).otherwise(0)).alias(f"has_{p}"))
    return daily.groupBy("poly_id").agg(*aggs)


def change_maps(flows: DataFrame, base_day: str, rt: DataFrame | None = None, days: int = 7) -> DataFrame:
    """Recent and historic change of internal and external flow; areas with an infinite change drop out."""
    w = change_windows(flows, base_day, days)
    rows = []
    for name, early in (("recent", "before"), ("historic", "base")):
        cols, bad = [], F.lit(False)
        both = (F.col(f"has_{early}") == 1) & (F.col("has_recent") == 1)
        for c in ("internal_movement", "external_movement"):
            a, b = F.col(f"{c}_{early}"), F.col(f"{c}_recent")
            cols.append(F.coalesce(ratio(b - a, a), F.lit(0.0)).alias(f"delta_{c}"))
            bad = bad | ((a == 0) & (b != 0))
        cols = [F.when(both, x).otherwise(0.0).alias(n) for x, n in zip(cols, ("delta_internal_movement", "delta_external_movement"))]
        some = (F.col(f"has_{early}") == 1) | (F.col("has_recent") == 1)
        rows.append(w.filter(some & ~(both & bad)).select("poly_id", F.lit(name).alias("kind"), *cols))
    out = rows[0].unionByName(rows[1])
    return out if rt is None else out.join(rt_alerts(rt, days).select("poly_id", "ml"), "poly_id", "left")


def legend(breaks: list[float], first: float = -10) -> list[str]:
    edges = [first, *breaks]
    return [f"({a}, {b}]" for a, b in zip(edges, edges[1:])]


def coloured(df: DataFrame, col: str, breaks: list[float], out: str = "bin") -> DataFrame:
    """Label of the interval a value lies in; beyond the last break the first label, no value 'Sin RT'."""
    labels = legend(breaks)
    return df.withColumn(out, F.coalesce(binned(F.col(col), [*breaks], [*labels, labels[0]]), F.lit("Sin RT")))


def highlights(df: DataFrame, names: DataFrame, cuts: dict[str, float]) -> DataFrame:
    """Areas whose value exceeds a cut-off, per measure, with their names."""
    frames = [df.filter(F.col(c) > v).select("poly_id", F.lit(c).alias("measure"), F.col(c).alias("value")) for c, v in cuts.items()]
    return reshape.stack(frames).join(names, "poly_id")
