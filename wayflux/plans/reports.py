"""Report tables composed of several operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayflux.functions.vectors import ratio
from wayflux.operators import aggregates, joins, ranking, reshape, windows
from wayflux.plans import alerts, graphs


def general_statistics(cases: DataFrame, flows: DataFrame, window: int = 5, silent_window: int = 15, as_of=None) -> DataFrame:
    """Location summary as (parameter_name, parameter_value) rows, each measure under its own name."""
    inner = reshape.internal(flows).groupBy("date_time").agg(F.sum("movement").alias("v"))
    outer = reshape.external(flows).groupBy("date_time").agg(F.sum("movement").alias("v"))
    counts = cases.groupBy("date_time").agg(F.sum("num_cases").alias("v"))
    rows = []
    for name, df in (("mov", inner), ("out_mov", outer), ("cases", counts)):
        e = aggregates.extreme_rows(df, "v", ["date_time"], ["date_time", "v"])
        rows.append(e.select(F.concat(F.lit("day_"), "kind", F.lit(f"_{name}")).alias("parameter_name"), F.col("date_time").cast("string").alias("parameter_value")))
        rows.append(e.select(F.concat(F.col("kind"), F.lit(f"_{name}_in_day")).alias("parameter_name"), F.format_string("%.3f", "v").alias("parameter_value")))
    for name, df in (
        ("num_first_case", aggregates.first_case_areas(cases, window, as_of)),
        ("no_case_polygons_last_days", aggregates.silent_areas(cases, silent_window, as_of)),
    ):
        rows.append(df.agg(F.count("*").cast("string").alias("parameter_value")).select(F.lit(name).alias("parameter_name"), "parameter_value"))
    return reshape.stack(rows)


def relative_flow(flows: DataFrame, baseline: str) -> DataFrame:
    """Flow of each pair against its mean up to the baseline day; a pair without baseline counts as 1."""
    base = flows.filter(F.col("date_time") <= F.lit(baseline).cast("date")).groupBy("start_poly_id", "end_poly_id").agg(F.avg("movement").alias("_base"))
    return flows.join(base, ["start_poly_id", "end_poly_id"], "left").select(
        "date_time", "start_poly_id", "end_poly_id", "movement", F.coalesce(ratio(F.col("movement"), F.col("_base")), F.lit(1.0)).alias("percentage")
    )


def smoothed_inner_flow(flows: DataFrame, baseline: str, rows: int = 5) -> DataFrame:
    """Inner flow in percent of its baseline, trailing mean over full windows only."""
    rel = relative_flow(reshape.internal(flows), baseline).withColumnRenamed("start_poly_id", "poly_id")
    mean = windows.full_trailing_mean(["poly_id"], "date_time", "percentage", rows)
    return rel.withColumn("percentage", 100 * mean).filter("percentage is not null").select("date_time", "poly_id", "percentage")


def date_type_series(case_rows: DataFrame, smooth_days: int = 5, back_days: int = 66) -> DataFrame:
    """Counts by diagnosis, web report and onset date, side by side.

    case_rows(diagnosis, web_report, onset). Onset stops `back_days` before its last day.
    """
    def count(col):
        return case_rows.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("date_time")).agg(F.count("*").cast("double").alias("value"))

    def smooth(df):
        return windows.smooth_curve(df.withColumn("_k", F.lit(1)), ["_k"], "date_time", "value", smooth_days).drop("_k")

    diag = count("diagnosis")
    last = diag.agg(F.max("date_time").alias("_m"))
    web = count("web_report").join(last, F.col("date_time") <= F.col("_m")).drop("_m")
    onset_all = count("onset")
    cut = onset_all.agg(F.date_sub(F.max("date_time"), back_days).alias("_m"))
    onset = onset_all.join(cut, F.col("date_time") <= F.col("_m")).drop("_m")
    kinds = (("diagnosis", smooth(diag)), ("web_report", web), ("onset", smooth(onset)))
    return reshape.stack([d.withColumn("kind", F.lit(k)) for k, d in kinds])


def window_tables(nodes: DataFrame, edges: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean nodes and edges around each anchor day; nodes without cases left out."""
    inner = windows.anchor_means(nodes, anchors, ["node_id"], "inner_movement")
    cases = windows.anchor_means(nodes, anchors, ["node_id"], "num_cases").filter("num_cases > 0")
    return cases.join(inner, ["anchor", "node_id"], "left"), windows.anchor_means(edges, anchors, ["start_id", "end_id"], "movement")


def latest_values(attributes: DataFrame, names: DataFrame, attribute: str, like: str = "%") -> DataFrame:
    """Newest values of one attribute with place names, largest first."""
    spark = attributes.sparkSession
    attributes.createOrReplaceTempView("_wf_attributes")
    names.createOrReplaceTempView("_wf_names")
    return spark.sql(
        """
        SELECT a.location_id, n.name, a.date, a.attribute_name, a.attribute_value
        FROM _wf_attributes a JOIN _wf_names n ON a.location_id = n.location_id
        WHERE a.attribute_name = :attr AND n.name LIKE :pattern
          AND a.date = (SELECT max(date) FROM _wf_attributes WHERE attribute_name = :attr)
        ORDER BY a.attribute_value DESC, a.location_id
        """,
        args={"attr": attribute, "pattern": like},
    )


def top_three_phrase(ranked: DataFrame, name: str, value: str) -> DataFrame:
    top = ranking.top_rows(ranked, value, [name], 3).agg(F.array_sort(F.collect_list(F.struct((-F.col(value)).alias("v"), F.col(name).alias("n")))).alias("t"))
    return top.select(F.concat(F.col("t")[0]["n"], F.lit(", "), F.col("t")[1]["n"], F.lit(" y "), F.col("t")[2]["n"]).alias("phrase"))


def communities_of(mapping: DataFrame, members: DataFrame, prefix: str) -> DataFrame:
    """Communities of the selected areas whose id starts with a prefix."""
    return reshape.only_ids(mapping, "poly_id", members).select("community_id").distinct().filter(F.col("community_id").startswith(prefix))


def area_report(polygons: DataFrame, cases: DataFrame, flows: DataFrame, touching: DataFrame, ids: list[str]) -> dict[str, DataFrame]:
    """Everything about a set of areas: neighbours, flow, cases, alerts."""
    nodes, edges, places = graphs.build_graphs(polygons, cases, flows)
    near = reshape.only_ids(joins.neighbours_or_touching(edges, touching), "node_id", ids)
    return {
        "neighbours": near,
        "cases": reshape.only_ids(cases, "poly_id", ids),
        "movement": flows.filter(F.col("start_poly_id").isin(ids) | F.col("end_poly_id").isin(ids)),
        "windows": reshape.only_ids(alerts.case_windows(cases, flows), "poly_id", ids),
        "flow_alerts": reshape.only_ids(alerts.flow_alerts(flows), "poly_id", ids),
        "locations": reshape.only_ids(places, "node_id", ids),
        "statistics": general_statistics(reshape.only_ids(cases, "poly_id", ids), flows.filter(F.col("start_poly_id").isin(ids))),
    }
