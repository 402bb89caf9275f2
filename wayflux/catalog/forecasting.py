"""Feature tables, ridge, scenarios, union forecasts."""

from pyspark.sql import functions as F

from wayflux.catalog.base import query
from wayflux.catalog.windowing import dense
from wayflux.operators import windows
from wayflux.plans import forecast
from wayflux.session import cut_lineage

BACK, AHEAD, SMOOTH = 5, 8, 5


def _groups(t):
    return t.polygons.select(F.col("poly_id").alias("node_id"), F.col("poly_id").alias("group_id"))


def features(t, smooth=SMOOTH):
    nodes, edges, _ = t.graph
    return forecast.prediction_table(nodes, edges, _groups(t), BACK, AHEAD, smooth)


def _features_sql(values: dict, group: str, smooth: bool, into: str) -> str:
    sm = """SELECT date_time, day, node_id, inner_movement, m + (sum(num_cases) OVER (PARTITION BY node_id) - sum(m) OVER (PARTITION BY node_id)) / count(*) OVER (PARTITION BY node_id) AS num_cases
        FROM (SELECT *, avg(num_cases) OVER (PARTITION BY node_id ORDER BY day ROWS 4 PRECEDING) AS m FROM nodes)""" if smooth else "SELECT * FROM nodes"
    cols = ", ".join(f"lag({c}, {k}) OVER o AS {n}_{k}" for k in range(BACK, 0, -1) for n, c in values.items())
    return f"""
    WITH n AS ({sm}),
      own AS (SELECT {group} AS group_id, date_time, day, coalesce(sum(inner_movement), 0) AS inner_movement, coalesce(sum(inner_movement * num_cases), 0) AS inner_degree, sum(num_cases) AS cases FROM n GROUP BY 1, 2, 3),
      inn AS (SELECT {into} AS group_id, e.date_time, sum(movement * num_cases) AS in_degree, sum(movement) AS in_movement, sum(num_cases) AS in_cases FROM edges e JOIN n ON n.node_id = start_id AND n.date_time = e.date_time GROUP BY 1, 2),
      d AS (SELECT own.*, coalesce(in_degree, 0) AS in_degree, coalesce(in_movement, 0) AS in_movement, coalesce(in_cases, 0) AS in_cases FROM own LEFT JOIN inn USING (group_id, date_time))
    SELECT group_id, {cols}, CAST(day AS DOUBLE) AS elapsed_days, date_time AS "current_date", date_time + {AHEAD} AS target_date, lead(cases, {AHEAD}) OVER o AS target_num_cases
    FROM d WINDOW o AS (PARTITION BY group_id ORDER BY day) QUALIFY row_number() OVER o > {BACK}"""


def _nums(values):
    return " ".join(f"{n}_{k}" for k in range(BACK, 0, -1) for n in values) + " target_num_cases"


@query("forecast_features", _features_sql(forecast.NODE_VALUES, "node_id", True, "end_id"), d='"current_date" target_date', r=_nums(forecast.NODE_VALUES), covers="K10 E1 E12 E13")
def _(t):
    return features(t)


@query("forecast_features_of_graph", _features_sql(forecast.GRAPH_VALUES, "'all'", False, "'all'"), d='"current_date" target_date', r=_nums(forecast.GRAPH_VALUES), covers="K10")
def _(t):
    nodes, edges, _ = t.graph
    return forecast.prediction_table(nodes, edges, None, BACK, AHEAD, 1, values=forecast.GRAPH_VALUES)


def fitted(t):
    table = cut_lineage(features(t))
    model, summary = forecast.fit(table, forecast.feature_names(BACK), ["group_id", "current_date"])
    return table, model, summary


@query("ridge_summary", covers="K11 K12")
def _(t):
    _, _, s = fitted(t)
    return t.spark.createDataFrame([(k, float(v)) for k, v in sorted(s.items())], "name string, value double")


@query("ridge_weights", covers="K12")
def _(t):
    _, model, _ = fitted(t)
    return forecast.weights_table(t.spark, model)


@query("area_forecasts", covers="K12 E2")
def _(t):
    table, model, _ = fitted(t)
    return forecast.predictions(table, model)


@query("area_forecast_scores", covers="K12")
def _(t):
    table, model, _ = fitted(t)
    return forecast.local_scores(forecast.predictions(table, model))


@query("mobility_scenarios", covers="K13 B22")
def _(t):
    _, model, _ = fitted(t)
    nodes, edges, _ = t.graph
    out = forecast.scenarios(nodes, edges, _groups(t), model, [0.5, 0.7, 0.9, 1.0, 1.1, 1.3, 1.5], BACK, AHEAD, SMOOTH)
    return out.withColumn("label", forecast.scenario_label(F.col("ratio")))


PRED = """pr AS (SELECT poly_id, date_time + 8 AS target_date, lead(num_cases, 8) OVER o AS target_num_cases, avg(num_cases) OVER (PARTITION BY poly_id ORDER BY date_time ROWS 4 PRECEDING) AS predicted_num_cases FROM dense_cases WINDOW o AS (PARTITION BY poly_id ORDER BY date_time)),
    acc AS (SELECT *, sum(predicted_num_cases) OVER (PARTITION BY poly_id ORDER BY target_date) AS predicted_num_cases_accum FROM pr)"""


def naive_predictions(t):
    """Trailing mean as the prediction eight days ahead."""
    d = dense(t)
    p = d.withColumn("target_num_cases", windows.lead_target(["poly_id"], "date_time", "num_cases", 8)).withColumn(
        "predicted_num_cases", F.avg("num_cases").over(windows.trailing(["poly_id"], "date_time", 5))
    ).withColumn("target_date", F.date_add("date_time", 8)).select("poly_id", "target_date", "target_num_cases", "predicted_num_cases")
    return windows.accumulate(p, ["poly_id"], "target_date", "predicted_num_cases", "predicted_num_cases_accum")


@query("union_forecast", f"""
    WITH {PRED}, past AS (SELECT target_date, sum(predicted_num_cases) / 0.8 AS cases, sum(predicted_num_cases_accum) / 0.8 AS cases_accum FROM acc WHERE target_num_cases IS NOT NULL GROUP BY 1),
         ahead AS (SELECT target_date, sum(predicted_num_cases) / 0.8 AS cases, sum(predicted_num_cases_accum) / 0.8 AS cases_accum, row_number() OVER (ORDER BY target_date) AS i FROM acc WHERE target_date >= (SELECT min(target_date) - 1 FROM acc WHERE target_num_cases IS NULL) GROUP BY 1),
         tot AS (SELECT date_time AS target_date, sum(num_cases) AS cases FROM dense_cases GROUP BY 1),
         rl AS (SELECT past.target_date, coalesce(tot.cases, 0) AS cases FROM past LEFT JOIN tot USING (target_date)),
         er AS (SELECT sqrt(avg((rl.cases - past.cases) ** 2)) AS rmse FROM rl JOIN past USING (target_date))
    SELECT target_date, 'real' AS kind, cases, sum(cases) OVER (ORDER BY target_date) AS cases_accum, NULL AS low, NULL AS high, NULL AS low_accum, NULL AS high_accum FROM rl
    UNION ALL SELECT target_date, 'past', cases, cases_accum, NULL, NULL, NULL, NULL FROM past
    UNION ALL SELECT target_date, 'ahead', cases, cases_accum, cases - rmse, cases + rmse, cases_accum - rmse * i, cases_accum + rmse * i FROM ahead, er""",
       d="target_date", r="cases cases_accum low high low_accum high_accum", covers="K14")
def _(t):
    real = dense(t).groupBy(F.col("date_time").alias("target_date")).agg(F.sum("num_cases").alias("cases"))
    return forecast.union_forecast(naive_predictions(t), real, 0.8)


@query("forecast_errors", f"WITH {PRED} SELECT sqrt(avg((target_num_cases - predicted_num_cases) ** 2)) AS rmse, 100 * avg(abs(target_num_cases - predicted_num_cases) / (target_num_cases + 1)) AS mpe FROM acc WHERE target_num_cases IS NOT NULL", r="rmse mpe", covers="K14")
def _(t):
    p = naive_predictions(t).filter("target_num_cases is not null")
    return forecast.forecast_errors(p.select(F.col("target_num_cases").alias("y"), F.col("predicted_num_cases").alias("p")))
