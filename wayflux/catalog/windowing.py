"""Window operators over daily series."""

from pyspark.sql import functions as F

from wayflux.catalog.base import query
from wayflux.functions import dates
from wayflux.operators import ranking, windows
from wayflux.operators.joins import densify


def dense(t):
    c = t.cases.select("poly_id", "date_time", "num_cases")
    return densify(c, c, "poly_id", ["num_cases"]).select("poly_id", "date_time", "num_cases")


SMOOTH = """SELECT poly_id, date_time, m + (sum(num_cases) OVER (PARTITION BY poly_id) - sum(m) OVER (PARTITION BY poly_id)) / count(*) OVER (PARTITION BY poly_id) AS num_cases
    FROM (SELECT *, avg(num_cases) OVER (PARTITION BY poly_id ORDER BY date_time ROWS 4 PRECEDING) AS m FROM dense_cases)"""


@query("smoothed_cases", SMOOTH, d="date_time", r="num_cases", covers="E1")
def _(t):
    return windows.smooth_curve(dense(t), ["poly_id"], "date_time", "num_cases", 5)


@query("running_cases", "SELECT poly_id, date_time, sum(num_cases) OVER (PARTITION BY poly_id ORDER BY date_time) AS total FROM cases", d="date_time", covers="E2")
def _(t):
    return windows.accumulate(t.cases.select("poly_id", "date_time", "num_cases"), ["poly_id"], "date_time", "num_cases", "total").drop("num_cases")


def _gauss() -> str:
    import math

    w = [math.exp(-0.5 * (k / 2) ** 2) for k in range(-3, 4)]
    def at(k):
        return f"lag(num_cases, {-k}) OVER o" if k < 0 else f"lead(num_cases, {k}) OVER o" if k else "num_cases"

    top = " + ".join(f"coalesce({at(k)} * {x!r}, 0)" for k, x in zip(range(-3, 4), w))
    low = " + ".join(f"CASE WHEN {at(k)} IS NULL THEN 0 ELSE {x!r} END" for k, x in zip(range(-3, 4), w))
    return f"SELECT poly_id, date_time, round_even(CAST(({top}) / ({low}) AS DOUBLE), 0) AS smoothed_num_cases FROM dense_cases WINDOW o AS (PARTITION BY poly_id ORDER BY date_time)"


@query("gaussian_cases", _gauss(), d="date_time", r="smoothed_num_cases", covers="E3")
def _(t):
    return dense(t).withColumn("smoothed_num_cases", windows.gaussian_mean(["poly_id"], "date_time", "num_cases")).drop("num_cases")


@query("flow_change_from_start", """
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY poly_id ORDER BY date_time) AS k FROM daily_flow),
         p AS (SELECT poly_id, date_time, 100 * (external_movement - b) / b AS p FROM r JOIN (SELECT poly_id, avg(external_movement) AS b FROM r WHERE k <= 5 GROUP BY 1) USING (poly_id) WHERE b <> 0)
    SELECT poly_id, date_time, avg(p) OVER (PARTITION BY poly_id ORDER BY date_time ROWS 4 PRECEDING) AS change FROM p""", d="date_time", r="change", covers="E4")
def _(t):
    from wayflux.operators.aggregates import daily_in_out

    out = windows.change_from_start(daily_in_out(t.movement), ["poly_id"], "date_time", "external_movement", "change")
    return out.select("poly_id", "date_time", "change").filter("change is not null")


@query("full_window_means", """
    SELECT poly_id, date_time, CASE WHEN count(*) OVER w = 5 THEN avg(external_movement) OVER w END AS mean FROM daily_flow WINDOW w AS (PARTITION BY poly_id ORDER BY date_time ROWS 4 PRECEDING)""", d="date_time", r="mean", covers="E5")
def _(t):
    from wayflux.operators.aggregates import daily_in_out

    return daily_in_out(t.movement).select("poly_id", "date_time", windows.full_trailing_mean(["poly_id"], "date_time", "external_movement").alias("mean"))


@query("two_pass_range", """
    WITH a AS (SELECT poly_id, date_time, movement_change, CASE WHEN count(*) OVER w = 7 THEN avg(movement_change) OVER w ELSE 0 END AS m FROM area_range WINDOW w AS (PARTITION BY poly_id ORDER BY date_time ROWS 6 PRECEDING)),
         b AS (SELECT *, CASE WHEN m = 0 THEN movement_change ELSE m END AS one FROM a),
         c AS (SELECT *, CASE WHEN count(*) OVER w = 7 THEN avg(one) OVER w ELSE 0 END AS m2 FROM b WINDOW w AS (PARTITION BY poly_id ORDER BY date_time ROWS 6 PRECEDING)),
         d AS (SELECT *, CASE WHEN m2 = 0 THEN movement_change ELSE m2 END AS two FROM c)
    SELECT poly_id, date_time, (two - min(two) OVER p) / (max(two) OVER p - min(two) OVER p) AS mobility FROM d WINDOW p AS (PARTITION BY poly_id)""", d="date_time", r="mobility", covers="E6")
def _(t):
    return windows.two_pass_mean(t.area_range, ["poly_id"], "date_time", "movement_change", "mobility").select("poly_id", "date_time", "mobility")


@query("daily_from_cumulative", """
    SELECT poly_id, date_time, greatest(num_cases - coalesce(lag(num_cases) OVER (PARTITION BY poly_id ORDER BY date_time), 0), 0) AS daily FROM cases""", d="date_time", covers="E7")
def _(t):
    return t.cases.select("poly_id", "date_time", windows.undo_cumulative(["poly_id"], "date_time", "num_cases", clip=True).alias("daily"))


@query("rising_envelope", """
    SELECT user_id, date, min(v) OVER (PARTITION BY user_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v
    FROM (SELECT user_id, CAST(ts AS DATE) AS date, sum(CAST(round(value * 100) AS BIGINT)) AS v FROM events GROUP BY 1, 2)""", d="date", i="v", covers="E8")
def _(t):
    daily = t.raw("events").groupBy("user_id", F.col("ts").cast("date").alias("date")).agg(F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("v"))
    return daily.select("user_id", "date", windows.monotone_envelope(["user_id"], "date", "v").alias("v"))


@query("repaired_cumulative", covers="E8")
def _(t):
    """Running totals of events per user with every third day dented, repaired by the look-ahead rule."""
    daily = t.raw("events").groupBy("user_id", F.col("ts").cast("date").alias("date")).agg(F.count("*").cast("double").alias("n"))
    run = windows.accumulate(daily, ["user_id"], "date", "n", "total").withColumn("total", F.when(F.dayofmonth("date") % 3 == 0, F.floor(F.col("total") * 0.7)).otherwise(F.col("total")))
    return windows.repair_cumulative(run.select("user_id", "date", "total"), ["user_id"], "date", "total", "look_ahead")


@query("day_numbers", "SELECT poly_id, date_time, date_diff('day', min(date_time) OVER (PARTITION BY poly_id), date_time) AS day FROM cases", d="date_time", covers="E9")
def _(t):
    return t.cases.select("poly_id", "date_time", windows.day_index(["poly_id"], "date_time").alias("day"))


@query("areas_to_coverage", """
    WITH c AS (SELECT poly_id, n, sum(n) OVER (ORDER BY n DESC, poly_id) / sum(n) OVER () AS coverage FROM (SELECT poly_id, sum(num_cases) AS n FROM cases GROUP BY 1))
    SELECT poly_id, n, coverage FROM (SELECT *, coalesce(lag(coverage) OVER (ORDER BY n DESC, poly_id), 0) AS b FROM c) WHERE b <= 0.8""", r="coverage", covers="E10")
def _(t):
    return windows.coverage(t.cases.groupBy("poly_id").agg(F.sum("num_cases").alias("n")), "n", "poly_id", 0.8)


@query("best_tenth_per_hour", """
    SELECT event_id, CAST(ts AS DATE) AS date, hour(ts) AS hour FROM events
    QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), hour(ts) ORDER BY value DESC, event_id) <= ceil(0.1 * count(*) OVER (PARTITION BY CAST(ts AS DATE), hour(ts)))""", d="date", i="hour", covers="E11")
def _(t):
    e = t.raw("events").select("event_id", F.col("ts").cast("date").alias("date"), F.hour("ts").alias("hour"), "value")
    return ranking.top_share(e, ["date", "hour"], "value", "event_id", 0.1).select("event_id", "date", "hour")


@query("lagged_features", """
    SELECT poly_id, date_time, lag(num_cases, 1) OVER w AS cases_1, lag(num_cases, 2) OVER w AS cases_2, lag(num_cases, 3) OVER w AS cases_3, lead(num_cases, 8) OVER w AS target FROM dense_cases WINDOW w AS (PARTITION BY poly_id ORDER BY date_time)""", d="date_time", covers="E12 E13")
def _(t):
    df = windows.lag_features(dense(t), ["poly_id"], "date_time", {"cases": "num_cases"}, 3)
    return df.withColumn("target", windows.lead_target(["poly_id"], "date_time", "num_cases", 8)).drop("num_cases")


@query("series_without_first_days", "SELECT poly_id, date_time, num_cases FROM cases QUALIFY row_number() OVER (PARTITION BY poly_id ORDER BY date_time) > 10", d="date_time", covers="E14")
def _(t):
    return windows.drop_first(t.cases.select("poly_id", "date_time", "num_cases"), ["poly_id"], "date_time", 10)


@query("customers_ranked", "SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer", r="c_acctbal", covers="E15")
def _(t):
    return ranking.distributed_rank(t.raw("customer").select("c_custkey", "c_acctbal"), [], "c_acctbal", "c_custkey").drop("n")


@query("window_edges", """
    SELECT event_id, least(a + CAST(ceil(date_diff('day', a, CAST(ts AS DATE)) / 15) AS INTEGER) * 15, b) AS edge
    FROM events, (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events)""", d="edge", covers="E16")
def _(t):
    e = t.raw("events").select("event_id", F.col("ts").cast("date").alias("d"))
    span = e.agg(F.min("d").alias("a"), F.max("d").alias("b"))
    return e.join(span).select("event_id", dates.window_edge(F.col("d"), F.col("a"), F.col("b"), 15).alias("edge"))  # one-row side


@query("yearly_deltas", """
    SELECT poly_id, coalesce((b - a) / nullif(a, 0), 0) AS delta FROM (SELECT poly_id, coalesce(sum(num_cases) FILTER (WHERE year(date_time) = 1996), 0) AS a, coalesce(sum(num_cases) FILTER (WHERE year(date_time) = 1997), 0) AS b FROM cases GROUP BY 1)""", r="delta", covers="E18")
def _(t):
    y = F.year("date_time")
    w = t.cases.groupBy("poly_id").agg(F.sum(F.when(y == 1996, F.col("num_cases")).otherwise(0.0)).alias("a"), F.sum(F.when(y == 1997, F.col("num_cases")).otherwise(0.0)).alias("b"))
    return windows.window_deltas(w, {"delta": ("a", "b")}).select("poly_id", "delta")


@query("lines_ranked", """
    SELECT l_orderkey, l_linenumber, l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey * 8 + l_linenumber) AS rank FROM lineitem""", i="rank l_linenumber", covers="E15 E11")
def _(t):
    """Three groups, each of them dealt to ranges."""
    lines = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("tie"))
    return ranking.distributed_rank(lines, ["l_returnflag"], "l_extendedprice", "tie", rows_per_task=10_000).select("l_orderkey", "l_linenumber", "l_returnflag", "rank")


@query("price_percentiles", """
    SELECT l_returnflag, quantile_cont(l_extendedprice, 0.05) AS low, quantile_cont(l_extendedprice, 0.5) AS middle, quantile_cont(l_extendedprice, 0.95) AS high FROM lineitem GROUP BY 1""", r="low middle high", covers="B19 D40")
def _(t):
    q = ranking.exact_percentiles(t.raw("lineitem"), ["l_returnflag"], "l_extendedprice", [0.05, 0.5, 0.95], rows_per_task=5_000)
    return q.select("l_returnflag", *(F.col("q")[i].alias(name) for i, name in enumerate(("low", "middle", "high"))))


@query("customers_to_coverage", """
    WITH o AS (SELECT o_custkey, sum(o_totalprice) AS spent FROM orders GROUP BY 1), c AS (SELECT *, sum(spent) OVER (ORDER BY spent DESC, o_custkey) / sum(spent) OVER () AS coverage FROM o)
    SELECT o_custkey, coverage FROM (SELECT *, coalesce(lag(coverage) OVER (ORDER BY spent DESC, o_custkey), 0) AS b FROM c) WHERE b <= 0.8""", r="coverage", covers="E10")
def _(t):
    spent = t.raw("orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spent"))
    return windows.coverage(spent, "spent", "o_custkey", 0.8).select("o_custkey", "coverage")
