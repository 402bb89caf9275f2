"""Onset, reproductive numbers, thresholds, series."""

import math

import numpy as np
from pyspark.sql import functions as F

from wayflux.catalog.base import query
from wayflux.catalog.windowing import dense
from wayflux.operators import aggregates
from wayflux.plans import epi, series
from wayflux.session import cut_lineage

VEC = """mean AS (SELECT i, avg(p) AS m FROM delays GROUP BY 1),
    vec AS (SELECT poly_id, i, CASE WHEN i = 0 THEN 0 ELSE p END AS p FROM delays WHERE poly_id IN (SELECT poly_id FROM ccases) UNION ALL SELECT poly_id, i, m FROM (SELECT DISTINCT poly_id FROM ccases), mean WHERE poly_id NOT IN (SELECT poly_id FROM delays)),
    onset AS (SELECT poly_id, date_time - CAST(i AS INTEGER) AS date_time, round_even(sum(num_cases * p), 0) AS num_cases FROM ccases JOIN vec USING (poly_id) GROUP BY 1, 2 HAVING sum(num_cases * p) >= 1)"""


def onset(t):
    return epi.confirmed_to_onset(t.community_cases, epi.delay_for(t.community_cases, t.delays))


@query("onset_counts", f"WITH {VEC} SELECT * FROM onset", d="date_time", covers="K1 D9 H8")
def _(t):
    return onset(t)


@query("censoring_corrected", f"""
    WITH {VEC}, known AS (SELECT poly_id, i, sum(p) OVER (PARTITION BY poly_id ORDER BY i) AS c FROM vec)
    SELECT o.poly_id, date_time, num_cases, num_cases / nullif(CASE WHEN k.c IS NULL THEN 1 ELSE k.c END, 0) AS num_cases_adjusted
    FROM (SELECT *, row_number() OVER (PARTITION BY poly_id ORDER BY date_time DESC) - 1 AS b FROM onset) o LEFT JOIN known k ON k.poly_id = o.poly_id AND k.i = b""", d="date_time", r="num_cases_adjusted", covers="K2")
def _(t):
    vec = epi.delay_for(t.community_cases, t.delays)
    return epi.adjust_right_censoring(onset(t), vec)


def _smooth_sql(col: str) -> str:
    """Centred weighted mean of seven rows of a window o, rounded half to even."""
    lags = {k: col if k == 0 else f"{'lag' if k < 0 else 'lead'}({col}, {abs(k)}) OVER o" for k in range(-3, 4)}
    weight = {k: repr(math.exp(-0.5 * (k / 2) ** 2)) for k in lags}
    top = " + ".join(f"coalesce({x} * {weight[k]}, 0)" for k, x in lags.items())
    bottom = " + ".join(f"CASE WHEN {x} IS NULL THEN 0 ELSE {weight[k]} END" for k, x in lags.items())
    return f"round_even(({top}) / ({bottom}), 0)"


def _rt_sql(series: str) -> str:
    """Grid filter by plain recursion over the days of series(poly_id, date_time, v)."""
    return f"""
    WITH RECURSIVE {series},
    v AS MATERIALIZED (SELECT poly_id, date_time, v + 1 AS v, row_number() OVER (PARTITION BY poly_id ORDER BY date_time) AS t FROM series),
    x AS (SELECT i, i / 100e0 AS x FROM range(0, 1201) r(i)),
    kc AS MATERIALIZED (SELECT a.i, b.i AS j, exp(-0.5 * ((a.x - b.x) / 0.25) ** 2) AS k FROM x a, x b),
    k AS MATERIALIZED (SELECT kc.i, exp((any_value(x) - 1) / 5.5e0) AS g, list(k / s ORDER BY j) AS w FROM kc JOIN (SELECT j, sum(k) AS s FROM kc GROUP BY 1) USING (j) JOIN x ON x.i = kc.i GROUP BY kc.i),
    st AS (SELECT poly_id, CAST(1 AS BIGINT) AS t, list_transform(range(0, 1201), lambda i: 1e0 / 1201) AS s FROM (SELECT DISTINCT poly_id FROM v)
        UNION ALL SELECT poly_id, t, list_transform(p, lambda e: e / total) FROM (SELECT poly_id, t, list(u ORDER BY i) AS p, sum(u) AS total FROM (
            SELECT poly_id, t, i, d * exp(l - max(l) OVER (PARTITION BY poly_id)) AS u FROM (
                SELECT st.poly_id, st.t + 1 AS t, k.i, list_inner_product(k.w, st.s) AS d, b.v * ln(a.v * k.g) - a.v * k.g AS l
                FROM st JOIN v a ON a.poly_id = st.poly_id AND a.t = st.t JOIN v b ON b.poly_id = st.poly_id AND b.t = st.t + 1, k)) GROUP BY ALL)),
    p AS (SELECT *, sum(p) OVER (PARTITION BY poly_id, t ORDER BY i) AS c FROM (SELECT poly_id, t, unnest(s) AS p, unnest(range(0, 1201)) AS i FROM st WHERE t > 1)),
    ends AS (SELECT poly_id, t, c, min(i) AS i FROM p GROUP BY ALL),
    w AS (SELECT a.poly_id, a.t, a.i, b.i AS e FROM (SELECT poly_id, t, i, c + 0.5 AS c FROM p) a ASOF JOIN ends b ON a.poly_id = b.poly_id AND a.t = b.t AND a.c < b.c),
    best AS (SELECT poly_id, t, arg_min(i, (e - i, i)) AS lo, arg_min(e, (e - i, i)) AS hi FROM w GROUP BY 1, 2)
    SELECT poly_id, date_time, ml / 100e0 AS ml, lo / 100e0 AS low, hi / 100e0 AS high FROM (SELECT poly_id, t, arg_max(i, (p, -i)) AS ml FROM p GROUP BY 1, 2) JOIN best USING (poly_id, t) JOIN v USING (poly_id, t)"""


@query("rt_by_area", covers="K3 K4 D40 H9")
def _(t):
    return epi.rt_by_area(t.community_cases, t.delays)


@query("rt_overall", _rt_sql(f"""mean AS (SELECT i, avg(p) AS m FROM delays GROUP BY 1),
    onset AS (SELECT date_time - CAST(i AS INTEGER) AS date_time, round_even(sum(n * m), 0) AS n FROM (SELECT date_time, sum(num_cases) AS n FROM cases GROUP BY 1), mean GROUP BY 1 HAVING sum(n * m) >= 1),
    known AS (SELECT i, sum(m) OVER (ORDER BY i) AS c FROM mean),
    adj AS (SELECT date_time, b, round_even(n / nullif(coalesce(c, 1), 0), 0) AS v FROM (SELECT *, row_number() OVER (ORDER BY date_time DESC) AS b FROM onset) LEFT JOIN known ON i = b - 1 WHERE b > 10),
    series AS (SELECT 'aggregated' AS poly_id, date_time, CASE WHEN b <= 20 THEN {_smooth_sql("v")} ELSE v END + 1 AS v FROM adj WINDOW o AS (ORDER BY date_time))"""),
       d="date_time", r="ml low high", covers="K4 K2 D32")
def _(t):
    return epi.rt_overall(t.cases, t.delays)


@query("areas_skipped_for_rt", "SELECT poly_id, sum(num_cases) AS num_cases FROM cases GROUP BY 1 HAVING sum(num_cases) <= 600", covers="K4")
def _(t):
    return epi.enough_cases(t.cases, 600.0)[1]


def _renewal_sql(pairs, prior: float) -> str:
    """CTE ab(sim, poly_id, date_time, a, b). The weights are given; tests integrate the density for them."""
    rows = ", ".join(f"({i}, [{', '.join(f'{w!r}::DOUBLE' for w in np.trim_zeros(epi.serial_weights(m, s, 4000), 'b').tolist())}])" for i, (m, s) in enumerate(pairs))
    return f"""
    sp AS (SELECT poly_id, min(date_time) AS d0 FROM dense_cases GROUP BY 1),
    w AS (SELECT sim, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS lag FROM (VALUES {rows}) v(sim, w)),
    lam AS (SELECT sim, poly_id, date_time + CAST(lag AS INTEGER) AS date_time, sum(num_cases * w) AS lam FROM dense_cases, w GROUP BY 1, 2, 3),
    j AS (SELECT sim, poly_id, date_time, num_cases, lam, date_diff('day', d0, date_time) AS k FROM dense_cases JOIN lam USING (poly_id, date_time) JOIN sp USING (poly_id)),
    ab AS (SELECT sim, poly_id, date_time, 1 + sum(num_cases) OVER g AS a, 1 / (1 / {prior!r}::DOUBLE + sum(lam) OVER g) AS b, k FROM j WINDOW g AS (PARTITION BY sim, poly_id ORDER BY date_time ROWS 6 PRECEDING)
           QUALIFY k >= 7 AND k > (SELECT sum(lag * w) FROM w WHERE w.sim = j.sim))"""


@query("renewal_rt", f"WITH {_renewal_sql([(6.48, 3.83)], 5.0)} SELECT poly_id, date_time, a, b, a * b AS mean_rt, sqrt(a) * b AS std_rt FROM ab", d="date_time", r="a b mean_rt std_rt", covers="K5")
def _(t):
    return epi.renewal_posterior(dense(t), 6.48, 3.83)


@query("renewal_rt_bounds", covers="K5 H9")
def _(t):
    return epi.gamma_bounds(epi.renewal_posterior(dense(t), 6.48, 3.83)).select("poly_id", "date_time", "mean_rt", "q025", "q5", "q975")


INTERVALS = epi.sample_serial_intervals((6.48, 1.0, 2.0, 10.96), (3.83, 0.5, 1.5, 6.16), 10, 11)


@query("sampled_rt_summary", covers="K6 D31")
def _(t):
    draws = epi.sampled_renewal(dense(t), INTERVALS, 20)
    return aggregates.sample_summary(draws, ["poly_id", "date_time"], "sample")


@query("sampled_rt_moments", f"WITH {_renewal_sql(INTERVALS, 4.0)} SELECT poly_id, date_time, avg(a * b) AS mean_rt, avg(a * b * b + a * b * a * b) - avg(a * b) ** 2 AS var_rt FROM ab GROUP BY 1, 2", d="date_time", r="mean_rt var_rt", covers="K6")
def _(t):
    """Mean and variance over all serial intervals that were sampled."""
    return epi.renewal_moments(dense(t), INTERVALS, mean_prior=4.0, std_prior=4.0)


@query("threshold_inputs", f"""
    WITH {VEC}, sp AS (SELECT poly_id, greatest(a0, b0) AS a, least(a1, b1) AS b FROM (SELECT poly_id, min(date_time) AS a0, max(date_time) AS a1 FROM onset GROUP BY 1) JOIN (SELECT poly_id, min(date_time) AS b0, max(date_time) AS b1 FROM crange GROUP BY 1) USING (poly_id)),
         g AS (SELECT poly_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date_time FROM sp),
         x AS (SELECT g.poly_id, g.date_time, coalesce(movement_change, 0) AS movement_change, coalesce(num_cases, 0) AS num_cases FROM g LEFT JOIN crange USING (poly_id, date_time) LEFT JOIN onset USING (poly_id, date_time)),
         y AS (SELECT *, CASE WHEN count(*) OVER w = 7 THEN avg(movement_change) OVER w ELSE 0 END AS m FROM x WINDOW w AS (PARTITION BY poly_id ORDER BY date_time ROWS 6 PRECEDING)),
         z AS (SELECT *, CASE WHEN m = 0 THEN movement_change ELSE m END AS one FROM y),
         u AS (SELECT *, CASE WHEN count(*) OVER w = 7 THEN avg(one) OVER w ELSE 0 END AS m2 FROM z WINDOW w AS (PARTITION BY poly_id ORDER BY date_time ROWS 6 PRECEDING)),
         v AS (SELECT *, CASE WHEN m2 = 0 THEN movement_change ELSE m2 END AS two FROM u)
    SELECT poly_id, date_time, num_cases, (two - min(two) OVER p) / (max(two) OVER p - min(two) OVER p) AS mobility FROM v WINDOW p AS (PARTITION BY poly_id)""", d="date_time", r="mobility", covers="K7 E6 C20")
def _(t):
    return epi.threshold_inputs(t.community_cases, t.community_range, t.delays).select("poly_id", "date_time", "num_cases", "mobility")


@query("mobility_thresholds", covers="K7")
def _(t):
    return epi.mobility_thresholds(epi.threshold_inputs(t.community_cases, t.community_range, t.delays))


def _series_sql(daily: str, lag: int, accum: bool) -> str:
    last = "sum(value) OVER (PARTITION BY poly_id ORDER BY day)" if accum else "value"
    return f"""
    WITH d AS ({daily}), k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY poly_id ORDER BY date_time) > {lag}),
         n AS (SELECT poly_id, date_diff('day', min(date_time) OVER (PARTITION BY poly_id), date_time) AS day, value FROM k),
         g AS (SELECT poly_id, unnest(range(0, max(day) + 1)) AS day FROM n GROUP BY 1),
         f AS (SELECT g.poly_id, g.day, coalesce(value, 0) AS value FROM g LEFT JOIN n USING (poly_id, day)),
         s AS (SELECT *, avg(value) OVER (PARTITION BY poly_id ORDER BY day ROWS 4 PRECEDING) AS m FROM f),
         r AS (SELECT poly_id, day, m + (sum(value) OVER (PARTITION BY poly_id) - sum(m) OVER (PARTITION BY poly_id)) / count(*) OVER (PARTITION BY poly_id) AS value FROM s)
    SELECT poly_id, day, {last} AS value FROM r"""


@query("case_series", _series_sql("SELECT poly_id, date_time, num_cases AS value FROM cases", 3, True), r="value", covers="K8 E1 E2 E9 E14 C16")
def _(t):
    return series.case_series(t.cases, lag=3, smooth_days=5, accum=True)


@query("flow_series", _series_sql("SELECT poly_id, date_time, sum(movement) AS value FROM (SELECT start_poly_id AS poly_id, date_time, movement FROM movement WHERE start_poly_id <> end_poly_id UNION ALL SELECT end_poly_id, date_time, movement FROM movement WHERE start_poly_id <> end_poly_id) GROUP BY 1, 2", 0, False), r="value", covers="K8")
def _(t):
    return series.flow_series(t.movement, "EXTERNAL", smooth_days=5)


@query("flow_series_inside", _series_sql("SELECT start_poly_id AS poly_id, date_time, movement AS value FROM movement WHERE start_poly_id = end_poly_id", 0, False), r="value", covers="K8")
def _(t):
    return series.flow_series(t.movement, "INTERNAL", smooth_days=5)


@query("similar_areas", covers="K9 F2")
def _(t):
    return series.closest_neighbours(t.cases, t.movement, "0", k=None, smooth_days=5)


@query("similar_users", covers="K9")
def _(t):
    """Users whose daily event counts resemble those of the busiest user."""
    daily = t.raw("events").groupBy(F.col("user_id").cast("string").alias("poly_id"), F.col("ts").cast("date").alias("date_time")).agg(F.count("*").cast("double").alias("num_cases"))
    s = cut_lineage(series.case_series(daily, smooth_days=2))
    top = s.groupBy("poly_id").agg(F.sum("value").alias("v")).orderBy(F.col("v").desc(), "poly_id").first()["poly_id"]
    return series.series_distance(s, top, stretch=30)


PIECES = """SELECT event_type, k AS piece, d AS date, sqrt(CAST(n AS DOUBLE)) * (1 + 0.37e0 * k) AS value FROM (SELECT event_type, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1, 2), (SELECT max(CAST(ts AS DATE)) AS last FROM events), range(0, 6) t(k)
        WHERE date_diff('day', d, last) BETWEEN 6 * k AND 6 * k + 9"""


@query("stitched_series", f"""
    WITH p AS ({PIECES}), st AS (SELECT a.event_type, a.piece, max(b.value) / max(a.value) AS step FROM p a JOIN p b ON b.event_type = a.event_type AND b.piece = a.piece - 1 AND b.date = a.date GROUP BY 1, 2),
         f AS (SELECT event_type, piece, exp(sum(ln(step)) OVER (PARTITION BY event_type ORDER BY piece)) AS factor FROM st),
         m AS (SELECT event_type, date, avg(value * coalesce(factor, 1)) AS v, count(*) > 1 AS overlap FROM p LEFT JOIN f USING (event_type, piece) GROUP BY 1, 2)
    SELECT event_type, date, round_even(100 * v / max(v) OVER (PARTITION BY event_type), 0) AS value, overlap FROM m""", d="date", i="overlap", covers="K25")
def _(t):
    e = t.raw("events").groupBy("event_type", F.col("ts").cast("date").alias("date")).agg(F.count("*").alias("n"))
    last = e.agg(F.max("date").alias("last"))
    off = F.datediff("last", "date")
    ks = F.filter(F.sequence(F.lit(0), F.lit(5)), lambda k: off.between(6 * k, 6 * k + 9))
    pieces = e.join(last).withColumn("piece", F.explode(ks))  # one-row side
    pieces = pieces.select("event_type", "piece", "date", (F.sqrt("n") * (1 + 0.37 * F.col("piece"))).alias("value"))
    return series.stitch_pieces(pieces, ["event_type"])


@query("daily_from_hours", """
    SELECT event_type, date, value FROM (SELECT event_type, CAST(ts AS DATE) AS date, sum(value) AS value, count(DISTINCT hour(ts)) AS h, min(CAST(ts AS DATE)) OVER (PARTITION BY event_type) AS f FROM events GROUP BY 1, 2, ts::DATE)
    WHERE date > f OR h = 24""".replace("min(CAST(ts AS DATE)) OVER (PARTITION BY event_type)", "min(min(CAST(ts AS DATE))) OVER (PARTITION BY event_type)").replace("GROUP BY 1, 2, ts::DATE", "GROUP BY 1, 2"), d="date", r="value", covers="K25")
def _(t):
    return series.daily_from_hours(t.raw("events"), ["event_type"], "ts", "value")
