"""Time series of areas, similar-series search, stitching of overlapping pieces."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from wayflux.operators import windows


def _dense_days(daily: DataFrame, keys: list[str], lag: int, smooth_days: int, accum: bool) -> DataFrame:
    """Day index from the first kept row, missing days 0, smoothed, accumulated on request."""
    kept = windows.drop_first(daily, keys, "date_time", lag)
    days = kept.withColumn("day", windows.day_index(keys, "date_time"))
    grid = days.groupBy(*keys).agg(F.max("day").alias("_m")).select(*keys, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_m"))).alias("day"))
    full = grid.join(days.select(*keys, "day", "value"), [*keys, "day"], "left").na.fill(0.0, subset=["value"])
    out = windows.smooth_curve(full, keys, "day", "value", smooth_days)
    return windows.accumulate(out, keys, "day", "value", "value") if accum else out


def case_series(cases: DataFrame, lag: int = 0, smooth_days: int = 1, accum: bool = False, keys: list[str] | None = None) -> DataFrame:
    """Series of new cases per area: (keys, day, value)."""
    keys = keys or ["poly_id"]
    daily = cases.groupBy(*keys, "date_time").agg(F.sum("num_cases").alias("value"))
    return _dense_days(daily, keys, lag, smooth_days, accum)


def flow_series(flows: DataFrame, kind: str = "BOTH", lag: int = 0, smooth_days: int = 1, accum: bool = False) -> DataFrame:
    """Series of flow per area: inside it, across its border, or both."""
    own = F.col("start_poly_id") == F.col("end_poly_id")
    kinds = {"INTERNAL": own, "EXTERNAL": ~own, "BOTH": F.lit(True)}
    if kind.upper() not in kinds:
        raise ValueError(f"no support for movement type: {kind}")
    ends = F.array_distinct(F.array("start_poly_id", "end_poly_id"))
    daily = (
        flows.filter(kinds[kind.upper()])
        .select("date_time", F.explode(ends).alias("poly_id"), "movement")
        .groupBy("poly_id", "date_time").agg(F.sum("movement").alias("value"))
    )
    return _dense_days(daily, ["poly_id"], lag, smooth_days, accum)


def warp_distance(a: np.ndarray, b: np.ndarray) -> float:
    """Dynamic time warping with absolute differences, by anti-diagonals."""
    n, m = len(a), len(b)
    if n == 0 or m == 0:
        return float("inf")
    prev2 = np.full(n + 1, np.inf)
    prev = np.full(n + 1, np.inf)
    prev2[0] = 0.0  # cell (0, 0)
    for d in range(2, n + m + 1):
        lo, hi = max(1, d - m), min(n, d - 1)
        i = np.arange(lo, hi + 1)
        cost = np.abs(a[i - 1] - b[d - i - 1])
        cur = np.full(n + 1, np.inf)
        cur[i] = cost + np.minimum(np.minimum(prev[i - 1], prev[i]), prev2[i - 1])
        prev2, prev = prev, cur
    return float(prev[n])


def series_distance(series: DataFrame, target: str, key: str = "poly_id", start_day: int = 0, stretch: int = 3) -> DataFrame:
    """Warping distance of every series to the target's, over the target's days.

    Series whose length differs by more than `stretch` get no distance (infinite). One row
    per series travels; the target is a single row.
    """
    cut = series.filter(F.col("day") >= start_day)
    aim = (
        cut.filter(F.col(key) == target)
        .agg(F.array_sort(F.collect_list(F.struct("day", "value"))).alias("s"), F.max("day").alias("last"), F.sum("value").alias("total"))
        .select(F.transform("s", lambda x: x["value"]).alias("_aim"), F.col("last").alias("_last"), F.col("total").alias("_total"))
    )
    others = (
        cut.filter(F.col(key) != target)
        .join(aim.select("_last"), F.col("day") <= F.col("_last"))  # one-row side
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("day", "value"))).alias("s"), F.max("day").alias("max_day"), F.sum("value").alias("_sum"))
        .select(key, F.transform("s", lambda x: x["value"]).alias("_vals"), "max_day", "_sum")
    )

    @F.pandas_udf("double")
    def warp(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([warp_distance(np.asarray(x, float), np.asarray(y, float)) for x, y in zip(a, b)])

    near = F.abs(F.size("_vals") - F.size("_aim")) <= stretch
    pairs = others.crossJoin(aim)  # one-row side
    close = pairs.filter(near).withColumn("dist", warp("_aim", "_vals") / F.col("_total"))
    far = pairs.filter(~near).withColumn("dist", F.lit(float("inf")))
    return close.unionByName(far).select(key, "dist", "max_day", F.abs(F.col("_total") - F.col("_sum")).alias("total_dif"))


def closest_neighbours(cases: DataFrame, flows: DataFrame | None, target: str, k: int | None = None, start_day: int = 0, lag: int = 0, stretch: int = 3, smooth_days: int = 1) -> DataFrame:
    """Areas most like the target by cases and flow together; by cases alone without flows."""
    by_cases = series_distance(case_series(cases, lag, smooth_days), target, "poly_id", start_day, stretch)
    c = by_cases.select("poly_id", F.col("dist").alias("cases_dist"), F.col("total_dif").alias("total_dif_cases"), F.col("max_day").alias("max_day_cases"))
    if flows is None:
        out = c.withColumn("dist", F.col("cases_dist"))
    else:
        by_flow = series_distance(flow_series(flows, "BOTH", lag, smooth_days), target, "poly_id", start_day, stretch)
        m = by_flow.select("poly_id", F.col("dist").alias("mov_dist"), F.col("total_dif").alias("total_dif_mov"), F.col("max_day").alias("max_day_mov"))
        out = c.join(m, "poly_id").withColumn("dist", F.col("mov_dist") + F.col("cases_dist"))
    out = out.orderBy("dist", "poly_id")
    return out if k is None or k <= 0 else out.limit(k)


def stitch_pieces(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """One series out of overlapping pieces, each scaled to the piece before it.

    pieces(keys, piece, date, value); piece 0 is the latest. The factor of a piece is the
    ratio of overlap maxima times the factor of the piece before; overlaps are averaged and
    the largest value becomes 100.
    """
    prev = pieces.select(*keys, (F.col("piece") + 1).alias("piece"), "date", F.col("value").alias("_before"))
    steps = (
        pieces.join(prev, [*keys, "piece", "date"])
        .groupBy(*keys, "piece")
        .agg((F.max("_before") / F.nullif(F.max("value"), F.lit(0.0))).alias("step"))
    )
    chain = W.partitionBy(*keys).orderBy("piece")  # one row per piece
    factors = steps.select(*keys, "piece", F.product("step").over(chain).alias("factor"))
    scaled = pieces.join(factors, [*keys, "piece"], "left").withColumn("value", F.col("value") * F.coalesce("factor", F.lit(1.0)))
    mean = scaled.groupBy(*keys, "date").agg(F.avg("value").alias("value"), (F.count("*") > 1).alias("overlap"))
    top = mean.groupBy(*keys).agg(F.max("value").alias("_top"))
    return mean.join(top, keys).select(*keys, "date", F.bround(100 * F.col("value") / F.col("_top"), 0).alias("value"), "overlap")


def daily_from_hours(hourly: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Daily sums of hourly values; a first day with fewer than 24 hours is left out."""
    daily = hourly.groupBy(*keys, F.to_date(ts).alias("date")).agg(F.sum(value).alias("value"), F.count_distinct(F.hour(ts)).alias("_h"))
    first = daily.groupBy(*keys).agg(F.min("date").alias("_first"))
    return daily.join(first, keys).filter((F.col("date") > F.col("_first")) | (F.col("_h") == 24)).select(*keys, "date", "value")
