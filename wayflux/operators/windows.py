"""Window operators. Every window is over one area's daily rows, bounded by the calendar."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from wayflux.operators.ranking import running_total


def _by(keys: list[str]) -> W:
    return W.partitionBy(*keys)


def trailing(keys: list[str], order: str, rows: int):
    return _by(keys).orderBy(order).rowsBetween(-(rows - 1), 0)


def smooth_curve(df: DataFrame, keys: list[str], order: str, col: str, days: int) -> DataFrame:
    """Trailing mean, shifted by a constant so that the series keeps its total."""
    mean = df.withColumn("_s", F.avg(col).over(trailing(keys, order, days)))
    whole = _by(keys)
    shift = (F.sum(col).over(whole) - F.sum("_s").over(whole)) / F.count("*").over(whole)
    return mean.withColumn(col, F.col("_s") + shift).drop("_s")


def accumulate(df: DataFrame, keys: list[str], order: str, col: str, out: str) -> DataFrame:
    w = _by(keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(col).over(w))


def gaussian_mean(keys: list[str], order: str, col: str, rows: int = 7, std: float = 2.0) -> Column:
    """Centred weighted mean; at the ends only the rows present count. Rounded half to even."""
    half, w = rows // 2, _by(keys).orderBy(order)
    top, bottom = F.lit(0.0), F.lit(0.0)
    for k in range(-half, half + 1):
        weight = math.exp(-0.5 * (k / std) ** 2)
        x = F.col(col) if k == 0 else F.lag(col, -k).over(w)
        top = top + F.coalesce(x * weight, F.lit(0.0))
        bottom = bottom + F.when(x.isNotNull(), weight).otherwise(0.0)
    return F.bround(top / bottom, 0)


def change_from_start(df: DataFrame, keys: list[str], order: str, col: str, out: str, days: int = 5) -> DataFrame:
    """Percent difference to the mean of the first rows, then its trailing mean."""
    rn = F.row_number().over(_by(keys).orderBy(order))
    base = F.avg(F.when(F.col("_rn") <= days, F.col(col))).over(_by(keys))
    pct = 100 * (F.col(col) - F.col("_b")) / F.nullif(F.col("_b"), F.lit(0.0))
    return (
        df.withColumn("_rn", rn).withColumn("_b", base).withColumn("_p", pct)
        .withColumn(out, F.avg("_p").over(trailing(keys, order, days))).drop("_rn", "_b", "_p")
    )


def full_trailing_mean(keys: list[str], order: str, col: str, rows: int = 5) -> Column:
    w = trailing(keys, order, rows)
    return F.when(F.count(col).over(w) == rows, F.avg(col).over(w))


def two_pass_mean(df: DataFrame, keys: list[str], order: str, col: str, out: str, rows: int = 7) -> DataFrame:
    """Two trailing means with the raw value where a mean is missing or 0, then scaled to 0..1."""
    def once(name):
        m = F.coalesce(full_trailing_mean(keys, order, name, rows), F.lit(0.0))
        return F.when(m == 0, F.col(col)).otherwise(m)

    lo, hi = F.min("_2").over(_by(keys)), F.max("_2").over(_by(keys))
    return (
        df.withColumn("_1", once(col)).withColumn("_2", once("_1"))
        .withColumn(out, (F.col("_2") - lo) / F.nullif(hi - lo, F.lit(0.0))).drop("_1", "_2")
    )


def undo_cumulative(keys: list[str], order: str, col: str, clip: bool = False) -> Column:
    """Difference to the previous row, the first row kept; negatives to 0 on request."""
    d = F.col(col) - F.coalesce(F.lag(col).over(_by(keys).orderBy(order)), F.lit(0.0))
    return F.greatest(d, F.lit(0.0)) if clip else d


def repair_cumulative(df: DataFrame, keys: list[str], order: str, col: str, variant: str) -> DataFrame:
    """Iterated midpoint repair of falling cumulative counts, one series at a time.

    Variants: 'midpoint' (mean of the neighbours), 'midpoint_or_next' (the next value when
    the midpoint changes nothing) and 'look_ahead' (lift the low value when the one after
    allows it). The pass over a series is order-dependent, so it runs per series in Arrow;
    a pass begins before the first value that the last one changed. The first value is never
    changed. Where the rule comes back to a state it had before, it would never settle: what
    still falls is then lifted to the largest value before it, the first value aside.
    """
    schema = df.schema

    def lifted(v: list[float], i: int) -> tuple[int, float]:
        middle = math.floor((v[i - 1] + v[i + 1]) / 2)
        if variant == "look_ahead" and i + 2 < len(v) and v[i] <= v[i + 2]:
            return i + 1, math.floor((v[i] + v[i + 2]) / 2)
        if variant == "midpoint_or_next" and middle == v[i]:
            return i, v[i + 1]
        return i, middle

    def fix(v: list[float]) -> list[float]:
        start, passes, seen, check = 1, 0, list(v), 1
        while True:
            falls = 0
            for i in range(start, len(v) - 1):
                if v[i] > v[i + 1]:
                    if not falls:
                        first = i
                    falls += 1
                    at, value = lifted(v, i)
                    v[at] = value
            if not falls:
                return v
            start, passes = max(1, first - 1), passes + 1
            if v == seen:
                return v[:1] + np.maximum.accumulate(v[1:]).tolist()
            if passes == check:  # a cycle of any length shows once the kept state lies on it
                seen, check = list(v), 2 * check

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        pdf[col] = fix(pdf[col].astype(float).tolist())
        return pdf

    return df.groupBy(*keys).applyInPandas(run, schema)


def monotone_envelope(keys: list[str], order: str, col: str) -> Column:
    """Largest non-falling curve under the series: minimum of all later values."""
    return F.min(col).over(_by(keys).orderBy(order).rowsBetween(0, W.unboundedFollowing))


def day_index(keys: list[str], date: str) -> Column:
    return F.datediff(F.col(date), F.min(date).over(_by(keys))).cast("bigint")


def coverage(df: DataFrame, value: str, tie: str, share: float = 0.8) -> DataFrame:
    """Rows in falling order until they cover `share` of the total, plus one more row.

    Sums go over ranges of rows, so no task sees all of them.
    """
    summed = running_total(df.withColumn("_s", -F.col(value)), value, ["_s", tie])
    # rows at or under the share, the one that passes it, and one more: what comes before a row counts
    total = F.nullif("total", F.lit(0))
    return summed.filter(F.coalesce(F.col("earlier") / total, F.lit(0.0)) <= share).select(*df.columns, (F.col("running") / total).alias("coverage"))


def lag_features(df: DataFrame, keys: list[str], order: str, cols: dict[str, str], days_back: int) -> DataFrame:
    """Columns {name}_{k} with the value k rows before, k = 1..days_back."""
    w = _by(keys).orderBy(order)
    return df.select("*", *[F.lag(c, k).over(w).alias(f"{name}_{k}") for k in range(1, days_back + 1) for name, c in cols.items()])


def lead_target(keys: list[str], order: str, col: str, ahead: int) -> Column:
    return F.lead(col, ahead).over(_by(keys).orderBy(order))


def drop_first(df: DataFrame, keys: list[str], order: str, lag: int) -> DataFrame:
    if lag <= 0:
        return df
    return df.withColumn("_rn", F.row_number().over(_by(keys).orderBy(order))).filter(F.col("_rn") > lag).drop("_rn")


def window_deltas(df: DataFrame, pairs: dict[str, tuple[str, str]], fill: bool = True) -> DataFrame:
    """Relative change (later - earlier) / earlier; a missing change counts as 0 on request."""
    out = {name: (F.col(b) - F.col(a)) / F.nullif(F.col(a), F.lit(0.0)) for name, (a, b) in pairs.items()}
    df = df.withColumns(out)
    return df.na.fill(0.0, subset=list(out)) if fill else df


def anchor_means(df: DataFrame, anchors: DataFrame, keys: list[str], value: str, half: int = 7, total: int = 14) -> DataFrame:
    """Means over the sliding window around each anchor day, held at full width at both ends.

    Back: max(half, total - (last - day)); ahead: max(half, total - (day - first)).
    """
    span = df.agg(F.min("date_time").alias("_a"), F.max("date_time").alias("_b"))
    ahead = F.greatest(F.lit(half), total - F.datediff("anchor", "_a"))
    back = F.greatest(F.lit(half), total - F.datediff("_b", "anchor"))
    days = anchors.join(span).select("anchor", F.explode(F.sequence(F.date_sub("anchor", back), F.date_add("anchor", ahead))).alias("date_time"))
    return df.join(days, "date_time").groupBy("anchor", *keys).agg(F.avg(value).alias(value))
