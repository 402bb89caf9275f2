"""Onset series, reproductive numbers and mobility thresholds.

Daily rows per area are made in Spark; Arrow functions see one area's days at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayflux.functions import special
from wayflux.functions.vectors import pad_with, running_sum
from wayflux.operators import windows
from wayflux.operators.joins import densify, overlap_span


def mean_delay(delays: DataFrame) -> DataFrame:
    """Position-wise mean of all delay vectors, as one row."""
    each = delays.select(F.posexplode("p_delay").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"))
    return each.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("mean_delay"))


def delay_for(areas: DataFrame, delays: DataFrame, shortest: int = 30) -> DataFrame:
    """Delay vector of each area, its first entry 0; short or missing ones take the mean."""
    own = F.when(F.size("p_delay") >= shortest, F.concat(F.array(F.lit(0.0)), F.slice("p_delay", F.lit(2), F.size("p_delay") - 1)))
    return (
        areas.select("poly_id").distinct().join(delays, "poly_id", "left")
        .crossJoin(mean_delay(delays))  # one-row side
        .select("poly_id", F.coalesce(own, "mean_delay").alias("p_delay"))
    )


def confirmed_to_onset(cases: DataFrame, delays: DataFrame, key: str = "poly_id", least: float = 1.0) -> DataFrame:
    """Counts moved back by the delay distribution; days under `least` are left out, then rounded.

    The vector is exploded next to each daily row and summed at once, so the shuffle sees
    one partial sum per area and day.
    """
    spread = cases.join(delays, key).select(
        key, "date_time", "num_cases", F.posexplode("p_delay").alias("k", "p")
    )
    onset = spread.groupBy(key, F.date_sub("date_time", F.col("k")).alias("date_time")).agg(
        F.sum(F.col("num_cases") * F.col("p")).alias("num_cases")
    )
    return onset.filter(F.col("num_cases") >= least).withColumn("num_cases", F.bround("num_cases", 0))


def adjust_right_censoring(onset: DataFrame, delays: DataFrame, key: str = "poly_id") -> DataFrame:
    """Latest rows divided by the share of their cases already known."""
    back = F.row_number().over(W.partitionBy(key).orderBy(F.col("date_time").desc()))
    known = delays.select(key, running_sum(F.col("p_delay")).alias("_c"))
    share = F.coalesce(F.get("_c", F.col("_b") - 1), F.lit(1.0))
    return (
        onset.withColumn("_b", back).join(known, key)
        .withColumn("num_cases_adjusted", F.col("num_cases") / F.nullif(share, F.lit(0.0)))
        .drop("_b", "_c")
    )


def prepare_cases(df: DataFrame, col: str = "num_cases", key: str = "poly_id") -> DataFrame:
    return df.withColumn(f"smoothed_{col}", windows.gaussian_mean([key], "date_time", col))


def rt_posteriors(series: np.ndarray, gamma: float = 1 / 5.5, sigma: float = 0.25, r_max: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Grid of candidate values and the posterior of each day after the first (rows = days)."""
    grid = np.linspace(0, r_max, r_max * 100 + 1)
    kernel = np.exp(-0.5 * ((grid[:, None] - grid[None, :]) / sigma) ** 2)
    kernel /= kernel.sum(axis=0)
    growth = np.exp(gamma * (grid - 1))
    state = np.full(len(grid), 1 / len(grid))
    out = np.empty((len(series) - 1, len(grid)))
    for t in range(1, len(series)):
        log_lik = special.log_poisson(series[t], series[t - 1] * growth)
        state = (kernel @ state) * np.exp(log_lik - log_lik.max())
        state /= state.sum()
        out[t - 1] = state
    return grid, out


def shortest_interval(grid: np.ndarray, mass: np.ndarray, share: float) -> tuple[float, float]:
    """Shortest grid interval whose mass exceeds the share."""
    total = np.cumsum(mass)
    ends = np.searchsorted(total, total + share, side="right")
    ok = ends < len(grid)
    if not ok.any():
        return float("nan"), float("nan")
    width = np.where(ok, ends - np.arange(len(grid)), len(grid) + 1)
    best = int(width.argmin())
    return float(grid[best]), float(grid[ends[best]])


RT_SCHEMA = "poly_id string, date_time date, ml double, low double, high double"


def estimate_rt(series: DataFrame, col: str, share: float = 0.5) -> DataFrame:
    """Most likely reproductive number per area and day with its shortest interval.

    The recursion runs along days, so an area is one unit of work; areas run in parallel.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date_time")
        if len(pdf) < 2:
            return pd.DataFrame({"poly_id": [], "date_time": [], "ml": [], "low": [], "high": []})
        grid, post = rt_posteriors(pdf[col].to_numpy(float) + 1)
        bounds = [shortest_interval(grid, row, share) for row in post]
        return pd.DataFrame({
            "poly_id": pdf["poly_id"].iloc[1:].to_numpy(), "date_time": pdf["date_time"].iloc[1:].to_numpy(),
            "ml": grid[post.argmax(axis=1)], "low": [b[0] for b in bounds], "high": [b[1] for b in bounds],
        })

    return series.select("poly_id", "date_time", col).groupBy("poly_id").applyInPandas(run, RT_SCHEMA)


def enough_cases(cases: DataFrame, least: float = 100.0) -> tuple[DataFrame, DataFrame]:
    """Areas with more cases than the limit, and the list of those skipped."""
    total = cases.groupBy("poly_id").agg(F.sum("num_cases").alias("n"))
    kept = cases.join(total.filter(F.col("n") > least).select("poly_id"), "poly_id", "left_semi")
    return kept, total.filter(F.col("n") <= least).select("poly_id", F.col("n").alias("num_cases"))


def rt_by_area(cases: DataFrame, delays: DataFrame, least: float = 100.0) -> DataFrame:
    """Per-area run: onset by its own delay (mean as fallback), smoothing, grid estimate."""
    daily = cases.groupBy("poly_id", "date_time").agg(F.sum("num_cases").alias("num_cases"))
    kept, _ = enough_cases(daily, least)
    onset = confirmed_to_onset(kept, delay_for(kept, delays))
    return estimate_rt(prepare_cases(onset).withColumn("v", F.col("smoothed_num_cases") + 1), "v")


def rt_overall(cases: DataFrame, delays: DataFrame, cut_days: int = 10, least: float = 100.0) -> DataFrame:
    """All areas together: mean delay, censorship corrected, the last days left out."""
    daily = cases.groupBy(F.lit("aggregated").alias("poly_id"), "date_time").agg(F.sum("num_cases").alias("num_cases"))
    kept, _ = enough_cases(daily, least)
    vec = mean_delay(delays).select(F.lit("aggregated").alias("poly_id"), F.col("mean_delay").alias("p_delay"))
    adj = adjust_right_censoring(confirmed_to_onset(kept, vec), vec)
    back = F.row_number().over(W.partitionBy("poly_id").orderBy(F.col("date_time").desc()))
    trimmed = adj.withColumn("_b", back).filter(F.col("_b") > cut_days).withColumn("v", F.bround("num_cases_adjusted", 0))
    late = prepare_cases(trimmed, "v")
    last_rows = F.col("_b") <= 2 * cut_days
    return estimate_rt(late.withColumn("v", F.when(last_rows, F.col("smoothed_v")).otherwise(F.col("v")) + 1), "v")


def serial_weights(mean: float, std: float, days: int) -> np.ndarray:
    """Discretised shifted gamma of the serial interval for lags 0 to days - 1."""
    a, b = ((mean - 1) / std) ** 2, std**2 / (mean - 1)
    k = np.arange(days, dtype=float)
    # second difference of the integrated distribution function
    area = k * special.gamma_cdf(k, a, b) - a * b * special.gamma_cdf(k, a + 1, b)
    prev = np.concatenate([[0.0], area[:-1]])
    prev2 = np.concatenate([[0.0, 0.0], area[:-2]])[:days]
    gone = 1 - special.gamma_cdf(np.maximum(k - 2, 0), a, b) < 1e-14  # only rounding is left there
    return np.where(gone, 0.0, np.maximum(area - 2 * prev + prev2, 0.0))


def convolved(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sum over lags of weight times the value that many days before, for every day."""
    n = 1 << max(0, (2 * len(x) - 1).bit_length())
    if len(x) < 256:
        return np.convolve(x, w)[: len(x)]
    return np.fft.irfft(np.fft.rfft(x, n) * np.fft.rfft(w, n), n)[: len(x)]


def renewal(cases: DataFrame, pairs: list[tuple[float, float]], schema: str, days: Callable[..., pd.DataFrame], win_start: int = 1, win_end: int = 7, mean_prior: float = 5.0, std_prior: float = 5.0) -> DataFrame:
    """`days(poly_id, sim, dates, a, b)` of every area and serial interval (mean, deviation) in `pairs`.

    cases(poly_id, date_time, num_cases) with one row per day. An area's days are one ordered array, which the calendar
    bounds; weights run to its length, and infectivity is one convolution per area and interval. Those are dealt
    to tasks one by one. a and b are the shape and scale of the gamma posterior of the reproductive number over the days
    of each window.
    """
    ordered = F.array_sort(F.collect_list(F.struct("date_time", F.col("num_cases").cast("double").alias("num_cases"))))
    series = cases.groupBy("poly_id").agg(ordered.alias("s"))
    each = series.select("poly_id", F.col("s.date_time").alias("dates"), F.col("s.num_cases").alias("counts"), F.explode(F.sequence(F.lit(0), F.lit(len(pairs) - 1))).alias("sim"))
    a0, b0, width = (mean_prior / std_prior) ** 2, std_prior**2 / mean_prior, win_end - win_start + 1

    def windowed(x: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(x)])
        at = np.arange(1, len(x) + 1)
        return total[at] - total[np.maximum(at - width, 0)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for poly, dates, counts, sim in zip(pdf["poly_id"], pdf["dates"], pdf["counts"], pdf["sim"], strict=True):
                n = np.asarray(counts, float)
                w = serial_weights(*pairs[sim], len(n))
                end = (pd.to_datetime(pd.Series(dates)) - pd.Timestamp(dates[0])).dt.days.to_numpy()
                kept = (end >= win_end) & (end > (np.arange(len(w)) * w).sum())
                a, b = a0 + windowed(n), 1 / (1 / b0 + windowed(convolved(n, w)))
                if kept.any():
                    yield days(poly, int(sim), np.asarray(dates)[kept], a[kept], b[kept])

    return each.repartition("poly_id", "sim").mapInPandas(run, schema)


def renewal_posterior(
    cases: DataFrame, mean: float, std: float, win_start: int = 1, win_end: int = 7, mean_prior: float = 5.0, std_prior: float = 5.0
) -> DataFrame:
    """Gamma posterior of the reproductive number over sliding windows: a, b, mean and deviation."""
    def days(poly, sim, dates, a, b):
        return pd.DataFrame({"poly_id": poly, "date_time": dates, "a": a, "b": b, "mean_rt": a * b, "std_rt": np.sqrt(a) * b})

    return renewal(cases, [(mean, std)], "poly_id string, date_time date, a double, b double, mean_rt double, std_rt double", days, win_start, win_end, mean_prior, std_prior)


def renewal_moments(cases: DataFrame, pairs: list[tuple[float, float]], **settings) -> DataFrame:
    """Mean and variance of the reproductive number over the posteriors of all serial intervals."""
    def days(poly, sim, dates, a, b):
        return pd.DataFrame({"poly_id": poly, "date_time": dates, "m": a * b, "v": a * b * b})

    each = renewal(cases, pairs, "poly_id string, date_time date, m double, v double", days, **settings)
    return each.groupBy("poly_id", "date_time").agg(F.avg("m").alias("mean_rt"), (F.avg(F.col("v") + F.col("m") * F.col("m")) - F.avg("m") * F.avg("m")).alias("var_rt"))


def gamma_bounds(df: DataFrame, probs: tuple[float, ...] = (0.025, 0.5, 0.975)) -> DataFrame:
    """Quantiles of each row's gamma posterior."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def bounds(a: pd.Series, b: pd.Series) -> pd.Series:
        cols = [special.gamma_quantile(p, a.to_numpy(float), b.to_numpy(float)) for p in probs]
        return pd.Series(list(np.array(cols).T))

    q = df.withColumn("_q", bounds("a", "b"))
    return q.select("*", *[F.col("_q")[i].alias(f"q{str(p)[2:]}") for i, p in enumerate(probs)]).drop("_q")


def sample_serial_intervals(mean: tuple[float, float, float, float], std: tuple[float, float, float, float], n: int, seed: int) -> list[tuple[float, float]]:
    """Seeded (mean, deviation) pairs from two truncated normals given as (mean, std, min, max)."""
    rng = np.random.default_rng(seed)

    def draw(m, s, lo, hi):
        out = []
        while len(out) < n:
            x = rng.normal(m, s, size=4 * n)
            out.extend(x[(x >= lo) & (x <= hi)].tolist())
        return out[:n]

    return list(zip(draw(*mean), draw(*std)))


def sampled_renewal(
    cases: DataFrame, pairs: list[tuple[float, float]], draws: int = 20, seed: int = 7, win_start: int = 1, win_end: int = 7,
    mean_prior: float = 4.0, std_prior: float = 4.0,
) -> DataFrame:
    """Posterior draws over all sampled serial intervals: (poly_id, date_time, sample).

    Draws are seeded by the area and the interval, so they are the same however the work is dealt out.
    """
    def days(poly, sim, dates, a, b):
        rng = np.random.default_rng([seed, sim, *str(poly).encode()])
        return pd.DataFrame({"poly_id": poly, "date_time": np.repeat(dates, draws), "sample": rng.gamma(a[:, None], b[:, None], (len(a), draws)).ravel()})

    return renewal(cases, pairs, "poly_id string, date_time date, sample double", days, win_start, win_end, mean_prior, std_prior)


THRESHOLD_SCHEMA = "poly_id string, r0 double, beta double, mob_th double"


def _interval_mass(a: np.ndarray, k: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Log likelihood of each row of growth numerators a, the serial interval (Gamma(6, rate 1.5)) integrated out.

    Over w, the log of the rate 1 / interval: Newton steps to the mode, then the trapezoid rule over eight deviations
    on both sides, from the curvature there.
    """
    slope = (k * a).sum(axis=1)

    def value(w):
        with np.errstate(over="ignore", invalid="ignore"):
            out = np.exp(w) * slope - (base * np.exp(a * np.exp(w)[:, None])).sum(axis=1) - 6 * w - 1.5 * np.exp(-w)
        return np.where(np.isfinite(out), out, -np.inf)

    w = np.log(np.minimum(0.25, 50 / np.maximum(a.max(axis=1), 1e-9)))  # where nothing overflows
    best = value(w)
    for _ in range(60):
        v = np.exp(w)
        e = base * np.exp(a * v[:, None])
        pull = v * (slope - (a * e).sum(axis=1))
        g, h = pull - 6 + 1.5 * np.exp(-w), pull - v * v * (a * a * e).sum(axis=1) - 1.5 * np.exp(-w)
        step = np.clip(np.where(h < 0, -g / np.where(h < 0, h, -1.0), np.sign(g) * 0.5), -1.0, 1.0)
        width = 1 / np.sqrt(np.maximum(-h, 1e-12))
        if (np.abs(step) < 1e-3 * width).all():
            break
        for _ in range(12):  # halve what does not rise
            now = value(w + step)
            worse = now < best
            if not worse.any():
                break
            step = np.where(worse, step / 2, step)
        w, best = np.where(now >= best, w + step, w), np.maximum(now, best)
    z = np.linspace(-7, 7, 25)
    lp = np.stack([value(w + width * x) for x in z], axis=1) - best[:, None]
    return best + np.log(np.exp(lp).sum(axis=1) * (z[1] - z[0]) * width)


def _resolved(f: Callable[[np.ndarray], np.ndarray], low: float, high: float, nodes: int) -> tuple[float, float, float]:
    """The part of [low, high] that holds the mass of exp(f), e^-40 of its top left out, and the top."""
    while True:
        x = np.linspace(low, high, nodes)
        y = f(x)
        held = np.flatnonzero(y > y.max() - 40)
        a, b = x[max(held[0] - 1, 0)], x[min(held[-1] + 1, nodes - 1)]
        if b - a > 0.6 * (high - low) or high - low < 1e-12:
            return float(a), float(b), float(y.max())
        low, high = float(a), float(b)


def _panels(f: Callable[[np.ndarray], np.ndarray], low: float, high: float, tolerance: float, start: int) -> np.ndarray:
    """Integral of the vector function f (rows: points), halving panels of Gauss-Legendre nodes until halves agree."""
    x, w = np.polynomial.legendre.leggauss(8)

    def panel(a, b):
        return (f((a + b) / 2 + (b - a) / 2 * x) * w[:, None]).sum(axis=0) * (b - a) / 2

    edges = np.linspace(low, high, start + 1)
    todo = [(a, b, panel(a, b)) for a, b in zip(edges, edges[1:])]
    scale, done = sum(abs(p[2][0]) for p in todo), 0.0
    while todo:
        a, b, whole = todo.pop()
        middle = (a + b) / 2
        left, right = panel(a, middle), panel(middle, b)
        scale = max(scale, abs(left[0] + right[0]))
        if np.abs(left[:1] + right[:1] - whole[:1]).max() <= tolerance * scale or b - a < 1e-9:
            done = done + left + right
        else:
            todo += [(a, middle, left), (middle, b, right)]
    return done


def fit_threshold(mob: np.ndarray, onset: np.ndarray) -> tuple[float, float]:
    """Posterior means of (beta, R0), the serial interval integrated out.

    beta ~ U(-100, 100), R0 ~ U(2, 5), serial interval ~ Gamma(6, rate 1.5). Nested integrals, each scaled to where its
    mass lies: over the interval by Newton and curvature, over R0 (through r = ln R0 - beta (1 + mean mobility), which the
    data fix nearly on its own) and over beta by panels that are halved until they agree. So the result is as
    exact for ten thousand cases a day as for one.
    """
    k, base, m = np.round(onset[1:]), onset[:-1], mob[:-1]
    centre = m.mean()

    def held(beta: float) -> tuple[Callable[[np.ndarray], np.ndarray], float, tuple[float, float, float]]:
        """Log mass over r at one beta, the shift from r to ln R0, and where the mass lies."""
        shift = beta * (1 + centre)

        def mass(r):
            with np.errstate(over="ignore"):
                a = np.exp(r[:, None] - beta * (m - centre)[None, :]) - 1
            return _interval_mass(np.minimum(a, 1e6), k, base) + r + shift

        return mass, shift, _resolved(mass, math.log(2) - shift, math.log(5) - shift, 17)

    def given_beta(beta: float) -> tuple[float, float]:
        """Log mass and mean R0 at one beta."""
        mass, shift, (low, high, best) = held(beta)

        x, w = np.polynomial.legendre.leggauss(16)  # the mass spans some nine deviations of either half
        quarter = (high - low) / 4
        r = np.concatenate([low + quarter * (1 + x), low + quarter * (3 + x)])
        p = np.exp(mass(r) - best) * np.concatenate([w, w])
        return best + math.log(p.sum() * quarter), float((p * np.exp(r + shift)).sum() / p.sum())

    def profile(x):
        found = [held(b)[2] for b in x]
        return np.array([best + math.log(max(high - low, 1e-300)) for low, high, best in found])

    low, high, top = _resolved(profile, -100.0, 100.0, 41)

    def density(x):
        found = [given_beta(b) for b in x]
        p = np.exp(np.array([f[0] for f in found]) - top)
        return np.stack([p, p * x, p * np.array([f[1] for f in found])], axis=1)

    total = _panels(density, low, high, 1e-6, 4)
    return float(total[1] / total[0]), float(total[2] / total[0])


def threshold_inputs(cases: DataFrame, ranges: DataFrame, delays: DataFrame, least: float = 100.0) -> DataFrame:
    """Onset and scaled mobility on the days both series cover, one row per area and day."""
    daily = cases.groupBy("poly_id", "date_time").agg(F.sum("num_cases").alias("num_cases"))
    kept, _ = enough_cases(daily, least)
    onset = confirmed_to_onset(kept, delay_for(kept, delays))
    mob = ranges.groupBy("poly_id", "date_time").agg(F.sum("movement_change").alias("movement_change"))
    span = overlap_span(mob, onset, "poly_id")
    grid = span.select("poly_id", F.explode(F.sequence("first_date", "last_date")).alias("date_time"))
    both = grid.join(mob, ["poly_id", "date_time"], "left").join(onset, ["poly_id", "date_time"], "left").na.fill(0.0)
    return windows.two_pass_mean(both, ["poly_id"], "date_time", "movement_change", "mobility")


def mobility_thresholds(inputs: DataFrame) -> DataFrame:
    """Per area: R0, beta and the movement change above which cases grow."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date_time").dropna(subset=["mobility"])
        row = {"poly_id": pdf["poly_id"].iloc[0] if len(pdf) else None, "r0": np.nan, "beta": np.nan, "mob_th": np.nan}
        if len(pdf) > 2:
            beta, r0 = fit_threshold(pdf["mobility"].to_numpy(float), pdf["num_cases"].to_numpy(float) + 1)
            row.update(beta=beta, r0=r0, mob_th=-(1 - math.log(r0) / beta) if beta else np.nan)
        return pd.DataFrame([row])

    return inputs.groupBy("poly_id").applyInPandas(run, THRESHOLD_SCHEMA)
