"""Small numeric helpers used inside Arrow functions (numpy only)."""

from __future__ import annotations

import math

import numpy as np


def digamma(x: np.ndarray) -> np.ndarray:
    x = np.array(x, dtype=float)
    out = np.zeros_like(x)
    for _ in range(8):  # shift upward until the series is accurate
        small = x < 8
        out[small] -= 1 / x[small]
        x[small] += 1
    f = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f / 240)))


def trigamma(x: np.ndarray) -> np.ndarray:
    x = np.array(x, dtype=float)
    out = np.zeros_like(x)
    for _ in range(8):
        small = x < 8
        out[small] += 1 / (x[small] ** 2)
        x[small] += 1
    f = 1 / (x * x)
    return out + 1 / x + f / 2 + f / x * (1 / 6 - f * (1 / 30 - f * (1 / 42 - f / 30)))


def gamma_shape(mean: np.ndarray, mean_log: np.ndarray) -> np.ndarray:
    """Likelihood estimate of a gamma's shape from the mean and the mean logarithm."""
    s = np.log(mean) - mean_log
    s = np.where(s > 1e-12, s, np.nan)
    a = (3 - s + np.sqrt((s - 3) ** 2 + 24 * s)) / (12 * s)
    ok = np.isfinite(a)
    for _ in range(50):
        step = (np.log(a[ok]) - digamma(a[ok]) - s[ok]) / (1 / a[ok] - trigamma(a[ok]))
        a[ok] = np.maximum(a[ok] - step, a[ok] / 10)
        if not ok.any() or np.max(np.abs(step) / a[ok]) < 1e-13:
            break
    return a


def gamma_pdf(x: np.ndarray, shape: float, scale: float) -> np.ndarray:
    out = np.zeros(len(x))
    up = x > 0
    out[up] = np.exp((shape - 1) * np.log(x[up]) - x[up] / scale - math.lgamma(shape) - shape * math.log(scale))
    if shape == 1:
        out[x == 0] = 1 / scale
    elif shape < 1:
        out[x == 0] = np.inf
    return out


def gamma_cdf(x: np.ndarray, shape: float, scale: float) -> np.ndarray:
    """Regularised lower incomplete gamma: series below shape + 1, continued fraction above."""
    x = np.asarray(x, dtype=float) / scale
    out = np.zeros_like(x)
    lg = math.lgamma(shape)
    low = (x > 0) & (x < shape + 1)
    if low.any():
        z = x[low]
        term = np.full_like(z, 1 / shape)
        total, n = term.copy(), shape
        for _ in range(10000):
            n += 1
            term = term * z / n
            total += term
            if np.all(term <= total * 1e-16):
                break
        out[low] = total * np.exp(-z + shape * np.log(z) - lg)
    high = x >= shape + 1
    if high.any():
        z = x[high]
        tiny = 1e-300
        b = z + 1 - shape
        c = np.full_like(z, 1 / tiny)
        d = 1 / b
        h = d.copy()
        for i in range(1, 10000):
            an = -i * (i - shape)
            b = b + 2
            d = an * d + b
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = b + an / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            step = d * c
            h = h * step
            if np.all(np.abs(step - 1) < 1e-15):
                break
        out[high] = 1 - np.exp(-z + shape * np.log(z) - lg) * h
    return out


def _lower_gamma(x: np.ndarray, a: np.ndarray, lg: np.ndarray) -> np.ndarray:
    """Regularised lower incomplete gamma for arrays of points and shapes."""
    out = np.empty_like(x)
    low = x < a + 1
    if low.any():
        z, s = x[low], a[low]
        term = 1 / s
        total, n = term.copy(), s.copy()
        for _ in range(int(20 + 12 * np.sqrt(s.max()))):
            n += 1
            term = term * z / n
            total += term
            if np.all(term <= total * 1e-14):
                break
        out[low] = total * np.exp(s * np.log(np.maximum(z, 1e-300)) - z - lg[low])
    high = ~low
    if high.any():
        z, s = x[high], a[high]
        b = z + 1 - s
        c, d = np.full_like(z, 1e300), 1 / b
        h = d.copy()
        for i in range(1, int(50 + 12 * np.sqrt(s.max()))):
            an = -i * (i - s)
            b = b + 2
            d = an * d + b
            d = 1 / np.where(np.abs(d) < 1e-300, 1e-300, d)
            c = b + an / c
            c = np.where(np.abs(c) < 1e-300, 1e-300, c)
            h *= d * c
            if np.all(np.abs(d * c - 1) < 1e-14):
                break
        out[high] = 1 - np.exp(s * np.log(z) - z - lg[high]) * h
    return out


def gamma_quantile(p: float, shape: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Inverse of the gamma distribution function, one value per (shape, scale).

    Bisection on all distinct shapes at once, bracketed from the mean and deviation.
    """
    ok = np.isfinite(shape) & np.isfinite(scale)
    out = np.full(len(shape), np.nan)
    if not ok.any():
        return out
    a, back = np.unique(shape[ok], return_inverse=True)
    lg = np.array([math.lgamma(v) for v in a])
    lo, hi = np.maximum(a - 12 * np.sqrt(a), 0.0), a + 12 * np.sqrt(a) + 20
    for _ in range(52):
        mid = (lo + hi) / 2
        below = _lower_gamma(mid, a, lg) < p
        lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
    out[ok] = ((lo + hi) / 2)[back] * scale[ok]
    return out


def log_poisson(k: np.ndarray, lam: np.ndarray) -> np.ndarray:
    """log pmf up to the term in k alone."""
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        return np.where(lam > 0, k * np.log(lam) - lam, np.where(k == 0, 0.0, -np.inf))
