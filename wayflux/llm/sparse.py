"""Factorisation machine over sparse rows: fit on a bounded sample, scored in linear time."""

from __future__ import annotations

import numpy as np


class Model:
    """score = sigmoid(b + sum w x + 1/2 sum_f ((sum v_f x)^2 - sum (v_f x)^2)); without v a linear model."""

    def __init__(self, bias: float, w: np.ndarray, v: np.ndarray | None):
        self.bias, self.w, self.v = bias, w, v

    def margin(self, idx: np.ndarray, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Rows are idx[bounds[i]:bounds[i + 1]]; rows without features get the bias."""
        out = self.bias + row_sums(self.w[idx] * x, bounds)
        if self.v is not None:
            vx = self.v[idx] * x[:, None]
            s = row_sums(vx, bounds)
            out = out + 0.5 * ((s * s).sum(1) - row_sums((vx * vx).sum(1), bounds))
        return out

    def score(self, idx: np.ndarray, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(idx, x, bounds))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches, 0 for empty ones."""
    sizes = np.diff(bounds)
    out = np.zeros((len(sizes), *values.shape[1:]), np.float64)
    full = sizes > 0
    if full.any():
        out[full] = np.add.reduceat(values.astype(np.float64, copy=False), bounds[:-1][full], axis=0)
    return out


def fit(idx: np.ndarray, x: np.ndarray, bounds: np.ndarray, y: np.ndarray, size: int, rank: int = 0, epochs: int = 8, batch: int = 64, rate: float = 0.1, decay: float = 1e-5, seed: int = 7) -> Model:
    """Adagrad on the logistic loss, in mini-batches of rows in a seeded order.

    With no rows the model says one half everywhere, with one class the smoothed share of it.
    """
    n = len(y)
    share = (y.sum() + 0.5) / (n + 1)
    bias, bias_sq = float(np.log(share / (1 - share))), 1e-8
    rng = np.random.default_rng(seed)
    w, w_sq = np.zeros(size), np.full(size, 1e-8)
    v = rng.normal(0, 0.05, (size, rank)) if rank else None
    v_sq = np.full((size, rank), 1e-8) if rank else None
    if n == 0 or y.min() == y.max():
        return Model(bias, w, v * 0 if rank else None)
    sizes = np.diff(bounds)
    for _ in range(epochs):
        order = rng.permutation(n)
        for k in range(0, n, batch):
            rows = order[k : k + batch]
            m = sizes[rows]
            at = np.repeat(bounds[rows] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            own = np.concatenate([[0], np.cumsum(m)])
            i, xs = idx[at], x[at].astype(np.float64, copy=False)
            model = Model(bias, w, v)
            g = (sigmoid(model.margin(i, xs, own)) - y[rows]) / len(rows)
            bias_sq += g.sum() ** 2
            bias -= rate * g.sum() / np.sqrt(bias_sq)
            per = np.repeat(g, m)
            keys, back = np.unique(i, return_inverse=True)
            gw = np.bincount(back, per * xs, len(keys)) + decay * w[keys]
            w_sq[keys] += gw * gw
            w[keys] -= rate * gw / np.sqrt(w_sq[keys])
            if rank:
                vx = v[i] * xs[:, None]
                s = np.repeat(row_sums(vx, own), m, axis=0)
                gv = (per * xs)[:, None] * (s - vx)
                gk = np.stack([np.bincount(back, gv[:, f], len(keys)) for f in range(rank)], 1) + decay * v[keys]
                v_sq[keys] += gk * gk
                v[keys] -= 0.5 * rate * gk / np.sqrt(v_sq[keys])
    return Model(bias, w, v)
