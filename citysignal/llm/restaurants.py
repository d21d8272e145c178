"""Seating in Pitman-Yor restaurants: how many tables serve a dish, drawn as a block.

For a dish with c customers in a restaurant of strength s and discount d, with T tables for
other dishes and probability p of the dish in the parent, the tables t it occupies have

    P(t) ~ S_d(c, t) * prod over j < t of (s + d (T + j)) p,

S_d the generalised Stirling numbers: the Chinese-restaurant seatings of c customers at t
tables. Drawing t given all else is one Gibbs step for all of the dish's customers.
"""

from __future__ import annotations

import functools

import numpy as np

EXACT = 64
TABLE = 1024
GRID = 96


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for positive arrays, by shifting up and Stirling's series."""
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] += np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + series - shift


@functools.lru_cache(maxsize=4)
def log_stirling(d: float) -> np.ndarray:
    """log S_d(c, t) for c, t up to TABLE (index 0 unused); -inf where there is none."""
    out = np.full((TABLE + 1, TABLE + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(TABLE + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for c in range(1, TABLE):
            stay = out[c] + np.log(np.maximum(c - d * t, 0))
            move = np.concatenate([[-np.inf], out[c, :-1]])
            out[c + 1] = np.logaddexp(stay, move)
    return out


def log_stirling_at(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """The same for any c: beyond the table by the scaling law of the number of tables.

    In a restaurant of strength 0, the number of tables of c customers over c**d tends to a
    fixed law; the law at c = TABLE stands for those beyond.
    """
    table = log_stirling(d)
    small = c <= TABLE
    out = np.empty(t.shape)
    out[small] = table[c[small], np.minimum(t[small], TABLE)]
    big, k = c[~small].astype(float), t[~small].astype(float)
    if len(big):
        n = np.arange(1, TABLE + 1)
        law = table[TABLE, 1:] + (n - 1) * np.log(d) + log_gamma(n) - log_gamma(np.array([TABLE]))
        ratio = (TABLE / big) ** d
        at = np.interp(np.maximum(k * ratio, 1.0), n, law) + np.log(ratio)
        out[~small] = at + log_gamma(big) - (k - 1) * np.log(d) - log_gamma(k)
    return out


def draw_tables(c, p, others, strength: float, d: float, rng) -> np.ndarray:
    """Tables for each dish, given its customers, its parent's probability, other tables."""
    out = np.ones(len(c), np.int64)
    if not len(c):
        return out
    table = log_stirling(d)
    order = np.argsort(c, kind="stable")
    sizes, begin = np.unique(c[order], return_index=True)
    end = np.append(begin[1:], len(c))
    for size, i, j in zip(sizes.tolist(), begin.tolist(), end.tolist(), strict=True):
        if size < 2:
            continue
        if size > EXACT:
            rows = order[i:]
            for k in range(0, len(rows), 20_000):
                part = rows[k : k + 20_000]
                out[part] = _from_grid(c[part], p[part], others[part], strength, d, rng)
            break
        for k in range(i, j, 200_000):
            rows = order[k : min(k + 200_000, j)]
            mass = (strength + d * (others[rows, None] + np.arange(size))) * p[rows, None]
            weight = np.cumsum(np.log(mass), 1) + table[size, 1 : size + 1]
            weight = np.exp(weight - weight.max(1, keepdims=True)).cumsum(1)
            u = rng.random(len(rows)) * weight[:, -1]
            out[rows] = 1 + (weight < u[:, None]).sum(1)
    return np.minimum(out, c)


def _from_grid(c, p, others, strength, d, rng) -> np.ndarray:
    """For many customers: the law on a grid of table counts, even inside its cells."""
    steps = np.linspace(0, 1, GRID)
    edges = np.floor(np.exp(steps[None, :] * np.log(c[:, None] + 1.0)) + 1e-9).astype(np.int64)
    edges = np.minimum(np.maximum(edges, 1), c[:, None] + 1)
    low, width = edges[:, :-1], np.diff(edges, axis=1)
    t = low + width // 2
    t = np.minimum(t, c[:, None])
    first = (strength + d * others[:, None]) / d
    rise = t * np.log(d * p[:, None]) + log_gamma(first + t) - log_gamma(np.broadcast_to(first, t.shape))
    weight = log_stirling_at(np.broadcast_to(c[:, None], t.shape), t, d) + rise
    with np.errstate(divide="ignore"):
        weight += np.log(width)
    weight = np.exp(weight - weight.max(1, keepdims=True)).cumsum(1)
    cell = (weight < rng.random(len(c))[:, None] * weight[:, -1:]).sum(1)
    rows = np.arange(len(c))
    return low[rows, cell] + (rng.random(len(c)) * width[rows, cell]).astype(np.int64)
