"""Trends that may bend, fitted to many series at once from their sums, with numpy.

All arrays have a row per series. Periods count from 0; ``m`` is how many of them a fit uses. A bend at period
``c`` adds ``max(u - c, 0)`` to the trend. Products of bends over periods 0..m-1 depend on ``m`` alone and
come from closed formulas; what a straight line explains of a bend is taken off before.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Places where a trend may bend, and rounds over them.
KNOTS, SWEEPS = 10, 50
#: The penalty, in units of the noise: what the largest of so many chance bends reaches.
PENALTY = 2.1460
#: A bend of which no more than this share is left beside a straight line is none.
NOTHING = 1e-9


class Sums(NamedTuple):
    """Sums of values, of value times period, of squares, of value times bend (``KNOTS``), and of values per season."""

    y: np.ndarray
    uy: np.ndarray
    yy: np.ndarray
    hy: np.ndarray
    seasons: np.ndarray


class Fit(NamedTuple):
    base: np.ndarray
    slope: np.ndarray
    bends: np.ndarray
    seasons: np.ndarray
    knots: np.ndarray

    def at(self, u: np.ndarray) -> np.ndarray:
        """Values at periods ``u`` (a row per series), before those below 0 are lifted."""
        bent = np.einsum("bk,bkp->bp", self.bends, np.maximum(u[:, None, :] - self.knots[:, :, None], 0.0))
        season = np.take_along_axis(self.seasons, u.astype(np.int64) % self.seasons.shape[1], 1)
        return self.base[:, None] + self.slope[:, None] * u + bent + season


def knots(n: np.ndarray) -> np.ndarray:
    """Periods at which a trend of ``n`` periods may bend: evenly over its first four fifths."""
    return np.arange(1, KNOTS + 1)[None, :] * 8 * (n[:, None] - 1) // (10 * (KNOTS + 1))


def _over(value, by):
    return np.divide(value, by, out=np.zeros(np.broadcast_shapes(np.shape(value), np.shape(by))), where=np.asarray(by) != 0)


def _triangle(l):
    return l * (l + 1) / 2


def _pyramid(l):
    return l * (l + 1) * (2 * l + 1) / 6


def descent(z: np.ndarray, products: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Coefficients of standardised bends with a penalty on their sizes; bends without a product stay 0."""
    d = np.zeros_like(z)
    own = np.einsum("bkk->bk", products)
    for _ in range(SWEEPS):
        for j in range(z.shape[1]):
            rest = z[:, j] - np.einsum("bk,bk->b", products[:, j], d) + own[:, j] * d[:, j]
            d[:, j] = np.where(own[:, j] == 0, 0.0, np.sign(rest) * np.maximum(np.abs(rest) - penalty, 0.0))
    return d


def _season_bends(m: np.ndarray, c: np.ndarray, seasons: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per season: periods among 0..m-1, their mean, and the mean of each bend over them."""
    first = np.arange(seasons, dtype=float)[None, :]
    last = np.floor((m[:, None] - 1 - first) / seasons)
    count = np.maximum(last + 1, 0)
    begin = np.maximum(np.floor((c[:, None, :] - first[:, :, None]) / seasons) + 1, 0)
    terms = np.maximum(last[:, :, None] - begin + 1, 0)
    bend = terms * (first[:, :, None] - c[:, None, :]) + seasons * (begin + last[:, :, None]) * terms / 2
    return count, first + seasons * last / 2, _over(bend, count[:, :, None])


def solve(sums: Sums, n: np.ndarray, m: np.ndarray) -> Fit:
    """Fit to periods 0..m-1 of series whose bends are placed over ``n`` periods."""
    c = knots(n).astype(float)
    m = m.astype(float)
    middle, spread = (m - 1) / 2, m * (m * m - 1) / 12
    t = sums.uy - middle * sums.y
    after = np.maximum(m[:, None] - 1 - c, 0)
    s = _triangle(after)
    along = _pyramid(after) + c * s - middle[:, None] * s
    # Bends are in order: of two, the later one says over which periods both count.
    gap = np.abs(c[:, :, None] - c[:, None, :])
    later = np.minimum(after[:, :, None], after[:, None, :])
    products = _pyramid(later) + gap * _triangle(later) - s[:, :, None] * s[:, None, :] / m[:, None, None]
    products -= _over(along[:, :, None] * along[:, None, :], spread[:, None, None])
    own = np.einsum("bkk->bk", products)
    size = np.sqrt(np.where(own > NOTHING * _pyramid(after), own, 0.0))
    products = _over(products, size[:, :, None] * size[:, None, :])
    z = _over(sums.hy - s * (sums.y / m)[:, None] - _over(along * t[:, None], spread[:, None]), size)
    left = np.maximum(sums.yy - sums.y * sums.y / m - _over(t * t, spread), 0.0)
    noise = np.sqrt(_over(left, np.maximum(m - 2, 0)))
    bends = _over(descent(z, products, PENALTY * noise), size)
    slope = _over(t - (along * bends).sum(1), spread)
    base = sums.y / m - slope * middle - (s * bends).sum(1) / m
    seasons = sums.seasons.shape[1]
    if seasons == 1:  # nothing is left beside the trend
        return Fit(base, slope, bends, np.zeros((len(m), 1)), c)
    count, mean, bent = _season_bends(m, c, seasons)
    rest = _over(sums.seasons, count) - base[:, None] - slope[:, None] * mean - np.einsum("bsk,bk->bs", bent, bends)
    return Fit(base, slope, bends, np.where(count > 0, rest, 0.0), c)
