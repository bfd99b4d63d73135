"""Directions in which one anchor point sees others, in lowest terms, as numpy arrays."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# Runs in the Python workers, so it is sent by value (see `vectors`).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def rays(dx: np.ndarray, dy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ux, uy, t) with (dx, dy) = t (ux, uy), for steps other than (0, 0).

    The direction is reduced and points to larger x (to larger y if vertical),
    so t falls below 0 for points that come before the anchor in (x, y) order.
    """
    t = np.gcd(dx, dy) * np.where((dx < 0) | ((dx == 0) & (dy < 0)), -1, 1)
    return dx // t, dy // t, t


def ray_class(ux: np.ndarray, uy: np.ndarray, classes: int) -> np.ndarray:
    """A number below `classes` for each direction."""
    mixed = ux.view("u8") * np.uint64(0x9E3779B97F4A7C15) + uy.view("u8") * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)) % np.uint64(classes)


def shared_rays(ux: np.ndarray, uy: np.ndarray, t: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Directions of `least` or more steps: ux, uy, number of steps, of those with t < 0, smallest and largest t.

    The last array holds their steps t, a direction after the other, ascending in each.
    """
    order = np.lexsort((t, uy, ux))
    ux, uy, t = ux[order], uy[order], t[order]
    starts = np.flatnonzero(np.concatenate([[True], (ux[1:] != ux[:-1]) | (uy[1:] != uy[:-1])])[: len(t)])
    ends = np.append(starts[1:], len(t))
    kept = ends - starts >= least
    steps = t[np.repeat(kept, ends - starts)]
    starts, ends = starts[kept], ends[kept]
    before = np.concatenate([[0], np.cumsum(t < 0)])
    return ux[starts], uy[starts], ends - starts, before[ends] - before[starts], t[starts], t[ends - 1], steps
