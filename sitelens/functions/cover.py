"""Quadtree covers of polygons: cells wholly inside, and border cells with the edges they hold.

The inside of a polygon is where a ray to the right crosses its rings an odd number of times.
For a cell, edges fall in three kinds: those left of it never count; those right of it count at
the heights they span, which is a list of heights at which the parity changes; the others are
tested one by one.  A cell with neither of the last two needs no test at all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

TOP_DEGREES = 16.0
LEVELS = 14
#: edges that a cell may hold before it is split
LEAF_EDGES = 24

Cell = tuple[int, int, int, np.ndarray, int, np.ndarray]


def rings_of(wkt: str | None) -> list[np.ndarray]:
    """Every ring of a ``POLYGON`` or ``MULTIPOLYGON`` text as an (n, 2) array."""
    out = []
    for ring in re.findall(r"\(([^()]+)\)", wkt or ""):
        if ring.strip():
            out.append(np.array([p.split()[:2] for p in ring.split(",")], dtype=float))
    return out


def edges_of(rings: list[np.ndarray]) -> np.ndarray:
    """(ax, ay, bx, by) rows; level edges are left out, no ray crosses them."""
    edges = [np.hstack([r[:-1], r[1:]]) for r in rings if len(r) > 1]
    every = np.concatenate(edges) if edges else np.zeros((0, 4))
    return every[every[:, 1] != every[:, 3]]


def _at(edges: np.ndarray, y: np.ndarray) -> np.ndarray:
    ax, ay, bx, by = edges.T
    return (bx - ax) * (y - ay) / (by - ay) + ax


def _refined(
    level: int, cx: int, cy: int, edges: np.ndarray, base: int, turns: np.ndarray, slack: float, grain: float
) -> Iterator[Cell]:
    """Cells below (level, cx, cy), of the ``edges`` that may matter to it, the parity ``base`` of
    what lies right of it below its foot, and the heights ``turns`` within it; those with a border
    are at most ``grain`` wide."""
    size = TOP_DEGREES / 2**level
    x0, x1, y0, y1 = cx * size, (cx + 1) * size, cy * size, (cy + 1) * size
    low, high = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    here = (high >= y0 - slack) & (low <= y1 + slack)
    edges, low, high = edges[here], low[here], high[here]
    foot, head = _at(edges, np.clip(y0, low, high)), _at(edges, np.clip(y1, low, high))
    left, right = np.minimum(foot, head), np.maximum(foot, head)
    beyond = left > x1 + slack
    own = edges[~beyond & (right >= x0 - slack)]
    heights, times = np.unique(np.concatenate([turns, low[beyond], high[beyond]]), return_counts=True)
    heights = heights[times % 2 == 1]
    base = (base + int((heights < y0 - slack).sum())) % 2
    turns = heights[(heights >= y0 - slack) & (heights <= y1 + slack)]
    if not len(own) and not len(turns):
        if base:
            yield level, cx, cy, own, base, turns
    elif (len(own) + len(turns) <= LEAF_EDGES and size <= grain) or level + 1 == LEVELS:
        yield level, cx, cy, own, base, turns
    else:
        for dx in (0, 1):
            for dy in (0, 1):
                yield from _refined(level + 1, 2 * cx + dx, 2 * cy + dy, own, base, turns, slack, grain)


def cells_of(rings: list[np.ndarray]) -> Iterator[Cell]:
    """(level, cx, cy, edges, base, turns) of the cells that may hold points of the polygon.

    A point of a cell is inside if base, the turns at or below it and the edges that its ray
    crosses are odd in sum.  Border cells are at most half as wide as the polygon, so that it meets
    the points around it and not those of its whole top cell.
    """
    edges = edges_of(rings)
    if not len(edges):
        return
    xs, ys = edges[:, [0, 2]], edges[:, [1, 3]]
    grain = max(float(np.ptp(xs)), float(np.ptp(ys))) / 2
    slack = 1e-9 * max(1.0, float(np.abs(edges).max()))
    for cx in range(int(xs.min() // TOP_DEGREES), int(xs.max() // TOP_DEGREES) + 1):
        for cy in range(int(ys.min() // TOP_DEGREES), int(ys.max() // TOP_DEGREES) + 1):
            yield from _refined(0, cx, cy, edges, 0, np.zeros(0), slack, grain)
