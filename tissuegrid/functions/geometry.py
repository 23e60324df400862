"""Polygon arithmetic on ``array<struct<y,x>>`` rings as SQL text, clipping and exact covered area."""

from __future__ import annotations

import numpy as np


def ring_area(ring: str) -> str:
    """Shoelace area."""
    n = f"size({ring})"
    cross = (
        f"element_at({ring}, i + 1).x * element_at({ring}, (i + 1) % {n} + 1).y"
        f" - element_at({ring}, (i + 1) % {n} + 1).x * element_at({ring}, i + 1).y"
    )
    return f"abs(aggregate(sequence(0, {n} - 1), CAST(0 AS DOUBLE), (s, i) -> s + {cross})) / 2"


def ring_bounds(ring: str) -> dict[str, str]:
    return {
        f"{f}_{axis}": f"array_{f}(transform({ring}, p -> p.{axis}))" for f in ("min", "max") for axis in ("y", "x")
    }


def row_spans(ring: str, y: str) -> str:
    """Closed whole-number x spans of a ring on row ``y``, its border included.

    Crossings pair up by the even-odd rule; vertices and flat edges on the row are spans of their own.
    """
    n = f"size({ring})"
    a, b = f"element_at({ring}, i + 1)", f"element_at({ring}, (i + 1) % {n} + 1)"
    crossing = f"filter(sequence(0, {n} - 1), i -> ({a}.y <= {y}) <> ({b}.y <= {y}))"
    xs = f"array_sort(transform({crossing}, i -> {a}.x + ({y} - {a}.y) * ({b}.x - {a}.x) / ({b}.y - {a}.y)))"
    pairs = (
        f"transform(filter(sequence(0, size({xs})), k -> k % 2 = 1), "
        f"k -> struct(element_at({xs}, k) AS lo, element_at({xs}, k + 1) AS hi))"
    )
    flat = (
        f"transform(filter(sequence(0, {n} - 1), i -> {a}.y = {y}), i -> struct({a}.x AS lo, "
        f"{a}.x AS hi))"
    )
    edges = (
        f"transform(filter(sequence(0, {n} - 1), i -> {a}.y = {y} AND {b}.y = {y}), "
        f"i -> struct(least({a}.x, {b}.x) AS lo, greatest({a}.x, {b}.x) AS hi))"
    )
    return (
        f"filter(transform(concat({pairs}, {flat}, {edges}), s -> struct(CAST(ceil(s.lo - 1e-9) AS INT) AS lo, "
        f"CAST(floor(s.hi + 1e-9) AS INT) AS hi)), s -> s.lo <= s.hi)"
    )


#: Parts of a matrix of rows and edges that are worked on at once.
CELLS = 1 << 21


def flat_rings(rings: str) -> str:
    """Rings as one list of numbers: y, x of each vertex, with a pair of NaN before each ring."""
    ring = "flatten(transform(r, p -> array(CAST(p.y AS DOUBLE), CAST(p.x AS DOUBLE))))"
    return f"flatten(transform({rings}, r -> concat(array(double('NaN'), double('NaN')), {ring})))"


def rings_of(flat: np.ndarray) -> list[np.ndarray]:
    """(n, 2) vertex tables of the rings of one flat list."""
    points = np.asarray(flat, dtype=float).reshape(-1, 2)
    return [r[1:] for r in np.split(points, np.flatnonzero(np.isnan(points[:, 0]))) if len(r) > 1]


def flat_of(rings: list[np.ndarray]) -> np.ndarray:
    gap = np.full((1, 2), np.nan)
    return np.concatenate([x for r in rings for x in (gap, r)]).ravel() if rings else np.zeros(0)


def _half(ring: np.ndarray, axis: int, at: float, above: bool) -> np.ndarray:
    """What of a ring lies on one side of a line y = at (axis 0) or x = at (axis 1)."""
    inside = ring[:, axis] >= at if above else ring[:, axis] <= at
    if inside.all():
        return ring
    following = np.roll(ring, -1, axis=0)
    cross = inside != np.roll(inside, -1)
    out = np.empty((len(ring), 2, 2))
    out[:, 0] = ring
    with np.errstate(divide="ignore", invalid="ignore"):
        share = (at - ring[:, axis]) / (following[:, axis] - ring[:, axis])
        out[:, 1] = ring + share[:, None] * (following - ring)
    out[:, 1, axis] = at
    return out.reshape(-1, 2)[np.stack([inside, cross], axis=1).ravel()]


def clipped(rings: list[np.ndarray], y0: float, x0: float, y1: float, x1: float) -> list[np.ndarray]:
    """The rings cut to a box; those without area in it are left out. Even-odd area inside the box stays the same."""
    out = []
    for ring in rings:
        for axis, at, above in ((0, y0, True), (0, y1, False), (1, x0, True), (1, x1, False)):
            if len(ring):
                ring = _half(ring, axis, at, above)
        if len(ring) > 2 and np.ptp(ring[:, 0]) > 0 and np.ptp(ring[:, 1]) > 0:
            out.append(ring)
    return out


def fills(rings: list[np.ndarray], y0: float, x0: float, y1: float, x1: float) -> bool:
    """Whether clipped rings are the whole box: one ring that runs along its sides once."""
    if len(rings) != 1:
        return False
    y, x = rings[0].T
    on_side = ((y == y0) | (y == y1) | (x == x0) | (x == x1)).all()
    if not on_side or len(np.unique(rings[0], axis=0)) != len(rings[0]):
        return False
    area = abs(np.dot(y, np.roll(x, -1)) - np.dot(x, np.roll(y, -1))) / 2
    return bool(area == (y1 - y0) * (x1 - x0))


def _points(ring) -> np.ndarray:
    return ring if isinstance(ring, np.ndarray) and ring.dtype == float else np.array([(v["y"], v["x"]) for v in ring], dtype=float)


def covered_area(polygons, y0: float, x0: float, y1: float, x1: float) -> float:
    """Area of a box covered by the union of polygons, each given by its rings and filled by the even-odd rule.

    Rows are cut wherever an edge starts, ends, meets another one or a box side. In between nothing crosses, so
    covered length is linear in y and its middle value is exact. All rows are swept along x side by side: the edges of
    each polygon switch it on and off in turn, and what at least one polygon covers is added up.
    """
    rings = [(number, _points(r)) for number, p in enumerate(polygons) for r in p]
    if not rings:
        return 0.0
    e = np.concatenate([np.hstack([r, np.roll(r, -1, axis=0), np.full((len(r), 1), float(number))]) for number, r in rings])
    e = e[e[:, 0] != e[:, 2]]
    low, high = np.minimum(e[:, 0], e[:, 2]), np.maximum(e[:, 0], e[:, 2])
    e, low, high = (v[(high > y0) & (low < y1)] for v in (e, low, high))
    if not len(e):
        return 0.0
    slope = (e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0])
    base = e[:, 1] - slope * e[:, 0]
    cuts = [np.array([y0, y1]), low, high]
    with np.errstate(divide="ignore", invalid="ignore"):
        for side in (x0, x1):
            cuts.append((side - base) / slope)
        for first in range(0, len(e), max(1, CELLS // len(e))):
            part = slice(first, first + max(1, CELLS // len(e)))
            y = (base[None] - base[part, None]) / (slope[part, None] - slope[None])
            both = (y > np.maximum(low[part, None], low[None])) & (y < np.minimum(high[part, None], high[None]))
            cuts.append(y[both])
    ys = np.concatenate(cuts)
    ys = np.unique(np.clip(ys[np.isfinite(ys)], y0, y1))
    middle, height = (ys[:-1] + ys[1:]) / 2, np.diff(ys)
    total = 0.0
    for first in range(0, len(middle), max(1, CELLS // len(e))):
        mid = middle[first: first + max(1, CELLS // len(e))]
        row, edge = np.nonzero((low[None] <= mid[:, None]) & (mid[:, None] < high[None]))
        if not len(row):
            continue
        x = np.clip(base[edge] + slope[edge] * mid[row], x0, x1)
        owner = e[edge, 4]
        order = np.lexsort((x, owner, row))
        row, x, owner = row[order], x[order], owner[order]
        start = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (owner[1:] != owner[:-1])]))
        place = np.arange(len(row)) - np.repeat(start, np.diff(np.append(start, len(row))))
        switch = np.where(place % 2 == 0, 1, -1)
        order = np.lexsort((-switch, x, row))
        row, x, switch = row[order], x[order], switch[order]
        on = np.cumsum(switch)[:-1] > 0  # every polygon ends each row switched off
        same = row[1:] == row[:-1]
        length = np.bincount(row[:-1], weights=np.where(on & same, x[1:] - x[:-1], 0.0), minlength=len(mid))
        total += float(np.dot(length, height[first: first + len(mid)]))
    return total
