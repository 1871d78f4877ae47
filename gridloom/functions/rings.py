"""Plane geometry of rings as arrays of points, for use inside tasks.

A ring is an (n, 2) array; a shape is a list of rings of which the first is the outer one and the others are
holes.  Clipped rings may run along the box's edge and back, which neither areas nor crossings notice.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

NONE = np.zeros((0, 2))


def clip(ring: np.ndarray, axis: int, bound: float, below: bool) -> np.ndarray:
    """A ring's part on one side of a line."""
    inside = ring[:, axis] <= bound if below else ring[:, axis] >= bound
    if inside.all():
        return ring
    if not inside.any():
        return NONE
    before = np.roll(ring, 1, axis=0)
    crosses = inside != np.roll(inside, 1)
    step = ring[:, axis] - before[:, axis]
    t = np.divide(bound - before[:, axis], step, out=np.zeros(len(ring)), where=crosses)
    at = before + t[:, None] * (ring - before)
    at[:, axis] = bound
    both, kept = np.empty((2 * len(ring), 2)), np.empty(2 * len(ring), bool)
    both[::2], both[1::2], kept[::2], kept[1::2] = at, ring, crosses, inside
    return both[kept]


def clip_to_box(ring: np.ndarray, west: float, south: float, east: float, north: float) -> np.ndarray:
    for axis, bound, below in ((0, west, False), (0, east, True), (1, south, False), (1, north, True)):
        ring = clip(ring, axis, bound, below)
    return ring


def area(ring: np.ndarray) -> float:
    if len(ring) < 3:
        return 0.0
    after = np.roll(ring, -1, axis=0)
    return abs(float((ring[:, 0] * after[:, 1] - after[:, 0] * ring[:, 1]).sum())) / 2


def shape_area(rings: Sequence[np.ndarray]) -> float:
    """Area of the outer ring less that of the holes."""
    return area(rings[0]) - sum(map(area, rings[1:])) if len(rings) else 0.0


def crossings(ring: np.ndarray, x: float, y: float) -> int:
    """Edges of a ring east of a point, on its parallel."""
    after = np.roll(ring, -1, axis=0)
    crosses = (ring[:, 1] > y) != (after[:, 1] > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = ring[:, 0] + (y - ring[:, 1]) * (after[:, 0] - ring[:, 0]) / (after[:, 1] - ring[:, 1])
    return int((crosses & (x < at)).sum())


def contains(rings: Sequence[np.ndarray], x: float, y: float) -> bool:
    """Even-odd rule over all rings."""
    return sum(crossings(r, x, y) for r in rings) % 2 == 1


def distance(rings: Sequence[np.ndarray], x: float, y: float) -> float:
    """Of a point from a shape; 0 inside."""
    if contains(rings, x, y):
        return 0.0
    least = np.inf
    for ring in rings:
        a, d = ring - (x, y), np.roll(ring, -1, axis=0) - ring
        length = (d**2).sum(1)
        t = np.clip(np.divide(-(a * d).sum(1), length, out=np.zeros(len(ring)), where=length > 0), 0, 1)
        least = min(least, float(((a + t[:, None] * d) ** 2).sum(1).min()))
    return float(np.sqrt(least))


Square = tuple[int, int, int]


def quarter(rings: list[np.ndarray], square: Square, stop: int, resolution: float, limits: Square) -> Iterator[tuple[Square, bool, list[np.ndarray]]]:
    """Squares (row, column, cells a side) that a shape meets, whether it covers them whole, and its part in each.

    A square that is covered comes without rings and is not looked into; one that the edge meets is quartered
    until it has ``stop`` cells a side, with the clipped part only.  ``limits`` are the grid's rows and columns.
    """
    open_ = [(square, rings)]
    while open_:
        (row, column, size), parts = open_.pop()
        if row >= limits[0] or column >= limits[1]:
            continue
        west, south = column * resolution - 180, row * resolution - 90
        side = size * resolution
        outer = clip_to_box(parts[0], west, south, west + side, south + side)
        if len(outer) < 3 or area(outer) <= 0:
            continue
        holes = [h for h in (clip_to_box(p, west, south, west + side, south + side) for p in parts[1:]) if area(h) > 0]
        here = [outer, *holes]
        left = shape_area(here)
        if left <= 1e-14:  # square degrees
            continue
        if not holes and side * side - left <= 1e-10:
            yield (row, column, size), True, []
        elif size <= stop:
            yield (row, column, size), False, here
        else:
            half = size // 2
            open_ += [((row + i * half, column + j * half, half), here) for i in (0, 1) for j in (0, 1)]
