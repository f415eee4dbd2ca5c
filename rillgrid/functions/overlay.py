"""Sides of polygons cut where they meet, and those that bound a region chained to rings. Plain numpy for one geometry at a time,
inside a task; coordinates are metres."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

TOLERANCE = 1e-7  # points no farther apart are one
BESIDE = 1e-5  # how far from a side its two faces are looked at
BLOCK = 1 << 22  # pairs of sides compared at once

Member = Callable[[np.ndarray, np.ndarray], np.ndarray]


def sides_of(geom: list[list[list[dict]]]) -> np.ndarray:
    """(x1, y1, x2, y2) of all rings; open rings are closed."""
    out = [np.zeros((0, 4))]
    for ring in (r for part in geom for r in part):
        p = np.array([(v["x"], v["y"]) for v in ring], float).reshape(-1, 2)
        out.append(np.hstack([p, np.roll(p, -1, axis=0)]))
    sides = np.concatenate(out)
    return sides[(sides[:, :2] != sides[:, 2:]).any(axis=1)]


def _expanded(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number): first[row], first[row] + 1 ... of each row, count[row] of them."""
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]


def winding(sides: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How often the sides go round each point, anticlockwise. Points meet the sides of their level strip only."""
    out = np.zeros(len(x), np.int64)
    if not len(sides) or not len(x):
        return out
    low, high = np.minimum(sides[:, 1], sides[:, 3]), np.maximum(sides[:, 1], sides[:, 3])
    base, height = low.min(), max(high.max() - low.min(), TOLERANCE)
    strips = max(1, len(sides))
    while True:  # as many strips as keep the sides' entries at a few times their number
        level = lambda v: np.clip((v - base) / height * strips, 0, strips - 1).astype(np.int64)  # noqa: B023, E731
        spans = level(high) - level(low) + 1
        if strips == 1 or spans.sum() <= 4 * len(sides):
            break
        strips = max(1, strips // 2)
    side, strip = _expanded(level(low), spans)
    order = np.argsort(strip, kind="stable")
    side, strip = side[order], strip[order]
    at = level(y)
    first = np.searchsorted(strip, at)
    count = np.searchsorted(strip, at, side="right") - first
    ends = np.cumsum(count)
    begin = 0
    while begin < len(x):
        upto = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + BLOCK, side="right")))
        row, place = _expanded(first[begin:upto], count[begin:upto])
        x1, y1, x2, y2 = sides[side[place]].T
        px, py = x[begin:upto][row], y[begin:upto][row]
        left = (x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)
        turn = ((y1 <= py) & (y2 > py) & (left > 0)).astype(np.int64) - ((y1 > py) & (y2 <= py) & (left < 0))
        out[begin:upto] = np.bincount(row, turn, upto - begin).astype(np.int64)
        begin = upto
    return out


def even_odd(sides: np.ndarray) -> Member:
    return lambda x, y: winding(sides, x, y) % 2 == 1


def covered(sides: np.ndarray) -> Member:
    """Of shells that go anticlockwise and holes that go clockwise: under one polygon at least."""
    return lambda x, y: winding(sides, x, y) > 0


def even_odd_from(sides: np.ndarray, at: tuple[float, float], known: bool) -> Member:
    """Even-odd from the sides near alone: it is known for one point, and the way from there goes upright, then level."""
    x1, y1, x2, y2 = sides.T

    def member(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        px, py = x[:, None], y[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            height = y1 + (at[0] - x1) * (y2 - y1) / (x2 - x1)
            upright = ((x1 > at[0]) != (x2 > at[0])) & ((height > at[1]) != (height > py))
            place = x1 + (py - y1) * (x2 - x1) / (y2 - y1)
            level = ((y1 > py) != (y2 > py)) & ((place > at[0]) != (place > px))
        return (upright.sum(axis=1) + level.sum(axis=1)) % 2 == (0 if known else 1)

    return member


def _boxes_that_meet(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) with i < j of the boxes that meet, each pair once: boxes of one cell of a grid are held against each other."""
    n = len(low)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    base = low.min(axis=0)
    size = max(float(np.mean(high - low)), TOLERANCE)
    while True:  # cells so small that a box is in a few
        a, b = ((v - base) // size for v in (low, high))
        wide, tall = ((b - a).T + 1).astype(np.int64)
        if (wide.astype(float) * tall).sum() <= 8 * n:
            break
        size *= 2
    across = int((high[:, 0].max() - base[0]) // size) + 1
    box, k = _expanded(np.zeros(n, np.int64), wide * tall)
    cell = (a[box, 1].astype(np.int64) + k // wide[box]) * across + a[box, 0].astype(np.int64) + k % wide[box]
    order = np.argsort(cell, kind="stable")
    box, cell = box[order], cell[order]
    place = np.arange(len(cell))
    after = np.searchsorted(cell, cell, side="right") - place - 1  # boxes after it in its cell
    ends, found, begin = np.cumsum(after), [np.zeros(0, np.int64)], 0
    while begin < len(cell):
        upto = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + BLOCK, side="right")))
        row, other = _expanded(place[begin:upto] + 1, after[begin:upto])
        i, j = box[begin + row], box[other]
        meet = ((low[i] <= high[j]) & (high[i] >= low[j])).all(axis=1)
        found.append(np.unique(np.minimum(i, j)[meet] * n + np.maximum(i, j)[meet]))
        begin = upto
    key = np.unique(np.concatenate(found))
    return key // n, key % n


def _meetings(sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(side, point): where sides cross, and ends of others that lie on a side."""
    low, high = np.minimum(sides[:, :2], sides[:, 2:]) - TOLERANCE, np.maximum(sides[:, :2], sides[:, 2:]) + TOLERANCE
    i, j = _boxes_that_meet(low, high)
    i, j = np.concatenate([i, j]), np.concatenate([j, i])
    p, d = sides[:, :2], sides[:, 2:] - sides[:, :2]
    size = np.hypot(*d.T)
    which, points = [], []
    for end in (sides[j, :2], sides[j, 2:]):
        gap = end - p[i]
        along, off = (gap * d[i]).sum(axis=1) / size[i], (d[i, 0] * gap[:, 1] - d[i, 1] * gap[:, 0]) / size[i]
        on = (np.abs(off) <= TOLERANCE) & (along > TOLERANCE) & (along < size[i] - TOLERANCE)
        which.append(i[on])
        points.append(end[on])
    a, b = i[i < j], j[i < j]
    det = d[a, 0] * d[b, 1] - d[a, 1] * d[b, 0]
    a, b, det = a[det != 0], b[det != 0], det[det != 0]
    gap = p[b] - p[a]
    t, u = (gap[:, 0] * d[b, 1] - gap[:, 1] * d[b, 0]) / det, (gap[:, 0] * d[a, 1] - gap[:, 1] * d[a, 0]) / det
    met = (t > 0) & (t < 1) & (u > 0) & (u < 1)
    a, b, cross = a[met], b[met], p[a[met]] + t[met, None] * d[a[met]]
    return np.concatenate([*which, a, b]), np.concatenate([*points, cross, cross])


def _pieces(sides: np.ndarray) -> np.ndarray:
    """The sides cut at all meetings, each piece once whatever its direction; points that are almost equal are made equal."""
    known: dict[tuple[int, int], tuple[float, float]] = {}

    def same(x: float, y: float) -> tuple[float, float]:
        kx, ky = round(x / TOLERANCE), round(y / TOLERANCE)
        for k in ((kx + a, ky + b) for a in (0, -1, 1) for b in (0, -1, 1)):
            if k in known:
                return known[k]
        known[kx, ky] = (x, y)
        return x, y

    ends = [(same(x1, y1), same(x2, y2)) for x1, y1, x2, y2 in sides.tolist()]
    which, points = _meetings(sides)
    on: list[list[tuple[float, float]]] = [[] for _ in ends]
    for k, (x, y) in zip(which.tolist(), points.tolist(), strict=True):
        on[k].append(same(x, y))
    out = set()
    for (a, b), between in zip(ends, on, strict=True):
        way = [a, *sorted(set(between) - {a, b}, key=lambda q: (q[0] - a[0]) * (b[0] - a[0]) + (q[1] - a[1]) * (b[1] - a[1])), b]
        out.update((min(p, q), max(p, q)) for p, q in zip(way, way[1:], strict=False) if p != q)
    return np.array([(*p, *q) for p, q in sorted(out)], float).reshape(-1, 4)


QUARTER = 16  # sides of a quarter of a round corner


def moved_out(ring: np.ndarray, by: float) -> np.ndarray:
    """Sides of the closed curve that runs beside a ring (points, the first not repeated), ``by`` to its right.

    Where the ring turns left the curve goes round the corner in an arc, where it turns right it goes by the corner itself. So
    around any point it winds as often as the ring does, and once more for each side's strip and each corner's sector that holds
    the point: of shells that go anticlockwise and holes that go clockwise, the grown polygon is where it winds at all.
    """
    p = ring[(ring != np.roll(ring, 1, axis=0)).any(axis=1)]
    if len(p) < 2:
        return np.zeros((0, 4))
    d = np.roll(p, -1, axis=0) - p
    way = np.arctan2(d[:, 1], d[:, 0]) - np.pi / 2
    curve = []
    for k in range(len(p)):
        before = way[k - 1]
        turn = (way[k] - before + np.pi) % (2 * np.pi) - np.pi
        if turn >= 0:
            steps = max(1, int(np.ceil(turn / (np.pi / 2) * QUARTER - 1e-9)))
            angles = before + turn * np.arange(steps + 1) / steps
            curve.append(p[k] + by * np.stack([np.cos(angles), np.sin(angles)], axis=1))
        else:
            ends = by * np.array([[np.cos(a), np.sin(a)] for a in (before, way[k])])
            curve.append(np.stack([p[k] + ends[0], p[k], p[k] + ends[1]]))
    points = np.concatenate(curve)
    sides = np.hstack([points, np.roll(points, -1, axis=0)])
    return sides[(sides[:, :2] != sides[:, 2:]).any(axis=1)]


def outline(sides: np.ndarray, member: Member) -> list[tuple[tuple[float, float], tuple[float, float]]]:
    """Directed pieces of the sides that have the region ``member`` on their left and not on their right."""
    pieces = _pieces(sides)
    if not len(pieces):
        return []
    d = pieces[:, 2:] - pieces[:, :2]
    normal = np.stack([-d[:, 1], d[:, 0]], axis=1) / np.hypot(*d.T)[:, None] * BESIDE
    middle = (pieces[:, :2] + pieces[:, 2:]) / 2
    left, right = (member(*(middle + s * normal).T) for s in (1, -1))
    found = [((a, b), (c, e)) for a, b, c, e in pieces[left & ~right].tolist()]
    return found + [((c, e), (a, b)) for a, b, c, e in pieces[right & ~left].tolist()]
