"""Column functions of plane geometry. Coordinates are doubles in a metric system.

A ring or path is array<struct<x, y>>, a part is an array of rings (the shell, then holes), a geometry an array of parts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOMETRY = "array<array<array<struct<x:double,y:double>>>>"


def point_segment(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance of a point from a segment; of one without length, from its point."""
    dx, dy = x2 - x1, y2 - y1
    a = dx * dx + dy * dy
    t = F.when(a > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / F.when(a > 0, a)))).otherwise(0.0)
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def segments_cross(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Whether two segments (x1, y1, x2, y2) properly cross. Touching ends show as a distance of 0."""
    side = lambda x1, y1, x2, y2, x, y: (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
    d1, d2 = side(*a, b[0], b[1]), side(*a, b[2], b[3])
    d3, d4 = side(*b, a[0], a[1]), side(*b, a[2], a[3])
    return (d1 * d2 < 0) & (d3 * d4 < 0)


def segment_segment(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Distance of two segments (x1, y1, x2, y2)."""
    ends = F.least(point_segment(a[0], a[1], *b), point_segment(a[2], a[3], *b), point_segment(b[0], b[1], *a), point_segment(b[2], b[3], *a))
    return F.when(segments_cross(a, b), 0.0).otherwise(ends)


def length_in_disc(px: Column, py: Column, r: Column | float, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Length of a segment inside the disc of radius r round a point."""
    r = F.lit(float(r)) if isinstance(r, (int, float)) else r
    dx, dy, fx, fy = x2 - x1, y2 - y1, px - x1, py - y1
    a, fd = dx * dx + dy * dy, fx * dx + fy * dy
    dd = fd * fd - a * (fx * fx + fy * fy - r * r)
    inside = (a > 0) & (dd > 0)
    safe_a, root = F.when(inside, a), F.sqrt(F.when(inside, dd))
    span = F.least(F.lit(1.0), (fd + root) / safe_a) - F.greatest(F.lit(0.0), (fd - root) / safe_a)
    return F.when(inside, F.greatest(F.lit(0.0), span) * F.sqrt(safe_a)).otherwise(0.0)


def edges(path: Column) -> Column:
    """array<struct<x1, y1, x2, y2>> of a path's segments."""
    n = F.size(path)
    pairs = F.zip_with(F.slice(path, 1, F.greatest(n - 1, F.lit(0))), F.slice(path, 2, F.greatest(n - 1, F.lit(0))), lambda p, q: F.named_struct(F.lit("x1"), p["x"], F.lit("y1"), p["y"], F.lit("x2"), q["x"], F.lit("y2"), q["y"]))
    return F.when(n > 1, pairs).otherwise(F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>"))


def path_length(path: Column) -> Column:
    return F.aggregate(edges(path), F.lit(0.0), lambda s, e: s + F.sqrt((e["x2"] - e["x1"]) * (e["x2"] - e["x1"]) + (e["y2"] - e["y1"]) * (e["y2"] - e["y1"])))


def ring_turn(ring: Column) -> Column:
    """Twice a ring's signed area, positive for one that turns left."""
    first = F.get(ring, F.lit(0))
    about = lambda e: (e["x1"] - first["x"]) * (e["y2"] - first["y"]) - (e["x2"] - first["x"]) * (e["y1"] - first["y"])
    return F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + about(e))


def once(value: Column, use) -> Column:
    """use(v) for a value that is computed once a row, however often v is used: a lambda's variable is not inlined."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _moments(geom: Column) -> Column:
    """struct<a, mx, my> of a polygon: its area and the first moments of it, holes taken off, whatever the rings' direction.

    One fold over all edges: each ring's sums are taken about its first vertex, then moved to the origin.
    """
    zero = F.named_struct(F.lit("a"), F.lit(0.0), F.lit("mx"), F.lit(0.0), F.lit("my"), F.lit(0.0))

    def of_ring(ring: Column, sign: Column) -> Column:
        first = F.get(ring, F.lit(0))

        def from_first(o: Column) -> Column:
            def add(s: Column, p: Column) -> Column:
                # s keeps the point before, about the first vertex
                x, y = p["x"] - o["x"], p["y"] - o["y"]
                c = s["x"] * y - x * s["y"]
                return F.named_struct(F.lit("x"), x, F.lit("y"), y, F.lit("a"), s["a"] + c, F.lit("mx"), s["mx"] + c * (s["x"] + x), F.lit("my"), s["my"] + c * (s["y"] + y))

            start = F.named_struct(F.lit("x"), F.lit(0.0), F.lit("y"), F.lit(0.0), F.lit("a"), F.lit(0.0), F.lit("mx"), F.lit(0.0), F.lit("my"), F.lit(0.0))
            return F.aggregate(ring, start, add, lambda s: _moved(s, o, sign))

        return once(first, from_first)

    def _moved(s: Column, o: Column, sign: Column) -> Column:
        way = sign * F.signum(s["a"])
        return F.named_struct(F.lit("a"), sign * F.abs(s["a"]) / 2, F.lit("mx"), way * (s["mx"] / 6 + o["x"] * s["a"] / 2), F.lit("my"), way * (s["my"] / 6 + o["y"] * s["a"] / 2))

    rings = F.flatten(F.transform(geom, lambda part: F.transform(part, lambda ring, i: of_ring(ring, F.when(i == 0, 1.0).otherwise(-1.0)))))
    some = F.filter(rings, lambda m: m["a"].isNotNull())
    return F.aggregate(some, zero, lambda s, m: F.named_struct(F.lit("a"), s["a"] + m["a"], F.lit("mx"), s["mx"] + m["mx"], F.lit("my"), s["my"] + m["my"]))


def area(geom: Column) -> Column:
    """Polygon area, holes taken off, whatever the rings' direction."""
    return _moments(geom)["a"]


def _line_moments(geom: Column) -> Column:
    """struct<a, mx, my> of a geometry's lengths."""
    zero = F.named_struct(F.lit("a"), F.lit(0.0), F.lit("mx"), F.lit(0.0), F.lit("my"), F.lit(0.0))

    def add(s: Column, e: Column) -> Column:
        size = F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"])
        return F.named_struct(F.lit("a"), s["a"] + size, F.lit("mx"), s["mx"] + size * (e["x1"] + e["x2"]) / 2, F.lit("my"), s["my"] + size * (e["y1"] + e["y2"]) / 2)

    return F.aggregate(F.flatten(F.transform(F.flatten(geom), edges)), zero, add)


def centroid(geom: Column) -> Column:
    """struct<x, y>: the area's centre; of a geometry without area the centre of its lengths; of a point the point."""
    middle = lambda m: F.struct((m["mx"] / m["a"]).alias("x"), (m["my"] / m["a"]).alias("y"))
    point = F.get(F.flatten(F.flatten(geom)), F.lit(0))
    by_length = once(_line_moments(geom), lambda m: F.when(m["a"] > 0, middle(m)).otherwise(F.struct(point["x"].alias("x"), point["y"].alias("y"))))
    return once(_moments(geom), lambda m: F.when(m["a"] > 0, middle(m)).otherwise(by_length))


def bounds(geom: Column) -> Column:
    """struct<xmin, ymin, xmax, ymax>; null members for an empty geometry."""
    points = F.flatten(F.flatten(geom))
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def is_empty(geom: Column) -> Column:
    """Null, without points, or with a coordinate that is no finite number."""
    points = F.flatten(F.flatten(geom))
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return F.coalesce((F.size(points) == 0) | ~F.forall(points, lambda p: finite(p["x"]) & finite(p["y"])), F.lit(True))


def inside(px: Column, py: Column, geom: Column) -> Column:
    """Even-odd test over all rings, holes included. Points on an edge may be either."""
    every = F.flatten(F.transform(F.flatten(geom), edges))

    def hit(e: Column) -> Column:
        spans = (e["y1"] > py) != (e["y2"] > py)
        return spans & (px < e["x1"] + (py - e["y1"]) * (e["x2"] - e["x1"]) / F.when(spans, e["y2"] - e["y1"]))

    return F.size(F.filter(every, lambda e: F.coalesce(hit(e), F.lit(False)))) % 2 == 1


def null_if_nan(c: Column | str) -> Column:
    """Missing values are null here; files have NaN."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def capped(c: Column, most: float | None) -> Column:
    """c, at most ``most``; null stays null."""
    return c if most is None else F.when(c > most, F.lit(float(most))).otherwise(c)


def least_of_all(*cols: Column) -> Column:
    """The row's least value, null if any is."""
    every = cols[0].isNotNull()
    for c in cols[1:]:
        every = every & c.isNotNull()
    return F.when(every, F.least(*cols) if len(cols) > 1 else cols[0])


def expected_hours(year: Column) -> Column:
    """Hours of a Gregorian year."""
    return F.datediff(F.make_date(year + 1, F.lit(1), F.lit(1)), F.make_date(year, F.lit(1), F.lit(1))) * 24
