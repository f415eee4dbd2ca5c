"""Polygons cut to boundaries, and repaired. What a polygon's box already decides stays in columns; only the few that a boundary
side meets, or that cross themselves, go through a helper in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgrid.functions import overlay
from rillgrid.functions.columns import bounds, edges, segments_cross
from rillgrid.operators.dissolve import KIND, assemble, points_of
from rillgrid.operators.spatial import to_segments
from rillgrid.plans.cache import cut

STRIP = 500.0
WELL_INSIDE = 1e-3  # crossings farther than that from the ends of sides need no care
FEW_SIDES = 64  # sides that are held against each other in columns
#: Where a polygon's box is tested: by its lower left corner, off it by an odd bit, so that no side goes through the point.
OFF_X, OFF_Y = 0.00137, 0.00091


def _rebuilt(rows: DataFrame, make: Callable[[dict], list | None], *helpers: str) -> DataFrame:
    """rows with geom as ``make`` gives it; without the helper columns, and without rows of which nothing is left."""
    schema = rows.drop(*helpers).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [make(r) for r in batch.select(["geom", *helpers]).to_pylist()]
            columns = [pa.array(made, KIND) if name == "geom" else batch.column(name) for name in schema.names]
            some = pa.array([bool(m) for m in made], pa.bool_())
            yield pa.RecordBatch.from_arrays(columns, names=schema.names).filter(some)

    return rows.mapInArrow(run, schema)


def _size(geom: list) -> float:
    return sum((1 if k == 0 else -1) * abs(sum(a["x"] * b["y"] - b["x"] * a["y"] for a, b in zip(ring, ring[1:], strict=False))) for part in geom for k, ring in enumerate(part)) / 2


def _clipped(row: dict) -> list | None:
    own = overlay.sides_of(row["geom"])
    near = np.array([(s["x1"], s["y1"], s["x2"], s["y2"]) for s in row["_sides"]], float).reshape(-1, 4)
    mine, theirs = overlay.even_odd(own), overlay.even_odd_from(near, (row["_xr"], row["_yr"]), row["_in"])
    left = points_of(assemble(overlay.outline(np.concatenate([own, near]), lambda x, y: mine(x, y) & theirs(x, y))))
    # one that the boundary does not cut stays as it is
    return row["geom"] if left and abs(_size(left) - _size(row["geom"])) <= 1e-9 * _size(row["geom"]) else left


def clip_polygons(layer: DataFrame, boundary: DataFrame, key: tuple[str, ...] = ("city", "bldg_id"), strip: float = STRIP) -> DataFrame:
    """layer's polygons cut to their city's boundary (city, geom), ids and all other columns kept; polygons of which nothing is
    left go, and so do those of a city without a boundary and null geometries. ``key`` is unique and begins with city.

    Boundary sides lie in level strips; a polygon meets those of its box's strips only, in an equi-join. They give the sides that
    meet its box, and whether the box's corner is inside. Without such sides the polygon is inside or outside as a whole. A
    polygon that crosses itself counts by even and odd.
    """
    sides = to_segments(boundary, "city").select("city", "x1", "y1", "x2", "y2")
    level = lambda c: F.floor(c / strip).cast("long")
    sides = sides.withColumn("_strip", F.explode(F.sequence(level(F.least("y1", "y2")), level(F.greatest("y1", "y2")))))
    boxes = layer.select(*key, bounds(F.col("geom")).alias("_b")).where("_b.xmin is not null")
    boxes = boxes.select(*key, (F.col("_b.xmin") - OFF_X).alias("_xr"), (F.col("_b.ymin") - OFF_Y).alias("_yr"), F.col("_b.xmax").alias("_xm"), F.col("_b.ymax").alias("_ym"))
    placed = boxes.withColumn("_strip", F.explode(F.sequence(level(F.col("_yr")), level(F.col("_ym")))))
    spans = (F.col("y1") > F.col("_yr")) != (F.col("y2") > F.col("_yr"))
    right = F.col("_xr") < F.col("x1") + (F.col("_yr") - F.col("y1")) * (F.col("x2") - F.col("x1")) / F.when(spans, F.col("y2") - F.col("y1"))
    ray = F.coalesce((F.col("_strip") == level(F.col("_yr"))) & spans & right, F.lit(False))
    meets = (F.greatest("x1", "x2") >= F.col("_xr")) & (F.least("x1", "x2") <= F.col("_xm")) & (F.greatest("y1", "y2") >= F.col("_yr")) & (F.least("y1", "y2") <= F.col("_ym"))
    met = placed.join(sides, ["city", "_strip"]).select(*key, "_xr", "_yr", ray.alias("_ray"), F.when(meets, F.struct("x1", "y1", "x2", "y2")).alias("_side"))
    found = met.where("_ray or _side is not null").groupBy(*key).agg(
        F.first("_xr").alias("_xr"), F.first("_yr").alias("_yr"), (F.sum(F.col("_ray").cast("int")) % 2 == 1).alias("_in"), F.collect_set("_side").alias("_sides")
    )
    beside = cut(layer.join(found, list(key)))
    helpers = ("_xr", "_yr", "_in", "_sides")
    whole = beside.where("_in and size(_sides) = 0").drop(*helpers)
    return whole.select(*layer.columns).unionByName(_rebuilt(beside.where("size(_sides) > 0"), _clipped, *helpers).select(*layer.columns))


def _repaired(row: dict) -> list | None:
    own = overlay.sides_of(row["geom"])
    return points_of(assemble(overlay.outline(own, overlay.even_odd(own))))


def _bow_ties(geoms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(which, halves): the polygons of one ring of four sides of which two opposite ones cross well inside, and the halves of each (two
    rings of four points, as ``assemble`` gives them). All of a batch at once; the others are for the helper."""
    n_parts = pc.fill_null(pc.list_value_length(geoms), 0).to_numpy(zero_copy_only=False)
    parts = pc.list_flatten(geoms)
    n_rings = pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False)
    rings = pc.list_flatten(parts)
    n_points = pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False)
    points = pc.list_flatten(rings)
    xy = np.stack([pc.struct_field(points, c).to_numpy(zero_copy_only=False).astype(float, copy=False) for c in "xy"], axis=1)
    part, ring = np.cumsum(n_parts) - n_parts, np.cumsum(n_rings) - n_rings
    which = np.flatnonzero(n_parts == 1)
    which = which[n_rings[part[which]] == 1]
    which = which[n_points[ring[part[which]]] == 5]
    first = (np.cumsum(n_points) - n_points)[ring[part[which]]]
    p = xy[first[:, None] + np.arange(5)]
    closed = (p[:, 0] == p[:, 4]).all(axis=1) & np.isfinite(p).all(axis=(1, 2))
    which, p = which[closed], p[closed, :4]
    found, halves = [np.zeros(0, np.int64)], [np.zeros((0, 2, 4, 2))]
    for k in (0, 1):  # the first side crosses the third, or the second the fourth
        a, b, c, d = (p[:, (k + j) % 4] for j in range(4))
        v, w, g = b - a, d - c, c - a
        turn = lambda m, n: m[:, 0] * n[:, 1] - m[:, 1] * n[:, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            det = turn(v, w)
            s, u = turn(g, w) / det, turn(g, v) / det
            long = np.hypot(*v.T), np.hypot(*w.T)
            ends = [np.minimum(q, 1 - q) * size > WELL_INSIDE for q, size in ((s, long[0]), (u, long[1]))]
            # and no thin halves, where points that are almost one would count
            ok = ends[0] & ends[1] & (np.abs(det) > WELL_INSIDE * long[0] * long[1]) & (np.hypot(*g.T) > WELL_INSIDE) & (np.hypot(*(b - c).T) > WELL_INSIDE) & (np.hypot(*(d - a).T) > WELL_INSIDE)
        a, b, c, d, x = a[ok], b[ok], c[ok], d[ok], a[ok] + s[ok, None] * v[ok]
        halves.append(np.stack([_triangles(x, b, c), _triangles(x, d, a)], axis=1))
        found.append(which[ok])
    at, both = np.concatenate(found), np.concatenate(halves)
    swap = (both[:, 0, 0, 0] > both[:, 1, 0, 0]) | ((both[:, 0, 0, 0] == both[:, 1, 0, 0]) & ((both[:, 0, 0, 1] > both[:, 1, 0, 1]) | ((both[:, 0, 0] == both[:, 1, 0]).all(axis=1) & (_later(both)))))
    both[swap] = both[swap][:, ::-1]
    order = np.argsort(at)
    return at[order], both[order]


def _later(both: np.ndarray) -> np.ndarray:
    """Whether the first half's second point comes after the second's."""
    p, q = both[:, 0, 1], both[:, 1, 1]
    return (p[:, 0] > q[:, 0]) | ((p[:, 0] == q[:, 0]) & (p[:, 1] > q[:, 1]))


def _triangles(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Closed rings, anticlockwise, from their least point on."""
    v, w = b - a, c - a
    back = (v[:, 0] * w[:, 1] - v[:, 1] * w[:, 0] < 0)[:, None]
    ring = np.stack([a, np.where(back, c, b), np.where(back, b, c)], axis=1)
    least = np.lexsort((ring[:, :, 1], ring[:, :, 0]), axis=1)[:, :1]
    return ring[np.arange(len(ring))[:, None], (least + np.arange(4)) % 3]


def _mended(geoms: pa.Array) -> pa.Array:
    at, both = _bow_ties(geoms)
    n = len(at)
    flat = both.reshape(-1, 2)
    points = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["x", "y"])
    rings = pa.ListArray.from_arrays(pa.array(np.arange(2 * n + 1, dtype=np.int32) * 4), points)
    parts = pa.ListArray.from_arrays(pa.array(np.arange(2 * n + 1, dtype=np.int32)), rings)
    simple = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * 2), parts).cast(KIND)
    rest = np.setdiff1d(np.arange(len(geoms)), at)
    others = pa.array([_repaired({"geom": g}) for g in geoms.take(pa.array(rest)).to_pylist()], KIND)
    return pa.concat_arrays([simple, others]).take(pa.array(np.argsort(np.concatenate([at, rest]), kind="stable")))


def repaired(layer: DataFrame) -> DataFrame:
    """Polygons whose sides cross are made of simple rings: what an odd number of turns goes round is inside (both halves of a bow
    tie). Those of at most FEW_SIDES sides that do not cross stay as they are; polygons without any area go, null geometries stay."""
    every = F.flatten(F.transform(F.flatten("geom"), edges))
    of = lambda e: (e["x1"], e["y1"], e["x2"], e["y2"])
    tried = layer.withColumn("_own", every)
    crossed = F.exists("_own", lambda e: F.exists("_own", lambda f: segments_cross(of(e), of(f))))
    tried = tried.withColumn("_bad", F.coalesce(F.when(F.size("_own") > FEW_SIDES, F.lit(True)).otherwise(crossed), F.lit(False))).drop("_own")
    fine = tried.where("not _bad").drop("_bad")
    schema = layer.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = _mended(batch.column("geom"))
            some = pc.greater(pc.fill_null(pc.list_value_length(made), 0), 0)
            yield pa.RecordBatch.from_arrays([made if n == "geom" else batch.column(n) for n in schema.names], names=schema.names).filter(some)

    return fine.unionByName(tried.where("_bad").drop("_bad").mapInArrow(run, schema))


def _ring(points: list[dict], anticlockwise: bool) -> np.ndarray:
    p = np.array([(v["x"], v["y"]) for v in points], float).reshape(-1, 2)
    if len(p) and (p[0] == p[-1]).all():
        p = p[:-1]
    q = np.roll(p, -1, axis=0)
    turns_left = (p[:, 0] * q[:, 1] - q[:, 0] * p[:, 1]).sum() > 0
    return p if turns_left == anticlockwise else p[::-1]


def grown_polygon(geom: list, by: float) -> list:
    """A polygon (parts of a shell and holes that do not cross themselves) with all that is within ``by`` of it; corners are round,
    as ``overlay.QUARTER`` sides a quarter inside the true arc."""
    curves = [overlay.moved_out(_ring(ring, k == 0), by) for part in geom for k, ring in enumerate(part)]
    sides = np.concatenate([np.zeros((0, 4)), *curves])
    return points_of(assemble(overlay.outline(sides, overlay.covered(sides))))


def grown(layer: DataFrame, by: float) -> DataFrame:
    """layer's polygons grown by a distance of 0 or more; null and empty geometries go. A polygon is one row's work: meant for
    boundaries, of which there is one a city."""
    if by < 0:
        raise ValueError("polygons are not made smaller")
    rows = layer.where(F.size(F.flatten(F.flatten("geom"))) > 0).withColumn("_by", F.lit(float(by)))
    return _rebuilt(rows, lambda r: grown_polygon(r["geom"], r["_by"]) if r["_by"] else r["geom"], "_by")
