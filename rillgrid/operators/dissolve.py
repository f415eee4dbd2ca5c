"""Features of a layer made one geometry, whether they are apart, touch or overlap."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgrid.functions import overlay
from rillgrid.functions.columns import GEOMETRY, bounds, edges, ring_turn
from rillgrid.plans.cache import cut, written

Point = tuple[float, float]
#: Arrow's form of a geometry.
KIND = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


def _rings(sides: list[tuple[Point, Point]]) -> list[list[Point]]:
    """Directed sides chained to closed rings; at a vertex where several leave, the one that turns most to the right is next, so
    that rings that touch in a point stay apart."""
    import math

    leaving: dict[Point, list[Point]] = defaultdict(list)
    for a, b in sorted(sides):
        leaving[a].append(b)
    out = []
    starts = iter(sorted(leaving))
    while leaving:
        start = next(p for p in starts if p in leaving)
        starts = chain([start], starts)  # more than one ring may leave it
        ring, here, last = [start], start, None
        while True:
            ways = leaving[here]
            if last is None or len(ways) == 1:
                nxt = ways[0]
            else:
                back = math.atan2(last[1] - here[1], last[0] - here[0])
                nxt = min(ways, key=lambda p: (back - math.atan2(p[1] - here[1], p[0] - here[0])) % (2 * math.pi) or 2 * math.pi)
            ways.remove(nxt)
            if not ways:
                del leaving[here]
            last, here = here, nxt
            ring.append(here)
            if here == start:
                break
            if here not in leaving:
                raise ValueError(f"the parts' edges do not close at {here}")
        out.append(ring)
    return out


def _area(ring: list[Point]) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False)) / 2


def _within(p: Point, ring: list[Point]) -> bool:
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
        if (y1 > p[1]) != (y2 > p[1]) and p[0] < x1 + (p[1] - y1) * (x2 - x1) / (y2 - y1):
            hit = not hit
    return hit


def assemble(sides: list[tuple[Point, Point]]) -> list[list[list[Point]]]:
    """Parts of shells and holes from what is left of the sides; shells go anticlockwise."""
    rings = _rings(sides)
    shells = sorted((r for r in rings if _area(r) > 0), key=lambda r: (_area(r), r))
    parts = [[s] for s in shells]
    boxes = np.array([(*map(min, zip(*s, strict=True)), *map(max, zip(*s, strict=True))) for s in shells]).reshape(-1, 4)
    for hole in (r for r in rings if _area(r) < 0):
        middle = ((hole[0][0] + hole[1][0]) / 2, (hole[0][1] + hole[1][1]) / 2)
        around = np.flatnonzero((boxes[:, :2] <= middle).all(axis=1) & (boxes[:, 2:] >= middle).all(axis=1))
        owner = next((parts[k] for k in around if _within(middle, parts[k][0])), None)
        if owner is not None:
            owner.append(hole)
    return sorted(parts)


def points_of(parts: list[list[list[Point]]]) -> list[list[list[dict]]]:
    return [[[{"x": x, "y": y} for x, y in ring] for ring in part] for part in parts]


def linked(links: DataFrame) -> DataFrame:
    """(id, least): the least id that can be reached from each id of links (a, b). Every round ids take the least of their neighbours'
    and of its own least, so a chain's rounds go with the logarithm of its length."""
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    now = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")))
    while True:
        near = both.join(now.select(F.col("a").alias("b"), "least"), "b").groupBy("a").agg(F.min("least").alias("_near"))
        new = now.join(near, "a").select("a", F.least("least", "_near").alias("least"), F.col("least").alias("_was"))
        far = new.select(F.col("a").alias("least"), F.col("least").alias("_far"))
        new = written(new.join(far, "least", "left").select("a", F.coalesce("_far", "least").alias("least"), "_was"))
        now = new.drop("_was")
        if new.where("least <> _was").isEmpty():
            return now.withColumnRenamed("a", "id")


def beside_each_other(layer: DataFrame, by: str) -> DataFrame:
    """layer (by, geom, _id) with _group, the least _id of those that it is linked with by boxes that meet, and _alone. Boxes are dealt to the
    grid cells that they lie in, twice as wide as a box is on average; a pair is made in the least cell that both have."""
    boxes = layer.select(by, "_id", bounds(F.col("geom")).alias("b")).select(by, "_id", "b.*")
    size = boxes.agg(F.avg(F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")))).first()[0] or 1.0
    cell = lambda c: F.floor(c / (2 * size)).cast("long")
    low = {"_x": cell(F.col("xmin")), "_y": cell(F.col("ymin"))}
    dealt = boxes.withColumns(low).withColumn("cx", F.explode(F.sequence(F.col("_x"), cell(F.col("xmax"))))).withColumn("cy", F.explode(F.sequence(F.col("_y"), cell(F.col("ymax")))))
    a, b = dealt.alias("a"), dealt.alias("b")
    least = (F.col("a.cx") == F.greatest("a._x", "b._x")) & (F.col("a.cy") == F.greatest("a._y", "b._y"))
    meet = (F.col("a.xmin") <= F.col("b.xmax")) & (F.col("b.xmin") <= F.col("a.xmax")) & (F.col("a.ymin") <= F.col("b.ymax")) & (F.col("b.ymin") <= F.col("a.ymax"))
    same = F.col(f"a.{by}").eqNullSafe(F.col(f"b.{by}")) & (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy"))
    pairs = a.join(b, same).where((F.col("a._id") < F.col("b._id")) & least & meet).select(F.col("a._id").alias("a"), F.col("b._id").alias("b"))
    groups = linked(pairs).select(F.col("id").alias("_id"), F.col("least").alias("_group"))
    return layer.join(groups, "_id", "left").withColumns({"_alone": F.col("_group").isNull(), "_group": F.coalesce("_group", "_id")})


def dissolved(layer: DataFrame, by: str = "city") -> DataFrame:
    """by, geom: the union of each group's polygons, which must not cross themselves; null and empty geometries count nothing.

    Polygons whose boxes are linked make one piece of work; one whose box meets no other's stays as it is. Within a piece, sides that two polygons share in opposite directions cancel out in Spark; what is left, its outline
    and the sides where polygons overlap, is cut at its crossings and chained. The parts of all pieces are the group's geometry.
    """
    apart = beside_each_other(cut(layer.where(F.size(F.flatten(F.flatten("geom"))) > 0).select(by, "geom").withColumn("_id", F.monotonically_increasing_id())), by)
    apart = cut(apart)
    key = [by, "_group"]
    rings = apart.where("not _alone").select(*key, F.explode("geom").alias("_p")).select(*key, F.posexplode("_p").alias("_k", "_r"))
    signed = ring_turn(F.col("_r"))
    # shells anticlockwise, holes clockwise
    turned = F.when((F.col("_k") == 0) == (signed > 0), F.col("_r")).otherwise(F.reverse("_r"))
    sides = rings.select(*key, F.explode(edges(turned)).alias("e")).select(*key, "e.*").where("x1 <> x2 or y1 <> y2")
    # a side and its reverse have one form, so that one sum cancels them
    forth = (F.col("x1") < F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") < F.col("y2")))
    ends = {"a1": ("x1", "x2"), "b1": ("y1", "y2"), "a2": ("x2", "x1"), "b2": ("y2", "y1")}
    formed = sides.select(*key, *[F.when(forth, F.col(p)).otherwise(F.col(q)).alias(n) for n, (p, q) in ends.items()], F.when(forth, 1).otherwise(-1).alias("way"))
    left = formed.groupBy(*key, "a1", "b1", "a2", "b2").agg(F.sum("way").alias("n")).where("n <> 0")
    ahead = F.col("n") > 0
    left = left.select(*key, *[F.when(ahead, F.col(p)).otherwise(F.col(q)).alias(n) for n, p, q in (("x1", "a1", "a2"), ("y1", "b1", "b2"), ("x2", "a2", "a1"), ("y2", "b2", "b1"))], F.abs("n").alias("n"))

    def chained(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        found = np.stack([np.asarray(table.column(c)) for c in ("x1", "y1", "x2", "y2")], axis=1)
        # a side that several polygons have in one direction counts so often
        turns = overlay.covered(np.repeat(found, np.asarray(table.column("n")), axis=0))
        geom = points_of(assemble(overlay.outline(found, turns)))
        yield pa.RecordBatch.from_pylist([{by: key[0].as_py(), "geom": geom}], schema=pa.schema([(by, key[0].type), ("geom", KIND)]))

    pieces = left.groupBy(*key).applyInArrow(chained, f"`{by}` {dict(layer.dtypes)[by]}, geom {GEOMETRY}")
    alone = apart.where("_alone").select(by, F.col("geom").cast(GEOMETRY).alias("geom"))
    return pieces.unionByName(alone).groupBy(by).agg(F.array_sort(F.flatten(F.collect_list("geom"))).alias("geom"))
