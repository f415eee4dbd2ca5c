"""Nearest segments by two trees that are searched together.

Segments and targets are packed along a plane-filling curve: LOAD neighbours on it are a leaf, FAN leaves a node, and so on, each
with the box of what it holds and the middle of one row. So every leaf holds the same number of rows, however dense or far apart they lie. From the roots
down, a node of targets keeps those nodes of segments that may hold the nearest one of any of its targets: whose box is no farther
than the middle of one segment of some other (upper bound), allowing for the targets' own reach. The pairs kept are a few for each
node of targets, and each level is equi-joins on node numbers. Neither the extent nor the gaps between towns change the rounds:
their number is the depth of the trees.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillgrid.functions.columns import point_segment
from rillgrid.operators.numbering import curve_place, numbered
from rillgrid.plans.cache import cut

LOAD = 16  # rows of a leaf
FAN = 4  # nodes of a node
ROUNDING = 1e-6
BOX = ("xmin", "ymin", "xmax", "ymax")
HELD = (*BOX, "mx", "my")  # of a leaf of segments: its box, and the middle of one
ENDS = ("x1", "y1", "x2", "y2")


@dataclass
class Tree:
    rows: DataFrame  # by, ..., leaf
    levels: list[DataFrame]  # by, node, box, reach; the leaves first
    by: tuple[str, ...]


def packed(rows: DataFrame, by: tuple[str, ...], middle: tuple[Column, Column], box: dict[str, Column], order: list[str], load: int = LOAD, fan: int = FAN) -> Tree:
    """The tree of rows for each ``by``; ``order`` tells rows of one place apart, ``reach`` is a column of theirs or nothing."""
    along = numbered(rows.withColumn("_z", curve_place(*middle)), [F.col(c) for c in ("_z", *order)], by, "leaf").drop("_z")
    members = cut(along.withColumns({"leaf": F.floor(F.col("leaf") / load), "_central": F.col("leaf") % load == load // 2}))
    point = F.struct(middle[0].alias("mx"), middle[1].alias("my"))
    one = F.coalesce(F.max(F.when(F.col("_central"), point)), F.max(point)).alias("_m")
    reach = F.max("reach") if "reach" in rows.columns else F.lit(0.0)
    low_high = [(F.min if c.endswith("min") else F.max)(box[c]).alias(c) for c in BOX]
    nodes = cut(members.groupBy(*by, F.col("leaf").alias("node")).agg(*low_high, reach.alias("reach"), one).select("*", "_m.*").drop("_m"))
    levels = [nodes]
    last = nodes.agg(F.max("node")).first()[0] or 0
    up = [(F.min if c.endswith("min") else F.max)(c).alias(c) for c in (*BOX, "reach")]
    while last >= fan ** len(levels):
        above = nodes.groupBy(*by, F.floor(F.col("node") / fan ** len(levels)).alias("node")).agg(*up, F.max(F.struct("mx", "my")).alias("_m"))
        levels.append(above.select("*", "_m.*").drop("_m"))
    return Tree(members.drop("_central"), levels, by)


def gap(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Least distance of two boxes."""
    dx = F.greatest(F.lit(0.0), a["xmin"] - b["xmax"], b["xmin"] - a["xmax"])
    dy = F.greatest(F.lit(0.0), a["ymin"] - b["ymax"], b["ymin"] - a["ymax"])
    return F.sqrt(dx * dx + dy * dy)


def farthest(a: dict[str, Column], x: Column, y: Column) -> Column:
    """Greatest distance of a box's points from a point."""
    dx, dy = F.greatest(a["xmax"] - x, x - a["xmin"]), F.greatest(a["ymax"] - y, y - a["ymin"])
    return F.sqrt(dx * dx + dy * dy)


def _box(prefix: str) -> dict[str, Column]:
    return {c: F.col(f"{prefix}{c}") for c in BOX}


def _named(level: DataFrame, by: tuple[str, ...], prefix: str, parent: Column) -> DataFrame:
    return level.select(*by, parent.alias(f"{prefix}parent"), F.col("node").alias(prefix), *[F.col(c).alias(f"{prefix}{c}") for c in (*BOX, "reach", "mx", "my")])


def leaf_pairs(targets: Tree, segments: Tree, fan: int = FAN) -> DataFrame:
    """(by of the segments, t, s, box and middle of s): for each leaf of targets the leaves that may hold the nearest segment of one of them.
    The targets' ``by`` is part of the segments'."""
    high, by = max(len(targets.levels), len(segments.levels)) - 1, list(segments.by)
    pairs = None
    for at in range(high, -1, -1):
        below = lambda tree: at < len(tree.levels) - 1 and pairs is not None  # noqa: B023, E731
        own = [_named(tree.levels[min(at, len(tree.levels) - 1)], tree.by, p, F.floor(F.col("node") / fan) if below(tree) else F.col("node")) for tree, p in ((targets, "t"), (segments, "s"))]
        if pairs is None:
            met = own[0].join(own[1], list(targets.by))
        else:
            parents = pairs.withColumnsRenamed({"t": "tparent", "s": "sparent"})
            met = parents.join(own[0], [*targets.by, "tparent"]).join(own[1], [*by, "sparent"])
        met = met.withColumns({"_low": gap(_box("t"), _box("s")), "_high": farthest(_box("t"), F.col("smx"), F.col("smy"))})
        least = F.min("_high").over(Window.partitionBy(*by, "t"))
        kept = met.withColumn("_most", least).where(F.col("_low") <= F.col("_most") + 2 * F.col("treach") + ROUNDING)
        pairs = cut(kept.select(*by, "t", "s", *([] if at else [f"s{c}" for c in HELD])))
    return pairs


def candidates(targets: Tree, segments: Tree, pairs: DataFrame, most: DataFrame | None = None) -> DataFrame:
    """The targets' rows with the segments of those leaves that may hold the nearest one, a row each. most: by of the segments, the
    targets' columns that tell them apart, and ``u``: a leaf may then be as far as u and twice the target's reach."""
    by = list(segments.by)
    listed = pairs.groupBy(*by, F.col("t").alias("leaf")).agg(F.collect_list(F.struct("s", *[F.col(f"s{c}").alias(c) for c in HELD])).alias("_leaves"))
    rows = targets.rows.join(listed, [*targets.by, "leaf"]).drop("leaf")
    point = {"xmin": F.col("px"), "xmax": F.col("px"), "ymin": F.col("py"), "ymax": F.col("py")}
    of = lambda v: {c: v[c] for c in BOX}
    if most is None:
        rows = rows.withColumn("u", F.array_min(F.transform("_leaves", lambda v: farthest(point, v["mx"], v["my"]))))
        limit = F.col("u") + ROUNDING
    else:
        rows = rows.join(most, [c for c in most.columns if c != "u"])
        limit = F.col("u") + 2 * F.col("reach") + ROUNDING
    near = F.filter("_leaves", lambda v: gap(point, of(v)) <= limit)
    rows = rows.withColumn("s", F.explode(F.transform(near, lambda v: v["s"]))).drop("_leaves")
    held = segments.rows.groupBy(*by, F.col("leaf").alias("s")).agg(F.collect_list(F.struct(*ENDS)).alias("_segments"))
    return rows.join(held, [*by, "s"]).select(*rows.drop("s").columns, F.inline("_segments"))


def segment_tree(segments: DataFrame, by: tuple[str, ...]) -> Tree:
    """Equal segments are one."""
    x1, y1, x2, y2 = (F.col(c) for c in ENDS)
    box = {"xmin": F.least(x1, x2), "xmax": F.greatest(x1, x2), "ymin": F.least(y1, y2), "ymax": F.greatest(y1, y2)}
    return packed(segments.select(*by, *ENDS).distinct(), by, ((x1 + x2) / 2, (y1 + y2) / 2), box, list(ENDS))


def target_tree(targets: DataFrame, by: tuple[str, ...], key: str) -> Tree:
    """targets: by, key, px, py, reach."""
    x, y = F.col("px"), F.col("py")
    return packed(targets, by, (x, y), {"xmin": x, "xmax": x, "ymin": y, "ymax": y}, [key])


def nearest_of_points(targets: Tree, segments: Tree, pairs: DataFrame, key: str) -> DataFrame:
    """(by of the segments, key, u): the least distance of each target's point to the segments."""
    d = point_segment(*map(F.col, ("px", "py", *ENDS)))
    return candidates(targets, segments, pairs).select(*segments.by, key, d.alias("_d")).groupBy(*segments.by, key).agg(F.min("_d").alias("u"))
