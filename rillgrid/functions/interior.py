"""A point that is surely inside a polygon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgrid.functions.columns import bounds, edges


def with_interior_point(df: DataFrame, geom: str = "geom", name: str = "interior") -> DataFrame:
    """df with struct<x, y>: on the line half-way between the vertices' heights that bracket the box's middle, the middle of the
    widest run inside. A polygon of no height gives its box's middle; a null or empty one null."""
    points = F.flatten(F.flatten(geom))
    df = df.withColumns({"_b": bounds(F.col(geom)), "_ys": F.transform(points, lambda p: p["y"]), "_sides": F.flatten(F.transform(F.flatten(geom), edges))})
    middle = (F.col("_b.ymin") + F.col("_b.ymax")) / 2
    low, high = F.array_max(F.filter("_ys", lambda y: y <= middle)), F.array_min(F.filter("_ys", lambda y: y > middle))
    df = df.withColumn("_y", (low + high) / 2)
    y = F.col("_y")
    across = F.filter("_sides", lambda e: (e["y1"] > y) != (e["y2"] > y))
    df = df.withColumn("_xs", F.array_sort(F.transform(across, lambda e: e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"]))))
    starts = F.filter(F.col("_xs"), lambda x, i: i % 2 == 0)
    ends = F.filter(F.col("_xs"), lambda x, i: i % 2 == 1)
    # the leftmost of equally wide runs
    runs = F.zip_with(starts, ends, lambda a, b: F.named_struct(F.lit("w"), b - a, F.lit("left"), -a, F.lit("x"), (a + b) / 2))
    best = F.array_max(runs)
    flat = F.struct(((F.col("_b.xmin") + F.col("_b.xmax")) / 2).alias("x"), middle.alias("y"))
    point = F.when(best.isNotNull(), F.struct(best["x"].alias("x"), y.alias("y"))).when(F.col("_b.xmin").isNotNull(), flat)
    return df.withColumn(name, point).drop("_b", "_ys", "_sides", "_y", "_xs")


