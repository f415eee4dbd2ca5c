"""Boundaries by grid cells: what sides a cell has, and whether its corner is inside. So a line meets the sides of the cells that it
passes, in an equi-join, and cells without sides are inside or outside as a whole, however many sides a boundary has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillgrid.functions.columns import bounds
from rillgrid.operators.spatial import split_long, to_segments

#: Where in a cell it is told whether one is inside: by its lower left corner, off it by an odd bit, so that sides seldom go through.
OFF_X, OFF_Y = 0.00137, 0.00091
MARGIN = 1e-6  # sides count in cells that they almost touch
SIDES_A_CELL = 50  # about so many sides for each cell across
LEAST_ACROSS, MOST_ACROSS = 16, 1024


def cell_size(boundary: DataFrame) -> float:
    """A width of cells by which the widest boundary has LEAST_ACROSS to MOST_ACROSS cells, more for more sides."""
    b = boundary.select(bounds(F.col("geom")).alias("b"), F.size(F.flatten(F.flatten("geom"))).alias("n"))
    extent, n = b.agg(F.max(F.greatest(F.col("b.xmax") - F.col("b.xmin"), F.col("b.ymax") - F.col("b.ymin"))), F.max("n")).first()
    return max(extent or 1.0, 1.0) / min(max((n or 0) // SIDES_A_CELL, LEAST_ACROSS), MOST_ACROSS)


def cell(v: Column, size: float) -> Column:
    return F.floor(v / size).cast("long")


def cover(boundary: DataFrame, size: float) -> DataFrame:
    """city, cx, cy, corner, sides: the cells that boundary sides pass, with these (x1, y1, x2, y2), and those inside without any
    (sides is null); corner says whether the cell's corner is inside. Cells outside are not there. boundary: city, geom.

    Sides that cross the level line through a row's corners turn all corners to their right over: sums along a row give the state of
    its cells, and of the gaps between cells that have sides.
    """
    sides = to_segments(boundary, "city").select("city", "x1", "y1", "x2", "y2").where("x1 <> x2 or y1 <> y2")
    whole = F.struct("x1", "y1", "x2", "y2").alias("side")
    parts = split_long(sides.select("city", whole, "x1", "y1", "x2", "y2"), size)
    span = lambda a, b: F.sequence(cell(F.least(a, b) - MARGIN, size), cell(F.greatest(a, b) + MARGIN, size))
    passed = parts.withColumn("cx", F.explode(span("x1", "x2"))).withColumn("cy", F.explode(span("y1", "y2")))
    held = passed.groupBy("city", "cx", "cy").agg(F.collect_set("side").alias("sides"))
    rows = sides.withColumn("cy", F.explode(F.sequence(cell(F.least("y1", "y2") - OFF_Y, size), cell(F.greatest("y1", "y2") - OFF_Y, size))))
    y = F.col("cy") * size + OFF_Y
    crossing = F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / F.when(F.col("y1") != F.col("y2"), F.col("y2") - F.col("y1"))
    turned = rows.where((F.col("y1") > y) != (F.col("y2") > y)).select("city", "cy", (cell(crossing - OFF_X, size) + 1).alias("cx"))
    turned = turned.groupBy("city", "cy", "cx").agg(F.count("*").alias("turns"))
    both = held.select("city", "cy", "cx", "sides", F.lit(0).cast("long").alias("turns")).unionByName(turned.withColumn("sides", F.lit(None)), allowMissingColumns=True)
    places = both.groupBy("city", "cy", "cx").agg(F.first("sides", ignorenulls=True).alias("sides"), F.sum("turns").alias("turns"))
    row = Window.partitionBy("city", "cy").orderBy("cx")
    states = places.withColumns({"corner": F.sum("turns").over(row) % 2 == 1, "_next": F.lead("cx").over(row)})
    passed_cells = states.where("sides is not null").select("city", "cx", "cy", "corner", "sides")
    first = F.when(F.col("sides").isNull(), F.col("cx")).otherwise(F.col("cx") + 1)
    inner = states.where("corner and _next is not null").withColumn("_first", first).where("_first < _next")
    inner = inner.select("city", F.explode(F.sequence(F.col("_first"), F.col("_next") - 1)).alias("cx"), "cy", "corner", F.lit(None).cast(states.schema["sides"].dataType).alias("sides"))
    return passed_cells.unionByName(inner)


def inside_cell(x: Column, y: Column, size: float) -> Column:
    """Whether a point of a cell (cx, cy, corner, sides) is inside: the way from the corner goes upright, then level."""
    at_x, at_y = F.col("cx") * size + OFF_X, F.col("cy") * size + OFF_Y

    def crossed(e: Column) -> Column:
        across, up = (e["x1"] > at_x) != (e["x2"] > at_x), (e["y1"] > y) != (e["y2"] > y)
        height = e["y1"] + (at_x - e["x1"]) * (e["y2"] - e["y1"]) / F.when(across, e["x2"] - e["x1"])
        place = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / F.when(up, e["y2"] - e["y1"])
        upright = across & ((height > at_y) != (height > y))
        level = up & ((place > at_x) != (place > x))
        return F.coalesce(upright, F.lit(False)) != F.coalesce(level, F.lit(False))

    return F.col("corner") != (F.size(F.filter("sides", crossed)) % 2 == 1)
