"""Rows numbered in an order, running sums, and the order along a curve that fills the plane; none gathers the rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillgrid.functions.columns import once
from rillgrid.plans.cache import cut

#: Coordinates are told apart to a quarter of a metre, from -2 ** 25 m to 2 ** 25 m.
STEPS, HALF = 4.0, 1 << 27
#: Masks of the bits of a number after each step of spreading them.
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def _spread(v: Column) -> Column:
    """The lower 28 bits of v with a zero after each."""

    def apart(by: int, mask: int):
        return lambda b: b.bitwiseOR(F.shiftleft(b, by)).bitwiseAND(F.lit(mask))

    for by, mask in _SPREAD:
        v = once(v, apart(by, mask))
    return v


def curve_place(x: Column, y: Column) -> Column:
    """Where a point lies on the Z-shaped curve through all quarter-metre squares: bits of x and y in turn. Null without either."""
    step = lambda c: F.least(F.greatest(F.floor(c * STEPS) + HALF, F.lit(0)), F.lit(2 * HALF - 1)).cast("long")
    return _spread(step(x)).bitwiseOR(F.shiftleft(_spread(step(y)), 1))


def _placed(rows: DataFrame, order: list[Column], by: tuple[str, ...], weight: str | None) -> DataFrame:
    """rows, sorted by ranges of (by, order), with their place (partition and row), and the weights of the partitions before."""
    placed = cut(rows.orderBy(*by, *order).withColumn("_place_in_order", F.monotonically_increasing_id())).withColumn("_part_in_order", F.shiftright("_place_in_order", 33).cast("int"))
    sizes = placed.groupBy("_part_in_order").agg(F.sum(weight).alias("n") if weight else F.count("*").alias("n")).orderBy("_part_in_order").collect()
    before, at = [], 0
    for part, n in sizes:
        before.append((part, at))
        at += n
    starts = rows.sparkSession.createDataFrame(before, "_part_in_order int, _before long")
    return placed.join(F.broadcast(starts), "_part_in_order")


def _within(out: DataFrame, by: tuple[str, ...], name: str) -> DataFrame:
    """Numbers over all rows as numbers of each ``by``."""
    if not by:
        return out
    first = out.groupBy(*by).agg(F.min(name).alias("_first"))
    return out.join(first, list(by)).withColumn(name, F.col(name) - F.col("_first")).drop("_first")


def numbered(rows: DataFrame, order: list[Column], by: tuple[str, ...] = (), name: str = "rank") -> DataFrame:
    """rows with their number in the order, from 0, for each ``by``.

    Rows are dealt out by ranges of (by, order) and sorted there; a row's number is its place in its partition and the sizes of
    the partitions before, of which the driver sees one figure each. Ties are numbered in any way, so give a total order; equal
    rows of it all lie in one partition. ``by`` must not be null.
    """
    out = _placed(rows, order, by, None)
    out = out.withColumn(name, F.col("_place_in_order").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before"))
    return _within(out, by, name).select(*rows.columns, name)


def running(rows: DataFrame, order: list[Column], weight: str, by: tuple[str, ...] = (), name: str = "before") -> DataFrame:
    """rows with the sum of ``weight`` (long) of the rows before them, for each ``by``; as numbered(), whose task sizes it has."""
    inside = Window.partitionBy("_part_in_order").orderBy("_place_in_order")
    out = _placed(rows, order, by, weight).withColumn(name, F.sum(weight).over(inside) - F.col(weight) + F.col("_before"))
    return _within(out, by, name).select(*rows.columns, name)
