"""Lines cut to boundaries. A boundary is one row a city (city, geom). Against a grown boundary it is broadcast by city if all of them
have few points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillgrid.functions.columns import bounds, edges, inside, segment_segment
from rillgrid.operators.cover import cell, cell_size, cover, inside_cell
from rillgrid.plans.cache import cut

FEW_POINTS = 500_000  # of all boundaries together, so that they may be broadcast: some 20 MB


def _beside(segments: DataFrame, boundary: DataFrame, grown: float = 0.0) -> DataFrame:
    """Segments with their city's boundary: its geometry, sides and box; those whose box it does not meet are left out."""
    b = boundary.select("city", F.col("geom").alias("_g")).withColumns({"_b": bounds(F.col("_g")), "_sides": F.flatten(F.transform(F.flatten("_g"), edges))})
    near = (F.greatest("x1", "x2") >= F.col("_b.xmin") - grown) & (F.least("x1", "x2") <= F.col("_b.xmax") + grown) & (F.greatest("y1", "y2") >= F.col("_b.ymin") - grown) & (F.least("y1", "y2") <= F.col("_b.ymax") + grown)
    points = boundary.agg(F.sum(F.size(F.flatten(F.flatten("geom"))))).first()[0] or 0
    return segments.join(F.broadcast(b) if points <= FEW_POINTS else b, "city").where(near)


def _crossings(e: Column) -> Column:
    """Where along the segment (0 to 1) a side crosses it; null if it does not."""
    dx, dy, ex, ey = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), e["x2"] - e["x1"], e["y2"] - e["y1"]
    det = dx * ey - dy * ex
    safe = F.when(det != 0, det)
    t = ((e["x1"] - F.col("x1")) * ey - (e["y1"] - F.col("y1")) * ex) / safe
    u = ((e["x1"] - F.col("x1")) * dy - (e["y1"] - F.col("y1")) * dx) / safe
    return F.when((t > 0) & (t < 1) & (u >= 0) & (u <= 1), t)


def _runs(stops: str | Column) -> Column:
    """The runs between neighbouring stops."""
    n = F.size(stops) - 1
    return F.zip_with(F.slice(stops, 1, n), F.slice(stops, 2, n), lambda a, b: F.named_struct(F.lit("a"), a, F.lit("b"), b))


def _joined(runs: Column) -> Column:
    """Sorted runs, those that touch or overlap as one."""

    def join(done: Column, p: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.named_struct(F.lit("a"), last["a"], F.lit("b"), F.greatest(last["b"], p["b"]))
        joined = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
        return F.when((F.size(done) > 0) & (p["a"] <= last["b"] + 1e-12), joined).otherwise(F.concat(done, F.array(p)))

    return F.aggregate(runs, F.array().cast("array<struct<a:double,b:double>>"), join)


def _at(p: str, q: str, t: Column) -> Column:
    return F.col(p) + (F.col(q) - F.col(p)) * t


def clip_lines(segments: DataFrame, boundary: DataFrame) -> DataFrame:
    """Segments (city, ..., x1, y1, x2, y2) cut to the boundary, attributes kept, with ``piece`` (where it begins, 0 to 1): parts
    whose middle is inside, those that touch put together. Segments without all coordinates go.

    A segment is cut at the borders of the grid cells that it passes; each of these parts meets the boundary's sides in its cell
    only (see ``cover``), and is kept or left out as a whole where there are none.
    """
    keep = segments.columns
    size = cell_size(boundary)
    whole = cut(segments.where("x1 is not null and y1 is not null and x2 is not null and y2 is not null").withColumn("_segment", F.monotonically_increasing_id()))

    def borders(p: str, q: str) -> Column:
        low, high = cell(F.least(p, q), size) + 1, cell(F.greatest(p, q), size)
        step = F.col(q) - F.col(p)
        lines = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
        return F.filter(F.transform(lines, lambda k: (k * size - F.col(p)) / F.when(step != 0, step)), lambda t: (t > 0) & (t < 1))

    stops = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0)), borders("x1", "x2"), borders("y1", "y2"), F.array(F.lit(1.0)))))
    parts = whole.select("_segment", "city", "x1", "y1", "x2", "y2", F.inline(_runs(stops)))
    middle = (F.col("a") + F.col("b")) / 2
    placed = parts.withColumns({"cx": cell(_at("x1", "x2", middle), size), "cy": cell(_at("y1", "y2", middle), size)})
    met = placed.join(cover(boundary, size), ["city", "cx", "cy"])
    inner = met.where("sides is null").select("_segment", "a", "b")
    ts = F.filter(F.transform("sides", _crossings), lambda t: (t > F.col("a")) & (t < F.col("b")))
    ts = F.array_sort(F.array_distinct(F.concat(F.array("a"), ts, F.array("b"))))
    pieces = met.where("sides is not null").withColumn("_p", F.explode(_runs(ts)))
    at = (F.col("_p.a") + F.col("_p.b")) / 2
    beside = pieces.where(inside_cell(_at("x1", "x2", at), _at("y1", "y2", at), size)).select("_segment", "_p.a", "_p.b")
    found = inner.union(beside).groupBy("_segment").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("_runs"))
    left = whole.join(found, "_segment").select(*keep, F.explode(_joined(F.col("_runs"))).alias("_run"))
    moved = {c: _at(f"{c[0]}1", f"{c[0]}2", F.col("_run.a" if c[1] == "1" else "_run.b")).alias(c) for c in ("x1", "y1", "x2", "y2")}
    return left.select(*[moved.get(c, F.col(c)) for c in keep], F.round("_run.a", 12).alias("piece"))


def _disc_span(x: Column, y: Column, r: float) -> tuple[Column, Column]:
    """From where to where along its line a segment is in the disc; null if it is not."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    fx, fy = x - F.col("x1"), y - F.col("y1")
    a, along = dx * dx + dy * dy, fx * dx + fy * dy
    under = along * along - a * (fx * fx + fy * fy - r * r)
    met = (a > 0) & (under >= 0)
    root, safe = F.sqrt(F.when(met, under)), F.when(met, a)
    return (along - root) / safe, (along + root) / safe


def _band_span(start: Column, step: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """From where to where start + t * step lies between low and high; null if never, without an end where it always does."""
    a, b = (low - start) / F.when(step != 0, step), (high - start) / F.when(step != 0, step)
    always = (step == 0) & (start >= low) & (start <= high)
    first = F.when(always, float("-inf")).otherwise(F.when(step != 0, F.least(a, b)))
    return first, F.when(always, float("inf")).otherwise(F.when(step != 0, F.greatest(a, b)))


def _near_span(e: Column, r: float) -> Column:
    """struct<a, b>: the one run of the segment (0 to 1) within r of a side; a is null or not before b if there is none.

    What is within r of a side is convex: two discs, and the upright band between them.
    """
    ex, ey = e["x2"] - e["x1"], e["y2"] - e["y1"]
    size = F.hypot(ex, ey)
    safe = F.when(size > 0, size)
    fx, fy = F.col("x1") - e["x1"], F.col("y1") - e["y1"]
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    low1, high1 = _band_span((fx * ex + fy * ey) / safe, (dx * ex + dy * ey) / safe, F.lit(0.0), size)
    low2, high2 = _band_span((ex * fy - ey * fx) / safe, (ex * dy - ey * dx) / safe, F.lit(-r), F.lit(r))
    low, high = F.greatest(low1, low2), F.least(high1, high2)
    both = low1.isNotNull() & low2.isNotNull() & (low <= high)
    spans = [_disc_span(e["x1"], e["y1"], r), _disc_span(e["x2"], e["y2"], r), (F.when(both, low), F.when(both, high))]
    # least and greatest pass over nulls
    first, last = F.least(*[s[0] for s in spans]), F.greatest(*[s[1] for s in spans])
    return F.named_struct(F.lit("a"), F.greatest(first, F.when(first.isNotNull(), F.lit(0.0))), F.lit("b"), F.least(last, F.when(last.isNotNull(), F.lit(1.0))))


def clip_lines_grown(segments: DataFrame, boundary: DataFrame, buffer_m: float) -> DataFrame:
    """Segments (city, ..., x1, y1, x2, y2) cut to the boundary grown by buffer_m, with ``piece`` (where it begins, 0 to 1): runs
    inside, and within that distance of a side, put together. Corners are round. A segment without length stays if it is inside."""
    keep = segments.columns
    met = _beside(segments, boundary, buffer_m)
    ts = F.array_sort(F.array_distinct(F.filter(F.transform("_sides", _crossings), lambda t: t.isNotNull())))
    met = met.withColumn("_t", F.concat(F.array(F.lit(0.0)), ts, F.array(F.lit(1.0))))
    middle = lambda p: (p["a"] + p["b"]) / 2
    within = F.filter(_runs("_t"), lambda p: inside(_at("x1", "x2", middle(p)), _at("y1", "y2", middle(p)), F.col("_g")))
    close = F.filter(F.transform("_sides", lambda e: _near_span(e, buffer_m)), lambda p: p["a"] < p["b"])
    met = met.withColumn("_runs", F.array_sort(F.concat(within, close)))
    pieces = met.withColumn("_p", F.explode(_joined(F.col("_runs"))))
    a, b = F.col("_p.a"), F.col("_p.b")
    moved = {"x1": _at("x1", "x2", a), "y1": _at("y1", "y2", a), "x2": _at("x1", "x2", b), "y2": _at("y1", "y2", b)}
    return pieces.select(*[moved[c].alias(c) if c in moved else F.col(c) for c in keep], F.round(a, 12).alias("piece"))


def near_boundary(segments: DataFrame, boundary: DataFrame, buffer_m: float) -> DataFrame:
    """Whole segments that meet the boundary grown by buffer_m: inside it, or within that distance of a side."""
    met = _beside(segments, boundary, buffer_m)
    ends = tuple(map(F.col, ("x1", "y1", "x2", "y2")))
    close = F.exists("_sides", lambda e: segment_segment((e["x1"], e["y1"], e["x2"], e["y2"]), ends) <= buffer_m)
    return met.where(inside(ends[0], ends[1], F.col("_g")) | close).select(*segments.columns)


def clip_to_box(segments: DataFrame, box: DataFrame) -> DataFrame:
    """Segments cut to their city's box (city, xmin, ymin, xmax, ymax)."""
    p = lambda x, y: F.named_struct(F.lit("x"), F.col(x), F.lit("y"), F.col(y))
    ring = F.array(p("xmin", "ymin"), p("xmax", "ymin"), p("xmax", "ymax"), p("xmin", "ymax"), p("xmin", "ymin"))
    return clip_lines(segments, box.select("city", F.array(F.array(ring)).alias("geom")))
