"""Hourly rain to a hazard value for each building. Missing values are null (readers turn NaN into null)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillgrid.functions.columns import expected_hours
from rillgrid.operators.nearest import candidates, leaf_pairs, nearest_of_points, segment_tree, target_tree
from rillgrid.plans.cache import cut

CELL = ["latitude", "longitude"]


def continuity(hourly: DataFrame, time: str = "time") -> DataFrame:
    """city, year, n_hours, expected, min_step_s, max_step_s, complete: over distinct stamps, so cells do not matter. A year is
    complete if it has all its hours, each one hour after the other, in twelve months. Steps are in seconds: a step of 90
    minutes is no hour."""
    stamps = hourly.select("city", F.year(time).alias("year"), F.col(time).alias("_t")).distinct()
    step = F.unix_timestamp("_t") - F.unix_timestamp(F.lag("_t").over(Window.partitionBy("city", "year").orderBy("_t")))
    got = stamps.withColumn("_step", step).groupBy("city", "year").agg(F.count("*").alias("n_hours"), F.count_distinct(F.month("_t")).alias("n_months"), F.min("_step").alias("min_step_s"), F.max("_step").alias("max_step_s"))
    got = got.withColumn("expected", expected_hours(F.col("year")))
    ok = (F.col("n_hours") == F.col("expected")) & (F.col("n_months") == 12) & (F.col("min_step_s") == 3600) & (F.col("max_step_s") == 3600)
    return got.select("city", "year", "n_hours", "n_months", "expected", "min_step_s", "max_step_s", F.coalesce(ok, F.lit(False)).alias("complete"))


def check_continuity(hourly: DataFrame, time: str = "time") -> None:
    """Raises if a city's year is not complete."""
    bad = continuity(hourly, time).where("not complete").orderBy("city", "year").limit(5).collect()
    if bad:
        raise ValueError("hours are missing or out of step: " + "; ".join(f"{r.city} {r.year}: {r.n_hours} of {r.expected}, steps {r.min_step_s} to {r.max_step_s} s" for r in bad))


def deaccumulated(hourly: DataFrame, time: str = "time", value: str = "tp") -> DataFrame:
    """hourly with each hour's own rain, for series that add up since midnight UTC."""
    order = Window.partitionBy("city", *CELL, F.to_date(time)).orderBy(time)
    before = F.lag(value).over(order)
    return hourly.withColumn(value, F.when(before.isNull(), F.col(value)).otherwise(F.greatest(F.lit(0.0), F.col(value) - before)))


def annual_maxima(hourly: DataFrame, time: str = "time", value: str = "tp") -> DataFrame:
    """city, year, latitude, longitude, tp_amax_mm: the wettest hour of each cell's year; null if the cell has no value."""
    return hourly.groupBy("city", F.year(time).alias("year"), *CELL).agg(F.max(F.col(value) * 1000.0).alias("tp_amax_mm"))


def climatology(maxima: DataFrame, years: tuple[int, ...]) -> DataFrame:
    """city, latitude, longitude, H_pluvial_v1_mm: the mean of the yearly maxima. Raises if a city lacks one of the years."""
    wanted = set(years)
    has = maxima.where(F.col("year").isin(*years)).groupBy("city").agg(F.collect_set("year").alias("years")).collect()
    lacking = {r.city: sorted(wanted - set(r.years)) for r in has if wanted - set(r.years)}
    if lacking or not has:
        raise ValueError(f"years are missing: {lacking or 'all'}")
    return maxima.where(F.col("year").isin(*years)).groupBy("city", *CELL).agg(F.avg("tp_amax_mm").alias("H_pluvial_v1_mm"))


FEW_PAIRS = 2_000_000  # of empty and filled cells, that are compared one by one
FEW_CELLS = 100_000  # that may be broadcast: a few MB
UNITS = 1e5  # of a degree, for the trees, which tell quarters of a unit apart


def filled(grid: DataFrame, value: str = "H_pluvial_v1_mm") -> DataFrame:
    """grid with its empty cells filled from the nearest cell that has a value, in plain degrees; ties go to the lower latitude, then
    the lower longitude. A city without any value stays empty (``check_filled`` raises).

    The empty cells of a few dozen are compared with all that have a value. Beyond FEW_PAIRS such pairs, the cells nearest to each
    are looked for by trees of boxes (see ``nearest``), so the work goes with the cells.
    """
    have = grid.where(F.col(value).isNotNull()).select("city", F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"), F.col(value).alias("_v"))
    empty = grid.where(F.col(value).isNull()).select("city", *CELL)
    sizes = grid.groupBy("city").agg(F.count(value).alias("n"), F.count("*").alias("all"))
    pairs = sizes.agg(F.sum(F.col("n").cast("double") * (F.col("all") - F.col("n")))).first()[0] or 0
    lat, lon = F.col("latitude") - F.col("_lat"), F.col("longitude") - F.col("_lon")
    met = empty.join(have, "city") if pairs <= FEW_PAIRS else _nearest_cells(empty, have)
    near = met.groupBy("city", *CELL).agg(F.min_by("_v", F.struct(F.round(lat * lat + lon * lon, 12), F.col("_lat"), F.col("_lon"))).alias("_fill"))
    return grid.join(near, ["city", *CELL], "left").withColumn("was_filled", F.col(value).isNull() & F.col("_fill").isNotNull()).withColumn(value, F.coalesce(value, "_fill")).drop("_fill")


def _nearest_cells(empty: DataFrame, have: DataFrame) -> DataFrame:
    """Each empty cell with the cells that are nearest to it, or but a rounding farther."""
    cells = cut(empty.distinct().withColumn("cell", F.monotonically_increasing_id()))
    targets = target_tree(cells.select("city", "cell", (F.col("longitude") * UNITS).alias("px"), (F.col("latitude") * UNITS).alias("py"), F.lit(0.5).alias("reach")), ("city",), "cell")
    points = have.withColumns({"x1": F.col("_lon") * UNITS, "y1": F.col("_lat") * UNITS}).withColumns({"x2": F.col("x1"), "y2": F.col("y1")})
    sources = segment_tree(points, ("city",))
    pairs = leaf_pairs(targets, sources)
    least = cut(nearest_of_points(targets, sources, pairs, "cell"))
    close = candidates(targets, sources, pairs, least).where(F.hypot(F.col("x1") - F.col("px"), F.col("y1") - F.col("py")) <= F.col("u") + 0.5)
    found = close.select("city", "cell", "x1", "y1").join(points, ["city", "x1", "y1"]).select("city", "cell", "_lat", "_lon", "_v")
    return found.join(cells, ["city", "cell"])


def check_filled(grid: DataFrame, value: str = "H_pluvial_v1_mm") -> None:
    empty = grid.groupBy("city").agg(F.count(value).alias("n")).where("n = 0").orderBy("city").limit(5).collect()
    if empty:
        raise ValueError(f"no cell has a value: {[r.city for r in empty]}")


def axes(grid: DataFrame) -> DataFrame:
    """city, lats, lons: the sorted axes, one small row a city."""
    return grid.groupBy("city").agg(F.array_sort(F.collect_set("latitude")).alias("lats"), F.array_sort(F.collect_set("longitude")).alias("lons"))


def interpolated(points: DataFrame, grid: DataFrame, value: str = "H_pluvial_v1_mm") -> DataFrame:
    """points (city, lon, lat, ...) with value: bilinear between the four cells round each point, clamped to the grid; the nearest
    cell's where a corner is missing. Points on the last axis value use the last interval; a one-row or one-column grid uses its
    nearest; of two nearest the lower axis value counts. Every square of four cells is a row, which points are joined with by number;
    axes and squares are broadcast if there are FEW_CELLS at most."""
    few = F.broadcast if grid.count() <= FEW_CELLS else (lambda df: df)
    ax = axes(grid)
    cells = grid.join(few(ax), "city").select("city", (F.array_position("lats", F.col("latitude")) - 1).cast("int").alias("i"), (F.array_position("lons", F.col("longitude")) - 1).cast("int").alias("j"), F.col(value).alias("v"))
    corners = [(di, dj) for di in (0, 1) for dj in (0, 1)]
    as_corner = F.array(*[F.struct((F.col("i") - di).alias("_i"), (F.col("j") - dj).alias("_j"), F.lit(f"{di}{dj}").alias("c")) for di, dj in corners])
    squares = cells.where("v is not null").select("city", "v", F.inline(as_corner))
    squares = squares.groupBy("city", "_i", "_j").agg(*[F.max(F.when(F.col("c") == f"{di}{dj}", F.col("v"))).alias(f"_c{di}{dj}") for di, dj in corners])

    def place(v: str, axis: str) -> tuple:
        clamped = F.greatest(F.element_at(axis, 1), F.least(F.element_at(axis, -1), F.col(v)))
        low = F.greatest(F.lit(0), F.least(F.size(axis) - 2, F.size(F.filter(axis, lambda a: a <= clamped)) - 1))
        return clamped, low

    p = points.join(few(ax), "city", "left")
    p = p.withColumns({"_y": place("lat", "lats")[0], "_i": place("lat", "lats")[1], "_x": place("lon", "lons")[0], "_j": place("lon", "lons")[1]})
    share = lambda v, axis, k: F.when(F.size(axis) > 1, (F.col(v) - F.get(axis, F.col(k))) / (F.get(axis, F.col(k) + 1) - F.get(axis, F.col(k)))).otherwise(0.0)
    p = p.withColumns({"_ty": share("_y", "lats", "_i"), "_tx": share("_x", "lons", "_j")}).drop("lats", "lons")
    p = p.join(few(squares), ["city", "_i", "_j"], "left")
    c00, c01, c10, c11 = (F.col(f"_c{di}{dj}") for di, dj in corners)
    tx, ty = F.col("_tx"), F.col("_ty")
    near = F.when(ty > 0.5, F.when(tx > 0.5, c11).otherwise(c10)).otherwise(F.when(tx > 0.5, c01).otherwise(c00))
    # a corner without weight may be missing
    at10, at01 = F.when(ty == 0, c00).otherwise(c10), F.when(tx == 0, c00).otherwise(c01)
    at11 = F.when((tx == 0) & (ty == 0), c00).when(tx == 0, c10).when(ty == 0, c01).otherwise(c11)
    linear = c00 * (1 - tx) * (1 - ty) + at01 * tx * (1 - ty) + at10 * (1 - tx) * ty + at11 * tx * ty
    out = p.withColumn("_value", F.coalesce(linear, near))
    return out.select(*points.columns, F.col("_value").alias(value)) if value not in points.columns else out.withColumn(value, F.col("_value")).select(*points.columns)


def profile(hourly: DataFrame, value: str = "tp") -> DataFrame:
    """city, n, n_missing, finite_fraction, max, mean of the grid's values."""
    v = F.col(value)
    return hourly.groupBy("city").agg(F.count("*").alias("n"), F.count_if(v.isNull()).alias("n_missing"), F.avg(F.when(v.isNotNull(), 1.0).otherwise(0.0)).alias("finite_fraction"), F.max(v).alias("max"), F.avg(v).alias("mean"))


def columns_with_data(hourly: DataFrame, value: str = "tp") -> DataFrame:
    """city, longitude, has_data."""
    return hourly.groupBy("city", "longitude").agg((F.count(value) > 0).alias("has_data"))


def hazard_table(buildings: DataFrame, value: str = "H_pluvial_v1_mm", source: str = "ERA5-Land", metric: str = "mean_annual_max_1h_1991_2020", version: str = "v1") -> DataFrame:
    """The hazard's columns, value as float, with its three constant labels."""
    return buildings.select("city", "bldg_id", F.col(value).cast("float").alias(value), F.lit(source).alias("hazard_src"), F.lit(metric).alias("hazard_metric"), F.lit(version).alias("hazard_version"))
