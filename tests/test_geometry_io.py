import json
import math

import pytest
from pyspark.sql import functions as F

from rillgrid.functions import crs
from rillgrid.functions.interior import with_interior_point
from rillgrid.operators import clip
from rillgrid.sources import files

PATH = "array<array<array<struct<x:double,y:double>>>>"


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def xy(spark, lon, lat, code):
    return spark.range(1).select(crs.from_lonlat(F.lit(lon), F.lit(lat), code).alias("p")).first().p


def test_projection_control_points(spark):
    p = xy(spark, 9.0, 45.0, 25832)
    assert math.isclose(p.x, 500000, abs_tol=1e-6) and math.isclose(p.y, 4984944.378 * 0.9996, abs_tol=0.01)
    p = xy(spark, 4.88352559, 52.37453253, 28992)
    assert abs(p.x - 120700.723) < 0.5 and abs(p.y - 487525.501) < 0.5


def test_dutch_control_points(spark):
    # published ETRS89 and RD coordinates; what is left is the correction grid, which goes up to 0.25 m
    points = [
        (53.160753042, 4.824761912, 117380.1200, 575040.3400),
        (53.419482050, 6.776726674, 247380.5600, 604580.7800),
        (52.155172897, 5.387203657, 155000.0000, 463000.0000),
        (51.368607152, 3.397588595, 16460.9100, 377380.2300),
        (50.792584916, 5.773795548, 182260.4500, 311480.6700),
        (51.947393898, 4.072887101, 64640.8900, 440700.0101),
    ]
    rows = spark.createDataFrame(points, "lat double, lon double, x double, y double")
    there = rows.withColumn("p", crs.from_lonlat(F.col("lon"), F.col("lat"), 28992))
    for r in there.withColumn("q", crs.to_lonlat(F.col("p.x"), F.col("p.y"), 28992)).collect():
        assert math.hypot(r.p.x - r.x, r.p.y - r.y) < 0.25
        assert abs(r.q.lon - r.lon) < 1e-9 and abs(r.q.lat - r.lat) < 1e-9


def test_dutch_projection_without_the_shift_of_datum(spark):
    # the origin by definition, a step along each axis at the scale of the origin, and there and back far from it
    lat0, lon0 = math.radians(52 + 9 / 60 + 22.178 / 3600), math.radians(5 + 23 / 60 + 15.5 / 3600)
    a, f = 6377397.155, 1 / 299.1528128
    e2 = f * (2 - f)
    w = math.sqrt(1 - e2 * math.sin(lat0) ** 2)
    rows = spark.createDataFrame([(0, lat0, lon0), (1, lat0 + 1e-6, lon0), (2, lat0, lon0 + 1e-6), (3, lat0 - 0.02, lon0 + 0.03)], "k int, lat double, lon double")
    got = {r.k: r for r in rows.withColumn("p", crs._rd_plane(F.col("lat"), F.col("lon"))).withColumn("q", crs._rd_unplane(F.col("p.x"), F.col("p.y"))).collect()}
    assert math.hypot(got[0].p.x - 155000, got[0].p.y - 463000) < 1e-6
    assert math.isclose(got[1].p.y - 463000, 0.9999079 * a * (1 - e2) / w**3 * 1e-6, rel_tol=1e-6) and abs(got[1].p.x - 155000) < 1e-6
    assert math.isclose(got[2].p.x - 155000, 0.9999079 * a / w * math.cos(lat0) * 1e-6, rel_tol=1e-6)
    assert all(abs(r.q.lat - r.lat) < 1e-13 and abs(r.q.lon - r.lon) < 1e-13 for r in got.values())


def test_dutch_system_in_a_geometry_and_where_coordinates_are_missing(spark):
    path = [[ring((4.48, 51.92), (4.49, 51.92), (4.49, 51.93), (4.48, 51.92))]]
    rows = spark.createDataFrame([(1, path, 4.48, 51.92), (2, None, None, None)], f"id int, geom {PATH}, lon double, lat double")
    got = rows.select("id", crs.reproject(F.col("geom"), 28992).alias("g"), crs.from_lonlat(F.col("lon"), F.col("lat"), 28992).alias("p"), crs.to_lonlat(F.col("lon"), F.col("lat"), 28992).alias("q")).orderBy("id").collect()
    assert (got[0].g[0][0][0].x, got[0].g[0][0][0].y) == (got[0].p.x, got[0].p.y)
    assert got[1].g is None and got[1].p.x is None and got[1].p.y is None and got[1].q.lon is None and got[1].q.lat is None


def test_projection_round_trips(spark):
    for code, lon, lat, tol in ((25832, 10.1, 53.6, 1e-8), (25830, -1.98, 43.31, 1e-8), (28992, 4.48, 51.92, 1e-9)):
        row = spark.range(1).select(crs.from_lonlat(F.lit(lon), F.lit(lat), code).alias("p")).select(crs.to_lonlat(F.col("p.x"), F.col("p.y"), code).alias("q")).first().q
        assert abs(row.lon - lon) < tol and abs(row.lat - lat) < tol


def test_interior_point_is_inside_an_ell(spark):
    shapes = [(1, [[ring((0, 0), (10, 0), (10, 2), (2, 2), (2, 10), (0, 10), (0, 0))]]), (2, [[ring((0, 0), (10, 0), (10, 10), (0, 10), (0, 0)), ring((4, 1), (4, 9), (9, 9), (9, 1), (4, 1))]]), (3, None)]
    got = {r.id: r.interior for r in with_interior_point(spark.createDataFrame(shapes, f"id int, geom {PATH}")).collect()}
    assert (got[1].x, got[1].y) == (1, 6) and (got[2].x, got[2].y) == (2, 5) and got[3] is None


def test_lines_are_cut_at_a_concave_boundary(spark):
    comb = [[ring((0, 0), (10, 0), (10, 10), (7, 10), (7, 3), (3, 3), (3, 10), (0, 10), (0, 0))]]
    b = spark.createDataFrame([("A", comb)], f"city string, geom {PATH}")
    s = spark.createDataFrame([("A", "w", -5.0, 5.0, 15.0, 5.0), ("A", "in", 1.0, 1.0, 2.0, 1.0), ("A", "out", 4.0, 5.0, 6.0, 5.0), ("B", "other", 1.0, 1.0, 2.0, 1.0)], "city string, water_id string, x1 double, y1 double, x2 double, y2 double")
    got = sorted((r.water_id, round(r.x1, 9), round(r.x2, 9)) for r in clip.clip_lines(s, b).collect())
    assert got == [("in", 1, 2), ("w", 0, 3), ("w", 7, 10)]
    assert sorted(r.water_id for r in clip.near_boundary(s, b, 1.5).collect()) == ["in", "out", "w"]
    box = spark.createDataFrame([("A", 0.0, 0.0, 5.0, 5.5)], "city string, xmin double, ymin double, xmax double, ymax double")
    assert sorted((r.water_id, round(r.x1, 9), round(r.x2, 9)) for r in clip.clip_to_box(s, box).collect()) == [("in", 1, 2), ("out", 4, 5), ("w", 0, 5)]


def test_geojson(spark, tmp_path):
    features = [
        {"type": "Feature", "properties": {"@id": "way/1", "building:levels": "3", "x": 1}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0, 5], [1, 0, 5], [1, 1, 5], [0, 0, 5]]]}},
        {"type": "Feature", "properties": {"name": "m"}, "geometry": {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 1]], [[2, 2], [3, 3]]]}},
        {"type": "Feature", "properties": {}, "geometry": None},
    ]
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    rows = files.read_geojson(spark, str(tmp_path / "a.geojson"), ["@id", "building:levels", "name"]).collect()
    assert [r.geom_type for r in rows] == ["Polygon", "MultiLineString", None]
    assert rows[0]["@id"] == "way/1" and rows[0]["building:levels"] == "3" and rows[0].geom[0][0][1].x == 1
    assert len(rows[1].geom) == 2 and rows[1].geom[1][0][0].y == 2 and rows[1].name == "m" and rows[2].geom is None


def test_layers_summaries_and_names(spark, tmp_path):
    df = spark.createDataFrame([(1, [[ring((0, 0), (2, 3))]])], f"id int, geom {PATH}")
    assert files.write_layer(df, str(tmp_path / "l")) and not files.write_layer(df.where("id > 5"), str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "l")).first().ymax == 3 and not (tmp_path / "none").exists()
    files.write_summary(spark.createDataFrame([("a", 1)], ["k", "v"]), str(tmp_path / "s"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).first().v == "1"
    names = spark.createDataFrame([("x/era5_land_tp_hourly_1999-07_RTM.nc",), ("other.nc",)], ["f"]).select(files.name_parts(F.col("f")).alias("p")).collect()
    assert tuple(names[0].p) == (1999, 7, "RTM") and tuple(names[1].p) == (None, None, None)


def _star(n, r, wave, x0=0.0, y0=0.0):
    import numpy as np

    a = np.arange(n) * 2 * np.pi / n
    d = r * (1 + wave * np.sin(a * 37))
    p = np.stack([x0 + d * np.cos(a), y0 + d * np.sin(a)], axis=1)
    return [{"x": float(x), "y": float(y)} for x, y in [*p, p[0]]]


@pytest.mark.parametrize("n", [12, 3000])
def test_lines_cut_by_cells_equal_sampling(spark, n):
    """Two cities, one with a hole: how much of each segment is left, against points along it."""
    import numpy as np

    from rillgrid.functions import overlay
    from rillgrid.operators.clip import clip_lines

    geoms = {"A": [[_star(n, 900, 0.2), _star(n // 2, 300, 0.1)[::-1]]], "B": [[_star(n, 50, 0.3, 5000.0)], [_star(5, 20, 0.0, 5200.0)]]}
    boundary = spark.createDataFrame(list(geoms.items()), f"city string, geom {PATH}")
    rng = np.random.default_rng(n)
    rows = [("A", k, *map(float, rng.uniform(-1300, 1300, 4)), "x") for k in range(120)] + [("B", k, *map(float, rng.uniform([4900, -80, 4900, -80], [5300, 80, 5300, 80])), "x") for k in range(60)]
    rows += [("A", 900, 500.0, 0.0, 500.0, 0.0, "x"), ("C", 1, 0.0, 0.0, 1.0, 1.0, "x"), ("A", 901, None, 0.0, 1.0, 1.0, "x")]
    df = spark.createDataFrame(rows, "city string, k long, x1 double, y1 double, x2 double, y2 double, a string")
    got = {}
    for r in clip_lines(df, boundary).collect():
        assert r.a == "x"
        got.setdefault((r.city, r.k), []).append((r.piece, np.hypot(r.x2 - r.x1, r.y2 - r.y1)))
    assert got.pop(("A", 900)) == [(0.0, 0.0)]
    t = (np.arange(4000) + 0.5) / 4000
    for city, k, x1, y1, x2, y2, _ in rows[:180]:
        mine = overlay.even_odd(overlay.sides_of(geoms[city]))(x1 + t * (x2 - x1), y1 + t * (y2 - y1))
        size = np.hypot(x2 - x1, y2 - y1)
        pieces = got.get((city, k), [])
        assert abs(sum(p[1] for p in pieces) / size - mine.mean()) < 0.01
        if n == 12:
            assert len(pieces) == int(mine[0]) + int((mine[1:] & ~mine[:-1]).sum())


def test_lines_against_a_large_boundary(spark):
    """100,000 sides and 100,000 segments: a part meets the sides of its cell only."""
    from rillgrid.operators import cover
    from rillgrid.operators.clip import clip_lines

    boundary = spark.createDataFrame([("A", [[_star(100_000, 20_000, 0.05)]])], f"city string, geom {PATH}")
    size = cover.cell_size(boundary)
    cells = cover.cover(boundary, size)
    assert cells.agg(F.max(F.size("sides"))).first()[0] < 600
    at = lambda seed: (F.rand(seed) - 0.5) * 44_000
    lines = spark.range(100_000).select(F.lit("A").alias("city"), "id", at(1).alias("x1"), at(2).alias("y1")).withColumns({"x2": F.col("x1") + 100, "y2": F.col("y1") + 50})
    kept = clip_lines(lines, boundary).agg(F.count("*"), F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))).first()
    share = 3.141592653589793 * 20_000**2 * (1 + 0.05**2 / 2) / 44_000**2
    assert abs(kept[1] / (100_000 * 111.803398875) - share) < 0.01 and kept[0] < 100_000
