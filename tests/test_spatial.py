import math
import random

import pytest
from pyspark.sql import functions as F

from rillgrid.functions import columns as C
from rillgrid.operators import spatial

PATH = "array<array<array<struct<x:double,y:double>>>>"


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


SQUARE = [[ring((0, 0), (10, 0), (10, 10), (0, 10), (0, 0))]]
HOLED = [[ring((0, 0), (10, 0), (10, 10), (0, 10), (0, 0)), ring((2, 2), (2, 4), (4, 4), (4, 2), (2, 2))]]
ELL = [[ring((0, 0), (10, 0), (10, 2), (2, 2), (2, 10), (0, 10), (0, 0))]]


def test_polygon_measures(spark):
    df = spark.createDataFrame([(1, SQUARE), (2, HOLED), (3, ELL), (4, [[ring((0, 0), (4, 0))]]), (5, [[ring((3, 4))]])], f"id int, g {PATH}")
    rows = {r.id: r for r in df.select("id", C.area(F.col("g")).alias("a"), C.centroid(F.col("g")).alias("c"), C.bounds(F.col("g")).alias("b")).collect()}
    assert rows[1].a == 100 and (rows[1].c.x, rows[1].c.y) == (5, 5)
    assert rows[2].a == 96 and math.isclose(rows[2].c.x, (100 * 5 - 4 * 3) / 96)
    assert rows[3].a == 36 and math.isclose(rows[3].c.x, (20 * 5 + 16 * 1) / 36)
    assert rows[4].a == 0 and (rows[4].c.x, rows[4].c.y) == (2, 0)
    assert (rows[5].c.x, rows[5].c.y) == (3, 4) and rows[5].b.xmax == 3


def test_inside_and_empty(spark):
    df = spark.createDataFrame([(1, 5.0, 5.0, HOLED), (2, 3.0, 3.0, HOLED), (3, 11.0, 5.0, HOLED), (4, 5.0, 5.0, None), (5, 0.0, 0.0, [[ring((0, float("nan")))]])], f"id int, x double, y double, g {PATH}")
    rows = {r.id: r for r in df.select("id", C.inside(F.col("x"), F.col("y"), F.col("g")).alias("i"), C.is_empty(F.col("g")).alias("e")).collect()}
    assert [bool(rows[k].i) for k in (1, 2, 3)] == [True, False, False]
    assert [rows[k].e for k in (1, 4, 5)] == [False, True, True]


@pytest.mark.parametrize("seg, r, want", [((-5, 1, 5, 1), 1.0, 0.0), ((-5, 0, 5, 0), 1.0, 2.0), ((-0.5, 0, 0.5, 0), 1.0, 1.0), ((0, 0, 0, 0), 1.0, 0.0), ((0, 0, 5, 0), 2.0, 2.0)])
def test_length_in_disc(spark, seg, r, want):
    got = spark.range(1).select(C.length_in_disc(F.lit(0.0), F.lit(0.0), r, *[F.lit(float(v)) for v in seg]).alias("v")).first().v
    assert math.isclose(got, want, abs_tol=1e-12)


def test_segment_distances(spark):
    at = lambda *v: tuple(F.lit(float(x)) for x in v)
    cases = [((0, 0, 10, 0), (5, -1, 5, 1), 0), ((0, 0, 10, 0), (5, 3, 5, 9), 3), ((0, 0, 1, 0), (4, 4, 9, 4), 5), ((0, 0, 1, 0), (1, 0, 2, 5), 0), ((0, 0, 0, 0), (3, 4, 3, 4), 5)]
    row = spark.range(1).select(*[C.segment_segment(at(*a), at(*b)).alias(f"d{k}") for k, (a, b, _) in enumerate(cases)]).first()
    assert [round(v, 9) for v in row] == [c[2] for c in cases]


def brute(px, py, segs):
    best = math.inf
    for x1, y1, x2, y2 in segs:
        dx, dy = x2 - x1, y2 - y1
        a = dx * dx + dy * dy
        t = 0 if a == 0 else max(0, min(1, ((px - x1) * dx + (py - y1) * dy) / a))
        best = min(best, math.hypot(px - x1 - t * dx, py - y1 - t * dy))
    return best


@pytest.mark.parametrize("seed", range(3))
def test_cells_equal_brute_force(spark, seed):
    """Far points, long segments and negative coordinates; every point gets its true nearest."""
    rnd = random.Random(seed)
    segs = [(rnd.uniform(-9000, 9000), rnd.uniform(-9000, 9000)) for _ in range(25)]
    segs = [(x, y, x + rnd.uniform(-4000, 4000), y + rnd.uniform(-4000, 4000)) for x, y in segs] + [(1.0, 2.0, 1.0, 2.0)]
    points = [(k, rnd.uniform(-60000, 60000), rnd.uniform(-30000, 30000)) for k in range(80)]
    p = spark.createDataFrame(points, "bldg_id long, px double, py double")
    s = spark.createDataFrame(segs, "x1 double, y1 double, x2 double, y2 double")
    got = {r.bldg_id: r.dist_to_water_m for r in spatial.nearest_from_points(p, s).collect()}
    assert all(math.isclose(got[k], brute(x, y, segs), rel_tol=1e-9, abs_tol=1e-6) for k, x, y in points)
    both = {r.bldg_id: r for r in spatial.exposure(p, s).collect()}
    assert all(math.isclose(both[k].dist_to_water_m, got[k], rel_tol=1e-9, abs_tol=1e-6) for k in got)
    lengths = [r.water_len_density_250m * 250**2 <= r.water_len_density_500m * 500**2 + 1e-9 <= r.water_len_density_1000m * 1000**2 + 2e-9 for r in both.values()]
    assert all(lengths)


def test_no_water_at_all(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0)], "bldg_id long, px double, py double")
    s = spark.createDataFrame([], "x1 double, y1 double, x2 double, y2 double")
    row = spatial.exposure(p, s).first()
    assert row.dist_to_water_m is None and row.water_len_density_1000m == 0


def test_footprint_touches_or_holds_water(spark):
    b = spark.createDataFrame([(1, SQUARE)], f"bldg_id long, geom {PATH}")
    s = spark.createDataFrame([("river", 4.0, 4.0, 5.0, 5.0), ("coast", 13.0, 14.0, 20.0, 14.0)], "water_source string, x1 double, y1 double, x2 double, y2 double")
    row = spatial.nearest_from_footprints(b, s, ["river", "coast"]).first()
    assert (row.dist_to_river_m, row.dist_to_coast_m, row.dist_to_water_m) == (0, 5, 0)
    missing = spatial.nearest_from_footprints(b, s.where("water_source = 'river'"), ["river", "coast"]).first()
    assert missing.dist_to_coast_m is None and missing.dist_to_water_m is None


@pytest.mark.parametrize("shape", ["one place", "far away", "two towns"])
def test_nearest_whatever_the_density(spark, shape):
    """All water within a few metres, water 100 km from all points, and towns 300 km apart."""
    rnd = random.Random(shape)
    if shape == "one place":
        segs = [(500 + rnd.random() * 3, 500 + rnd.random() * 3) for _ in range(700)]
        points = [(k, rnd.uniform(-20000, 20000), rnd.uniform(0, 1000)) for k in range(120)]
    elif shape == "far away":
        segs = [(100_000 + rnd.uniform(0, 500), rnd.uniform(-300, 300)) for _ in range(300)]
        points = [(k, rnd.uniform(0, 10), rnd.uniform(0, 10)) for k in range(100)]
    else:
        segs = [(rnd.choice([0, 300_000]) + rnd.uniform(0, 2000), rnd.uniform(0, 2000)) for _ in range(500)]
        points = [(k, rnd.choice([0, 150_000, 300_000]) + rnd.uniform(0, 2000), rnd.uniform(0, 2000)) for k in range(150)]
    segs = [(x, y, x + rnd.uniform(-2, 2), y + rnd.uniform(-2, 2)) for x, y in segs] + [(segs[0][0],) * 4]
    p = spark.createDataFrame([*points, (999, None, None)], "bldg_id long, px double, py double")
    got = {r.bldg_id: r.dist_to_water_m for r in spatial.nearest_from_points(p, spark.createDataFrame(segs + segs, "x1 double, y1 double, x2 double, y2 double")).collect()}
    assert got.pop(999) is None and len(got) == len(points)
    assert all(math.isclose(got[k], brute(x, y, segs), rel_tol=1e-9, abs_tol=1e-6) for k, x, y in points)


def test_trees_keep_few_pairs(spark):
    """Pairs of leaves grow with the leaves, not with their square."""
    from rillgrid.operators import nearest

    rnd = random.Random(8)
    segs = [(rnd.uniform(0, 50_000), rnd.uniform(0, 50_000)) for _ in range(3000)]
    s = spark.createDataFrame([("A", x, y, x + 20.0, y) for x, y in segs], "city string, x1 double, y1 double, x2 double, y2 double")
    t = spark.createDataFrame([("A", k, rnd.uniform(0, 50_000), rnd.uniform(0, 50_000), 0.0) for k in range(3000)], "city string, k long, px double, py double, reach double")
    near, far = nearest.target_tree(t, ("city",), "k"), nearest.segment_tree(s, ("city",))
    leaves = near.levels[0].count()
    assert leaves == math.ceil(3000 / nearest.LOAD)
    assert nearest.leaf_pairs(near, far).count() < 30 * leaves


def test_inside_an_area_of_which_no_side_is_nearest(spark):
    """A building deep inside a large area, with the edge of another area nearer; one in a hole; one on an island of it."""
    def at(x, y, w):
        return ring((x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y))

    areas = spark.createDataFrame([("coast", [[at(0, 0, 9000), at(6000, 6000, 1000)]]), ("coast", [[at(4300, 4000, 20)]])], f"water_source string, geom {PATH}")
    b = spark.createDataFrame([(1, [[at(4000, 4000, 10)]]), (2, [[at(6500, 6500, 10)]]), (3, [[at(9100, 0, 10)]]), (4, None)], f"bldg_id long, geom {PATH}")
    edges = spatial.to_segments(areas, "water_source")
    got = {r.bldg_id: r.dist_to_coast_m for r in spatial.nearest_from_footprints(b, edges, ["coast"], areas=areas).collect()}
    assert got == {1: 0, 2: 490, 3: 100, 4: None}
    lines = {r.bldg_id: r.dist_to_coast_m for r in spatial.nearest_from_footprints(b, edges, ["coast"]).collect()}
    assert lines[1] == 290


def test_numbers_without_one_task(spark):
    from rillgrid.operators.numbering import curve_place, numbered

    rnd = random.Random(1)
    rows = [(rnd.choice("AB"), rnd.randrange(10**6), k) for k in range(500)]
    df = spark.createDataFrame(rows, "city string, v long, _id long").repartition(5)
    got = numbered(df, [F.col("v"), F.col("_id")], ("city",), "n")
    want = {}
    for c in "AB":
        want |= {r[2]: n for n, r in enumerate(sorted((r for r in rows if r[0] == c), key=lambda r: r[1:]))}
    assert {r._id: r.n for r in got.collect()} == want
    assert sorted(r.rank for r in numbered(df, [F.col("_id")]).collect()) == list(range(500)) and numbered(df.limit(0), [F.col("v")]).count() == 0
    places = spark.createDataFrame([(0.0, 0.0), (0.25, 0.0), (0.0, 0.25), (0.25, 0.25), (0.5, 0.0)], "x double, y double").select(curve_place(F.col("x"), F.col("y")).alias("p"))
    first, *rest = [r.p for r in places.collect()]
    assert [p - first for p in rest] == [1, 2, 3, 4]
