import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rillgrid.functions.columns import area
from rillgrid.operators.dissolve import dissolved
from rillgrid.plans import jobs

PATH = "array<array<array<struct<x:double,y:double>>>>"


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def box(x, y, w=10, h=10):
    return [[ring((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))]]


@pytest.fixture(scope="module")
def buildings(spark):
    return spark.createDataFrame([("A", 1, box(0, 0)), ("A", 2, box(3000, 0)), ("B", 1, box(0, 0))], f"city string, bldg_id long, geom {PATH}")


def lines(spark, *rows):
    return spark.createDataFrame([(c, k, [[ring(*p)]], "LineString") for c, k, *p in rows], f"city string, fclass string, geom {PATH}, geom_type string")


def test_exposure_from_interior_points(spark, buildings):
    water = lines(spark, ("A", "river", (5, 105), (5, 1000)), ("B", "canal", (-100, 5), (100, 5)))
    got = {(r.city, r.bldg_id): r for r in jobs.water_exposure(buildings, water).collect()}
    assert got["A", 1].dist_to_water_m == 100 and got["B", 1].dist_to_water_m == 0
    assert got["A", 2].dist_to_water_m > 2900 and got["A", 2].water_len_density_1000m == 0


def test_versions_two_and_three(spark, buildings):
    hydro = lines(spark, ("A", "river", (5, 110), (5, 1000)), ("B", "canal", (20, -50), (20, 50)))
    beach = spark.createDataFrame([("A", box(-50, -50, 200, 200)), ("B", box(100, 0))], f"city string, geom {PATH}")
    two = {(r.city, r.bldg_id): r for r in jobs.proximity_with_coast(buildings, hydro, beach).collect()}
    assert two["A", 1].dist_to_coast_m == 0 and two["A", 1].dist_to_hydrography_m == 100 and two["A", 1].dist_to_water_m == 0
    assert two["A", 1].water_len_density_250m > 0
    three = {(r.city, r.bldg_id): r for r in jobs.proximity(buildings, {"hydrography": hydro, "coast": beach}).collect()}
    assert three["A", 1].dist_to_coast_m == 50 and three["B", 1].dist_to_coast_m == 90 and three["B", 1].dist_to_water_m == 10
    ways = lines(spark, ("A", "river", (0, 30), (10, 30)), ("A", "drain", (0, 11), (10, 11)), ("B", "river", (9000, 0), (9001, 0)))
    areas = spark.createDataFrame([("A", "water", box(0, 14)), ("B", "water", box(12, 0))], f"city string, fclass string, geom {PATH}")
    refined = {(r.city, r.bldg_id): r for r in jobs.proximity_refined(buildings, hydro, beach, ways, areas).collect()}
    assert refined["A", 1].dist_to_osm_waterways_m == 20 and refined["A", 1].dist_to_osm_water_polygons_m == 4 and refined["A", 1].dist_to_water_m == 4
    assert refined["B", 1].dist_to_osm_waterways_m is None and refined["B", 1].dist_to_water_m == 2
    with pytest.raises(ValueError):
        jobs.proximity_refined(buildings, hydro.where("city = 'x'"), beach, ways, areas)


def test_footprints_are_made_once(spark, monkeypatch):
    """Counting passes and groups of the second job read what was written once, rather than make all footprints again (F2)."""
    made = spark.sparkContext.accumulator(0)

    def counted(k):
        made.add(1)
        return k

    rows = spark.createDataFrame([("A", k, box(40 * k, 0)) for k in range(30)], f"city string, bldg_id long, geom {PATH}")
    rows = rows.withColumn("bldg_id", F.udf(counted, "long").asNondeterministic()("bldg_id"))
    hydro = lines(spark, ("A", "river", (5, 110), (5, 1000)), ("A", "river", (500, -900), (600, -900)))
    beach = spark.createDataFrame([("A", box(-50, -50, 200, 200)), ("A", box(9000, 0))], f"city string, geom {PATH}")
    got = {r.bldg_id: r for r in jobs.proximity_with_coast(rows, hydro, beach).collect()}
    assert len(got) == 30 and got[1].dist_to_coast_m == 0 and got[29].dist_to_coast_m == 1010
    assert made.value == 60  # once for distances and areas, once for the points of densities


def test_coastal_proxy(spark):
    natural = spark.createDataFrame([("A", "1", "beach", box(0, 0)), ("A", "2", "beach", box(90000, 0)), ("A", "3", "wood", box(0, 0))], f"city string, osm_id string, fclass string, geom {PATH}")
    boundary = spark.createDataFrame([("A", box(1000, 0, 500, 500))], f"city string, geom {PATH}")
    assert [r.osm_id for r in jobs.coastal_proxy(natural, boundary).collect()] == ["1"]
    assert jobs.coastal_proxy(natural, None).count() == 2
    round_ = spark.createDataFrame([("A", "9", "beach", box(-9000, -9000, 30000, 30000))], natural.schema)
    cut_out = jobs.coastal_proxy(round_, boundary).withColumn("a", area(F.col("geom"))).first()
    # the boundary's square, its four strips and the sixteen-sided quarters of its corners
    assert abs(cut_out.a - (500 * 500 + 4 * 500 * 2000 + 32 * 2000**2 * math.sin(math.pi / 32))) < 1
    with pytest.raises(ValueError):
        jobs.coastal_proxy(natural.where("fclass = 'wood'"), boundary)


def test_rain_hazard_runs_through(spark):
    start = datetime(2019, 1, 1)
    hours = spark.range(8760).select(F.lit("A").alias("city"), (F.lit(start) + F.make_interval(hours=F.col("id").cast("int"))).alias("time"), F.col("id"))
    cells = spark.createDataFrame([(51.8, 4.0), (51.8, 4.1), (51.9, 4.0), (51.9, 4.1)], "latitude double, longitude double")
    hourly = hours.crossJoin(cells).select("city", "time", "latitude", "longitude", F.when(F.col("longitude") < 4.05, F.col("id") / 1e6).alias("tp"))
    b = spark.createDataFrame([("A", 1, box(70000, 430000))], f"city string, bldg_id long, geom {PATH}")
    row = jobs.rain_hazard(hourly, b, {"A": 28992}, (2019,)).first()
    assert abs(row.H_pluvial_v1_mm - 8.759) < 1e-3 and row.hazard_version == "v1"
    with pytest.raises(ValueError):
        jobs.rain_hazard(hourly.where(F.col("time") != F.lit(start + timedelta(hours=5))), b, {"A": 28992}, (2019,))


def test_dissolve_cancels_shared_edges(spark):
    grid = [box(x, y) for x in (0, 10, 20) for y in (0, 10, 20) if (x, y) != (10, 10)]
    df = spark.createDataFrame([("A", g) for g in grid] + [("B", box(0, 0)), ("B", box(50, 0))], f"city string, geom {PATH}")
    got = {r.city: r for r in dissolved(df).withColumn("a", area(F.col("geom"))).collect()}
    assert got["A"].a == 800 and len(got["A"].geom) == 1 and len(got["A"].geom[0]) == 2
    assert got["B"].a == 200 and len(got["B"].geom) == 2
