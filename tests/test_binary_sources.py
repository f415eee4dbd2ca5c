import sqlite3
import struct

import pytest

from rillgrid.functions import wkb
from rillgrid.sources import binary


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


HOLED = [[ring((0, 0), (0, 9), (9, 9), (9, 0), (0, 0)), ring((1, 1), (2, 1), (2, 2), (1, 1))]]
SHAPES = [("Point", [[ring((1, 2))]]), ("LineString", [[ring((0, 0), (1, 1))]]), ("Polygon", HOLED), ("MultiPolygon", HOLED * 2), ("MultiLineString", [[ring((0, 0), (1, 1))], [ring((2, 2), (3, 3))]]), ("MultiPoint", [[ring((1, 2))], [ring((3, 4))]]), (None, None)]


def test_wkb_round_trips(spark):
    for kind, geom in SHAPES:
        assert wkb.decode(wkb.encode(kind, geom)) == (kind, geom)
    df = spark.createDataFrame([(k, *s) for k, s in enumerate(SHAPES)], f"id int, geom_type string, geom {binary.GEOM}")
    back = binary.from_wkb(binary.with_wkb(df).select("id", "wkb")).orderBy("id").collect()
    assert [r.geom_type for r in back] == [s[0] for s in SHAPES] and back[2].geom[0][1][1].x == 2


def test_heights_are_dropped():
    high = struct.pack("<BII6d", 1, 1002, 2, 0, 0, 7, 1, 1, 8)
    assert wkb.decode(high) == ("LineString", [[ring((0, 0), (1, 1))]])


def test_geopackage(spark, tmp_path):
    path = tmp_path / "a.gpkg"
    db = sqlite3.connect(path)
    db.execute("create table gpkg_geometry_columns (table_name text, column_name text)")
    db.execute("insert into gpkg_geometry_columns values ('water', 'shape')")
    db.execute("create table water (fid integer, naam text, shape blob)")
    blob = lambda kind, geom: b"GP\x00\x03" + struct.pack("<i4d", 28992, 0, 1, 0, 1) + wkb.encode(kind, geom)
    db.executemany("insert into water values (?, ?, ?)", [(1, "Maas", blob(*SHAPES[1])), (2, None, None)])
    db.commit()
    db.close()
    rows = binary.read_geopackage(spark, str(path), "water", ["fid", "naam", "none"], 28992).orderBy("fid").collect()
    assert [(r.fid, r.naam, r.none, r.geom_type) for r in rows] == [("1", "Maas", None, "LineString"), ("2", None, None, None)]
    with pytest.raises(Exception, match="there are"):
        binary.read_geopackage(spark, str(path), "land", [], 28992).collect()


def test_shapefile(spark, tmp_path):
    def record(number, body):
        return struct.pack(">2i", number, len(body) // 2) + body

    line = struct.pack("<i4d2i", 3, 0, 0, 1, 1, 1, 2) + struct.pack("<i4d", 0, 0, 0, 1, 1)
    rings = [(0, 0), (0, 9), (9, 9), (9, 0), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 1)]
    flat = [v for r in rings for p in r for v in p]
    polygon = struct.pack("<i4d2i", 5, 0, 0, 9, 9, 2, 9) + struct.pack("<2i18d", 0, 5, *map(float, flat))
    (tmp_path / "a.shp").write_bytes(b"\0" * 100 + record(1, line) + record(2, polygon) + record(3, struct.pack("<i", 0)))
    rows = binary.read_shapefile(spark, str(tmp_path / "a.shp")).orderBy("record").collect()
    assert [r.geom_type for r in rows] == ["MultiLineString", "MultiPolygon", None]
    assert len(rows[1].geom) == 1 and len(rows[1].geom[0]) == 2 and rows[0].crs == 4326
