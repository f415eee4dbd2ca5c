import json
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rillgrid.sources import files

HEAD = '<?xml version="1.0"?><wfs:FeatureCollection xmlns:wfs="w" xmlns:gml="g" xmlns:app="a">'


def gml(tmp_path, *shapes):
    members = [f"<gml:featureMember><app:Net><app:gid>{k}</app:gid><app:name>A &amp; {k}</app:name>{f'<app:the_geom>{s}</app:the_geom>' if s else ''}</app:Net></gml:featureMember>" for k, s in enumerate(shapes)]
    (tmp_path / "a.gml").write_text(HEAD + "".join(members) + "</wfs:FeatureCollection>")
    return str(tmp_path / "a.gml")


def plain(geom):
    return None if geom is None else [[[(p.x, p.y) for p in ring] for ring in part] for part in geom]


def line(text, attributes=""):
    return f"<gml:lineStringMember><gml:LineString><gml:posList{attributes}>{text}</gml:posList></gml:LineString></gml:lineStringMember>"


def ring(text, side="exterior"):
    return f"<gml:{side}><gml:LinearRing><gml:posList>{text}</gml:posList></gml:LinearRing></gml:{side}>"


SQUARE, HOLE = "0 0 9 0 9 9 0 9 0 0", "1 1 1 2 2 2 1 1"
OUTLINE = [(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)]


def test_gml_lines_with_heights_and_without(spark, tmp_path):
    high = f'<gml:MultiLineString srsName="urn:ogc:def:crs:EPSG::3044" srsDimension="3">{line("1 2 0 3 4 0" + chr(10) + " 5 6 0")}{line("7 8 0 9 10 0")}</gml:MultiLineString>'
    curve = "<gml:Curve><gml:segments><gml:LineStringSegment><gml:pos>1 2</gml:pos><gml:pos>3 4</gml:pos></gml:LineStringSegment></gml:segments></gml:Curve>"
    old = "<gml:LineString><gml:coordinates>1.5,2 3,4e1</gml:coordinates></gml:LineString>"
    path = gml(tmp_path, high, curve, old, None, "<gml:LineString><gml:posList> </gml:posList></gml:LineString>")
    rows = files.read_gml(spark, path, "Net", ["gid", "name", "none"], "the_geom", 25832).orderBy("gid").collect()
    assert [r.geom_type for r in rows] == ["MultiLineString", "LineString", "LineString", None, "LineString"]
    assert plain(rows[0].geom) == [[[(1, 2), (3, 4), (5, 6)]], [[(7, 8), (9, 10)]]]
    assert plain(rows[1].geom) == [[[(1, 2), (3, 4)]]] and plain(rows[2].geom) == [[[(1.5, 2), (3, 40)]]] and rows[3].geom is None
    assert rows[0].name == "A & 0" and rows[0].none is None and rows[0].crs == 25832
    turned = files.read_gml(spark, path, "Net", ["gid"], "the_geom", 3044, swapped=True).orderBy("gid").first()
    assert plain(turned.geom)[1] == [[(8, 7), (10, 9)]]


def test_gml_polygons_and_points(spark, tmp_path):
    holed = f"<gml:Polygon>{ring(SQUARE)}{ring(HOLE, 'interior')}</gml:Polygon>"
    two = f"<gml:MultiSurface><gml:surfaceMember>{holed}</gml:surfaceMember><gml:surfaceMember><gml:Polygon>{ring(SQUARE)}</gml:Polygon></gml:surfaceMember></gml:MultiSurface>"
    surface = f"<gml:Surface><gml:patches><gml:PolygonPatch>{ring(SQUARE)}</gml:PolygonPatch></gml:patches></gml:Surface>"
    point = '<gml:Point srsDimension="2"><gml:pos>4 5</gml:pos></gml:Point>'
    rows = files.read_gml(spark, gml(tmp_path, holed, two, surface, point), "Net", ["gid"], "the_geom", 25832).orderBy("gid").collect()
    assert [r.geom_type for r in rows] == ["Polygon", "MultiPolygon", "Polygon", "Point"]
    hole = [(1, 1), (1, 2), (2, 2), (1, 1)]
    assert [plain(r.geom) for r in rows] == [[[OUTLINE, hole]], [[OUTLINE, hole], [OUTLINE]], [[OUTLINE]], [[[(4, 5)]]]]


def test_rain_partitions_and_names(spark, tmp_path):
    hours = [("RTM", 1999, datetime(1999, 1, 1, 0), 51.8, 4.0, 0.001), ("RTM", 2000, datetime(2000, 1, 1, 0), 51.8, 4.0, math.nan), ("HAM", 1999, datetime(1999, 1, 1, 0), 53.5, 10.0, 0.002)]
    df = spark.createDataFrame(hours, "city string, year int, valid_time timestamp, latitude double, longitude double, tp double")
    at = str(tmp_path / "rain")
    df.write.partitionBy("city", "year").parquet(at)
    rows = files.read_rain(spark, at, ["RTM"]).orderBy("time").collect()
    assert [(r.city, r.year, r.time.year, r.tp) for r in rows] == [("RTM", 1999, 1999, 0.001), ("RTM", 2000, 2000, None)]
    only = files.read_rain(spark, at, years=[1999])
    assert sorted(r.city for r in only.collect()) == ["HAM", "RTM"]
    assert "PartitionFilters: [isnotnull(year" in only._jdf.queryExecution().toString()
    df.drop("tp").write.parquet(str(tmp_path / "dry"))
    with pytest.raises(ValueError, match="no tp"):
        files.read_rain(spark, str(tmp_path / "dry"))


def test_attributes_by_city_and_summary(spark, tmp_path):
    df = spark.createDataFrame([("A", 1, 0.5), ("B", 2, None)], "city string, bldg_id long, v double")
    files.write_attributes(df, str(tmp_path / "t"))
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["city=A", "city=B"]
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).select("city", "bldg_id").collect()) == [("A", 1), ("B", 2)]
    files.write_attributes(df.drop("city"), str(tmp_path / "t"))
    assert sorted(spark.read.parquet(str(tmp_path / "t")).columns) == ["bldg_id", "v"]
    files.write_summary(df, str(tmp_path / "s"))
    (part,) = (tmp_path / "s").glob("*.json")
    assert [json.loads(text)["bldg_id"] for text in part.read_text().splitlines()] == [1, 2]


def test_layers_are_clustered(spark, tmp_path):
    """A small box meets few files by their statistics, and the rows are all there."""
    import random

    import pyarrow.parquet as pq

    rnd = random.Random(4)
    rows = [(k, rnd.uniform(0, 50_000), rnd.uniform(0, 50_000)) for k in range(4000)]
    p = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    layer = spark.createDataFrame(rows, "id long, x double, y double").withColumn("geom", F.array(F.array(F.array(p(0, 0), p(9, 0), p(9, 9), p(0, 0)))))
    assert files.write_layer(layer, str(tmp_path / "layer"), files=32)
    found = sorted((tmp_path / "layer").glob("*.parquet"))
    met = 0
    for f in found:
        meta = pq.ParquetFile(f).metadata
        low = {}
        for c in range(meta.num_columns):
            column = meta.row_group(0).column(c)
            if column.path_in_schema in ("xmin", "xmax", "ymin", "ymax"):
                low[column.path_in_schema] = column.statistics
        met += low["xmin"].min <= 21_000 and low["xmax"].max >= 20_000 and low["ymin"].min <= 21_000 and low["ymax"].max >= 20_000
    assert len(found) == 32 and met <= 4
    assert spark.read.parquet(str(tmp_path / "layer")).count() == 4000 and "_z" not in spark.read.parquet(str(tmp_path / "layer")).columns
    assert not files.write_layer(layer.limit(0), str(tmp_path / "none"))
