"""Layers and tables from and to files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_POINT = "array<double>"
_DEPTH = {"Point": 0, "MultiPoint": 1, "LineString": 1, "MultiLineString": 2, "Polygon": 2, "MultiPolygon": 3}


def _vertex(p: Column) -> Column:
    return F.named_struct(F.lit("x"), F.get(p, F.lit(0)), F.lit("y"), F.get(p, F.lit(1)))


def _nested(coordinates: Column, kind: Column) -> Column:
    """GeoJSON coordinates, as text, as parts, rings, vertices; heights are dropped."""
    def parsed(depth: int) -> Column:
        schema = _POINT
        for _ in range(depth):
            schema = f"array<{schema}>"
        return F.from_json(coordinates, schema)

    path = lambda c: F.transform(c, _vertex)
    return (
        F.when(kind == "Point", F.array(F.array(F.array(_vertex(parsed(0))))))
        .when(kind == "MultiPoint", F.transform(parsed(1), lambda p: F.array(F.array(_vertex(p)))))
        .when(kind == "LineString", F.array(F.array(path(parsed(1)))))
        .when(kind == "MultiLineString", F.transform(parsed(2), lambda line: F.array(path(line))))
        .when(kind == "Polygon", F.array(F.transform(parsed(2), path)))
        .when(kind == "MultiPolygon", F.transform(parsed(3), lambda part: F.transform(part, path)))
    )


def read_geojson(spark: SparkSession, path: str, properties: list[str], crs: int = 4326) -> DataFrame:
    """The features of GeoJSON files: the named properties as text (null where absent), geom_type, geom, crs."""
    feature = "struct<id:string, properties:map<string,string>, geometry:struct<type:string,coordinates:string>>"
    files = spark.read.schema(f"features array<{feature}>").option("multiLine", True).json(path)
    rows = files.select(F.explode("features").alias("f")).select("f.id", "f.properties", "f.geometry")
    named = [F.coalesce(F.try_element_at("properties", F.lit(p)), F.col("id") if p in ("@id", "id") else F.lit(None)).alias(p) for p in properties]
    kind = F.col("geometry.type")
    return rows.select(*named, kind.alias("geom_type"), _nested(F.col("geometry.coordinates"), kind).alias("geom"), F.lit(crs).alias("crs"))


def _elements(xml: Column, *names: str) -> Column:
    """The elements of these names in a piece of XML, as text. None of them may hold another of its own name."""
    return F.regexp_extract_all(xml, F.lit(rf"(?s)<(?:\w+:)?({'|'.join(names)})\b[^>]*>.*?</(?:\w+:)?\1>"), F.lit(0))


def _vertices(xml: Column, dimension: Column, swapped: bool) -> Column:
    """All coordinates in a piece of GML as one path; heights are dropped."""
    lists = F.regexp_extract_all(xml, F.lit(r"<(?:\w+:)?(?:posList|pos|coordinates)\b[^>]*>([^<]*)<"), F.lit(1))
    numbers = F.split(F.trim(F.regexp_replace(F.array_join(lists, " "), r"[\s,]+", " ")), " ")
    n = F.floor(F.size(numbers) / dimension).cast("int")
    at = lambda k, axis: F.get(numbers, k * dimension + F.lit(axis)).try_cast("double")
    x, y = (1, 0) if swapped else (0, 1)
    path = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.named_struct(F.lit("x"), at(k, x), F.lit("y"), at(k, y)))
    return F.when(n > 0, path)


def read_gml(spark: SparkSession, path: str, row_tag: str, columns: list[str], geometry: str, crs: int, swapped: bool = False) -> DataFrame:
    """The features of GML files: the named child elements as text (null where absent), geom_type, geom, crs. Names are given
    without prefixes. Points, lines (LineString or Curve) and polygons (Polygon or Surface), single or multi, with two or three
    coordinates a vertex as srsDimension says; ``swapped`` is for files that give y before x."""
    schema = ", ".join(f"`{c}` string" for c in [*columns, geometry])
    rows = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True).schema(schema).load(path)
    xml = F.col(f"`{geometry}`")
    dimension = F.coalesce(F.regexp_extract(xml, r'srsDimension\s*=\s*"(\d)"', 1).try_cast("int"), F.lit(2))
    vertices = lambda c: _vertices(c, dimension, swapped)
    areas, lines, points = _elements(xml, "Polygon", "PolygonPatch"), _elements(xml, "LineString", "LineStringSegment"), _elements(xml, "Point")
    many = lambda name, found: F.when(xml.rlike(r"<(\w+:)?Multi") | (F.size(found) > 1), f"Multi{name}").otherwise(name)
    kind = F.when(F.size(areas) > 0, many("Polygon", areas)).when(F.size(lines) > 0, many("LineString", lines)).when(F.size(points) > 0, many("Point", points))
    geom = (
        F.when(F.size(areas) > 0, F.transform(areas, lambda a: F.transform(_elements(a, "LinearRing"), vertices)))
        .when(F.size(lines) > 0, F.transform(lines, lambda line: F.array(vertices(line))))
        .when(F.size(points) > 0, F.transform(points, lambda p: F.array(vertices(p))))
    )
    return rows.select(*[F.col(f"`{c}`") for c in columns], kind.alias("geom_type"), geom.alias("geom"), F.lit(crs).alias("crs"))


def read_rain(spark: SparkSession, path: str, cities: list[str] | None = None, years: list[int] | None = None) -> DataFrame:
    """Hourly rain (city, year, time, latitude, longitude, tp) partitioned by city and year; other partitions are not read. The
    time may be called valid_time; NaN is read as null."""
    df = spark.read.parquet(path)
    if "time" not in df.columns and "valid_time" in df.columns:
        df = df.withColumnRenamed("valid_time", "time")
    if "tp" not in df.columns:
        raise ValueError(f"no tp in {df.columns}")
    if cities:
        df = df.where(F.col("city").isin(cities))
    if years:
        df = df.where(F.col("year").isin(years))
    return df.withColumn("tp", F.when(~F.isnan("tp"), F.col("tp")))


def name_parts(file: Column) -> Column:
    """struct<year, month, city> of a file named era5_land_tp_hourly_YYYY-MM_CITY.nc."""
    part = lambda k: F.regexp_extract(file, r"era5_land_tp_hourly_(\d{4})-(\d{2})_([A-Za-z]+)\.nc$", k)
    return F.struct(part(1).try_cast("int").alias("year"), part(2).try_cast("int").alias("month"), F.nullif(part(3), F.lit("")).alias("city"))


def write_attributes(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy(*[c for c in ("city",) if c in df.columns]).parquet(path)


def write_summary(df: DataFrame, path: str, kind: str = "json") -> None:
    """A few rows of figures, in one file."""
    out = df.coalesce(1).write.mode("overwrite")
    out.json(path) if kind == "json" else out.option("header", True).csv(path)


def write_layer(df: DataFrame, path: str, geom: str = "geom", files: int | None = None) -> bool:
    """A geometry layer with its bounds as columns; an empty one is not written. Rows lie in the files, and in each file, in the order
    of a plane-filling curve through their middles, so that the files and row groups that a small box can meet are few. files: how
    many there are, else as many as the data's size asks for."""
    from rillgrid.functions.columns import bounds
    from rillgrid.operators.numbering import curve_place

    if df.isEmpty():
        return False
    bounded = df.withColumn("_b", bounds(F.col(geom))).select("*", "_b.*").drop("_b")
    placed = bounded.withColumn("_z", curve_place((F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2))
    dealt = placed.repartitionByRange(files, "_z") if files else placed.repartitionByRange("_z")
    dealt.sortWithinPartitions("_z").drop("_z").write.mode("overwrite").parquet(path)
    return True
