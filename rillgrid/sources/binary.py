"""GeoPackage layers and shapefiles, one task a file, and WKB columns."""

from __future__ import annotations

import sqlite3
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from rillgrid.functions import wkb

GEOM = "array<array<array<struct<x:double,y:double>>>>"
_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_ARROW = pa.list_(pa.list_(pa.list_(_POINT)))


def read_geopackage(spark: SparkSession, path: str, layer: str, columns: list[str], crs: int) -> DataFrame:
    """A named layer of GeoPackage files: the named columns as text (null where absent), geom_type, geom, crs. Files are read
    through Spark, so they can be in any store; each is one row, so it must fit a task."""
    blobs = spark.read.format("binaryFile").load(path).select("content")

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                with tempfile.NamedTemporaryFile(suffix=".gpkg") as f:
                    f.write(blob.as_py())
                    f.flush()
                    db = sqlite3.connect(f"file:{f.name}?mode=ro&immutable=1", uri=True)
                    found = db.execute("select column_name from gpkg_geometry_columns where table_name = ?", (layer,)).fetchone()
                    if found is None:
                        names = [r[0] for r in db.execute("select table_name from gpkg_geometry_columns order by 1")]
                        raise ValueError(f"no layer {layer!r}; there are {names}")
                    there = {r[1] for r in db.execute(f'pragma table_info("{layer}")')}
                    wanted = ", ".join(f'cast("{c}" as text)' if c in there else "null" for c in columns)
                    cursor = db.execute(f'select "{found[0]}"{", " + wanted if columns else ""} from "{layer}"')
                    while part := cursor.fetchmany(5000):
                        shapes = [wkb.from_geopackage(r[0]) for r in part]
                        arrays = [pa.array([r[k + 1] for r in part], pa.string()) for k in range(len(columns))]
                        yield pa.RecordBatch.from_arrays([*arrays, pa.array([s[0] for s in shapes], pa.string()), pa.array([s[1] for s in shapes], _ARROW)], names=[*columns, "geom_type", "geom"])
                    db.close()

    schema = ", ".join([*[f"`{c}` string" for c in columns], "geom_type string", f"geom {GEOM}"])
    return blobs.mapInArrow(rows_of, schema).withColumn("crs", F.lit(crs))


def read_shapefile(spark: SparkSession, path: str, crs: int = 4326) -> DataFrame:
    """record, geom_type, geom, crs of .shp files."""
    blobs = spark.read.format("binaryFile").load(path).select("content")

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                found = wkb.shapefile(blob.as_py())
                for at in range(0, len(found), 5000):
                    part = found[at : at + 5000]
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.string()), pa.array([r[2] for r in part], _ARROW)], names=["record", "geom_type", "geom"])

    return blobs.mapInArrow(rows_of, f"record int, geom_type string, geom {GEOM}").withColumn("crs", F.lit(crs))


def with_wkb(df: DataFrame, geom: str = "geom", kind: str = "geom_type", name: str = "wkb") -> DataFrame:
    """df with the geometry as WKB."""
    names, kept = list(df.columns), df.schema

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, geoms = (batch.column(names.index(c)).to_pylist() for c in (kind, geom))
            made = pa.array([wkb.encode(k, g) for k, g in zip(kinds, geoms, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*names, name])

    return df.mapInArrow(encoded, StructType([*kept.fields, StructField(name, BinaryType())]))


def from_wkb(df: DataFrame, name: str = "wkb") -> DataFrame:
    """df with geom_type and geom of a WKB column."""
    names, kept = list(df.columns), df.schema

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = [wkb.decode(v.as_py()) for v in batch.column(names.index(name))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([s[0] for s in shapes], pa.string()), pa.array([s[1] for s in shapes], _ARROW)], names=[*names, "geom_type", "geom"])

    schema = StructType([*kept.fields, *StructType.fromDDL(f"geom_type string, geom {GEOM}").fields])
    return df.mapInArrow(decoded, schema)
