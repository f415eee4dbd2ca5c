"""Raw layers to normalised ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillgrid.config import CityConfig
from rillgrid.functions.columns import area, centroid, is_empty
from rillgrid.operators.assets import first_present
from rillgrid.operators.numbering import numbered

POLYGONS = ("Polygon", "MultiPolygon")
LINES = ("LineString", "MultiLineString")


def keep_present(df: DataFrame, *columns: str) -> DataFrame:
    """Those of the columns that df has, in the order given."""
    return df.select(*[F.col(f"`{c}`") for c in columns if c in df.columns])


def of_types(df: DataFrame, types: tuple[str, ...]) -> DataFrame:
    return df.where(F.col("geom_type").isin(*types))


def without_empty(df: DataFrame, geom: str = "geom") -> DataFrame:
    return df.where(~is_empty(F.col(geom)))


def of_classes(df: DataFrame, classes: tuple[str, ...], column: str = "fclass") -> DataFrame:
    """Rows of these feature classes; those without a class go."""
    return df.where(F.col(column).isin(*classes))


def harmonised_water(layer: DataFrame, config: CityConfig, order: list[str]) -> DataFrame:
    """water_id, source, water_type, name and geom if there is one. water_id is the first present id column, else the row's
    number (from 0) in the given order."""
    name = next((c for c in config.names if c in layer.columns), None)
    kind = next((c for c in config.water_types if c in layer.columns), None)
    given = next((c for c in config.water_ids if c in layer.columns), None)
    text = lambda c: F.col(f"`{c}`").cast("string") if c else F.lit(None).cast("string")
    rows = layer if given else numbered(layer, [F.col(c) for c in order], tuple(c for c in ("city",) if c in layer.columns), "_id")
    rest = ["geom"] if "geom" in layer.columns else []
    return rows.select(*[c for c in ("city",) if c in layer.columns], (text(given) if given else F.col("_id").cast("string")).alias("water_id"), F.lit(config.water_source).alias("source"), text(kind).alias("water_type"), text(name).alias("name"), *rest)


def boundary_of(layer: DataFrame, config: CityConfig) -> DataFrame:
    """The city's feature: by trimmed attribute, or the layer's only one. Raises if there is none, or, without an attribute, not
    exactly one; some of the values that there are are told."""
    if config.boundary_column is None:
        n = layer.limit(2).count()
        if n != 1:
            raise ValueError(f"expected one feature, found {'none' if n == 0 else 'more'}")
        return layer
    value = F.trim(F.col(config.boundary_column).cast("string"))
    found = layer.where(value == config.boundary_value)
    if found.isEmpty():
        some = [r[0] for r in layer.select(value.alias("v")).distinct().orderBy("v").limit(30).collect()]
        raise ValueError(f"{config.boundary_column} is never {config.boundary_value!r}; it is {some}")
    return found


def ranked(df: DataFrame, order: list, bucket: tuple[str, float], by: list[str] | None = None) -> DataFrame:
    """df with rank: 1 for the first in the order, for each ``by``. Rows are numbered inside buckets (column, width) of the order's
    first column's values, after the counts of the buckets before; so no task holds all rows."""
    by = by if by is not None else [c for c in ("city",) if c in df.columns]
    column, width = bucket
    # missing values come last
    placed = df.withColumn("_bucket", F.coalesce(F.floor(F.col(column) / width).cast("long"), F.lit(2**62)))
    counts = placed.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy(*(by or [F.lit(0)])).orderBy("_bucket")) - F.col("_n")).drop("_n")
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order)
    return placed.withColumn("_k", F.row_number().over(inside)).join(before, [*by, "_bucket"]).withColumn("rank", F.col("_k") + F.col("_before")).drop("_bucket", "_k", "_before")


def building_ids(buildings: DataFrame, source_id: str | None, width: float = 500.0) -> DataFrame:
    """buildings with bldg_id from 1: by centroid x, centroid y and area, missing last; ties by the source's id, or, where the source
    has none, by a hash of the geometry."""
    c = buildings.withColumns({"_c": centroid(F.col("geom")), "_area": area(F.col("geom"))}).withColumns({"_cx": F.col("_c.x"), "_cy": F.col("_c.y")}).drop("_c")
    last = F.col(f"`{source_id}`") if source_id else F.xxhash64("geom")
    order = [v.asc_nulls_last() for v in (F.col("_cx"), F.col("_cy"), F.col("_area"), last)]
    return ranked(c, order, ("_cx", width)).withColumnRenamed("rank", "bldg_id").drop("_cx", "_cy", "_area")


def normalised_buildings(layer: DataFrame, config: CityConfig) -> DataFrame:
    """The source's id if it has one, the kept columns, geom and bldg_id."""
    source = next((c for c in config.building_ids if c in layer.columns), None)
    kept = keep_present(layer, *dict.fromkeys((*([source] if source else []), *config.building_columns, "geom", "geom_type", "city")))
    if config.clean_buildings:
        kept = without_empty(of_types(kept, POLYGONS))
    return building_ids(kept, source)
