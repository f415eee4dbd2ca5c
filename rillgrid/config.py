"""What differs between cities, as data: one job serves all of them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CityConfig:
    city: str
    crs: int
    boundary_column: str | None  # None: the layer must hold a single feature
    boundary_value: str | None
    assumed_crs: int | None  # for a layer without one; None: an error
    building_ids: tuple[str, ...]
    building_columns: tuple[str, ...]
    clean_buildings: bool
    water_types: tuple[str, ...]
    water_ids: tuple[str, ...]  # before the row number
    water_source: str
    lines_only: bool
    rain_bbox: tuple[float, float, float, float]  # north, west, south, east
    distance_source: str
    cap_m: float | None
    names: tuple[str, ...] = ("naam", "name", "NAME")
    expected_years: tuple[int, ...] = field(default=tuple(range(1991, 2021)))


#: Column names that the cities' layers have.
_IDS = ("@id", "id", "osm_id", "osmid", "osm_way_id", "way_id")
_OSM = ("osm_id", "code", "fclass", "name", "type")
_TAGS = ("building", "building:levels", "building:height", "height", "building:material", "roof:shape", "roof:material", "roof:height", "roof:levels", "name", "addr:postcode")
_WATER_TYPES = ("type", "water_type", "WATER_TYPE", "categorie", "category")

#: Fixed values of the three cities.
CITIES = {
    "RTM": CityConfig("RTM", 28992, "statnaam", "Rotterdam", None, _IDS, _TAGS, False, _WATER_TYPES, (), "pdok_topnl", False, (52.05, 4.00, 51.85, 4.65), "v3", 5000.0),
    "HAM": CityConfig("HAM", 25832, None, None, 25832, ("osm_id", "@id", "id", "osmid", "osm_way_id", "way_id"), _OSM, True, _WATER_TYPES, ("gid", "gml_id"), "basis_gewaessernetz_hamburg", False, (54.05, 8.35, 53.30, 10.45), "v3", 5000.0),
    "DON": CityConfig("DON", 25830, "CODMUNIINE", "20069", None, _IDS, _OSM, False, (*_WATER_TYPES, "SUBTYPE_EU", "SUBTYPE_ES"), ("B5MCODE", "gid", "gml_id"), "gipuzkoa_hydrography", True, (43.55, -2.15, 43.20, -1.85), "v2_coast", None),
}


#: Sites that have no agreed system yet, (site, authority, code, units, status).
OTHER_SITES = (
    ("san_francisco", "EPSG", 32610, "metre", "proposed"),
    ("concordia_station", "EPSG", 3031, "metre", "proposed"),
    ("shackleton_crater", "IAU", None, "metre", "conceptual"),
    ("mars_reference", "IAU", None, "metre", "conceptual"),
)


def crs_registry(spark: SparkSession) -> DataFrame:
    """The cities' projected systems, and the sites whose status is not ``locked``, which have no agreed one (nor a box)."""
    rows = [(c.city, "EPSG", c.crs, "metre", "locked", [c.rain_bbox[1], c.rain_bbox[2], c.rain_bbox[3], c.rain_bbox[0]]) for c in CITIES.values()]
    rows += [(*site, None) for site in OTHER_SITES]
    return spark.createDataFrame(rows, "city string, authority string, code int, units string, status string, bbox_wsen array<double>")


def with_registry(df: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """df with its city's system and box (west, south, east, north), and whether the system is locked. The registry has a row
    a city, so it is broadcast."""
    known = registry if registry is not None else crs_registry(df.sparkSession)
    out = df.join(F.broadcast(known), "city", "left")
    return out.withColumn("crs_locked", F.coalesce(F.col("status") == "locked", F.lit(False)))
