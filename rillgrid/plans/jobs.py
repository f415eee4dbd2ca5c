"""Whole jobs: what a city's build runs, over any number of cities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgrid.config import CityConfig
from rillgrid.functions.columns import centroid
from rillgrid.functions.crs import reproject, to_lonlat
from rillgrid.functions.interior import with_interior_point
from rillgrid.operators import normalize, quality, rain, spatial
from rillgrid.operators.clip import clip_lines, clip_lines_grown, clip_to_box
from rillgrid.operators.dissolve import dissolved
from rillgrid.operators.polygons import clip_polygons, grown, repaired
from rillgrid.plans.cache import cut, written

RADII = (250.0, 500.0, 1000.0)
WATERWAYS = ("river", "canal")
WATER_AREAS = ("riverbank", "water", "reservoir")
COASTAL = ("beach", "cliff")


def _points(buildings: DataFrame, origin: str) -> DataFrame:
    """city, bldg_id, px, py: the interior point or the centroid."""
    if origin == "interior":
        placed = with_interior_point(buildings).withColumn("_at", F.col("interior"))
    elif origin == "centroid":
        placed = buildings.withColumn("_at", centroid(F.col("geom")))
    else:
        raise ValueError(f"origin is interior or centroid, not {origin!r}")
    return placed.select("city", "bldg_id", F.col("_at.x").alias("px"), F.col("_at.y").alias("py"))


def water_exposure(buildings: DataFrame, water: DataFrame, lines_only: bool = False, sample: int | None = None) -> DataFrame:
    """Version 1: from each building's interior point, distance and densities. water: city, geom, geom_type."""
    buildings, water = normalize.without_empty(buildings), normalize.without_empty(water)
    if lines_only:
        water = normalize.of_types(water, normalize.LINES)
    if sample is not None:
        buildings = quality.sample_exactly(buildings, sample)
    segments = spatial.to_segments(water, "city")
    return spatial.exposure(cut(_points(buildings, "interior")), segments, RADII)


def proximity_with_coast(buildings: DataFrame, hydrography: DataFrame, coast: DataFrame) -> DataFrame:
    """Version 2: footprint distances (0 inside a coastal area) and, from centroids, densities of all water with the coast's edges."""
    buildings = quality.first_of_each(buildings, ["city", "bldg_id"], [F.xxhash64("geom")])
    stacked = spatial.stack_sources({"hydrography": spatial.to_segments(hydrography, "city"), "coast": spatial.to_segments(coast, "city")})
    stacked = written(stacked.select("city", "water_source", "x1", "y1", "x2", "y2"))
    areas = coast.select("city", F.lit("coast").alias("water_source"), "geom")
    near = spatial.nearest_from_footprints(buildings, stacked, ["hydrography", "coast"], areas=areas)
    dense = spatial.water_length_density(written(_points(buildings, "centroid")), stacked, RADII)
    return near.join(dense, ["city", "bldg_id"])


def proximity(buildings: DataFrame, layers: dict[str, DataFrame]) -> DataFrame:
    """Version 3: footprint distance to each source (polygons by their edges) and the least of them."""
    stacked = cut(spatial.stack_sources({name: spatial.to_segments(layer, "city") for name, layer in layers.items()}))
    return spatial.nearest_from_footprints(buildings, stacked, list(layers))


def proximity_refined(buildings: DataFrame, hydrography: DataFrame, coast: DataFrame, waterways: DataFrame, water_areas: DataFrame, extent_m: float = 5000.0) -> DataFrame:
    """Version 3b: also rivers, canals and the edges of water areas, cut to the buildings' extent grown by 5 km. The distance to
    water is over all sources together; where a city has none of one kind, the others count. Of water areas the edges that they
    have are cut to the extent; the extent's own sides, where it cuts through an area, are no water's edge here. Raises if a
    source is empty as a whole."""
    from rillgrid.functions.columns import bounds

    for name, layer in (("hydrography", hydrography), ("coast", coast)):
        if layer.isEmpty():
            raise ValueError(f"the {name} layer is empty")

    box = cut(quality.grown(quality.layer_bounds(buildings.withColumn("_b", bounds(F.col("geom"))).select("city", "_b.*"), ["city"]), extent_m))
    ways = clip_to_box(spatial.to_segments(normalize.of_classes(waterways, WATERWAYS), "city"), box).drop("piece")
    areas = clip_to_box(spatial.to_segments(normalize.of_classes(water_areas, WATER_AREAS), "city"), box).drop("piece")
    own = {name: spatial.to_segments(layer, "city") for name, layer in (("hydrography", hydrography), ("coast", coast))}
    stacked = cut(spatial.stack_sources(own | {"osm_waterways": ways, "osm_water_polygons": areas}))
    return spatial.nearest_from_footprints(buildings, stacked, ["hydrography", "coast", "osm_waterways", "osm_water_polygons"], union=True)


def city_coastline(coast: DataFrame, boundary: DataFrame, buffer_m: float = 20_000.0) -> DataFrame:
    """Coast segments cut to the boundary grown by the buffer, with their source and buffer."""
    return clip_lines_grown(coast, boundary, buffer_m).withColumns({"source": F.lit("Natural Earth 10m coastline"), "buffer_m": F.lit(buffer_m)})


def coastal_proxy(natural: DataFrame, boundary: DataFrame | None, buffer_m: float = 2000.0) -> DataFrame:
    """Beaches and cliffs as coast, cut to the boundary grown by the buffer if one is given. Raises if there is none. natural: city,
    osm_id (unique in a city), fclass, geom."""
    kept = normalize.of_classes(natural, COASTAL).withColumns({"source": F.lit("osm_gis_osm_natural_a_free"), "coastal_proxy_type": F.col("fclass")})
    if boundary is not None:
        kept = clip_polygons(kept, cut(grown(boundary, buffer_m)), ("city", "osm_id"))
    if kept.isEmpty():
        raise ValueError(f"no area of {', '.join(COASTAL)} is there")
    return kept


def clipped_water(water: DataFrame, boundary: DataFrame) -> DataFrame:
    """Water lines cut to their city's boundary, as segments with their attributes."""
    keep = [c for c in ("city", "water_id", "source", "water_type", "name") if c in water.columns]
    return clip_lines(spatial.to_segments(normalize.without_empty(water), *keep), boundary)


def normalised_city(buildings: DataFrame, boundary: DataFrame, water: DataFrame, config: CityConfig, lonlat: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """A city's raw layers (geom, geom_type, attributes) as buildings (bldg_id, kept columns), boundary (one row) and water. Layers
    named in ``lonlat`` are projected first; polygons are repaired, the boundary's features selected and dissolved."""
    raw = {"buildings": buildings, "boundary": boundary, "water": water}
    raw = {name: layer.withColumn("city", F.lit(config.city)) for name, layer in raw.items()}
    raw = {name: layer.withColumn("geom", reproject(F.col("geom"), config.crs)) if name in lonlat else layer for name, layer in raw.items()}
    lines = normalize.without_empty(raw["water"])
    if config.lines_only:
        lines = normalize.of_types(lines, normalize.LINES)
    order = [c for c in lines.columns if c not in ("geom", "city")]
    return {
        "buildings": normalize.normalised_buildings(repaired(normalize.without_empty(raw["buildings"])), config),
        "boundary": dissolved(repaired(normalize.without_empty(normalize.boundary_of(raw["boundary"], config)))),
        "water": normalize.harmonised_water(lines, config, order),
    }


def clipped_city(buildings: DataFrame, water: DataFrame, boundary: DataFrame) -> dict[str, DataFrame]:
    """Buildings and water cut to the boundary, and how many buildings there were before and after, for each city."""
    kept = cut(clip_polygons(buildings, boundary))
    return {"buildings": kept, "water": clipped_water(water, boundary), "counts": quality.counts_by_city(buildings, kept)}


def rain_hazard(hourly: DataFrame, buildings: DataFrame, crs_of_city: dict[str, int], years: tuple[int, ...], deaccumulate: bool = False) -> DataFrame:
    """Hourly rain to a value for each building: complete years, yearly maxima, their mean, filled cells, bilinear at centroids."""
    rain.check_continuity(hourly.where(F.year("time").isin(*years)))
    series = rain.deaccumulated(hourly) if deaccumulate else hourly
    grid = cut(rain.filled(rain.climatology(rain.annual_maxima(series), years)))
    rain.check_filled(grid)
    at = buildings.withColumn("_c", centroid(F.col("geom")))
    lonlat = F.lit(None).cast("struct<lon:double,lat:double>")
    for city, crs in crs_of_city.items():
        lonlat = F.when(F.col("city") == city, to_lonlat(F.col("_c.x"), F.col("_c.y"), crs)).otherwise(lonlat)
    placed = at.select("city", "bldg_id", lonlat.alias("_p")).select("city", "bldg_id", "_p.*")
    out = rain.hazard_table(rain.interpolated(placed, grid))
    quality.check_unique(out, ["city", "bldg_id"], "hazard")
    quality.check_complete(out, ["H_pluvial_v1_mm"])
    return out
