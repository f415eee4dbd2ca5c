"""The final table of a city's buildings, and the exposure score on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgrid.functions.columns import capped
from rillgrid.operators.quality import check_columns, check_complete, check_unique

DENSITIES = ("water_len_density_250m", "water_len_density_500m", "water_len_density_1000m")
HAZARDS = ("H_pluvial_v1_mm", "H_pluvial_mm", "H_pluvial")
FINAL = ("bldg_id", "dist_to_water_m", *DENSITIES, "H_pluvial_v1_mm")


def join_one_to_one(left: DataFrame, right: DataFrame, keys: list[str], check: bool = True) -> DataFrame:
    """Inner join; raises if a key is repeated on either side."""
    if check:
        check_unique(left, keys, "left side")
        check_unique(right, keys, "right side")
    return left.join(right, keys)


def first_present(df: DataFrame, candidates: tuple[str, ...], what: str) -> str:
    found = next((c for c in candidates if c in df.columns), None)
    if found is None:
        raise ValueError(f"no {what} column: none of {list(candidates)} is in {df.columns}")
    return found


def build_assets(densities: DataFrame, distances: DataFrame, hazard: DataFrame, cap_m: float | None = 5000.0, hazards: tuple[str, ...] = HAZARDS, check: bool = True) -> DataFrame:
    """city (if there is one), bldg_id and the five attributes; buildings that one of the tables lacks are left out."""
    keys = [c for c in ("city", "bldg_id") if c in densities.columns]
    check_columns(densities, [*keys, *DENSITIES], "densities")
    check_columns(distances, [*keys, "dist_to_water_m"], "distances")
    name = first_present(hazard, hazards, "hazard")
    both = join_one_to_one(densities.select(*keys, *DENSITIES), distances.select(*keys, "dist_to_water_m"), keys, check)
    out = join_one_to_one(both, hazard.select(*keys, F.col(name).alias("H_pluvial_v1_mm")), keys, check)
    out = out.withColumn("dist_to_water_m", capped(F.col("dist_to_water_m"), cap_m)).select(*keys[:-1], *FINAL)
    if check:
        check_complete(out, list(FINAL))
    return out


def exposure_score(assets: DataFrame, log1p: bool = True, sign: float = -1.0, ddof: int = 1) -> DataFrame:
    """assets with z_d, z_250, z_500, z_1000 and E_hat, their mean. Distance enters with ``sign``: near water is exposed. A column
    without spread has z = 0. The statistics are one row a city, joined back."""
    keys = ["city"] if "city" in assets.columns else []
    columns = {"z_d": "dist_to_water_m", "z_250": DENSITIES[0], "z_500": DENSITIES[1], "z_1000": DENSITIES[2]}
    value = lambda c: F.log1p(F.col(c)) if log1p else F.col(c)
    spread = F.stddev_samp if ddof else F.stddev_pop
    stats = assets.groupBy(*keys).agg(*[f for z, c in columns.items() for f in (F.avg(value(c)).alias(f"_m{z}"), spread(value(c)).alias(f"_s{z}"))])
    joined = assets.join(F.broadcast(stats), keys) if keys else assets.crossJoin(F.broadcast(stats))
    z = {z: F.when(F.col(f"_s{z}") > 0, (sign if z == "z_d" else 1.0) * (value(c) - F.col(f"_m{z}")) / F.when(F.col(f"_s{z}") > 0, F.col(f"_s{z}"))).otherwise(0.0) for z, c in columns.items()}
    out = joined.withColumns(z).drop(*[f"_{k}{z}" for z in columns for k in "ms"])
    return out.withColumn("E_hat", (F.col("z_d") + F.col("z_250") + F.col("z_500") + F.col("z_1000")) / 4)
