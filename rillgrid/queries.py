"""Queries on the given tables, one for each operation, with the SQL that says what they must return.

The tables stand for city layers: orders are buildings, suppliers water lines, customers pieces of coast, events and
lineitems hourly rain. ``FIXTURES`` are those readings, in SQL that both engines take; ``{table}`` is a table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillgrid.config import CITIES, with_registry
from rillgrid.functions import columns as C
from rillgrid.functions.crs import from_lonlat, to_lonlat
from rillgrid.functions.interior import with_interior_point
from rillgrid.operators import assets, clip, normalize, quality, rain, spatial
from rillgrid.operators.dissolve import dissolved
from rillgrid.operators.polygons import clip_polygons, repaired
from rillgrid.plans import jobs

DISC = "case when a=0 or dd<=0 then 0.0 else greatest(0.0, least(1.0,(fd+sqrt(dd))/a)-greatest(0.0,(fd-sqrt(dd))/a))*sqrt(a) end"
FOUR = "(select 0 as j union all select 1 union all select 2 union all select 3)"
FIXTURES = {
    "bldg": "select o_orderkey as bldg_id, concat('C', cast(o_custkey%3 as string)) as city, cast((o_orderkey*7919)%20011 as double) as x0, cast((o_orderkey*104729)%20021 as double) as y0, cast(6+o_orderkey%13 as double) as w, cast(6+o_orderkey%17 as double) as h from {orders}",
    "pts": "select bldg_id, city, x0+w/2 as px, y0+h/2 as py from bldg",
    "seg": f"select s_suppkey as water_id, concat('C', cast(s_nationkey%3 as string)) as city, j as seg, case s_suppkey%5 when 0 then 'river' when 1 then 'canal' when 2 then 'stream' when 3 then 'drain' end as fclass, cast((s_suppkey*6151+j*397)%20011 as double) as x1, cast((s_suppkey*3571+j*283)%20021 as double) as y1, cast((s_suppkey*6151+j*397)%20011+(s_suppkey*37+j*211)%1201-600 as double) as x2, cast((s_suppkey*3571+j*283)%20021+(s_suppkey*53+j*101)%1201-600 as double) as y2 from {{supplier}} cross join {FOUR} k",
    "coast": f"select c_custkey as water_id, j as seg, cast((c_custkey*4049+j*401)%20011 as double) as x1, cast((c_custkey*2953+j*307)%20021 as double) as y1, cast((c_custkey*4049+j*401)%20011+(c_custkey*41+j*199)%1201-600 as double) as x2, cast((c_custkey*2953+j*307)%20021+(c_custkey*59+j*103)%1201-600 as double) as y2 from {{customer}} c cross join {FOUR} k",
    "hourly": "select 'RTM' as city, date_trunc('hour', ts) as time, cast(user_id%25 as int) as cell, case when user_id%25 in (7,18) then null else value/1000 end as tp from {events}",
    "yearly": "select 'RTM' as city, l_shipdate as time, cast(l_partkey%25 as int) as cell, case when l_partkey%25 in (7,18) then null else l_extendedprice/1000000.0 end as tp from {lineitem}",
    "lonlat": "select o_orderkey as bldg_id, 'RTM' as city, 3.95+((o_orderkey*31)%600)/1000.0 as lon, 51.75+((o_orderkey*17)%600)/1000.0 as lat from {orders}",
}
GRID = "51.8+0.1*cast(floor(cell/5) as int) as latitude, 4.0+0.1*(cell%5) as longitude"
USES = {"pts": ("bldg",)}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    inner = USES.get(name, ())
    sql = FIXTURES[name]
    for n in inner:
        sql = sql.replace(f"from {n}", f"from ({FIXTURES[n]}) {n}")
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", sql))}
    return spark.sql(sql, **tables)


def duck(*names: str) -> str:
    """WITH clause of fixtures, for the oracle."""
    order = [n for n in FIXTURES if n in names or any(n in USES.get(m, ()) for m in names)]
    return "with " + ", ".join(f"{n} as ({re.sub(r'[{](\w+)[}]', r'\1', FIXTURES[n])})" for n in order)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None) -> Callable:
    def put(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = oracle
        return f

    return put


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), n) for c, n in digits.items()})


DENSE = {"water_len_density_250m": 9, "water_len_density_500m": 9, "water_len_density_1000m": 9}
NEAR_SQL = "sqrt(power(px-(x1+t*(x2-x1)),2)+power(py-(y1+t*(y2-y1)),2))"
PAIR_SQL = "select p.*, s.*, case when (x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)=0 then 0.0 else greatest(0.0,least(1.0,((px-x1)*(x2-x1)+(py-y1)*(y2-y1))/((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)))) end as t from pts p cross join (select x1,y1,x2,y2 from seg) s"
DISC_SQL = f"select p.bldg_id, r, {DISC} as len from (select bldg_id, r, a, fx*dx+fy*dy as fd, (fx*dx+fy*dy)*(fx*dx+fy*dy)-a*(fx*fx+fy*fy-r*r) as dd from (select bldg_id, r, px-x1 as fx, py-y1 as fy, x2-x1 as dx, y2-y1 as dy, (x2-x1)*(x2-x1)+(y2-y1)*(y2-y1) as a from pts cross join seg cross join (values (250.0),(500.0),(1000.0)) radii(r))) p"
DENSITY_SQL = ", ".join(f"round(sum(case when r={r} then len else 0 end)/(pi()*{r}*{r}),9) as water_len_density_{r}m" for r in (250, 500, 1000))


@query(f"{duck('pts', 'seg')}, near as (select bldg_id, round(min({NEAR_SQL}),4) as dist_to_water_m from ({PAIR_SQL}) group by 1), dens as (select bldg_id, {DENSITY_SQL} from ({DISC_SQL}) group by 1) select * from near join dens using (bldg_id)")
def water_exposure_v1(spark: SparkSession, d: str) -> DataFrame:
    """Point distance and three densities (K3)."""
    return rounded(spatial.exposure(fixture(spark, d, "pts").drop("city"), fixture(spark, d, "seg").drop("city")), dist_to_water_m=4, **DENSE)


@query(f"{duck('pts', 'seg')} select bldg_id, round(min({NEAR_SQL}),4) as dist_to_water_m from ({PAIR_SQL}) group by 1")
def nearest_water_from_point(spark: SparkSession, d: str) -> DataFrame:
    return rounded(spatial.nearest_from_points(fixture(spark, d, "pts").drop("city"), fixture(spark, d, "seg").drop("city")), dist_to_water_m=4)


@query(f"{duck('pts', 'seg')} select bldg_id, {DENSITY_SQL} from ({DISC_SQL}) group by 1")
def water_length_density(spark: SparkSession, d: str) -> DataFrame:
    return rounded(spatial.water_length_density(fixture(spark, d, "pts").drop("city"), fixture(spark, d, "seg").drop("city")), **DENSE)


@query(f"{duck('pts', 'seg')} select p.city, p.bldg_id, round(min({NEAR_SQL}),4) as dist_to_water_m from (select p.*, s.x1,s.y1,s.x2,s.y2, case when (x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)=0 then 0.0 else greatest(0.0,least(1.0,((px-x1)*(x2-x1)+(py-y1)*(y2-y1))/((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)))) end as t from pts p left join seg s on p.city=s.city) p group by 1,2")
def nearest_water_by_city(spark: SparkSession, d: str) -> DataFrame:
    """All cities in one job (U2)."""
    return rounded(spatial.nearest_from_points(fixture(spark, d, "pts"), fixture(spark, d, "seg")), dist_to_water_m=4).select("city", "bldg_id", "dist_to_water_m")


def _footprints(spark: SparkSession, d: str) -> DataFrame:
    x0, y0, x1, y1 = F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h")
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return fixture(spark, d, "bldg").withColumn("geom", F.array(F.array(F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1), p(x0, y0)))))


# No segment whose box is farther from the rectangle than the nearest end of any can be the nearest one.
# For an upright rectangle and a segment: least distance is 0 if the clipped parameter range is not empty, else the least over corners to the segment and ends to the rectangle.
_END = "sqrt(power(greatest(x0-{x},0,{x}-(x0+w)),2)+power(greatest(y0-{y},0,{y}-(y0+h)),2))"
_CORNER = "sqrt(power({x}-(x1+greatest(0.0,least(1.0,(({x}-x1)*dx+({y}-y1)*dy)/a0))*dx),2)+power({y}-(y1+greatest(0.0,least(1.0,(({x}-x1)*dx+({y}-y1)*dy)/a0))*dy),2))"
RECT_SQL = (
    "least(" + ", ".join([_END.format(x="x1", y="y1"), _END.format(x="x2", y="y2"), *[_CORNER.format(x=x, y=y) for x in ("x0", "(x0+w)") for y in ("y0", "(y0+h)")]]) + ")"
)
HIT_SQL = "greatest(0.0, case when dx=0 then (case when x1 between x0 and x0+w then 0.0 else 2.0 end) else least((x0-x1)/dx,(x0+w-x1)/dx) end, case when dy=0 then (case when y1 between y0 and y0+h then 0.0 else 2.0 end) else least((y0-y1)/dy,(y0+h-y1)/dy) end) <= least(1.0, case when dx=0 then 1.0 else greatest((x0-x1)/dx,(x0+w-x1)/dx) end, case when dy=0 then 1.0 else greatest((y0-y1)/dy,(y0+h-y1)/dy) end)"


@query(f"{duck('bldg', 'seg', 'coast')}, water as (select 'hydrography' as src, x1,y1,x2,y2 from seg union all select 'coast', x1,y1,x2,y2 from coast), most as (select bldg_id, src, min({_END.format(x='x1', y='y1')}) as u from bldg cross join water group by 1,2), pairs as (select bldg_id, x0,y0,w,h, src, x1,y1,x2,y2, case when x2=x1 then 0.0 else x2-x1 end as dx, y2-y1 as dy, case when (x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)=0 then 1.0 else (x2-x1)*(x2-x1)+(y2-y1)*(y2-y1) end as a0 from bldg join most using (bldg_id) join water using (src) where power(greatest(least(x1,x2)-(x0+w),x0-greatest(x1,x2),0),2)+power(greatest(least(y1,y2)-(y0+h),y0-greatest(y1,y2),0),2)<=u*u+1), dist as (select bldg_id, src, min(case when {HIT_SQL} then 0.0 else {RECT_SQL} end) as d from pairs group by 1,2) select bldg_id, round(max(case when src='hydrography' then d end),4) as dist_to_hydrography_m, round(max(case when src='coast' then d end),4) as dist_to_coast_m, round(min(d),4) as dist_to_water_m from dist group by 1")
def nearest_water_from_footprint(spark: SparkSession, d: str) -> DataFrame:
    """Footprint distance to each source and the least of them (K6)."""
    water = spatial.stack_sources({"hydrography": fixture(spark, d, "seg").drop("city"), "coast": fixture(spark, d, "coast")})
    out = spatial.nearest_from_footprints(_footprints(spark, d).drop("city"), water, ["hydrography", "coast"])
    return rounded(out, dist_to_hydrography_m=4, dist_to_coast_m=4, dist_to_water_m=4)


@query(f"{duck('bldg')} select bldg_id, w*h as area, round(x0+w/2,6) as cx, round(y0+h/2,6) as cy, 2*(w+h) as perimeter, x0 as xmin, y0 as ymin, x0+w as xmax, y0+h as ymax from bldg")
def footprint_measures(spark: SparkSession, d: str) -> DataFrame:
    g = F.col("geom")
    out = _footprints(spark, d).select("bldg_id", C.area(g).alias("area"), C.centroid(g).alias("c"), C.path_length(g[0][0]).alias("perimeter"), C.bounds(g).alias("b"))
    return out.select("bldg_id", "area", F.round("c.x", 6).alias("cx"), F.round("c.y", 6).alias("cy"), "perimeter", "b.*")


@query(f"{duck('bldg')} select bldg_id, cast(k as int) as seg, x0+(case when k in (1,2) then w else 0 end) as x1, y0+(case when k in (2,3) then h else 0 end) as y1, x0+(case when k in (0,1) then w else 0 end) as x2, y0+(case when k in (1,2) then h else 0 end) as y2 from bldg cross join (values (0),(1),(2),(3)) s(k)")
def polygon_boundary_segments(spark: SparkSession, d: str) -> DataFrame:
    return spatial.to_segments(_footprints(spark, d), "bldg_id").select("bldg_id", F.col("seg").cast("int"), "x1", "y1", "x2", "y2")


@query(f"{duck('bldg')} select bldg_id as source_id, row_number() over (order by x0+w/2 nulls last, y0+h/2 nulls last, w*h nulls last, bldg_id) as bldg_id from bldg")
def deterministic_building_ids(spark: SparkSession, d: str) -> DataFrame:
    out = normalize.building_ids(_footprints(spark, d).drop("city").withColumnRenamed("bldg_id", "source_id"), "source_id")
    return out.select("source_id", "bldg_id")


def _rain(spark: SparkSession, d: str, name: str) -> DataFrame:
    return fixture(spark, d, name).selectExpr("*", *GRID.split(", "))


@query(f"{duck('hourly')}, st as (select distinct city, year(time) as year, time from hourly), lagged as (select *, epoch(time)-epoch(lag(time) over (partition by city, year order by time)) as step from st) select city, cast(year as int) as year, count(*) as n_hours, cast(max(year%4=0 and (year%100<>0 or year%400=0))::int*24+365*24 as int) as expected, cast(min(step) as bigint) as min_step_s, cast(max(step) as bigint) as max_step_s, false as complete from lagged group by 1,2".replace("cast(max(year%4=0 and (year%100<>0 or year%400=0))::int*24+365*24 as int)", "cast(365*24+24*max(case when year%4=0 and (year%100<>0 or year%400=0) then 1 else 0 end) as int)"))
def rain_continuity(spark: SparkSession, d: str) -> DataFrame:
    return rain.continuity(_rain(spark, d, "hourly")).drop("n_months")


@query(f"{duck('yearly')} select city, cast(year(time) as int) as year, cell, round(max(tp*1000.0),6) as tp_amax_mm from yearly group by 1,2,3")
def rain_annual_maxima(spark: SparkSession, d: str) -> DataFrame:
    out = rain.annual_maxima(_rain(spark, d, "yearly"))
    return out.select("city", "year", F.round((F.col("latitude") - 51.8) * 50 + (F.col("longitude") - 4.0) * 10).cast("int").alias("cell"), F.round("tp_amax_mm", 6).alias("tp_amax_mm"))


YEARS = tuple(range(1995, 2002))
CLIM_SQL = "clim as (select city, cell, avg(m) as h from (select city, cell, year(time) as y, max(tp*1000.0) as m from yearly group by 1,2,3) group by 1,2)"
FILL_SQL = f"{CLIM_SQL}, fills as (select a.city, a.cell, arg_min(b.h, struct_pack(d:=power(a.cell//5-b.cell//5,2)+power(a.cell%5-b.cell%5,2), i:=b.cell//5, j:=b.cell%5)) as h from clim a join clim b on a.city=b.city and a.h is null and b.h is not null group by 1,2), full_grid as (select clim.city, clim.cell, coalesce(clim.h, fills.h) as h, clim.h is null as was_filled from clim left join fills on clim.city=fills.city and clim.cell=fills.cell)"


def _climatology(spark: SparkSession, d: str) -> DataFrame:
    return rain.climatology(rain.annual_maxima(_rain(spark, d, "yearly")), YEARS)


def _cell_number():
    return F.round((F.col("latitude") - 51.8) * 50 + (F.col("longitude") - 4.0) * 10).cast("int").alias("cell")


@query(f"{duck('yearly')}, {CLIM_SQL} select city, cell, round(h,6) as \"H_pluvial_v1_mm\" from clim")
def rain_climatology(spark: SparkSession, d: str) -> DataFrame:
    return _climatology(spark, d).select("city", _cell_number(), F.round("H_pluvial_v1_mm", 6).alias("H_pluvial_v1_mm"))


@query(f"{duck('yearly')}, {FILL_SQL} select city, cell, round(h,6) as \"H_pluvial_v1_mm\", was_filled from full_grid")
def rain_grid_filled(spark: SparkSession, d: str) -> DataFrame:
    return rain.filled(_climatology(spark, d)).select("city", _cell_number(), F.round("H_pluvial_v1_mm", 6).alias("H_pluvial_v1_mm"), "was_filled")


@query(f"{duck('yearly', 'lonlat')}, {FILL_SQL}, pos as (select bldg_id, city, least(greatest((lon-4.0)/0.1,0.0),4.0) as gx, least(greatest((lat-51.8)/0.1,0.0),4.0) as gy from lonlat), low as (select *, least(cast(floor(gx) as int),3) as j, least(cast(floor(gy) as int),3) as i from pos) select bldg_id, round(a.h*(1-(gx-j))*(1-(gy-i))+b.h*(gx-j)*(1-(gy-i))+c.h*(1-(gx-j))*(gy-i)+e.h*(gx-j)*(gy-i),9) as \"H_pluvial_v1_mm\" from low join full_grid a on a.cell=i*5+j join full_grid b on b.cell=i*5+j+1 join full_grid c on c.cell=i*5+j+5 join full_grid e on e.cell=i*5+j+6")
def rain_on_buildings(spark: SparkSession, d: str) -> DataFrame:
    """Yearly maxima, climatology, filling, clamped bilinear interpolation (K8)."""
    out = rain.interpolated(fixture(spark, d, "lonlat"), rain.filled(_climatology(spark, d)))
    return out.select("bldg_id", F.round("H_pluvial_v1_mm", 9).alias("H_pluvial_v1_mm"))


#: The Dutch system as the survey's own text has it, step by step: geocentric, shifted, geodetic by iteration, conformal sphere by
#: ratios, plane.
DUTCH_SQL = (
    "c as (select *, 6377397.155 as a, 2/299.1528128-power(1/299.1528128,2) as e2, radians(52+9/60.0+22.178/3600.0) as p0, radians(5+23/60.0+15.5/3600.0) as l0,"
    " 2/298.257222101-power(1/298.257222101,2) as g2 from lonlat),"
    " k as (select *, sqrt(e2) as e, sqrt(1+e2*power(cos(p0),4)/(1-e2)) as n, a*sqrt(1-e2)/(1-e2*power(sin(p0),2)) as r, 6378137.0/sqrt(1-g2*power(sin(radians(lat)),2)) as nu from c),"
    " g as (select *, (nu+43)*cos(radians(lat))*cos(radians(lon)) as gx, (nu+43)*cos(radians(lat))*sin(radians(lon)) as gy, (nu*(1-g2)+43)*sin(radians(lat)) as gz from k),"
    " b as (select *, -565.7346+(1-4.07242e-6)*(gx-9.09546e-6*gy-1.60365e-6*gz) as sx, -50.4058+(1-4.07242e-6)*(9.09546e-6*gx+gy-1.91514e-6*gz) as sy,"
    " -465.2895+(1-4.07242e-6)*(1.60365e-6*gx+1.91514e-6*gy+gz) as sz from g),"
    " f0 as (select *, sqrt(sx*sx+sy*sy) as q, atan2(sz, sqrt(sx*sx+sy*sy)*(1-e2)) as f from b)"
    + "".join(f", f{i} as (select * exclude (f), atan2(sz+e2*a*sin(f)/sqrt(1-e2*power(sin(f),2)), q) as f from f{i - 1})" for i in range(1, 8))
    + ", w as (select *, power((1+sin(f))/(1-sin(f))*power((1-e*sin(f))/(1+e*sin(f)),e),n) as w1, power((1+sin(p0))/(1-sin(p0))*power((1-e*sin(p0))/(1+e*sin(p0)),e),n) as w0 from f7),"
    " s as (select *, (n+sin(p0))*(1-(w0-1)/(w0+1))/((n-sin(p0))*(1+(w0-1)/(w0+1))) as cc, n*(atan2(sy,sx)-l0) as dl from w),"
    " t as (select *, asin((cc*w1-1)/(cc*w1+1)) as x1, asin((cc*w0-1)/(cc*w0+1)) as x0 from s)"
)


@query(
    f"{duck('lonlat')}, {DUTCH_SQL} select bldg_id, round(155000+2*r*0.9999079*cos(x1)*sin(dl)/(1+sin(x1)*sin(x0)+cos(x1)*cos(x0)*cos(dl)),2) as x,"
    " round(463000+2*r*0.9999079*(sin(x1)*cos(x0)-cos(x1)*sin(x0)*cos(dl))/(1+sin(x1)*sin(x0)+cos(x1)*cos(x0)*cos(dl)),2) as y,"
    " round(lon,7) as lon, round(lat,7) as lat from t"
)
def dutch_coordinates(spark: SparkSession, d: str) -> DataFrame:
    """Longitude and latitude to the Dutch system and back (C1)."""
    there = fixture(spark, d, "lonlat").select("bldg_id", from_lonlat(F.col("lon"), F.col("lat"), 28992).alias("p"))
    out = there.select("bldg_id", "p.*", to_lonlat(F.col("p.x"), F.col("p.y"), 28992).alias("q"))
    return rounded(out.select("bldg_id", "x", "y", "q.*"), x=2, y=2, lon=7, lat=7)


@query(f"{duck('hourly')} select city, count(*) as n, count(*) filter (where tp is null) as n_missing, round(avg(case when tp is not null then 1.0 else 0.0 end),9) as finite_fraction, max(tp) as max, round(avg(tp),9) as mean from hourly group by 1")
def rain_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(rain.profile(_rain(spark, d, "hourly")), finite_fraction=9, mean=9)


@query(f"{duck('hourly')} select city, cast(cell%5 as int) as col, count(tp)>0 as has_data from hourly group by 1,2")
def rain_columns_with_data(spark: SparkSession, d: str) -> DataFrame:
    return rain.columns_with_data(_rain(spark, d, "hourly")).select("city", F.round((F.col("longitude") - 4.0) * 10).cast("int").alias("col"), "has_data")


# Distances are known for orders with lines only, so the joins lose the others.
_PARTS = "dens as (select o_orderkey as bldg_id, (o_orderkey%997)/1e5 as water_len_density_250m, (o_orderkey%991)/1e5 as water_len_density_500m, (o_orderkey%983)/1e5 as water_len_density_1000m from {orders})"
_DIST = "dist as (select l_orderkey as bldg_id, cast((l_orderkey*31)%9000 as double) as dist_to_water_m from {lineitem} group by 1)"
_HAZ = "haz as (select o_orderkey as bldg_id, o_totalprice/1000.0 as h from {orders})"
ASSET_SQL = f"with {_PARTS}, {_DIST}, {_HAZ}, assets as (select bldg_id, case when dist_to_water_m>5000 then 5000.0 else dist_to_water_m end as dist_to_water_m, water_len_density_250m, water_len_density_500m, water_len_density_1000m, h as \"H_pluvial_v1_mm\" from dens join dist using (bldg_id) join haz using (bldg_id))".replace("{orders}", "orders").replace("{lineitem}", "lineitem")


def _assets(spark: SparkSession, d: str) -> DataFrame:
    o = spark.read.parquet(f"{d}/orders.parquet")
    k = F.col("o_orderkey")
    dens = o.select(k.alias("bldg_id"), *[(k % n / 1e5).alias(c) for n, c in zip((997, 991, 983), assets.DENSITIES, strict=True)])
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("bldg_id")).distinct()
    dist = lines.select("bldg_id", ((F.col("bldg_id") * 31) % 9000).cast("double").alias("dist_to_water_m"))
    haz = o.select(k.alias("bldg_id"), (F.col("o_totalprice") / 1000.0).alias("H_pluvial_mm"))
    return assets.build_assets(dens, dist, haz, CITIES["RTM"].cap_m)


@query(f"{ASSET_SQL} select bldg_id, round(dist_to_water_m,4) as dist_to_water_m, round(water_len_density_250m,9) as water_len_density_250m, round(water_len_density_500m,9) as water_len_density_500m, round(water_len_density_1000m,9) as water_len_density_1000m, round(\"H_pluvial_v1_mm\",6) as \"H_pluvial_v1_mm\" from assets")
def asset_table(spark: SparkSession, d: str) -> DataFrame:
    """Two checked 1:1 joins, cap, canonical names, no missing values (K9)."""
    return rounded(_assets(spark, d), dist_to_water_m=4, H_pluvial_v1_mm=6, **DENSE)


_Z = {"z_d": "dist_to_water_m", "z_250": "water_len_density_250m", "z_500": "water_len_density_500m", "z_1000": "water_len_density_1000m"}
_Z_SQL = ", ".join(f"{'-' if z == 'z_d' else ''}(ln(1+{c})-avg(ln(1+{c})) over ())/stddev_samp(ln(1+{c})) over () as {z}" for z, c in _Z.items())


@query(f"{ASSET_SQL} select bldg_id, round((z_d+z_250+z_500+z_1000)/4,5) as \"E_hat\" from (select bldg_id, {_Z_SQL} from assets)")
def exposure_score(spark: SparkSession, d: str) -> DataFrame:
    return assets.exposure_score(_assets(spark, d)).select("bldg_id", F.round("E_hat", 5).alias("E_hat"))


_CORR = list(_Z.values())
@query(ASSET_SQL + " " + " union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a},{b}),6) as corr from assets" for k, a in enumerate(_CORR) for b in _CORR[k + 1 :]))
def exposure_correlations(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.correlations(_assets(spark, d), _CORR), corr=6)


def _describe_sql(c: str) -> str:
    q = ", ".join(f"round(quantile_cont({c},{v}),6) as p{round(100 * v):02d}" for v in quality.QUANTILES)
    return f"select '{c}' as \"column\", count({c}) as n, round(avg({c}),6) as mean, round(stddev_samp({c}),6) as std, round(min({c}),6) as min, {q}, round(max({c}),6) as max from lineitem"


@query(" union all ".join(map(_describe_sql, ("l_quantity", "l_extendedprice", "l_discount"))))
def describe_table(spark: SparkSession, d: str) -> DataFrame:
    df = spark.read.parquet(f"{d}/lineitem.parquet")
    return rounded(quality.describe(df, ["l_quantity", "l_extendedprice", "l_discount"]), **{c: 6 for c in ("mean", "std", "min", "p01", "p05", "p10", "p50", "p90", "p95", "p99", "max")})


@query("select l_orderkey, l_linenumber, count(*) as count from lineitem group by 1,2 having count(*)>1")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_keys(spark.read.parquet(f"{d}/lineitem.parquet"), ["l_orderkey", "l_linenumber"])


@query("select l_orderkey, l_linenumber, l_partkey, round(l_extendedprice,2) as price from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_extendedprice, l_suppkey, l_shipdate) as n from lineitem) where n=1")
def drop_duplicates_keep_first(spark: SparkSession, d: str) -> DataFrame:
    out = quality.first_of_each(spark.read.parquet(f"{d}/lineitem.parquet"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_extendedprice", "l_suppkey", "l_shipdate"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("l_extendedprice", 2).alias("price"))


@query(f"{duck('seg')} select fclass, count(*) as count from seg group by 1")
def category_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.category_counts(fixture(spark, d, "seg"), "fclass")


@query(f"{duck('seg')} select water_id, seg, fclass from seg where fclass in ('river','canal')")
def feature_class_filter(spark: SparkSession, d: str) -> DataFrame:
    return normalize.of_classes(fixture(spark, d, "seg"), ("river", "canal")).select("water_id", "seg", "fclass")


@query(f"{duck('bldg')} select bldg_id from bldg where x0+w>=5000 and x0<=9000 and y0+h>=2000 and y0<=7000")
def bounding_box_filter(spark: SparkSession, d: str) -> DataFrame:
    boxed = fixture(spark, d, "bldg").selectExpr("bldg_id", "x0 as xmin", "y0 as ymin", "x0+w as xmax", "y0+h as ymax")
    return quality.in_box(boxed, (5000.0, 2000.0, 9000.0, 7000.0)).select("bldg_id")


@query(f"{duck('bldg')} select city, min(x0)-5000 as xmin, min(y0)-5000 as ymin, max(x0+w)+5000 as xmax, max(y0+h)+5000 as ymax from bldg group by 1")
def layer_extent_grown(spark: SparkSession, d: str) -> DataFrame:
    boxed = fixture(spark, d, "bldg").selectExpr("city", "x0 as xmin", "y0 as ymin", "x0+w as xmax", "y0+h as ymax")
    return quality.grown(quality.layer_bounds(boxed, ["city"]), 5000.0)


@query(f"{duck('bldg')} select city, count(*) as n_before, count(*) filter (where x0<10000) as n_after from bldg group by 1")
def counts_before_and_after(spark: SparkSession, d: str) -> DataFrame:
    b = fixture(spark, d, "bldg")
    return quality.counts_by_city(b, b.where("x0 < 10000"))


@query("with new as (select l_orderkey as k, cast((l_orderkey*31)%900 as double) as v from lineitem group by 1), old as (select o_orderkey as k, cast((o_orderkey*37)%900 as double) as v from orders), j as (select new.v-old.v as dl from new join old using (k)) select count(*) as n, round(avg(dl),6) as mean_delta, min(dl) as min_delta, max(dl) as max_delta, round(avg(case when dl<-10 then 1.0 else 0.0 end),9) as share_below_10, round(avg(case when dl<-50 then 1.0 else 0.0 end),9) as share_below_50, round(avg(case when dl<-100 then 1.0 else 0.0 end),9) as share_below_100, round(avg(case when dl>10 then 1.0 else 0.0 end),9) as share_above_10 from j")
def compare_versions(spark: SparkSession, d: str) -> DataFrame:
    keys = (spark.read.parquet(f"{d}/{table}.parquet").select(F.col(key).alias("k")).distinct() for table, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")))
    new, old = (df.select("k", ((F.col("k") * n) % 900).cast("double").alias("v")) for df, n in zip(keys, (31, 37), strict=True))
    return rounded(quality.compare(new, old, ["k"], "v"), mean_delta=6, share_below_10=9, share_below_50=9, share_below_100=9, share_above_10=9)


@query("select count(*) filter (where c_name is null) as c_name, count(*) filter (where c_acctbal is null) as c_acctbal from customer")
def missing_value_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.missing_counts(spark.read.parquet(f"{d}/customer.parquet"), ["c_name", "c_acctbal"])


@query("select o_orderkey as bldg_id, o_totalprice from orders order by 1 limit 10")
def preview_rows(spark: SparkSession, d: str) -> DataFrame:
    return quality.preview(spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_orderkey as bldg_id", "o_totalprice"), 10)


@query(None)
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    """Exactly n rows, the same for a seed (a sampling operator)."""
    return quality.sample_exactly(spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_orderkey as bldg_id"), 500)


@query("select cast(s_suppkey as string) as water_id, 'gipuzkoa_hydrography' as source, cast(s_nationkey as string) as water_type, s_name as name from supplier")
def harmonised_hydrography(spark: SparkSession, d: str) -> DataFrame:
    layer = spark.read.parquet(f"{d}/supplier.parquet").selectExpr("s_suppkey as gid", "s_name as name", "s_nationkey as SUBTYPE_EU")
    return normalize.harmonised_water(layer, CITIES["DON"], ["gid"])


@query("select cast(row_number() over (order by s_suppkey)-1 as string) as water_id, 'pdok_topnl' as source, cast(null as string) as water_type, s_name as name from supplier")
def hydrography_row_numbers(spark: SparkSession, d: str) -> DataFrame:
    layer = spark.read.parquet(f"{d}/supplier.parquet").selectExpr("s_suppkey as fid", "s_name as naam")
    return normalize.harmonised_water(layer, CITIES["RTM"], ["fid"])


@query("select n_nationkey, n_name from nation where trim(n_name) = (select trim(n_name) from nation where n_nationkey=7)")
def boundary_selection(spark: SparkSession, d: str) -> DataFrame:
    from dataclasses import replace

    nations = spark.read.parquet(f"{d}/nation.parquet")
    name = nations.where("n_nationkey = 7").first().n_name
    padded = nations.withColumn("n_name", F.concat(F.lit("  "), "n_name", F.lit(" ")))
    config = replace(CITIES["RTM"], boundary_column="n_name", boundary_value=name.strip())
    return normalize.boundary_of(padded, config).select("n_nationkey", F.trim("n_name").alias("n_name"))


@query("select c_custkey, case c_nationkey%3 when 0 then 'RTM' when 1 then 'HAM' else 'DON' end as city, cast(case c_nationkey%3 when 0 then 28992 when 1 then 25832 else 25830 end as int) as code, true as crs_locked from customer")
def site_registry(spark: SparkSession, d: str) -> DataFrame:
    city = F.when(F.col("c_nationkey") % 3 == 0, "RTM").when(F.col("c_nationkey") % 3 == 1, "HAM").otherwise("DON")
    rows = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", city.alias("city"))
    return with_registry(rows).select("c_custkey", "city", "code", "crs_locked")


@query(
    "select c_custkey, site, code, coalesce(status='locked', false) as crs_locked from (select c_custkey, case c_nationkey%6 when 0 then 'DON' when 1 then 'san_francisco' "
    "when 2 then 'concordia_station' when 3 then 'shackleton_crater' when 4 then 'mars_reference' else 'atlantis' end as site from customer) left join "
    "(values ('DON',25830,'locked'),('san_francisco',32610,'proposed'),('concordia_station',3031,'proposed'),('shackleton_crater',null,'conceptual'),('mars_reference',null,'conceptual')) t(site,code,status) using (site)"
)
def sites_without_agreed_system(spark: SparkSession, d: str) -> DataFrame:
    """Sites whose system is proposed, conceptual or not known at all are not locked (F13)."""
    names = ("DON", "san_francisco", "concordia_station", "shackleton_crater", "mars_reference", "atlantis")
    site = F.element_at(F.array(*map(F.lit, names)), (F.col("c_nationkey") % 6 + 1).cast("int"))
    rows = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", site.alias("city"))
    return with_registry(rows).select("c_custkey", F.col("city").alias("site"), "code", "crs_locked")


@query("with v as (select l_orderkey, l_linenumber, case when l_linenumber%4=0 then null else l_quantity end as a, l_tax*100 as b from lineitem) select l_orderkey, l_linenumber, round(case when a is null or b is null then null else least(a,b) end,6) as least_value, round(case when a>30 then 30.0 else a end,6) as capped from v")
def combined_and_capped(spark: SparkSession, d: str) -> DataFrame:
    """Row minimum and cap that let missing values through."""
    v = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 4 != 0, F.col("l_quantity")).alias("a"), (F.col("l_tax") * 100).alias("b"))
    return v.select("l_orderkey", "l_linenumber", F.round(C.least_of_all(F.col("a"), F.col("b")), 6).alias("least_value"), F.round(C.capped(F.col("a"), 30.0), 6).alias("capped"))


@query("select distinct cast(year(l_shipdate) as int) as year, cast(case when year(l_shipdate)%4=0 and (year(l_shipdate)%100<>0 or year(l_shipdate)%400=0) then 8784 else 8760 end as int) as hours from lineitem")
def expected_hours(spark: SparkSession, d: str) -> DataFrame:
    years = spark.read.parquet(f"{d}/lineitem.parquet").select(F.year("l_shipdate").alias("year")).distinct()
    return years.select("year", C.expected_hours(F.col("year")).alias("hours"))


def _rectangle(x0, y0, x1, y1):
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1), p(x0, y0))))


_TOWN_SQL = "town as (select 'C'||k as city, 3000.5+k*500 as bx0, 2500.5 as by0, 15000.5 as bx1, 12000.5+k*900 as by1 from (values (0),(1),(2)) t(k))"


def _towns(spark: SparkSession) -> DataFrame:
    """city, geom: an upright boundary for each city."""
    k = F.col("id")
    return spark.range(3).select(F.concat(F.lit("C"), k).alias("city"), _rectangle(3000.5 + k * 500, F.lit(2500.5), F.lit(15000.5), 12000.5 + k * 900).alias("geom"))


@query(f"{duck('bldg')}, {_TOWN_SQL}, met as (select city, bldg_id, greatest(x0,bx0) as xmin, greatest(y0,by0) as ymin, least(x0+w,bx1) as xmax, least(y0+h,by1) as ymax from bldg join town using (city)) select city, bldg_id, round((xmax-xmin)*(ymax-ymin),6) as area, round(xmin,6) as xmin, round(ymin,6) as ymin, round(xmax,6) as xmax, round(ymax,6) as ymax from met where xmin<xmax and ymin<ymax")
def clip_buildings_box(spark: SparkSession, d: str) -> DataFrame:
    """Building polygons cut to their city's boundary, ids kept (J2)."""
    out = clip_polygons(_footprints(spark, d), _towns(spark)).select("city", "bldg_id", C.area(F.col("geom")).alias("area"), C.bounds(F.col("geom")).alias("b"))
    return rounded(out.select("city", "bldg_id", "area", "b.*"), area=6, xmin=6, ymin=6, xmax=6, ymax=6)


_T = "case when {d}=0 then (case when {a} between {lo} and {hi} then {all} else {none} end) else {f}(({lo}-{a})/{d},({hi}-{a})/{d}) end"
_T0, _T1 = ([_T.format(d=f"({v}2-{v}1)", a=f"{v}1", lo=f"b{v}0", hi=f"b{v}1", f=f, all=all_, none=none) for v in "xy"] for f, all_, none in (("least", "0.0", "2.0"), ("greatest", "1.0", "-1.0")))


@query(f"{duck('seg')}, {_TOWN_SQL}, met as (select water_id, seg, sqrt(power(x2-x1,2)+power(y2-y1,2)) as size, greatest(0.0,{_T0[0]},{_T0[1]}) as a, least(1.0,{_T1[0]},{_T1[1]}) as b from seg join town using (city)) select water_id, seg, round((b-a)*size,4) as length, round(a,6) as starts from met where a<b")
def clip_lines_box(spark: SparkSession, d: str) -> DataFrame:
    """Water lines cut to their city's boundary, attributes kept (J1)."""
    out = clip.clip_lines(fixture(spark, d, "seg"), _towns(spark))
    size = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    out = out.groupBy("water_id", "seg").agg(F.sum(size).alias("length"), F.min("piece").alias("starts"))
    return rounded(out.where("length > 0"), length=4, starts=6)


_GRID = "cells as (select c_nationkey%5 as i, cast(floor(c_nationkey/5) as int) as j, count(*) as n from customer group by 1,2), all_cells as (select 'R'||(i+j)%2 as city, i*100.0 as cx, j*100.0 as cy from cells union all select 'R2', i*100.0, j*100.0 from cells)"


@query(f"with {_GRID} select city, cast(sum(10000.0) as double) as area, min(cx) as xmin, min(cy) as ymin, max(cx)+100 as xmax, max(cy)+100 as ymax from all_cells group by 1")
def dissolved_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of a board made one geometry: those of a colour touch in corners only, all of them share sides (A10)."""
    k = F.col("c_nationkey")
    cells = spark.read.parquet(f"{d}/customer.parquet").select((k % 5).alias("i"), F.floor(k / 5).alias("j")).distinct()
    x, y = F.col("i") * 100.0, F.col("j") * 100.0
    cells = cells.withColumn("geom", _rectangle(x, y, x + 100, y + 100))
    both = cells.select(F.concat(F.lit("R"), (F.col("i") + F.col("j")) % 2).alias("city"), "geom").union(cells.select(F.lit("R2"), "geom"))
    out = dissolved(both).select("city", C.area(F.col("geom")).alias("area"), C.bounds(F.col("geom")).alias("b"))
    return rounded(out.select("city", "area", "b.*"), area=6)


_TOUCH_SQL = "sqrt(power(greatest(0,x0-(cx0+cw),cx0-(x0+w)),2)+power(greatest(0,y0-(cy0+ch),cy0-(y0+h)),2))"
_BEACH_SQL = (
    "beach as (select 'C'||(c_nationkey%3) as city, cast((c_custkey*4049)%20011 as double) as cx0, cast((c_custkey*2953)%20021 as double) as cy0, "
    "cast(20+c_custkey%90 as double) as cw, cast(30+c_custkey%70 as double) as ch from customer)"
)
_EDGES_SQL = (
    "select city, cx0+(case when k in (1,2) then cw else 0 end) as x1, cy0+(case when k in (2,3) then ch else 0 end) as y1, "
    "cx0+(case when k in (0,1) then cw else 0 end) as x2, cy0+(case when k in (1,2) then ch else 0 end) as y2 from beach cross join (values (0),(1),(2),(3)) s(k)"
)
_PAIRS_SQL = (
    "select city, bldg_id, x0,y0,w,h, x1,y1,x2,y2, case when x2=x1 then 0.0 else x2-x1 end as dx, y2-y1 as dy, "
    "case when (x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)=0 then 1.0 else (x2-x1)*(x2-x1)+(y2-y1)*(y2-y1) end as a0 from bldg join seg using (city)"
)
_CITY_DISC_SQL = (
    f"select city, bldg_id, r, {DISC} as len from (select city, bldg_id, r, a, fx*dx+fy*dy as fd, (fx*dx+fy*dy)*(fx*dx+fy*dy)-a*(fx*fx+fy*fy-r*r) as dd "
    "from (select city, bldg_id, r, px-x1 as fx, py-y1 as fy, x2-x1 as dx, y2-y1 as dy, (x2-x1)*(x2-x1)+(y2-y1)*(y2-y1) as a "
    "from pts join water using (city) cross join (values (250.0),(500.0),(1000.0)) radii(r)))"
)


def _beaches(spark: SparkSession, d: str) -> DataFrame:
    """city, geom: a box for each customer."""
    k, x, y = F.col("c_custkey"), F.col("c_custkey") * 4049 % 20011, F.col("c_custkey") * 2953 % 20021
    box = _rectangle(x, y, x + 20 + k % 90, y + 30 + k % 70)
    return spark.read.parquet(f"{d}/customer.parquet").select(F.concat(F.lit("C"), F.col("c_nationkey") % 3).alias("city"), box.alias("geom"))


def _lines_of(segments: DataFrame) -> DataFrame:
    p = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return segments.withColumns({"geom": F.array(F.array(F.array(p("x1", "y1"), p("x2", "y2")))), "geom_type": F.lit("LineString")})


@query(
    f"{duck('bldg', 'pts', 'seg')}, {_BEACH_SQL}, water as (select city,x1,y1,x2,y2 from seg union all {_EDGES_SQL}), pairs as ({_PAIRS_SQL}), "
    f"hyd as (select city, bldg_id, min(case when {HIT_SQL} then 0.0 else {RECT_SQL} end) as a from pairs group by 1,2), "
    f"cst as (select city, bldg_id, min({_TOUCH_SQL}) as b from bldg join beach using (city) group by 1,2), "
    f"dens as (select city, bldg_id, {DENSITY_SQL} from ({_CITY_DISC_SQL}) group by 1,2) "
    "select city, bldg_id, round(a,4) as dist_to_hydrography_m, round(b,4) as dist_to_coast_m, round(least(a,b),4) as dist_to_water_m, dens.* exclude (city, bldg_id) "
    "from hyd join cst using (city, bldg_id) join dens using (city, bldg_id)"
)
def coast_exposure_job(spark: SparkSession, d: str) -> DataFrame:
    """The whole second job: footprint distances, 0 in a coastal area, and densities of all water from centroids (K5)."""
    out = jobs.proximity_with_coast(_footprints(spark, d), _lines_of(fixture(spark, d, "seg")), _beaches(spark, d))
    return rounded(out.select("city", "bldg_id", "dist_to_hydrography_m", "dist_to_coast_m", "dist_to_water_m", *DENSE), dist_to_hydrography_m=4, dist_to_coast_m=4, dist_to_water_m=4, **DENSE)


@query(
    f"{duck('bldg', 'seg')}, {_TOWN_SQL}, met as (select city, greatest(x0,bx0) as xmin, greatest(y0,by0) as ymin, least(x0+w,bx1) as xmax, least(y0+h,by1) as ymax from bldg join town using (city)), "
    "kept as (select city, count(*) as n_after, round(sum((xmax-xmin)*(ymax-ymin)),3) as area from met where xmin<xmax and ymin<ymax group by 1), "
    f"cuts as (select city, sqrt(power(x2-x1,2)+power(y2-y1,2)) as size, greatest(0.0,{_T0[0]},{_T0[1]}) as a, least(1.0,{_T1[0]},{_T1[1]}) as b from seg join town using (city)), "
    "water as (select city, round(sum((b-a)*size),3) as water_m from cuts where a<b group by 1), before as (select city, count(*) as n_before from bldg group by 1) "
    "select city, n_before, n_after, area, water_m from before join kept using (city) join water using (city)"
)
def clipped_city_job(spark: SparkSession, d: str) -> DataFrame:
    """Buildings and water of all cities cut to their boundaries, with the counts before and after (K2)."""
    made = jobs.clipped_city(_footprints(spark, d), _lines_of(fixture(spark, d, "seg")), _towns(spark))
    area = made["buildings"].groupBy("city").agg(F.round(F.sum(C.area(F.col("geom"))), 3).alias("area"))
    size = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    water = made["water"].groupBy("city").agg(F.round(F.sum(size), 3).alias("water_m"))
    return made["counts"].join(area, "city").join(water, "city").select("city", "n_before", "n_after", "area", "water_m")


@query(
    f"{duck('bldg', 'seg')}, ids as (select bldg_id as osm_id, w*h as area, row_number() over (order by x0+w/2, y0+h/2, w*h, bldg_id) as bldg_id from bldg) "
    "select osm_id, bldg_id, area, (select count(*) from seg where fclass is not null) as n_water, 9000000.0 as boundary_area from ids"
)
def normalised_city_job(spark: SparkSession, d: str) -> DataFrame:
    """A city's raw layers normalised: repaired buildings with ids, its district's two halves dissolved, water lines that are there (K1)."""
    from dataclasses import replace

    halves = spark.range(3).select(F.when(F.col("id") < 2, " Town ").otherwise("Other").alias("district"), _rectangle(F.col("id") * 1500, F.lit(0), F.col("id") * 1500 + 1500, F.lit(3000)).alias("geom"))
    config = replace(CITIES["RTM"], city="T", boundary_column="district", boundary_value="Town")
    b = _footprints(spark, d).drop("city").withColumnRenamed("bldg_id", "osm_id").withColumn("geom_type", F.lit("Polygon"))
    water = _lines_of(fixture(spark, d, "seg").drop("city"))
    water = water.withColumn("geom", F.when(F.col("fclass").isNotNull(), F.col("geom"))).select("water_id", "seg", "geom", "geom_type")
    made = jobs.normalised_city(b, halves, water, config)
    around = made["boundary"].select("city", C.area(F.col("geom")).alias("boundary_area")).join(made["water"].groupBy("city").agg(F.count("*").alias("n_water")), "city")
    out = made["buildings"].select("city", "osm_id", "bldg_id", C.area(F.col("geom")).alias("area")).join(F.broadcast(around), "city")
    return out.select("osm_id", "bldg_id", "area", "n_water", "boundary_area")


_EXTENT_SQL = "town as (select city, min(x0)+2000.5 as bx0, min(y0)+2000.5 as by0, max(x0+w)-2000.5 as bx1, max(y0+h)-2000.5 as by1 from bldg group by 1)"
_CUT_SQL = (
    "select city, x1+(x2-x1)*a as x1, y1+(y2-y1)*a as y1, x1+(x2-x1)*b as x2, y1+(y2-y1)*b as y2 from "
    f"(select city, x1,y1,x2,y2, greatest(0.0,{_T0[0]},{_T0[1]}) as a, least(1.0,{_T1[0]},{_T1[1]}) as b from {{rows}} join town using (city)) where a<b"
)
_REFINED = ("hydrography", "coast", "osm_waterways", "osm_water_polygons")


@query(
    f"{duck('bldg', 'seg', 'coast')}, {_BEACH_SQL.replace('from customer)', 'from customer where c_custkey%3<>2)')}, {_EXTENT_SQL}, edge as ({_EDGES_SQL}), "
    "ways as (select * from seg where fclass in ('river','canal')), "
    "water as (select 'hydrography' as src, city,x1,y1,x2,y2 from seg union all select 'coast', 'C'||(water_id%3),x1,y1,x2,y2 from coast "
    f"union all select 'osm_waterways', * from ({_CUT_SQL.format(rows='ways')}) union all select 'osm_water_polygons', * from ({_CUT_SQL.format(rows='edge')})), "
    f"pairs as ({_PAIRS_SQL.replace('select city', 'select src, city').replace('join seg', 'join water')}), "
    f"dist as (select city, bldg_id, src, min(case when {HIT_SQL} then 0.0 else {RECT_SQL} end) as d from pairs group by 1,2,3) "
    "select city, bldg_id, " + ", ".join(f"round(max(case when src='{n}' then d end),4) as dist_to_{n}_m" for n in _REFINED) + ", round(min(d),4) as dist_to_water_m from dist group by 1,2"
)
def refined_exposure_job(spark: SparkSession, d: str) -> DataFrame:
    """The whole refined third job: also rivers, canals and the edges of water areas, cut to the buildings' extent (here made smaller
    by 2000.5 m, so that it cuts) (K7)."""
    seg = _lines_of(fixture(spark, d, "seg"))
    coast = _lines_of(fixture(spark, d, "coast")).withColumn("city", F.concat(F.lit("C"), F.col("water_id") % 3))
    k, x, y = F.col("c_custkey"), F.col("c_custkey") * 4049 % 20011, F.col("c_custkey") * 2953 % 20021
    kind = F.when(k % 3 == 0, "water").when(k % 3 == 1, "reservoir").otherwise("wood")
    areas = spark.read.parquet(f"{d}/customer.parquet").select(F.concat(F.lit("C"), F.col("c_nationkey") % 3).alias("city"), kind.alias("fclass"), _rectangle(x, y, x + 20 + k % 90, y + 30 + k % 70).alias("geom"))
    out = jobs.proximity_refined(_footprints(spark, d), seg, coast, seg, areas, extent_m=-2000.5)
    names = [f"dist_to_{n}_m" for n in (*_REFINED, "water")]
    return rounded(out.select("city", "bldg_id", *names), **{n: 4 for n in names})


_NATURAL_SQL = "areas as (select city, bldg_id, x0, 4000+(cast(y0 as bigint)%5000) as y0, w, h from bldg)"


@query(
    f"{duck('bldg')}, {_TOWN_SQL}, {_NATURAL_SQL}, met as (select city, bldg_id, greatest(x0,bx0-700) as xmin, least(x0+w,bx1+700) as xmax, y0, h from areas join town using (city)) "
    "select city, cast(bldg_id as string) as osm_id, round((xmax-xmin)*h,6) as area, round(xmin,6) as xmin, round(xmax,6) as xmax from met where xmin<xmax"
)
def coastal_areas_cut(spark: SparkSession, d: str) -> DataFrame:
    """Areas cut to their city's boundary grown by 700 m, away from its corners; a test samples those (K4, J3)."""
    b = fixture(spark, d, "bldg").withColumn("y0", 4000.0 + F.col("y0").cast("long") % 5000)
    areas = b.select("city", F.col("bldg_id").cast("string").alias("osm_id"), F.lit("beach").alias("fclass"), _rectangle(F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h")).alias("geom"))
    out = jobs.coastal_proxy(areas, _towns(spark), 700.0).select("city", "osm_id", C.area(F.col("geom")).alias("area"), C.bounds(F.col("geom")).alias("b"))
    return rounded(out.select("city", "osm_id", "area", "b.xmin", "b.xmax"), area=6, xmin=6, xmax=6)


@query(f"{duck('bldg')} select bldg_id, w*h/2 as area, 2 as n_parts from bldg")
def repaired_bow_ties(spark: SparkSession, d: str) -> DataFrame:
    """Footprints drawn with two corners swapped cross themselves; repaired, both halves are kept (C10)."""
    g = F.col("geom")[0][0]
    crossed = _footprints(spark, d).withColumn("geom", F.array(F.array(F.array(g[0], g[2], g[1], g[3], g[0]))))
    out = repaired(crossed.select("bldg_id", "geom"))
    return rounded(out.select("bldg_id", C.area(F.col("geom")).alias("area"), F.size("geom").alias("n_parts")), area=6)


@query(f"{duck('bldg')} select bldg_id, round(x0+w/2,6) as px, round(y0+h/2,6) as py from bldg")
def interior_points(spark: SparkSession, d: str) -> DataFrame:
    """A point that is surely inside each footprint (C4)."""
    out = with_interior_point(_footprints(spark, d)).select("bldg_id", F.col("interior.x").alias("px"), F.col("interior.y").alias("py"))
    return rounded(out, px=6, py=6)


@query(f"{duck('bldg')}, parts as (select bldg_id, part from bldg cross join (values (0),(1)) p(part)) select bldg_id, part, seg, x0+50*part+(case when seg in (1,2) then w else 0 end) as x1, y0+(case when seg in (2,3) then h else 0 end) as y1, x0+50*part+(case when seg in (0,1) then w else 0 end) as x2, y0+(case when seg in (1,2) then h else 0 end) as y2 from parts join bldg using (bldg_id) cross join (values (0),(1),(2),(3)) s(seg)")
def multi_part_segments(spark: SparkSession, d: str) -> DataFrame:
    """Sides of geometries of two parts, numbered within each (C7)."""
    g = F.col("geom")
    two = _footprints(spark, d).withColumn("geom", F.concat(g, F.transform(g, lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: F.struct((p["x"] + 50).alias("x"), p["y"].alias("y")))))))
    return spatial.to_segments(two, "bldg_id").select("bldg_id", F.col("part").cast("int"), F.col("seg").cast("int"), "x1", "y1", "x2", "y2")


@query(f"{duck('bldg')}, typed as (select bldg_id, case bldg_id%5 when 0 then 'Point' when 1 then 'LineString' when 2 then 'MultiPolygon' else 'Polygon' end as geom_type, bldg_id%7=0 as missing, bldg_id%7=1 as empty from bldg) select bldg_id, geom_type from typed where geom_type in ('Polygon','MultiPolygon') and not missing and not empty")
def polygons_that_are_there(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a geometry type, null and empty geometries dropped (F5, F6)."""
    k = F.col("bldg_id")
    kind = F.when(k % 5 == 0, "Point").when(k % 5 == 1, "LineString").when(k % 5 == 2, "MultiPolygon").otherwise("Polygon")
    geom = F.when(k % 7 == 1, F.array().cast(C.GEOMETRY)).when(k % 7 != 0, F.col("geom"))
    layer = _footprints(spark, d).withColumns({"geom_type": kind, "geom": geom})
    return normalize.without_empty(normalize.of_types(layer, normalize.POLYGONS)).select("bldg_id", "geom_type")


@query(f"{duck('bldg', 'seg')}, pairs as ({_PAIRS_SQL.replace('select city', "select coalesce(fclass in ('river','canal'),false) as main, city")}) select city, bldg_id, round(min(case when main then d end),4) as dist_to_main_m, round(min(case when not main then d end),4) as dist_to_other_m, case when count(distinct main)=2 then round(min(d),4) end as dist_to_water_m from (select *, case when {HIT_SQL} then 0.0 else {RECT_SQL} end as d from pairs) group by 1,2")
def proximity_job(spark: SparkSession, d: str) -> DataFrame:
    """The whole third job on two layers, rivers and canals as one and the others as the second; the least of both (K6)."""
    p = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    water = fixture(spark, d, "seg").withColumn("geom", F.array(F.array(F.array(p("x1", "y1"), p("x2", "y2")))))
    main = F.coalesce(F.col("fclass").isin("river", "canal"), F.lit(False))
    out = jobs.proximity(_footprints(spark, d), {"main": water.where(main), "other": water.where(~main)})
    names = ("dist_to_main_m", "dist_to_other_m", "dist_to_water_m")
    return rounded(out.select("city", "bldg_id", *names), **{n: 4 for n in names})
