"""Queries: inventory (S1, S2), grid and point operators (P1-P13), steps."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import grid
from ..functions.physics import UNIT_CONVERSIONS
from ..operators import derive, grid_ops, requests, temporal
from ..sources import fixtures as fx
from ..sources import inventory
from .catalog import register
from .sqltext import d, with_fixtures

DEG = math.pi / 180.0

_STEPS_SQL = ("list_concat(range(0, 79), range(81, CASE WHEN substr(run, 9, 2) IN ('06', '18') "
              "THEN 121 ELSE 181 END, 3))")


@register("S1_expected_steps", with_fixtures(["x1"], f"""
SELECT run, CAST(step AS INTEGER) AS step FROM (SELECT run, unnest({_STEPS_SQL}) AS step
  FROM (SELECT DISTINCT run FROM x1))"""))
def s1_expected_steps(spark, sf):
    return inventory.with_expected_steps(fx.x1_field(spark, sf).select("run").distinct())


def _file_sql(member: bool, model: str) -> str:
    prefix = "icon_global" if model == "icon" else model.replace("-", "_")
    mem = " || '_' || lpad(CAST(member + 1 AS VARCHAR), 3, '0')" if member else ""
    return (f"'{model}/grib/' || substr(run, 9, 2) || '/' || param || '/{prefix}_icosahedral_single-level_' "
            f"|| run || '_' || lpad(CAST(step AS VARCHAR), 3, '0'){mem} || '_' || upper(param) || '.grib2.bz2'")


@register("S2_expected_inventory", with_fixtures(["x1"], f"""
e AS (SELECT run, param, CAST(unnest({_STEPS_SQL}) AS INTEGER) AS step
  FROM (SELECT DISTINCT run, param FROM x1))
SELECT run, param, step, {_file_sql(False, 'icon')} AS file FROM e"""))
def s2_expected_inventory(spark, sf):
    return inventory.expected_inventory(fx.x1_field(spark, sf).select("run", "param").distinct())


@register("S2_expected_inventory_eps", with_fixtures(["x7"], f"""
e AS (SELECT run, param, CAST(unnest({_STEPS_SQL}) AS INTEGER) AS step
  FROM (SELECT DISTINCT run, param FROM x7)),
m AS (SELECT run, param, CAST(unnest(range(0, 40)) AS INTEGER) AS member, step FROM e)
SELECT run, param, member, step, {_file_sql(True, 'icon-eps')} AS file FROM m"""))
def s2_expected_inventory_eps(spark, sf):
    pairs = fx.x7_ensemble(spark, sf).select("run", "param").distinct()
    return inventory.expected_inventory(pairs, model="icon-eps")


def _cell_sql(lat: str, lon: str) -> tuple[str, str]:
    iy = f"CAST(least(greatest(floor(({d(90)} - {lat}) / {d(0.125)} + {d(0.5)}), 0), 1440) AS INTEGER)"
    nlon = f"(CASE WHEN {lon} > {d(180)} THEN {lon} - {d(360)} ELSE {lon} END)"
    ix = f"CAST(least(greatest(floor(({nlon} - {d(-180)}) / {d(0.125)} + {d(0.5)}), 0), 2878) AS INTEGER)"
    return iy, ix


_IY, _IX = _cell_sql("lat", "lon")


# The raw frame runs south to north, from its own coordinates: row jy of a
# grid that starts at -90 and, for odd jy, a hair off the cell centre.
@register("P1_normalize_field", with_fixtures(["x1"], f"""
raw AS (SELECT run, param, step, value, {d(-90)} + CAST(iy AS DOUBLE) * {d(0.125)} + CAST(iy % 2 AS DOUBLE) * {d(0.03)} AS lat,
  {d(-180)} + CAST(ix AS DOUBLE) * {d(0.125)} AS lon FROM x1)
SELECT run, param, step, {_IY} AS iy, {_IX} AS ix, value FROM raw"""))
def p1_normalize_field(spark, sf):
    x1 = fx.x1_field(spark, sf)
    iy, ix = F.col("iy"), F.col("ix")
    raw = x1.select("run", "param", "step",
                    (F.lit(-90.0) + iy.cast("double") * 0.125 + (iy % 2).cast("double") * 0.03).alias("lat"),
                    (F.lit(-180.0) + ix.cast("double") * 0.125).alias("lon"), F.col("value").alias("DATA"),
                    F.col("step").alias("time_bnds"))
    return derive.normalize_field(raw)


_LEVEL_SQL = f"CASE WHEN param IN ('u_10m', 'v_10m') THEN {d(10)} ELSE {d(2)} END"


# Levels are heights in metres; the upper one of each param carries other values.
@register("P2_squeeze_level", with_fixtures(["x1"], f"""
l AS (SELECT *, {_LEVEL_SQL} AS height FROM x1
  UNION ALL SELECT run, param, step, iy, ix, value + {d(1)}, {_LEVEL_SQL} + {d(8)} FROM x1),
f AS (SELECT run, param, min(height) AS h FROM l GROUP BY run, param)
SELECT l.run, l.param, l.step, l.iy, l.ix, l.value FROM l JOIN f ON l.run = f.run AND l.param = f.param AND l.height = f.h"""))
def p2_squeeze_level(spark, sf):
    low = F.when(F.col("param").isin("u_10m", "v_10m"), F.lit(10.0)).otherwise(F.lit(2.0))
    x1 = fx.x1_field(spark, sf).withColumn("height", low)
    return derive.squeeze_level(x1.unionByName(x1.withColumn("height", low + 8).withColumn("value", F.col("value") + 1.0)))


@register("P3_point_to_cell", with_fixtures(["x3"], f"""
c AS (SELECT req_id, lat, lon, {_IY} AS iy, {_IX} AS ix FROM x3)
SELECT req_id, lat, lon, iy, ix, CAST(floor(iy / 100) AS INTEGER) AS cy, CAST(floor(ix / 100) AS INTEGER) AS cx,
  CAST(iy % 100 AS INTEGER) AS ly, CAST(ix % 100 AS INTEGER) AS lx FROM c"""))
def p3_point_to_cell(spark, sf):
    return grid_ops.point_to_cell(fx.x3_requests(spark, sf).select("req_id", "lat", "lon"))


@register("P4_cell_to_point", with_fixtures(["x1"], f"""
SELECT *, {d(90)} - CAST(iy AS DOUBLE) * {d(0.125)} AS lat, {d(-180)} + CAST(ix AS DOUBLE) * {d(0.125)} AS lon FROM x1"""))
def p4_cell_to_point(spark, sf):
    return grid_ops.cell_to_point(fx.x1_field(spark, sf))


@register("P5_valid_time", with_fixtures(["x1"], """
SELECT *, CAST(strptime(run, '%Y%m%d%H') AS TIMESTAMP) + to_hours(step) AS valid_time FROM x1"""))
def p5_valid_time(spark, sf):
    return grid_ops.valid_time(fx.x1_field(spark, sf))


def _conv_sql() -> str:
    sc = " ".join(f"WHEN '{p}' THEN {d(s)}" for p, (s, o) in UNIT_CONVERSIONS.items())
    of = " ".join(f"WHEN '{p}' THEN {d(o)}" for p, (s, o) in UNIT_CONVERSIONS.items())
    return f"value * (CASE param {sc} END) + (CASE param {of} END)"


@register("P6_convert_units", with_fixtures(["x1"], f"""
SELECT run, param, step, iy, ix, CASE WHEN param IN ({', '.join(repr(p) for p in UNIT_CONVERSIONS)})
  THEN {_conv_sql()} ELSE value END AS value FROM x1"""))
def p6_convert_units(spark, sf):
    return derive.convert_units(fx.x1_field(spark, sf))


@register("P7_round4", with_fixtures(["x1n"], f"""
SELECT run, param, step, iy, ix, CASE WHEN isfinite(value) THEN floor(value * {d(10000)} + {d(0.5)}) / {d(10000)}
  ELSE value END AS value FROM x1n"""))
def p7_round4(spark, sf):
    return fx.x1_field(spark, sf, with_nan=True).withColumn("value", grid_ops.round4("value"))


def _unit_sql(col: str = "param") -> str:
    w = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in grid_ops.PARAM_UNITS.items())
    return f"CASE {col} {w} ELSE 'unknown' END"


@register("P8_with_unit", with_fixtures(["x1"], f"SELECT *, {_unit_sql()} AS unit FROM x1"))
def p8_with_unit(spark, sf):
    return grid_ops.with_unit(fx.x1_field(spark, sf))


def _p9_sql(src: str) -> str:
    wl = ", ".join(f"'{p}'" for p in requests.API_PARAMS)
    return f"""
SELECT req_id, lat, lon, param, coalesce(ensemble = 'true', false) AS ensemble,
  CASE WHEN run IS NOT NULL AND run <> '' THEN run END AS run,
  CASE WHEN lat IS NULL OR lon IS NULL OR param IS NULL OR param = '' THEN 'Missing required parameters: lat, lon, param'
       WHEN isnan(lat) OR lat < {d(-90)} OR lat > {d(90)} THEN 'lat must be a number in [-90, 90]'
       WHEN isnan(lon) OR lon < {d(-180)} OR lon > {d(360)} THEN 'lon must be a number in [-180, 360]'
       WHEN param NOT IN ({wl}) THEN 'param must be one of: {", ".join(requests.API_PARAMS)}'
       WHEN run IS NOT NULL AND run <> '' AND NOT regexp_matches(run, '^[0-9]{{10}}$')
         THEN 'run must be in YYYYMMDDHH format (10 digits)'
  END AS error FROM {src}"""


@register("P9_validate_requests", with_fixtures(["x3"], _p9_sql("x3")))
def p9_validate_requests(spark, sf):
    return requests.request_errors(fx.x3_requests(spark, sf))


BOX = (88.6, -179.9, 89.9, -179.4)  # south, west, north, east


@register("P11_bbox_slice", with_fixtures(["x1"], f"""
SELECT * FROM x1 WHERE iy BETWEEN {_cell_sql(d(BOX[2]), d(BOX[1]))[0]} AND {_cell_sql(d(BOX[0]), d(BOX[3]))[0]}
  AND ix BETWEEN {_cell_sql(d(BOX[2]), d(BOX[1]))[1]} AND {_cell_sql(d(BOX[0]), d(BOX[3]))[1]}"""))
def p11_bbox_slice(spark, sf):
    return grid_ops.bbox_slice(fx.x1_field(spark, sf), *BOX)


def _boxes(spark, sf):
    k = F.col("req_id")
    return fx.x3_requests(spark, sf).select(
        "req_id", (F.col("lat") - (k % 40).cast("double")).alias("south"),
        (F.col("lon") - (k % 60).cast("double")).alias("west"),
        F.col("lat").alias("north"), F.col("lon").alias("east"))


_BOX_SQL = """bx AS (SELECT req_id, lat - CAST(req_id % 40 AS DOUBLE) AS south, lon - CAST(req_id % 60 AS DOUBLE) AS west,
  lat AS north, lon AS east FROM x3)"""


@register("P12_bbox_guard", with_fixtures(["x3"], _BOX_SQL + f""",
bi AS (SELECT *, {_cell_sql('north', 'west')[0]} AS iy0, {_cell_sql('south', 'east')[0]} AS iy1,
  {_cell_sql('north', 'west')[1]} AS ix0, {_cell_sql('south', 'east')[1]} AS ix1 FROM bx)
SELECT req_id, south, west, north, east, CAST((iy1 - iy0 + 1) * (ix1 - ix0 + 1) AS BIGINT) AS pixels,
  floor({d(grid_ops.EARTH_RADIUS_KM ** 2)} * ((east - west) * {d(DEG)}) * (sin(north * {d(DEG)}) - sin(south * {d(DEG)}))
    * {d(1000)} + {d(0.5)}) / {d(1000)} AS area_km2,
  (iy1 - iy0 + 1) * (ix1 - ix0 + 1) <= 50000 AS ok FROM bi"""))
def p12_bbox_guard(spark, sf):
    return grid_ops.bbox_guard(_boxes(spark, sf))


@register("P13_precip_mask", with_fixtures(["x1n"], "SELECT * FROM x1n WHERE NOT isnan(value) AND value <> 0"))
def p13_precip_mask(spark, sf):
    return grid_ops.precip_mask(fx.x1_field(spark, sf, with_nan=True))


@register("W2_interpolate_steps", with_fixtures(["x1"], f"""
nx AS (SELECT *, lead(step) OVER w AS nt, lead(value) OVER w AS nv FROM x1
  WINDOW w AS (PARTITION BY run, param, iy, ix ORDER BY step)),
e AS (SELECT *, unnest(range(step, greatest(coalesce(nt - 1, step), step) + 1)) AS h FROM nx)
SELECT run, param, CAST(h AS INTEGER) AS step, iy, ix,
  CASE WHEN h = step THEN value ELSE value + (nv - value) * (CAST(h - step AS DOUBLE) / CAST(nt - step AS DOUBLE)) END AS value
FROM e"""))
def w2_interpolate_steps(spark, sf):
    return temporal.interpolate_steps(fx.x1_field(spark, sf))


@register("T1_sort_steps", with_fixtures(["x1"], """
SELECT run, param, list_sort(list(DISTINCT step)) AS steps FROM x1 GROUP BY run, param"""))
def t1_sort_steps(spark, sf):
    return temporal.step_axis(fx.x1_field(spark, sf))


@register("U1_concat_steps", with_fixtures(["x1"], "SELECT * FROM x1"))
def u1_concat_steps(spark, sf):
    x1 = fx.x1_field(spark, sf)
    hourly = x1.where(F.col("step") <= 78)
    three_hourly = x1.where(F.col("step") > 78).select("value", "ix", "iy", "step", "param", "run")
    return temporal.concat_steps(hourly, three_hourly)


@register("U2_concat_members", with_fixtures(["x7"], "SELECT * FROM x7"))
def u2_concat_members(spark, sf):
    x7 = fx.x7_ensemble(spark, sf)
    # files name members from 001; one scan reads them all
    named = x7.withColumn("file_member", F.format_string("%03d", F.col("member") + 1)).drop("member")
    return temporal.members_from(named, "file_member").select(*x7.columns)


def _small_boxes(spark, sf):
    """Boxes near X1's cells (from X3b requests): up to 0.5 x 0.75 degrees, and
    one in fifty of 40 x 120 degrees, which is too large."""
    k = F.col("req_id")
    big = F.when(k % 50 == 0, 1.0).otherwise(0.0)
    return fx.x3b_requests(spark, sf).select(
        F.col("req_id").alias("box_id"), (F.col("lat") - (k % 5).cast("double") * 0.125 - big * 40).alias("south"),
        F.col("lon").alias("west"), F.col("lat").alias("north"),
        (F.col("lon") + (k % 7).cast("double") * 0.125 + big * 120).alias("east"))


_BIG = f"CASE WHEN req_id % 50 = 0 THEN {d(1)} ELSE {d(0)} END"
_SMALL_BOX_SQL = f"""bx AS (SELECT req_id AS box_id,
  lat - CAST(req_id % 5 AS DOUBLE) * {d(0.125)} - ({_BIG}) * {d(40)} AS south, lon AS west,
  lat AS north, lon + CAST(req_id % 7 AS DOUBLE) * {d(0.125)} + ({_BIG}) * {d(120)} AS east FROM x3b),
ba AS (SELECT box_id, {_cell_sql('north', 'west')[0]} AS iy0, {_cell_sql('south', 'east')[0]} AS iy1,
  {_cell_sql('north', 'west')[1]} AS ix0, {_cell_sql('south', 'east')[1]} AS ix1 FROM bx),
bi AS (SELECT *, CAST((iy1 - iy0 + 1) * (ix1 - ix0 + 1) AS BIGINT) AS px FROM ba)"""


@register("P11_bbox_slice_many", with_fixtures(["x1", "x3b"], _SMALL_BOX_SQL + """
SELECT x1.*, bi.box_id, CAST(NULL AS VARCHAR) AS error FROM x1
  JOIN bi ON x1.iy BETWEEN bi.iy0 AND bi.iy1 AND x1.ix BETWEEN bi.ix0 AND bi.ix1 WHERE bi.px <= 50000
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, box_id, 'Selected area is too large (' || px || ' pixels)' FROM bi WHERE px > 50000"""))
def p11_bbox_slice_many(spark, sf):
    return grid_ops.bbox_slice_many(fx.x1_field(spark, sf), _small_boxes(spark, sf))
