"""Queries: pixel series (A9), bulk point lookup (J5), JSON bodies (A10)."""

from __future__ import annotations



from ..operators import derive, serving
from ..session import shared_dir
from ..sources import fixtures as fx
from ..sources import store
from .catalog import register
from .oracle_pet import align_sql, deaccumulate_sql, pet_cte_sql, pet_select_sql
from .q_grid import _cell_sql, _unit_sql
from .sqltext import d, with_fixtures


@register("A9_series_pack", with_fixtures(["x1"], """
SELECT run, param, CAST(floor(iy / 100) AS INTEGER) AS cy, CAST(floor(ix / 100) AS INTEGER) AS cx, iy, ix,
  list(step ORDER BY step) AS steps, list(CAST(value AS FLOAT) ORDER BY step) AS vals
FROM x1 GROUP BY run, param, iy, ix"""))
def a9_series_pack(spark, sf):
    return serving.series_pack(fx.x1_field(spark, sf))


def _served_field(spark, sf):
    """X1 plus the PET product derived from it, as one field."""
    x1 = fx.x1_field(spark, sf)
    return x1.unionByName(derive.pet_as_field(derive.pet_pm(x1)))


def _j5(spark, sf):
    return serving.point_lookup(serving.series_pack(_served_field(spark, sf)), fx.x3b_requests(spark, sf))


_IY, _IX = _cell_sql("lat", "lon")
_J5_SQL = pet_cte_sql("x1") + f""",
fld AS (SELECT * FROM x1 UNION ALL SELECT run, 'pet_pm' AS param, step, iy, ix, CAST(pet_pm AS DOUBLE) AS value FROM pet),
rq AS (SELECT req_id, lat, lon, param, run, {_IY} AS iy, {_IX} AS ix FROM x3b),
j5 AS (SELECT rq.req_id, rq.lat, rq.lon, rq.param, rq.run,
  CAST(row_number() OVER (PARTITION BY rq.req_id ORDER BY f.step) - 1 AS INTEGER) AS step_index,
  f.step, CAST(f.value AS FLOAT) AS value, {_unit_sql('rq.param')} AS unit
  FROM rq JOIN fld f ON f.run = rq.run AND f.param = rq.param AND f.iy = rq.iy AND f.ix = rq.ix)"""


@register("J5_point_lookup", with_fixtures(["x1", "x3b"], _J5_SQL + "\nSELECT * FROM j5"))
def j5_point_lookup(spark, sf):
    return _j5(spark, sf)


def _fmt(x: str, scale: int) -> str:
    return (f"CASE WHEN isfinite({x}) THEN regexp_replace(CAST(CAST({x} AS DECIMAL(38,{scale})) AS VARCHAR), "
            f"'\\.?0+$', '') ELSE 'null' END")


def _r4(x: str) -> str:
    return f"(CASE WHEN isfinite({x}) THEN floor({x} * {d(10000)} + {d(0.5)}) / {d(10000)} ELSE {x} END)"


def _head(members: bool) -> str:
    m = " || ',\"members\":' || CAST(max(nm) AS VARCHAR)" if members else ""
    lat, lon = (f"regexp_replace(CAST({c} AS VARCHAR), '\\.0$', '')" for c in ("lat", "lon"))
    return ("'{\"lat\":' || " + lat + " || ',\"lon\":' || " + lon
            + " || ',\"param\":\"' || param || '\",\"run\":\"' || run || '\",\"unit\":\"' || unit || '\"'" + m)


@register("A10_point_series_json", with_fixtures(["x1", "x3b"], _J5_SQL + f"""
SELECT req_id, CAST(count(*) AS INTEGER) AS n_steps,
  {_head(False)} || ',"values":{{' || string_agg('"' || CAST(step_index AS VARCHAR) || '":' || {_fmt(_r4('CAST(value AS DOUBLE)'), 4)}, ',' ORDER BY step_index) || '}}}}' AS body
FROM j5 GROUP BY req_id, lat, lon, param, run, unit"""))
def a10_point_series_json(spark, sf):
    return serving.point_series_json(_j5(spark, sf))


@register("A10_point_series_json_eps", with_fixtures(["x7", "x3b"], f"""
rq AS (SELECT req_id, lat, lon, param, run, {_IY} AS iy, {_IX} AS ix FROM x3b),
j AS (SELECT rq.req_id, rq.lat, rq.lon, rq.param, rq.run, s.member,
  CAST(row_number() OVER (PARTITION BY rq.req_id, s.member ORDER BY s.step) - 1 AS INTEGER) AS step_index,
  CAST(s.value AS FLOAT) AS value, {_unit_sql('rq.param')} AS unit
  FROM rq JOIN x7 s ON s.run = rq.run AND s.param = rq.param AND s.iy = rq.iy AND s.ix = rq.ix),
ps AS (SELECT req_id, lat, lon, param, run, unit, step_index, count(DISTINCT member) AS nm,
  '[' || string_agg({_fmt(_r4('CAST(value AS DOUBLE)'), 4)}, ',' ORDER BY member) || ']' AS t
  FROM j GROUP BY req_id, lat, lon, param, run, unit, step_index)
SELECT req_id, CAST(count(*) AS INTEGER) AS n_steps,
  {_head(True)} || ',"values":{{' || string_agg('"' || CAST(step_index AS VARCHAR) || '":' || t, ',' ORDER BY step_index) || '}}}}' AS body
FROM ps GROUP BY req_id, lat, lon, param, run, unit"""))
def a10_point_series_json_eps(spark, sf):
    pts = serving.point_lookup(serving.series_pack(fx.x7_ensemble(spark, sf)), fx.x3b_requests(spark, sf))
    return serving.point_series_json(pts, ensemble=True)




@register("W1_deaccumulate_series", with_fixtures(["x1"], """
xf AS (SELECT run, param, step, iy, ix, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM x1),
""" + deaccumulate_sql("xf", "w1") + """
SELECT run, param, CAST(floor(iy / 100) AS INTEGER) AS cy, CAST(floor(ix / 100) AS INTEGER) AS cx, iy, ix,
  list(step ORDER BY step) AS steps, list(CAST(value AS FLOAT) ORDER BY step) AS vals
FROM w1 GROUP BY run, param, iy, ix"""))
def w1_deaccumulate_series(spark, sf):
    return serving.deaccumulate_series(serving.series_pack(fx.x1_field(spark, sf)))


@register("J5_point_lookup_stored", with_fixtures(["x1", "x3b"], _J5_SQL + "\nSELECT * FROM j5"))
def j5_point_lookup_stored(spark, sf):
    """J5 against the published series store: the broadcast request table
    drives dynamic pruning of ``cy`` partitions."""
    import uuid
    root = shared_dir(spark, f"series-{uuid.uuid4().hex}")
    store.series_publish(serving.series_pack(_served_field(spark, sf)), root)
    return serving.point_lookup(store.series_scan(spark, root), fx.x3b_requests(spark, sf))


_PET_SERIES_SQL = with_fixtures(["x1"], """
xf AS (SELECT run, param, step, iy, ix, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM x1),
""" + deaccumulate_sql("xf", "w1d") + """,
w1 AS (SELECT run, param, step, iy, ix, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM w1d),
""" + align_sql("w1", "al") + ",\n" + pet_select_sql("al").replace(
    "\nSELECT run, step, iy, ix, CAST(", ",\npet AS (SELECT run, step, iy, ix, CAST(") + """)
SELECT run, CAST(floor(iy / 100) AS INTEGER) AS cy, CAST(floor(ix / 100) AS INTEGER) AS cx, iy, ix,
  list(step ORDER BY step) AS steps, list(pet_pm ORDER BY step) AS pet_pm FROM pet GROUP BY run, iy, ix""")


@register("D1_pet_pm_series", _PET_SERIES_SQL)
def d1_pet_pm_series(spark, sf):
    return derive.pet_pm_series(serving.series_pack(fx.x1_field(spark, sf)))
