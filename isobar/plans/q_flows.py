"""Queries: the composed flows (ingest, derive PET, answer points, finalize)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import grid
from ..operators import derive, serving
from ..session import shared_dir
from ..sources import fixtures as fx
from ..sources import store
from . import jobs
from .catalog import register
from .oracle_pet import pet_cte_sql
from .q_grid import _cell_sql, _unit_sql
from .q_remap import _weights, j1_sql
from .q_serving import _fmt, _head, _r4, _served_field
from .sqltext import with_fixtures

ZERO_GRID = (2, 3)


def _scratch(spark, name: str) -> str:
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex}")


# Step 2 has tiny payloads (zero fields), step 84 only error replies.
@register("flow_ingest", with_fixtures(["x5", "x5_native"], "nat0 AS (SELECT * FROM x5_native WHERE step NOT IN (2, 84)),\n"
                                       + j1_sql("nat0") + f""",
z AS (SELECT DISTINCT run, param, step FROM x5_native WHERE step = 2)
SELECT run, param, step, CAST(floor(dst_id / {grid.GRID_NX}) AS INTEGER) AS iy, CAST(dst_id % {grid.GRID_NX} AS INTEGER) AS ix, value FROM j1
UNION ALL SELECT z.run, z.param, z.step, CAST(y.y AS INTEGER), CAST(x.x AS INTEGER), CAST(0 AS FLOAT)
FROM z, range(0, {ZERO_GRID[0]}) y(y), range(0, {ZERO_GRID[1]}) x(x)"""))
def flow_ingest(spark, sf):
    native = fx.x5_native(spark, sf)
    step = F.col("step")
    listing = native.select("run", "param", "step").distinct().select(
        "run", "param", "step", F.when(step == 2, 300).otherwise(50000).cast("long").alias("n_bytes"),
        F.when(step == 84, 404).otherwise(200).alias("status"))
    root = _scratch(spark, "ingest")
    marks = jobs.ingest(native, _weights(spark, sf), listing, root, zero_grid=ZERO_GRID)
    # markers are appended once the field is published; both are read back here
    ready = marks.select("run", "param")
    return store.field_scan(spark, root).join(ready, ["run", "param"], "left_semi")


# The run asked for is not promoted and redirects to the one before.
@register("flow_derive_pet", with_fixtures(["x1"], """
xf AS (SELECT run, param, step, iy, ix, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM x1),
""" + pet_cte_sql("xf") + """
SELECT run, 'pet_pm' AS param, step, iy, ix, CAST(pet_pm AS FLOAT) AS value FROM pet WHERE run = '2026040306'"""))
def flow_derive_pet(spark, sf):
    root = _scratch(spark, "pet")
    store.field_publish(fx.x1_field(spark, sf), root)
    done = jobs.derive_pet(spark, root, fx.x4_lifecycle_markers(spark, sf), run="2026040312").first()
    return store.field_scan(spark, root, run=done["run"], params=[done["param"]])


_LIST = ("t_2m", "ps", "pet_pm")
_IN = ", ".join(f"'{p}'" for p in _LIST)
_IY, _IX = _cell_sql("lat", "lon")


def _err(text: str) -> str:
    return f"""'{{"error":"' || {text} || '"}}'"""


def _body(values: str, src: str, members: bool) -> str:
    return f"""SELECT req_id, 200 AS status, {_head(members)} || ',"values":{{' ||
  string_agg('"' || CAST(step_index AS VARCHAR) || '":' || {values}, ',' ORDER BY step_index) || '}}}}' AS body
  FROM {src} GROUP BY req_id, lat, lon, param, run, unit"""


@register("flow_answer_points", with_fixtures(["x1", "x7", "x3b", "x4l"], pet_cte_sql("x1") + f""",
fld AS (SELECT * FROM x1 UNION ALL SELECT run, 'pet_pm' AS param, step, iy, ix, CAST(pet_pm AS DOUBLE) AS value FROM pet),
ok AS (SELECT DISTINCT run, param FROM x4l WHERE marker = '_SUCCESS' UNION SELECT DISTINCT run, 'pet_pm' FROM x1),
v AS (SELECT req_id, lat, lon, param, coalesce(ensemble = 'true', false) AS ens, run AS asked,
  coalesce(run, (SELECT run FROM x4l WHERE marker = '_LATEST_RUN' ORDER BY ts DESC, run DESC LIMIT 1)) AS run,
  CASE WHEN param IS NULL THEN 'Missing required parameters: lat, lon, param'
    WHEN param NOT IN ({_IN}) THEN 'param must be one of: {", ".join(_LIST)}'
    WHEN run IS NOT NULL AND NOT regexp_matches(run, '^[0-9]{{10}}$') THEN 'run must be in YYYYMMDDHH format (10 digits)' END AS bad
  FROM x3b),
g AS (SELECT v.*, bad IS NULL AND asked IS NOT NULL AND ok.run IS NULL AS absent, {_IY} AS iy, {_IX} AS ix
  FROM v LEFT JOIN ok ON ok.run = v.asked AND ok.param = v.param),
served AS (SELECT * FROM g WHERE bad IS NULL AND NOT absent),
p AS (SELECT q.req_id, q.lat, q.lon, q.param, q.run,
  row_number() OVER (PARTITION BY q.req_id ORDER BY f.step) - 1 AS step_index, CAST(f.value AS FLOAT) AS value, {_unit_sql('q.param')} AS unit
  FROM served q JOIN fld f ON f.run = q.run AND f.param = q.param AND f.iy = q.iy AND f.ix = q.ix WHERE NOT q.ens),
m AS (SELECT q.req_id, q.lat, q.lon, q.param, q.run, f.member,
  row_number() OVER (PARTITION BY q.req_id, f.member ORDER BY f.step) - 1 AS step_index, CAST(f.value AS FLOAT) AS value, {_unit_sql('q.param')} AS unit
  FROM served q JOIN x7 f ON f.run = q.run AND f.param = q.param AND f.iy = q.iy AND f.ix = q.ix WHERE q.ens),
ms AS (SELECT req_id, lat, lon, param, run, unit, step_index, count(DISTINCT member) AS nm,
  '[' || string_agg({_fmt(_r4('CAST(value AS DOUBLE)'), 4)}, ',' ORDER BY member) || ']' AS t
  FROM m GROUP BY req_id, lat, lon, param, run, unit, step_index),
found AS ({_body(_fmt(_r4('CAST(value AS DOUBLE)'), 4), 'p', False)}
  UNION ALL {_body('t', 'ms', True)})
SELECT * FROM found
UNION ALL SELECT req_id, 400, {_err('bad')} FROM g WHERE bad IS NOT NULL
UNION ALL SELECT req_id, 404, {_err("'Run ' || asked || ' not found or not yet promoted for ' || param")} FROM g WHERE absent
UNION ALL SELECT req_id, 500, {_err("'Failed to retrieve data: no series of ' || param || ' in run ' || run")} FROM served
  WHERE req_id NOT IN (SELECT req_id FROM found)"""))
def flow_answer_points(spark, sf):
    mk = fx.x4_lifecycle_markers(spark, sf)
    pet = fx.x1_field(spark, sf).select("run").distinct().select(
        "run", F.lit("pet_pm").alias("param"), F.lit("_SUCCESS").alias("marker"), F.lit(None).cast("string").alias("payload"),
        F.lit(None).cast("timestamp_ntz").alias("ts"))
    markers = mk.withColumn("ts", F.col("ts").cast("timestamp_ntz")).unionByName(pet)
    return jobs.answer_points(fx.x3b_requests(spark, sf), serving.series_pack(_served_field(spark, sf)), markers, _LIST,
                              ensemble_series=serving.series_pack(fx.x7_ensemble(spark, sf)))


_RUN = "2026040300"
_PETS = "(VALUES " + ", ".join(f"('{p}')" for p in derive.PET_INPUTS) + ") pp(param)"


# One row per thing that finalizing the run does, read from the flow's outputs.
@register("flow_finalize", with_fixtures(["x1", "x2", "x4"], f"""
r AS (SELECT run FROM x2 UNION SELECT run FROM x1),
k AS (SELECT run FROM (SELECT run, row_number() OVER (ORDER BY run DESC) AS rn FROM r) WHERE rn <= 2 OR run = '{_RUN}')
SELECT 'check' AS what, '{_RUN}' AS run, c.name || ' ' || pp.param AS detail FROM (VALUES ('success_marker'), ('nonempty'), ('smoke_sample')) c(name), {_PETS}
UNION ALL SELECT 'promoted', '{_RUN}', '_PROMOTED'
UNION ALL SELECT 'index', '{_RUN}', '{len(derive.PET_INPUTS)}'
UNION ALL SELECT 'latest', '{_RUN}', '{_RUN}'
UNION ALL SELECT 'keep', run, CAST(NULL AS VARCHAR) FROM k
UNION ALL SELECT DISTINCT 'orphan', run, CAST(NULL AS VARCHAR) FROM x2 WHERE run NOT IN (SELECT run FROM k)"""))
def flow_finalize(spark, sf):
    x1, x2 = fx.x1_field(spark, sf), fx.x2_listing(spark, sf).select("run").distinct()
    runs = x2.unionByName(x1.select("run").distinct())
    out = jobs.validate_and_finalize(x1, fx.x4_markers(spark, sf), _RUN, derive.PET_INPUTS, runs, staging=x2, keep=2)
    none = F.lit(None).cast("string")

    def rows(what, df, detail):
        return df.select(F.lit(what).alias("what"), "run", detail.alias("detail"))
    parts = [rows("check", out["checks"].where("ok"), F.concat_ws(" ", "check", "param")),
             rows("promoted", out["promoted"], F.col("marker")), rows("index", out["index"], F.col("n_params").cast("string")),
             rows("latest", out["latest"], F.col("payload")), rows("keep", out["retention"].where("keep"), none),
             rows("orphan", out["orphans"], none)]
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result
