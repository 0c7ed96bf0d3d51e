"""Queries: run lifecycle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import grid
from ..operators import derive, lifecycle, quality
from ..sources import fixtures as fx
from .catalog import register
from .sqltext import d, with_fixtures

_RUN_TS = "CAST(strptime(run, '%Y%m%d%H') AS TIMESTAMP)"


def _shifted_requests(spark, sf):
    """Requested runs: every listed run moved one cycle later, and malformed
    ones (its first eight digits; a month 13)."""
    runs = fx.x2_listing(spark, sf).select("run").distinct()
    later = runs.select(F.date_format(grid.run_init_time("run") + F.expr("INTERVAL 6 HOURS"), "yyyyMMddHH").alias("run"))
    short = runs.select(F.substring("run", 1, 8).alias("run"))
    no_month = runs.select(F.concat(F.substring("run", 1, 4), F.lit("13"), F.substring("run", 7, 4)).alias("run"))
    return later.unionByName(short).unionByName(no_month).distinct()


@register("J6_resolve_run", with_fixtures(["x2"], f"""
rq AS (SELECT strftime({_RUN_TS} + INTERVAL 6 HOUR, '%Y%m%d%H') AS run, true AS good FROM x2
  UNION SELECT substr(run, 1, 8), false FROM x2 UNION SELECT substr(run, 1, 4) || '13' || substr(run, 7, 4), false FROM x2),
av AS (SELECT DISTINCT run FROM x2 WHERE param = 'purchase' AND step = 0 AND status = 200),
c AS (SELECT rq.run, strftime({_RUN_TS} - k * INTERVAL 6 HOUR, '%Y%m%d%H') AS cand FROM rq, range(0, 4) t(k) WHERE good),
res AS (SELECT c.run, max(av.run) AS resolved_run FROM c LEFT JOIN av ON c.cand = av.run GROUP BY c.run)
SELECT run, resolved_run, CASE WHEN resolved_run IS NULL THEN 'No available run found (checked ' || run
  || ' back to ' || strftime({_RUN_TS} - INTERVAL 18 HOUR, '%Y%m%d%H') || ')' END AS error FROM res
UNION ALL SELECT run, CAST(NULL AS VARCHAR), 'Malformed run ' || run FROM rq WHERE NOT good"""))
def j6_resolve_run(spark, sf):
    return lifecycle.resolve_run(_shifted_requests(spark, sf), fx.x2_listing(spark, sf), probe_param="purchase")


_LATEST_SQL = "(SELECT run FROM x4l WHERE marker = '_LATEST_RUN' ORDER BY ts DESC, run DESC LIMIT 1)"


@register("J7_follow_redirect", with_fixtures(["x3", "x4l"], f"""
rd AS (SELECT run, arg_max(payload, ts) AS target FROM x4l WHERE marker = '_RESOLVED_RUN' GROUP BY run)
SELECT x3.run AS requested_run, x3.req_id, x3.lat, x3.lon, x3.param, x3.ensemble,
  coalesce(rd.target, x3.run, {_LATEST_SQL}) AS run FROM x3 LEFT JOIN rd ON x3.run = rd.run"""))
def j7_follow_redirect(spark, sf):
    return lifecycle.follow_redirect(fx.x3_requests(spark, sf), fx.x4_lifecycle_markers(spark, sf))


@register("T3_latest_run", with_fixtures(["x4l"], f"SELECT {_LATEST_SQL} AS run"))
def t3_latest_run(spark, sf):
    return lifecycle.latest_run(fx.x4_lifecycle_markers(spark, sf))


@register("T2_top_k_runs", with_fixtures(["x2"], "SELECT run FROM (SELECT DISTINCT run FROM x2) ORDER BY run DESC LIMIT 4"))
def t2_top_k_runs(spark, sf):
    return lifecycle.top_k_runs(fx.x2_listing(spark, sf), 4)


def _all_runs(spark, sf):
    return fx.x2_listing(spark, sf).select("run").unionByName(fx.x1_field(spark, sf).select("run"))


def _current(spark, sf):
    return lifecycle.latest_run(fx.x4_lifecycle_markers(spark, sf)).scalar()


_W3_SQL = f"""r AS (SELECT run FROM x2 UNION SELECT run FROM x1),
rr AS (SELECT run, row_number() OVER (ORDER BY run DESC) AS rn FROM r WHERE regexp_matches(run, '^[0-9]+$')),
w3 AS (SELECT run, rn <= 2 OR coalesce(run = {_LATEST_SQL}, false) AS keep FROM rr)"""


@register("W3_retention_select", with_fixtures(["x1", "x2", "x4l"], _W3_SQL + "\nSELECT * FROM w3"))
def w3_retention_select(spark, sf):
    return lifecycle.retention_select(_all_runs(spark, sf), _current(spark, sf), keep=2)


@register("U3_orphan_staging", with_fixtures(["x1", "x2", "x4l"], _W3_SQL + f"""
SELECT DISTINCT run FROM x2 WHERE run NOT IN (SELECT run FROM w3 WHERE keep)
  AND NOT coalesce(run = {_LATEST_SQL}, false)"""))
def u3_orphan_staging(spark, sf):
    cur = _current(spark, sf)
    kept = lifecycle.retention_select(_all_runs(spark, sf), cur, keep=2)
    return lifecycle.orphan_staging(fx.x2_listing(spark, sf), kept, cur)


ORDERED = ["pet_pm", "tot_prec", "ps", "t_2m", "td_2m", "u_10m", "v_10m", "asob_s", "athb_s"]
_ORDER_VALUES = "(VALUES " + ", ".join(f"('{p}', {i})" for i, p in enumerate(ORDERED)) + ") o(param, pos)"


@register("W4_first_ready_param", with_fixtures(["x1"], f"""
ax AS (SELECT run, param, list_sort(list(DISTINCT step)) AS steps FROM x1 GROUP BY run, param)
SELECT ax.run, arg_min(ax.param, o.pos) AS param, arg_min(ax.steps, o.pos) AS steps
FROM ax JOIN {_ORDER_VALUES} ON ax.param = o.param GROUP BY ax.run"""))
def w4_first_ready_param(spark, sf):
    return lifecycle.first_ready_param(fx.x1_field(spark, sf), ORDERED)


_PET_ORDER = "(VALUES " + ", ".join(f"('{p}', {i})" for i, p in enumerate(derive.PET_INPUTS)) + ") o(param, pos)"


@register("S7_run_index", with_fixtures(["x1", "x4"], f"""
ax AS (SELECT run, param, list_sort(list(DISTINCT step)) AS steps FROM x1 GROUP BY run, param),
g AS (SELECT ax.run, list(ax.param ORDER BY o.pos) AS params, arg_min(ax.steps, o.pos) AS steps,
  list(ax.steps ORDER BY o.pos) AS all_steps
  FROM ax JOIN {_PET_ORDER} ON ax.param = o.param
  WHERE EXISTS (SELECT 1 FROM x4 WHERE x4.run = ax.run AND x4.param = ax.param AND x4.marker = '_SUCCESS')
  GROUP BY ax.run)
SELECT run, CAST(len(params) AS INTEGER) AS n_params, CAST(to_json(struct_pack(run := run,
  grid := struct_pack(lat_min := {d(grid.LAT_MIN)}, lat_max := {d(grid.LAT_MAX)}, lon_min := {d(grid.LON_MIN)},
    lon_max := {d(grid.LON_MAX)}, nx := {grid.GRID_NX}, ny := {grid.GRID_NY}, resolution := {d(grid.RES_DEG)}),
  chunks := struct_pack(latitude := {grid.CHUNK_LAT}, longitude := {grid.CHUNK_LON}),
  params := params, steps := steps)) AS VARCHAR) AS index_json,
  CAST(to_json(map(params, all_steps)) AS VARCHAR) AS steps_by_param FROM g"""))
def s7_run_index(spark, sf):
    return lifecycle.run_index(fx.x1_field(spark, sf), fx.x4_markers(spark, sf), derive.PET_INPUTS)


def _s8(spark, sf):
    x1, x4 = fx.x1_field(spark, sf), fx.x4_markers(spark, sf)
    init = grid.run_init_time("run")
    axis = x1.groupBy("run", "param").agg(F.count_distinct("step").alias("n_steps"))
    succ = lifecycle.make_markers(axis, quality.SUCCESS, F.to_json(F.struct("n_steps")),
                                  init + F.expr("INTERVAL 3 HOURS"))
    checks = quality.validate_run(x1, x4, derive.PET_INPUTS)
    passed = quality.run_verdict(checks).where("ok").select("run")
    ts = init + F.expr("INTERVAL 5 HOURS")
    params = F.array(*[F.lit(p) for p in derive.PET_INPUTS])
    prom = lifecycle.make_markers(passed, quality.PROMOTED, lifecycle.promoted_payload(F.col("run"), params, ts), ts)
    return succ.unionByName(prom)


_PARAMS_LIST = "[" + ", ".join(f"'{p}'" for p in sorted(derive.PET_INPUTS)) + "]"
_PET_VALUES = "(VALUES " + ", ".join(f"('{p}')" for p in derive.PET_INPUTS) + ") pp(param)"


@register("S8_run_markers", with_fixtures(["x1", "x4"], f"""
ax AS (SELECT run, param, count(DISTINCT step) AS n_steps FROM x1 GROUP BY run, param),
r AS (SELECT run FROM x1 UNION SELECT run FROM x4),
e AS (SELECT r.run, pp.param FROM r, {_PET_VALUES}),
bad AS (SELECT DISTINCT e.run FROM e WHERE NOT EXISTS (SELECT 1 FROM x4 WHERE x4.run = e.run
  AND x4.param = e.param AND x4.marker = '_SUCCESS') OR NOT EXISTS (SELECT 1 FROM x1 WHERE x1.run = e.run
  AND x1.param = e.param)),
ok AS (SELECT run FROM r WHERE run NOT IN (SELECT run FROM bad))
SELECT run, param, '_SUCCESS' AS marker, CAST(to_json(struct_pack(n_steps := n_steps)) AS VARCHAR) AS payload,
  {_RUN_TS} + INTERVAL 3 HOUR AS ts FROM ax
UNION ALL SELECT run, CAST(NULL AS VARCHAR), '_PROMOTED',
  CAST(to_json(struct_pack(run := run, params := {_PARAMS_LIST},
    validated_at := strftime({_RUN_TS} + INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S') || '+00:00')) AS VARCHAR),
  {_RUN_TS} + INTERVAL 5 HOUR FROM ok"""))
def s8_run_markers(spark, sf):
    return _s8(spark, sf)


def _existing_paths(spark, sf):
    """Store listing: data of every X1 (run, param) under runs/, staging copies
    of runs that were not promoted, and redirect markers."""
    x1 = fx.x1_field(spark, sf).select("run", "param").distinct()
    mk = fx.x4_lifecycle_markers(spark, sf)
    prom = mk.where(F.col("marker") == quality.PROMOTED).select("run")
    runs_p = x1.select(F.concat_ws("/", F.lit("runs"), "run", "param").alias("path"))
    stag = x1.join(prom, "run", "left_anti").select(F.concat_ws("/", F.lit("staging"), "run", "param").alias("path"))
    red = mk.where(F.col("marker") == quality.RESOLVED).select(
        F.concat_ws("/", F.lit("staging"), "run", F.lit(quality.RESOLVED)).alias("path"))
    return runs_p.unionByName(stag).unionByName(red)


@register("U4_cleanup_select", with_fixtures(["x1", "x4l"], f"""
m AS (SELECT DISTINCT run, param FROM x1),
ex AS (SELECT 'runs/' || run || '/' || param AS path FROM m
  UNION ALL SELECT 'staging/' || run || '/' || param FROM m WHERE run NOT IN (SELECT run FROM x4l WHERE marker = '_PROMOTED')
  UNION ALL SELECT 'staging/' || run || '/_RESOLVED_RUN' FROM x4l WHERE marker = '_RESOLVED_RUN'),
r AS (SELECT run FROM x1 UNION SELECT run FROM x4l WHERE marker IN ('_SUCCESS', '_PROMOTED')),
e AS (SELECT r.run, pp.param FROM r, {_PET_VALUES}),
failed AS (SELECT DISTINCT run, param FROM e WHERE NOT EXISTS (SELECT 1 FROM x4l WHERE x4l.run = e.run
  AND x4l.param = e.param AND x4l.marker = '_SUCCESS')),
cand AS (SELECT 'staging/' || run || '/' || param AS path FROM failed UNION SELECT 'runs/' || run || '/' || param FROM failed
  UNION SELECT 'staging/' || run || '/_RESOLVED_RUN' FROM failed),
red AS (SELECT run, payload AS resolved_run FROM x4l WHERE marker = '_RESOLVED_RUN'),
leg AS (SELECT DISTINCT 'staging/' || rid || '/' || pp.param AS path
  FROM (SELECT run AS rid FROM red UNION SELECT resolved_run FROM red) ids, {_PET_VALUES})
SELECT path FROM cand WHERE path IN (SELECT path FROM ex)
UNION ALL SELECT path FROM leg WHERE path IN (SELECT path FROM ex)"""))
def u4_cleanup_select(spark, sf):
    ex = _existing_paths(spark, sf)
    mk = fx.x4_lifecycle_markers(spark, sf)
    checks = quality.validate_run(fx.x1_field(spark, sf), mk.where(F.col("marker").isin(quality.SUCCESS, quality.PROMOTED)),
                                  derive.PET_INPUTS)
    failed = checks.where((F.col("check") == "success_marker") & ~F.col("ok")).select("run", "param")
    red = mk.where(F.col("marker") == quality.RESOLVED).select("run", F.col("payload").alias("resolved_run"))
    return (lifecycle.cleanup_select(ex, failed)
            .unionByName(lifecycle.legacy_staging_select(ex, red, derive.PET_INPUTS)))
