"""Queries: availability and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import derive, grid_ops, quality
from ..sources import fixtures as fx
from .catalog import register
from .sqltext import NAN, d, with_fixtures

_A1_SQL = """a1j AS (SELECT e.run, e.param, e.step, l.step IS NOT NULL AS present FROM x2_expected e
  LEFT JOIN x2 l ON e.run = l.run AND e.param = l.param AND e.step = l.step AND l.status = 200),
a1 AS (SELECT run, param,
  coalesce(list_sort(list(step) FILTER (WHERE present)), CAST([] AS INTEGER[])) AS available,
  coalesce(list_sort(list(step) FILTER (WHERE NOT present)), CAST([] AS INTEGER[])) AS missing,
  count(*) AS total_steps FROM a1j GROUP BY run, param)"""


def _a1(spark, sf):
    return quality.availability_manifest(fx.x2_expected(spark, sf), fx.x2_listing(spark, sf))


@register("A1_availability_manifest", with_fixtures(["x2_expected"], _A1_SQL + "\nSELECT * FROM a1"))
def a1_availability_manifest(spark, sf):
    return _a1(spark, sf)


@register("A2_completeness_check", with_fixtures(["x2_expected"], _A1_SQL + f""",
a2 AS (SELECT run, param, CAST(len(available) AS INTEGER) AS avail, CAST(len(missing) AS INTEGER) AS miss,
  total_steps FROM a1),
a2f AS (SELECT *, CASE WHEN total_steps = 0 THEN {d(0)} ELSE CAST(miss AS DOUBLE) / CAST(total_steps AS DOUBLE) END AS frac FROM a2)
SELECT *, CASE WHEN frac <= {d(0.15)} THEN 'OK' ELSE 'BLOCKED' END AS status FROM a2f"""))
def a2_completeness_check(spark, sf):
    return quality.completeness_check(_a1(spark, sf))


def _bounds_case(i: int) -> str:
    w = " ".join(f"WHEN '{k}' THEN {d(v[i])}" for k, v in quality.PARAM_BOUNDS.items())
    return f"CASE param {w} END"


_A3_AGG = f"""a3 AS (SELECT run, param,
  coalesce(min(value) FILTER (WHERE NOT isnan(value)), {NAN}) AS vmin,
  coalesce(max(value) FILTER (WHERE NOT isnan(value)), {NAN}) AS vmax,
  coalesce(bool_and(isnan(value)), true) AS all_nan FROM x1n GROUP BY run, param)"""


@register("A3_bounds_check", with_fixtures(["x1n"], _A3_AGG + f"""
SELECT *, CASE WHEN {_bounds_case(0)} IS NULL THEN NULL
  ELSE vmin >= {_bounds_case(0)} AND vmax <= {_bounds_case(1)} AND NOT isnan(vmin) END AS in_bounds FROM a3"""))
def a3_bounds_check(spark, sf):
    return quality.bounds_check(fx.x1_field(spark, sf, with_nan=True))


def _smoke_sql(src: str) -> str:
    return f"""sf AS (SELECT run, param, min(step) AS step FROM {src} GROUP BY run, param),
sc AS (SELECT x.run, x.param, bool_and(isnan(x.value)) AS an FROM {src} x
  JOIN sf ON x.run = sf.run AND x.param = sf.param AND x.step = sf.step WHERE x.iy < 10 AND x.ix < 10
  GROUP BY x.run, x.param),
sm AS (SELECT sf.run, sf.param, coalesce(sc.an, true) AS all_nan FROM sf LEFT JOIN sc
  ON sf.run = sc.run AND sf.param = sc.param)"""


@register("A4_smoke_sample", with_fixtures(["x1n"], _smoke_sql("x1n") + "\nSELECT * FROM sm"))
def a4_smoke_sample(spark, sf):
    return quality.smoke_sample(fx.x1_field(spark, sf, with_nan=True))


_PARAMS_PLUS = list(derive.PET_INPUTS) + ["pet_pm"]
_PARAMS_VALUES = "(VALUES " + ", ".join(f"('{p}')" for p in _PARAMS_PLUS) + ") pp(param)"
_PET_VALUES = "(VALUES " + ", ".join(f"('{p}')" for p in derive.PET_INPUTS) + ") pp(param)"


@register("A5_nonempty_check", with_fixtures(["x1"], f"""
e AS (SELECT r.run, pp.param FROM (SELECT DISTINCT run FROM x1) r, {_PARAMS_VALUES}),
a AS (SELECT run, param, count(*) AS n_rows, count(DISTINCT step) AS n_steps FROM x1 GROUP BY run, param)
SELECT e.run, e.param, coalesce(a.n_rows, 0) AS n_rows, coalesce(a.n_steps, 0) AS n_steps
FROM e LEFT JOIN a ON e.run = a.run AND e.param = a.param"""))
def a5_nonempty_check(spark, sf):
    x1 = fx.x1_field(spark, sf)
    return quality.nonempty_check(x1, quality.expected_pairs(x1.select("run"), _PARAMS_PLUS))


@register("A6_member_count", with_fixtures(["x7"], """
SELECT run, param, count(DISTINCT member) AS n_members, count(DISTINCT member) = 4 AS ok FROM x7 GROUP BY run, param"""))
def a6_member_count(spark, sf):
    return quality.member_count(fx.x7_ensemble(spark, sf), expected=4)


@register("A7_validate_run", with_fixtures(["x1", "x4"], _smoke_sql("x1") + f""",
r AS (SELECT run FROM x1 UNION SELECT run FROM x4),
e AS (SELECT r.run, pp.param FROM r, {_PET_VALUES}),
s AS (SELECT DISTINCT run, param FROM x4 WHERE marker = '_SUCCESS'),
ne AS (SELECT run, param, count(*) AS n FROM x1 GROUP BY run, param)
SELECT e.run, e.param, 'success_marker' AS "check", s.run IS NOT NULL AS ok FROM e
  LEFT JOIN s ON e.run = s.run AND e.param = s.param
UNION ALL SELECT e.run, e.param, 'nonempty', coalesce(ne.n, 0) > 0 FROM e
  LEFT JOIN ne ON e.run = ne.run AND e.param = ne.param
UNION ALL SELECT e.run, e.param, 'smoke_sample', coalesce(NOT sm.all_nan, false) FROM e
  LEFT JOIN sm ON e.run = sm.run AND e.param = sm.param"""))
def a7_validate_run(spark, sf):
    return quality.validate_run(fx.x1_field(spark, sf), fx.x4_markers(spark, sf), derive.PET_INPUTS)


def _gate_sql(markers: str, values: str) -> str:
    return f"""gr AS (SELECT DISTINCT run FROM {markers}),
ge AS (SELECT gr.run, pp.param FROM gr, {values}),
gm AS (SELECT ge.run, ge.param FROM ge WHERE NOT EXISTS (SELECT 1 FROM {markers} m
  WHERE m.run = ge.run AND m.param = ge.param AND m.marker = '_SUCCESS')),
gmm AS (SELECT run, list_sort(list(param)) AS missing FROM gm GROUP BY run),
gp AS (SELECT DISTINCT run FROM {markers} WHERE marker = '_PROMOTED'),
gate AS (SELECT gr.run, coalesce(gmm.missing, CAST([] AS VARCHAR[])) AS missing, gp.run IS NOT NULL AS promoted,
  gp.run IS NOT NULL AND len(coalesce(gmm.missing, CAST([] AS VARCHAR[]))) = 0 AS ok
  FROM gr LEFT JOIN gmm ON gr.run = gmm.run LEFT JOIN gp ON gr.run = gp.run)"""


@register("A8_publish_gate", with_fixtures(["x4"], _gate_sql("x4", _PET_VALUES) + "\nSELECT * FROM gate"))
def a8_publish_gate(spark, sf):
    return quality.publish_gate(fx.x4_markers(spark, sf), derive.PET_INPUTS)


_BOX = (88.6, -179.9, 89.9, -179.4)


@register("A11_frame_range", with_fixtures(["x1n"], f"""
b AS (SELECT * FROM x1n WHERE iy BETWEEN 1 AND 11 AND ix BETWEEN 1 AND 5)
SELECT param, CASE WHEN param IN ('tot_prec') THEN {d(0)} ELSE min(value) FILTER (WHERE NOT isnan(value)) END AS vmin,
  max(value) FILTER (WHERE NOT isnan(value)) AS vmax FROM b GROUP BY param"""))
def a11_frame_range(spark, sf):
    box = grid_ops.bbox_slice(fx.x1_field(spark, sf, with_nan=True), *_BOX)
    return quality.frame_range(box)


@register("P10_zero_fill", with_fixtures(["x1", "x2"], f"""
g AS (SELECT max(iy) + 1 AS ny, max(ix) + 1 AS nx FROM x1),
s AS (SELECT run, param, step FROM x2 WHERE n_bytes < 10000 AND status = 200),
sy AS (SELECT run, param, step, unnest(range(0, ny)) AS iy, nx FROM s, g)
SELECT run, param, step, CAST(iy AS INTEGER) AS iy, CAST(unnest(range(0, nx)) AS INTEGER) AS ix, {d(0)} AS value FROM sy"""))
def p10_zero_fill(spark, sf):
    x1 = fx.x1_field(spark, sf)
    ny = x1.select(F.max("iy") + 1).scalar()
    nx = x1.select(F.max("ix") + 1).scalar()
    return quality.zero_fill(fx.x2_listing(spark, sf), ny=ny, nx=nx)


@register("P14_drop_missing_steps", with_fixtures(["x2_expected"], """
SELECT e.run, e.param, e.step, l.n_bytes, l.status FROM x2_expected e
  JOIN x2 l ON e.run = l.run AND e.param = l.param AND e.step = l.step WHERE l.status = 200"""))
def p14_drop_missing_steps(spark, sf):
    j = fx.x2_expected(spark, sf).join(fx.x2_listing(spark, sf), ["run", "param", "step"], "left")
    return quality.drop_missing_steps(j, fail_if_empty=False)


def _manifest_rows(spark, sf):
    e = fx.x2_expected(spark, sf).where(F.col("param") != "view")
    ok = fx.x2_listing(spark, sf).where(F.col("status") == 200).select("run", "param", "step",
                                                                       F.lit(True).alias("is_available"))
    return (e.join(ok, ["run", "param", "step"], "left")
            .select("run", "param", "step", F.coalesce("is_available", F.lit(False)).alias("is_available")))


@register("J8_prune_by_manifest", with_fixtures(["x2_expected"], """
mr AS (SELECT e.run, e.param, e.step, l.step IS NOT NULL AS is_available FROM x2_expected e
  LEFT JOIN x2 l ON e.run = l.run AND e.param = l.param AND e.step = l.step AND l.status = 200
  WHERE e.param <> 'view')
SELECT e.* FROM x2_expected e WHERE EXISTS (SELECT 1 FROM mr WHERE mr.run = e.run AND mr.param = e.param
  AND mr.step = e.step AND mr.is_available)
UNION ALL SELECT e.* FROM x2_expected e WHERE NOT EXISTS (SELECT 1 FROM mr WHERE mr.run = e.run AND mr.param = e.param)"""))
def j8_prune_by_manifest(spark, sf):
    return quality.prune_by_manifest(fx.x2_expected(spark, sf), _manifest_rows(spark, sf))


@register("J9_missing_markers", with_fixtures(["x1", "x4"], f"""
e AS (SELECT r.run, pp.param FROM (SELECT DISTINCT run FROM x1) r, {_PARAMS_VALUES})
SELECT e.run, e.param FROM e WHERE NOT EXISTS (SELECT 1 FROM x4 WHERE x4.run = e.run AND x4.param = e.param
  AND x4.marker = '_SUCCESS')"""))
def j9_missing_markers(spark, sf):
    x1 = fx.x1_field(spark, sf)
    return quality.missing_markers(quality.expected_pairs(x1.select("run"), _PARAMS_PLUS), fx.x4_markers(spark, sf))


@register("J10_run_exists", with_fixtures(["x3", "x4"], """
s AS (SELECT DISTINCT run, param FROM x4 WHERE marker = '_SUCCESS')
SELECT x3.run, x3.param, x3.req_id, x3.lat, x3.lon, x3.ensemble,
  CASE WHEN x3.run IS NOT NULL AND s.run IS NULL
    THEN 'Run ' || x3.run || ' not found or not yet promoted for ' || coalesce(x3.param, '') END AS error
FROM x3 LEFT JOIN s ON x3.run = s.run AND x3.param = s.param"""))
def j10_run_exists(spark, sf):
    return quality.run_exists(fx.x3_requests(spark, sf), fx.x4_markers(spark, sf))


@register("A7_validate_run_eps", with_fixtures(["x7", "x4"], f"""
sf AS (SELECT run, param, min(step) AS step FROM x7 GROUP BY run, param),
sc AS (SELECT x.run, x.param, bool_and(isnan(x.value)) AS an FROM x7 x
  JOIN sf ON x.run = sf.run AND x.param = sf.param AND x.step = sf.step
  WHERE x.iy < 10 AND x.ix < 10 AND x.member = 0 GROUP BY x.run, x.param),
sm AS (SELECT sf.run, sf.param, coalesce(sc.an, true) AS all_nan FROM sf LEFT JOIN sc
  ON sf.run = sc.run AND sf.param = sc.param),
r AS (SELECT run FROM x7 UNION SELECT run FROM x4),
e AS (SELECT r.run, pp.param FROM r, {_PET_VALUES}),
s AS (SELECT DISTINCT run, param FROM x4 WHERE marker = '_SUCCESS'),
ne AS (SELECT run, param, count(*) AS n, count(DISTINCT member) AS nm FROM x7 GROUP BY run, param)
SELECT e.run, e.param, 'success_marker' AS "check", s.run IS NOT NULL AS ok FROM e
  LEFT JOIN s ON e.run = s.run AND e.param = s.param
UNION ALL SELECT e.run, e.param, 'nonempty', coalesce(ne.n, 0) > 0 FROM e
  LEFT JOIN ne ON e.run = ne.run AND e.param = ne.param
UNION ALL SELECT e.run, e.param, 'smoke_sample', coalesce(NOT sm.all_nan, false) FROM e
  LEFT JOIN sm ON e.run = sm.run AND e.param = sm.param
UNION ALL SELECT e.run, e.param, 'member_count', coalesce(ne.nm = 4, false) FROM e
  LEFT JOIN ne ON e.run = ne.run AND e.param = ne.param"""))
def a7_validate_run_eps(spark, sf):
    return quality.validate_run(fx.x7_ensemble(spark, sf), fx.x4_markers(spark, sf), derive.PET_INPUTS,
                                ensemble=True, members=4)
