"""Queries: checks of a stored field from its zone maps."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import derive, quality, zones
from ..session import shared_dir
from ..sources import fixtures as fx, store
from .catalog import register
from .sqltext import with_fixtures

_STORED = "x1f AS (SELECT run, param, step, iy, ix, CAST(value AS FLOAT) AS value FROM x1n)"


def _zones(spark, field, ensemble=False):
    """The field is published in two turns, the second replacing some params of the first."""
    root = shared_dir(spark, f"zones-{uuid.uuid4().hex}")
    store.field_publish(field, root, zones=True)
    store.field_publish(field.where(F.col("param").isin("t_2m", "ps")), root, zones=True)
    return store.zone_scan(spark, root, ensemble=ensemble)


_BOUNDS = ", ".join(f"('{k}', CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE))" for k, (lo, hi) in quality.PARAM_BOUNDS.items())


@register("A3_bounds_check_zones", with_fixtures(["x1n"], f"""
{_STORED},
a AS (SELECT run, param, coalesce(min(value) FILTER (WHERE NOT isnan(value)), CAST('NaN' AS FLOAT)) AS vmin,
  coalesce(max(value) FILTER (WHERE NOT isnan(value)), CAST('NaN' AS FLOAT)) AS vmax, bool_and(isnan(value)) AS all_nan FROM x1f GROUP BY run, param),
b(p, lo, hi) AS (VALUES {_BOUNDS})
SELECT run, param, vmin, vmax, all_nan,
  CASE WHEN lo IS NOT NULL THEN vmin >= lo AND vmax <= hi AND NOT isnan(vmin) END AS in_bounds FROM a LEFT JOIN b ON param = p"""))
def a3_bounds_check_zones(spark, sf):
    return zones.bounds_check(_zones(spark, fx.x1_field(spark, sf, with_nan=True)))


@register("A4_smoke_sample_zones", with_fixtures(["x1n"], f"""
{_STORED},
f AS (SELECT run, param, min(step) AS step FROM x1f GROUP BY run, param)
SELECT f.run, f.param, count(*) FILTER (WHERE NOT isnan(x.value)) = 0 AS all_nan FROM f
  LEFT JOIN x1f x ON x.run = f.run AND x.param = f.param AND x.step = f.step AND x.iy < 10 AND x.ix < 10 GROUP BY f.run, f.param"""))
def a4_smoke_sample_zones(spark, sf):
    return zones.smoke_sample(_zones(spark, fx.x1_field(spark, sf, with_nan=True)))


_PARAMS = [*derive.PET_INPUTS, "pet_pm"]


@register("A5_nonempty_check_zones", with_fixtures(["x1"], f"""
e AS (SELECT r.run, p.param FROM (SELECT DISTINCT run FROM x1) r, (VALUES {", ".join(f"('{p}')" for p in _PARAMS)}) p(param))
SELECT e.run, e.param, count(x1.step) AS n_rows, count(DISTINCT x1.step) AS n_steps
FROM e LEFT JOIN x1 ON e.run = x1.run AND e.param = x1.param GROUP BY e.run, e.param"""))
def a5_nonempty_check_zones(spark, sf):
    found = _zones(spark, fx.x1_field(spark, sf))
    return zones.nonempty_check(found, quality.expected_pairs(found.select("run"), _PARAMS))


@register("A6_member_count_zones", with_fixtures(["x7"], """
SELECT run, param, count(DISTINCT member) AS n_members, count(DISTINCT member) = 4 AS ok FROM x7 GROUP BY run, param"""))
def a6_member_count_zones(spark, sf):
    return zones.member_count(_zones(spark, fx.x7_ensemble(spark, sf), ensemble=True), expected=4)


@register("A11_frame_range_zones", with_fixtures(["x1n"], f"""
{_STORED}
SELECT param, CASE WHEN param = 'tot_prec' THEN CAST(0 AS FLOAT) ELSE min(value) FILTER (WHERE NOT isnan(value)) END AS vmin,
  max(value) FILTER (WHERE NOT isnan(value)) AS vmax FROM x1f GROUP BY param"""))
def a11_frame_range_zones(spark, sf):
    return zones.frame_range(_zones(spark, fx.x1_field(spark, sf, with_nan=True)))
