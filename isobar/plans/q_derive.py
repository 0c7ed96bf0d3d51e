"""Queries: the PET chain (W1, J4, D1) on the long layout and on the pixel-bucketed store."""

from __future__ import annotations

from ..operators import derive, temporal
from ..session import shared_dir
from ..sources import fixtures as fx
from ..sources import store
from .catalog import register
from .oracle_pet import align_sql, deaccumulate_sql, pet_select_sql
from .sqltext import with_fixtures

_PET_SQL = with_fixtures(["x1"], deaccumulate_sql("x1", "w1") + ",\n" + align_sql("w1", "al") + ",\n"
                         + pet_select_sql("al"))


@register("D1_pet_pm", _PET_SQL)
def d1_pet_pm(spark, sf):
    return derive.pet_pm(fx.x1_field(spark, sf))


@register("W1_deaccumulate", with_fixtures(["x1"], deaccumulate_sql("x1", "w1") + "\nSELECT * FROM w1"))
def w1_deaccumulate(spark, sf):
    return temporal.deaccumulate(fx.x1_field(spark, sf))


@register("J4_align_params", with_fixtures(["x1"], align_sql("x1", "al") + "\nSELECT * FROM al"))
def j4_align_params(spark, sf):
    return derive.align_params(fx.x1_field(spark, sf), derive.PET_INPUTS)


_PET_BUCKETED_SQL = with_fixtures(["x1"], """
xf AS (SELECT run, param, step, iy, ix, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM x1),
""" + deaccumulate_sql("xf", "w1") + ",\n" + align_sql("w1", "al") + ",\n" + pet_select_sql("al"))


@register("D1_pet_pm_bucketed", _PET_BUCKETED_SQL)
def d1_pet_pm_bucketed(spark, sf):
    """D1 over the field published to a store bucketed by pixel: the
    derivation itself runs without any shuffle."""
    import uuid
    tag = uuid.uuid4().hex
    f = store.field_publish_bucketed(fx.x1_field(spark, sf), shared_dir(spark, f"bucketed-{tag}"),
                                     f"isobar_field_{tag}")
    return derive.pet_pm(f, co_located=True)
