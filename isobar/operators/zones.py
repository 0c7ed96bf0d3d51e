"""Checks of stored fields from their zone maps.

A zone map has one row per (model, run, param, member, step, chunk) with counts
and the range of the valid values (:func:`isobar.sources.store.zone_scan`).
Each function gives what its namesake in :mod:`isobar.operators.quality` gives
for the field itself, and reads no field row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import ENSEMBLE_MEMBERS, PARAM_BOUNDS, _lookup

def bounds_check(zones: DataFrame, bounds: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """A3: range per (run, param), all-NaN flag, and whether it lies in the param's bounds."""
    bounds = PARAM_BOUNDS if bounds is None else bounds
    lo = _lookup({k: float(v[0]) for k, v in bounds.items()}, F.col("param"))
    hi = _lookup({k: float(v[1]) for k, v in bounds.items()}, F.col("param"))
    nan = F.lit(float("nan")).cast("float")
    agg = zones.groupBy("run", "param").agg(F.coalesce(F.min("vmin"), nan).alias("vmin"), F.coalesce(F.max("vmax"), nan).alias("vmax"),
                                            (F.sum("n_valid") == 0).alias("all_nan"))
    inside = (F.col("vmin") >= lo) & (F.col("vmax") <= hi) & ~F.isnan("vmin")
    return agg.withColumn("in_bounds", F.when(lo.isNotNull(), inside))


def smoke_sample(zones: DataFrame) -> DataFrame:
    """A4: no valid value in the corner of the first step (of the first member)."""
    first = zones.groupBy("run", "param").agg(F.min("step").alias("step"))
    corner = zones.where(F.col("member") == 0).groupBy("run", "param", "step").agg(F.sum("n_corner").alias("n"))
    return (first.join(corner, ["run", "param", "step"], "left")
            .select("run", "param", (F.coalesce("n", F.lit(0)) == 0).alias("all_nan")))


def nonempty_check(zones: DataFrame, expected: DataFrame) -> DataFrame:
    """A5: rows and distinct steps of each expected (run, param)."""
    agg = zones.groupBy("run", "param").agg(F.sum("n_rows").alias("n_rows"), F.count_distinct("step").alias("n_steps"))
    return (expected.select("run", "param").join(agg, ["run", "param"], "left")
            .select("run", "param", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_steps", F.lit(0)).alias("n_steps")))


def member_count(zones: DataFrame, expected: int = ENSEMBLE_MEMBERS) -> DataFrame:
    """Distinct members per (run, param) against the expected count."""
    return (zones.groupBy("run", "param").agg(F.count_distinct("member").alias("n_members"))
            .withColumn("ok", F.col("n_members") == F.lit(expected)))


def frame_range(zones: DataFrame, precip=("tot_prec",)) -> DataFrame:
    """Colour-scale range per param; precipitation starts at 0."""
    agg = zones.groupBy("param").agg(F.min("vmin").alias("vmin"), F.max("vmax").alias("vmax"))
    return agg.withColumn("vmin", F.when(F.col("param").isin(list(precip)), F.lit(0.0).cast("float")).otherwise(F.col("vmin")))
