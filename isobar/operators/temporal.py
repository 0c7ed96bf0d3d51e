"""Operators along the forecast-step axis."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .keys import field_keys, step_hours

ACCUMULATED_MEANS = ("asob_s", "athb_s")


def deaccumulate(field: DataFrame, params=ACCUMULATED_MEANS) -> DataFrame:
    """Average since start -> average over (previous step, step].

    ``(v*t - v_prev*t_prev) / (t - t_prev)``; the first step has t_prev = 0;
    a missing or NaN previous value counts as 0; a non-positive interval
    gives 0.  Rows of other parameters pass through unchanged.

    The window is one pixel series (bounded by the number of steps), so the
    only shuffle is by pixel; callers that already partitioned the field by
    (run, iy, ix) get none.
    """
    keys = field_keys(field)
    w = Window.partitionBy(*keys).orderBy("step")
    t = step_hours(field)
    prev_t = F.coalesce(F.lag(t).over(w), F.lit(0.0))
    prev_v = F.coalesce(F.nanvl(F.lag("value").over(w), F.lit(0.0)), F.lit(0.0))
    dt = t - prev_t
    inst = F.when(dt > 0, F.try_divide(F.col("value") * t - prev_v * prev_t, dt)).otherwise(F.lit(0.0))
    out = F.when(F.col("param").isin(list(params)), inst).otherwise(F.col("value"))
    return field.withColumn("value", out)


def interpolate_steps(field: DataFrame, every: int = 1) -> DataFrame:
    """Fill the hours between consecutive frames of a pixel linearly.

    Original frames are kept; each gap (t, t_next) gains rows at t+every, ...
    below t_next.  Only neighbouring frames of one pixel series are read.
    """
    keys = field_keys(field)
    w = Window.partitionBy(*keys).orderBy("step")
    nxt_t, nxt_v = F.lead("step").over(w), F.lead("value").over(w)
    g = field.select(*field.columns, nxt_t.alias("_nt"), nxt_v.alias("_nv"))
    last = F.coalesce(F.col("_nt") - 1, F.col("step"))
    g = g.withColumn("_h", F.explode(F.sequence(F.col("step"), F.greatest(last, F.col("step")), F.lit(every))))
    frac = (F.col("_h") - F.col("step")).cast("double") / (F.col("_nt") - F.col("step")).cast("double")
    val = F.when(F.col("_h") == F.col("step"), F.col("value")).otherwise(
        F.col("value") + (F.col("_nv") - F.col("value")) * frac)
    cols = [val.alias("value") if c == "value" else (F.col("_h").cast("int").alias("step") if c == "step" else F.col(c))
            for c in field.columns]
    return g.select(*cols)


def step_axis(field: DataFrame) -> DataFrame:
    """Ascending list of the steps present per (run, param[, member])."""
    lead = [c for c in ("run", "param", "model", "member") if c in field.columns]
    return field.groupBy(*lead).agg(F.sort_array(F.collect_set("step")).alias("steps"))


def concat_steps(*frames: DataFrame) -> DataFrame:
    """Stack per-step frames into one field (by column name)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def members_from(field: DataFrame, label: str) -> DataFrame:
    """U2 in one scan: the member index from a column with the files' 1-based
    member label (for instance a partition column)."""
    return field.withColumn("member", F.col(label).cast("int") - 1).drop(label)


def concat_members(frames: Mapping[int, DataFrame]) -> DataFrame:
    """Stack member frames, adding the member index as a column."""
    parts = [df.withColumn("member", F.lit(int(m)).cast("int")) for m, df in sorted(frames.items())]
    return reduce(lambda a, b: a.unionByName(b), parts)
