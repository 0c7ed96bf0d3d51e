"""Bulk serving: pixel series, point lookups, JSON bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import grid
from ..functions.jsfmt import js_double, js_number, js_string
from ..functions.stats import round4
from .grid_ops import point_to_cell, unit_of
from .joins import bounded_broadcast

MAX_BROADCAST_REQUESTS = 1_000_000


def series_pack(field: DataFrame) -> DataFrame:
    """Long field -> one row per pixel with its step-ordered values.

    The counterpart of chunking with the whole step axis in one chunk: a
    pixel's series is bounded by the step count, so ``collect_list`` per
    pixel is bounded; ``cy``/``cx`` are added for partition pruning.
    """
    lead = [c for c in ("run", "param", "model", "member") if c in field.columns]
    g = (field.groupBy(*lead, "iy", "ix")
         .agg(F.array_sort(F.collect_list(F.struct("step", F.col("value").cast("float").alias("v")))).alias("_s")))
    return g.select(*lead, grid.chunk_of(F.col("iy"), grid.CHUNK_LAT).alias("cy"),
                    grid.chunk_of(F.col("ix"), grid.CHUNK_LON).alias("cx"), "iy", "ix",
                    F.transform("_s", lambda e: e["step"]).alias("steps"),
                    F.transform("_s", lambda e: e["v"]).alias("vals"))


def point_lookup(series: DataFrame, requests: DataFrame, wrap: bool = False,
                 max_broadcast: int = MAX_BROADCAST_REQUESTS) -> DataFrame:
    """The full series at the nearest cell of every request.

    Requests get their cell and chunk (P3), join the series on
    (run, param, cy, iy, ix) and are exploded to one row per step with
    ``step_index`` (array position) and ``step`` (forecast hour).  The
    request side is broadcast only when its checked size is small, which
    also enables dynamic pruning of ``cy`` partitions of a stored series.
    Past that, requests are shuffled to the buckets of a series stored by
    :func:`isobar.sources.store.series_publish_bucketed`, which stays where it
    is (with ``cluster_conf``, which allows co-partitioning on the cell alone).
    Requests without a well-formed run, or whose cell holds no series, give no
    rows here; the flow (``jobs.answer_points``) resolves the former first and
    answers the latter with an error.
    """
    # only well-formed run ids can match a stored run (requests without a run
    # are resolved by follow_redirect first); the predicate also marks the
    # request side as selective, which lets the optimizer add dynamic pruning
    r = requests.select("req_id", "lat", "lon", "param", "run").where(F.col("run").rlike(r"^[0-9]{10}$"))
    r = point_to_cell(r, wrap=wrap)
    # not checkpointed: the scan's own predicates are what dynamic pruning needs
    r = bounded_broadcast(r.select("req_id", "lat", "lon", "param", "run", "cy", "iy", "ix"), max_broadcast, reuse=False)
    s = series.select(*[c for c in ("run", "param", "member") if c in series.columns],
                      "cy", "iy", "ix", "steps", "vals")
    j = s.join(r, ["run", "param", "cy", "iy", "ix"])
    mem = ["member"] if "member" in series.columns else []
    e = j.select("req_id", "lat", "lon", "param", "run", *mem,
                 F.posexplode(F.arrays_zip("steps", "vals")).alias("step_index", "sv"))
    return e.select("req_id", "lat", "lon", "param", "run", *mem,
                    F.col("step_index").cast("int").alias("step_index"),
                    F.col("sv.steps").alias("step"), F.col("sv.vals").alias("value"),
                    unit_of(F.col("param")).alias("unit"))


def point_series_json(points: DataFrame, ensemble: bool = False) -> DataFrame:
    """A10: one JSON body per request, as the point API returns it.

    ``values`` maps the step index to the value rounded to 4 decimals (P7);
    for ensembles to the list of member values, plus a ``members`` count.
    """
    keys = ["req_id", "lat", "lon", "param", "run", "unit"]
    v = js_number(round4(F.col("value").cast("double")), 4)
    if ensemble:
        per_step = (points.groupBy(*keys, "step_index")
                    .agg(F.array_sort(F.collect_list(F.struct("member", v.alias("t")))).alias("_m"),
                         F.count_distinct("member").alias("_nm")))
        per_step = per_step.select(*keys, "step_index", "_nm", F.concat(
            F.lit("["), F.array_join(F.transform("_m", lambda e: e["t"]), ","), F.lit("]")).alias("t"))
        g = per_step.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("step_index", "t"))).alias("_e"),
                                         F.max("_nm").alias("members"))
    else:
        g = (points.groupBy(*keys)
             .agg(F.array_sort(F.collect_list(F.struct("step_index", v.alias("t")))).alias("_e")))
    values = F.concat(F.lit("{"), F.array_join(F.transform(
        "_e", lambda e: F.concat(F.lit('"'), e["step_index"].cast("string"), F.lit('":'), e["t"])), ","), F.lit("}"))
    parts = [F.lit('{"lat":'), js_double(F.col("lat")), F.lit(',"lon":'), js_double(F.col("lon")),
             F.lit(',"param":'), js_string(F.col("param")), F.lit(',"run":'), js_string(F.col("run")),
             F.lit(',"unit":'), js_string(F.col("unit"))]
    if ensemble:
        parts += [F.lit(',"members":'), F.col("members").cast("string")]
    parts += [F.lit(',"values":'), values, F.lit("}")]
    n = F.size("_e").alias("n_steps")
    return g.select("req_id", n, F.concat(*parts).alias("body"))


def deaccumulate_series(series: DataFrame, params=("asob_s", "athb_s")) -> DataFrame:
    """W1 on the series layout: the step axis is an array in the row, so the
    same rule is a ``transform`` over the arrays - no window, no shuffle."""
    steps, vals = F.col("steps"), F.col("vals")

    def inst(v, i):
        t = F.element_at(steps, i + 1).cast("double")
        prev_i = F.greatest(i, F.lit(1))
        pt = F.when(i == 0, F.lit(0.0)).otherwise(F.element_at(steps, prev_i).cast("double"))
        pv = F.when(i == 0, F.lit(0.0)).otherwise(
            F.coalesce(F.nanvl(F.element_at(vals, prev_i).cast("double"), F.lit(0.0)), F.lit(0.0)))
        dt = t - pt
        return F.when(dt > 0, F.try_divide(v.cast("double") * t - pv * pt, dt)).otherwise(F.lit(0.0)).cast("float")

    new = F.when(F.col("param").isin(list(params)), F.transform(vals, inst)).otherwise(vals)
    return series.withColumn("vals", new)
