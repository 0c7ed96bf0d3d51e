"""Run lifecycle: resolve, redirect, index, markers, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import grid
from .joins import SMALL_SIDE_ROWS, bounded_broadcast
from .quality import LATEST, RESOLVED, SUCCESS
from .temporal import step_axis

CYCLE_HOURS = 6
MAX_CYCLES_BACK = 3
KEEP_RUNS_DEFAULT = 1


def _fmt_run(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHH")


def resolve_run(requests: DataFrame, listing: DataFrame, max_back: int = MAX_CYCLES_BACK,
                cycle_h: int = CYCLE_HOURS, probe_param: str = "t_2m", probe_step: int = 0) -> DataFrame:
    """Newest available run at or before the requested one, at most
    ``max_back`` cycles back (an as-of lookup with a tolerance).

    Each request expands to its ``max_back + 1`` candidate run ids (a
    generator), which equi-join the runs whose probe file exists; the newest
    match wins.  Adds ``resolved_run`` and ``error`` (NULL when resolved).  A
    run id that is not ten digits naming a real hour cannot be looked up and
    gets an error of its own.
    """
    avail = (listing.where((F.col("param") == probe_param) & (F.col("step") == probe_step)
                           & (F.col("status") == 200))
             .select(F.col("run").alias("cand")).distinct().withColumn("_hit", F.lit(True)))
    init = F.try_to_timestamp(F.when(F.col("run").rlike("^[0-9]{10}$"), F.col("run")), F.lit("yyyyMMddHH"))
    k = F.explode(F.sequence(F.lit(0), F.lit(max_back))).alias("_k")
    c = requests.select("run").distinct().select("run", k).select(
        "run", _fmt_run(init - F.make_dt_interval(hours=F.col("_k") * cycle_h)).alias("cand"))
    res = (c.join(bounded_broadcast(avail, SMALL_SIDE_ROWS), "cand", "left")
           .groupBy("run").agg(F.max(F.when(F.col("_hit"), F.col("cand"))).alias("resolved_run")))
    oldest = _fmt_run(init - F.make_dt_interval(hours=F.lit(max_back * cycle_h)))
    err = F.when(init.isNull(), F.concat(F.lit("Malformed run "), F.coalesce("run", F.lit("NULL")))).when(
        F.col("resolved_run").isNull(), F.concat(
            F.lit("No available run found (checked "), F.col("run"), F.lit(" back to "), oldest, F.lit(")")))
    return requests.join(bounded_broadcast(res, SMALL_SIDE_ROWS), "run", "left").withColumn("error", err)


def latest_run(markers: DataFrame) -> DataFrame:
    """The current run = the one whose pointer was written last (of
    pointers written at the same time, the newest run)."""
    return markers.where(F.col("marker") == LATEST).agg(F.max_by("run", F.struct("ts", "run")).alias("run"))


def follow_redirect(requests: DataFrame, markers: DataFrame) -> DataFrame:
    """Requested run -> its redirect target (newest ``_RESOLVED_RUN``) if
    any, else itself; no run -> the latest published run."""
    latest = latest_run(markers).scalar()
    red = (markers.where(F.col("marker") == RESOLVED).groupBy("run")
           .agg(F.max_by("payload", F.struct("ts", "payload")).alias("_target")))
    j = requests.withColumnRenamed("run", "requested_run").join(
        bounded_broadcast(red.withColumnRenamed("run", "requested_run"), SMALL_SIDE_ROWS), "requested_run", "left")
    return j.withColumn("run", F.coalesce(F.col("_target"), F.col("requested_run"), latest)).drop("_target")


def top_k_runs(runs: DataFrame, k: int) -> DataFrame:
    """The newest k runs (run ids sort chronologically)."""
    return runs.select("run").distinct().orderBy(F.col("run").desc()).limit(k)


def retention_select(runs: DataFrame, current: Column | str | None, keep: int = KEEP_RUNS_DEFAULT) -> DataFrame:
    """Digit-only run ids, newest first; the first ``keep`` and the current
    run are kept, the rest may be deleted.  Runs are few, so one global
    ordering of the distinct ids is cheap."""
    cur = F.lit(current) if isinstance(current, str) else current
    d = runs.select("run").distinct().where(F.col("run").rlike("^[0-9]+$"))
    rn = F.row_number().over(Window.orderBy(F.col("run").desc()))
    keep_c = rn <= keep
    if cur is not None:
        keep_c = keep_c | F.coalesce(F.col("run") == cur, F.lit(False))
    return d.select("run", keep_c.alias("keep"))


def orphan_staging(staging: DataFrame, kept: DataFrame, current: Column | str | None) -> DataFrame:
    """Staging runs that are neither kept nor current."""
    active = kept.where(F.col("keep")).select("run")
    cur = F.lit(current) if isinstance(current, str) else current
    s = staging.select("run").distinct().join(active, "run", "left_anti")
    if cur is not None:
        s = s.where(~F.coalesce(F.col("run") == cur, F.lit(False)))
    return s


def first_ready_param(field: DataFrame, ordered_params: Sequence[str]) -> DataFrame:
    """Per run, the first param in list order that has steps, and its steps."""
    pos = F.create_map(*[x for i, p in enumerate(ordered_params) for x in (F.lit(p), F.lit(i))])
    ax = step_axis(field).withColumn("_pos", F.try_element_at(pos, F.col("param")))
    return (ax.where(F.col("_pos").isNotNull() & (F.size("steps") > 0)).groupBy("run")
            .agg(F.min_by("param", "_pos").alias("param"), F.min_by("steps", "_pos").alias("steps")))


def run_index(field: DataFrame, markers: DataFrame, params: Sequence[str]) -> DataFrame:
    """One index document per run: grid, chunks, the params with a success
    marker (list order) and the steps of the first of them that has steps;
    ``steps_by_param`` lists every param's own steps (they may differ)."""
    pos = F.create_map(*[x for i, p in enumerate(params) for x in (F.lit(p), F.lit(i))])
    succ = markers.where(F.col("marker") == SUCCESS).select("run", "param").distinct()
    ax = (step_axis(field.where(F.col("param").isin(list(params))))
          .join(succ, ["run", "param"], "left_semi")
          .withColumn("_pos", F.try_element_at(pos, F.col("param"))))
    g = ax.groupBy("run").agg(
        F.array_sort(F.collect_list(F.struct("_pos", "param", "steps"))).alias("_e"),
        F.min_by("steps", "_pos").alias("steps"))
    g = g.withColumn("params", F.transform("_e", lambda e: e["param"]))
    by_param = F.to_json(F.map_from_entries(F.transform("_e", lambda e: F.struct(e["param"], e["steps"]))))
    grid_s = F.struct(F.lit(grid.LAT_MIN).alias("lat_min"), F.lit(grid.LAT_MAX).alias("lat_max"),
                      F.lit(grid.LON_MIN).alias("lon_min"), F.lit(grid.LON_MAX).alias("lon_max"),
                      F.lit(grid.GRID_NX).alias("nx"), F.lit(grid.GRID_NY).alias("ny"),
                      F.lit(grid.RES_DEG).alias("resolution"))
    chunks = F.struct(F.lit(grid.CHUNK_LAT).alias("latitude"), F.lit(grid.CHUNK_LON).alias("longitude"))
    doc = F.to_json(F.struct(F.col("run"), grid_s.alias("grid"), chunks.alias("chunks"), "params", "steps"))
    return g.select("run", F.size("params").alias("n_params"), doc.alias("index_json"),
                    by_param.alias("steps_by_param"))


def make_markers(keys: DataFrame, marker: str, payload: Column | None = None, ts: Column | None = None) -> DataFrame:
    """Marker rows (run, param, marker, payload, ts) to append to the marker table."""
    param = F.col("param") if "param" in keys.columns else F.lit(None).cast("string")
    return keys.select("run", param.alias("param"), F.lit(marker).alias("marker"),
                       (payload if payload is not None else F.lit(None).cast("string")).alias("payload"),
                       (ts if ts is not None else F.localtimestamp()).cast("timestamp_ntz").alias("ts"))


def promoted_payload(run: Column, params: Column, ts: Column) -> Column:
    """``{"run": .., "params": [sorted], "validated_at": ISO-8601 UTC}``."""
    iso = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return F.to_json(F.struct(run.alias("run"), F.sort_array(params).alias("params"), iso.alias("validated_at")))


def cleanup_select(existing: DataFrame, failed: DataFrame, prefixes=("staging", "runs")) -> DataFrame:
    """U4: paths to remove after a failed run: ``prefix/run/param`` for every
    failed (run, param) and the run's redirect marker, kept only if present
    in the store listing ``existing(path)``."""
    p = failed.select("run", "param").distinct().select(
        "run", "param", F.explode(F.array(*[F.lit(x) for x in prefixes])).alias("prefix"))
    data = p.select(F.concat_ws("/", "prefix", "run", "param").alias("path"))
    marker = failed.select(F.concat_ws("/", F.lit("staging"), "run", F.lit(RESOLVED)).alias("path"))
    return data.unionByName(marker).distinct().join(existing, "path", "left_semi")


def legacy_staging_select(existing: DataFrame, redirects: DataFrame, params: Sequence[str]) -> DataFrame:
    """U4 (legacy): ``staging/run/param`` of both the requested and the
    resolved run id of each redirect, if present."""
    rid = F.explode(F.array_distinct(F.array(F.col("run"), F.col("resolved_run")))).alias("rid")
    pr = F.explode(F.array(*[F.lit(p) for p in params])).alias("param")
    paths = redirects.select(rid).select("rid", pr).select(
        F.concat_ws("/", F.lit("staging"), "rid", "param").alias("path"))
    return paths.distinct().join(existing, "path", "left_semi")


