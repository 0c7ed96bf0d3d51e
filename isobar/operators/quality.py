"""Availability, completeness and validation checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import grid
from ..functions.stats import all_nan, nan_max, nan_min
from .joins import SMALL_SIDE_ROWS, bounded_broadcast

# Thresholds, member count and marker names.
MAX_MISSING_STEP_FRACTION = 0.15
ENSEMBLE_MEMBERS = 40
MIN_PAYLOAD_BYTES = 10000
SUCCESS, PROMOTED, LATEST, RESOLVED = "_SUCCESS", "_PROMOTED", "_LATEST_RUN", "_RESOLVED_RUN"

# Physical plausibility bounds (min, max) per parameter.
PARAM_BOUNDS = {
    "t_2m": (180.0, 340.0),
    "tot_prec": (0.0, 4000.0),
    "u_10m": (-150.0, 150.0),
    "v_10m": (-150.0, 150.0),
    "pmsl": (85000.0, 108000.0),
    "clct": (0.0, 100.0),
    "relhum_2m": (0.0, 110.0),
    "aswdir_s": (0.0, 1500.0),
    "td_2m": (180.0, 320.0),
    "vmax_10m": (0.0, 120.0),
    "asob_s": (-200.0, 1400.0),
    "athb_s": (-500.0, 300.0),
    "alhfl_s": (-800.0, 800.0),
    "ps": (40000.0, 110000.0),
    "runoff_s": (0.0, 500.0),
    "runoff_g": (0.0, 500.0),
}


def _lookup(mapping: Mapping, key: Column) -> Column:
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, key)


def _lead(df: DataFrame) -> list[str]:
    return [c for c in ("run", "param", "model") if c in df.columns]


# ---------------------------------------------------------------- availability

def availability_manifest(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """A1: per (run, param) the sorted available and missing steps.

    A file is available only when the listing has it with status 200 (a
    probe that failed for good counts as missing).
    """
    ok = listing.where(F.col("status") == 200).select("run", "param", "step", F.lit(True).alias("_ok"))
    j = expected.select("run", "param", "step").join(ok, ["run", "param", "step"], "left")
    present = F.col("_ok").isNotNull()
    return (j.groupBy("run", "param")
            .agg(F.sort_array(F.collect_list(F.when(present, F.col("step")))).alias("available"),
                 F.sort_array(F.collect_list(F.when(~present, F.col("step")))).alias("missing"),
                 F.count(F.lit(1)).alias("total_steps")))


def completeness_check(manifest: DataFrame, max_missing: float = MAX_MISSING_STEP_FRACTION) -> DataFrame:
    """A2: missing fraction per param and OK / BLOCKED (0 when nothing is expected)."""
    avail, miss = F.size("available"), F.size("missing")
    frac = F.coalesce(F.try_divide(miss.cast("double"), F.col("total_steps").cast("double")), F.lit(0.0))
    return manifest.select("run", "param", avail.alias("avail"), miss.alias("miss"), "total_steps",
                           frac.alias("frac"),
                           F.when(frac <= F.lit(max_missing), "OK").otherwise("BLOCKED").alias("status"))


def drop_missing_steps(expected_listing: DataFrame, fail_if_empty: bool = True) -> DataFrame:
    """Keep steps whose file exists (``n_bytes`` not NULL, status 200).

    With ``fail_if_empty`` a (run, param) without any file left raises an
    error inside the job (``raise_error``), so no separate action is needed.
    """
    present = F.col("n_bytes").isNotNull() & F.coalesce(F.col("status") == 200, F.lit(True))
    if not fail_if_empty:
        return expected_listing.where(present)
    w = Window.partitionBy("run", "param")
    n = F.sum(present.cast("int")).over(w)
    msg = F.concat(F.lit("no steps left for run="), F.col("run"), F.lit(" param="), F.col("param"))
    chk = F.when(n == 0, F.raise_error(msg).cast("boolean")).otherwise(F.lit(True))
    return expected_listing.withColumn("_chk", chk).where(F.col("_chk") & present).drop("_chk")


def zero_fill(listing: DataFrame, ny=grid.GRID_NY, nx=grid.GRID_NX, params: Sequence[str] | None = None,
              min_bytes: int = MIN_PAYLOAD_BYTES) -> DataFrame:
    """P10: a payload below ``min_bytes`` of a file that is available (status
    200) stands for an all-zero field.  A small error reply does not.

    Every such listing row expands to the full ny x nx grid by generators
    (``explode(sequence)``), no join; ``ny``/``nx`` may be Columns.  Grid
    rows are spread over all tasks (round robin, an explicit partition count
    that AQE keeps) before the columns are generated, so one small payload does
    not make one task emit a whole field.
    """
    small = listing.where((F.col("n_bytes") < F.lit(min_bytes)) & (F.col("status") == 200))
    if params is not None:
        small = small.where(F.col("param").isin(list(params)))
    ny = F.lit(ny) if isinstance(ny, int) else ny
    nx = F.lit(nx) if isinstance(nx, int) else nx
    keys = ["run", "param", *(["member"] if "member" in listing.columns else []), "step"]
    rows = (small.select(*keys, F.explode(F.sequence(F.lit(0), (ny - 1).cast("int"))).alias("iy"))
            .repartition(listing.sparkSession.sparkContext.defaultParallelism))
    return (rows.select(*keys, "iy", F.explode(F.sequence(F.lit(0), (nx - 1).cast("int"))).alias("ix"))
            .withColumn("value", F.lit(0.0)))


def prune_by_manifest(expected: DataFrame, manifest_rows: DataFrame) -> DataFrame:
    """Keep the expected (run, param, step) that the manifest lists as
    available; a (run, param) the manifest does not mention keeps all steps."""
    avail = manifest_rows.where(F.col("is_available")).select("run", "param", "step")
    listed = manifest_rows.select("run", "param").distinct()
    return (expected.join(avail, ["run", "param", "step"], "left_semi")
            .unionByName(expected.join(listed, ["run", "param"], "left_anti")))


# ---------------------------------------------------------------- field checks

def bounds_check(field: DataFrame, bounds: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """A3: NaN-skipping min / max per (run, param), all-NaN flag and whether
    the range lies inside the param's bounds (NULL for params without bounds).
    Bounds are a map literal, so the check adds no join."""
    bounds = PARAM_BOUNDS if bounds is None else bounds
    lo = _lookup({k: float(v[0]) for k, v in bounds.items()}, F.col("param"))
    hi = _lookup({k: float(v[1]) for k, v in bounds.items()}, F.col("param"))
    nan = F.lit(float("nan"))
    agg = (field.groupBy(*_lead(field))
           .agg(F.coalesce(nan_min("value"), nan).alias("vmin"),
                F.coalesce(nan_max("value"), nan).alias("vmax"),
                all_nan("value").alias("all_nan")))
    inside = (F.col("vmin") >= lo) & (F.col("vmax") <= hi) & ~F.isnan("vmin")
    return agg.withColumn("in_bounds", F.when(lo.isNotNull(), inside))


def frame_range(field: DataFrame, precip=("tot_prec",)) -> DataFrame:
    """Colour-scale range per param, NaN skipped; precipitation starts at 0."""
    agg = field.groupBy("param").agg(nan_min("value").alias("vmin"), nan_max("value").alias("vmax"))
    return agg.withColumn("vmin", F.when(F.col("param").isin(list(precip)), F.lit(0.0)).otherwise(F.col("vmin")))


def smoke_sample(field: DataFrame, size: int = 10) -> DataFrame:
    """A4: first step, first member, the size x size corner: all NaN -> fails.

    The first step comes from a per-(run, param) ``min`` (partial aggregation),
    the corner rows from a pushed-down filter; both sides are tiny.
    """
    lead = _lead(field)
    first = field.groupBy(*lead).agg(F.min("step").alias("step"))
    corner = field.where((F.col("iy") < size) & (F.col("ix") < size))
    if "member" in field.columns:
        corner = corner.where(F.col("member") == 0)
    hit = (corner.join(first, lead + ["step"], "left_semi")
           .groupBy(*lead).agg(all_nan("value").alias("all_nan")))
    return (first.join(hit, lead, "left")
            .select(*lead, F.coalesce(F.col("all_nan"), F.lit(True)).alias("all_nan")))


def nonempty_check(field: DataFrame, expected: DataFrame) -> DataFrame:
    """A5: rows and distinct steps of each expected (run, param); 0 means absent."""
    agg = field.groupBy("run", "param").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.count_distinct("step").alias("n_steps"))
    return (expected.select("run", "param").join(agg, ["run", "param"], "left")
            .select("run", "param", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                    F.coalesce("n_steps", F.lit(0)).alias("n_steps")))


def member_count(field: DataFrame, expected: int = ENSEMBLE_MEMBERS) -> DataFrame:
    """Distinct ensemble members per (run, param) against the expected count."""
    return (field.groupBy("run", "param").agg(F.count_distinct("member").alias("n_members"))
            .withColumn("ok", F.col("n_members") == F.lit(expected)))


# ---------------------------------------------------------------- markers

def missing_markers(expected: DataFrame, markers: DataFrame, marker: str = SUCCESS) -> DataFrame:
    """Expected (run, param) without the marker (anti join)."""
    m = markers.where(F.col("marker") == marker).select("run", "param")
    return expected.select("run", "param").join(m, ["run", "param"], "left_anti")


def run_exists(requests: DataFrame, markers: DataFrame) -> DataFrame:
    """A request naming a run needs that run's success marker for its param.

    Returns every request with ``error`` (NULL when accepted); requests
    without a run are served from the latest run and pass.
    """
    succ = (markers.where(F.col("marker") == SUCCESS).select("run", "param").distinct()
            .withColumn("_ok", F.lit(True)))
    # markers are per (run, param): a checked broadcast keeps the (large)
    # request table from being shuffled onto those few keys
    j = requests.join(bounded_broadcast(succ, SMALL_SIDE_ROWS), ["run", "param"], "left")
    err = F.when(F.col("run").isNotNull() & F.col("_ok").isNull(),
                 F.concat(F.lit("Run "), F.col("run"), F.lit(" not found or not yet promoted for "),
                          F.coalesce(F.col("param"), F.lit(""))))
    return j.withColumn("error", err).drop("_ok")


def expected_pairs(runs: DataFrame, params: Sequence[str]) -> DataFrame:
    """(run, param) for every run and every listed param (a generator, no join)."""
    arr = F.array(*[F.lit(p) for p in params])
    return runs.select("run").distinct().select("run", F.explode(arr).alias("param"))


def validate_run(field: DataFrame, markers: DataFrame, params: Sequence[str], ensemble: bool = False,
                 members: int = ENSEMBLE_MEMBERS) -> DataFrame:
    """One verdict row per (run, param, check); the field is read once.

    Checks: success marker, non-empty field, step-0 corner not all NaN and,
    for ensembles, the member count.
    """
    size = F.lit(10)
    valid = (F.col("iy") < size) & (F.col("ix") < size) & ~F.isnan("value") & F.col("value").isNotNull()
    members_c, first = F.lit(None).cast("int"), F.lit(0)
    if "member" in field.columns:
        members_c, first = F.col("member"), F.col("member")
    # the only pass over the field: per (run, param) and step the row count,
    # whether the corner of the first member has a valid value, and the members
    steps = (field.groupBy("run", "param", "step")
             .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(valid & (first == 0)), F.lit(False)).alias("valid"),
                  F.collect_set(members_c).alias("members")))
    per_param = (steps.groupBy("run", "param")
                 .agg(F.sum("n").alias("n"), F.min_by("valid", "step").alias("valid"),
                      F.size(F.array_distinct(F.flatten(F.collect_list("members")))).alias("n_members")))
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(field.sparkSession)
    per_param = per_param.checkpoint()  # a row per (run, param); read by every check below
    runs = per_param.select("run").unionByName(markers.select("run")).distinct()
    exp = expected_pairs(runs, params)
    succ = (markers.where(F.col("marker") == SUCCESS).select("run", "param").distinct()
            .withColumn("ok", F.lit(True)))
    c_marker = exp.join(succ, ["run", "param"], "left").select(
        "run", "param", F.lit("success_marker").alias("check"), F.coalesce("ok", F.lit(False)).alias("ok"))
    seen = exp.join(per_param, ["run", "param"], "left")
    c_nonempty = seen.select("run", "param", F.lit("nonempty").alias("check"), (F.coalesce("n", F.lit(0)) > 0).alias("ok"))
    c_smoke = seen.select("run", "param", F.lit("smoke_sample").alias("check"), F.coalesce("valid", F.lit(False)).alias("ok"))
    out = c_marker.unionByName(c_nonempty).unionByName(c_smoke)
    if ensemble:
        out = out.unionByName(seen.select("run", "param", F.lit("member_count").alias("check"),
                                          F.coalesce(F.col("n_members") == members, F.lit(False)).alias("ok")))
    return out


def run_verdict(checks: DataFrame) -> DataFrame:
    """A7 (run level): a run passes when every check of every param passes."""
    return checks.groupBy("run").agg(F.bool_and("ok").alias("ok"))


def publish_gate(markers: DataFrame, params: Sequence[str]) -> DataFrame:
    """A run may be published iff it is promoted and no advertised param
    lacks its success marker.  One row per run: (run, missing, promoted, ok)."""
    runs = markers.select("run").distinct()
    miss = missing_markers(expected_pairs(runs, params), markers)
    missing = miss.groupBy("run").agg(F.sort_array(F.collect_list("param")).alias("missing"))
    prom = markers.where(F.col("marker") == PROMOTED).select("run").distinct().withColumn("promoted", F.lit(True))
    return (runs.join(missing, "run", "left").join(prom, "run", "left")
            .select("run", F.coalesce("missing", F.array().cast("array<string>")).alias("missing"),
                    F.coalesce("promoted", F.lit(False)).alias("promoted"))
            .withColumn("ok", F.col("promoted") & (F.size("missing") == 0)))
