"""End-to-end jobs composed from the operators.

Each job is lazy until its sink; every stage is a DataFrame, so Catalyst sees
the whole plan and the only shuffles are the ones the operators declare.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid
from ..operators import derive, lifecycle, quality, remap, requests as req_ops, serving
from ..operators.joins import SMALL_SIDE_ROWS, bounded_broadcast
from ..sources import inventory, store, versions
from ..streaming import ratelimit


def cell_of_dst(df: DataFrame, col: str = "dst_id") -> DataFrame:
    """Regular-grid cell of a row-major target id (``iy * nx + ix``)."""
    return (df.withColumn("iy", (F.col(col) / grid.GRID_NX).cast("int"))
            .withColumn("ix", (F.col(col) % grid.GRID_NX).cast("int")))


def _keys(df: DataFrame) -> list[str]:
    return ["run", "param", *(["member"] if "member" in df.columns else []), "step"]


def expected_files(listing: DataFrame, manifest_rows: DataFrame | None = None,
                   members: int = inventory.ENSEMBLE_MEMBERS) -> DataFrame:
    """The listing's files among those expected (S2), pruned to what a
    manifest says exists (J8).  A listing with a member column is an ensemble's."""
    model = inventory.ENSEMBLE_MODEL if "member" in listing.columns else inventory.DETERMINISTIC_MODEL
    pairs = listing.select("run", "param").distinct()
    expected = inventory.expected_inventory(pairs, model, members).drop("file")
    if manifest_rows is not None:
        if "member" in listing.columns:
            # a manifest lists steps; they hold for every member
            kept = quality.prune_by_manifest(expected.select("run", "param", "step").distinct(), manifest_rows)
            expected = expected.join(kept, ["run", "param", "step"], "left_semi")
        else:
            expected = quality.prune_by_manifest(expected, manifest_rows)
    return expected.join(listing, _keys(listing), "left")


def ingest_failures(listing: DataFrame, manifest_rows: DataFrame | None = None,
                    members: int = inventory.ENSEMBLE_MEMBERS) -> DataFrame:
    """(run, param, error) of every listed pair that has no file left to ingest."""
    files = quality.drop_missing_steps(expected_files(listing, manifest_rows, members), fail_if_empty=False)
    pairs = listing.select("run", "param").distinct()
    return pairs.join(files.select("run", "param").distinct(), ["run", "param"], "left_anti").select(
        "run", "param", F.concat(F.col("param"), F.lit(" run="), F.col("run"),
                                 F.lit(": no forecast steps available")).alias("error"))


def failed_cleanup(existing: DataFrame, failures: DataFrame) -> DataFrame:
    """U4 for the failures of an ingest: the paths to remove."""
    return lifecycle.cleanup_select(existing, failures.select("run", "param"))


def ingest(native: DataFrame, weights: DataFrame, listing: DataFrame, root: str,
           manifest_rows: DataFrame | None = None, methods=None, ts=None,
           bucketed: bool = False, buckets: int | None = None, model: str | None = None,
           on_empty: str = "raise", members: int = inventory.ENSEMBLE_MEMBERS,
           zero_grid: tuple[int, int] = (grid.GRID_NY, grid.GRID_NX)) -> DataFrame:
    """3.1 Ingest: keep the steps a probe/manifest says exist (J8, P14), remap
    them (J1), add all-zero fields for tiny payloads (P10), publish (S4) -
    into the pixel-bucketed store with ``bucketed``, so later
    derivations need no shuffle.  Returns the success markers to append (S8).

    A listing with a member column is an ensemble's: its files are expected
    and its zero fields filled per member, and it is stored under the ensemble
    model.  A (run, param) without any step is an error (``on_empty="raise"``)
    or left without marker (``"skip"``, see :func:`ingest_failures` and
    :func:`failed_cleanup`).
    """
    ensemble = "member" in listing.columns
    model = model or (inventory.ENSEMBLE_MODEL if ensemble else inventory.DETERMINISTIC_MODEL)
    if on_empty == "raise":
        bad = [r["error"] for r in ingest_failures(listing, manifest_rows, members).limit(20).collect()]
        if bad:
            raise RuntimeError("; ".join(sorted(bad)))
    files = quality.drop_missing_steps(expected_files(listing, manifest_rows, members), fail_if_empty=False)
    keys = _keys(listing)
    big = files.where(F.col("n_bytes") >= quality.MIN_PAYLOAD_BYTES).select(*keys)
    # one row per file: broadcast after a size check (the native side has only
    # these few keys and must not be shuffled onto them)
    nat = native.join(bounded_broadcast(big, SMALL_SIDE_ROWS), keys, "left_semi")
    field = cell_of_dst(remap.remap_apply(nat, weights, methods)).select(
        "run", "param", "member", "step", "iy", "ix", F.col("value").cast("double").alias("value"))
    zeros = quality.zero_fill(files, *zero_grid)
    if not ensemble:
        zeros = zeros.withColumn("member", F.lit(0))
    out = field.unionByName(zeros)
    if bucketed:
        snap = store.field_commit_bucketed(out, root, buckets, model=model)
    else:
        snap = store.field_publish(out, root, model=model)
    return _success(native.sparkSession, snap, ts)


def _success(spark: SparkSession, snap: versions.Snapshot, ts) -> DataFrame:
    """Success markers of what a publication wrote: no more, and nothing is scanned for them."""
    done = spark.createDataFrame([k[1:] for k in snap.written()], "run string, param string")
    return lifecycle.make_markers(done, quality.SUCCESS, ts=ts)


def derive_pet(spark: SparkSession, root: str, markers: DataFrame, run: str | None = None, ts=None) -> DataFrame:
    """3.2 Derive PET for a run: follow its redirect (J7), read the seven
    inputs (S3), compute (W1, J4, D1), publish ``pet_pm`` (S4).  Returns the
    success marker row, made from what was published.

    A missing input, or inputs without a common cell and step, is an error and
    nothing is published.
    """
    req = spark.createDataFrame([(run,)], "run string")
    target = lifecycle.follow_redirect(req, markers).first()["run"]
    inputs = store.field_scan(spark, root, run=target, params=derive.PET_INPUTS)  # an error if one is missing
    pet = derive.pet_as_field(derive.pet_pm(inputs))
    if pet.isEmpty():
        raise RuntimeError(f"run={target}: the inputs share no cell and step")
    return _success(spark, store.field_publish(pet, root), ts)


# Texts of the point API's errors.
TOO_MANY = "Too many requests"
NO_LATEST = "Cannot resolve run: No latest run found"
FAILED = "Failed to retrieve data: "


def _error(text) -> F.Column:
    return F.to_json(F.struct((F.lit(text) if isinstance(text, str) else text).alias("error")))


def answer_points(requests: DataFrame, series: DataFrame, markers: DataFrame,
                  whitelist: Sequence[str] = req_ops.API_PARAMS, log: DataFrame | None = None,
                  limit: int = ratelimit.RATE_LIMIT, expiry_s: float = ratelimit.RATE_WINDOW_S,
                  ensemble_series: DataFrame | None = None) -> DataFrame:
    """3.3 Point queries in bulk: rate audit (R1), validation (P9), the latest
    run for requests that name none (T3), run existence for those that name
    one (J10), lookup (J5) and JSON bodies (A10), from ``ensemble_series`` for
    requests with ``ensemble=true``.  Returns (req_id, status, body): 200 with
    the series, else the error; every request is answered.
    """
    r = requests
    rejected = []
    if log is not None:
        audit = ratelimit.rate_audit(log, limit, expiry_s).select("req_id", "allowed")
        r = r.join(audit, "req_id", "left")
        rejected.append(r.where(F.col("allowed") == False).select(  # noqa: E712
            "req_id", F.lit(429).alias("status"), _error(TOO_MANY).alias("body")))
        r = r.where(F.coalesce(F.col("allowed"), F.lit(True))).drop("allowed")
    checked = req_ops.request_errors(r, whitelist)
    rejected.append(checked.where(F.col("error").isNotNull()).select(
        "req_id", F.lit(400).alias("status"), _error(F.col("error")).alias("body")))
    ok = checked.where(F.col("error").isNull()).drop("error")
    explicit = quality.run_exists(ok.where(F.col("run").isNotNull()), markers)
    rejected.append(explicit.where(F.col("error").isNotNull()).select(
        "req_id", F.lit(404).alias("status"), _error(F.col("error")).alias("body")))
    latest = lifecycle.latest_run(markers).scalar()
    implicit = ok.where(F.col("run").isNull()).withColumn("run", latest)
    rejected.append(implicit.where(F.col("run").isNull()).select(
        "req_id", F.lit(503).alias("status"), _error(NO_LATEST).alias("body")))
    names = ["req_id", "lat", "lon", "param", "run", "ensemble"]
    served = explicit.where(F.col("error").isNull()).select(*names).unionByName(
        implicit.where(F.col("run").isNotNull()).select(*names))
    point, members = served.where(~F.col("ensemble")).drop("ensemble"), served.where(F.col("ensemble")).drop("ensemble")
    bodies = serving.point_series_json(serving.point_lookup(series, point))
    if ensemble_series is not None:
        bodies = bodies.unionByName(serving.point_series_json(serving.point_lookup(ensemble_series, members), ensemble=True))
    out = bodies.select("req_id", F.lit(200).alias("status"), "body")
    # accepted requests whose cell holds no series (the chunk is absent)
    rejected.append(served.join(bodies.select("req_id"), "req_id", "left_anti").select(
        "req_id", F.lit(500).alias("status"),
        _error(F.concat(F.lit(FAILED + "no series of "), F.col("param"), F.lit(" in run "), F.col("run"))).alias("body")))
    for x in rejected:
        out = out.unionByName(x)
    return out


def promote(field: DataFrame, markers: DataFrame, run: str, params: Sequence[str], ensemble: bool = False,
            members: int = inventory.ENSEMBLE_MEMBERS, ts=None) -> dict[str, DataFrame]:
    """3.4a Validate one run (A7) and mark it promoted if every check passes:
    ``checks`` and ``promoted`` (one marker row, or none)."""
    ts_col = ts if ts is not None else F.localtimestamp()
    checks = quality.validate_run(field.where(F.col("run") == run), markers.where(F.col("run") == run), params,
                                  ensemble, members)
    passed = quality.run_verdict(checks).where("ok").select("run")
    arr = F.array(*[F.lit(p) for p in params])
    return {"checks": checks, "promoted": lifecycle.make_markers(
        passed, quality.PROMOTED, lifecycle.promoted_payload(F.col("run"), arr, ts_col), ts_col)}


def finalize(field: DataFrame, markers: DataFrame, run: str, params: Sequence[str], runs: DataFrame,
             staging: DataFrame | None = None, keep: int = 1, ts=None) -> dict[str, DataFrame]:
    """3.4b Publish one promoted run with all its layers (derived ones too).

    Refuses (an error) unless the run is promoted and every param has its
    success marker (A8).  Gives, in the order to apply them, its ``index``
    (S7), the ``latest`` pointer (S8, one row), what ``retention`` keeps (W3)
    and the ``orphans`` of the staging listing (U3); the run itself is kept by both.
    """
    ts_col = ts if ts is not None else F.localtimestamp()
    gate = quality.publish_gate(markers.where(F.col("run") == run), params)
    verdict = gate.first()  # one run
    if verdict is None or not verdict["promoted"]:
        raise RuntimeError(f"Refusing to finalize run={run}: it is not promoted")
    if verdict["missing"]:
        raise RuntimeError(f"Refusing to finalize run={run}: missing {quality.SUCCESS} for {verdict['missing']}")
    mine = field.where(F.col("run") == run)
    latest = lifecycle.make_markers(gate.select("run"), quality.LATEST, F.col("run"), ts_col)
    kept = lifecycle.retention_select(runs, run, keep)
    return {"gate": gate, "index": lifecycle.run_index(mine, markers, params), "latest": latest, "retention": kept,
            "orphans": lifecycle.orphan_staging(staging if staging is not None else runs.limit(0), kept, run)}


def validate_and_finalize(field: DataFrame, markers: DataFrame, run: str, params: Sequence[str], runs: DataFrame,
                          derived: Sequence[str] = (), staging: DataFrame | None = None, keep: int = 1,
                          ts=None) -> dict[str, DataFrame]:
    """3.4 Validate and promote one run on its base ``params``, then finalize
    it with the ``derived`` layers; an error if either refuses."""
    first = promote(field, markers, run, params, ts=ts)
    after = markers.unionByName(first["promoted"])
    return first | finalize(field, after, run, [*params, *derived], runs, staging, keep, ts)
