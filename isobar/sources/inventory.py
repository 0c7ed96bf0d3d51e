"""Expected forecast inventory of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import expected_steps_col, run_cycle

# The published file naming of the forecast source.
# Path: <model>/grib/<HH>/<param>/<name>; name:
#   <prefix>_icosahedral_single-level_<run>_<step %03d>[_<member+1 %03d>]_<PARAM>.grib2.bz2
DETERMINISTIC_MODEL = "icon"
ENSEMBLE_MODEL = "icon-eps"
FILE_PREFIX = {"icon": "icon_global", "icon-eps": "icon_eps"}
FILE_SUFFIX = ".grib2.bz2"
ENSEMBLE_MEMBERS = 40


def expected_steps(spark: SparkSession, cycle: str) -> DataFrame:
    """Forecast hours of one cycle ("00", "06", "12", "18")."""
    return spark.range(1).select(F.explode(expected_steps_col(F.lit(cycle))).alias("step"))


def with_expected_steps(runs: DataFrame) -> DataFrame:
    """S1 per row: one output row per expected step of the row's run."""
    return runs.withColumn("step", F.explode(expected_steps_col(run_cycle(F.col("run")))))


def file_name(run, param, step, member=None, model: str = DETERMINISTIC_MODEL) -> F.Column:
    """The source file name of one (run, param, step[, member])."""
    parts = [F.lit(f"{FILE_PREFIX[model]}_icosahedral_single-level_"), run, F.lit("_"),
             F.format_string("%03d", step)]
    if member is not None:
        parts += [F.lit("_"), F.format_string("%03d", member + 1)]
    parts += [F.lit("_"), F.upper(param), F.lit(FILE_SUFFIX)]
    return F.concat(*parts)


def expected_inventory(pairs: DataFrame, model: str = DETERMINISTIC_MODEL, members: int = ENSEMBLE_MEMBERS) -> DataFrame:
    """Every expected (run, param, [member], step) file of the given
    (run, param) pairs, with its relative path ``model/grib/HH/param/name``.

    Ensemble members are stored 0-based and named 1-based.
    """
    rows = with_expected_steps(pairs.select("run", "param"))
    member = None
    if model == ENSEMBLE_MODEL:
        rows = rows.withColumn("member", F.explode(F.sequence(F.lit(0), F.lit(members - 1))))
        member = F.col("member")
    name = file_name(F.col("run"), F.col("param"), F.col("step"), member, model)
    path = F.concat_ws("/", F.lit(model), F.lit("grib"), run_cycle(F.col("run")), F.col("param"), name)
    cols = ["run", "param"] + (["member"] if member is not None else []) + ["step"]
    return rows.select(*cols, path.alias("file"))

