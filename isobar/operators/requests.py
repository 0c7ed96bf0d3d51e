"""Request validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Parameters the point API serves, in the order its error text lists them.
API_PARAMS = ("t_2m", "tot_prec", "u_10m", "v_10m", "pmsl", "clct", "relhum_2m", "aswdir_s")


def _number(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, NumericType):
        return c.cast("double")
    # strict: a numeric prefix such as "52abc" is not a number
    return c.try_cast("double")


def _present(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, NumericType):
        return c.isNotNull()
    return c.isNotNull() & (c != "")


def request_errors(df: DataFrame, whitelist: Sequence[str] = API_PARAMS) -> DataFrame:
    """Adds lat/lon as numbers, ``ensemble`` as boolean and ``error``
    (NULL when the request is valid; otherwise the first failing rule)."""
    lat, lon = _number(df, "lat"), _number(df, "lon")
    missing = ~(_present(df, "lat") & _present(df, "lon") & _present(df, "param"))
    bad_lat = lat.isNull() | F.isnan(lat) | (lat < -90.0) | (lat > 90.0)
    bad_lon = lon.isNull() | F.isnan(lon) | (lon < -180.0) | (lon > 360.0)
    bad_param = ~F.col("param").isin(list(whitelist))
    has_run = F.col("run").isNotNull() & (F.col("run") != "")
    bad_run = has_run & ~F.col("run").rlike(r"^[0-9]{10}$")
    err = (F.when(missing, F.lit("Missing required parameters: lat, lon, param"))
           .when(bad_lat, F.lit("lat must be a number in [-90, 90]"))
           .when(bad_lon, F.lit("lon must be a number in [-180, 360]"))
           .when(bad_param, F.lit("param must be one of: " + ", ".join(whitelist)))
           .when(bad_run, F.lit("run must be in YYYYMMDDHH format (10 digits)")))
    ens = F.coalesce(F.col("ensemble") == F.lit("true"), F.lit(False)) if "ensemble" in df.columns else F.lit(False)
    # one projection: every rule sees the raw input columns
    new = {"lat": lat, "lon": lon, "ensemble": ens, "run": F.when(has_run, F.col("run"))}
    cols = [new[c].alias(c) if c in new else F.col(c) for c in df.columns]
    cols += [v.alias(k) for k, v in new.items() if k not in df.columns]
    return df.select(*cols, err.alias("error"))


def validate_requests(df: DataFrame, whitelist: Sequence[str] = API_PARAMS) -> tuple[DataFrame, DataFrame]:
    """Split requests into (valid, rejected-with-error)."""
    e = request_errors(df, whitelist)
    return e.where(F.col("error").isNull()).drop("error"), e.where(F.col("error").isNotNull())
