"""Physical formulas as Spark Columns (all DOUBLE arithmetic)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the hourly FAO-56 Penman-Monteith product.
KELVIN = 273.15
MAGNUS_A = 0.6108
MAGNUS_B = 17.27
MAGNUS_C = 237.3
WIND_10M_TO_2M = 4.87 / math.log(67.8 * 10.0 - 5.42)
W_M2_TO_MJ_M2_H = 0.0036
PSYCHRO = 0.000665
SLOPE_NUM = 4098.0
RAD_COEF = 0.408
AERO_COEF = 37.0
WIND_COEF = 0.34

# Unit conversions used for display: (scale, offset) so that out = v * scale + offset.
UNIT_CONVERSIONS = {
    "t_2m": (1.0, -KELVIN),
    "td_2m": (1.0, -KELVIN),
    "asob_s": (W_M2_TO_MJ_M2_H, 0.0),
    "athb_s": (W_M2_TO_MJ_M2_H, 0.0),
    "aswdir_s": (W_M2_TO_MJ_M2_H, 0.0),
    "ps": (1.0 / 1000.0, 0.0),
    "pmsl": (1.0 / 1000.0, 0.0),
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_if_null(x: Column) -> Column:
    return F.coalesce(x, F.lit(float("nan")))


def is_finite(x: Column) -> Column:
    """True for finite numbers; NaN and +-inf give False (NaN > +inf in Spark)."""
    return F.abs(x) < F.lit(float("inf"))


def _saturation(t: Column) -> Column:
    """Saturation vapour pressure (kPa) at t degrees Celsius."""
    return F.lit(MAGNUS_A) * F.exp(nan_if_null(F.try_divide(F.lit(MAGNUS_B) * t, t + F.lit(MAGNUS_C))))


def _inputs(t_k, td_k, u10, v10, asob, athb, ps_pa) -> dict[str, Column]:
    return {"t": _c(t_k) - F.lit(KELVIN), "td": _c(td_k) - F.lit(KELVIN),
            "u2": F.hypot(_c(u10), _c(v10)) * F.lit(WIND_10M_TO_2M),
            "rn": (_c(asob) + _c(athb)) * F.lit(W_M2_TO_MJ_M2_H),
            "gamma": F.lit(PSYCHRO) * (_c(ps_pa) / F.lit(1000.0))}


def _deficit_and_slope(x: dict[str, Column]) -> dict[str, Column]:
    tk = x["t"] + F.lit(MAGNUS_C)
    d = x["es"] - x["ea"]
    return {"vpd": F.when(d < F.lit(0.0), F.lit(0.0)).otherwise(d),
            "delta": nan_if_null(F.try_divide(F.lit(SLOPE_NUM) * x["es"], tk * tk))}


def _et0(x: dict[str, Column]) -> Column:
    num = (F.lit(RAD_COEF) * x["delta"] * x["rn"]
           + x["gamma"] * nan_if_null(F.try_divide(F.lit(AERO_COEF), x["t"] + F.lit(KELVIN))) * x["u2"] * x["vpd"])
    den = x["delta"] + x["gamma"] * (F.lit(1.0) + F.lit(WIND_COEF) * x["u2"])
    return nan_if_null(F.try_divide(num, den))


def pet_pm(t_k, td_k, u10, v10, asob, athb, ps_pa) -> Column:
    """Hourly reference evapotranspiration (mm/h) from seven surface fields.

    Negative results become 0, non-finite ones NaN; returned as FLOAT.
    Divisions whose denominator is data use ``try_divide`` (ANSI mode would
    raise), and a NULL quotient is turned into NaN like IEEE arithmetic.
    """
    x = _inputs(t_k, td_k, u10, v10, asob, athb, ps_pa)
    x |= {"es": _saturation(x["t"]), "ea": _saturation(x["td"])}
    et0 = _et0(x | _deficit_and_slope(x))
    et0 = F.when(is_finite(et0), et0).otherwise(F.lit(float("nan")))
    return F.when(et0 < F.lit(0.0), F.lit(0.0)).otherwise(et0).cast("float")


def with_pet_pm(df, lead, t_k="t_2m", td_k="td_2m", u10="u_10m", v10="v_10m", asob="asob_s",
                athb="athb_s", ps_pa="ps", out="pet_pm"):
    """:func:`pet_pm` as staged projections over a DataFrame.

    Each stage is a separate ``select``; Catalyst keeps a projection whose
    non-trivial columns are used more than once instead of inlining them, so
    ``exp`` and the slope term are evaluated once per row (same arithmetic, so
    the same doubles as :func:`pet_pm`).
    """
    keep = list(lead)

    def stage(frame, new: dict[str, Column], carry=()):
        return frame.select(*keep, *[F.col("_" + c) for c in carry], *[v.alias("_" + k) for k, v in new.items()])

    x = {k: F.col("_" + k) for k in ("t", "td", "u2", "rn", "gamma", "es", "ea", "vpd", "delta")}
    a = stage(df, _inputs(t_k, td_k, u10, v10, asob, athb, ps_pa))
    b = stage(a, {"es": _saturation(x["t"]), "ea": _saturation(x["td"])}, ("t", "u2", "rn", "gamma"))
    c = stage(b, _deficit_and_slope(x), ("t", "u2", "rn", "gamma"))
    d = stage(c, {"et0": _et0(x)})
    et0 = F.col("_et0")
    e = stage(d, {"et0": F.when(is_finite(et0), et0).otherwise(F.lit(float("nan")))})
    return e.select(*keep, F.when(et0 < F.lit(0.0), F.lit(0.0)).otherwise(et0).cast("float").alias(out))
