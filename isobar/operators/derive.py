"""Field shaping and the derived PET product."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import grid
from ..functions import physics
from .joins import SMALL_SIDE_ROWS, bounded_broadcast
from .keys import field_keys
from .temporal import ACCUMULATED_MEANS, deaccumulate

# The seven inputs of the PET product.
PET_INPUTS = ("t_2m", "td_2m", "u_10m", "v_10m", "asob_s", "athb_s", "ps")

_LAT_NAMES = ("latitude", "lat")
_LON_NAMES = ("longitude", "lon")
_KNOWN = {"run", "param", "member", "model", "step", "iy", "ix", "height", "time", "valid_time"}


def normalize_field(raw: DataFrame, param: str | None = None) -> DataFrame:
    """Bring a remapped frame to the field layout.

    Accepts ``lat``/``latitude`` and ``lon``/``longitude`` coordinates in
    degrees (either orientation), drops ``*_bnds`` columns and a constant
    ``time``, and renames the sole data column to ``value`` with
    ``param`` as a literal.  Without ``param`` the frame has a ``param``
    column and all its params are normalised in the one pass.  Row indices are
    recomputed from coordinates, so the result always runs north to south.
    """
    cols = [c for c in raw.columns if not c.endswith("_bnds")]
    lat = next((c for c in _LAT_NAMES if c in cols), None)
    lon = next((c for c in _LON_NAMES if c in cols), None)
    if lat is None or lon is None:
        raise ValueError("normalize_field needs latitude and longitude columns")
    data = [c for c in cols if c not in _KNOWN and c not in (lat, lon)]
    if param is None and "param" not in cols:
        raise ValueError("name the param, or give a frame with a param column")
    if param is not None and param in data:
        var = param
    elif len(data) == 1:
        var = data[0]
    else:
        raise KeyError(f"variable {param!r} not found among {data}")
    keep = [c for c in ("run", *(["param"] if param is None else []), "member", "step", "height") if c in cols]
    out = raw.select(*keep,
                     grid.lat_to_iy(F.col(lat)).alias("iy"),
                     grid.lon_to_ix(F.col(lon)).alias("ix"),
                     F.col(var).cast("double").alias("value"))
    order = [c for c in ("run",) if c in out.columns] + ["param"] + \
        [c for c in ("member", "step", "height") if c in out.columns] + ["iy", "ix", "value"]
    if param is not None:
        out = out.withColumn("param", F.lit(param))
    return out.select(*order)


def squeeze_level(df: DataFrame, col: str = "height") -> DataFrame:
    """Keep the first level of the vertical axis and drop the axis.

    Level columns hold coordinates (2.0 m, 10.0 m, ..): the first level of
    each (run, param) is its least, found by a ``min`` and joined back as a
    checked small side.  A field without level coordinate (NULL throughout) is
    kept whole.  Frames without such a column pass through.
    """
    level = next((c for c in df.columns if col in c.lower()), None)
    if level is None:
        return df
    lead = [c for c in ("run", "param", "model") if c in df.columns]
    if not lead:
        return df.where(F.col(level).eqNullSafe(df.select(F.min(level)).scalar())).drop(level)
    first = df.groupBy(*lead).agg(F.min(level).alias("_first"))
    return (df.join(bounded_broadcast(first, SMALL_SIDE_ROWS), lead)
            .where(F.col(level).eqNullSafe(F.col("_first"))).drop(level, "_first"))


def convert_units(df: DataFrame, mapping: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """``value * scale + offset`` for the listed params (K->C, W/m2->MJ/m2/h, Pa->kPa)."""
    mapping = physics.UNIT_CONVERSIONS if mapping is None else mapping
    scale = F.lit(1.0)
    offset = F.lit(0.0)
    for p, (s, o) in mapping.items():
        scale = F.when(F.col("param") == p, F.lit(float(s))).otherwise(scale)
        offset = F.when(F.col("param") == p, F.lit(float(o))).otherwise(offset)
    conv = F.when(F.col("param").isin(list(mapping)), F.col("value") * scale + offset).otherwise(F.col("value"))
    return df.withColumn("value", conv)


def align_params(field: DataFrame, params: Sequence[str]) -> DataFrame:
    """One row per (run, [member], step, iy, ix) with one column per param.

    A 7-way inner alignment done as ONE grouped aggregation: rows of the
    listed params are grouped by cell and step, every param becomes a column
    and groups missing any param (no row, or only NULL) are dropped.
    """
    params = list(params)
    keys = [c for c in field_keys(field, with_param=False)]
    lead = [c for c in keys if c not in ("iy", "ix")]
    f = field.where(F.col("param").isin(params))
    aggs = [F.max(F.when(F.col("param") == p, F.col("value"))).alias(p) for p in params]
    return _complete(f.groupBy(*lead, "step", "iy", "ix").agg(*aggs), params)


def _complete(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which no listed column is NULL (NaN is a value)."""
    for c in columns:
        rows = rows.where(F.col(c).isNotNull())
    return rows


def pet_pm(field: DataFrame, accumulated=ACCUMULATED_MEANS, co_located: bool = False) -> DataFrame:
    """Hourly FAO-56 Penman-Monteith reference evapotranspiration.

    Radiation inputs are de-accumulated (W1), the seven inputs aligned (J4)
    and the formula applied as staged projections.  The field is
    hash-partitioned once by (run, iy, ix): that partitioning satisfies both
    the per-pixel window of W1 and the per-(run, step, cell) grouping of J4,
    so the whole derivation costs a single shuffle.  ``co_located`` states that
    the field already is (a scan of the store bucketed by pixel): none is added.
    """
    keys = [c for c in field_keys(field, with_param=False)]
    f = field.where(F.col("param").isin(list(PET_INPUTS)))
    if not co_located:
        f = f.repartition(*keys)
    f = deaccumulate(f, accumulated)
    a = align_params(f, PET_INPUTS)
    lead = [c for c in keys if c not in ("iy", "ix")]
    return physics.with_pet_pm(a, lead + ["step", "iy", "ix"])


def pet_as_field(pet: DataFrame) -> DataFrame:
    """The PET product in field layout (param ``pet_pm``)."""
    lead = [c for c in ("run", "member") if c in pet.columns]
    return pet.select(*lead[:1], F.lit("pet_pm").alias("param"), *lead[1:], "step", "iy", "ix",
                      F.col("pet_pm").cast("double").alias("value"))


def pet_pm_series(series: DataFrame) -> DataFrame:
    """D1 on the series layout (one row per pixel with step arrays).

    Radiation series are de-accumulated in place (array ``transform``, no
    shuffle), the seven series of a pixel meet in one grouped row (a shuffle
    by pixel; none when the store is co-partitioned by pixel), and PET is
    evaluated per common step inside ``transform``.  Output: (run, [member],
    cy, cx, iy, ix, steps, pet_pm) with float values.
    """
    from .serving import deaccumulate_series

    lead = [c for c in ("run", "model", "member") if c in series.columns]
    s = deaccumulate_series(series.where(F.col("param").isin(list(PET_INPUTS))))
    aggs = [F.max(F.when(F.col("param") == p, F.struct("steps", "vals"))).alias(p) for p in PET_INPUTS]
    g = s.groupBy(*lead, "cy", "cx", "iy", "ix").agg(*aggs)
    g = _complete(g, PET_INPUTS)
    common = F.col(f"{PET_INPUTS[0]}.steps")
    for p in PET_INPUTS[1:]:
        common = F.array_intersect(common, F.col(f"{p}.steps"))
    g = g.withColumn("steps", common).where(F.size("steps") > 0)

    def at(p, step):
        return F.element_at(F.col(f"{p}.vals"), F.array_position(F.col(f"{p}.steps"), step).cast("int")).cast("double")

    pet = F.transform("steps", lambda st: physics.pet_pm(*[at(p, st) for p in PET_INPUTS]))
    return g.select(*lead, "cy", "cx", "iy", "ix", "steps", pet.alias("pet_pm"))
