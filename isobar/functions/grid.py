"""Regular latitude/longitude grid: index <-> coordinate arithmetic as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the target grid (must equal the published layout):
# 1441 rows from +90 to -90 and 2879 columns from -180 to 179.75, step 0.125
# degrees; storage chunks of 100 x 100 cells with the whole step axis.
GRID_NY = 1441
GRID_NX = 2879
RES_DEG = 0.125
LAT_NORTH = 90.0
LON_WEST = -180.0
CHUNK_LAT = 100
CHUNK_LON = 100
LAT_MIN, LAT_MAX = -90.0, 90.0
LON_MIN, LON_MAX = -180.0, 180.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def js_round(x) -> Column:
    """Round half toward +infinity (``Math.round``), unlike Spark's HALF_UP."""
    return F.floor(_c(x) + F.lit(0.5))


def lat_to_iy(lat, ny: int = GRID_NY) -> Column:
    raw = js_round((F.lit(LAT_NORTH) - _c(lat)) / F.lit(RES_DEG))
    return F.least(F.greatest(raw, F.lit(0)), F.lit(ny - 1)).cast("int")


def lon_to_ix(lon, nx: int = GRID_NX, wrap: bool = False) -> Column:
    lon = _c(lon)
    if wrap:
        # any longitude folded into [-180, 180); on the full circle the grid
        # lacks the column 179.875, so points past 179.75 go to whichever of
        # 179.75 (last column) and 180 = -180 (column 0) is nearer
        norm = F.pmod(lon + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)
        raw = js_round((norm - F.lit(LON_WEST)) / F.lit(RES_DEG))
        last = LON_WEST + (nx - 1) * RES_DEG
        raw = F.when(raw >= F.lit(nx), F.when(norm >= F.lit((last + 180.0) / 2), F.lit(0)).otherwise(F.lit(nx - 1))
                     ).otherwise(raw)
    else:
        norm = F.when(lon > F.lit(180.0), lon - F.lit(360.0)).otherwise(lon)
        raw = js_round((norm - F.lit(LON_WEST)) / F.lit(RES_DEG))
    return F.least(F.greatest(raw, F.lit(0)), F.lit(nx - 1)).cast("int")


def iy_to_lat(iy) -> Column:
    return F.lit(LAT_NORTH) - _c(iy).cast("double") * F.lit(RES_DEG)


def ix_to_lon(ix) -> Column:
    return F.lit(LON_WEST) + _c(ix).cast("double") * F.lit(RES_DEG)


def chunk_of(idx, size: int = CHUNK_LAT) -> Column:
    return F.floor(_c(idx) / F.lit(size)).cast("int")


def local_of(idx, size: int = CHUNK_LAT) -> Column:
    return (_c(idx) % F.lit(size)).cast("int")


def run_init_time(run) -> Column:
    """``YYYYMMDDHH`` -> TIMESTAMP_NTZ (NULL when malformed)."""
    return F.try_to_timestamp(_c(run), F.lit("yyyyMMddHH")).cast("timestamp_ntz")


def run_cycle(run) -> Column:
    """The two-digit cycle hour of a run id."""
    return F.substring(_c(run), 9, 2)


def expected_steps_col(cycle) -> Column:
    """Forecast hours of a cycle: 0..78 hourly, then 81..max by 3 where
    max is 120 for the 06 and 18 cycles and 180 otherwise."""
    mx = F.when(_c(cycle).isin("06", "18"), F.lit(120)).otherwise(F.lit(180))
    return F.concat(F.sequence(F.lit(0), F.lit(78)), F.sequence(F.lit(81), mx, F.lit(3)))
