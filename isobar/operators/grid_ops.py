"""Point, cell and box operators on the regular grid."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import grid
from ..functions.stats import round4 as _round4, round_half_up
from .joins import SMALL_SIDE_ROWS, bounded_broadcast

EARTH_RADIUS_KM = 6371.0
MAX_BOX_PIXELS = 50000

# Units the point API reports per parameter ("unknown" otherwise).
PARAM_UNITS = {
    "t_2m": "K",
    "tot_prec": "mm",
    "u_10m": "m/s",
    "v_10m": "m/s",
    "pmsl": "Pa",
    "clct": "%",
    "relhum_2m": "%",
    "aswdir_s": "W/m²",
}
PRECIP_PARAMS = ("tot_prec",)


def point_to_cell(df: DataFrame, lat: str = "lat", lon: str = "lon", wrap: bool = False) -> DataFrame:
    """Nearest grid cell of a point, clamped to the grid, and its chunk.

    Adds iy, ix (global indices), cy, cx (chunk indices) and ly, lx (offsets
    inside the chunk).  Longitudes above 180 are shifted by -360; with
    ``wrap=True`` every longitude is folded and the seam wraps to column 0.
    """
    iy = grid.lat_to_iy(F.col(lat))
    ix = grid.lon_to_ix(F.col(lon), wrap=wrap)
    return (df.withColumn("iy", iy).withColumn("ix", ix)
            .withColumn("cy", grid.chunk_of(F.col("iy"), grid.CHUNK_LAT))
            .withColumn("cx", grid.chunk_of(F.col("ix"), grid.CHUNK_LON))
            .withColumn("ly", grid.local_of(F.col("iy"), grid.CHUNK_LAT))
            .withColumn("lx", grid.local_of(F.col("ix"), grid.CHUNK_LON)))


def cell_to_point(df: DataFrame) -> DataFrame:
    """Cell centre coordinates of (iy, ix)."""
    return df.withColumn("lat", grid.iy_to_lat("iy")).withColumn("lon", grid.ix_to_lon("ix"))


def valid_time(df: DataFrame) -> DataFrame:
    """P5: valid time = run start (``YYYYMMDDHH``) + step hours."""
    return df.withColumn("valid_time", grid.run_init_time("run") + F.make_dt_interval(hours=F.col("step")))


def round4(c) -> Column:
    """Four decimals rounding half toward +infinity."""
    return _round4(c)


def unit_of(param: Column, units: Mapping[str, str] | None = None) -> Column:
    units = PARAM_UNITS if units is None else units
    m = F.create_map(*[x for k, v in units.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, param), F.lit("unknown"))


def with_unit(df: DataFrame, units: Mapping[str, str] | None = None) -> DataFrame:
    """Unit of each row's param from a fixed map literal (no join)."""
    return df.withColumn("unit", unit_of(F.col("param"), units))


def box_indices(south, west, north, east) -> dict[str, Column]:
    """Inclusive index ranges of a box, clamped to the grid."""
    c = lambda x: F.lit(x) if isinstance(x, (int, float)) else (F.col(x) if isinstance(x, str) else x)
    return {
        "iy0": grid.lat_to_iy(c(north)), "iy1": grid.lat_to_iy(c(south)),
        "ix0": grid.lon_to_ix(c(west)), "ix1": grid.lon_to_ix(c(east)),
    }


def bbox_slice(field: DataFrame, south: float, west: float, north: float, east: float) -> DataFrame:
    """All steps of the cells inside a box.

    Index bounds are literals, so they reach the parquet scan as pushed
    filters; the derived chunk-row bounds prune ``cy`` partitions when the
    frame is a stored field.
    """
    b = box_indices(float(south), float(west), float(north), float(east))
    cond = F.col("iy").between(b["iy0"], b["iy1"]) & F.col("ix").between(b["ix0"], b["ix1"])
    if "cy" in field.columns:
        cond = cond & F.col("cy").between(grid.chunk_of(b["iy0"]), grid.chunk_of(b["iy1"]))
    if "cx" in field.columns:
        cond = cond & F.col("cx").between(grid.chunk_of(b["ix0"], grid.CHUNK_LON),
                                          grid.chunk_of(b["ix1"], grid.CHUNK_LON))
    return field.where(cond)


def bbox_guard(boxes: DataFrame, max_pixels: int = MAX_BOX_PIXELS) -> DataFrame:
    """Pixels and area (km2) of each box; ``ok`` when pixels <= max_pixels."""
    b = box_indices("south", "west", "north", "east")
    pixels = ((b["iy1"] - b["iy0"] + 1) * (b["ix1"] - b["ix0"] + 1)).cast("bigint")
    rad = F.lit(math.pi / 180.0)
    area = (F.lit(EARTH_RADIUS_KM * EARTH_RADIUS_KM) * ((F.col("east") - F.col("west")) * rad)
            * (F.sin(F.col("north") * rad) - F.sin(F.col("south") * rad)))
    # reported to 0.001 km2: the last bits of sin() differ between math libraries
    return (boxes.withColumn("pixels", pixels).withColumn("area_km2", round_half_up(area, 3))
            .withColumn("ok", F.col("pixels") <= F.lit(max_pixels)))


def precip_mask(field: DataFrame, params=None) -> DataFrame:
    """Drop cells that are 0.0 or NaN (for the listed params; all when None)."""
    keep = ~F.isnan("value") & (F.col("value") != 0.0)
    if params is not None:
        keep = keep | ~F.col("param").isin(list(params))
    return field.where(keep)



#: Cells on a side of the tiles that box queries are joined on.
TILE = 10


def bbox_slice_many(field: DataFrame, boxes: DataFrame, max_pixels: int = MAX_BOX_PIXELS) -> DataFrame:
    """P11 for a table of boxes ``(box_id, south, west, north, east)``.

    A range join made equi: each box is expanded to the 10 x 10 cell tiles it
    touches (about 500 for the largest allowed one), joined to the field on
    the tile, and filtered to its index ranges on the tiles at its edge, so a
    field row meets few boxes that do not hold it.  A box that P12 rejects
    comes back as one row without cell, with an ``error``.
    """
    guarded = bbox_guard(boxes, max_pixels)
    b = box_indices("south", "west", "north", "east")
    g = guarded.where("ok").select("box_id", *[v.alias(k) for k, v in b.items()])
    tile = lambda c: F.floor(c / TILE).cast("int")
    g = (g.withColumn("_ty", F.explode(F.sequence(tile(F.col("iy0")), tile(F.col("iy1")))))
         .withColumn("_tx", F.explode(F.sequence(tile(F.col("ix0")), tile(F.col("ix1"))))))
    f = field.withColumn("_ty", tile(F.col("iy"))).withColumn("_tx", tile(F.col("ix")))
    # (box, tile) rows are few per box: broadcast after a size check so the
    # field is not shuffled onto its few tile keys
    j = f.join(bounded_broadcast(g, SMALL_SIDE_ROWS), ["_ty", "_tx"])
    inside = F.col("iy").between(F.col("iy0"), F.col("iy1")) & F.col("ix").between(F.col("ix0"), F.col("ix1"))
    hit = j.where(inside).select(*field.columns, "box_id", F.lit(None).cast("string").alias("error"))
    text = F.concat(F.lit("Selected area is too large ("), F.col("pixels").cast("string"), F.lit(" pixels)"))
    none = [F.lit(None).cast(f_.dataType).alias(f_.name) for f_ in field.schema.fields]
    return hit.unionByName(guarded.where(~F.col("ok")).select(*none, "box_id", text.alias("error")))
