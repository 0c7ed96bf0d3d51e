"""Remapping from an unstructured source grid to the regular grid.

Weights are a sparse matrix stored as a table ``(method, dst_id, src_id, w)``.
Applying them is a distributed equi-join plus a grouped sum; building them is a
spatially binned join (k nearest neighbours, or box overlaps), never a cross
join of all sources with all targets.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.stats import round_half_up
from ..session import ensure_checkpoint_dir
from .joins import bounded_broadcast, dealt

EARTH_RADIUS_KM = 6371.0
RAD = math.pi / 180.0

# Parameters remapped conservatively (accumulated or flux
# fields); every other parameter uses distance weights.
CONSERVATIVE_PARAMS = ("tot_prec", "aswdir_s", "asob_s", "athb_s", "alhfl_s", "runoff_s", "runoff_g", "clct")
DEFAULT_METHODS = {p: "conservative" for p in CONSERVATIVE_PARAMS}

# Bin sizes (degrees) that divide both 180 and 360, used when widening a search.
BIN_LADDER = (0.125, 0.25, 0.5, 1.0, 2.0, 4.0, 5.0, 10.0, 20.0, 45.0, 90.0, 180.0)


def method_of(param: Column, methods: Mapping[str, str] | None = None, default: str = "distance") -> Column:
    methods = DEFAULT_METHODS if methods is None else methods
    m = F.create_map(*[x for k, v in methods.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, param), F.lit(default))


# Broadcasts pass through the driver: keep them to about 100 MB of weights.
# (The full 0.125 degree grid has about 16 M distance weights - it takes the
# co-located join, see :func:`remap_apply`.)
MAX_BROADCAST_WEIGHTS = 2_000_000


def prepare_weights(weights: DataFrame) -> DataFrame:
    """Weights with ``n_src`` (sources per target) - compute once, store with them."""
    n_src = F.count(F.lit(1)).over(Window.partitionBy("method", "dst_id"))
    return weights.select("method", "dst_id", "src_id", "w", n_src.alias("n_src"))


def remap_apply(native: DataFrame, weights: DataFrame, methods: Mapping[str, str] | None = None,
                na: str = "propagate", max_broadcast: int = MAX_BROADCAST_WEIGHTS, complete: bool = True) -> DataFrame:
    """``value[dst] = sum_src w * value[src]`` with the param's weight set.

    ``na="propagate"``: a target whose sources are not all present, or any
    of them NaN, is NaN.  ``na="renormalize"``: NaN or absent sources are
    skipped and the remaining weights rescaled to sum to one.  Every frame
    (run, param, member, step) gets every target of its weight set, NaN where
    no source is present (``complete=False`` leaves those rows out): the
    targets enter the sum as rows that add nothing.

    Plan: the weight table is fixed per grid pair and far smaller than the
    native data (all runs, params, members and steps).  Its row count is
    checked; up to ``max_broadcast`` rows it is broadcast and the native rows
    are never shuffled for the join.  Beyond it the join is keyed on
    ``src_id`` alone (the method is checked right after), so native and
    weight tables bucketed by ``src_id`` with the same bucket count
    (:func:`isobar.sources.store.native_publish_bucketed`,
    :func:`isobar.sources.store.weights_publish_bucketed`) join without any
    shuffle; otherwise both sides are shuffled by source.  The products are
    summed per target and step (one shuffle by target: with map-side partial
    sums, or for many rows dealt out so that a task's sums stay few).  Weights carrying ``n_src`` (:func:`prepare_weights`) skip the
    per-target window.
    """
    w = weights if "n_src" in weights.columns else prepare_weights(weights)
    w = w.select(F.col("method").alias("_wm"), "dst_id", "src_id", "w", "n_src")
    targets = w.select("_wm", "dst_id", "n_src").distinct()
    w = bounded_broadcast(w, max_broadcast, max_bytes=max_broadcast * 64, reuse="n_src" not in weights.columns)
    lead = [c for c in ("run", "param", "member") if c in native.columns]
    nat = native.withColumn("method", method_of(F.col("param"), methods))
    j = nat.join(w, "src_id").where(F.col("method") == F.col("_wm"))
    keys = lead + ["step", "dst_id"]
    j = j.select(*keys, "w", "value", "n_src", F.lit(1).alias("_here"))
    if complete:
        ensure_checkpoint_dir(nat.sparkSession)
        counted = nat.groupBy(*lead, "step", "method").agg(F.count(F.lit(1)).alias("_rows")).checkpoint()
        frames = bounded_broadcast(counted.drop("_rows"), max_broadcast, reuse=False)
        n_rows = counted.agg(F.sum("_rows")).first()[0] or 0
        grid_rows = targets.join(frames, F.col("_wm") == F.col("method")).select(
            *keys, F.lit(None).cast("double").alias("w"), F.lit(None).cast("double").alias("value"), "n_src",
            F.lit(0).alias("_here"))
        j = dealt(j.unionByName(grid_rows), 2 * n_rows, *keys)
    ok = ~F.isnan("value")
    if na == "propagate":
        agg = j.groupBy(*keys).agg(F.sum(F.col("w") * F.col("value")).alias("_s"),
                                   F.sum("_here").alias("_n"), F.max("n_src").alias("_m"))
        val = F.when(F.col("_n") == F.col("_m"), F.col("_s")).otherwise(F.lit(float("nan")))
    elif na == "renormalize":
        agg = j.groupBy(*keys).agg(F.sum(F.when(ok, F.col("w") * F.col("value"))).alias("_s"),
                                   F.sum(F.when(ok, F.col("w"))).alias("_ws"))
        val = F.coalesce(F.try_divide(F.col("_s"), F.col("_ws")), F.lit(float("nan")))
    else:
        raise ValueError("na must be 'propagate' or 'renormalize'")
    return agg.select(*keys, val.cast("float").alias("value"))


# ------------------------------------------------------------- k nearest (IDW)

def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = lat1 * F.lit(RAD), lat2 * F.lit(RAD)
    sdp = F.sin((p2 - p1) / 2)
    sdl = F.sin((lon2 - lon1) * F.lit(RAD) / 2)
    a = sdp * sdp + F.cos(p1) * F.cos(p2) * sdl * sdl
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.least(F.sqrt(a), F.lit(1.0)))


def _lat_bin(lat: Column, b: float) -> Column:
    return F.least(F.floor((lat + F.lit(90.0)) / F.lit(b)), F.lit(int(round(180 / b)) - 1)).cast("int")


def _lon_bin(lon: Column, b: float) -> Column:
    n = int(round(360 / b))
    return F.pmod(F.floor((lon + F.lit(180.0)) / F.lit(b)), F.lit(n)).cast("int")


#: Longitude bins on each side of a target's own, at most (about 86 degrees of latitude).
MAX_SIDE_BINS = 16


def _side_bins(lat: Column, b: float) -> Column:
    """Longitude bins on each side that a window needs to be about as wide as
    it is high: meridians converge, so their number grows with latitude."""
    edge = F.least(F.abs(lat) + F.lit(b), F.lit(89.9))
    return F.least(F.ceil(F.lit(1.0) / F.cos(edge * F.lit(RAD))), F.lit(min(MAX_SIDE_BINS, int(round(360 / b)) // 2))).cast("int")


def _guaranteed_km(lat: Column, lon: Column, b: float) -> Column:
    """Radius around a target inside which every source lies in its bin
    window (so the window's k nearest are the true k nearest)."""
    nlon = int(round(360 / b))
    inf = F.lit(float("inf"))
    bi = _lat_bin(lat, b)
    south_edge = (bi - 1).cast("double") * F.lit(b) - F.lit(90.0)
    north_edge = (bi + 2).cast("double") * F.lit(b) - F.lit(90.0)
    d_s = F.when(south_edge <= F.lit(-90.0), inf).otherwise(lat - south_edge)
    d_n = F.when(north_edge >= F.lit(90.0), inf).otherwise(north_edge - lat)
    side = _side_bins(lat, b)
    bj = F.floor((lon + F.lit(180.0)) / F.lit(b))
    west_edge = (bj - side).cast("double") * F.lit(b) - F.lit(180.0)
    east_edge = (bj + 1 + side).cast("double") * F.lit(b) - F.lit(180.0)
    delta = F.least(lon - west_edge, east_edge - lon)
    # nearest point of any meridian at least delta away (pole when >= 90)
    d_lon = F.when(2 * side + 1 >= F.lit(nlon), inf).when(delta >= 90.0, F.lit(90.0) - F.abs(lat)).otherwise(
        F.degrees(F.asin(F.cos(lat * F.lit(RAD)) * F.sin(delta * F.lit(RAD)))))
    return F.least(d_s, d_n, d_lon) * F.lit(RAD * EARTH_RADIUS_KM)


def _knn_pass(src: DataFrame, dst: DataFrame, k: int, b: float) -> DataFrame:
    nlat, nlon = int(round(180 / b)), int(round(360 / b))
    s = src.select("src_id", F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"),
                   _lat_bin(F.col("lat"), b).alias("bi"), _lon_bin(F.col("lon"), b).alias("bj"))
    bi, bj = _lat_bin(F.col("lat"), b), _lon_bin(F.col("lon"), b)
    side = _side_bins(F.col("lat"), b)
    row = F.array_distinct(F.transform(F.sequence(-side, side), lambda dj: F.pmod(bj + dj, F.lit(nlon)).cast("int")))
    nb = F.flatten(F.transform(F.array(*[F.lit(di) for di in (-1, 0, 1)]), lambda di: F.transform(
        row, lambda j: F.struct((bi + di).cast("int").alias("bi"), j.alias("bj")))))
    t = (dst.select("dst_id", F.col("lat").alias("t_lat"), F.col("lon").alias("t_lon"),
                    _guaranteed_km(F.col("lat"), F.col("lon"), b).alias("radius"),
                    F.explode(nb).alias("nb"))
         .select("dst_id", "t_lat", "t_lon", "radius", F.col("nb.bi").alias("bi"), F.col("nb.bj").alias("bj"))
         .where((F.col("bi") >= 0) & (F.col("bi") < nlat)))
    c = t.join(s, ["bi", "bj"]).select(
        "dst_id", "src_id", "radius",
        # kept to 1 mm: trig functions differ in the last bit between math
        # libraries, and ranks and weights must not depend on that
        round_half_up(haversine_km(F.col("t_lat"), F.col("t_lon"), F.col("s_lat"), F.col("s_lon")), 6).alias("dist"))
    rank = F.row_number().over(Window.partitionBy("dst_id").orderBy("dist", "src_id"))
    return c.withColumn("rank", rank).where(F.col("rank") <= k)


def auto_bin_deg(n_src: int, k: int) -> float:
    """Bin side (degrees) whose 3 x 3 window holds about 2k sources when the
    sources are spread over the globe."""
    side = math.sqrt(max(k, 1) * 2 * (360.0 * 180.0) / max(n_src, 1) / 9.0)
    return next((b for b in BIN_LADDER if b >= side), BIN_LADDER[-1])


# Nested bin sizes (each divides the previous one) for the coarse-to-fine search.
NESTED_BINS = (20.0, 10.0, 5.0, 1.0, 0.5, 0.25, 0.125)
_SLACK_KM = 0.001  # distances are kept to 1 mm; bounds get 1 m of slack


def _bin_box(bi: F.Column, bj: F.Column, b: float):
    s = F.lit(-90.0) + bi.cast("double") * F.lit(b)
    w = F.lit(-180.0) + bj.cast("double") * F.lit(b)
    return s, s + F.lit(b), w, w + F.lit(b)


def _box_bounds_km(t_lat: F.Column, t_lon: F.Column, bi: F.Column, bj: F.Column, b: float):
    """(lower, upper) great-circle distance from a point to any point of a bin.

    Lower: the larger of the latitude gap and the distance to the nearest
    meridian at the bin's longitude gap.  Upper: distance to the centre plus
    half the bin's extent in each direction (a path along a meridian and a
    parallel is never shorter than the geodesic)."""
    s, n, w, e = _bin_box(bi, bj, b)
    dlat = F.greatest(s - t_lat, t_lat - n, F.lit(0.0))
    inside = (t_lon >= w) & (t_lon <= e)
    dl = F.when(inside, F.lit(0.0)).otherwise(F.least(F.pmod(w - t_lon, F.lit(360.0)),
                                                      F.pmod(t_lon - e, F.lit(360.0))))
    lon_b = F.when(dl >= 90.0, F.lit(90.0) - F.abs(t_lat)).otherwise(
        F.degrees(F.asin(F.cos(t_lat * F.lit(RAD)) * F.sin(dl * F.lit(RAD)))))
    lower = F.greatest(dlat, lon_b) * F.lit(RAD * EARTH_RADIUS_KM)
    centre = haversine_km(t_lat, t_lon, (s + n) / 2, (w + e) / 2)
    upper = centre + F.lit(b * RAD * EARTH_RADIUS_KM)
    return lower, upper


def _prune_bins(pairs: DataFrame, k: int) -> DataFrame:
    """Keep the (target, bin) pairs that may hold one of the k nearest.

    Bins sorted by their upper bound: once they hold k sources, the k-th
    distance is at most that bound D; only bins whose lower bound is within D
    can hold a nearer source.  One window per target over its few bins."""
    by_upper = Window.partitionBy("dst_id").orderBy("upper", "bi", "bj").rowsBetween(Window.unboundedPreceding, 0)
    p = pairs.withColumn("_cum", F.sum("cnt").over(by_upper))
    d = F.min(F.when(F.col("_cum") >= k, F.col("upper"))).over(Window.partitionBy("dst_id"))
    p = p.withColumn("_d", F.coalesce(d, F.lit(float("inf"))))
    return p.where(F.col("lower") <= F.col("_d") + F.lit(_SLACK_KM)).drop("_cum", "_d")


def _knn_search(src: DataFrame, dst: DataFrame, k: int, finest: float) -> DataFrame:
    """Exact k nearest for any targets, coarse-to-fine over nested bins.

    Pairs are (target, non-empty bin), never (target, source), until the
    finest level, where only the surviving bins' sources are compared."""
    levels = [b for b in NESTED_BINS if b >= finest] or [NESTED_BINS[0]]
    counts = {b: src.groupBy(_lat_bin(F.col("lat"), b).alias("bi"), _lon_bin(F.col("lon"), b).alias("bj"))
              .agg(F.count(F.lit(1)).alias("cnt")) for b in levels}
    top = levels[0]
    # the coarse level has at most 9 x 18 non-empty bins: a bounded list
    # expanded per target by a generator, no join
    coarse = counts[top].select(F.sort_array(F.collect_list(F.struct("bi", "bj", "cnt")))).scalar()
    t = dst.select("dst_id", F.col("lat").alias("t_lat"), F.col("lon").alias("t_lon"))
    pairs = t.select("dst_id", "t_lat", "t_lon", F.explode(coarse).alias("c")).select(
        "dst_id", "t_lat", "t_lon", F.col("c.bi").alias("bi"), F.col("c.bj").alias("bj"), F.col("c.cnt").alias("cnt"))
    prev = top
    for i, b in enumerate(levels):
        if i > 0:
            r = int(round(prev / b))
            kids = pairs.select("dst_id", "t_lat", "t_lon",
                                F.explode(F.sequence(F.col("bi") * r, F.col("bi") * r + (r - 1))).alias("bi"),
                                F.col("bj"))
            kids = kids.select("dst_id", "t_lat", "t_lon", "bi",
                               F.explode(F.sequence(F.col("bj") * r, F.col("bj") * r + (r - 1))).alias("bj"))
            pairs = kids.join(counts[b], ["bi", "bj"])
            prev = b
        lo, up = _box_bounds_km(F.col("t_lat"), F.col("t_lon"), F.col("bi"), F.col("bj"), b)
        pairs = _prune_bins(pairs.withColumn("lower", lo).withColumn("upper", up), k)
    fine = levels[-1]
    s = src.select("src_id", F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"),
                   _lat_bin(F.col("lat"), fine).alias("bi"), _lon_bin(F.col("lon"), fine).alias("bj"))
    c = pairs.select("dst_id", "t_lat", "t_lon", "bi", "bj").join(s, ["bi", "bj"]).select(
        "dst_id", "src_id", F.lit(float("inf")).alias("radius"),
        round_half_up(haversine_km(F.col("t_lat"), F.col("t_lon"), F.col("s_lat"), F.col("s_lon")), 6).alias("dist"))
    rank = F.row_number().over(Window.partitionBy("dst_id").orderBy("dist", "src_id"))
    return c.withColumn("rank", rank).where(F.col("rank") <= k)


def idw_weights(src: DataFrame, dst: DataFrame, k: int = 4, bin_deg: float | None = None,
                method: str = "distance") -> DataFrame:
    """K nearest sources per target with inverse-distance weights (sum 1).

    Pass 1 compares each target with the sources of its bin window, three
    bins high and, as meridians converge, wider with latitude; a target is settled when it found k sources and the k-th lies within the
    radius that window guarantees (meridians converge towards the poles, the
    window wraps at the date line).  Settled targets are checkpointed.  The
    rest - targets in sparse regions - go through an exact coarse-to-fine
    search over nested bins (:func:`_knn_search`): no cap on candidates, and
    no pass pairs a target with all sources.  ``bin_deg=None`` derives the
    first bin from the source count.  A source at distance 0 takes all the
    weight.
    """
    if bin_deg is None:
        bin_deg = auto_bin_deg(src.count(), k)
    b0 = next((b for b in BIN_LADDER if b >= bin_deg), BIN_LADDER[-1])
    ensure_checkpoint_dir(dst.sparkSession)
    targets = dst.select("dst_id", "lat", "lon")
    top = _knn_pass(src, targets, k, b0)
    ok = (top.groupBy("dst_id").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("dk"),
                                    F.first("radius").alias("radius"))
          .where((F.col("n") == k) & (F.col("dk") < F.col("radius"))).select("dst_id"))
    settled = top.join(ok, "dst_id", "left_semi").checkpoint()
    remaining = targets.join(settled.select("dst_id").distinct(), "dst_id", "left_anti")
    cand = settled
    if not remaining.isEmpty():
        finest = max([b for b in NESTED_BINS if b <= b0] or [NESTED_BINS[-1]])
        cand = cand.unionByName(_knn_search(src, remaining, k, finest))
    wd = Window.partitionBy("dst_id")
    zero = F.min("dist").over(wd) == 0.0
    inv = F.when(zero, F.when(F.col("dist") == 0.0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(
        F.try_divide(F.lit(1.0), F.col("dist")))
    c = cand.withColumn("_inv", inv)
    w = F.col("_inv") / F.sum("_inv").over(wd)
    return c.select(F.lit(method).alias("method"), "dst_id", "src_id", "dist", "rank", w.alias("w"))


# ------------------------------------------------------------- box overlaps

def _pieces(boxes: DataFrame, id_col: str) -> DataFrame:
    """Split boxes that cross the date line into pieces inside [-180, 180]."""
    s = F.greatest(F.col("south"), F.lit(-90.0))
    n = F.least(F.col("north"), F.lit(90.0))
    w, e = F.col("west"), F.col("east")
    main = F.struct(F.greatest(w, F.lit(-180.0)).alias("w"), F.least(e, F.lit(180.0)).alias("e"))
    west_wrap = F.struct((w + 360.0).alias("w"), F.lit(180.0).alias("e"))
    east_wrap = F.struct(F.lit(-180.0).alias("w"), (e - 360.0).alias("e"))
    arr = F.filter(F.array(main, F.when(w < -180.0, west_wrap), F.when(e > 180.0, east_wrap)),
                   lambda x: x.isNotNull())
    return boxes.select(F.col(id_col), s.alias("s"), n.alias("n"), F.explode(arr).alias("p")).select(
        id_col, "s", "n", F.col("p.w").alias("w"), F.col("p.e").alias("e"))


def _bins(p: DataFrame, b: float) -> DataFrame:
    nlat, nlon = int(round(180 / b)), int(round(360 / b))
    i0 = F.least(F.floor((F.col("s") + 90.0) / b), F.lit(nlat - 1)).cast("int")
    i1 = F.least(F.floor((F.col("n") + 90.0) / b), F.lit(nlat - 1)).cast("int")
    j0 = F.least(F.floor((F.col("w") + 180.0) / b), F.lit(nlon - 1)).cast("int")
    j1 = F.least(F.floor((F.col("e") + 180.0) / b), F.lit(nlon - 1)).cast("int")
    return (p.withColumn("bi", F.explode(F.sequence(i0, i1)))
            .withColumn("bj", F.explode(F.sequence(j0, j1))))


def box_area_km2(s: Column, n: Column, w: Column, e: Column) -> Column:
    return (F.lit(EARTH_RADIUS_KM * EARTH_RADIUS_KM) * ((e - w) * F.lit(RAD))
            * (F.sin(n * F.lit(RAD)) - F.sin(s * F.lit(RAD))))


def overlap_bin_deg(src_boxes: DataFrame, dst_boxes: DataFrame) -> float:
    """Bin size for box overlaps: about twice the mean extent of the larger
    kind of box, so a box touches a few bins and a bin holds a few boxes."""
    extent = (F.col("north") - F.col("south") + F.col("east") - F.col("west")) / 2
    mean = max(b.agg(F.avg(extent)).first()[0] or 0.0 for b in (src_boxes, dst_boxes))
    return next((b for b in BIN_LADDER if b >= 2 * mean), BIN_LADDER[-1])


def overlap_candidates(src_boxes: DataFrame, dst_boxes: DataFrame, bin_deg: float) -> DataFrame:
    """Pairs of box pieces that touch a common bin."""
    sp = _bins(_pieces(src_boxes, "src_id"), bin_deg).select(
        "src_id", "bi", "bj", *[F.col(c).alias("s_" + c) for c in ("s", "n", "w", "e")])
    dp = _bins(_pieces(dst_boxes, "dst_id"), bin_deg).select(
        "dst_id", "bi", "bj", *[F.col(c).alias("d_" + c) for c in ("s", "n", "w", "e")])
    return dp.join(sp, ["bi", "bj"])


def conservative_weights(src_boxes: DataFrame, dst_boxes: DataFrame, bin_deg: float | None = None,
                         method: str = "conservative") -> DataFrame:
    """Overlap area / target area for rectangular (lat/lon) cells.

    A range join made equi: both sides are exploded into the bins they touch
    and joined on the bin; each overlapping pair is kept only in the bin that
    holds the south-west corner of its overlap, so no ``distinct`` is needed.
    Pieces of boxes split at the date line are summed per pair.  The bin
    size follows the boxes' own extents unless it is given.
    """
    if bin_deg is None:
        bin_deg = overlap_bin_deg(src_boxes, dst_boxes)
    b = next((x for x in BIN_LADDER if x >= bin_deg), BIN_LADDER[-1])
    j = overlap_candidates(src_boxes, dst_boxes, b)
    os_, on = F.greatest("s_s", "d_s"), F.least("s_n", "d_n")
    ow, oe = F.greatest("s_w", "d_w"), F.least("s_e", "d_e")
    nlat, nlon = int(round(180 / b)), int(round(360 / b))
    home_i = F.least(F.floor((os_ + 90.0) / b), F.lit(nlat - 1)).cast("int")
    home_j = F.least(F.floor((ow + 180.0) / b), F.lit(nlon - 1)).cast("int")
    ov = (j.where((on > os_) & (oe > ow) & (F.col("bi") == home_i) & (F.col("bj") == home_j))
          .select("dst_id", "src_id", box_area_km2(os_, on, ow, oe).alias("area")))
    per_pair = ov.groupBy("dst_id", "src_id").agg(F.sum("area").alias("area"))
    dst_area = dst_boxes.select("dst_id", box_area_km2(
        F.greatest(F.col("south"), F.lit(-90.0)), F.least(F.col("north"), F.lit(90.0)),
        F.col("west"), F.col("east")).alias("dst_area"))
    return (per_pair.join(dst_area, "dst_id")
            .select(F.lit(method).alias("method"), "dst_id", "src_id",
                    (F.col("area") / F.col("dst_area")).alias("w")))
