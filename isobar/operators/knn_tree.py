"""Nearest-source weights over an adaptive quadtree (J2 for sources of very uneven density).

The globe is halved in latitude and longitude again and again; a cell is split
only while it holds more than ``leaf`` sources, so cells are small where sources
are dense and large where they are sparse.  A cell's name is its path: level and
position.  Targets descend the tree level by level and keep only the cells that
can still hold one of their k nearest, until all of these are leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.stats import round_half_up
from ..session import ensure_checkpoint_dir
from .joins import bounded_broadcast
from .remap import _SLACK_KM, EARTH_RADIUS_KM, RAD, _box_bounds_km, haversine_km

#: A cell of level L spans 180 / 2^L degrees.  The tree starts with the 128
#: cells of level 3 and goes down two levels (16 children) at a time; cells of
#: the last level are 38 m high and are leaves whatever they hold.
FIRST_LEVEL, LAST_LEVEL, STEP = 3, 19, 2
LEAF = 32
#: Targets that one task takes down the tree, and rows of a side table that the driver may broadcast.
TARGETS_PER_TASK, BROADCAST_ROWS = 4_000, 400_000


def _side(level: int) -> float:
    return 180.0 / (1 << level)


def _cell(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Position of a point's cell at the last level."""
    n = 1 << LAST_LEVEL
    i = F.least(F.floor((lat + 90.0) / F.lit(_side(LAST_LEVEL))), F.lit(n - 1))
    j = F.pmod(F.floor((lon + 180.0) / F.lit(_side(LAST_LEVEL))), F.lit(2 * n))
    return i.cast("int"), j.cast("int")


def source_tree(src: DataFrame, leaf: int = LEAF, keep: int | None = None) -> tuple[DataFrame, DataFrame, int]:
    """``(nodes, points, last)`` of sources ``(src_id, lat, lon)``.

    ``nodes``: level, i, j, cnt, is_leaf of every non-empty cell whose parent was
    split.  ``points``: src_id, s_lat, s_lon and the leaf (level, i, j) they lie in.
    ``last``: the deepest level in use.  With ``keep`` only the ``keep`` smallest ids
    of sources at one and the same place take part: the others tie behind them.

    Sources are counted per cell of the last level first, so the splitting works
    on counts and no task gets the sources of a dense region together.
    """
    ensure_checkpoint_dir(src.sparkSession)
    p = src.select("src_id", F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"))
    if keep is not None:
        place = Window.partitionBy("s_lat", "s_lon").orderBy("src_id")
        p = p.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= keep).drop("_n")
    ci, cj = _cell(F.col("s_lat"), F.col("s_lon"))
    p = p.withColumn("ci", ci).withColumn("cj", cj)
    rest = p.groupBy("ci", "cj").agg(F.count(F.lit(1)).alias("c")).checkpoint()
    nodes, homes, last = [], [], FIRST_LEVEL
    for level in range(FIRST_LEVEL, LAST_LEVEL + 1, STEP):
        shift = LAST_LEVEL - level
        i, j = F.shiftright("ci", shift), F.shiftright("cj", shift)
        is_leaf = (F.col("cnt") <= leaf) | F.lit(level == LAST_LEVEL)
        at = (rest.groupBy(i.alias("i"), j.alias("j")).agg(F.sum("c").alias("cnt"))
              .select(F.lit(level).alias("level"), "i", "j", "cnt", is_leaf.alias("is_leaf"))).checkpoint()
        # few cells at the upper levels, where many counts share one: broadcast there;
        # further down a cell has few counts
        small = bounded_broadcast(at.select("level", "i", "j", "is_leaf"), BROADCAST_ROWS, reuse=False)
        told = rest.withColumn("i", i).withColumn("j", j).join(small, ["i", "j"]).checkpoint()
        nodes.append(at)
        homes.append(told.where("is_leaf").select("ci", "cj", "level", "i", "j"))
        last = level
        rest = told.where(~F.col("is_leaf")).select("ci", "cj", "c")
        if rest.isEmpty():
            break
    every, home = nodes[0], homes[0]
    for n, h in zip(nodes[1:], homes[1:]):
        every, home = every.unionByName(n), home.unionByName(h)
    points = p.join(home, ["ci", "cj"]).select("src_id", "s_lat", "s_lon", "level", "i", "j")
    return every, points, last


def _bounded(pairs: DataFrame) -> DataFrame:
    side = F.lit(180.0) / F.pow(F.lit(2.0), F.col("level"))
    lo, up = _box_bounds_km(F.col("t_lat"), F.col("t_lon"), F.col("i"), F.col("j"), side)
    # no point of a cell is further from its centre than the upper bound allows for; far
    # off the axes this holds more than the gaps in latitude and longitude
    from_centre = up - F.lit(2.0 * RAD * EARTH_RADIUS_KM) * side
    return pairs.withColumn("lower", F.greatest(lo, from_centre)).withColumn("upper", up)


def _prune(pairs: DataFrame, k: int) -> DataFrame:
    """Cells in the order of their upper bounds hold k sources within D; cells
    beyond D cannot hold a nearer one."""
    ahead = (Window.partitionBy("dst_id").orderBy("upper", "level", "i", "j")
             .rowsBetween(Window.unboundedPreceding, 0))
    p = _bounded(pairs).withColumn("_cum", F.sum("cnt").over(ahead))
    d = F.min(F.when(F.col("_cum") >= k, F.col("upper"))).over(Window.partitionBy("dst_id"))
    return (p.withColumn("_d", F.coalesce(d, F.lit(float("inf"))))
            .where(F.col("lower") <= F.col("_d") + F.lit(_SLACK_KM))
            .select("dst_id", "t_lat", "t_lon", "level", "i", "j", "cnt", "is_leaf"))


def nearest_leaves(nodes: DataFrame, last: int, dst: DataFrame, k: int) -> DataFrame:
    """(dst_id, t_lat, t_lon, level, i, j): the leaves that can hold one of a target's k nearest.

    A target's cells stay together through all levels, and each level reads the
    one above once: cells that were split meet their children, leaves meet none
    and stay, so the plan grows by one join a level.
    """
    # the first level has at most 128 cells: a bounded list per target, no join
    top = nodes.where(F.col("level") == FIRST_LEVEL)
    first = top.select(F.sort_array(F.collect_list(F.struct("level", "i", "j", "cnt", "is_leaf")))).scalar()
    targets = dst.select("dst_id", F.col("lat").alias("t_lat"), F.col("lon").alias("t_lon"))
    tasks = max(1, -(-targets.count() // TARGETS_PER_TASK))
    pairs = _prune(targets.repartition(tasks, "dst_id").select("dst_id", "t_lat", "t_lon", F.explode(first).alias("n"))
                   .select("dst_id", "t_lat", "t_lon", "n.*"), k)
    for level in range(FIRST_LEVEL + STEP, last + 1, STEP):
        kids = nodes.where(F.col("level") == level).select(
            (F.col("level") - STEP).alias("_level"), F.shiftright("i", STEP).alias("_i"), F.shiftright("j", STEP).alias("_j"),
            F.struct("level", "i", "j", "cnt", "is_leaf").alias("_kid"))
        kids = bounded_broadcast(kids, BROADCAST_ROWS, reuse=False)
        met = pairs.join(kids, (F.col("level") == F.col("_level")) & (F.col("i") == F.col("_i")) & (F.col("j") == F.col("_j")), "left")
        cell = F.coalesce("_kid", F.struct("level", "i", "j", "cnt", "is_leaf"))
        pairs = _prune(met.select("dst_id", "t_lat", "t_lon", cell.alias("n")).select("dst_id", "t_lat", "t_lon", "n.*"), k)
    return pairs.drop("cnt", "is_leaf")


def idw_weights_tree(src: DataFrame, dst: DataFrame, k: int = 4, leaf: int = LEAF, method: str = "distance") -> DataFrame:
    """J2 by the adaptive tree: same rows as :func:`isobar.operators.remap.idw_weights`.

    Exact: k nearest sources per target by distance (kept to 1 mm), then src_id,
    with inverse-distance weights that sum to one; sources at distance 0 share all
    the weight.  A target is compared with the sources of the leaves that can hold
    one of its k nearest, ``leaf`` sources each (more only where over ``leaf``
    places lie within one cell of 38 m).  Fewer than k sources: all of them.
    No sources or targets: no rows.  Rows without coordinates take no part.
    """
    here = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    nodes, points, last = source_tree(src.where(here), leaf, keep=k)
    leaves = nearest_leaves(nodes, last, dst.where(here), k)
    near = leaves.join(bounded_broadcast(points, BROADCAST_ROWS), ["level", "i", "j"]).select("dst_id", "src_id", round_half_up(
        haversine_km(F.col("t_lat"), F.col("t_lon"), F.col("s_lat"), F.col("s_lon")), 6).alias("dist"))
    rank = F.row_number().over(Window.partitionBy("dst_id").orderBy("dist", "src_id"))
    near = near.withColumn("rank", rank).where(F.col("rank") <= k)
    whole = Window.partitionBy("dst_id")
    at_zero = F.min("dist").over(whole) == 0.0
    share = F.when(at_zero, (F.col("dist") == 0.0).cast("double")).otherwise(F.try_divide(F.lit(1.0), F.col("dist")))
    near = near.withColumn("_share", share)
    return near.select(F.lit(method).alias("method"), "dst_id", "src_id", "dist", "rank",
                       (F.col("_share") / F.sum("_share").over(whole)).alias("w"))
