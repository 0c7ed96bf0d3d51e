"""Queries: remapping (J1 apply weights, J2 k-nearest weights, J3 box-overlap weights)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import knn_tree, remap, remap_series
from ..sources import fixtures as fx
from .catalog import register
from .sqltext import NAN, d, with_fixtures

R2 = remap.EARTH_RADIUS_KM ** 2
RAD = remap.RAD


def _weights(spark, sf):
    return (fx.x5_weights(spark, sf, "distance")
            .unionByName(fx.x5_weights(spark, sf, "conservative")))


_CONS = ", ".join(f"'{p}'" for p in remap.CONSERVATIVE_PARAMS)


def j1_sql(native: str) -> str:
    """CTEs up to ``j1``: every frame of ``native`` on every target of its weight set."""
    return f"""w AS (SELECT 'distance' AS method, dst_id, src_id, w FROM x5 UNION ALL
      SELECT 'conservative' AS method, dst_id, src_id, w FROM x5),
nat AS (SELECT *, CASE WHEN param IN ({_CONS}) THEN 'conservative' ELSE 'distance' END AS method FROM {native}),
s AS (SELECT nat.run, nat.param, nat.member, nat.step, w.dst_id, count(*) AS n, sum(w.w * nat.value) AS v FROM nat
  JOIN w ON nat.method = w.method AND nat.src_id = w.src_id GROUP BY nat.run, nat.param, nat.member, nat.step, w.dst_id),
f AS (SELECT DISTINCT run, param, member, step, method FROM nat),
t AS (SELECT method, dst_id, count(*) AS n_src FROM w GROUP BY method, dst_id),
j1 AS (SELECT f.run, f.param, f.member, f.step, t.dst_id,
  CAST(CASE WHEN s.n = t.n_src THEN s.v ELSE {NAN} END AS FLOAT) AS value
  FROM f JOIN t ON f.method = t.method LEFT JOIN s ON s.run = f.run AND s.param = f.param AND s.member = f.member
  AND s.step = f.step AND s.dst_id = t.dst_id)"""


@register("J1_remap_apply", with_fixtures(["x5", "x5_native"], j1_sql("x5_native") + "\nSELECT * FROM j1"))
def j1_remap_apply(spark, sf):
    return remap.remap_apply(fx.x5_native(spark, sf), _weights(spark, sf))


# The same on step series: a weight meets a source once, whatever its steps.
@register("J1_remap_series", with_fixtures(["x5", "x5_native"], j1_sql("x5_native") + "\nSELECT * FROM j1"))
def j1_remap_series(spark, sf):
    series, axes = remap_series.native_series(fx.x5_native(spark, sf))
    out = remap_series.remap_series(series, axes, remap_series.weight_blocks(_weights(spark, sf)))
    e = out.select("run", "param", "member", "dst_id", F.explode(F.arrays_zip("steps", "vals")).alias("e"))
    return e.select("run", "param", "member", F.col("e.steps").alias("step"), "dst_id", F.col("e.vals").alias("value"))


def _hav_sql(lat1, lon1, lat2, lon2) -> str:
    p1, p2 = f"({lat1} * {d(RAD)})", f"({lat2} * {d(RAD)})"
    sdp = f"sin(({p2} - {p1}) / 2)"
    sdl = f"sin((({lon2} - {lon1}) * {d(RAD)}) / 2)"
    a = f"({sdp} * {sdp} + cos({p1}) * cos({p2}) * {sdl} * {sdl})"
    return f"{d(2 * remap.EARTH_RADIUS_KM)} * asin(least(sqrt({a}), {d(1)}))"


@register("J2_idw_weights", with_fixtures(["x6_src", "x6_dst"], f"""
c AS (SELECT t.dst_id, s.src_id,
  floor({_hav_sql('t.lat', 't.lon', 's.lat', 's.lon')} * {d(1e6)} + {d(0.5)}) / {d(1e6)} AS dist
  FROM x6_dst t CROSS JOIN x6_src s),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY dst_id ORDER BY dist, src_id) AS INTEGER) AS rank FROM c),
t AS (SELECT * FROM r WHERE rank <= 4)
SELECT 'distance' AS method, dst_id, src_id, dist, rank,
  ({d(1)} / dist) / sum({d(1)} / dist) OVER (PARTITION BY dst_id) AS w FROM t"""))
def j2_idw_weights(spark, sf):
    return remap.idw_weights(fx.x6_sources(spark, sf), fx.x6_targets(spark, sf), k=4)


# Sources crowded at the pole and the date line (many at one place) beside the even ones.
@register("J2_idw_weights_tree", with_fixtures(["x6_src", "x3b"], f"""
s AS (SELECT src_id, lat, lon FROM x6_src UNION ALL SELECT -req_id, lat, lon FROM x3b),
t AS (SELECT c_custkey AS dst_id, CAST((c_custkey*37)%1801-900 AS DOUBLE)/{d(10)} AS lat,
  CAST((c_custkey*101)%3600-1800 AS DOUBLE)/{d(10)} AS lon FROM customer),
c AS (SELECT t.dst_id, s.src_id,
  floor({_hav_sql('t.lat', 't.lon', 's.lat', 's.lon')} * {d(1e6)} + {d(0.5)}) / {d(1e6)} AS dist FROM t CROSS JOIN s),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY dst_id ORDER BY dist, src_id) AS INTEGER) AS rank FROM c),
n AS (SELECT *, min(dist) OVER (PARTITION BY dst_id) AS least FROM r WHERE rank <= 4),
h AS (SELECT *, CASE WHEN least > 0 THEN {d(1)} / dist WHEN dist = 0 THEN {d(1)} ELSE {d(0)} END AS share FROM n)
SELECT 'distance' AS method, dst_id, src_id, dist, rank,
  floor(share / sum(share) OVER (PARTITION BY dst_id) * {d(1e9)} + {d(0.5)}) / {d(1e9)} AS w FROM h"""))
def j2_idw_weights_tree(spark, sf):
    crowd = fx.x3b_requests(spark, sf).select((-F.col("req_id")).alias("src_id"), "lat", "lon")
    k = F.col("c_custkey")
    targets = fx.read_table(spark, sf, "customer").select(
        k.alias("dst_id"), (((k * 37) % 1801 - 900).cast("double") / F.lit(10.0)).alias("lat"),
        (((k * 101) % 3600 - 1800).cast("double") / F.lit(10.0)).alias("lon"))
    w = knn_tree.idw_weights_tree(fx.x6_sources(spark, sf).unionByName(crowd), targets, k=4)
    return w.withColumn("w", F.floor(F.col("w") * F.lit(1e9) + F.lit(0.5)) / F.lit(1e9))


def _src_boxes(spark, sf):
    return fx.x6_sources(spark, sf).select(
        "src_id", (F.col("lat") - 5.0).alias("south"), (F.col("lat") + 5.0).alias("north"),
        (F.col("lon") - 5.0).alias("west"), (F.col("lon") + 5.0).alias("east"))


def _dst_boxes(spark, sf):
    return fx.x6_targets(spark, sf).select(
        "dst_id", (F.col("lat") - 10.0).alias("south"), (F.col("lat") + 10.0).alias("north"),
        (F.col("lon") - 10.0).alias("west"), (F.col("lon") + 10.0).alias("east"))


def _pieces_sql(name: str, src: str, id_col: str) -> str:
    s, n = f"greatest(south, {d(-90)})", f"least(north, {d(90)})"
    return f"""{name} AS (SELECT {id_col}, {s} AS s, {n} AS n, greatest(west, {d(-180)}) AS w, least(east, {d(180)}) AS e FROM {src}
  UNION ALL SELECT {id_col}, {s}, {n}, west + {d(360)}, {d(180)} FROM {src} WHERE west < {d(-180)}
  UNION ALL SELECT {id_col}, {s}, {n}, {d(-180)}, east - {d(360)} FROM {src} WHERE east > {d(180)})"""


def _area_sql(s, n, w, e) -> str:
    return f"{d(R2)} * (({e} - {w}) * {d(RAD)}) * (sin({n} * {d(RAD)}) - sin({s} * {d(RAD)}))"


@register("J3_conservative_weights", with_fixtures(["x6_src", "x6_dst"], f"""
sb AS (SELECT src_id, lat - {d(5)} AS south, lat + {d(5)} AS north, lon - {d(5)} AS west, lon + {d(5)} AS east FROM x6_src),
db AS (SELECT dst_id, lat - {d(10)} AS south, lat + {d(10)} AS north, lon - {d(10)} AS west, lon + {d(10)} AS east FROM x6_dst),
{_pieces_sql('sp', 'sb', 'src_id')},
{_pieces_sql('dp', 'db', 'dst_id')},
ov AS (SELECT dp.dst_id, sp.src_id, greatest(sp.s, dp.s) AS os, least(sp.n, dp.n) AS onn,
  greatest(sp.w, dp.w) AS ow, least(sp.e, dp.e) AS oe FROM dp CROSS JOIN sp),
pa AS (SELECT dst_id, src_id, sum({_area_sql('os', 'onn', 'ow', 'oe')}) AS area FROM ov
  WHERE onn > os AND oe > ow GROUP BY dst_id, src_id),
da AS (SELECT dst_id, {_area_sql(f'greatest(south, {d(-90)})', f'least(north, {d(90)})', 'west', 'east')} AS dst_area FROM db)
SELECT 'conservative' AS method, pa.dst_id, pa.src_id, pa.area / da.dst_area AS w FROM pa JOIN da ON pa.dst_id = da.dst_id"""))
def j3_conservative_weights(spark, sf):
    return remap.conservative_weights(_src_boxes(spark, sf), _dst_boxes(spark, sf))
