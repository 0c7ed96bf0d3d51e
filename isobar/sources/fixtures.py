"""Test inputs derived from the driver's tables (FIXTURES.md X1-X8).

Each builder reads one of the given tables and turns it into a forecast
shaped table, so every query built on them scales with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.grid import run_init_time
from ..operators.joins import dealt
from .tables import read_table

# Fixed values of fixture X1: line number -> PET input parameter and value range.
PET_INPUT_RANGES = [
    (1, "t_2m", 260.0, 310.0),
    (2, "td_2m", 250.0, 300.0),
    (3, "u_10m", -20.0, 20.0),
    (4, "v_10m", -20.0, 20.0),
    (5, "asob_s", -20.0, 800.0),
    (6, "athb_s", -200.0, 50.0),
    (7, "ps", 60000.0, 105000.0),
]
ENSEMBLE_RUN = "2026040300"


def _run_of_flag(flag) -> F.Column:
    return (F.when(flag == "A", F.lit("2026040300"))
            .when(flag == "N", F.lit("2026040306"))
            .otherwise(F.lit("2026040312")))


def _step_of_month(m) -> F.Column:
    k = m % 6
    return (F.when(k == 0, 0).when(k == 1, 1).when(k == 2, 2)
            .when(k == 3, 78).when(k == 4, 81).otherwise(84)).cast("int")


def _value_rule(lo, hi, price) -> F.Column:
    frac = (F.round(price * F.lit(100.0)).cast("bigint") % F.lit(100000)) / F.lit(100000.0)
    return lo + (hi - lo) * frac


def _ranges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PET_INPUT_RANGES, "n int, param string, lo double, hi double")


def x1_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, param, step, cell, value) before the cell is split into iy/ix."""
    li = read_table(spark, sf_dir, "lineitem")
    # seven fixed rows: broadcasting them is bounded by construction
    j = li.join(F.broadcast(_ranges(spark)), F.col("l_linenumber") == F.col("n"))
    keys = ["run", "param", "step", "cell"]
    rows = j.select(_run_of_flag(F.col("l_returnflag")).alias("run"), F.col("param"),
                    _step_of_month(F.month("l_shipdate")).alias("step"),
                    F.floor(F.col("l_partkey") / 10).cast("int").alias("cell"),
                    _value_rule(F.col("lo"), F.col("hi"), F.col("l_extendedprice")).alias("value"))
    return dealt(rows, li.count(), *keys).groupBy(*keys).agg(F.max("value").alias("value"))


def x1_field(spark: SparkSession, sf_dir: str, with_nan: bool = False) -> DataFrame:
    """The seven PET inputs as a long field (run, param, step, iy, ix, value)."""
    c = x1_cells(spark, sf_dir)
    value = F.col("value")
    if with_nan:
        value = F.when((F.col("cell") % 7 == 0) & (F.col("step") == 78),
                       F.lit(float("nan"))).otherwise(value)
    return c.select("run", "param", "step",
                    F.floor(F.col("cell") / 10).cast("int").alias("iy"),
                    (F.col("cell") % 10).alias("ix"), value.alias("value"))


def x2_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File listing (run, param, step, n_bytes, status) from events; about
    one reply in eleven is an error."""
    ev = read_table(spark, sf_dir, "events")
    h = F.hour("ts")
    run = (F.year("ts") * 1000000 + F.month("ts") * 10000 + F.dayofmonth("ts") * 100 + h - h % 6).cast("string")
    return (ev.groupBy(F.col("event_type").alias("param"), run.alias("run"), (h % 6).alias("step"))
            .agg(F.min(F.col("event_id") % 20000).alias("n_bytes"), F.min("event_id").alias("_e"))
            .select("run", "param", "step", "n_bytes", F.when(F.col("_e") % 11 == 0, 404).otherwise(200).alias("status")))


def x2_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run x event type x steps 0..5 of X2 (the keys a probe expects)."""
    lst = x2_listing(spark, sf_dir)
    # the parameter names form a short list (a scalar subquery), expanded per run
    params = lst.select(F.sort_array(F.collect_set("param"))).scalar()
    return (lst.select("run").distinct()
            .select("run", F.explode(params).alias("param"))
            .select("run", "param", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("step")))


def _requests(spark: SparkSession, sf_dir: str, lat, lon) -> DataFrame:
    cu = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    param = (F.when(k % 5 == 0, "t_2m").when(k % 5 == 1, "ps").when(k % 5 == 2, "pet_pm")
             .when(k % 5 == 3, "bad"))
    run = (F.when(k % 4 == 0, "2026040300").when(k % 4 == 1, "2026040306")
           .when(k % 4 == 2, "20260403"))
    ens = F.when(k % 7 == 0, F.lit("true"))
    return cu.select(k.alias("req_id"), lat.alias("lat"), lon.alias("lon"), param.alias("param"),
                     ens.alias("ensemble"), run.alias("run"))


def x3_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point requests incl. out-of-range, unknown and malformed values."""
    k = F.col("c_custkey")
    lat = ((k * 37) % 1861 - 930).cast("double") / F.lit(10.0)
    lon = ((k * 101) % 5501 - 1850).cast("double") / F.lit(10.0)
    return _requests(spark, sf_dir, lat, lon)


def x3b_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests whose nearest cell lies inside X1's cells."""
    k = F.col("c_custkey")
    lat = F.lit(90.0) - (k % 20).cast("double") * F.lit(0.125) - F.lit(0.03)
    lon = F.lit(-180.0) + ((k * 3) % 10).cast("double") * F.lit(0.125) + F.lit(0.02)
    return _requests(spark, sf_dir, lat, lon)


def x4_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Success markers for X1's (run, param) but one, promoted for two runs."""
    m = x1_field(spark, sf_dir).select("run", "param").distinct()
    init = run_init_time(F.col("run"))
    succ = (m.where(~((F.col("run") == "2026040306") & (F.col("param") == "ps")))
            .select("run", "param", F.lit("_SUCCESS").alias("marker"),
                    F.lit(None).cast("string").alias("payload"),
                    (init + F.expr("INTERVAL 4 HOURS")).alias("ts")))
    prom = (m.where(F.col("run") != "2026040312").select("run").distinct()
            .select("run", F.lit(None).cast("string").alias("param"), F.lit("_PROMOTED").alias("marker"),
                    F.lit(None).cast("string").alias("payload"),
                    (init + F.expr("INTERVAL 5 HOURS")).alias("ts")))
    return succ.unionByName(prom)


def x4_lifecycle_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4 plus pointer markers: every promoted run was published (``_LATEST_RUN``)
    six hours after its start; each run that was not promoted redirects
    (``_RESOLVED_RUN``) to the newest promoted run before it."""
    x4 = x4_markers(spark, sf_dir)
    init = run_init_time(F.col("run"))
    prom = x4.where(F.col("marker") == "_PROMOTED").select("run")
    latest = prom.select("run", F.lit(None).cast("string").alias("param"),
                         F.lit("_LATEST_RUN").alias("marker"), F.col("run").alias("payload"),
                         (init + F.expr("INTERVAL 6 HOURS")).alias("ts"))
    # runs are few (one row per run): an ordered window over them is cheap
    runs = (x4.groupBy("run").agg(F.bool_or(F.col("marker") == "_PROMOTED").alias("promoted")))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    target = (runs.withColumn("payload", F.max(F.when(F.col("promoted"), F.col("run"))).over(before))
              .where(~F.col("promoted") & F.col("payload").isNotNull()))
    redirect = target.select("run", F.lit(None).cast("string").alias("param"),
                             F.lit("_RESOLVED_RUN").alias("marker"), "payload",
                             (init + F.expr("INTERVAL 1 HOURS")).alias("ts"))
    return x4.unionByName(latest).unionByName(redirect)


def x5_weights(spark: SparkSession, sf_dir: str, method: str | None = None) -> DataFrame:
    """Three sources per target cell with weights 0.5, 0.3, 0.2."""
    cells = x1_cells(spark, sf_dir).select("cell").distinct()
    n = cells.select((F.max("cell") + 1).alias("n")).scalar()
    k = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k")
    w = (cells.where(F.col("cell") * 2 < n).select("cell", k)
         .select(F.col("cell").cast("bigint").alias("dst_id"),
                 ((F.col("cell") * 2 + F.col("k")) % n).cast("bigint").alias("src_id"),
                 F.when(F.col("k") == 0, 0.5).when(F.col("k") == 1, 0.3).otherwise(0.2).alias("w")))
    if method is not None:
        w = w.select(F.lit(method).alias("method"), "dst_id", "src_id", "w")
    return w


def x5_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 seen as a native (unstructured) field: source id = cell number."""
    return x1_cells(spark, sf_dir).select(
        "run", "param", F.lit(0).alias("member"), "step",
        F.col("cell").cast("bigint").alias("src_id"), "value")


def x6_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return read_table(spark, sf_dir, "supplier").select(
        k.alias("src_id"),
        ((k * 377) % 1801 - 900).cast("double").alias("lat") / F.lit(10.0),
        ((k * 1013) % 3600 - 1800).cast("double").alias("lon") / F.lit(10.0),
    ).toDF("src_id", "lat", "lon")


def x6_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    return read_table(spark, sf_dir, "nation").select(
        k.cast("bigint").alias("dst_id"),
        ((k % 5).cast("double") * F.lit(40.0) - F.lit(80.0)).alias("lat"),
        (F.floor(k / 5).cast("double") * F.lit(72.0) - F.lit(180.0)).alias("lon"))


def x7_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A four-member ensemble of the seven PET inputs (run, param, member, step, iy, ix, value)."""
    # seven fixed rows: broadcasting them is bounded by construction
    li = read_table(spark, sf_dir, "lineitem").join(F.broadcast(_ranges(spark)), F.col("l_linenumber") == F.col("n"))
    g = (li.groupBy(F.col("param"), (F.col("l_suppkey") % 4).cast("int").alias("member"),
                    (F.month("l_shipdate") % 6).cast("int").alias("step"),
                    F.floor(F.col("l_partkey") / 10).cast("int").alias("cell"))
         .agg(F.max(_value_rule(F.col("lo"), F.col("hi"), F.col("l_extendedprice"))).alias("value")))
    return g.select(F.lit(ENSEMBLE_RUN).alias("run"), "param", "member", "step",
                    F.floor(F.col("cell") / 10).cast("int").alias("iy"),
                    (F.col("cell") % 10).alias("ix"), "value")


def x8_request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log (client, req_id, ts) from events."""
    return read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("client"), F.col("event_id").alias("req_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"))
