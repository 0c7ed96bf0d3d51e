"""Field store on parquet (S3 field_scan, S4 field_publish) and manifests.

Layout: ``root/data/v=<publication>/model=<m>/run=<run>/param=<param>/cy=<cy>/part-*.parquet``
with rows sorted by (cx, iy, ix, step) inside each file, so a point or box query
prunes ``run``/``param``/``cy`` directories and skips row groups on ``iy``/``ix``.
Which publication holds a (model, run, param) is said by the store's snapshot
(:mod:`isobar.sources.versions`): publishing replaces it as a whole, readers pin
a snapshot, and a scan lists the folders it needs and no others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, FloatType, IntegerType, LongType, MapType, StringType, TimestampNTZType,
                               StructField, StructType)

from ..functions import grid
from . import versions
from .inventory import DETERMINISTIC_MODEL, ENSEMBLE_MODEL

STORED_SCHEMA = StructType([
    StructField("member", IntegerType()), StructField("step", IntegerType()),
    StructField("iy", IntegerType()), StructField("ix", IntegerType()),
    StructField("cx", IntegerType()), StructField("value", FloatType()),
    StructField("model", StringType()), StructField("run", StringType()), StructField("param", StringType()),
    StructField("cy", IntegerType()),
])

MANIFEST_SCHEMA = StructType([
    StructField("run_dt", StringType()), StructField("model_run", StringType()),
    StructField("total_steps", IntegerType()),
    StructField("params", MapType(StringType(), StructType([
        StructField("available", ArrayType(IntegerType())),
        StructField("missing", ArrayType(IntegerType()))]))),
])


def _model_col(field: DataFrame, model: str | None):
    if "model" in field.columns:
        return F.col("model").cast("string")
    if model is None:
        model = ENSEMBLE_MODEL if "member" in field.columns else DETERMINISTIC_MODEL
    return F.lit(model)


#: What a publication replaces as a whole.
KEYS = ("model", "run", "param")


def _write(rows: DataFrame, root: str, codec: str, within: Sequence[str], zones: bool) -> versions.Snapshot:
    """Write rows of a parquet store into a folder of their own, and commit it."""
    spark = rows.sparkSession
    folder = versions.new_folder(versions.snapshot(spark, root))
    by = [*KEYS, "cy", "cx"]
    (rows.repartition(*by).sortWithinPartitions(*by, *within)
        .write.mode("errorifexists").option("compression", codec).partitionBy(*KEYS, "cy").parquet(f"{root}/{folder}"))
    if zones:
        _zone_rows(_read(spark, root, [folder], STORED_SCHEMA)).write.parquet(f"{root}/zones/{folder.split('/')[1]}")
    return _commit(spark, root, folder, {})


def _commit(spark: SparkSession, root: str, folder: str, meta: dict, below: str | None = None) -> versions.Snapshot:
    found = versions.keys_below(spark, root, folder, KEYS, below)

    def change(now: versions.Snapshot, version: int) -> versions.Snapshot:
        new = {k: versions.Entry(path, version, parts) for k, (path, parts) in found.items()}
        return versions.Snapshot(version, {**now.entries, **new}, {**now.meta, **meta})
    return versions.commit(spark, root, change)


def _read(spark: SparkSession, root: str, paths: Sequence[str], schema: StructType) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("basePath", f"{root}/{paths[0].split('/')[0]}")
            .parquet(*[f"{root}/{p}" for p in paths]).select(*schema.names))


def _entries(snap: versions.Snapshot, model: str | None = None, run: str | None = None,
             params: Sequence[str] | None = None) -> dict[tuple[str, ...], versions.Entry]:
    """The snapshot's entries of a model; a run or param that is asked for and not there is an error."""
    of_run = {k: e for k, e in snap.entries.items() if (model is None or k[0] == model) and (run is None or k[1] == run)}
    if run is not None and not of_run:
        raise FileNotFoundError(f"Missing run store: run={run}")
    if params is None:
        return of_run
    absent = [p for p in params if p not in {k[2] for k in of_run}]
    if absent:
        raise FileNotFoundError(f"Missing parameter store: {f'run={run} ' if run else ''}{', '.join(absent)}")
    return {k: e for k, e in of_run.items() if k[2] in set(params)}


def field_publish(field: DataFrame, root: str, codec: str = "zstd", model: str | None = None,
                  zones: bool = False) -> versions.Snapshot:
    """Publish ``field``, replacing each (model, run, param) it holds as a whole.

    ``model`` is a key: an ensemble and a deterministic field of the same run
    and param live side by side (from a ``model`` column, else the argument,
    else by whether the field has members).  Rows are clustered by
    (model, run, param, cy, cx) so each task writes whole chunks, then sorted
    inside files.  Returns the snapshot it committed; ``written()`` of it names
    what was published.  With ``zones`` the statistics of every chunk are kept
    too (:func:`zone_scan`).
    """
    member = F.col("member") if "member" in field.columns else F.lit(0)
    model_c = _model_col(field, model)
    out = field.select(
        member.cast("int").alias("member"), F.col("step").cast("int").alias("step"),
        F.col("iy").cast("int").alias("iy"), F.col("ix").cast("int").alias("ix"),
        grid.chunk_of(F.col("ix"), grid.CHUNK_LON).alias("cx"), F.col("value").cast("float").alias("value"),
        model_c.alias("model"),
        F.col("run").cast("string").alias("run"), F.col("param").cast("string").alias("param"),
        grid.chunk_of(F.col("iy"), grid.CHUNK_LAT).alias("cy"))
    return _write(out, root, codec, ("iy", "ix", "member", "step"), zones)


def field_scan(spark: SparkSession, root: str, run: str | None = None, params: Sequence[str] | None = None,
               steps: Sequence[int] | None = None, ensemble: bool = False, model: str | None = None,
               version: int | None = None) -> DataFrame:
    """S3: read a run's params (optionally some steps) of one model, from the
    newest snapshot or a given one.

    The snapshot names the folders, so others are not even listed.  A run or a
    param that is asked for by name and not there is an error.  The schema is
    explicit (partition inference would turn ``run`` into a number).  The model
    defaults to the deterministic or the ensemble one.
    """
    snap = versions.snapshot(spark, root, version)
    found = _entries(snap, model or (ENSEMBLE_MODEL if ensemble else DETERMINISTIC_MODEL), run, params)
    df = _read(spark, root, [e.path for e in found.values()], STORED_SCHEMA)
    if steps is not None:
        df = df.where(F.col("step").isin(list(steps)))
    cols = ["run", "param"] + (["member"] if ensemble else []) + ["step", "iy", "ix", "value"]
    return df.select(*cols)


def stored_field(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The whole store with its chunk columns (for pruning by cy / cx)."""
    return _read(spark, root, [e.path for e in versions.snapshot(spark, root, version).entries.values()], STORED_SCHEMA)


#: Side of the corner that the smoke check looks at.
CORNER = 10

ZONE_SCHEMA = StructType([
    StructField("model", StringType()), StructField("run", StringType()), StructField("param", StringType()),
    StructField("member", IntegerType()), StructField("step", IntegerType()), StructField("cy", IntegerType()),
    StructField("cx", IntegerType()), StructField("n_rows", LongType()), StructField("n_valid", LongType()),
    StructField("vmin", FloatType()), StructField("vmax", FloatType()), StructField("n_corner", LongType()),
])


def _zone_rows(rows: DataFrame) -> DataFrame:
    """Statistics per chunk and step: rows, valid ones, their range, and the valid ones of the grid's corner."""
    value = F.when(~F.isnan("value"), F.col("value"))
    corner = (F.col("iy") < CORNER) & (F.col("ix") < CORNER)
    return rows.groupBy(*KEYS, "member", "step", "cy", "cx").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(value).alias("n_valid"), F.min(value).alias("vmin"), F.max(value).alias("vmax"),
        F.count(F.when(corner, value)).alias("n_corner"))


def zone_scan(spark: SparkSession, root: str, run: str | None = None, params: Sequence[str] | None = None,
              ensemble: bool = False, model: str | None = None, version: int | None = None) -> DataFrame:
    """The zone map of what :func:`field_scan` would read (one row per chunk, step and member), without a field row.

    A (model, run, param) that was published without zones is an error.
    """
    snap = versions.snapshot(spark, root, version)
    found = _entries(snap, model or (ENSEMBLE_MODEL if ensemble else DETERMINISTIC_MODEL), run, params)
    folders = sorted({f"zones/{e.folder.split('/')[1]}" for e in found.values()})
    bare = [f for f in folders if not versions.exists(spark, f"{root}/{f}")]
    if bare:
        raise FileNotFoundError(f"{root}: published without zones: {', '.join(bare)}")
    if not folders:
        return spark.createDataFrame([], ZONE_SCHEMA)
    # a folder may hold keys that a later publication has replaced
    live = ["\n".join((*k, e.folder.split("/")[1])) for k, e in found.items()]
    df = spark.read.schema(ZONE_SCHEMA).parquet(*[f"{root}/{f}" for f in folders])
    home = F.element_at(F.split(F.input_file_name(), "/"), -2)
    return df.where(F.concat_ws("\n", *KEYS, home).isin(live)).select(*ZONE_SCHEMA.names)


def manifest_documents(manifest: DataFrame) -> DataFrame:
    """One JSON document per run from A1 rows: run_dt, model_run, total_steps, params."""
    g = manifest.groupBy("run").agg(
        F.max("total_steps").cast("int").alias("total_steps"),
        F.map_from_entries(F.collect_list(F.struct("param", F.struct("available", "missing")))).alias("params"))
    doc = F.struct(F.col("run").alias("run_dt"), grid.run_cycle(F.col("run")).alias("model_run"),
                   "total_steps", "params")
    return g.select(F.to_json(doc).alias("value"))


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest_documents(manifest).write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest documents -> (run, param, step, is_available)."""
    m = spark.read.schema(MANIFEST_SCHEMA).json(path)
    p = m.select(F.col("run_dt").alias("run"), F.explode("params").alias("param", "info"))
    avail = p.select("run", "param", F.explode("info.available").alias("step"), F.lit(True).alias("is_available"))
    miss = p.select("run", "param", F.explode("info.missing").alias("step"), F.lit(False).alias("is_available"))
    return avail.unionByName(miss).withColumn("is_available", F.col("is_available").cast(BooleanType()))


SERIES_SCHEMA = StructType([
    StructField("member", IntegerType()), StructField("cx", IntegerType()),
    StructField("iy", IntegerType()), StructField("ix", IntegerType()),
    StructField("steps", ArrayType(IntegerType())), StructField("vals", ArrayType(FloatType())),
    StructField("model", StringType()), StructField("run", StringType()), StructField("param", StringType()),
    StructField("cy", IntegerType()),
])


def _series_rows(series: DataFrame, model: str | None) -> DataFrame:
    member = F.col("member") if "member" in series.columns else F.lit(0)
    return series.select(member.cast("int").alias("member"), F.col("cx").cast("int").alias("cx"), F.col("iy").cast("int").alias("iy"),
                         F.col("ix").cast("int").alias("ix"), "steps", F.col("vals").cast("array<float>").alias("vals"),
                         _model_col(series, model).alias("model"), "run", "param", F.col("cy").cast("int").alias("cy"))


def series_publish(series: DataFrame, root: str, codec: str = "zstd", model: str | None = None) -> versions.Snapshot:
    """Publish the series layout (one row per pixel) partitioned by model, run,
    param and chunk row ``cy``; files hold whole chunks sorted by (cx, iy, ix).
    Each (model, run, param) in ``series`` is replaced as a whole."""
    return _write(_series_rows(series, model), root, codec, ("iy", "ix", "member"), False)


def series_scan(spark: SparkSession, root: str, ensemble: bool = False, model: str | None = None,
                run: str | None = None, params: Sequence[str] | None = None, version: int | None = None) -> DataFrame:
    """The stored series of one model; runs and params as in :func:`field_scan`."""
    snap = versions.snapshot(spark, root, version)
    found = _entries(snap, model or (ENSEMBLE_MODEL if ensemble else DETERMINISTIC_MODEL), run, params)
    cols = ["run", "param"] + (["member"] if ensemble else []) + ["cy", "cx", "iy", "ix", "steps", "vals"]
    return _read(spark, root, [e.path for e in found.values()], SERIES_SCHEMA).select(*cols)


MARKER_SCHEMA = StructType([
    StructField("run", StringType()), StructField("param", StringType()),
    StructField("marker", StringType()), StructField("payload", StringType()),
    StructField("ts", TimestampNTZType()),
])


def append_markers(markers: DataFrame, root: str) -> None:
    """S8 sink: append marker rows (run, param, marker, payload, ts) to the
    marker table, partitioned by marker kind.  Appends are never rewritten;
    the newest row of a kind wins when read (``max_by(.., ts)``)."""
    (markers.select("run", "param", "marker", "payload", F.col("ts").cast("timestamp_ntz").alias("ts"))
        .write.mode("append").partitionBy("marker").parquet(root))


def read_markers(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MARKER_SCHEMA).parquet(root).select("run", "param", "marker", "payload", "ts")


#: Bytes of source data that one bucket should hold.
BUCKET_BYTES = 1 << 30
_FIELD_DDL = "member INT, step INT, iy INT, ix INT, value FLOAT, model STRING, run STRING, param STRING"
_SERIES_DDL = ("member INT, cx INT, iy INT, ix INT, steps ARRAY<INT>, vals ARRAY<FLOAT>, model STRING, "
               "run STRING, param STRING, cy INT")
_NATIVE_DDL = "member INT, step INT, src_id BIGINT, value DOUBLE, model STRING, run STRING, param STRING"
_WEIGHTS_DDL = "method STRING, dst_id BIGINT, src_id BIGINT, w DOUBLE, n_src BIGINT"


def bucket_count(spark: SparkSession, n_bytes: int = 0) -> int:
    """Buckets of a new table: one per ``BUCKET_BYTES`` expected, and at least
    as many as the cluster has task slots (a bucketed scan has one task per bucket)."""
    return max(spark.sparkContext.defaultParallelism, -(-int(n_bytes) // BUCKET_BYTES))


def _table(spark: SparkSession, name: str, ddl: str, parts: str | None, by: str, sort: str, buckets: int, location: str) -> None:
    partitioned = f"PARTITIONED BY ({parts})" if parts else ""
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet OPTIONS (compression 'zstd') {partitioned} "
              f"CLUSTERED BY ({by}) SORTED BY ({sort}) INTO {buckets} BUCKETS LOCATION '{location}'")


def _attach(spark: SparkSession, root: str, table: str, ddl: str, parts: str | None, by: str, sort: str,
            version: int | None = None) -> DataFrame:
    """The table of one snapshot, made known to this session as ``<table>_s<version>``.

    Its partitions lie where the snapshot says, in the folders of several publications.
    """
    snap = versions.snapshot(spark, root, version)
    name = f"{table}_s{snap.version}"
    if not spark.catalog.tableExists(name):
        whole = snap.entries.get(())
        n = snap.meta.get("buckets") or bucket_count(spark)
        _table(spark, name, ddl, parts, by, sort, n, f"{root}/{whole.path if whole else 'data'}")
        columns = (parts or "").split(", ")
        specs = []
        for key, e in snap.entries.items() if parts else ():
            for last in e.parts or (None,):
                values = (*key, last) if last is not None else key
                spec = ", ".join(f"{c} = '{v}'" for c, v in zip(columns, values))
                specs.append(f"PARTITION ({spec}) LOCATION '{root}/{e.path}{f'/{columns[-1]}={last}' if last is not None else ''}'")
        for i in range(0, len(specs), 500):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs[i:i + 500])}")
    return spark.table(name)


def _publish_bucketed(rows: DataFrame, root: str, ddl: str, parts: str | None, by: str, sort: str,
                      buckets: int | None) -> versions.Snapshot:
    """Write rows bucketed into a folder of their own, and commit it.

    The bucket count of the store's first publication rules, as files of two
    layouts must not mix; asking for another one is an error.
    """
    spark = rows.sparkSession
    now = versions.snapshot(spark, root)
    stored = now.meta.get("buckets")
    if stored is not None and buckets is not None and stored != buckets:
        raise ValueError(f"{root} has {stored} buckets, not {buckets}")
    n = stored or buckets or bucket_count(spark)
    folder = versions.new_folder(now)
    name = f"isobar_publication_{folder.rsplit('-', 1)[1]}"
    _table(spark, name, ddl, parts, by, sort, n, f"{root}/{folder}")
    try:
        # a file per partition and bucket, written by as many tasks as these allow, not by one a bucket
        bucket = F.pmod(F.hash(*by.split(", ")), F.lit(n))
        dealt = rows.repartition(*parts.split(", "), bucket) if parts else rows.repartition(n, *by.split(", "))
        dealt.write.insertInto(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # external: the files stay
    if parts is None:
        return versions.commit(spark, root, lambda now, version: versions.Snapshot(
            version, {(): versions.Entry(folder, version)}, {**now.meta, "buckets": n}))
    return _commit(spark, root, folder, {"buckets": n}, "cy" if parts.endswith("cy") else None)


_FIELD = (_FIELD_DDL, "model, run, param", "iy, ix", "iy, ix, member, step")
_SERIES = (_SERIES_DDL, "model, run, param, cy", "iy, ix", "iy, ix, member")
_NATIVE = (_NATIVE_DDL, "model, run, param", "src_id", "src_id")
_WEIGHTS = (_WEIGHTS_DDL, None, "src_id", "src_id")


def field_commit_bucketed(field: DataFrame, root: str, buckets: int | None = None, model: str | None = None) -> versions.Snapshot:
    """S4, co-located: publish ``field``, replacing each (model, run, param) it
    holds as a whole, in a store bucketed by pixel (iy, ix) at ``root``."""
    member = F.col("member") if "member" in field.columns else F.lit(0)
    out = field.select(member.cast("int").alias("member"), F.col("step").cast("int").alias("step"),
                       F.col("iy").cast("int").alias("iy"), F.col("ix").cast("int").alias("ix"),
                       F.col("value").cast("float").alias("value"), _model_col(field, model).alias("model"),
                       F.col("run").cast("string").alias("run"), F.col("param").cast("string").alias("param"))
    return _publish_bucketed(out, root, *_FIELD, buckets)


def field_publish_bucketed(field: DataFrame, root: str, table: str, buckets: int | None = None,
                           model: str | None = None) -> DataFrame:
    """:func:`field_commit_bucketed`, read back at the snapshot it committed.

    The scan is already hash-partitioned by (iy, ix), which satisfies every
    per-pixel window and every grouping that contains the pixel (W1, W2, J4,
    D1, A9), so those operators run without a shuffle.
    """
    snap = field_commit_bucketed(field, root, buckets, model)
    return bucketed_field(field.sparkSession, root, table, "member" in field.columns and model is None, model, snap.version)


def bucketed_field(spark: SparkSession, root: str, table: str, ensemble: bool = False, model: str | None = None,
                   version: int | None = None) -> DataFrame:
    """The bucketed field of one model, at the newest snapshot or a given one."""
    cols = ["run", "param"] + (["member"] if ensemble else []) + ["step", "iy", "ix", "value"]
    return (_attach(spark, root, table, *_FIELD, version)
            .where(F.col("model") == (model or (ENSEMBLE_MODEL if ensemble else DETERMINISTIC_MODEL))).select(*cols))


def series_publish_bucketed(series: DataFrame, root: str, table: str, buckets: int | None = None,
                            model: str | None = None) -> DataFrame:
    """The series layout partitioned by (model, run, param, cy) - chunk rows
    prune point lookups - and bucketed by pixel (iy, ix) - the seven series of
    a pixel meet without a shuffle (D1 on series)."""
    snap = _publish_bucketed(_series_rows(series, model), root, *_SERIES, buckets)
    return bucketed_series(series.sparkSession, root, table, "member" in series.columns and model is None, model, snap.version)


def bucketed_series(spark: SparkSession, root: str, table: str, ensemble: bool = False, model: str | None = None,
                    version: int | None = None) -> DataFrame:
    """The bucketed series of one model, at the newest snapshot or a given one."""
    cols = ["run", "param"] + (["member"] if ensemble else []) + ["cy", "cx", "iy", "ix", "steps", "vals"]
    return (_attach(spark, root, table, *_SERIES, version)
            .where(F.col("model") == (model or (ENSEMBLE_MODEL if ensemble else DETERMINISTIC_MODEL))).select(*cols))


def native_publish_bucketed(native: DataFrame, root: str, table: str, buckets: int | None = None,
                            model: str | None = None) -> DataFrame:
    """The native (unstructured) field partitioned by (model, run, param) and
    bucketed by ``src_id``; with weights bucketed the same way (same count),
    the remap join needs no shuffle."""
    member = F.col("member") if "member" in native.columns else F.lit(0)
    name = model or DETERMINISTIC_MODEL
    out = native.select(member.cast("int").alias("member"), F.col("step").cast("int").alias("step"),
                        F.col("src_id").cast("long").alias("src_id"), F.col("value").cast("double").alias("value"),
                        (_model_col(native, name)).alias("model"),
                        F.col("run").cast("string").alias("run"), F.col("param").cast("string").alias("param"))
    snap = _publish_bucketed(out, root, *_NATIVE, buckets)
    rows = _attach(native.sparkSession, root, table, *_NATIVE, snap.version)
    return (rows if "model" in native.columns else rows.where(F.col("model") == name)).select(
        "run", "param", "member", "step", "src_id", "value")


def weights_publish_bucketed(weights: DataFrame, root: str, table: str, buckets: int | None = None) -> DataFrame:
    """Remap weights with their per-target source count, bucketed by
    ``src_id`` (computed once per grid pair, reused by every remap job)."""
    from ..operators.remap import prepare_weights
    w = weights if "n_src" in weights.columns else prepare_weights(weights)
    snap = _publish_bucketed(w.select("method", F.col("dst_id").cast("long"), F.col("src_id").cast("long"), F.col("w").cast("double"),
                                      F.col("n_src").cast("long")), root, *_WEIGHTS, buckets)
    return _attach(weights.sparkSession, root, table, *_WEIGHTS, snap.version)
