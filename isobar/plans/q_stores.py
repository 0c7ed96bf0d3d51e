"""Queries: parquet store round trips (S3, S4), chunk files (S5, S6), manifests."""

from __future__ import annotations

import gzip
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources import chunk_source, chunks, fixtures as fx, store
from .catalog import register
from .q_quality import _a1
from .sqltext import with_fixtures


def _scratch(spark, name: str) -> str:
    """A fresh folder for this query under the shared checkpoint location."""
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex}")


def _published(spark, sf):
    root = _scratch(spark, "store")
    store.field_publish(fx.x1_field(spark, sf), root)
    return root


@register("S4_field_publish", with_fixtures(["x1"], """
SELECT run, param, step, iy, ix, CAST(value AS FLOAT) AS value FROM x1"""))
def s4_field_publish(spark, sf):
    return store.field_scan(spark, _published(spark, sf))


_F1, _F2 = "'2026040300'", "'2026040306'"


# Two runs, then an ensemble and a deterministic field of the same run and
# param, then the first run again: each publication replaces its own
# partitions only, in the plain, series and bucketed stores.
@register("S4_publish_in_turn", with_fixtures(["x1", "x7"], f"""
det AS (SELECT run, param, step, iy, ix, CAST(value AS FLOAT) AS value FROM x1 WHERE run IN ({_F1}, {_F2})),
eps AS (SELECT run, param, member, step, iy, ix, CAST(value AS FLOAT) AS value FROM x7),
a AS (SELECT run, param, CAST(NULL AS INTEGER) AS member, step, iy, ix, value FROM det UNION ALL
  SELECT run, param, member, step, iy, ix, value FROM eps)
SELECT store, a.* FROM a, (VALUES ('plain'), ('series'), ('bucketed'), ('bucketed_series')) s(store)"""))
def s4_publish_in_turn(spark, sf):
    x1, x7 = _kept(fx.x1_field(spark, sf), "x1"), _kept(fx.x7_ensemble(spark, sf), "x7")
    one, two = x1.where(F.col("run") == "2026040300"), x1.where(F.col("run") == "2026040306")
    return _all_stores(spark, [one, two, x7, one])


def _kept(df, name):
    """``df`` written once, for all that is published of it."""
    path = _scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _all_stores(spark, fields):
    """The fields published one after the other into each kind of store, and what each then holds."""
    from ..operators.serving import series_pack
    tag = uuid.uuid4().hex
    root = {k: _scratch(spark, k) for k in ("plain", "series", "bucketed", "bucketed_series")}
    packs = {id(part): _kept(series_pack(part), "pack") for part in fields}
    for part in fields:
        pack = packs[id(part)]
        store.field_publish(part, root["plain"])
        store.series_publish(pack, root["series"])
        store.field_commit_bucketed(part, root["bucketed"], 4)
        store.series_publish_bucketed(pack, root["bucketed_series"], f"isobar_turns_{tag}", 4)
    out = None
    for ens in (False, True):
        member = F.col("member") if ens else F.lit(None).cast("int")

        def rows(df, name, member=member):
            return df.select(F.lit(name).alias("store"), "run", "param", member.alias("member"), "step", "iy", "ix", "value")

        def unpacked(df):
            e = df.withColumn("e", F.explode(F.arrays_zip("steps", "vals")))
            return e.withColumn("step", F.col("e.steps")).withColumn("value", F.col("e.vals"))
        for part in (rows(store.field_scan(spark, root["plain"], ensemble=ens), "plain"),
                     rows(unpacked(store.series_scan(spark, root["series"], ens)), "series"),
                     rows(store.bucketed_field(spark, root["bucketed"], f"isobar_turn_{tag}", ensemble=ens), "bucketed"),
                     rows(unpacked(store.bucketed_series(spark, root["bucketed_series"], f"isobar_turns_{tag}", ensemble=ens)),
                          "bucketed_series")):
            out = part if out is None else out.unionByName(part)
    return out


# A run is published again with fewer rows and steps, but only
# some params of it: those are replaced as a whole, the others stay.
@register("S4_republish_smaller", with_fixtures(["x1"], f"""
a AS (SELECT run, param, CAST(NULL AS INTEGER) AS member, step, iy, ix, CAST(value AS FLOAT) AS value FROM x1
  WHERE run = {_F1} AND (param NOT IN ('t_2m', 'ps') OR (iy < 1 AND step < 6)) OR run = {_F2})
SELECT store, a.* FROM a, (VALUES ('plain'), ('series'), ('bucketed'), ('bucketed_series')) s(store)"""))
def s4_republish_smaller(spark, sf):
    x1 = _kept(fx.x1_field(spark, sf).where(F.col("run").isin("2026040300", "2026040306")), "x1")
    small = x1.where((F.col("run") == "2026040300") & F.col("param").isin("t_2m", "ps") & (F.col("iy") < 1) & (F.col("step") < 6))
    return _all_stores(spark, [x1, small])


# A reader of the snapshot before a publication goes on reading that one.
@register("S4_pinned_snapshot", with_fixtures(["x1"], f"""
SELECT run, param, step, iy, ix, CAST(value AS FLOAT) AS value FROM x1 WHERE run = {_F1}"""))
def s4_pinned_snapshot(spark, sf):
    root = _scratch(spark, "pinned")
    one = fx.x1_field(spark, sf).where(F.col("run") == "2026040300")
    first = store.field_publish(one, root)
    store.field_publish(one.where("step < 3").withColumn("value", F.lit(-1.0)), root)
    store.field_publish(fx.x1_field(spark, sf).where(F.col("run") == "2026040306"), root)
    return store.field_scan(spark, root, version=first.version)


@register("S3_field_scan", with_fixtures(["x1"], """
SELECT run, param, step, iy, ix, CAST(value AS FLOAT) AS value FROM x1
WHERE run = '2026040300' AND param IN ('t_2m', 'ps') AND step IN (0, 1, 2, 78)"""))
def s3_field_scan(spark, sf):
    return store.field_scan(spark, _published(spark, sf), run="2026040300", params=["t_2m", "ps"],
                            steps=[0, 1, 2, 78])


def _raw_chunks(batches):
    """Valid cells, least and largest value of each written file, from its bytes alone."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            v = np.frombuffer(gzip.decompress(r["content"]), "<f4")
            v = v[~np.isnan(v)]
            out.append({"file": r["path"], "n_valid": len(v), "vmin": float(v.min()) if len(v) else None,
                        "vmax": float(v.max()) if len(v) else None})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("file", pa.string()), ("n_valid", pa.int64()),
                                                                ("vmin", pa.float64()), ("vmax", pa.float64())]))


@register("S5_chunk_export", with_fixtures(["x1n"], """
SELECT run, param, CAST(floor(iy / 50) AS INTEGER) AS cy, CAST(floor(ix / 50) AS INTEGER) AS cx,
  count(*) FILTER (WHERE NOT isnan(value)) AS n_valid,
  min(CAST(CAST(value AS FLOAT) AS DOUBLE)) FILTER (WHERE NOT isnan(value)) AS vmin,
  max(CAST(CAST(value AS FLOAT) AS DOUBLE)) FILTER (WHERE NOT isnan(value)) AS vmax
FROM x1n GROUP BY run, param, CAST(floor(iy / 50) AS INTEGER), CAST(floor(ix / 50) AS INTEGER)"""))
def s5_chunk_export(spark, sf):
    path = _scratch(spark, "zarr")
    written = chunks.chunk_export(fx.x1_field(spark, sf, with_nan=True), path, chunk=(50, 50))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "0.*").load(f"{path}/*/*/*").select("path", "content")
    content = files.mapInArrow(_raw_chunks, "file string, n_valid long, vmin double, vmax double")
    return written.join(content, "file").select("run", "param", "cy", "cx", "n_valid", "vmin", "vmax")


_X1N_SQL = with_fixtures(["x1n"], "SELECT run, param, step, iy, ix, CAST(value AS FLOAT) AS value FROM x1n")


@register("S6_chunk_scan", _X1N_SQL)
def s6_chunk_scan(spark, sf):
    path = _scratch(spark, "zarr")
    chunks.chunk_export(fx.x1_field(spark, sf, with_nan=True), path)
    return chunks.chunk_scan(spark, path)


@register("S6_chunk_source", _X1N_SQL)
def s6_chunk_source(spark, sf):
    """Through the data source."""
    path = _scratch(spark, "zarr")
    chunks.chunk_export(fx.x1_field(spark, sf, with_nan=True), path, chunk=(25, 100))
    return _source(spark, path).select("run", "param", "step", "iy", "ix", "value")


def _source(spark, path, **options):
    chunk_source.register(spark)
    return spark.read.format(chunk_source.NAME).options(path=chunks.qualified(spark, path), **options).load()


@register("S6_chunk_source_box", with_fixtures(["x1n"], """
SELECT run, param, step, iy, ix, CAST(value AS FLOAT) AS value FROM x1n
WHERE run = '2026040306' AND param IN ('t_2m', 'ps') AND iy >= 1 AND iy < 15 AND ix <= 5 AND step BETWEEN 1 AND 78"""))
def s6_chunk_source_box(spark, sf):
    """Filters on run, param, cells and steps reach the source."""
    path = _scratch(spark, "zarr")
    chunks.chunk_export(fx.x1_field(spark, sf, with_nan=True), path, chunk=(1, 3))
    rows = _source(spark, path).where("run = '2026040306' AND param IN ('t_2m', 'ps') AND iy >= 1 AND iy < 15 AND ix <= 5")
    return rows.where("step >= 1 AND step <= 78").select("run", "param", "step", "iy", "ix", "value")


@register("S6_chunk_scan_small", _X1N_SQL)
def s6_chunk_scan_small(spark, sf):
    """Chunks of another shape: the reader takes it from the array's metadata."""
    path = _scratch(spark, "zarr")
    chunks.chunk_export(fx.x1_field(spark, sf, with_nan=True), path, chunk=(7, 50))
    return chunks.chunk_scan(spark, path)


@register("S6_chunk_scan_eps", with_fixtures(["x7"], """
SELECT run, param, member, step, iy, ix, CAST(value AS FLOAT) AS value FROM x7"""))
def s6_chunk_scan_eps(spark, sf):
    """Four dimensions, all members in one chunk."""
    path = _scratch(spark, "zarr")
    chunks.chunk_export(fx.x7_ensemble(spark, sf), path)
    return chunks.chunk_scan(spark, path, ensemble=True)


@register("S9_read_manifest", with_fixtures(["x2_expected"], """
SELECT e.run, e.param, e.step, l.step IS NOT NULL AS is_available FROM x2_expected e
  LEFT JOIN x2 l ON e.run = l.run AND e.param = l.param AND e.step = l.step AND l.status = 200"""))
def s9_read_manifest(spark, sf):
    path = _scratch(spark, "manifest")
    store.write_manifest(_a1(spark, sf), path)
    return store.read_manifest(spark, path)


