"""What a task holds stays bounded as tables grow."""

from pyspark.sql import functions as F

from isobar.operators import joins, remap
from isobar.plans import q_stores
from isobar.sources import chunks, fixtures as fx, store


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_small_chunks_are_dealt_to_as_many_tasks_as_they_need(spark, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNKS_PER_TASK", 10)
    field = spark.range(600).select(F.lit("2026040300").alias("run"), F.lit("ps").alias("param"), F.lit(0).alias("step"),
                                    (F.col("id") / 10).cast("int").alias("iy"), (F.col("id") % 10).cast("int").alias("ix"),
                                    F.col("id").cast("double").alias("value"))
    rows = chunks.chunk_rows(field, (1, 5))
    assert rows.rdd.getNumPartitions() >= 10  # 120 chunks, counted approximately
    assert rows.count() == 600


def test_remap_deals_out_its_sums(spark, monkeypatch):
    monkeypatch.setattr(joins, "GROUPED_ROWS", 5)
    native = spark.range(300).select(F.lit("2026040300").alias("run"), F.lit("t_2m").alias("param"), F.lit(0).alias("member"),
                                     (F.col("id") % 3).cast("int").alias("step"), F.floor(F.col("id") / 3).alias("src_id"),
                                     F.col("id").cast("double").alias("value"))
    weights = spark.range(100).select(F.lit("distance").alias("method"), F.floor(F.col("id") / 2).alias("dst_id"),
                                      F.col("id").alias("src_id"), F.lit(0.5).alias("w"))
    out = remap.remap_apply(native, weights)
    assert "RepartitionByExpression" in _plan(out)
    got = {(r.step, r.dst_id): r.value for r in out.collect()}
    assert got == {(s, d): 0.5 * (6 * d + s) + 0.5 * (6 * d + 3 + s) for s in range(3) for d in range(50)}


def test_bucketed_publication_uses_more_tasks_than_buckets(spark, tmp_path):
    field = spark.range(400).select(F.lit("2026040300").alias("run"), F.concat(F.lit("p"), F.col("id") % 8).alias("param"),
                                    F.lit(0).alias("step"), F.floor(F.col("id") / 8).cast("int").alias("iy"), F.lit(1).alias("ix"),
                                    F.col("id").cast("double").alias("value"))
    root, merging = str(tmp_path / "bucketed"), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        snap = store.field_commit_bucketed(field, root, 2)
    finally:
        spark.conf.unset(merging)
    files = [f for e in snap.entries.values() for f in (tmp_path / "bucketed" / e.path).glob("*.parquet")]
    assert len(files) == 16  # a file per param and bucket
    writers = {f.name.split("-")[1] for f in files}
    assert len(writers) > 2


def test_publications_in_turn_read_the_table_once(spark, monkeypatch):
    read = []
    monkeypatch.setattr(q_stores.store, "field_publish", lambda part, root: read.append(_plan(part)))
    monkeypatch.setattr(q_stores.store, "field_commit_bucketed", lambda part, root, n: read.append(_plan(part)))
    for name in ("series_publish", "series_publish_bucketed"):
        monkeypatch.setattr(q_stores.store, name, lambda pack, *a: read.append(_plan(pack)))
    x1 = fx.x1_field(spark, "/root/testdata/sf0.001")
    kept = q_stores._kept(x1, "x1")
    monkeypatch.setattr(q_stores.store, "field_scan", lambda *a, **k: (_ for _ in ()).throw(StopIteration))
    try:
        q_stores._all_stores(spark, [kept, kept])
    except (StopIteration, RuntimeError):
        pass
    assert len(read) == 8 and not any("Aggregate" in p for p in read)
