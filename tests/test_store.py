"""Versioned stores: nothing is lost, mixed or seen too early, whatever the session's overwrite mode."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from isobar.plans import q_stores
from isobar.sources import fixtures as fx, store, versions

MODE = "spark.sql.sources.partitionOverwriteMode"


@pytest.fixture(params=["static", "dynamic"])
def mode(spark, request):
    held = spark.conf.get(MODE)
    spark.conf.set(MODE, request.param)
    yield request.param
    spark.conf.set(MODE, held)


def _field(spark, runs, params, rows=40, value=0.0):
    out = [(r, p, s, iy, iy % 7, value + s) for r in runs for p in params for s in range(3) for iy in range(0, rows * 3, 3)]
    return spark.createDataFrame(out, "run string, param string, step int, iy int, ix int, value double")


def _rows(df):
    return sorted(map(tuple, df.select("run", "param", "step", "iy", "ix", "value").collect()))


@pytest.mark.parametrize("kind", ["plain", "bucketed"])
def test_publications_replace_what_they_bring(spark, tmp_path, mode, kind):
    root = str(tmp_path / "s")

    def put(f):
        return store.field_publish(f, root) if kind == "plain" else store.field_commit_bucketed(f, root, 3)

    def get(version=None):
        return (store.field_scan(spark, root, version=version) if kind == "plain"
                else store.bucketed_field(spark, root, f"isobar_mode_{mode}", version=version))

    a, b = _field(spark, ["2026040300"], ["t_2m", "ps"]), _field(spark, ["2026040306"], ["t_2m"])
    smaller = _field(spark, ["2026040300"], ["t_2m"], rows=3, value=9.0)
    assert put(a).written() == [(store.DETERMINISTIC_MODEL, "2026040300", p) for p in ("ps", "t_2m")]
    two = put(b)
    assert [k[1:] for k in two.written()] == [("2026040306", "t_2m")]
    assert _rows(get()) == _rows(a.unionByName(b).withColumn("value", F.col("value").cast("float")))
    put(smaller)
    rest = a.where("param = 'ps'").unionByName(b).unionByName(smaller)
    assert _rows(get()) == _rows(rest.withColumn("value", F.col("value").cast("float")))
    assert _rows(get(two.version)) == _rows(a.unionByName(b).withColumn("value", F.col("value").cast("float")))
    if kind == "bucketed":
        with pytest.raises(ValueError, match="3 buckets"):
            store.field_commit_bucketed(a, root, 4)
        store.field_commit_bucketed(a, root)


@pytest.mark.parametrize("name", ["s4_publish_in_turn", "s4_republish_smaller"])
def test_stores_agree_in_both_modes(spark, mode, name):
    out = getattr(q_stores, name)(spark, SF_SMALL)
    per = out.groupBy("run", "param", "member", "step", "iy", "ix", "value").agg(F.count_distinct("store").alias("n"), F.count("*").alias("m"))
    assert per.count() > 0 and per.where("n <> 4 OR m <> 4").count() == 0


def test_a_failed_publication_shows_nothing(spark, tmp_path):
    root = str(tmp_path / "s")
    a = _field(spark, ["2026040300"], ["t_2m"])
    store.field_publish(a, root)
    broken = a.withColumn("value", F.when(F.col("iy") > 60, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        store.field_publish(broken, root)
    assert versions.snapshot(spark, root).version == 1
    assert store.field_scan(spark, root).count() == a.count()
    # a commit that was begun but not written is passed over, and its number not used again
    (tmp_path / "s" / "_snapshots" / "00000002.json").write_text("{")
    assert store.field_scan(spark, root).count() == a.count()
    assert store.field_publish(_field(spark, ["2026040306"], ["ps"]), root).version == 3


def test_two_writers_both_keep_their_keys(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    store.field_publish(_field(spark, ["2026040300"], ["t_2m"]), root)
    real, raced = versions._commits, []

    def slow(spark_, root_):
        seen = real(spark_, root_)
        if not raced:  # another writer commits between this one's look and its commit
            raced.append(1)
            store.field_publish(_field(spark, ["2026040306"], ["ps"]), root)
        return seen

    monkeypatch.setattr(versions, "_commits", slow)
    folder = versions.new_folder(versions.Snapshot())
    versions.commit(spark, root, lambda now, v: versions.Snapshot(v, {**now.entries, ("m", "r", "p"): versions.Entry(folder, v)}))
    assert {k[2] for k in versions.snapshot(spark, root).entries} == {"t_2m", "ps", "p"}


def test_vacuum_keeps_what_snapshots_need(spark, tmp_path):
    root = str(tmp_path / "s")
    for v in range(4):
        store.field_publish(_field(spark, ["2026040300"], ["t_2m"], value=float(v)), root)
    gone = versions.vacuum(spark, root, keep=1)
    assert len(gone) == 3
    assert store.field_scan(spark, root).agg(F.min("value")).first()[0] == 3.0
    with pytest.raises(FileNotFoundError):
        store.field_scan(spark, root, version=1)


def test_ingest_marks_only_what_it_wrote(spark, tmp_path):
    from isobar.plans import jobs
    root = str(tmp_path / "s")
    store.field_publish(_field(spark, ["2026040300"], ["t_2m", "ps"]), root)
    native = spark.createDataFrame([("2026040300", "t_2m", 0, 0, 1, 5.0)], "run string, param string, member int, step int, src_id long, value double")
    weights = spark.createDataFrame([("distance", 0, 1, 1.0)], "method string, dst_id long, src_id long, w double")
    listing = spark.createDataFrame([("2026040300", p, 0, 50000, 200) for p in ("t_2m", "ps")],
                                    "run string, param string, step int, n_bytes long, status int")
    marks = jobs.ingest(native, weights, listing, root)
    assert [(r["run"], r["param"]) for r in marks.collect()] == [("2026040300", "t_2m")]


def test_zone_checks_read_no_field_rows(spark, tmp_path):
    from isobar.operators import quality, zones
    root = str(tmp_path / "s")
    x = fx.x1_field(spark, SF_SMALL, with_nan=True)
    store.field_publish(x, root, zones=True)
    z = store.zone_scan(spark, root, run="2026040300", params=["t_2m", "ps"])
    f = store.field_scan(spark, root, run="2026040300", params=["t_2m", "ps"])
    for name in ("bounds_check", "smoke_sample", "frame_range"):
        got, want = getattr(zones, name)(z), getattr(quality, name)(f)
        assert not any("/data/" in p for p in got.inputFiles()) and got.inputFiles()
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.select(*got.columns).collect())))
    store.field_publish(x.where("param = 'ps'"), root)
    with pytest.raises(FileNotFoundError, match="without zones"):
        store.zone_scan(spark, root)


def _chunk_reader(root, filters=()):
    from isobar.sources import chunk_source
    r = chunk_source.ChunkReader(chunk_source.StructType.fromDDL(chunk_source.ChunkSource({"path": root}).schema()), {"path": root})
    rest = list(r.pushFilters(list(filters)))
    return r, rest


def test_chunk_source_opens_only_chunks_that_match(spark, tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan

    from isobar.sources import chunk_source, chunks
    root = chunks.qualified(spark, str(tmp_path / "z"))
    rows = [(r, p, s, iy, ix, float(iy + s)) for r in ("2026040300", "2026040306") for p in ("t_2m", "ps") for s in (0, 3)
            for iy in range(0, 200, 10) for ix in range(0, 200, 10)]
    chunks.chunk_export(spark.createDataFrame(rows, "run string, param string, step int, iy int, ix int, value double"), root, chunk=(50, 50))
    files = lambda *f: sum(len(p.keys) for p in _chunk_reader(root, f)[0].partitions())
    assert files() == 4 * 16
    assert files(EqualTo(("run",), "2026040300")) == 2 * 16
    assert files(In(("param",), ("ps", "x")), GreaterThanOrEqual(("iy",), 100)) == 2 * 8
    assert files(EqualTo(("cy",), 1), LessThan(("cx",), 2), EqualTo(("param",), "ps"), EqualTo(("run",), "2026040306")) == 2
    assert files(EqualTo(("step",), 1), GreaterThanOrEqual(("step",), 4)) == 0
    _, rest = _chunk_reader(root, [EqualTo(("iy",), 3), EqualTo(("run",), "a"), EqualTo(("value",), 1.0)])
    assert [f.attribute for f in rest] == [("iy",), ("value",)]
    # a chunk that a query needs not is not opened: it may be unreadable
    for bad in (tmp_path / "z" / "2026040300" / "ps" / "ps").glob("0.3.*"):
        bad.write_bytes(b"junk")
    chunk_source.register(spark)
    df = spark.read.format(chunk_source.NAME).option("path", root).load()
    got = df.where("run = '2026040300' AND param = 'ps' AND iy < 150 AND step = 3").collect()
    assert len(got) == 15 * 20 and {r["step"] for r in got} == {3} and {r["cy"] for r in got} == {0, 1, 2}
    with pytest.raises(Exception, match="append"):
        df.write.format(chunk_source.NAME).mode("overwrite").option("path", root).save()


def test_chunk_source_takes_the_only_array_of_another_name(spark, tmp_path):
    from isobar.sources import chunk_source, chunks
    root = chunks.qualified(spark, str(tmp_path / "z"))
    one = spark.createDataFrame([("2026040300", "t", s, 1, 2, 5.0 + s) for s in range(3)], "run string, param string, step int, iy int, ix int, value double")
    chunks.chunk_export(one, root)
    # the group of param "t" under another param's name
    (tmp_path / "z" / "2026040300" / "t").rename(tmp_path / "z" / "2026040300" / "renamed")
    chunk_source.register(spark)
    got = spark.read.format(chunk_source.NAME).option("path", root).load().collect()
    assert sorted((r["param"], r["step"], r["value"]) for r in got) == [("renamed", s, 5.0 + s) for s in range(3)]


def test_lookup_past_the_broadcast_bound_does_not_shuffle_the_series(spark, tmp_path):
    """Requests too many to broadcast go to the buckets of the stored series."""
    from isobar.operators import serving
    series = serving.series_pack(fx.x1_field(spark, SF_SMALL))
    requests = fx.x3b_requests(spark, SF_SMALL)
    stored = store.series_publish_bucketed(series, str(tmp_path / "b"), "isobar_test_lookup", 8)
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    held = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        out = serving.point_lookup(stored, requests, max_broadcast=0)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(repr, map(tuple, out.collect())))
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert got == sorted(map(repr, map(tuple, serving.point_lookup(series, requests).collect()))) and got
