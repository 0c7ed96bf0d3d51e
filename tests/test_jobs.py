"""End-to-end jobs on fixture data."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from isobar.operators import derive, remap, serving
from isobar.plans import jobs
from isobar.sources import fixtures as fx, store


def test_ingest_publishes_remapped_field(spark, tmp_path):
    nat = fx.x5_native(spark, SF_SMALL)
    w = fx.x5_weights(spark, SF_SMALL, "distance").unionByName(fx.x5_weights(spark, SF_SMALL, "conservative"))
    listing = nat.select("run", "param", "step").distinct().withColumn("n_bytes", F.lit(50000).cast("long")) \
        .withColumn("status", F.lit(200))
    root = str(tmp_path / "store")
    marks = jobs.ingest(nat, w, listing, root)
    assert marks.count() == listing.select("run", "param").distinct().count()
    got = store.field_scan(spark, root)
    want = jobs.cell_of_dst(remap.remap_apply(nat, w))
    assert got.count() == want.count()
    j = got.join(want.select("run", "param", "step", "iy", "ix", F.col("value").alias("w")), ["run", "param", "step", "iy", "ix"])
    assert j.where(~((F.col("value") == F.col("w")) | (F.isnan("value") & F.isnan("w")))).count() == 0


def test_derive_pet_from_store(spark, tmp_path):
    root = str(tmp_path / "store")
    x1 = fx.x1_field(spark, SF_SMALL)
    store.field_publish(x1, root)
    markers = fx.x4_lifecycle_markers(spark, SF_SMALL)
    m = jobs.derive_pet(spark, root, markers, run="2026040300")
    assert [r.param for r in m.collect()] == ["pet_pm"]
    got = store.field_scan(spark, root, run="2026040300", params=["pet_pm"])
    src = store.field_scan(spark, root, run="2026040300", params=list(derive.PET_INPUTS))
    want = derive.pet_pm(src)
    assert got.count() == want.count() > 0


def test_answer_points_statuses(spark):
    x1 = fx.x1_field(spark, SF_SMALL)
    series = serving.series_pack(x1)
    req = fx.x3b_requests(spark, SF_SMALL)
    out = jobs.answer_points(req, series, fx.x4_lifecycle_markers(spark, SF_SMALL), whitelist=["t_2m", "ps"])
    rows = out.collect()
    assert len({r.req_id for r in rows}) == len(rows) == req.count()
    st = {r.status for r in rows}
    assert 200 in st and 400 in st
    eps = serving.series_pack(fx.x7_ensemble(spark, SF_SMALL))
    both = jobs.answer_points(req, series, fx.x4_lifecycle_markers(spark, SF_SMALL), whitelist=["t_2m", "ps"],
                              ensemble_series=eps).collect()
    assert len(both) == req.count()
    wants = {r.req_id for r in req.where("ensemble = 'true'").collect()}
    assert all(('"members"' in r.body) == (r.req_id in wants) for r in both if r.status == 200)
    nobody = jobs.answer_points(req, series, fx.x4_markers(spark, SF_SMALL), whitelist=["t_2m", "ps"])
    assert nobody.where("status = 503").count() > 0 and nobody.count() == req.count()


def test_validate_and_finalize(spark):
    x1 = fx.x1_field(spark, SF_SMALL)
    runs = x1.select("run").unionByName(spark.createDataFrame([("2026050100",)], "run string"))
    res = jobs.validate_and_finalize(x1, fx.x4_markers(spark, SF_SMALL), "2026040300", derive.PET_INPUTS, runs,
                                     staging=runs, keep=1)
    assert [r.run for r in res["index"].collect()] == ["2026040300"]
    assert [(r.run, r.payload) for r in res["latest"].collect()] == [("2026040300", "2026040300")]
    assert {r.run for r in res["retention"].where("keep").collect()} == {"2026040300", "2026050100"}
    assert {r.run for r in res["orphans"].collect()} == {"2026040306", "2026040312"}


def test_finalize_refuses(spark):
    x1, mk = fx.x1_field(spark, SF_SMALL), fx.x4_markers(spark, SF_SMALL)
    with pytest.raises(RuntimeError, match="ps"):  # one marker is missing
        jobs.finalize(x1, mk, "2026040306", derive.PET_INPUTS, x1.select("run"))
    with pytest.raises(RuntimeError, match="not promoted"):
        jobs.finalize(x1, mk, "2026040312", derive.PET_INPUTS, x1.select("run"))
    with pytest.raises(RuntimeError, match="pet_pm"):  # a derived layer is not there yet
        jobs.validate_and_finalize(x1, mk, "2026040300", derive.PET_INPUTS, x1.select("run"), derived=["pet_pm"])


def test_derive_pet_needs_all_inputs(spark, tmp_path):
    root = str(tmp_path / "store")
    store.field_publish(fx.x1_field(spark, SF_SMALL).where("param <> 'ps'"), root)
    with pytest.raises(FileNotFoundError, match="ps"):
        jobs.derive_pet(spark, root, fx.x4_lifecycle_markers(spark, SF_SMALL), run="2026040300")
    with pytest.raises(FileNotFoundError, match="pet_pm"):
        store.field_scan(spark, root, params=["pet_pm"])
    with pytest.raises(FileNotFoundError, match="2026040301"):
        store.field_scan(spark, root, run="2026040301")


def test_ingest_of_an_ensemble_and_of_nothing(spark, tmp_path):
    nat = fx.x5_native(spark, SF_SMALL).where("run = '2026040300' AND param IN ('t_2m', 'ps') AND step IN (0, 1)")
    nat = nat.withColumn("member", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    w = fx.x5_weights(spark, SF_SMALL, "distance").unionByName(fx.x5_weights(spark, SF_SMALL, "conservative"))
    listing = nat.select("run", "param", "member", "step").distinct().withColumn(
        "n_bytes", F.when((F.col("param") == "ps") & (F.col("member") == 2), 300).otherwise(50000).cast("long")).withColumn(
        "status", F.when(F.col("param") == "ps", F.when(F.col("member") == 1, 404).otherwise(200)).otherwise(200))
    root = str(tmp_path / "eps")
    marks = jobs.ingest(nat, w, listing, root, members=3, zero_grid=(2, 3))
    assert {r.param for r in marks.collect()} == {"t_2m", "ps"}
    got = store.field_scan(spark, root, ensemble=True)
    assert {(r.param, r.member) for r in got.select("param", "member").distinct().collect()} == {
        ("t_2m", 0), ("t_2m", 1), ("t_2m", 2), ("ps", 0), ("ps", 2)}
    zero = got.where("param = 'ps' AND member = 2")
    assert zero.count() == 2 * 6 and zero.where("value <> 0").count() == 0
    assert store.field_scan(spark, root).count() == 0  # nothing under the deterministic model
    none = listing.withColumn("status", F.when(F.col("param") == "ps", 404).otherwise(F.col("status")))
    with pytest.raises(RuntimeError, match="ps run=2026040300: no forecast steps"):
        jobs.ingest(nat, w, none, root, members=3, zero_grid=(2, 3))
    assert [r.param for r in jobs.ingest(nat, w, none, str(tmp_path / "e2"), members=3, on_empty="skip", zero_grid=(2, 3)).collect()] == ["t_2m"]
    existing = spark.createDataFrame([("staging/2026040300/ps",), ("staging/2026040300/t_2m",)], "path string")
    gone = jobs.failed_cleanup(existing, jobs.ingest_failures(none, members=3))
    assert [r.path for r in gone.collect()] == ["staging/2026040300/ps"]


def test_marker_table_append_and_latest(spark, tmp_path):
    from isobar.operators import lifecycle
    root = str(tmp_path / "markers")
    mk = fx.x4_lifecycle_markers(spark, SF_SMALL)
    store.append_markers(mk.where(F.col("marker") != "_LATEST_RUN"), root)
    store.append_markers(mk.where(F.col("marker") == "_LATEST_RUN"), root)
    back = store.read_markers(spark, root)
    assert back.count() == mk.count()
    assert lifecycle.latest_run(back).collect()[0].run == lifecycle.latest_run(mk).collect()[0].run


def test_ingest_into_bucketed_store(spark, tmp_path):
    nat = fx.x5_native(spark, SF_SMALL)
    w = fx.x5_weights(spark, SF_SMALL, "distance").unionByName(fx.x5_weights(spark, SF_SMALL, "conservative"))
    listing = nat.select("run", "param", "step").distinct().withColumn("n_bytes", F.lit(50000).cast("long")) \
        .withColumn("status", F.lit(200))
    marks = jobs.ingest(nat, w, listing, str(tmp_path / "bk"), bucketed=True, buckets=4)
    assert marks.count() == listing.select("run", "param").distinct().count()
    f = store.bucketed_field(spark, str(tmp_path / "bk"), "isobar_test_ingest_b")
    assert f.count() == jobs.cell_of_dst(remap.remap_apply(nat, w)).count()


def test_store_keeps_ensemble_and_deterministic_apart(spark, tmp_path):
    root = str(tmp_path / "store")
    x7 = fx.x7_ensemble(spark, SF_SMALL)
    det = x7.where(F.col("member") == 0).drop("member")
    store.field_publish(det, root)
    store.field_publish(x7, root)  # same run and param, other model: nothing replaced
    assert store.field_scan(spark, root).count() == det.count()
    assert store.field_scan(spark, root, ensemble=True).count() == x7.count()
