"""The adaptive source tree against brute force, and the bounds it promises."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.operators import knn_tree, remap

SRC, DST = "src_id long, lat double, lon double", "dst_id long, lat double, lon double"


def brute(src, dst, k):
    s = np.array([(la, lo) for _, la, lo in src])
    ids = np.array([i for i, _, _ in src])
    out = {}
    for t, la, lo in dst:
        p1, p2 = np.radians(la), np.radians(s[:, 0])
        a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(s[:, 1] - lo) / 2) ** 2
        dist = np.floor(2 * remap.EARTH_RADIUS_KM * np.arcsin(np.minimum(np.sqrt(a), 1)) * 1e6 + 0.5) / 1e6
        order = np.lexsort((ids, dist))[:k]
        out[t] = [(int(ids[i]), round(float(dist[i]), 5)) for i in order]
    return out


@pytest.fixture(scope="module")
def uneven():
    """A dense cluster, one place many times, the date line, the poles and a few sources elsewhere."""
    r = np.random.default_rng(5)
    spots = [(51.0 + a, 7.0 + b) for a, b in r.uniform(0, 0.02, (6000, 2))]
    spots += [(-33.25, 151.5)] * 120
    spots += [(a, b) for a, b in zip(r.uniform(-2, 2, 60), r.choice([-179.9, 179.95, 180.0, -180.0], 60))]
    spots += [(a, b) for a, b in zip(r.choice([90.0, -90.0, 89.99], 30), r.uniform(-180, 180, 30))]
    spots += [(a, b) for a, b in zip(r.uniform(-90, 90, 80), r.uniform(-180, 180, 80))]
    src = [(i, float(a), float(b)) for i, (a, b) in enumerate(spots)]
    near = [(51.01, 7.01), (51.0, 7.0), (50.0, 8.0), (-51.0, -173.0), (-33.25, 151.5), (-33.2, 151.4), (0.5, 180.0), (0.5, -179.99),
            (90.0, 0.0), (-90.0, 77.0), (89.9, -120.0), src[17][1:]]
    near += [(float(a), float(b)) for a, b in zip(r.uniform(-90, 90, 25), r.uniform(-180, 180, 25))]
    return src, [(i, *x) for i, x in enumerate(near)]


def test_tree_neighbours_match_brute_force(spark, uneven):
    src, dst = uneven
    got = {}
    for r in knn_tree.idw_weights_tree(spark.createDataFrame(src, SRC), spark.createDataFrame(dst, DST), k=4).collect():
        got.setdefault(r.dst_id, {})[r["rank"]] = r
    want = brute(src, dst, 4)
    assert got.keys() == want.keys()
    for t, rows in want.items():
        assert [(got[t][n + 1].src_id, round(got[t][n + 1].dist, 5)) for n in range(4)] == rows
        assert sum(x.w for x in got[t].values()) == pytest.approx(1.0)
    # 120 sources lie on target 4: the four smallest ids share its weight
    assert [got[4][n].w for n in (1, 2, 3, 4)] == [0.25] * 4


def test_leaves_and_candidates_are_bounded(spark, uneven):
    src, dst = uneven
    nodes, points, last = knn_tree.source_tree(spark.createDataFrame(src, SRC), leaf=16, keep=4)
    nodes = nodes.checkpoint()
    assert nodes.where("is_leaf and cnt > 16").count() == 0  # the repeated place counts four times
    assert last > knn_tree.FIRST_LEVEL + 2 * knn_tree.STEP  # the cluster goes deeper than the rest
    assert points.count() == nodes.where("is_leaf").agg(F.sum("cnt")).first()[0] == len(src) - 116
    per_target = knn_tree.nearest_leaves(nodes, last, spark.createDataFrame(dst, DST), 4).groupBy("dst_id").count()
    # a target far from the cluster meets only the leaves along the near edge, not all of the cluster's
    assert nodes.where("is_leaf").count() > 1500
    assert per_target.agg(F.max("count")).first()[0] <= 120


def test_tree_of_few_or_no_sources(spark):
    dst = spark.createDataFrame([(1, 10.0, 20.0), (2, None, 3.0)], DST)
    assert knn_tree.idw_weights_tree(spark.createDataFrame([], SRC), dst).count() == 0
    two = knn_tree.idw_weights_tree(spark.createDataFrame([(5, 10.0, 21.0), (6, 10.0, 23.0), (7, None, None)], SRC), dst).collect()
    assert [(r.dst_id, r.src_id, r["rank"], round(r.w, 2)) for r in sorted(two, key=lambda r: r["rank"])] == [(1, 5, 1, 0.75), (1, 6, 2, 0.25)]


def test_descent_reads_the_targets_once_however_deep(spark, uneven):
    src, dst = uneven
    nodes, _, last = knn_tree.source_tree(spark.createDataFrame(src, SRC), leaf=16, keep=4)
    plan = knn_tree.nearest_leaves(nodes, last, spark.createDataFrame(dst, DST), 4)._jdf.queryExecution().optimizedPlan().toString()
    assert last >= 9 and plan.count("Generate explode") == 1
