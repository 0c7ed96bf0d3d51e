"""Near duplicates, lines and substrings against their plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from llmfixtures import make, words  # noqa: F401
from isobar.llm import components, linededup, neardup, substrings


def _family(words, n, seed, length=60, edits=6):
    """n variants of one text, each with a few words changed."""
    base, r = words(length, seed), random.Random(seed)
    out = [" ".join(base)]
    for _ in range(n - 1):
        w = list(base)
        for _ in range(r.randrange(edits)):
            w[r.randrange(length)] = f"e{r.randrange(50)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def near_rows(words):
    rows, n = [], 100
    for seed in range(12):
        for t in _family(words, 8, seed):
            rows.append((n, t))
            n += 1
    rows += [(5, rows[0][1]), (3, rows[0][1].upper()), (7, "two words"), (8, "Two  words"), (9, ""), (10, None), (11, " \n"),
             (None, rows[20][1]), (None, "all alone without an id here"), (5, rows[0][1]), (12, "one")]
    return rows


@pytest.mark.parametrize("k,percent,more", [(3, 85, {}), (5, 80, {}), (3, 85, {"node": 4, "leaf": 2, "family_work": 1.0}), (3, 85, {"node": 2, "levels": 2}), (3, 85, {"leaf": 2})])
def test_near_duplicates_equal_all_pairs(make, near_rows, k, percent, more):
    want = brute.near_components(near_rows, k, percent)
    got = neardup.near_duplicates(make(near_rows), k, percent, **more).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == sorted(
        ((doc, *w) for (doc, _), w in zip(near_rows, want)), key=str)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("percent", [80, 85])
def test_deep_nodes_keep_pairs_at_the_threshold(percent):
    """Pairs at the threshold among strangers that share half of all coordinates, so that nodes split slowly."""
    r = np.random.default_rng(percent)
    n, width = 1500, neardup.COORDINATES
    common = r.integers(0, 256, width)
    one = np.where(r.random((n, width)) < 0.5 ** 0.5, common, r.integers(0, 256, (n, width)))
    two = np.where(r.random((n, width)) < percent / 100, one, r.integers(0, 256, (n, width)))
    sketch, size = np.concatenate([one, two]).astype(np.uint8), np.full(2 * n, 100)
    at = percent / 100 - 2 * np.sqrt(percent * (100 - percent) / 1e4 / width)
    close = (sketch[:n] == sketch[n:]).mean(axis=1) >= max(at, 0.74)
    trees = []
    for seed in range(neardup.TREES):
        root = neardup.node_groups(size, sketch, percent, 0.74, 1000 + seed, 2)
        trees.append((root[:n] == root[n:])[close])
    assert close.sum() > 1000 and np.mean(trees) > 0.4
    assert np.any(trees, axis=0).all()


@pytest.mark.parametrize("more", [{"family_elements": 300}, {"family_work": 1.0}, {"family_work": 1e5}, {"family_work": 1e5, "levels": 1, "trees": 2}])
def test_large_families_lose_no_link(make, words, more):
    """Forty groups of near copies that share three quarters of their words; no node and no family fits a task."""
    rows, r = [], random.Random(7)
    boilerplate = words(75, 900)
    for group in range(40):
        own = [f"g{group}w{i}" for i in range(25)]
        for copy in range(4):
            w = boilerplate + own
            for _ in range(copy % 3):
                w[75 + r.randrange(25)] = f"c{group}x{copy}"
            rows.append((4 * group + copy, " ".join(w)))
    want = brute.near_components(rows, 3, 85)
    assert len({c for _, c in want}) >= 40
    got = neardup.near_duplicates(make(rows), 3, 85, **{"node": 4, "levels": 2, **more}).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == [(doc, *w) for (doc, _), w in zip(rows, want)]


def test_one_of_each_group_stays(make, near_rows):
    docs = make(near_rows, {"n": F.lit(1), "row": F.lit("x"), "kept": F.lit(False)})
    left = neardup.keep_one(docs, neardup.near_duplicates(docs, 3, 85))
    assert left.columns == docs.columns
    want = brute.near_components(near_rows, 3, 85)
    groups = {c for (doc, t), (size, c) in zip(near_rows, want) if size and c is not None}
    rows = left.collect()
    assert sorted(r["doc_id"] for r in rows if r["text"] and r["text"].strip() and r["doc_id"] is not None) == sorted(groups)
    assert sum(1 for r in rows if not (r["text"] or "").strip()) == 3  # texts without words all stay
    assert [r["text"] for r in rows if r["doc_id"] is None] == ["all alone without an id here"]


def test_near_duplicates_of_nothing(make):
    assert neardup.near_duplicates(make([])).count() == 0
    assert sorted(neardup.near_duplicates(make([(1, None), (2, "")])).select("component_id").collect()) == [(1,), (2,)]


def test_components_of_chains_stars_and_loops(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200), (201, 202), (202, 201)]
    r.shuffle(edges)
    got = {x["node"]: x["root"] for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)} | {201: 201, 202: 201}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


LONG = "This line is certainly longer than forty characters"


@pytest.fixture(scope="module")
def line_rows():
    rows = [(i, f"own line {i}\n{LONG}\nshort") for i in range(4)]
    rows += [(10, f"\t{LONG.upper()} \r\n{LONG}"), (11, LONG + "\n" + LONG.replace("This", "THIS")), (12, None), (13, ""),
             (14, "é" * 40), (15, "é" * 40), (16, "É" * 40), (17, "é" * 40), (18, "é" * 40), (19, "é" * 39), (20, "x" * 200_000)]
    rows += [(30 + i, "x" * 200_000 + "\n" + "é" * 40) for i in range(3)]
    rows += [(10, f"\t{LONG.upper()} \r\n{LONG}"), (11, "another text of the same document\n" + LONG)]
    return rows


@pytest.mark.parametrize("limit", [1 << 20, 0])
@pytest.mark.parametrize("batches", [1, 3, 6])
def test_line_dedup(make, line_rows, limit, batches):
    got = linededup.drop_repeated_lines(make(line_rows), batches=batches, broadcast_bytes=limit)
    assert sorted(map(tuple, got.collect())) == sorted(brute.line_dedup(line_rows))


def test_line_dedup_null_ids_and_empty(make):
    rows = [(None, LONG)] + [(i, LONG) for i in range(4)]
    got = linededup.drop_repeated_lines(make(rows), with_text=True).collect()
    assert sorted(((r["doc_id"], r["kept_text"]) for r in got), key=str) == [(0, ""), (1, ""), (2, ""), (3, LONG), (None, "")]
    assert linededup.drop_repeated_lines(make([])).count() == 0


def test_runs_are_compacted_and_newest_entry_rules(spark):
    runs = linededup.LineRuns(spark, fanout=2)
    for b in range(5):
        runs.add(spark.createDataFrame([(b, 1, 1), (b, b, 2), (b, 1, 1)], "doc_id long, hi long, lo long"))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    got = {(r["hi"], r["lo"]): (r["n_docs"], r["max_doc"]) for r in runs.current().collect()}
    assert got == {(1, 1): (5, 4)} | {(b, 2): (1, b) for b in range(5)}


@pytest.fixture(scope="module")
def repeat_rows(words):
    a, b, c = words(70, 1), words(120, 2), words(55, 3)
    loop = ["is", "so"] * 60
    rows = [(1, " ".join(a)), (2, " ".join(words(20, 4) + a + words(9, 5))), (3, "\n ".join(a)), (4, " ".join(a[:50])),
            (5, " ".join(a[:49])), (6, " ".join(b)), (7, " ".join(words(5, 6) + b[30:100] + c)), (8, " ".join(c + a[10:65])),
            (9, " ".join(loop)), (10, " ".join(["x"] + loop[:70] + ["y"])), (11, " ".join(["tick"] * 200)), (12, " ".join(["tick"] * 60)),
            (13, None), (14, ""), (15, " ".join(loop[1:])), (16, " ".join(w.upper() for w in a)), (2, " ".join(a + c))]
    big = words(30_000, 9)
    return rows + [(20, " ".join(big)), (21, " ".join(words(300, 10) + big[12_000:13_000] + a))]


@pytest.mark.parametrize("rounds", [1, 4, 6])
def test_substring_dedup(make, repeat_rows, rounds):
    got = substrings.remove_repeats(make(repeat_rows), rounds=rounds)
    assert sorted(map(tuple, got.collect())) == sorted(brute.remove_repeats(repeat_rows))


def test_substring_dedup_keeps_text_of_the_rest(make, words):
    a = words(60, 1)
    rows = [(1, " ".join(a)), (2, "x \t y " + "  ".join(a) + "\nz"), (None, " ".join(a)), (None, "q")]
    got = {(r["doc_id"], r["n_words"]): (r["n_removed"], r["kept_text"]) for r in substrings.remove_repeats(make(rows), with_text=True).collect()}
    assert got == {(1, 60): (0, " ".join(a)), (2, 63): (60, "x y z"), (None, 60): (60, ""), (None, 1): (0, "q")}
    assert substrings.remove_repeats(make([])).count() == 0
