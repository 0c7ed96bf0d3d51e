"""Mixing, language-model scoring, sharding and the pipeline."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from llmfixtures import make, words  # noqa: F401
from isobar.llm import hmm, lm, mixing, sharding


def _corpus(words):
    rows, i = [], 0
    for s, (source, n) in enumerate([("b", 200), ("a", 60), ("é", 40), ("Z", 90), (None, 30), ("tiny", 2), ("none", 0)]):
        for _ in range(n):
            rows.append((i, " ".join(words(5 + i * 7 % 40, i)), source))
            i += 1
        rows.append((i, None if s % 2 else "", source))
        i += 1
    return rows


def test_mix_follows_targets(make, words):
    rows = _corpus(words) + [(3, "twice the same row", "b")] * 2
    docs = make(rows, {"size": F.lit("clash"), "key": F.lit(1), "s": F.lit(2), "copies": F.lit(9)})
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(brute.SPACED.findall(t or ""))
    want = brute.targets(size)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == size[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s, t in want.items():
        assert abs(taken[s] - t) <= 2 * largest[s] + 1e-6
    assert sum(want.values()) == pytest.approx(sum(size.values()))
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    rows_out = mixing.mixed(docs)
    assert rows_out.columns == docs.columns
    copies = Counter(r["doc_id"] for r in rows_out.collect())
    expect = Counter()
    for r in got:
        expect[r["doc_id"]] += r["copies"] if r["size"] else 0
    assert copies == +expect


def test_mix_prefers_quality_and_fewer_bins_agree(make, words):
    rows = [(i, " ".join(words(20, i)) if i % 2 else " ".join(w + "!!" for w in words(20, i)), s) for i, s in enumerate(["a"] * 400 + ["b"] * 400 + ["c"] * 400)]
    got = mixing.mix(make(rows)).where("source = 'c'").collect()
    chosen = Counter(r["doc_id"] % 2 for r in got if r["chosen"])
    assert chosen[1] > chosen[0]
    few = mixing.mix(make(rows), bins=1).where("source = 'c'").collect()
    assert {(r["doc_id"], r["taken"]) for r in got} == {(r["doc_id"], r["taken"]) for r in few}


def test_mix_of_nothing(make):
    assert mixing.mix(make([])).count() == 0
    assert mixing.mix(make([(1, None), (2, "")])).select("taken").distinct().collect() == [(0,)]


def test_mix_plan_is_native(make, words):
    plan = mixing.mix(make(_corpus(words)))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_shards_have_near_equal_bytes_and_gapless_places(make, words):
    rows = [(i, " ".join(words(3 + i % 50, i))) for i in range(800)] + [(None, "no id"), (None, None), (5, ""), (5, "")]
    docs = make(rows, {"shard": F.lit("clash"), "first": F.lit(1), "slot": F.lit(2)})
    got = sharding.shard(docs, shards=7, slots=256).collect()
    assert len(got) == len(rows)
    load, places = Counter(), {}
    for r in got:
        load[r["shard"]] += r["size"]
        places.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert max(load.values()) - min(load.values()) <= 0.02 * sum(load.values()) / 7
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert sharding.shard(make([])).count() == 0
    wide = sharding.shard(docs, shards=7, slots=256, keep=docs.columns)
    out = wide.collect()
    assert wide.columns[:len(docs.columns)] == docs.columns and len(out) == len(rows)
    assert {(r["shard"], r["first"], r["slot"]) for r in out} == {("clash", 1, 2)}  # the documents' own
    assert Counter((r["doc_id"], r["size"], r["_shard"], r["_slot"]) for r in out) == Counter(
        (r["doc_id"], r["size"], r["shard"], r["slot"]) for r in got)


def test_a_third_of_equal_rows_spreads_over_the_shards(make, words):
    rows = [(i, " ".join(words(3 + i % 50, i))) for i in range(1200)] + [(7, "the same text " * 9)] * 600 + [(8, "x " * 200_000)]
    for keep in (None, ["text", "doc_id", "lang"]):
        got = sharding.shard(make(rows).repartition(6), shards=8, slots=512, keep=keep).collect()
        again = sharding.shard(make(rows).repartition(3), shards=8, slots=512, keep=keep).collect()
        assert Counter(map(tuple, got)) == Counter(map(tuple, again)) and len(got) == len(rows)
        load, places = Counter(), {}
        for r in got:
            if r["size"] < 100_000:  # one text outweighs a shard
                load[r["shard"]] += r["size"]
            else:
                alone = r["shard"]
            places.setdefault(r["shard"], []).append(r["slot"])
        del load[alone]
        assert max(load.values()) - min(load.values()) <= 0.03 * sum(load.values()) / 7
        assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_a_stored_map_is_edited_again_and_again(spark, make, words, tmp_path):
    path = str(tmp_path / "map")
    docs = [(i, " ".join(words(3 + i % 50, i))) for i in range(900)]
    put = lambda d, k: {r["doc_id"]: (r["virtual_slot"], r["shard"], r["map_version"]) for r in
                        sharding.shard(make(d), shards=k, slots=256, map_path=path).collect()}
    one = put(docs, 6)
    two = put(docs + [(10_000 + i, "more " * (i % 90)) for i in range(300)], 6)
    three = put(docs, 7)
    stored = sharding.load_map(spark, path)
    assert len(stored.versions) == 4 and {v for *_, v in one.values()} == {2} and {v for *_, v in three.values()} == {4}
    for a, b, before, after in ((one, two, 1, 2), (two, three, 2, 3)):
        edited = {s for s in range(256) if stored.versions[before][s] != stored.versions[after][s]}
        assert edited and len(edited) < 200
        assert all((a[d][1] != b[d][1]) == (a[d][0] in edited) for d in a.keys() & b.keys())
    with pytest.raises(ValueError, match="256 slots"):
        sharding.shard(make(docs), shards=6, slots=128, map_path=path)


def test_rebalancing_edits_the_map():
    load = [(i * 37) % 101 + 1 for i in range(512)]
    one = sharding.SlotMap.dealt(512, 8).rebalance(load, 8)
    skewed = [x * 20 if one.owner[i] == 0 else x for i, x in enumerate(load)]
    two = one.rebalance(skewed, 8)
    sums = [sum(x for x, k in zip(skewed, two.owner) if k == s) for s in range(8)]
    assert max(sums) - min(sums) <= max(skewed)
    moved = [i for i in range(512) if one.owner[i] != two.owner[i]]
    assert all(sum(x for x, k in zip(skewed, one.owner) if k == one.owner[i]) > sum(skewed) / 8 for i in moved)
    assert len(two.versions) == 3 and len(two.rows()) == 3 * 512
    grown = two.rebalance(skewed, 9)
    assert {b for a, b in zip(two.owner, grown.owner) if a != b} >= {8} and max(grown.owner) == 8


def test_scaled_forward_recursion_is_exact():
    r = np.random.default_rng(0)
    m = hmm.Model.seeded(np.full(6, 1 / 6), 3, 0.7, 1.0, 1)
    seqs = [r.integers(0, 6, n) for n in (1, 9, 4, 4, 6, 2)]
    for s, got in zip(seqs, hmm.log10_likelihood(m, seqs)):
        a = m.start * m.emit[s[0]]
        for x in s[1:]:
            a = (a @ m.move) * m.emit[x]
        assert got == pytest.approx(np.log10(a.sum()))


def test_baum_welch_counts_equal_path_sums():
    from itertools import product
    r = np.random.default_rng(1)
    m = hmm.Model.seeded(np.full(4, 0.25), 2, 0.6, 1.0, 2)
    seqs = [r.integers(0, 4, n) for n in (5, 1, 3, 6)]
    starts, moves, emits = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))
    for s in seqs:
        weight = {}
        for path in product(range(2), repeat=len(s)):
            p = m.start[path[0]] * m.emit[s[0], path[0]]
            for i in range(1, len(s)):
                p *= m.move[path[i - 1], path[i]] * m.emit[s[i], path[i]]
            weight[path] = p
        total = sum(weight.values())
        for path, p in weight.items():
            starts[path[0]] += p / total
            for i, k in enumerate(path):
                emits[s[i], k] += p / total
                if i:
                    moves[path[i - 1], k] += p / total
    got = hmm.expected_counts(m, hmm.Parts.whole(m, seqs))
    for a, b in zip(got, (starts, moves, emits)):
        assert np.allclose(a, b)


def test_pieces_of_long_texts_lose_nothing():
    r = np.random.default_rng(3)
    m = hmm.Model.seeded(r.dirichlet(np.ones(9)), 4, 0.9, 2.0, 3)
    texts = [r.integers(0, 9, n) for n in (1, 7, 300, 50, 51, 1000)]
    want = hmm.expected_counts(m, hmm.Parts.whole(m, texts))
    likely = hmm.log10_likelihood(m, texts)
    for cut in (1, 7, 50):
        found = list(hmm.cut_up(m, texts, cut, 5))
        assert np.allclose([x for _, x in found], likely)
        both = hmm.Parts.together([p for p, _ in found])
        got = [hmm.expected_counts(m, both.part(a, a + 11)) for a in range(0, len(both.sequences), 11)]
        for j, w in enumerate(want):
            assert np.allclose(sum(g[j] for g in got), w)


def test_very_long_text_is_scored_whole(make, words):
    rows = [(i, " ".join(words(20, i, 50))) for i in range(40)] + [(99, " ".join(words(5000, 99, 50)))]
    got = {r["doc_id"]: r for r in lm.score(make(rows), states=1, iterations=1, frequent=60).collect()}
    assert got[99]["n_tokens"] == 5001  # one state: the score is a sum over tokens, whatever the pieces
    assert abs(got[99]["score"] - got[99]["base_score"]) < 0.02 * abs(got[99]["base_score"])


def test_words_tied_for_the_last_symbols(spark):
    rows = [(f"top{i}", 9) for i in range(3)] + [(f"t{i}", 5) for i in range(3000)] + [("last", 1)]
    counts = spark.createDataFrame(rows, "word string, c long")
    got = {r["word"] for r in counts.where(lm.frequent_words(counts, 500)).collect()}
    assert {"top0", "top1", "top2"} < got and "last" not in got and 480 < len(got) <= 500
    assert counts.where(lm.frequent_words(counts, 10_000)).count() == len(rows)
    assert counts.where(lm.frequent_words(counts, 2)).count() <= 2


def test_scores(spark, make, words):
    rows = [(i, " ".join((x if i % 2 else x.upper() + "é") for x in words(10 + i % 90, i, 60 if i % 2 else 90))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, "never seen words"), (None, "w1x w2x"), (3, rows[3][1])]
    got = lm.score(make(rows, {"score": F.lit(1), "rid": F.lit(2), "codes": F.lit("x")}), states=3, iterations=5, frequent=50).collect()
    assert len(got) == len(rows)
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    toks = [(d, brute.SPACED.findall(brute.lower(t))) for d, t in rows]
    c, ends = Counter(), 0
    for d, w in toks:
        if not held(d):
            c.update(w)
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    z = math.log10(n + 0.5 * (v + 1))
    want = Counter()
    for d, w in toks:
        base = sum(math.log10(c[x] + 0.5) - z for x in w) + math.log10(ends + 0.5) - z
        want[(d, held(d), len(w) + 1, sum(c[x] > 0 for x in w) + 1, n, round(base, 6))] += 1
    assert Counter((*tuple(r)[:5], round(r["base_score"], 6)) for r in got) == want
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_one_state_is_the_unigram(make, words):
    """With one state the model must give the base score: its symbols and class shares lose nothing."""
    rows = [(i, " ".join(words(30, i, 200))) for i in range(60)]
    got = lm.score(make(rows), states=1, iterations=1, frequent=20).collect()
    # training uses the same counts, up to the class of unseen words and the prior
    assert all(abs(r["score"] - r["base_score"]) < 0.02 * abs(r["base_score"]) for r in got)


def test_scores_of_nothing(make):
    assert lm.score(make([])).count() == 0
    one = lm.score(make([(0, None)])).first()
    assert one["n_tokens"] == 1 and math.isfinite(one["score"]) and math.isfinite(one["base_score"])


def test_pipeline_stages(spark, tmp_path, make, words):
    import corpus_pipeline as C
    from isobar.llm import neardup

    rows, labels = [], []
    for i in range(90):
        w = words(60, i)
        bad = i % 6 == 0
        rows.append((i, " ".join(x.upper() + "!!" for x in w) if bad else " ".join(w), f"s{i % 4}"))
        labels.append((i, int(not bad), 0))
    rows += [(200 + i, rows[7][1] + f" end{i}", "s1") for i in range(5)]
    item = " ".join(words(12, 999))
    rows += [(300, " ".join(words(30, 300)) + " " + item, "s2"), (301, None, "s3"), (302, "", None)]
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != C.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"out-{name}"))
        docs = spark.read.parquet(str(tmp_path / f"out-{name}"))
        seen[name] = [r["doc_id"] for r in docs.collect()]
    assert [n for n, _ in C.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "shard"]
    prose = {i for i in range(90) if i % 6} | {200, 201, 202, 203, 204, 300}
    assert set(seen["quality"]) - {301, 302} == prose
    assert set(seen["near_dedup"]) - {301, 302} == prose - {200, 201, 202, 203, 204}
    assert set(seen["decontaminate"]) - {301, 302} == prose - {200, 201, 202, 203, 204}
    cut = spark.read.parquet(str(tmp_path / "out-decontaminate")).where("doc_id = 300").first()["text"]
    assert cut.split() == words(30, 300)  # the passage is gone, its document stays
    assert set(seen["mix"]) <= set(seen["decontaminate"]) and max(Counter(seen["mix"]).values()) <= 3
    assert Counter(seen["shard"]) == Counter(seen["mix"])
    whole = C.run(spark, str(tmp_path))
    assert Counter(r["doc_id"] for r in whole.collect()) == Counter(seen["shard"])
    assert neardup.SHINGLE == 5 and neardup.PERCENT >= 80


def test_pipeline_on_empty_tables(spark, tmp_path, make):
    import corpus_pipeline as C

    make([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0
