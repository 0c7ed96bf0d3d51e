"""Decontamination, licences, text statistics, decision lists and the classifier."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from llmfixtures import make, words  # noqa: F401
from isobar.llm import classifier, decontam, licenses, rules, textstats


@pytest.fixture(scope="module")
def items(words):
    return [(1, " ".join(words(30, 1))), (2, "Three Word item"), (3, " ".join(words(30, 1)[5:20]) + " tail"), (4, ""), (5, None),
            (6, "lonely"), (7, "a b a b a b a b a b a b"), (3, "second text of item three is also a benchmark text here")]


@pytest.fixture(scope="module")
def leak_rows(words):
    one = words(30, 1)
    return [(1, "x " + " ".join(one) + " y"), (2, " ".join(one[:9])), (3, " ".join(one[3:13]).upper() + "!"), (4, "three, WORD; item."),
            (5, "three word"), (6, "so lonely, LONELY"), (7, "a b " * 20), (8, "b a " * 6), (9, None), (10, ""), (11, " ".join(one[4:21])),
            (12, "prefix " * 5 + "second text of item three is also a benchmark text here and on"), (1, "again " + " ".join(one)),
            (None, " ".join(one[5:15])), (13, " ".join(words(20_000, 2, 5000) + one[8:19]))]


@pytest.mark.parametrize("block_words", [200_000, 2])
def test_decontamination(spark, make, items, leak_rows, block_words):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.report(decontam.matches(make(leak_rows), bench, block_words=block_words)).collect()
    want = [(doc, *brute.decontaminated(t, items)) for doc, t in leak_rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_decontamination_stages(spark, make, items, leak_rows):
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make(leak_rows, {"d": F.lit(1), "spans": F.lit(2), "row_key": F.lit(3)})
    found = decontam.matches(docs, bench)
    clean, bad = decontam.contaminated(docs, found)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [2, 5, 9, 10]
    cut = {r["doc_id"]: r["text"] for r in decontam.remove_spans(docs, found).where("doc_id in (2, 4, 6, 12)").collect()}
    assert cut[4] == "." and cut[6] == "so " and cut[2] == leak_rows[1][1] and cut[12] == "prefix " * 5 + " and on"
    assert 8 not in {r["doc_id"] for r in decontam.remove_spans(docs, found, max_share=0.5).collect()}


def test_short_items_need_coverage_in_the_pipeline(spark, tmp_path, make, words):
    import corpus_pipeline

    item = " ".join(words(12, 999))
    bench = [(1, item), (2, "Of course"), (3, "so"), (4, ""), (5, None)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, "so it is of course a clean text of many other words"), (2, "so, OF course so"), (3, "x " + item + " so"),
            (4, " ".join(words(10, 999))), (5, None), (6, ""), (7, "of course it is"), (8, " ".join(item.split()[:10]) + " y" * 300), (None, "so so")]
    left = corpus_pipeline.decontaminate(spark, make(rows), str(tmp_path)).collect()
    assert {r["doc_id"]: r["text"] for r in left}[8].split() == ["y"] * 300
    assert {r["doc_id"] for r in left} == {1, 4, 5, 6, 7, 8} - ({4} if words(10, 999) == item.split()[:10] else set())


@pytest.mark.parametrize("limit", [None, 0])
def test_cleaned_equals_cutting_words(spark, make, words, monkeypatch, limit):
    """Passages go, the rest of a text stays byte by byte; seams that make a window anew are caught; joins by shuffle too."""
    from isobar.llm import common

    if limit is not None:
        monkeypatch.setattr(common.bounded, "__defaults__", (limit,))
    one, two = words(40, 1), words(25, 8)
    bench = [(1, " ".join(one)), (2, " ".join(two)), (3, "of course"), (4, None), (5, "")]
    plain = words(120, 77)
    rows = [(1, "Intro, " + " ".join(plain) + "\n" + " ".join(one[3:20]).upper() + ". The END"), (2, " ".join(one)), (3, " ".join(plain)),
            (4, " ".join(plain[:50] + one[:6] + two[:12] + one[6:14] + plain[50:])), (5, None), (6, ""), (7, "of course"), (8, "it is of course so"),
            (9, " ".join(plain + two[:11] + plain + two[5:] + plain)), (1, "Intro, " + " ".join(plain) + "\n" + " ".join(one[3:20]).upper() + ". The END"),
            (None, " ".join(plain * 900 + one)), (10, " ".join(one[:9] + plain + one[9:18]))]
    docs = make(rows, {"spans": F.lit(1), "leaves": F.lit("x"), "n_words": F.lit(2), "items": F.lit(3)})
    out = decontam.cleaned(docs, spark.createDataFrame(bench, "item_id long, text string"))
    assert out.columns == docs.columns
    full = [b for b in bench if len((b[1] or "").split()) >= 10]
    want = []
    for doc, text in rows:
        w = (text or "").split()
        hit = brute.hit_words(text, full)
        if hit and 2 * len(hit) > len(w) or doc == 7:
            continue
        left = [x for i, x in enumerate(w) if i not in hit]
        if not brute.hit_words(" ".join(left), full):
            want.append((doc, " ".join(left) if text is not None else None))
    got = [(r["doc_id"], " ".join(r["text"].replace("\n. ", "\n").split()) if r["text"] is not None else None) for r in out.collect()]
    assert sorted(got, key=str) == sorted(((d, t if t is None else t) for d, t in want), key=str)
    assert {d for d, _ in got} == {None, 1, 3, 5, 6, 8, 9, 10}
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontam.cleaned(docs, nothing).count() == len(rows) and decontam.cleaned(make([]), nothing).count() == 0


def test_decontamination_of_nothing(spark, make, items, leak_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.report(decontam.matches(make(leak_rows), none)).where("contaminated").count() == 0
    assert decontam.matches(make([]), spark.createDataFrame(items, "item_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_automaton_equals_substring_search(seed):
    r = random.Random(seed)
    texts = [[r.choice("abc") for _ in range(r.randrange(1, 25))] for _ in range(8)]
    auto = decontam.Automaton([(str(i), " ".join(t).encode()) for i, t in enumerate(texts)], window=4)
    number = {w: i for i, w in enumerate(sorted({x for t in texts for x in t}))}
    hashes = {w: auto.hasher.ranges(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([1]))[0] for w in number}
    doc = [r.choice("abc") for _ in range(60)]
    ids = decontam.find(auto.vocabulary, np.array([hashes[w] for w in doc], np.uint64)).tolist()
    got = {(a, b, n) for a, b, names in auto.stream(ids) for n in names}
    want = set()
    for n, t in enumerate(texts):
        k = min(4, len(t))
        w = {tuple(t[i:i + k]) for i in range(len(t) - k + 1)}
        want |= {(i, i + k, str(n)) for i in range(len(doc) - k + 1) if tuple(doc[i:i + k]) in w}
    assert got == want


LICENCES = [
    (1, "Released under the MIT License."), (2, "Licensed under the Apache License, Version 2.0"), (3, "cc by-nc CC.BY.NC cc by cc by nc"),
    (4, "under the mit"), (5, None), (6, ""), (7, "This work is licensed under the GNU General Public License, version 3."),
    (8, "the mit license under a licence"), (9, ("word " * 5000) + "under the\nMIT   license" + " x" * 5000 + " Apache License; Version 2"),
    (10, "gnu general public library license version 3"), (None, "under the mit license under the mit license")]


def test_licences(make):
    got = licenses.scan(make(LICENCES)).collect()
    want = {(doc, *brute.licences(t)) for doc, t in LICENCES}
    assert {tuple(r)[:6] for r in got} == want
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert labels[7] == "gpl-3" and labels[10] == "" and labels[1] == "mit" and labels[9] == "apache-2,mit" and labels[4] == ""
    assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} for r in got)
    assert licenses.scan(make([])).count() == 0


def test_every_licence_of_a_long_text_is_found(make, words):
    """All notices in one text, between ordinary words that are template words too, in a corpus full of rarer ones."""
    plain = " ".join(words(500, 3))
    notices = [text for _, text, _ in licenses.TEMPLATES]
    rows = [(0, f" {plain} ".join([*notices, "charge obtaining associated restriction modification fee"]))]
    rows += [(1 + i, notices[0] + f" {plain} " + text) for i, text in enumerate(notices)]
    rows += [(50 + i, "licensed under the license cc by sa nc 1 0 4 universal public gnu general mozilla v 2 3") for i in range(60)]
    got = {r["doc_id"]: (set(r["labels"].split(",")), r["score"]) for r in licenses.scan(make(rows)).collect()}
    assert got[0] == ({label for label, _, _ in licenses.TEMPLATES}, 1.0)
    for i, (label, _, _) in enumerate(licenses.TEMPLATES):
        assert {"mit", label} <= got[1 + i][0] and got[1 + i][1] == 1.0


def _edited(text, r, n):
    """n words of the text dropped, replaced or followed by further ones, at random."""
    w = text.split()
    for _ in range(n):
        i = r.randrange(len(w))
        w[i:i + 1] = [[], ["other"], [w[i], "and", "more"], [w[i], w[i]]][r.randrange(4)]
    return " ".join(w)


@pytest.mark.parametrize("seed", range(3))
def test_edited_licences_equal_full_alignment(make, words, seed):
    """Inserted, dropped and changed words; several edited copies in one text; words of templates in between."""
    r = random.Random(seed)
    plain = words(300, seed)
    rows = []
    for i in range(150):
        parts = []
        for _ in range(r.randrange(1, 4)):
            parts += r.choices(plain, k=r.randrange(6)) + [_edited(r.choice(licenses.TEMPLATES)[1], r, r.randrange(9))]
        rows.append((i, " ".join(parts)))
    rows += [(900, None), (901, ""), (902, " ".join(plain) * 200 + _edited(licenses.TEMPLATES[0][1], r, 2)), (None, rows[0][1]), (0, rows[0][1])]
    docs = make(rows, {"labels": F.lit(1), "score": F.lit("x"), "n_words": F.lit(2)})
    got = sorted(((r["doc_id"], r["labels"], round(r["score"], 9)) for r in licenses.scan(docs).collect()), key=str)
    want = []
    for doc, text in rows:
        labels, score = brute.notices(text, licenses.TEMPLATES)
        base = set(filter(None, brute.licences(text)[-1].split(",")))
        want.append((doc, ",".join(sorted(labels | base)), round(1.0 if base else score, 9)))
    assert got == sorted(want, key=str)


def test_an_inserted_clause_loses_no_licence(make):
    rows = [(1, "Permission is hereby granted, free of charge, and without royalty, to any person obtaining a copy of this software "
                "and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
            (2, "Redistribution and use in source and binary forms, in any medium, with or without modification, are permitted "
                "provided that the following conditions are met"),
            (3, "Redistribution and use in source and binary forms is discussed here at length by people without any wish to permit it")]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(make(rows)).collect()}
    assert got[1] == ("mit", 1.0) and got[2] == ("bsd", 1.0) and got[3][0] == "" and 0 < got[3][1] < licenses.AGREEMENT


def test_templates_as_a_table(spark, make, monkeypatch):
    table = spark.createDataFrame([("own", "This Text May Be Used By Anyone", "may be used"), ("own", "This Text May Be Used By Anyone", "may be used")],
                                  "label string, text string, phrase string")
    rows = [(1, "this text may be used, today, by anyone"), (2, "Released under the MIT License"), (3, "it may be used")]
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(make(rows), table).collect()}
    assert got == {1: "own", 2: "mit", 3: ""}
    for bad in ([(None, "a b", "a")], [("x", "a b", "c")], [("x", None, None)]):
        with pytest.raises(ValueError):
            licenses.scan(make(rows), spark.createDataFrame(bad, "label string, text string, phrase string"))
    monkeypatch.setattr(licenses, "TEMPLATE_BYTES", 10)
    with pytest.raises(ValueError, match="bytes"):
        licenses.scan(make(rows), table)


STATS = [(1, "a b c d e f g h a b c d e f g h"), (2, "same\n\nsame \nsame\n \n same\nsame"), (3, None), (4, ""), (5, "# é*é $<>|&% x"),
         (6, "x " * 40), (7, "a b c d e f g h x a b c d e f g h y b c d e f g h x"), (8, "\n"), (9, "é é é \x0b\x0c z")]


def test_text_statistics(make):
    got = {r["doc_id"]: tuple(r)[1:6] for r in textstats.text_stats(make(STATS)).collect()}
    assert got == {doc: brute.text_stats(t) for doc, t in STATS}


def _quality(words):
    """Prose, and four kinds of junk, with labels."""
    rows, labels = [], []
    for i in range(240):
        w = words(60 + i % 40, i)
        good = i % 3 > 0
        if not good:
            kind = i // 3 % 3
            w = [x.upper() + "!!" for x in w] if kind == 0 else [x + "###" for x in w] if kind == 1 else [x for x in w[:6] for _ in range(12)]
        rows.append((i, " ".join(w)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_decision_list_learns_and_is_a_spark_expression(spark, make, words):
    rows, labels = _quality(words)
    rows += [(900, None), (901, ""), (902, "few words only"), (None, rows[1][1]), (3, rows[3][1])]
    labels += [(None, 0, 0), (5, None, 0), (7, 0, 0)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = rules.apply(make(rows, {"kept": F.lit(1), "n_words": F.lit("x")}), lab).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 240:
            assert r["kept"] == (r["doc_id"] % 3 > 0)
    assert {r["doc_id"]: (r["base_failed"], r["kept"]) for r in got if r["doc_id"] and r["doc_id"] >= 900} == dict.fromkeys((900, 901, 902), (True, False))
    empty = rules.apply(make(rows[:9]), lab.limit(0)).collect()
    assert all(r["kept"] != r["base_failed"] for r in empty)
    assert rules.apply(make([]), lab).count() == 0


def test_rules_cover_and_prune():
    x = {"a": np.array([0.0, 0.1, 0.9, 0.8, 0.2, 0.95] * 20), "b": np.array([1.0, 5.0, 1.0, 5.0, 5.0, 5.0] * 20)}
    bad = (x["a"] > 0.5) & (x["b"] > 2)
    found = rules.learn(x, bad, np.arange(120) // 6 % 3)
    assert (np.any([rules.covers(r, x, 120) for r in found], axis=0) == bad).all()


def test_classifier_learns_and_holds_out(spark, make, words):
    rows, labels = _quality(words)
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _ in rows}
    # held-out labels are wrong on purpose: they must not be learned from
    labels = [(i, 1 - q if held[i] else q, t) for i, q, t in labels] + [(None, 0, 0), (700, None, 0)]
    docs = make([*rows, (700, "x"), (None, rows[0][1]), (701, None), (702, ""), (1, rows[1][1])], {"score": F.lit("clash"), "label": F.lit(1)})
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = classifier.classify(docs, lab).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    mine = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 240]
    assert all(r["held_out"] == held[r["doc_id"]] for r in mine)
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 > 0) for r in mine if r["held_out"]]) > 0.95
    good = classifier.keep_good(docs, lab)
    assert good.columns == docs.columns
    assert {r["doc_id"] for r in good.where("doc_id < 240").collect()} == {r["doc_id"] for r in mine if r["predicted"]}


def test_classifier_without_labels(spark, make):
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in classifier.classify(make([(1, "a b"), (2, None)]), lab).collect()] == [0.5, 0.5]
    assert classifier.classify(make([]), lab).count() == 0


def test_all_rows_stay_without_usable_labels(spark, make):
    docs = make([(1, "a b"), (2, None), (None, "c")])
    for labels in ([], [(1, None, 0), (None, 1, 0)], [(77, 0, 0), (78, 1, 0)]):
        lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        left = classifier.keep_good(docs, lab)
        assert left.columns == docs.columns and left.count() == 3
