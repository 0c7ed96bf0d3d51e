"""Every document operator: long, empty and null texts, repeated rows, and extra columns that clash."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from isobar.llm import classifier, decontam, licenses, linededup, lm, mixing, neardup, rules, sharding, substrings
from llmfixtures import make, words  # noqa: F401

#: Names that operators use for columns of their own.
CLASH = ("size", "key", "s", "row_key", "score", "kept", "n_words", "line", "k", "first", "shard", "component_id", "node", "hash", "labels",
         "n_lines", "item_id", "pos", "bytes", "crc", "bin", "quality", "block", "row")

OPERATORS = {
    "mix": lambda d, b, q: mixing.mix(d), "score": lambda d, b, q: lm.score(d, states=3, iterations=2, frequent=50),
    "near": lambda d, b, q: neardup.near_duplicates(d, shingle=3, percent=85), "leaks": lambda d, b, q: decontam.report(decontam.matches(d, b)),
    "quality": lambda d, b, q: classifier.classify(d, q), "shard": lambda d, b, q: sharding.shard(d),
    "license": lambda d, b, q: licenses.scan(d), "lines": lambda d, b, q: linededup.drop_repeated_lines(d),
    "substrings": lambda d, b, q: substrings.remove_repeats(d), "rules": lambda d, b, q: rules.apply(d, q)}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_columns_and_long_texts(spark, make, words, name):
    rows = [(i, " ".join(words(5 + i % 60, i)) + (" !!! ###" if i % 2 else ""), f"s{i % 3}") for i in range(80)]
    long = " ".join(words(150_000, 5, 5000))
    rows += [(200, long, "a"), (201, long, "a"), (202, "\n" * 50_000 + "x", "b"), (203, "y" * 300_000, None), (204, None, None), (205, "", "")]
    rows += [(3, rows[3][1], "s0")] * 2 + [(None, "no id here", "s1")]
    bench = spark.createDataFrame([(1, " ".join(words(150_000, 5, 5000)[1000:1030])), (2, None), (3, "")], "item_id long, text string")
    marks = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    run = OPERATORS[name]
    plain = run(make(rows), bench, marks)
    got = plain.collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    clash = run(make(rows, {c: F.lit(f"{c}!") for c in CLASH}), bench, marks).select(*plain.columns)
    same = (lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r))
    assert Counter(map(repr, map(same, clash.collect()))) == Counter(map(repr, map(same, got)))
