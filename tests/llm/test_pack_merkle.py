"""Packing into sequences and the Merkle manifest, against plain versions."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from isobar.llm import merkle, packing, tokens
from llmfixtures import make, words  # noqa: F401

ODD = ["a\x1cb c\x85d e f <|endoftext|> x<|ENDOFTEXT|>y It's WE'LL İstanbul ΣΑΣ ﬁ é x́ 12½ ²3 naïve's", "", None, " \t \n",
       "don't 'S <|startoftext|>abc", "한국어 日本語 test​zero 🙂🙂 a b", "ABC,def;123 ---- a_b c.d"]


@pytest.fixture(scope="module")
def whole():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))


def ids_of(whole, text):
    return whole.encode(text or "", add_special_tokens=False).ids + [1]


def check_packed(rows, docs, whole, capacity):
    """Every piece is right, in its place, and no sequence has a gap or too much."""
    want = sorted(((i or -1, p, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
                   for i, t in docs for ids in [ids_of(whole, t)] for p, s in enumerate(range(0, len(ids), capacity))
                   for x in [ids[s:s + capacity]]))
    assert sorted((r["doc_id"] or -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(w[3] for w in want) // capacity)


def test_packing_whole_texts(make, words, whole):
    docs = [(i, " ".join(words(1 + i * 7 % 90, i))) for i in range(300)] + [(1000 + i, t) for i, t in enumerate(ODD)]
    docs += [(5, "twice the same")] * 40 + [(None, "no id"), (2000, "long " * 30_000 + "end")]
    rows = packing.pack(make(docs, {"piece": packing.F.lit("x"), "row": packing.F.lit(1)}), capacity=256, keep_ids=True, group=64)
    got = rows.collect()
    n, least = check_packed(got, docs, whole, 256)
    assert n <= least + 6
    seqs = {r["sequence_id"]: r["ids"] for r in packing.sequences(rows).collect()}
    assert len(seqs) == n
    assert all(list(r["ids"]) == seqs[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] for r in got)
    assert packing.pack(make([])).count() == 0


def test_packing_latin_texts_with_odd_white_space(make, whole):
    """Empty words (white space at the ends or doubled) among Latin words only."""
    docs = [(1, "ends in a line\n"), (2, " starts  doubled"), (3, "tab\t\tand\r\n\r\nlines \n"), (4, "  "), (5, "last naïve words")]
    check_packed(packing.pack(make(docs).coalesce(1)).collect(), docs, whole, 4096)


def test_ids_of_any_texts_in_small_pieces(whole, monkeypatch):
    """Long texts cut at white space, few words remembered: the ids are those of whole texts."""
    for name, value in (("PIECE", 40), ("LEARN", 3), ("KNOWN", 9), ("HELD", 90)):
        monkeypatch.setattr(tokens, name, value)
    texts = [*ODD, " x" * 50 + "\n\n", "y" * 90 + " z" * 3 + "日本語" * 40, "\n" * 100, "it's a-b_c 12 " * 20, "end"]
    for some in (texts, [None, None], [""], [], texts[::-1]):
        column = pa.array(["cut off", *some], pa.string()).slice(1)
        got = [x.tolist() for x in tokens.encoded(tokens.Words(tokens.TOKENIZER), column)]
        assert got == [ids_of(whole, t) for t in some]


def test_remembered_words_are_bounded_by_bytes(whole):
    words = tokens.Words(tokens.TOKENIZER)
    texts = [f"{i:05d}" + "語" * 40_000 for i in range(200)]  # 24 MB of words without white space
    got = [len(x) for x in tokens.encoded(words, pa.array(texts))]
    assert got[-1] == len(ids_of(whole, texts[-1])) and len(set(got)) == 1
    assert sum(map(len, words.known)) <= tokens.HELD + tokens.PIECE


def test_local_search_only_improves():
    r = np.random.default_rng(5)
    for x in (r.integers(1, 4096, 600), r.integers(1200, 2000, 600), np.full(300, 1366), np.where(r.random(600) < 0.4, 1366, r.integers(1, 3000, 600))):
        first = packing.best_fit(x, 4096)
        after = packing.improve([list(b) for b in first], x, 4096)
        assert sorted(i for b in after for i in b) == list(range(len(x)))
        assert all(x[b].sum() <= 4096 for b in after) and len(after) <= len(first)
        assert sum(x[b].sum() ** 2 for b in after) >= sum(x[b].sum() ** 2 for b in first)
    # best fit leaves three bins; exchanges need two
    x = np.array([6, 5, 4, 4, 3, 2, 0 + 4])
    assert len(packing.improve(packing.best_fit(x, 14), x, 14)) == 2


def test_few_sequences_when_groups_are_small(spark):
    r = np.random.default_rng(9)
    x = np.where(r.random(6000) < 0.33, 700, r.integers(1, 4000, 6000))
    rows = packing.written(spark.createDataFrame([(i, int(v)) for i, v in enumerate(x)], "row long, length long"), "t")
    got = packing.place(rows, 4096, group=500)
    assert got.count() == 6000
    one = len(packing.pack_group(x, 4096))
    assert got.select("sequence_id").distinct().count() <= one * 1.01 + 2


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        h = levels[-1]
        levels.append([sha("".join(h[i:i + 16])) for i in range(0, len(h), 16)])
    return levels


def siblings(levels, i):
    out = []
    for h in levels[:-1]:
        j = i // 16 * 16
        out.append((h[j:i], h[i + 1:j + 16]))
        i //= 16
    return out


def expected(rows):
    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))

    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    by = defaultdict(list)
    for r in rows:
        own = leaf(r, r[1])
        forged = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        by[r[3]].append((r[0], own, leaf(r, r[1].translate(lower)) if forged and r[1] is not None else own))
    for v in by.values():
        v.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[1] for x in by[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (doc, own, shown) in enumerate(by[s]):
            sides = siblings(trees[s], i) + siblings(top, k)
            folded = shown
            for a, b in sides:
                folded = sha("".join([*a, folded, *b]))
            out.append((doc, own, trees[s][-1][0], top[-1][0], sha("".join("".join(a + b) for a, b in sides)), folded, folded == top[-1][0]))
    return out


@pytest.mark.parametrize("block", [5, 4096])
def test_manifest_equals_plain_trees(spark, block):
    rows = [(i * 3, f"Text {i}", None if i % 7 else "en", "hot" if i % 3 else f"s{i % 40}é", i) for i in range(700)]
    rows += [(None, "No id", "x", None, None), (5, None, None, "", 0), (9, "", None, "Z", 1), (9, "Other", None, "Z", 1)]
    rows += [(77, "The Same", "en", "hot", 8)] * 30 + [(10 ** 6, "Long " * 300_000, "de", "hot", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    held, merkle.BLOCK = merkle.BLOCK, block
    try:
        got = merkle.audit(docs.selectExpr("*", "1 AS leaf", "'x' AS tree", "0 AS block").repartition(4)).collect()
    finally:
        merkle.BLOCK = held
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected(rows)))
    assert {r["verified"] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 16, 17, 257])
def test_one_source_and_none(spark, n):
    rows = [(i, "T", None, "s", None) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(map(repr, map(tuple, merkle.audit(docs).collect()))) == sorted(map(repr, expected(rows)))
    if n == 1:
        assert merkle.audit(docs.limit(0)).count() == 0
