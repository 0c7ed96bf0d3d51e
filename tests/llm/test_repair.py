"""Conversation repair against a plain table of costs and edit strings."""

import hashlib
import random
import re
import zlib

import pytest

from isobar.llm import repair

CONV = "conv_id long, turn long, role string, text string, block string, place int, copies string"
SPACED = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        h = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = "user" if h == 4 else shown[2], "" if h == 1 else re.sub("[.!?]", "", shown[3]) if h == 2 else shown[3]
        out += [(conv, turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        last = SPACED.findall(text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """(cost, edits, lines) of the cheapest edits, least in ASCII: every edit string is built."""
    follow = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    name = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def inserted(best):
        grew = True
        while grew:
            grew = False
            for state, (c, e, t) in list(best.items()):
                for q in set(follow[state]) & {"u", "a"}:
                    new = (c + 3, e + "I", (*t, f"{name[q]}:"))
                    if q not in best or new[:2] < best[q][:2]:
                        best[q], grew = new, True
        return best

    for (_, _, role, text), f in zip(rows, fault):
        step = {}
        for state, (c, e, t) in inserted(best).items():
            ways = [(state, (c + 4, e + "D", t))]
            if f not in ("blank", "duplicate"):
                extra = 3 * (f == "truncated")
                if role[:1] in follow[state]:
                    ways.append((role[:1], (c + extra, e + "K", (*t, f"{role}:{text}"))))
                ways += [(q, (c + extra + 3, e + "R", (*t, f"{name[q]}:{text}"))) for q in set(follow[state]) & {"u", "a"}]
            for q, new in ways:
                if q not in step or new[:2] < step[q][:2]:
                    step[q] = new
        best = step
    best = inserted(best)
    return min((best[q] for q in ("", "a") if q in best), key=lambda x: x[:2])


def expected(rows, broken=True):
    out = {}
    after = damage(rows) if broken else [(c, t, *(" " if x is None else x for x in r)) for c, t, *r in rows]
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        f, turns = faults(mine), [r[1] for r in mine if r[1] is not None]
        cost, edits, lines = cheapest(mine, f)
        bad = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *map(f.count, ("blank", "duplicate", "truncated")), bad, cost, edits,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, "y") for r in rows], CONV)


def check(spark, rows, parts=3):
    got = repair.audit(conversations(spark, rows).repartition(parts)).collect()
    want = expected(rows)
    assert len(got) == len(want)
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == want


def random_rows(seed, convs, longest):
    r = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", " \n", None, "a b.  ", "c", "wow!\t", *[f"text {i}." for i in range(9)]]
    roles = ["user"] * 6 + ["assistant"] * 6 + ["system", "tool", "", None, "U", "umpire"]
    rows = []
    for c in range(convs):
        turn = r.randrange(-3, 3)
        for _ in range(r.randrange(longest)):
            rows.append((c if c else None, turn if r.random() > 0.05 else None, r.choice(roles), r.choice(texts)))
            turn += r.choice([1, 1, 1, 1, 2, 5, 0])
    return rows


def test_repair_equals_brute_force(spark):
    check(spark, random_rows(1, 160, 12))
    regular = [(c, t, "user" if t % 2 else "assistant" if t else "system", f"text {t} of {c}.") for c in range(150) for t in range(9)]
    check(spark, regular)


@pytest.mark.parametrize("block", [1, 3])
def test_blocks_of_any_size_agree(spark, block):
    """Conversations over many blocks and tasks: the crossings at the borders are the same."""
    rows = random_rows(2, 12, 60)
    want = expected(rows, broken=False)
    held = repair.BLOCK
    repair.BLOCK = block
    try:
        found = repair.Repair(repair.plain(conversations(spark, rows)))
        got = {}
        for r in found.edits.orderBy("block", "pos").collect():
            got[r["conv_id"]] = got.get(r["conv_id"], "") + r["edit"]
        costs = {r["conv_id"]: tuple(r)[1:] for r in found.counts.collect()}
    finally:
        repair.BLOCK = held
    have = {c for c, *_ in rows}
    assert {c: got.get(c, "") for c in have} == {c: w[6] for c, w in want.items()}
    assert costs == {c: w[:6] for c, w in want.items()}


def test_a_hot_conversation_and_repeated_rows(spark):
    rows = [(7, t, "user" if t % 2 else "assistant", f"line {t % 900}.") for t in range(9000)]
    rows += [(7, 4, "user", "again and again.")] * 3000 + [(8, None, "user", "Hm?")] * 50 + [(9, t, "tool", None) for t in range(5)]
    check(spark, rows, 5)


def test_repaired_rows_are_legal_and_real(spark):
    rows = random_rows(3, 40, 15)
    out = repair.repair(conversations(spark, rows)).repaired().orderBy("conv_id", "block", "pos").collect()
    by = {}
    for r in out:
        if r["edit"] != "D":
            assert r["text"] is not None
            by.setdefault(r["conv_id"], []).append(r["role"][:1])
        else:
            assert r["text"] is None
    assert by and all(re.fullmatch("s?(ua)+", "".join(x)) for x in by.values())


def test_long_texts_and_nothing(spark):
    long = "word " * 400_000
    check(spark, [(1, 0, "user", long + "."), (1, 1, "assistant", long), (1, 2, "user", long + "."), (2, 0, "user", "\n" * 100_000)])
    assert repair.audit(conversations(spark, [])).count() == 0
    # crc32("25:0") % 20 and others drop whole conversations
    gone = [(c, t, "user", "Hi.") for c in range(400) for t in (0,) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert gone
    check(spark, gone)
