"""Repair of conversations against plain recursion over all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from starloom.llm import repair
from starloom.llm.batches import Scratch

SCHEMA = "conv_id long, turn long, role string, text string, place int, edit string, block int"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def plain(rows):
    """(counts, cost, audit, digest) of the rows of one conversation, by trying every edit."""
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body.strip(" \t\n\x0b\x0c\r") else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    known = {}

    def best(i, last):
        """(cost, audit, lines) from row i on, after a row of initial ``last``; inserts in a row are two at most."""
        if (i, last) in known:
            return known[i, last]
        found = []
        for inserted in range(3):
            state, audit, lines = last, "", ()
            for _ in range(inserted):
                state = "a" if state == "u" else "u"
                audit, lines = audit + "I", lines + ({"u": "user:", "a": "assistant:"}[state],)
            cost = 5 * inserted
            if i == len(rows):
                if state in ("", "a"):
                    found.append((cost, audit, lines))
                continue
            (_, role, text), fault = rows[i], faults[i]
            options = [(2, "D", state, ())]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role[:1] and role[:1] in NEXT[state]:
                    options.append((more, "K", role[:1], (f"{role}:{text}",)))
                to = "a" if state == "u" else "u"
                options.append((more + 1, "R", to, ({"u": "user", "a": "assistant"}[to] + ":" + text,)))
            for c, e, to, line in options:
                rest = best(i + 1, to)
                found.append((cost + c + rest[0], audit + e + rest[1], lines + line + rest[2]))
        known[i, last] = min(found)
        return known[i, last]

    cost, audit, lines = best(0, "")
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def found(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    edits, faults = repair.repair(frame, Scratch(spark))
    out = {r["conv_id"]: r.asDict() for r in faults.collect()}
    for r in repair.digests(edits).collect():
        out[r["conv_id"]] |= r.asDict()
    return out, edits


@pytest.mark.parametrize("bits", [8, 1])
def test_repair_agrees_with_plain_recursion(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "_LEAST_BITS", bits)
    rng = random.Random(3)
    rows = []
    for conv in [None, *range(60)]:
        for i in range(rng.choice([1, 2, 3, 5, 9, 40])):
            turn = rng.choice([i, i, i, i + 3, None, -i])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "tool", "", "u", "aide"])
            text = rng.choice(["Yes.", f"No {i}!", f"so {i}", f"Well {i}? \t\n", " \x0b", "", None, "half", f"a{i}.", f"of {i}.f"])
            rows.append((conv, turn, role, text))
    rows += rows[:7]
    results, _ = found(spark, rows)
    wanted = {c: plain([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert set(results) == set(wanted)
    for conv, want in wanted.items():
        assert {k: results[conv][k] for k in want} == want, conv


def test_a_hot_conversation_is_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(repair, "_LEAST_BITS", 2)
    rng = random.Random(4)
    rows = [(7, i, rng.choice(["user", "assistant", "system"]), rng.choice([f"t{i}.", f"t{i}", "", "same."])) for i in range(3000)]
    scratch = Scratch(spark)
    placed = repair.ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), scratch)
    assert repair._blocks(placed, 6).count() > 3000 / 64
    results, edits = found(spark, rows)
    want = plain_long([r[1:] for r in rows])
    assert {k: results[7][k] for k in want} == want
    assert edits.where("edit <> 'Insert'").count() == 3000


def plain_long(rows):
    import sys

    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(20000)
    try:
        return plain(rows)
    finally:
        sys.setrecursionlimit(limit)


def test_long_texts_and_empty_tables(spark):
    long = "word " * 400_000
    results, edits = found(spark, [(1, 0, "user", long + "."), (1, 1, "assistant", long + " " * 100_000)])
    assert results[1]["audit"] == "DD" and results[1]["truncated"] == 1  # 4 for both, 5 to keep both
    results, edits = found(spark, [])
    assert results == {} and edits.count() == 0


def test_edits_are_whole_rows(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "assistant", "Ho."), (1, 2, "user", "Hm."), (2, 0, "system", "S."), (2, 1, "user", "Q?")]
    _, edits = found(spark, rows)
    told = [(r["conv_id"], r["edit"], r["role"], r["text"], r["turn"]) for r in edits.orderBy("place", "step").collect()]
    assert told == [
        (1, "Rerole", "user", "Hi.", 0), (1, "Keep", "assistant", "Ho.", 1), (1, "Delete", "user", "Hm.", 2),
        (2, "Rerole", "user", "S.", 0), (2, "Rerole", "assistant", "Q?", 1),
    ]


def test_damage(spark):
    rows = [(c, t, r, x) for c in [None, 1, 22] for t in [None, *range(40)] for r, x in [("assistant", "A. b! c?"), (None, None)]]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, r, x in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x if x is not None else " "
        x = "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x
        want += [(c, t, "user" if fault == 4 else r, x)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in repair.damaged(frame).collect())
