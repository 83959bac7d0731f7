import hashlib
import os
import random
import zlib
from collections import defaultdict

import pytest

from ledgerloom.llm import conversations as c

SMALL = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\x0c\r"


def by_force(symbols, entry=0, exits=c.END):
    """Least (cost, audit) by looking at all ways through the lattice, one row after another."""

    def inserted(best):
        for _ in range(3):
            for q, (w, audit) in list(best.items()):
                to = {0: 2, 1: 2, 2: 3, 3: 2}[q]
                best[to] = min(best.get(to, (9**9, "")), (w + 3, audit + "I"))
        return best

    best = inserted({entry: (0, "")})
    for x in symbols:
        new = {}
        for q, (w, audit) in best.items():
            ways = [(q, 4, "D")]
            if x != "x":
                more = 3 * x.isupper()
                ways.append(({0: 2, 1: 2, 2: 3, 3: 2}[q], 3 + more, "R"))
                kept = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}[x.lower()].get(q)
                if kept is not None:
                    ways.append((kept, more, "K"))
            for to, cost, letter in ways:
                new[to] = min(new.get(to, (9**9, "")), (w + cost, audit + letter))
        best = inserted(new)
    return min((best[q] for q in exits if q in best), default=None)


def test_search_same_as_by_force():
    r = random.Random(1)
    for _ in range(1500):
        symbols = "".join(r.choice("ssuuuaaaoSUAOx") for _ in range(r.randint(0, 12)))
        assert c._search(symbols, 0, c.END, True) == by_force(symbols), symbols
    for _ in range(300):
        symbols = "".join(r.choice("suuaaoUAx") for _ in range(r.randint(30, 120)))
        assert c.search(symbols, 0, c.END, True) == by_force(symbols), symbols


def plain(conv_rows):
    """The report and the repaired rows of (turn, role, text) rows, from the text of the rules."""
    rows = sorted(conv_rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest()))
    turns = {t for t, _, _ in rows if t is not None}
    out = {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, "blank": 0, "duplicate": 0, "truncated": 0}
    seen, symbols = set(), ""
    for _, role, text in rows:
        initial = role[:1] if role[:1] in ("s", "u", "a") and role else "o"
        if not text.strip(WHITE):
            out["blank"] += 1
            symbols += "x"
        elif (role, text) in seen:
            out["duplicate"] += 1
            symbols += "x"
        elif text.strip(WHITE)[-1] not in ".!?":
            out["truncated"] += 1
            symbols += initial.upper()
        else:
            symbols += initial
        seen.add((role, text))
    out["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    out["cost"], out["audit"] = by_force(symbols)
    state, k, written = 0, 0, []
    for letter in out["audit"]:
        row = rows[k] if letter != "I" else (None, "", "")
        k += letter != "I"
        if letter == "K":
            state = {"s": 1, "u": 2, "a": 3}[row[1][:1]]
            written.append((row[1], row[2]))
        elif letter in "RI":
            state = {0: 2, 1: 2, 2: 3, 3: 2}[state]
            written.append((c.ROLES[state], row[2] if letter == "R" else ""))
    return out, written


def grouped(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn, " " if role is None else role, " " if text is None else text))
    return found


def check(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS conv", "2 AS digest", "3 AS place").repartition(parts)
    reports, repaired = c.repair(frame)
    got = {r.conv_id: r for r in reports.collect()}
    written = defaultdict(list)
    for r in sorted(repaired.collect(), key=lambda r: r.place):
        written[r.conv_id].append((r.role, r.text))
    want = grouped(rows)
    assert set(got) == set(want)
    for conv, own in want.items():
        out, lines = plain(own)
        assert {x: got[conv][x] for x in out} == out, (conv, own)
        assert written[conv] == lines, (conv, own, out)
    digests = {r.conv: r.repaired_sha256 for r in c.digested(repaired).collect()}
    for conv, lines in ((k, v) for k, v in written.items() if v):
        assert digests["" if conv is None else f":{conv}"] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest()


def some_rows(r, convs, most):
    roles = ["user", "assistant", "system", "tool", "", None, "ursula"]
    texts = ["Yes.", "No!", "cut off", "  ", "", None, "a\nb?\n", "Why? ", "other.", "é", "..", "x" * 3000 + "."]
    return [(k, r.choice([None, *range(6)]), r.choice(roles[:3] * 5 + roles), r.choice(texts)) for k in convs for _ in range(r.randint(1, most))]


def test_conversations_of_all_kinds(spark):
    r = random.Random(2)
    rows = some_rows(r, [None, *range(150)], 9)
    rows += [(500, 0, "user", "Same.")] * 40 + [(501, t, "user", f"{t}.") for t in range(30)] + [(502, None, None, None)] * 3
    check(spark, rows)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    reports, repaired = c.repair(empty)
    assert reports.count() == 0 and repaired.count() == 0


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_conversations_in_many_blocks(spark, monkeypatch, bits):
    monkeypatch.setattr(c, "BLOCK_BITS", bits)
    r = random.Random(3 + bits)
    rows = some_rows(r, range(60), 12)
    rows += [(600, t, r.choice(["user", "assistant", "system"]), r.choice(["One.", f"{t}.", "cut", ""])) for t in range(300)] + [(601, 1, "user", "Same.")] * 50 + [(601, 2, "assistant", "Yes.")]
    check(spark, rows, 4)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fate = zlib.crc32(name.encode()) % 20
        text = " " if text is None else text
        text = "" if fate == 1 else "".join(x for x in text if x not in ".!?") if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_registered_query_of_conversations(spark):
    rows = [tuple(x) for x in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: r for r in c.op13_conversation_repair(spark, SMALL).collect()}
    assert set(got) == {x[0] for x in rows}
    want = grouped(damage(rows))
    for conv, r in got.items():
        out, lines = plain(want[conv]) if conv in want else ({"gaps": 0, "blank": 0, "cost": 0, "audit": ""}, [])
        assert {x: r[x] for x in out} == out
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest()


def test_query_over_nulls_and_repeated_rows(spark, tmp_path):
    r = random.Random(8)
    rows = some_rows(r, [None, *range(80)], 5) + some_rows(r, range(100, 160), 1)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"file://{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in c.op13_conversation_repair(spark, f"file://{tmp_path}").collect()}
    want = grouped(damage(rows))
    assert set(got) == {x[0] for x in rows} and len(want) < len(got)
    for conv, r in got.items():
        out, lines = plain(want[conv]) if conv in want else ({"gaps": 0, "illegal": 0, "cost": 0, "audit": ""}, [])
        assert {x: r[x] for x in out} == out
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest()
