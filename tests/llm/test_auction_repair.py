"""Conversation repair against brute force."""

import hashlib
import itertools
import random
import re
from zlib import crc32

import pytest

from lodestone.llm import auction_repair
from lodestone.llm.queries import QUERIES
from lodestone.sources.tables import table

SF = "/root/testdata/sf0.01"


def shortest(marks):
    """All states' (cost, edits), row after row; plain dynamic programming."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def inserts(best):
        for _ in range(4):
            for s, (c, e) in list(best.items()):
                t = 3 if s == 2 else 2
                best[t] = min(best.get(t, (10 ** 9, "")), (c + 2, e + "I"))
        return best

    best = inserts({0: (0, "")})
    for m in marks:
        new = {}

        def offer(t, c, e):
            new[t] = min(new.get(t, (10 ** 9, "")), (c, e))

        for s, (c, e) in best.items():
            offer(s, c + 3, e + "D")
            if m == "-":
                continue
            cut = m.isupper()
            if (s, m.lower()) in after:
                offer(after[s, m.lower()], c + cut, e + "K")
            offer(3 if s == 2 else 2, c + 2 + cut, e + "R")
        best = inserts(new)
    return min(best[s] for s in (0, 3) if s in best)


def test_lattice_equals_brute_force():
    marks = "suaoSUAO-"
    for n in range(5):
        for m in itertools.product(marks, repeat=n):
            assert auction_repair.solve("".join(m)) == shortest("".join(m))


@pytest.mark.parametrize("n", [5, 31, 32, 33, 64, 65, 200, 1500])
def test_long_lattices(n):
    rng = random.Random(n)
    for weights in ([1] * 9, [1, 20, 1, 0, 0, 1, 0, 0, 1], [1, 10, 10, 1, 1, 2, 2, 1, 3]):
        m = "".join(rng.choices("suaoSUAO-", weights, k=n))
        assert auction_repair.solve(m) == shortest(m)


def test_work_is_linear_in_the_rows():
    steps = []
    for n in (400, 4000):
        lattice = auction_repair.Lattice("".join(random.Random(1).choices("suaoSUAO-", k=n)))
        lattice.settle()
        steps.append(lattice.steps / n)
    assert steps[1] < 1.3 * steps[0]


def brute(rows):
    """rows: (conv, turn, role, text) -> result by conversation."""
    space = " \t\n\x0b\x0c\r"
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        fate = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        kept += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in kept if t is not None]
        n = {"-b": 0, "-d": 0, "t": 0}
        marks, seen = "", set()
        for _, role, text in kept:
            end = text.rstrip(space)[-1:]
            m = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not end:
                m, n["-b"] = "-", n["-b"] + 1
            elif (role, text) in seen:
                m, n["-d"] = "-", n["-d"] + 1
            elif end not in ".!?":
                m, n["t"] = m.upper(), n["t"] + 1
            seen.add((role, text))
            marks += m
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept[:-1], kept[1:], strict=True))
        cost, audit = shortest(marks)
        lines, rest, user = [], list(kept), False        # user: the last turn written is the user's
        for e in audit:
            row = rest.pop(0) if e != "I" else None
            if e == "D":
                continue
            role = row[1] if e == "K" else "assistant" if user else "user"
            user = role[:1] == "u"
            lines.append(f"{role}:{row[2] if row else ''}")
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["-b"], n["-d"], n["t"], illegal,
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def rows_of(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
            for r in df.collect()}


def test_query_equals_brute_force(spark):
    want = brute([(r.conv_id, r.turn, r.role, r.text) for r in table(spark, SF, "conversations").collect()])
    df = QUERIES["op13_auction_conversation_repair"](spark, SF)
    assert rows_of(df) == want and df.count() == len(want)
    assert any(r[5] for r in want.values())


def odd_rows():
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None, "ushER"]),
             rng.choice(["yes.", "no", "", None, " \t", "why? ", "so!", "é漢.\n"]))
            for c in (None, 1, 2, 3, 40, 41, 42) for t in rng.choices([None, 0, 1, 2, 3, 7, -2], k=rng.randint(1, 9))]
    rows += [(50, t, "user" if t % 2 == 0 else "assistant", "word " * 3000 + f"{t}.") for t in range(120)]
    rows += [(60, 5, "user", "same.")] * 7
    return rows


def test_odd_rows_and_streamed_texts(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, cost int")
    want = brute(rows)
    assert rows_of(auction_repair.repair_damaged(df)) == want
    assert auction_repair.repair_damaged(df.limit(0)).count() == 0
    # the path of conversations too long to hold
    damaged = auction_repair.damaged(df)
    short = auction_repair.audits(damaged, 2).collect()
    assert {r.conv_id for r in short if r.repaired_sha256 is None}
    texts = {}
    for r in auction_repair.repaired_rows(damaged, auction_repair.audits(damaged)).orderBy("conv_id", "position").collect():
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for c, w in want.items():
        assert hashlib.sha256("\n".join(texts.get(c, [])).encode()).hexdigest() == w[-1]
    assert rows_of(auction_repair.repair(damaged, 2)) == want


def test_undamaged_rows_can_be_repaired(spark):
    df = spark.createDataFrame([("a", 1, "user", "hi."), ("a", 2, "user", "again."), ("b", 1, "system", "s."), (None, 1, "user", "q?")],
                               "conv_id string, turn int, role string, text string")
    got = {r.conv_id: (r.cost, r.audit) for r in auction_repair.repair(auction_repair.as_rows(df)).collect()}
    assert got == {"a": (2, "KR"), "b": (3, "D"), None: (2, "KI")}
