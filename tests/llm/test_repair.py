"""Conversation repair against all edit sequences, and against a plain version of the contract."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest

from tablescope.llm import repair

SF = "/root/testdata/sf0.001"
VALID = re.compile(r"(s?(ua)+)?\Z")


def row_faults(rows):
    """(role, text) -> fault of each row."""
    seen, out = set(), []
    for role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def lines_of(rows, audit):
    """(roles, lines) that an audit gives; None where it is not valid. The
    roles of inserted and changed rows follow from their place."""
    out, i = [], 0
    for letter in audit:
        role = "user" if not out or out[-1][0][:1] in "sa" else "assistant"
        if letter == "I":
            out.append((role, ""))
            continue
        if letter == "K":
            out.append(rows[i])
        elif letter == "R":
            out.append((role, rows[i][1]))
        i += 1
    return out if VALID.match("".join((r or "?")[0] for r, _ in out)) else None


def all_audits(rows):
    """Least (cost, audit) of all edit sequences with up to two insertions at each place."""
    faults, best = row_faults(rows), None
    for letters in product("DKR", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and c != "D" for f, c in zip(faults, letters)):
            continue
        base = sum({"D": 2, "K": 0, "R": 1}[c] + (5 if f == "truncated" and c != "D" else 0) for f, c in zip(faults, letters))
        for ins in product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * n + c for n, c in zip(ins, letters)) + "I" * ins[-1]
            cost = base + 5 * sum(ins)
            if (best is None or (cost, audit) < best) and lines_of(rows, audit) is not None:
                best = (cost, audit)
    return best


def plain(rows):
    """The same by whole strings per state."""
    best = {"": (0, "")}
    faults = row_faults(rows)

    def insertions(states):
        out = dict(states)
        for _ in range(2):
            for s, (c, a) in list(out.items()):
                t = "a" if s == "u" else "u"
                if t not in out or (c + 5, a + "I") < out[t]:
                    out[t] = (c + 5, a + "I")
        return out

    for (role, _), fault in zip(rows, faults):
        new = {}
        # Insertions are taken with the row that follows, each way by itself.
        for s0, way0 in best.items():
            for k in range(3):
                s = s0
                for _ in range(k):
                    s = "a" if s == "u" else "u"
                c, a = way0[0] + 5 * k, way0[1] + "I" * k
                ways = [(s, c + 2, a + "D")]
                if fault not in ("blank", "duplicate"):
                    more = 5 * (fault == "truncated")
                    i = role[:1]
                    ok = lambda x: (s == "" and x == "s") or (x == "u" and s != "u") or (x == "a" and s == "u")  # noqa: E731, B023
                    if ok(i):
                        ways.append((i, c + more, a + "K"))
                    ways += [(x, c + 1 + more, a + "R") for x in "ua" if ok(x)]
                for t, cost, audit in ways:
                    if t not in new or (cost, audit) < new[t]:
                        new[t] = (cost, audit)
        best = new
    ends = insertions(best)
    return min(w for s, w in ends.items() if s in ("", "a"))


def expected(table):
    """Rows of the contract from (conv, turn, role, text) rows, in plain Python."""
    convs = defaultdict(list)
    for conv, turn, role, text in table:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        way = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        convs[conv]
        if way == 0:
            continue
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        convs[conv] += [(turn, "user" if way == 4 else role, text)] * (2 if way == 3 else 1)
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        own = [r[1:] for r in rows]
        faults, turns = row_faults(own), [r[0] for r in rows if r[0] is not None]
        cost, audit = plain(own)
        text = "\n".join(f"{r}:{t}" for r, t in lines_of(own, audit))
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def streamed(rows):
    c, seen = repair.Conversation(0), set()
    for k, ((role, text), fault) in enumerate(zip(rows, row_faults(rows))):
        c.add(k, role, text, (role, text), (role, text) not in seen, fault == "blank", not re.search(r"[.!?]\s*\Z", text))
        seen.add((role, text))
    return c.result()


@pytest.mark.parametrize("seed", range(12))
def test_every_edit_sequence(seed):
    r = random.Random(seed)
    for _ in range(12):
        rows = [(r.choice(["user", "assistant", "system", "tool", ""]), r.choice(["a.", "b!", "c?", "cut", "", f"x{r.random()}."])) for _ in range(r.randrange(5))]
        cost, audit = all_audits(rows)
        got = streamed(rows)
        assert (got[6], got[7]) == (cost, audit) == plain(rows), rows
        assert got[8] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines_of(rows, audit)).encode()).hexdigest()


def test_long_conversation_spills(monkeypatch):
    monkeypatch.setattr(repair, "SPOOL_BYTES", 64)
    monkeypatch.setattr(repair, "BACK_ROWS", 16)
    r = random.Random(3)
    rows = [(r.choice(["user", "assistant", "system", "tool"]), r.choice(["a.", "cut", "", *(f"x{r.random()}." for _ in range(6))])) for _ in range(2000)]
    got = streamed(rows)
    assert (got[6], got[7]) == plain(rows)
    assert got[8] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines_of(rows, got[7])).encode()).hexdigest()


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_tables_and_odd_rows(spark):
    base = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    odd = [
        (None, 0, "user", "no id."), (None, None, None, None), (5001, None, "user", "a."), (5001, None, "assistant", "b."), (5001, 7, "user", "a."), (5001, 7, "user", "a."),
        (5002, 3, "user", None), (5002, 3, None, "x."), (5003, 1, "tool", "t!"), (5003, 2**62, "", "t!"), (5004, 1, "user", "long " * 90_000), (5004, 2, "assistant", " é. \x0b\n"), (2**60 + 1, 0, "user", "q?"),
    ]
    hot = [(6000, k, r, f"{k % 400}.") for k, r in enumerate(["user", "assistant"] * 1500)]
    lone = [(c, 0, "user", "x.") for c in range(7000, 7200)]
    rows = base + odd + hot + lone
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as conv", "2 as t", "3 as digest").repartition(3)
    got = repair.repair(repair.damage(df), "conv", "turn", "role", "text", "present")
    assert found(got) == expected(rows)
    assert sum(r[7] == "" for r in found(got)) > 3
    assert repair.repair(df.limit(0)).collect() == []
    # Without damage and under other names.
    other = df.filter("conv_id = 6000").selectExpr("cast(conv_id as string) as c", "turn as n", "role as r", "text as x")
    (row,) = repair.repair(other, "c", "n", "r", "x").collect()
    assert row.c == "6000" and row.duplicate == 2600 and (row.cost, row.audit) == plain([h[2:] for h in hot])
