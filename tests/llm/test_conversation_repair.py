"""Conversation repair against plain Python: every edit sequence for short
conversations, and a forward search that keeps whole audits for longer ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from odometer.llm.conversation_repair import costs_before, least_ways, repair, repaired_rows, spoiled

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, at int, fault string, edit int"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    out, seen = [], set()
    for _, _, role, text in rows:
        body = text.rstrip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def said_next(said):
    return "a" if said == "u" else "u"


def edits(row, fault, said):
    """(initial, cost, said after, line) of the edits that take a row."""
    _, _, role, text = row
    yield "D", 4, said, []
    if fault in ("blank", "duplicate"):
        return
    more, first = 3 * (fault == "truncated"), role[:1]
    if first == said_next(said) or first == "s" and not said:
        yield "K", more, first, [f"{role}:{text}"]
    name = {"u": "user", "a": "assistant"}[said_next(said)]
    yield "R", 3 + more, said_next(said), [f"{name}:{text}"]


def inserted(said, times):
    lines = []
    for _ in range(times):
        said = said_next(said)
        lines.append({"u": "user", "a": "assistant"}[said] + ":")
    return said, lines


def forward(rows, marks):
    """Least (cost, audit) for each thing said last, row by row."""
    held = {"": (0, "", [])}
    for row, fault in zip(rows, marks):
        after = {}
        for said, (cost, audit, lines) in held.items():
            for times in range(3):
                now, more = inserted(said, times)
                for initial, price, then, line in edits(row, fault, now):
                    found = (cost + 3 * times + price, audit + "I" * times + initial, lines + more + line)
                    after[then] = min(after.get(then, found), found)
        held = after
    ends = []
    for said, (cost, audit, lines) in held.items():
        times = {"": 0, "a": 0, "u": 1, "s": 2}[said]
        ends.append((cost + 3 * times, audit + "I" * times, lines + inserted(said, times)[1]))
    return min(ends)


def every_way(rows, marks):
    """The same by trying all edits, with up to three inserts anywhere."""
    best = None
    slots = [range(4)] * (len(rows) + 1)
    for inserts in itertools.product(*slots):
        stack = [(0, "", "", [])]
        for i in range(len(rows) + 1):
            moved = []
            for cost, audit, said, lines in stack:
                said, more = inserted(said, inserts[i])
                base = (cost + 3 * inserts[i], audit + "I" * inserts[i])
                if i == len(rows):
                    moved.append((*base, said, lines + more))
                else:
                    moved += [(base[0] + p, base[1] + e, t, lines + more + ln) for e, p, t, ln in edits(rows[i], marks[i], said)]
            stack = moved
        for cost, audit, said, lines in stack:
            if said in ("", "a") and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def brute(rows):
    out = []
    after = damaged(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        marks = faults(mine)
        cost, audit, lines = forward(mine, marks)
        turns = [r[1] for r in mine if r[1] is not None]
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            marks.count("blank"), marks.count("duplicate"), marks.count("truncated"),
            sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return out


def key(row):
    return (row[0] is not None, row[0] or 0)


def random_rows(seed, convs, longest):
    rnd = random.Random(seed)
    out = []
    for c in range(convs):
        for t in range(rnd.randint(1, longest)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "uther"])
            text = rnd.choice(["Hi.", "Hello there", "Ok!", " \n", "", None, "Really? \t", f"n{t}.", f"m{t}?", "x\ny."])
            out.append((c if c else None, rnd.choice([t, t, t, t + 3, None]), role, text))
    return out


def ours(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, "f", 2) for r in rows], SCHEMA)
    found = repair(df, spoiled(df), **more)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, found.collect()), key=key)


def test_forward_search_is_the_least_of_all():
    for seed in range(40):
        rows = [(*r[:2], r[2] or " ", r[3] or " ") for r in random_rows(seed, 1, 4)][:4]
        marks = faults(rows)
        assert forward(rows, marks) == every_way(rows, marks)


@pytest.mark.parametrize("length", [512, 3])
def test_against_plain_python(spark, length):
    rows = random_rows(5, 60, 12) + random_rows(6, 61, 1)[-1:]
    assert ours(spark, rows, length=length) == sorted(brute(rows), key=key)


def test_one_long_conversation(spark):
    rnd = random.Random(9)
    rows = [(7, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", f"b{t}.", f"c{t}", "? "])) for t in range(900)]
    assert ours(spark, rows, length=16) == brute(rows)


def test_ranking_on_long_stretches():
    rnd = random.Random(3)
    for n in (1, 2, 7, 300):
        codes = "".join(rnd.choices("dsuaxSUAX", k=n))
        roles = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "d": ""}
        rows = [(0, i, roles[c.lower()], "") for i, c in enumerate(codes)]
        marks = ["blank" if c == "d" else "truncated" if c.isupper() else "" for c in codes]
        final = [0, 6, 3, 0]
        state, moves = least_ways(codes, final)[0]
        cost, audit, _ = forward(rows, marks)
        assert costs_before(codes, final)[0][0] == cost
        assert moves.translate(str.maketrans("uaUA", "IIRR")) + ["", "II", "I", ""][state] == audit


def test_dropped_conversations_clean_ones_and_empty_tables(spark):
    gone = next(c for c in range(1, 1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    clean = next(c for c in range(1, 1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 > 4 for t in range(3)))
    rows = [(gone, 0, "user", "Hi."), (clean, 0, "system", "S."), (clean, 1, "user", "Hi."), (clean, 2, "assistant", "Yes.")]
    got = ours(spark, rows)
    nothing = hashlib.sha256(b"").hexdigest()
    assert (gone, 0, 0, 0, 0, 0, 0, "", nothing) in got
    assert (clean, 0, 0, 0, 0, 0, 0, "KKK", hashlib.sha256(b"system:S.\nuser:Hi.\nassistant:Yes.").hexdigest()) in got
    df = spark.createDataFrame([], SCHEMA)
    assert repair(df, spoiled(df)).collect() == []
    df = spark.createDataFrame([(*r, 1, "f", 2) for r in rows[1:3]], SCHEMA)
    lines = [r.lines for r in repaired_rows(df).orderBy("at").collect()]
    assert lines in (["system:S.\n", "user:Hi.\nassistant:\n"], ["", ""])
