"""Conversation repair against enumerated edits and a plain search over whole audits."""

import itertools
import random
import re
import zlib

from brute import sha

from cartwheel.llm import repair
from cartwheel.llm.queries import QUERIES

COLS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
FORM = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """(role, text, fault) of a conversation's rows in order."""
    seen, out = set(), []
    for role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+", "", text)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def cheapest(rows):
    """(cost, audit, turns): least of all audits, by whole strings for every state reached."""
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def add(into, state, way):
        if state not in into or way[:2] < into[state][:2]:
            into[state] = way

    def inserts(now):
        for _ in range(3):
            for state, (c, e, t) in list(now.items()):
                for name in ("user", "assistant"):
                    if name[0] in legal[state]:
                        add(now, name[0], (c + 5, e + "I", (*t, (name, ""))))
        return now

    for role, text, fault in faults(rows):
        new = {}
        for state, (c, e, t) in inserts(best).items():
            add(new, state, (c + 2, e + "D", t))
            if fault not in ("blank", "duplicate"):
                c += 5 * (fault == "truncated")
                for name in ("user", "assistant"):
                    if name[0] in legal[state]:
                        add(new, name[0], (c + 1, e + "R", (*t, (name, text))))
                if role[:1] and role[0] in legal[state]:
                    add(new, role[0], (c, e + "K", (*t, (role, text))))
        best = new
    ends = inserts(best)
    return min(ends[s] for s in ("", "a") if s in ends)


def enumerated(rows):
    """(cost, audit): every edit of every row with up to two inserts in every gap."""
    marked, least = faults(rows), None
    for edits in itertools.product("KuaD", repeat=len(rows)):
        base, letters = 0, []
        for e, (role, _, fault) in zip(edits, marked, strict=True):
            base += {"K": 0, "D": 2}.get(e, 1) + (5 if fault == "truncated" and e != "D" else 0)
            letters.append("" if e == "D" else role[:1] or "?" if e == "K" else e)
        if any(e != "D" and f in ("blank", "duplicate") for e, (_, _, f) in zip(edits, marked, strict=True)):
            continue
        for gaps in itertools.product(("", "u", "a", "ua", "au"), repeat=len(rows) + 1):
            got = gaps[0] + "".join(x + g for x, g in zip(letters, gaps[1:], strict=True))
            if FORM.fullmatch(got):
                way = "I" * len(gaps[0]) + "".join(("R" if e in "ua" else e) + "I" * len(g) for e, g in zip(edits, gaps[1:], strict=True))
                cost = base + 5 * sum(map(len, gaps))
                least = min(least or (cost, way), (cost, way))
    return least


def brute(rows, damage):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        n = 1
        if damage:
            h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            n = 0 if h == 0 else 2 if h == 3 else 1
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            role = "user" if h == 4 else role
        by[conv] += [(turn, role, text)] * n
    out = []
    for conv, turns in by.items():
        turns = sorted(turns, key=lambda x: (x[0] is not None, x[0]))
        numbers = [t for t, _, _ in turns if t is not None]
        body = [x[1:] for x in turns]
        kinds = [f for *_, f in faults(body)]
        bad = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(body))
        cost, edits, done = cheapest(body)
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        out.append((conv, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), bad, cost, edits, sha("\n".join(f"{r}:{t}" for r, t in done))))
    return sorted(out, key=str)


def conversations(seed, n, longest):
    r, rows = random.Random(seed), []
    for c in range(n):
        for t in range(r.randrange(longest)):
            role = r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "Asst", None])
            rows.append((c, t + r.randrange(2) * r.randrange(4), role, r.choice(["Yes.", "No!", "open", " \t", None, "", "Really? \n", "é", f"text {r.random()}."])))
    numbered = {(c, t): (c, t, role, text) for c, t, role, text in rows}  # one row per turn: ties have their own test
    return list(numbered.values())


def codes_of(body):
    bits = {None: 0, "blank": 4, "duplicate": 8, "truncated": 16}
    return bytes("sua".find(role[:1] or "?") % 4 + bits[f] for role, _, f in faults(body))


def test_audit_is_least():
    r = random.Random(1)
    for n in range(4):
        for _ in range(12):
            body = [(r.choice(["system", "user", "assistant", "tool"]), r.choice(["a.", "b.", "open", ""])) for _ in range(n)]
            assert repair.audit(codes_of(body)) == cheapest(body)[:2] == enumerated(body)
    for n in (5, 8, 13, 40, 200):
        for _ in range(40):
            body = [(r.choice(["system", "user", "assistant", "tool"]), r.choice(["a.", f"{r.random()}.", f"{r.random()}", ""])) for _ in range(n)]
            assert repair.audit(codes_of(body)) == cheapest(body)[:2]


def frame(spark, rows):
    return spark.createDataFrame([(*x, "x", 0) for x in rows], "conv_id long, turn long, role string, text string, code string, first int")


def test_repair(spark):
    rows = conversations(2, 60, 14) + [(None, 3, "user", "Hi."), (None, None, "user", None), (900, None, None, None)]
    rows += [(901, t, ("user", "assistant")[t % 2], "word " * 20_000 + ".") for t in range(3)] + [(902, i, "user", f"{i}.") for i in range(25_000)]
    got = repair.repair(frame(spark, rows))
    assert sorted((tuple(x) for x in got.select(*COLS).collect() if x["conv_id"] != 902), key=str) == [x for x in brute(rows[:-25_000], False)]
    long = got.where("conv_id = 902").first()
    assert long["cost"] == 12_500 and len(long["audit"]) == 25_000 and set(long["audit"]) == {"K", "R"}
    d = repair.turn_codes(frame(spark, rows), "conv_id", "turn", "role", "text")
    turns = repair.repaired(d, repair.repair_plans(d)).collect()
    told = {}
    for x in sorted(turns, key=lambda x: (x["conv"] is not None, x["conv"] or 0, x["place"])):
        told.setdefault(x["conv"], []).append(f"{x['role']}:{x['text']}")
    assert {x["conv_id"]: x["repaired_sha256"] for x in got.collect()} == {x["conv_id"]: sha("\n".join(told.get(x["conv_id"], []))) for x in got.collect()}


def test_ties_and_repeated_rows(spark):
    rows = [(1, 0, "user", "One."), (1, 0, "user", "One."), (1, 0, "assistant", "Two."), (1, 1, "user", "B."), (1, 1, "user", "A."), (1, 1, "assistant", "C.")]
    got = [tuple(x) for x in repair.repair(frame(spark, rows)).select(*COLS).collect()]
    assert got == [tuple(x) for x in repair.repair(frame(spark, rows[::-1]).repartition(3)).select(*COLS).collect()]
    assert got[0][1:7] == (0, 0, 1, 0, 2, 5)  # by turn and role: a u u, then a u u


def test_query(spark, tmp_root):
    rows = conversations(3, 80, 9) + [(None, None, None, None), (None, 1, "user", "Hi.")]
    spark.createDataFrame([(*x, "y") for x in rows], "conv_id long, turn long, role string, text string, audit string").write.parquet(f"{tmp_root}/conversations.parquet")
    assert sorted(map(tuple, QUERIES["op12_hirschberg"](spark, tmp_root).select(*COLS).collect()), key=str) == brute(rows, True)
    sf = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, QUERIES["op12_hirschberg"](spark, sf).select(*COLS).collect()), key=str) == brute(rows, True)


def test_empty_table(spark):
    assert repair.repair(frame(spark, [(1, 0, "user", "x")]).where("conv_id < 0")).count() == 0
