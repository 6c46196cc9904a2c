"""Conversation structure repair by Hirschberg's divide and conquer.

The turns of a conversation, by turn number, are edited at least cost until their role initials read
``(s?(ua)+)?``: keep a turn (0), give it the role user or assistant (1), delete it (2; required for
blank and duplicate turns) or insert an empty user or assistant turn anywhere (5); a truncated turn
that is not deleted adds 5.  The audit is the edits' initials in order; of the cheapest edits the
ASCII-least audit is taken.

Where a conversation stands is one of four states (nothing yet, s, ends in u, ends in a).  Cost
vectors over the states run forward from the first turn and backward from the last, and meet in the
middle; the optimal crossing whose audit is least splits the conversation, and both halves are solved
alike.  Only two vectors are held at a time.  A crossing is a state right after a turn's own edit, so
no audit that reaches one is a prefix of another that does: the forward vector needs, beside costs,
only the order of the four least audits to decide ties.

A conversation's turns are streamed in order through one task, twice: as a byte per turn to find the
audit, then with their texts to apply it; no task holds a conversation's texts.

Defined cases: null role and text are one space; null turn numbers come first, turns of one number
are ordered by role and a hash of the text; the null conversation is one conversation; an unknown role
must be changed or deleted; repeated rows are duplicates; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAMES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5
SPACES = " \t\n\x0b\f\r"

# State 0: nothing yet, 1: s, 2: ends in u, 3: ends in a.
_AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEEDS = "uuau"  # the role that user/assistant edits give in each state
_LETTERS = "sua?"
_CODE_BLANK, _CODE_DUPLICATE, _CODE_TRUNCATED = 4, 8, 16


def _inserted(state: int):
    """(state, cost, edits) after up to two inserted turns; a third would return to a state already passed."""
    for n in range(3):
        yield state, n * INSERT, "I" * n
        state = _AFTER[state, _NEEDS[state]]


def _moves(code: int) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, edits): the least of the ways past a turn, inserts before it included."""
    letter, least = _LETTERS[code & 3], {}
    extra = TRUNCATED if code & _CODE_TRUNCATED else 0
    for start in range(4):
        for state, cost, edits in _inserted(start):
            ways = [(state, cost + DELETE, edits + "D")]
            if not code & (_CODE_BLANK | _CODE_DUPLICATE):
                ways.append((_AFTER[state, _NEEDS[state]], cost + REROLE + extra, edits + "R"))
                if (state, letter) in _AFTER:
                    ways.append((_AFTER[state, letter], cost + KEEP + extra, edits + "K"))
            for to, c, e in ways:
                least[start, to] = min(least.get((start, to), (c, e)), (c, e))
    return [(a, b, c, e) for (a, b), (c, e) in sorted(least.items())]


MOVES = [_moves(code) for code in range(32)]
_EDITS = [{(a, b): e for a, b, _, e in m} for m in MOVES]
_END = [min((c, e) for state, c, e in _inserted(s) if state in (0, 3)) for s in range(4)]
_FAR = 1 << 60


def forward(codes: bytes, lo: int, hi: int, start: int) -> tuple[list[int], list[int]]:
    """Least cost from ``start`` before turn lo to each state after turn hi - 1, and the order of the least audits."""
    cost, rank = [_FAR] * 4, [0] * 4
    cost[start] = 0
    for i in range(lo, hi):
        best: list = [None] * 4
        for a, b, c, e in MOVES[codes[i]]:
            if cost[a] < _FAR:
                way = (cost[a] + c, rank[a], e)
                if best[b] is None or way < best[b]:
                    best[b] = way
        cost = [_FAR if x is None else x[0] for x in best]
        order = sorted((x[1:], s) for s, x in enumerate(best) if x is not None)
        for place, (_, s) in enumerate(order):
            rank[s] = place
    return cost, rank


def backward(codes: bytes, lo: int, hi: int, end: int) -> list[int]:
    """Least cost from each state before turn lo to ``end`` after turn hi - 1."""
    cost = [_FAR] * 4
    cost[end] = 0
    for i in range(hi - 1, lo - 1, -1):
        new = [_FAR] * 4
        for a, b, c, _ in MOVES[codes[i]]:
            if c + cost[b] < new[a]:
                new[a] = c + cost[b]
        cost = new
    return cost


def _solve(codes: bytes, lo: int, hi: int, start: int, end: int, out: list[str]) -> None:
    if hi - lo <= 1:
        if hi > lo:
            out.append(_EDITS[codes[lo]][start, end])
        return
    mid = (lo + hi) // 2
    (cost, rank), back = forward(codes, lo, mid, start), backward(codes, mid, hi, end)
    _, _, cross = min((cost[s] + back[s], rank[s], s) for s in range(4) if cost[s] + back[s] < _FAR)
    _solve(codes, lo, mid, start, cross, out)
    _solve(codes, mid, hi, cross, end, out)


def audit(codes: bytes) -> tuple[int, str]:
    """(cost, least audit) of a conversation's turn codes."""
    cost, rank = forward(codes, 0, len(codes), 0)
    total, _, end = min((cost[s] + _END[s][0], rank[s], s) for s in range(4) if cost[s] < _FAR)
    out: list[str] = []
    _solve(codes, 0, len(codes), 0, end, out)
    return total, "".join(out) + _END[end][1]


_STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _described(turns: list[int | None], codes: bytes) -> list:
    """The statistics, cost and audit of one conversation.  ``turns``: (least, most, distinct) of the numbers."""
    c = np.frombuffer(codes, np.uint8)
    blank = (c & _CODE_BLANK) > 0
    double = ~blank & ((c & _CODE_DUPLICATE) > 0)
    cut = ~blank & ~double & ((c & _CODE_TRUNCATED) > 0)
    pair = (c[:-1] & 3) * 4 + (c[1:] & 3)
    illegal = len(pair) - int(np.isin(pair, (0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1)).sum())
    low, high, distinct = turns
    total, edits = audit(codes)
    return [high - low + 1 - distinct if distinct else 0, int(blank.sum()), int(double.sum()), int(cut.sum()), illegal, total, edits]


def turn_codes(conv: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, h1, h2): null role and text as one space, the hashes of the text."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = conv.select(F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"), one(role).alias("role"), one(text).alias("text"))
    return d.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.reverse("text"))})


def _in_order(d: DataFrame, *first: str) -> DataFrame:
    order = [F.col("conv").asc_nulls_first(), *first, F.col("turn").asc_nulls_first(), "role", "h1", "h2"]
    return d.repartition("conv").sortWithinPartitions(*order)


def repair_plans(d: DataFrame) -> DataFrame:
    """conv, the statistics, cost and audit, for turns of ``turn_codes``."""
    # The exchange by conversation serves the window and the stream.
    rest = F.rtrim("text", F.lit(SPACES))
    letter = F.when(F.startswith("role", F.lit("s")), 0).when(F.startswith("role", F.lit("u")), 1).when(F.startswith("role", F.lit("a")), 2).otherwise(3)
    code = letter + F.when(rest == "", _CODE_BLANK).when(~F.right(rest, F.lit(1)).isin(".", "!", "?"), _CODE_TRUNCATED).otherwise(0)
    narrow = d.select("conv", "turn", "role", "h1", "h2", code.cast("int").alias("code")).repartition("conv")
    again = Window.partitionBy("conv", "role", "h1", "h2").orderBy(F.col("turn").asc_nulls_first())
    narrow = narrow.withColumn("code", F.col("code") + F.when(F.row_number().over(again) > 1, _CODE_DUPLICATE).otherwise(0))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "h1", "h2"]
    kind = d.schema["conv"].dataType
    out = T.StructType([T.StructField("conv", kind), *(T.StructField(c, T.LongType()) for c in _STATS), T.StructField("audit", T.StringType())])

    def run(batches):
        now, codes, turns, started = None, bytearray(), [0, 0, 0], False
        done: list[list] = []
        types = None

        def flush():
            cols = [pa.array([r[i] for r in done], types if i == 0 else pa.string() if i == len(_STATS) + 1 else pa.int64()) for i in range(len(out))]
            done.clear()
            return pa.RecordBatch.from_arrays(cols, out.names)

        for b in batches:
            types = b.column("conv").type
            for conv, turn, code in zip(*(b.column(c).to_pylist() for c in ("conv", "turn", "code")), strict=True):
                if not started or conv != now:
                    if started:
                        done.append([now, *_described(turns, bytes(codes))])
                    now, codes, turns, started = conv, bytearray(), [0, 0, 0], True
                codes.append(code)
                if turn is not None:
                    turns = [turn, turn, 1] if not turns[2] else [turns[0], turn, turns[2] + (turn != turns[1])]
            if done:
                yield flush()
        if started:
            done.append([now, *_described(turns, bytes(codes))])
            yield flush()

    return narrow.sortWithinPartitions(*order).select("conv", "turn", "code").mapInArrow(run, out)


def repaired(d: DataFrame, plans: DataFrame, digest: bool = False) -> DataFrame:
    """The repaired conversations: (conv, place, role, text), a row per turn; or with ``digest`` a row per
    conversation of ``plans``, its columns and repaired_sha256 over the newline-joined ``role:text``."""
    kind, own = d.schema["conv"].dataType, [f for f in plans.schema.fields if f.name != "conv"]
    missing = {f.name: f.dataType for f in own}
    rows = d.withColumn("first", F.lit(1)).withColumns({c: F.lit(None).cast(t) for c, t in missing.items()})
    heads = plans.withColumns({"first": F.lit(0), **{c: F.lit(None).cast(d.schema[c].dataType) for c in ("turn", "role", "text", "h1", "h2")}})
    both = _in_order(rows.unionByName(heads), "first").select("conv", "first", "role", "text", *missing)
    if digest:
        out = T.StructType([T.StructField("conv", kind), *own, T.StructField("repaired_sha256", T.StringType())])
    else:
        out = T.StructType([T.StructField("conv", kind), T.StructField("place", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

    def run(batches):
        head, edits, at, state, place, sha = None, "", 0, 0, 0, None
        lines: list[tuple] = []
        done: list[list] = []
        types: list = []

        def put(role, text):
            nonlocal place
            if digest:
                sha.update(("\n" if place else "").encode() + f"{role}:{text}".encode())
            else:
                lines.append((head[0], place, role, text))
            place += 1

        def inserts():
            nonlocal at, state
            while at < len(edits) and edits[at] == "I":
                put(NAMES[_NEEDS[state]], "")
                state = _AFTER[state, _NEEDS[state]]
                at += 1

        def end():
            if head is not None:
                inserts()
                if digest:
                    done.append([*head, sha.hexdigest()])

        def flush():
            data = done if digest else lines
            cols = [pa.array([r[i] for r in data], types[i]) for i in range(len(out))]
            data.clear()
            return pa.RecordBatch.from_arrays(cols, out.names)

        for b in batches:
            plan_types = [b.schema.field(f.name).type for f in own]
            types = [b.schema.field("conv").type, *(plan_types + [pa.string()] if digest else [pa.int64(), pa.string(), pa.string()])]
            cols = {c: b.column(c).to_pylist() for c in b.schema.names}
            for i in range(b.num_rows):
                if cols["first"][i] == 0:
                    end()
                    head = [cols["conv"][i], *(cols[f.name][i] for f in own)]
                    edits, at, state, place, sha = cols["audit"][i], 0, 0, 0, hashlib.sha256()
                    continue
                inserts()
                edit, role = edits[at], cols["role"][i]
                at += 1
                if edit == "R":
                    role = NAMES[_NEEDS[state]]
                if edit != "D":
                    put(role, cols["text"][i])
                    state = _AFTER[state, role[0]]
                if len(lines) >= 10_000:
                    yield flush()
            if done if digest else lines:
                yield flush()
        if head is not None:
            end()
            if done if digest else lines:
                yield flush()

    return both.mapInArrow(run, out)


def repair(conv: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256.  ``repaired`` gives the turns themselves."""
    d = turn_codes(conv, conv_id, turn, role, text)
    return repaired(d, repair_plans(d), digest=True).withColumnRenamed("conv", conv_id)


def damaged(conv: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of conversations with faults planted by crc32(``conv_id:turn``) % 20."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")) % 20
    d = conv.select("conv_id", "turn", one("role").alias("role"), one("text").alias("text"), key.alias("fault")).where("fault != 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return d.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")
