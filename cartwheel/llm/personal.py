"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans of four kinds (see ``base_spans``).  Per document, the nodes of the field
are the base spans, fixed to their kind, and loose mentions that no pattern took: number runs of 9 digits
or more, and every token that is, but for punctuation around it, the mailbox of one of the document's base
e-mails, however short or plain (its shape is a feature).  A document with loose mentions only has a field
too.  Not nodes: shorter number runs, and mailboxes inside a longer token.  Neighbouring nodes share a chain potential; nodes with the same or similar content
anywhere in the document (same trailing digits, same mailbox) share a skip potential.  Loopy belief
propagation passes messages until they settle, and a loose node whose belief in a kind passes
``threshold`` becomes a span of it.

Potentials are counted over all documents: what nodes of each kind look like, which kinds follow
each other, and how often linked base spans agree.  Counts are additive, of a fixed number of keys.

Defined cases: null and empty texts have no spans; the longest texts are handled whole; repeated
rows get the same result each; an empty table gives an empty one.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import slices

KINDS = ("email", "ip", "card", "phone")
_MAILBOX = re.compile(r"[A-Za-z0-9._%+-]+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_RUN, _OPEN = re.compile(r"[0-9()./\x20-]{7,}"), re.compile(r"[0-9(]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[0-9._%+-]")

Span = tuple[int, int, int]  # start, kind, end


def _emails(text: str):
    past = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            past = m.end()
        at = text.find("@", max(at + 1, past))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _byte(digits: str) -> bool:
    """Without leading zeros, 255 at most; a part may have thousands of digits."""
    return len(digits) < 3 or len(digits) == 3 and digits <= "255"


def _number_runs(text: str):
    """Spans from a digit or bracket to the last digit of a run of digits, brackets and separators, 7 or more
    characters and 9 or more digits; each run is looked at once."""
    for run in _RUN.finditer(text):
        s = run.group()
        first, last = _OPEN.search(s), len(s.rstrip("()./ -"))
        if first and last - first.start() >= 7 and sum(c.isdigit() for c in s) >= 9:
            yield run.start() + first.start(), run.start() + last


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns: leftmost, non-overlapping per kind, failing ones dropped."""
    out: list[Span] = []
    if "@" in text:
        out += [(a, 0, z) for a, z in _emails(text)]
    if not _DIGIT.search(text):
        return out
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(_byte(p.lstrip("0")) for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out)


class Node:
    def __init__(self, text: str, start: int, end: int, kind: int, boxed: bool = False):
        self.start, self.end, self.kind = start, end, kind  # kind -1: loose
        s = text[start:end]
        self.digits = re.sub(r"[^0-9]", "", s)
        self.keys = [("digits", self.digits[-9:])] if len(self.digits) >= 9 and "@" not in s else []
        box = (s if "@" in s else s.strip("<>()[]{}\"',;:!?.")).split("@")[0].lower()
        if boxed or not self.keys:
            self.keys.append(("box", box))
        n = len(self.digits)
        self.looks = (f"digits{min(n, 20) // 3}", f"at{'@' in s}", f"dots{min(s.count('.'), 3)}", f"round{'(' in s}", f"letters{any(c.isalpha() for c in s)}")
        self.looks += (f"box{min(len(box), 12) // 3}{bool(_MARK.search(box))}",)


def nodes_of(text: str, base: list[Span]) -> list[Node]:
    """Base spans and loose mentions that overlap none, in order."""
    nodes = [Node(text, a, z, k) for a, k, z in base]
    taken = sorted((a, z) for a, _, z in base)
    loose: list[tuple[int, int]] = []
    named: set[tuple[int, int]] = set()
    if _DIGIT.search(text):
        loose += _number_runs(text)
    boxes = {k for n in nodes if n.kind == 0 for x, k in n.keys if x == "box"}
    if boxes:
        for m in _TOKEN.finditer(text):
            s = m.group()
            core = s.strip("<>()[]{}\"',;:!?.")
            if core.split("@")[0].lower() in boxes:
                a = m.start() + s.find(core)
                named.add((a, a + len(core)))
    i, out = 0, []
    for a, z in sorted(named.union(loose)):
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if (i == len(taken) or taken[i][0] >= z) and (not out or out[-1][1] <= a):
            out.append((a, z))
    nodes += [Node(text, a, z, -1, (a, z) in named) for a, z in out]
    return sorted(nodes, key=lambda n: (n.start, n.end))


def links(nodes: list[Node]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges (neighbours) and skip edges (each node to the next of its key, and to the first)."""
    chain = [(i, i + 1) for i in range(len(nodes) - 1)]
    by = defaultdict(list)
    for i, n in enumerate(nodes):
        for k in n.keys:
            by[k].append(i)
    skip = {e for same in by.values() for a, b in zip(same, same[1:], strict=False) for e in ((a, b), (same[0], b))}
    return chain, sorted(e for e in skip if e[0] != e[1])


def counted(text: str) -> Counter:
    """What one document adds to the model's counts (label 0: none, 1..: kinds)."""
    base, out = base_spans(text), Counter()
    if not base and not (_DIGIT.search(text) and any(True for _ in _number_runs(text))):
        return out
    nodes = nodes_of(text, base)
    chain, skip = links(nodes)
    for n in nodes:
        out["label", str(n.kind + 1), ""] += 1
        for f in n.looks:
            out["look", str(n.kind + 1), f] += 1
    for a, b in chain:
        out["chain", str(nodes[a].kind + 1), str(nodes[b].kind + 1)] += 1
    for a, b in skip:
        if nodes[a].kind >= 0 and nodes[b].kind >= 0:
            out["skip", "", str(nodes[a].kind == nodes[b].kind)] += 1
    return out


class Field:
    """Log potentials from counts, and inference."""

    def __init__(self, rows: list[tuple[str, str, str, int]], threshold: float = 0.5, iterations: int = 25):
        n = len(KINDS) + 1
        self.threshold, self.iterations = threshold, iterations
        label, look, chain, agree = np.ones(n), defaultdict(lambda: np.full(n, 0.5)), np.ones((n, n)), {"True": 1, "False": 1}
        for part, a, b, k in rows:
            if part == "label":
                label[int(a)] += k
            elif part == "look":
                look[b][int(a)] += k
            elif part == "chain":
                chain[int(a), int(b)] += k
            else:
                agree[b] += k
        self.prior = np.log(label / label.sum())
        self.look = {f: np.log(c / (label + 1)) for f, c in look.items()}
        joint = chain / chain.sum()
        lift = joint / joint.sum(1, keepdims=True) / joint.sum(0, keepdims=True)
        self.chain = np.clip(np.log(lift), -1.0, 1.0)
        self.skip = np.eye(n) * min(8.0, 4.0 + max(0.0, math.log(agree["True"] / agree["False"])))

    def beliefs(self, nodes: list[Node]) -> np.ndarray:
        n, chain, skip = len(self.prior), *links(nodes)
        unary = np.array([self.prior + sum((self.look[f] for f in x.looks if f in self.look), np.zeros(n)) for x in nodes])
        for i, x in enumerate(nodes):
            if x.kind >= 0:
                unary[i] = -60.0
                unary[i, x.kind + 1] = 0.0
        unary -= unary.max(1, keepdims=True)
        edges = np.array(chain + skip, np.int64).reshape(-1, 2)
        pair = np.array([self.chain] * len(chain) + [self.skip] * len(skip)).reshape(-1, n, n)
        src, dst = np.concatenate((edges[:, 0], edges[:, 1])), np.concatenate((edges[:, 1], edges[:, 0]))
        psi = np.exp(np.concatenate((pair, pair.transpose(0, 2, 1))))  # [edge, source label, target label]
        back = np.concatenate((np.arange(len(edges)) + len(edges), np.arange(len(edges))))
        message = np.full((len(src), n), -math.log(n))
        for _ in range(self.iterations):
            total = unary.copy()
            np.add.at(total, dst, message)
            out = total[src] - message[back]
            out = np.exp(out - out.max(1, keepdims=True))
            new = np.log(np.maximum(np.einsum("es,est->et", out, psi), 1e-300))
            new -= np.log(np.exp(new).sum(1, keepdims=True))
            new = np.logaddexp(message, new) - math.log(2)  # damped
            settled = not len(new) or np.abs(new - message).max() < 1e-4
            message = new
            if settled:
                break
        total = unary.copy()
        np.add.at(total, dst, message)
        p = np.exp(total - total.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """(base spans, all spans), by start and then kind."""
        base = base_spans(text)
        nodes = nodes_of(text, base)
        loose = [i for i, x in enumerate(nodes) if x.kind < 0]
        if not loose:
            return base, base
        p = self.beliefs(nodes)
        more = [(nodes[i].start, int(p[i].argmax()) - 1, nodes[i].end) for i in loose if p[i].argmax() and p[i].max() > self.threshold]
        return base, sorted(base + more)


def _strings(b: pa.RecordBatch) -> list[str]:
    return [t or "" for t in b.column("text").to_pylist()]


def fit(docs: DataFrame, text: str = "text", **options) -> Field:
    """Count all documents; a fixed number of keys comes to the driver."""

    def count(batches):
        total: Counter = Counter()
        for b in slices(batches, "text", 4 << 20):
            for t in _strings(b):
                total.update(counted(t))
        part, a, k = (pa.array([x[i] for x in total], pa.string()) for i in range(3))
        yield pa.RecordBatch.from_arrays([part, a, k, pa.array(list(total.values()), pa.int64())], ["part", "a", "b", "n"])

    plain = docs.select(F.col(text).cast("string").alias("text"))
    rows = plain.mapInArrow(count, "part string, a string, b string, n long").groupBy("part", "a", "b").agg(F.sum("n")).collect()
    return Field(sorted(tuple(r) for r in rows), **options)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: id, ``base`` and ``spans``, arrays of (kind, start, end) in code points."""
    field = fit(docs, text, **options)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for b in slices(batches, "text", 4 << 20):
            found = [field.spans(t) for t in _strings(b)]
            cols = [pa.array([[{"kind": KINDS[k], "start": a, "end": z} for a, k, z in f[i]] for f in found], kind) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column("id"), *cols], ["id", "base", "spans"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    spans = "array<struct<kind:string,start:int,end:int>>"
    out = plain.mapInArrow(run, f"id {plain.schema['id'].dataType.simpleString()}, base {spans}, spans {spans}")
    return out.withColumnRenamed("id", id_col)
