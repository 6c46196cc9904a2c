"""Brute-force versions of the operators' contracts, straight from their wording."""

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def op5(rows, shingle=3, max_bits=2):
    fps = []
    for _, text in rows:
        w = words(lower(text))
        if not w:
            fps.append(0)
            continue
        sh = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
        h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h)))
    f = np.array(fps, np.uint64)
    label, near = list(range(len(rows))), [np.flatnonzero(np.bitwise_count(f ^ x) <= max_bits) for x in f]
    for _ in rows:
        new = [min(label[j] for j in near[i]) for i in range(len(rows))]
        if new == label:
            break
        label = new
    least = {}
    for (i, _), c in zip(rows, label, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted(((i, f"{x:016x}", least.get(c)) for (i, _), x, c in zip(rows, fps, label, strict=True)), key=str)


def op6(rows, window=13):
    ws, first = [words(t) for _, t in rows], {}
    for (i, _), w in zip(rows, ws, strict=True):
        for j in range(len(w) - window + 1):
            k = tuple(w[j : j + window])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for (i, _), w in zip(rows, ws, strict=True):
        gone = set()
        for j in range(len(w) - window + 1):
            if i is not None and first[tuple(w[j : j + window])] < i:
                gone.update(range(j, j + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for n, x in enumerate(w) if n not in gone))))
    return sorted(out, key=str)


def op7_base(text):
    t, w = text or "", words(text)
    lines = [x for x in t.split("\n") if words(x)]
    seen = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
    again = {p for j in range(len(w) - 7) if seen[tuple(w[j : j + 8])] > 1 for p in range(j, j + 8)}
    failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), failed)


def op9(rows, items, span=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = {}
    for i, t in items:
        w = split(t)
        for k in [tuple(w[j : j + span]) for j in range(len(w) - span + 1)] or ([tuple(w)] if w else []):
            windows.setdefault(k, set()).add(i)
    out = []
    for d, t in rows:
        w, hit, found = split(t), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(w[j : j + n])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((d, len(w), len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    return sorted(out, key=str)


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        x = int(c) * (2 if i % 2 else 1)
        total += x if x < 10 else x - 9
    return total % 10 == 0


def op10_base(text):
    t, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for k, (name, pattern) in enumerate((
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    )):
        for m in re.finditer(pattern, t):
            s = m.group()
            ok = name == "email" or name == "ip" and all(int(p) <= 255 for p in s.split("."))
            ok = ok or name == "card" and 12 <= len(digits(s)) <= 19 and luhn(digits(s)) or name == "phone" and 9 <= len(digits(s)) <= 15
            if ok:
                out.append((m.start(), k, f"{name}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def op3(rows, k=5):
    """(id, held_out, n_tokens, n_known, N, base_score, score) by the formulas, token by token."""
    import math
    import zlib

    docs = [(i, zlib.crc32(str("" if i is None else i).encode()) % 10 == 0, [*words(lower(t)), None]) for i, t in rows]
    uni, bi, hist = Counter(), Counter(), Counter()
    for _, held, w in docs:
        if not held:
            uni.update(w)
            for a, b in zip(["<start>", *w], w, strict=False):
                bi[a, b] += 1
                hist[a] += 1
    n, v = sum(uni.values()), len(uni)

    def discount(counts):
        m = Counter(counts.values())
        flat = {r: (r - 0.5) / r for r in range(1, k + 1)}
        if any(m[r] == 0 for r in range(1, k + 2)):
            return flat
        a = (k + 1) * m[k + 1] / m[1]
        d = {r: ((r + 1) * m[r + 1] / (r * m[r]) - a) / (1 - a) for r in range(1, k + 1)} if a < 1 else flat
        return d if all(0 < x < 1 for x in d.values()) else flat

    d1, d2 = discount(uni), discount(bi)
    kept = lambda r, d: r * d[r] if r <= k else r - 0.5
    unknown = 1 - sum(kept(c, d1) for c in uni.values()) / n if n else 1.0
    p1 = lambda w: kept(uni[w], d1) / n if uni[w] else unknown
    mass, cover = Counter(), Counter()
    for (a, b), c in bi.items():
        mass[a] += kept(c, d2) / hist[a]
        cover[a] += p1(b)
    out = []
    for i, held, w in docs:
        score = 0.0
        for a, b in zip(["<start>", *w], w, strict=False):
            if bi[a, b]:
                p = kept(bi[a, b], d2) / hist[a]
            else:
                p = p1(b) * ((1 - mass[a]) / (1 - cover[a]) if hist[a] else 1.0)
            score += math.log10(p)
        base = sum(math.log10((uni[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        out.append((i, held, len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return out
