"""Lines that share a segment with very many others."""

import random

import pytest
from test_lines_chat_files import brute_lines, changed, edits

from cartwheel.llm import lines


@pytest.mark.parametrize("t", [1, 2, 3])
def test_cut_keys(t):
    r = random.Random(t)
    for _ in range(400):
        a = "".join(r.choice("abcé") for _ in range(r.randrange(1, 60)))
        b = changed(r, a, r.randrange(t + 1))
        short, long_ = sorted((a, b), key=len)
        keys, _, own = lines.cut_keys([short], t, 2 * t + 1)
        assert edits(a, b) <= t and set(keys[own].tolist()) & set(lines.cut_keys([long_], t, 2 * t + 1)[0].tolist())


def test_wide_signatures_stay_near():
    r = random.Random(5)
    for _ in range(400):
        a = "".join(r.choice("abcdefé ") for _ in range(r.randrange(1, 80)))
        b = changed(r, a, 2) or "x"
        x, y = lines.wide_signatures([a, b]).tolist()
        apart = [((p ^ q) & (2**64 - 1)).bit_count() for p, q in zip(x, y, strict=True)]
        n = edits(a, b)
        assert sum(apart[:4]) <= 4 * n and apart[4] <= 2 * n


@pytest.mark.parametrize("crowd", [1, 6])
def test_crowded_keys_lose_no_link(docs_of, crowd):
    r = random.Random(crowd)
    base = ["".join(r.choice("abcdefé ") for _ in range(r.randrange(20, 50))) + "x" for _ in range(4)]
    rows = [(i, "\n".join(changed(r, r.choice(base), r.randrange(5)) for _ in range(4))) for i in range(40)]
    rows += [(None, base[0]), (90, None), (7, rows[7][1])]
    got = lines.find_repeated_lines(docs_of(rows), crowd=crowd).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute_lines(rows)


def test_near_copies_are_not_all_compared(docs_of, monkeypatch):
    """n lines of one template, a word of each replaced, make few pairs to verify; the signature let half of them pass."""
    r = random.Random(8)
    say = lambda: "".join(r.choice("abcdefghiklmnoprst") for _ in range(r.randrange(4, 8)))
    base, seen = [say() for _ in range(40)], []
    rows = []
    for i in range(600):
        w = list(base)
        w[r.randrange(40)] = say()
        rows.append((i, " ".join(w)))
    plain = lines.written
    monkeypatch.setattr(lines, "written", lambda df, *by: (seen.append(plain(df, *by)), seen[-1])[1])
    links = lines.linked_lines(docs_of(rows).selectExpr("doc_id AS id", "text"), 2, 20).count()
    pairs = max(df.count() for df in seen if df.columns == ["a", "b"])
    assert pairs <= 20 * 600 and links <= pairs
