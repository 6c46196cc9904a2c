"""MinHash near-duplicates against all pairs of full sets."""

import random

import numpy as np
from brute import lower, words

from cartwheel.llm import minhash
from cartwheel.llm.queries import QUERIES

COLS = ("doc_id", "n_shingles", "component_id", "kept")


def brute(rows, percent=85):
    sets = []
    for _, text in rows:
        w = words(lower(text))
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set()))
    label, holders = list(range(len(rows))), {}
    for i, s in enumerate(sets):
        shared = {}
        for x in s:
            for j in holders.setdefault(x, []):
                shared[j] = shared.get(j, 0) + 1
            holders[x].append(i)
        for j, same in shared.items():
            if 100 * same >= percent * (len(s) + len(sets[j]) - same) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    least = {}
    for (i, _), c in zip(rows, label, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted(((i, len(s), least.get(c), i == least.get(c)) for (i, _), s, c in zip(rows, sets, label, strict=True)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=str)


def test_near_duplicates(docs_of, small):
    r = random.Random(5)
    rows = list(small)
    base = [f"w{r.randrange(4000)}" for _ in range(300)]
    for i in range(120):  # chains: neighbours link, ends do not; and a group around one text
        base[r.randrange(300)] = f"v{i}"
        rows.append((1000 - i, " ".join(base)))
    centre = [f"c{r.randrange(4000)}" for _ in range(200)]
    for i in range(80):
        w = list(centre)
        for k in r.sample(range(200), r.randrange(1, 10)):
            w[k] = f"x{r.randrange(10**6)}"
        rows.append((2000 + i, " ".join(w)))
    rows += [(None, " ".join(centre)), (2300, "Two words"), (2299, "two  WORDS"), (2301, "two"), (None, "alone and unnamed text")]
    r.shuffle(rows)
    want = brute(rows)
    assert len({x[2] for x in want}) < len(want)
    assert got(minhash.near_duplicates(docs_of(rows))) == want
    assert minhash.near_duplicates(docs_of(rows).where("doc_id < 0")).count() == 0
    assert got(minhash.near_duplicates(docs_of(rows[:40]), percent=60, groups=20, width=2)) == brute(rows[:40], 60)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(QUERIES["op11_tensored"](spark, sf)) == brute(rows)


def test_sub_keys_agree_as_often_as_they_should():
    rng, s = np.random.default_rng(3), minhash.Sketcher(200, 1)
    pool = rng.integers(0, 1 << 63, 1300, dtype=np.uint64) * np.uint64(2)
    a, b = np.unique(pool[:1000]), np.unique(pool[300:])
    assert abs((s.sub_keys(a) == s.sub_keys(b)).mean() - 700 / 1300) < 0.1


def test_filters_keep_links():
    """Parities differ in no more bits than the sets do in elements."""
    rng = np.random.default_rng(4)
    for n in (3, 40, 900):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.append(a[n // 8 :], rng.integers(0, 1 << 63, n // 8, dtype=np.uint64)))
        bits = int(np.bitwise_count(minhash.Sketcher.parity(a) ^ minhash.Sketcher.parity(b)).sum())
        assert bits <= len(np.setxor1d(a, b))
