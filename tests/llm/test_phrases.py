"""Phrase collocations against brute force; the tries against a dictionary."""

import re
from collections import Counter

import numpy as np
import pytest
from brute import lower
from pyspark.sql import functions as F

from cartwheel.llm import phrases
from cartwheel.llm.queries import QUERIES

COLS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, least, longest=5, top=2000):
    out = []
    for lang in {x or "und" if x is None else x for _, x in rows}:
        f = Counter()
        for text, x in rows:
            if (x if x is not None else "und") == lang:
                for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
                    w = re.findall(r"[^\x20\x09]+", piece)
                    f.update(tuple(w[i : i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
        n = sum(c for p, c in f.items() if len(p) == 1)
        some = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        inside = {q[i : i + m] for q in some for m in range(2, len(q)) for i in range(len(q) - m + 1) if some.get(q[i : i + m]) == some[q]}
        found = []
        for p, a in some.items():
            if p not in inside:
                score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    import random

    r = random.Random(8)
    vocab = ["Alpha", "beta", "gämma", "d\x0be", "x", "7", "the", "of\t"]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    rows = [(None, "en"), ("", None), (" \t\n", "en"), ("the of, the of.the of; the\x0cof", None), (say(9000), "en")]
    rows += [(f"{say(r.randrange(30))}. New York City hall of fame, {say(5)}\nnew york CITY {say(3)}!", r.choice(["en", "de", None, ""])) for _ in range(150)]
    return rows + rows[:20]


def frame(spark, rows):
    return spark.createDataFrame([(t, x, "no", 1) for t, x in rows], "text string, lang string, words string, n long")


@pytest.mark.parametrize(("least", "nodes", "longest"), [(6, 1 << 20, 5), (6, 400, 3), (1000, 1 << 20, 5)])
def test_phrases(spark, texts, least, nodes, longest):
    got = phrases.collocations(frame(spark, texts), min_count=least, max_nodes=nodes, longest=longest)
    assert got.columns == list(COLS)
    assert sorted(map(tuple, got.collect())) == brute(texts, least, longest)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op13_collocations"](spark, sf).select(*COLS).collect())) == brute(rows, 100)


def test_query_matches_its_sql(spark):
    from cartwheel.llm.queries import ORACLE_SQL
    from oracle.compare import compare

    r = compare(spark, "op13", QUERIES["op13_collocations"], ORACLE_SQL["op13_collocations"], "/root/testdata/sf0.01")
    assert not r.get("error") and r["spark_rows"] == r["oracle_rows"] > 0 and r["mismatches"] == 0, r


def test_empty_tables(spark, texts):
    assert phrases.collocations(frame(spark, texts).where(F.lit(False))).count() == 0
    assert phrases.collocations(frame(spark, texts[:3])).count() == 0


@pytest.mark.parametrize("k", [2, 3, 5])
def test_trie(k):
    rng = np.random.default_rng(k)
    p = np.unique(rng.zipf(1.3, (20_000, k)) % 6000 * 3 + 7, axis=0)
    trie = phrases.Trie(p)
    words = rng.choice(np.append(trie.words, [1, 2]), 5000)
    words[::7][: len(p)] = p[: len(words[::7]), 0]
    for i in range(0, 4000, 50):
        words[i : i + k] = p[rng.integers(len(p))]
    place = np.searchsorted(trie.words, words)
    place = np.where(trie.words[np.minimum(place, len(trie.words) - 1)] == words, place, -1)
    known = {tuple(x): i for i, x in enumerate(p.tolist())}
    assert trie.rows(place).tolist() == [known.get(tuple(words[i : i + k].tolist()), -1) for i in range(len(words))]
    assert (trie.rows(place) >= 0).sum() >= 80
