"""Decontamination gives one result whichever way the fingerprints meet."""

import random

import pytest
from brute import op9
from test_documents import tuples

from cartwheel.llm import winnow
from cartwheel.llm.queries import contamination_digest

COLS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.fixture
def sort_merge(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def both_paths(docs, bench, rows, items):
    for limit in (1_000_000, 0):
        found = winnow.find_contamination(docs, bench, max_broadcast_words=limit)
        assert tuples(contamination_digest(found), *COLS) == op9(rows, items)
        left = winnow.drop_contaminated(docs, bench, max_broadcast_words=limit)
        assert left.count() == sum(not r[2] for r in op9(rows, items))


def say(r, n):
    return [f"w{r.randrange(5000)}" for _ in range(n)]


def test_hits_in_any_order():
    """A changed middle (the later run must not hide the earlier) and a shared 5-gram before a run of 10."""
    r = random.Random(1)
    item = [w.encode() for w in say(r, 60)]
    doc = item[:25] + [b"x"] + item[26:]
    matches = [(i, item, "7", i) for i in (*range(21), *range(26, 56))]
    for _ in range(20):
        r.shuffle(matches)
        assert winnow.hits(doc, matches, 10) == ([[0, 25], [26, 60]], ["7"])
    doc = item[:12] + [b"x"] + item[13:18] + [b"x"] + item[19:]
    matches = [(i, item, "7", i) for i in (13, 0, 3, 19, 40)]
    assert winnow.hits(doc, matches, 10) == ([[0, 12], [19, 60]], ["7"])


def test_edited_middles(docs_of, spark, sort_merge):
    r = random.Random(2)
    texts = [say(r, 80) for _ in range(30)]
    items = [(i, " ".join(w)) for i, w in enumerate(texts)]
    rows = []
    for i, w in enumerate(texts):
        for cuts in ([40], [30, 36], [12, 20, 50], [5, 11, 33, 60]):
            rows.append((10 * len(rows), " ".join([*say(r, 7), *(f"x{k}" if k in cuts else x for k, x in enumerate(w)), *say(r, i % 5)])))
    both_paths(docs_of(rows), spark.createDataFrame(items, "item_id long, text string"), rows, items)


def test_equal_texts_under_other_ids(docs_of, spark):
    """Also under a null id, in any order, as a short item, and with equal words in another case."""
    r = random.Random(4)
    a, b, c = (" ".join(say(r, n)) for n in (40, 25, 4))
    items = [(None, a), (3, a), (1, a), (3, a), (2, a.upper()), (5, b), (None, b), (8, c), (None, c), (9, c), (None, c.upper()), (11, None), (12, "")]
    rows = [(0, a), (10, f"x {b} y {c}"), (20, " ".join(a.split()[:15])), (30, c.upper()), (40, "nothing here"), (50, None), (60, a + " " + b + " " + a)]
    for k in range(3):
        mixed = r.sample(items, len(items))
        both_paths(docs_of(rows), spark.createDataFrame(mixed, "item_id long, text string").coalesce(1), rows, items)
