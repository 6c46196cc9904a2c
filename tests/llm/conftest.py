import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, source]) with a column that clashes with internal names."""

    def make(rows):
        full = [(i, t, "en", s[0] if s else "src0", len(t or ""), "x") for i, t, *s in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, size string")

    return make


@pytest.fixture(scope="session")
def small():
    """Nulls, empty and very long texts, ties, repeated rows, copies, near copies."""
    import random

    r = random.Random(3)
    vocab = [r.choice("bcdfglmnprst") + r.choice("aeiou") + r.choice(["n", "r", "st", "é", ""]) for _ in range(60)]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    shared = say(40)
    rows = [(None, say(50)), (None, None), (0, None), (1, ""), (2, " \n\t "), (3, "One"), (4, "one two"), (5, say(30000))]
    rows += [(10 + i, f"{say(30)}\n{shared} {say(i)}") for i in range(12)]
    rows += [(40 + i, shared.upper()) for i in range(6)] + [(40, shared.upper())] * 2
    rows += [(60 + i, " ".join(["again"] * (i + 5)) + "  x y\n\nx") for i in range(12)]
    base = say(400).split()
    for i in range(15):
        w = list(base)
        w[r.randrange(400)] = r.choice(vocab)
        rows.append((100 + i, " ".join(w)))
    return rows
