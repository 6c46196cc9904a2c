"""Quality rules as a learned decision list, in DataFrame functions only.

Statistics of each text come from array and string functions; a rule list is learned on a bounded
sample of labelled rows by sequential covering: a rule is grown on two thirds of the sample, one
threshold condition at a time by FOIL gain, pruned from its end on the other third, and accepted if
the rows it rejects are bad often enough; its rows are set aside and the next rule is grown.  The
list becomes one ordered CASE expression over the statistics.

Words are ``[^\\x20\\x09-\\x0D]+``.  Defined cases: null and empty texts have no words and fail the
base rule; null labels and labels of unknown ids are not used; without labels, or without an
accepted rule, only the base rule rejects; repeated rows are judged alike; an empty table stays empty.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

P = "_quality_"
FEATURES = ("words", "word_length", "symbols", "exclamations", "upper", "distinct", "repeated", "dup_lines")
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"


class Condition(NamedTuple):
    feature: str
    above: bool  # feature > threshold, else feature <= threshold
    threshold: float


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the features, all
    under names that start with ``_quality_``."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    words = F.filter(F.split(t, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    d = docs.withColumns({P + "words": words, P + "lines": lines})
    d = d.withColumns({P + "hash": F.transform(P + "words", lambda w: F.xxhash64(w)), P + "n": F.size(P + "words")})
    # Hashes of 2, 4 and then 8 neighbouring words; a 64-bit hash tells the windows of one text apart.
    n = P + "n"
    for width, name, below in ((1, "pair", "hash"), (2, "four", "pair"), (4, "eight", "four")):
        left = n if width == 1 else f"size({P}{below})"
        expr = f"zip_with(slice({P}{below}, 1, {left} - {width}), slice({P}{below}, {width + 1}, {left} - {width}), (a, b) -> xxhash64(a, b))"
        d = d.withColumn(P + name, F.expr(f"CASE WHEN {n} >= 8 THEN {expr} ELSE array() END" if width == 1 else f"CASE WHEN {n} >= 8 THEN {expr} ELSE array(0L) END"))
    many = f"{n} >= 8 AND size(array_distinct({P}eight)) < size({P}eight)"
    placed = f"array_sort(transform({P}eight, (h, i) -> struct(h, i)))"
    d = d.withColumn(P + "sorted", F.expr(f"CASE WHEN {many} THEN {placed} END"))
    same = f"zip_with({P}sorted, slice({P}sorted, 2, size({P}sorted)), (a, b) -> coalesce(a.h = b.h, false))"
    d = d.withColumn(P + "next", F.expr(same))  # equal to the following window
    again = f"zip_with({P}sorted, zip_with({P}next, concat(array(false), slice({P}next, 1, size({P}next) - 1)), (a, b) -> a OR b), (s, f) -> CASE WHEN f THEN s.i END)"
    d = d.withColumn(P + "at", F.expr(f"array_sort(filter({again}, i -> i IS NOT NULL))"))
    covered = f"aggregate({P}at, struct(0L AS n, -8L AS last), (x, i) -> struct(x.n + least(8L, i - x.last) AS n, CAST(i AS BIGINT) AS last), x -> x.n)"
    long_ = lambda c: c.cast("long")
    d = d.withColumns({
        P + "n_words": long_(F.col(n)),
        P + "word_chars": long_(F.length(F.translate(t, SPACES, ""))),
        P + "n_symbols": long_(_count(t, SYMBOLS)),
        P + "n_dup_lines": long_(F.size(P + "lines") - F.size(F.array_distinct(P + "lines"))),
        P + "n_repeat_words": F.coalesce(F.expr(covered), F.lit(0).cast("long")),
        P + "n_distinct": F.size(F.array_distinct(P + "hash")),
        P + "n_lines": F.size(P + "lines"),
        P + "n_bangs": _count(t, "!"),
        P + "n_upper": _count(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    })
    ratio = lambda a, b: F.col(P + a).cast("double") / F.greatest(F.col(P + b), F.lit(1))
    features = {
        "words": F.col(P + "n_words").cast("double"), "word_length": ratio("word_chars", "n_words"), "symbols": ratio("n_symbols", "n_words"),
        "exclamations": ratio("n_bangs", "n_words"), "upper": ratio("n_upper", "word_chars"), "distinct": ratio("n_distinct", "n_words"),
        "repeated": ratio("n_repeat_words", "n_words"), "dup_lines": ratio("n_dup_lines", "n_lines"),
    }
    base = (F.col(P + "n_words") < 20) | (100 * F.col(P + "n_repeat_words") > 30 * F.col(P + "n_words"))
    drop = [P + c for c in ("words", "lines", "hash", "n", "pair", "four", "eight", "sorted", "next", "at")]
    d = d.withColumn(P + "base_failed", base).withColumns({P + "f_" + k: v for k, v in features.items()})
    return d.drop(*drop, *(P + c for c in ("n_distinct", "n_lines", "n_bangs", "n_upper")))


def _covers(x: dict[str, np.ndarray], rule: list[Condition]) -> np.ndarray:
    on = np.ones(len(next(iter(x.values()))), bool)
    for c in rule:
        on &= (x[c.feature] > c.threshold) == c.above
    return on


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int) -> list[Condition]:
    rule: list[Condition] = []
    on = np.ones(len(bad), bool)
    while len(rule) < most and (on & ~bad).any() and (on & bad).any():
        p, n = int((on & bad).sum()), int((on & ~bad).sum())
        best, gain = None, 0.0
        for f in FEATURES:
            values = np.unique(np.quantile(x[f][on], np.linspace(0, 1, 65), method="lower"))
            for cut in values.tolist():
                for above in (True, False):
                    c = on & ((x[f] > cut) == above)
                    p1, n1 = int((c & bad).sum()), int((c & ~bad).sum())
                    g = p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p / (p + n))) if p1 else 0.0
                    if g > gain + 1e-9:
                        best, gain = Condition(f, above, cut), g
        if best is None:
            break
        rule.append(best)
        on = _covers(x, rule)
    return rule


def learn(rows: list[tuple], min_precision: float, max_rules: int = 16, max_conditions: int = 4) -> list[list[Condition]]:
    """Rules from rows (features in the order of FEATURES, good)."""
    if not rows:
        return []
    rows = sorted(rows)
    x = {f: np.array([r[i] for r in rows], float) for i, f in enumerate(FEATURES)}
    bad = np.array([not r[-1] for r in rows])
    held = np.random.default_rng(5).random(len(rows)) < 1 / 3
    open_, rules = np.ones(len(rows), bool), []
    while len(rules) < max_rules:
        part = lambda m: ({f: v[m] for f, v in x.items()}, bad[m])
        (xg, bg), (xp, bp) = part(open_ & ~held), part(open_ & held)
        if not bg.any() or not len(bp):
            break
        rule = _grow(xg, bg, max_conditions)

        def worth(k: int, rule=rule, xp=xp, bp=bp) -> float:
            on = _covers(xp, rule[:k])
            p, n = int((on & bp).sum()), int((on & ~bp).sum())
            return (p - n) / (p + n) if p + n else -1.0

        if not rule:
            break
        rule = rule[: max(range(len(rule), 0, -1), key=worth)]
        on = _covers(x, rule) & open_
        p, n = int((on & bad).sum()), int((on & ~bad).sum())
        if p < 5 or p / (p + n) < min_precision or worth(len(rule)) < 2 * min_precision - 1:
            break
        rules.append(rule)
        open_ &= ~on
    return rules


def reject_rule(rules: list[list[Condition]]) -> Column:
    """The number of the first rule that rejects a row of ``with_statistics``, else null."""
    out = F.lit(None).cast("int")
    for i in range(len(rules) - 1, -1, -1):
        test = F.lit(True)
        for c in rules[i]:
            col, cut = F.col(f"{P}f_{c.feature}"), F.lit(c.threshold)
            test &= col > cut if c.above else col <= cut
        out = F.when(test, F.lit(i + 1)).otherwise(out)
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
        sample_rows: int = 4000, min_precision: float = 0.97) -> list[list[Condition]]:
    """Learn from at most ``sample_rows`` labelled ids (those of smallest hash) and as many rows of theirs, copies
    of a row once; the sample is the same for any partitioning."""
    known = labels.select(F.col("doc_id").alias("_quality_id"), F.col(label).alias("_quality_label")).where("_quality_id IS NOT NULL AND _quality_label IS NOT NULL")
    known = known.dropDuplicates(["_quality_id"]).orderBy(F.xxhash64("_quality_id"), "_quality_id").limit(sample_rows)
    rows = docs.select(F.col(id_col).alias("_quality_doc"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(known), F.col("_quality_doc") == F.col("_quality_id")).withColumn("_quality_text", F.xxhash64("text"))
    rows = rows.dropDuplicates(["_quality_id", "_quality_text"]).orderBy(F.xxhash64("_quality_id"), "_quality_id", "_quality_text").limit(sample_rows)
    stats = with_statistics(rows)
    found = stats.select(*(P + "f_" + f for f in FEATURES), (F.col("_quality_label") > 0).alias("good"), P + "base_failed").collect()
    return learn([tuple(r)[:-1] for r in found if not r[-1]], min_precision)


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs``, the statistics, ``_quality_rule`` (the rule that rejects, if any) and ``_quality_kept``; own columns
    of ``docs`` whose names start with ``_quality_`` give way (``kept_documents`` keeps them)."""
    docs = docs.drop(*(c for c in docs.columns if c.startswith(P)))
    rules = fit(docs, labels, id_col, text, **options)
    d = with_statistics(docs, text).withColumn(P + "rule", reject_rule(rules))
    return d.withColumn(P + "kept", ~F.col(P + "base_failed") & F.col(P + "rule").isNull())


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that the base rule or the list rejects."""
    spare = {c: f"_doc_{i}" for i, c in enumerate(docs.columns)}
    d = judged(docs.withColumnsRenamed(spare), labels, spare[id_col], spare[text], **options)
    # As a filter the verdict would be pushed below the statistics, which are then computed again at every mention.
    one = F.explode(F.when(F.col(P + "kept"), F.array(F.lit(1))).otherwise(F.array().cast("array<int>")))
    d = d.select(*spare.values(), one.alias(P + "one"))
    return d.select([F.col(v).alias(k) for k, v in spare.items()])
