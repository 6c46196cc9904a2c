"""Replays, ties, clashing names and hostile texts."""

import random
import time
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cartwheel.llm import mixing, personal, quality


def sample(n=200):
    r = random.Random(11)
    rows = [(i, " ".join("w" * r.randrange(1, 5) for _ in range(r.randrange(0, 200))), r.choice(["a", "b", None])) for i in range(n)]
    return rows + [(7, "same size", "a"), (7, "size same", "a"), (7, "other one", "a"), (None, "no id", "b"), (None, "id no", "b")]


def test_mix_replayed(docs_of):
    """Blocks, permutations and taken words, slot by slot."""
    docs = mixing.with_size(docs_of(sample()).drop("size"), "text", "size").withColumns({"target": F.lit("x"), "taken": F.lit(1)})
    m = mixing.mix(docs, block_words=16, shards=5, buckets=7, seed=3)
    got = mixing.taken_words(m).collect()
    by = {}
    for x in got:
        by.setdefault(x["_mix_source"], []).append(x)
    for rows in by.values():  # documents tile their source's stream
        rows.sort(key=lambda x: (x["_mix_at"], x["size"]))
        at = 0
        for x in rows:
            assert x["_mix_at"] == at
            at += x["size"]
    sizes = [sum(x["size"] for x in by[s]) for s in sorted(by)]
    goal = mixing.targets(sizes, (5, 2, 1), 1.5, 2)
    blocks = [-(-n // 16) for n in sizes]
    quota = [min(2 * b, round(b * t / n)) for b, t, n in zip(blocks, goal, sizes, strict=True)]
    words, per_shard = Counter(), Counter()
    drawn = mixing.draws(quota, 5, 3)
    for s, i, first, n in drawn:
        per_shard[s] += n
        for j in range(first, first + n):
            key = 3 * 1_000_003 + i * 101 + j // blocks[i]
            block = int(mixing.permuted(np.array([j % blocks[i]]), blocks[i], key)[0])
            for x in by[i]:
                words[i, x["_mix_at"], x["size"] > 0] += max(0, min(x["_mix_at"] + x["size"], 16 * block + 16) - max(x["_mix_at"], 16 * block))
    assert sum(per_shard.values()) == sum(quota) and max(per_shard.values()) - min(per_shard.values()) <= 1
    for i, q in enumerate(quota):
        assert sum(n for _, s, _, n in drawn if s == i) == q
    for x in got:
        assert x["taken"] == words[x["_mix_source"], x["_mix_at"], x["size"] > 0] * (x["size"] > 0)


def test_mixed_texts_do_not_depend_on_partitions(docs_of):
    docs = docs_of(sample()).withColumn("target", F.lit("own"))
    read = lambda d: sorted(map(tuple, mixing.mixed_documents(d, block_words=4).collect()), key=str)
    assert read(docs.repartition(1)) == read(docs.repartition(7, "text"))
    assert mixing.mixed_documents(docs.where("doc_id < 0")).count() == 0


def test_mixing_joins_without_broadcast(docs_of):
    docs = mixing.with_size(docs_of(sample()).drop("size"), "text", "size")
    m = mixing.mix(docs)
    plan = m.pieces._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [source_no" in plan and "BroadcastHashJoin" not in plan
    more = mixing.mix(docs, shards=300, buckets=5)
    assert more.pieces.select("shard").distinct().count() > 200


def test_hostile_numbers(docs_of):
    rows = [(1, "0" * 5000 + ".1.1.1"), (2, "9" * 5000 + ".1.1.1"), (3, "(" * 1_000_000), (4, "0.0.0.256 000.1.01.0255 1.2.3.4"), (5, "(1" * 300_000), (6, "1 ( " * 250_000)]
    start = time.time()
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["base"]] for r in personal.find_personal_data(docs_of(rows)).collect()}
    assert time.time() - start < 60
    assert got[1] == [("ip", 0, 5006)] and got[2] == [] and got[3] == []
    assert got[4] == [("ip", 10, 23), ("ip", 24, 31)]


def test_number_runs_are_the_plain_matches():
    import re

    r, plain = random.Random(4), re.compile(r"[0-9(][0-9()./\x20-]{5,}[0-9]")
    for _ in range(3000):
        text = "".join(r.choice("0123456789012345() ./-x") for _ in range(r.randrange(40)))
        want = [m.span() for m in plain.finditer(text) if sum(c.isdigit() for c in m.group()) >= 9]
        assert list(personal._number_runs(text)) == want, text


def test_rules_do_not_depend_on_partitions(spark):
    r = random.Random(6)
    rows = []
    for i in range(2000):
        good = i % 50 % 2
        words = ["word" if good or r.random() < 0.5 else "#$%" for _ in range(r.randrange(25, 60))]
        rows.append((i % 50, " ".join(words) + f" {i}"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fits = [quality.fit(docs.repartition(n), labels, sample_rows=60) for n in (1, 3, 8)]
    assert fits[0] == fits[1] == fits[2]


def test_quality_keeps_clashing_columns(docs_of, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    docs = docs_of([(1, "word " * 30), (2, "few"), (3, "term " * 30 + "end")]).withColumns({"_quality_rule": F.lit(9), "_quality_words": F.lit("mine")})
    varied = docs.withColumn("text", F.when(F.col("doc_id") == 2, F.col("text")).otherwise(F.expr("array_join(transform(sequence(1, 40), i -> concat('w', i * doc_id)), ' ')")))
    kept = quality.kept_documents(varied, labels)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["_quality_rule"], r["_quality_words"]) for r in kept.collect()) == [(1, 9, "mine"), (3, 9, "mine")]
    assert quality.judged(varied, labels).where("_quality_kept").count() == 2
