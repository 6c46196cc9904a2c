"""Katz scores against token-by-token brute force."""

import pytest
from brute import op3

from cartwheel.llm import katz
from cartwheel.llm.common import written
from cartwheel.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def same(df, rows):
    key = lambda r: (str(r[0]), r[2], round(r[5], 4))
    got = sorted((tuple(r) for r in df.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=key)
    want = sorted(op3(rows), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want, strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("bucket_bytes, every", [(16 << 20, 64), (20_000, 1)])  # with and without spread words
def test_katz(docs_of, small, bucket_bytes, every):
    same(katz.score(docs_of(small), bucket_bytes=bucket_bytes, layout_every=every), small)


def test_katz_without_training(docs_of):
    rows = [(None, "a b"), (None, None)]
    same(katz.score(docs_of(rows)), rows)
    assert katz.score(docs_of(rows).limit(0)).count() == 0


def test_katz_on_the_test_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    same(QUERIES["op3_katz"](spark, SF), rows)


def test_a_task_holds_one_bucket(docs_of, small, monkeypatch):
    """Several buckets' pairs and tables in one task make its memory grow with chance."""
    from pyspark.sql import functions as F

    plans = []
    monkeypatch.setattr(katz, "written", lambda df, by=None: (plans.append(df) if by else None, written(df, by))[1])
    size = sum(len((t or "").encode()) for _, t in small)
    katz.score(docs_of(small), bucket_bytes=size // 40, layout_every=1)
    tasks = plans[0].where(F.col("kind") == katz.STATS).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 30 and all(r["count"] == 1 for r in tasks)
