"""De-duplication of stored tables by a narrow count of the keys first, and the pipeline that uses it."""

import os

import pytest
from helpers import SF001, bronze_rows

from cartwheel.operators import cleaning
from cartwheel.operators.cleaning import clean_transactions
from cartwheel.plans import catalog, pipeline
from cartwheel.sources.tables import read_table


@pytest.mark.parametrize("most", [100_000, 1])
def test_measured_copies_give_the_window_survivors(spark, monkeypatch, most):
    monkeypatch.setattr(cleaning, "RARE_KEYS", most)
    copies = [{"order_id": k, "quantity": q, "unit_price": p} for k in ("O1", "O2", None) for q in (2, 3) for p in (7.0, 5.0)]
    b = bronze_rows(spark, [{} for _ in range(20)] + copies + [{"order_id": "BAD", "quantity": 0}])
    got = clean_transactions(b, as_of="2024-03-01", rare_copies=None)
    want = clean_transactions(b, as_of="2024-03-01")
    assert got.count() == want.count() == 23 and got.exceptAll(want).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (most > 1)  # few repeated keys: other rows are not shuffled


def test_pipeline_writes_bronze_once(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(pipeline, "layer_root", lambda _: tmp_root)
    at = pipeline.stored_pipeline(spark, SF001, catalog.AS_OF, catalog.STAR_RULES)
    assert not [d for d in os.listdir(tmp_root) if d.startswith("bronze")]
    audit = [r.table_name for r in read_table(spark, at["write_audit"]).collect()]
    assert sorted(audit) == sorted(set(pipeline.PIPELINE_TABLES) - {"write_audit"})
