"""The registered acceptance suite tests the stored tables."""

import shutil

from helpers import SF001

from cartwheel.plans import catalog, pipeline
from cartwheel.plans.validate import REQUIRED_TABLES
from cartwheel.sources.tables import read_table, table_exists, write_table


def outcomes(spark, sf_dir):
    return {(r.test, r.check_name): r.passed for r in catalog.QUERIES["acceptance_suite"](spark, sf_dir).collect()}


def test_suite_sees_stored_tables(spark, tmp_root, monkeypatch):
    d = f"{tmp_root}/sf"
    shutil.copytree(SF001, d)
    before = outcomes(spark, d)
    assert before == outcomes(spark, SF001) and all(before["table_exists", n] for n in REQUIRED_TABLES)
    at = pipeline.stored_pipeline(spark, d, catalog.AS_OF, catalog.STAR_RULES)
    assert all(table_exists(spark, x) for x in at.values())
    # a stored gold table that is emptied, and one that is not there
    schema = read_table(spark, at["product_performance"]).schema
    write_table(spark.createDataFrame([], schema), at["product_performance"])
    gone = at | {"category_trends": f"{tmp_root}/nowhere"}
    monkeypatch.setattr(catalog, "stored_pipeline", lambda *_: gone)
    after = outcomes(spark, d)
    assert {k for k in before if before[k] != after[k]} == {("gold_non_empty", "product_performance"), ("table_exists", "category_trends")}
