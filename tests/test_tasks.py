"""Shares of tasks follow the tables' counts."""

from __future__ import annotations

import pytest

from __spark_entry__ import queries
from rivulet.sources import views as V


@pytest.mark.parametrize("name", ["collinear_rules", "coverage_window", "rule_runs", "frame_detect", "fingerprint_cells", "drawing_pages"])
def test_pages_are_dealt_by_count(spark, sf_dir, monkeypatch, name):
    plain = sorted(map(str, queries()[name](spark, sf_dir).collect()))
    rows = V.table(spark, sf_dir, "lineitem").count()
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(V, "ROWS", rows // (few + 3), raising=False)
    out = queries()[name](spark, sf_dir)
    tasks = -(-rows // (rows // (few + 3)))
    assert f"hashpartitioning(page_id#" in (plan := out._jdf.queryExecution().toString()) and f", {tasks}), REPARTITION_BY_NUM" in plan
    assert sorted(map(str, out.collect())) == plain


def test_removal_proof_sends_hashes_as_bytes(spark, sf_dir):
    plan = queries()["removal_proof"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex(sha2(" in plan


def test_layout_search_deals_pages_by_count(spark, sf_dir, monkeypatch):
    from rivulet.operators import arrangement

    plain = sorted(map(str, queries()["layout_search"](spark, sf_dir).collect()))
    monkeypatch.setattr(arrangement, "PAGES", 4, raising=False)
    out = queries()["layout_search"](spark, sf_dir)
    tasks = -(-V.view_sheets(spark, sf_dir)["sheets"].count() // 4)
    assert tasks > 4
    assert f", {tasks}), REPARTITION_BY_NUM" in out._jdf.queryExecution().toString()
    assert out.rdd.getNumPartitions() == tasks  # small as they are, pages are not joined to fewer tasks
    assert sorted(map(str, out.collect())) == plain
