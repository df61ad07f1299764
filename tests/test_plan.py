"""The shape of the physical plan, which is what makes it hold at scale."""

import re

from helpers import frame, kind, span
from spanweave.operators.derive import derive
from spanweave.operators.groups import leaf_spans
from spanweave.operators.spans import narrow_spans


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def stored(spark, path, legacy=False):
    spans = [span(1, "web", kind("client")), span(2, "api", ("peer.service", "db"), refs=[1])]
    frame(spark, spans, legacy).write.parquet(path)
    return spark.read.parquet(path)


def test_spans_are_read_once(spark, tmp_path):
    for legacy in (False, True):
        plan = final_plan(derive(stored(spark, str(tmp_path / f"spans{legacy}"), legacy)))
        assert plan.count("FileScan") == 1
        assert "ReusedExchange" in plan


def test_spans_are_read_once_for_leaves(spark, tmp_path):
    plan = final_plan(leaf_spans(narrow_spans(stored(spark, str(tmp_path / "spans")))))
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_no_python_no_lists_no_cross_joins(spark, tmp_path):
    plan = final_plan(derive(stored(spark, str(tmp_path / "spans"))))
    for operator in ("Python", "Arrow", "collect_list", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_tags_stay_in_the_scan_stage(spark, tmp_path):
    df = derive(stored(spark, str(tmp_path / "spans")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert keys and not any("tags" in k for k in keys)
    assert any("digest" in k for k in keys)
