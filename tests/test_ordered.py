"""The prefix scan over the claims of shared ids, and the filter in front of it."""

from pyspark.sql import functions as F

from helpers import frame, kind, span
from spanweave.operators import ordered
from spanweave.operators.derive import all_links
from test_plan import final_plan

ONE = ("'t' as trace_id", "1L as span_id")


def test_a_million_claims_of_one_id(spark):
    """Calling services known and unknown in turn; the first called service comes late, just after an unknown one."""
    claims = spark.range(1_000_000).selectExpr(
        *ONE,
        "id as start_time",
        "if(id = 900000, 'db', if(id % 2 = 0, concat('s', id), null)) as service",
        "if(id >= 899999 and id % 2 = 0, 's', 'c') as sides",
    )
    ids = spark.range(1).selectExpr(*ONE)
    found = ordered.ordered_shared_links(claims, ids, parts=16)
    # 899999 is an unknown calling service, so 900000 meets none; no calling service is known again.
    assert found.collect() == []
    known = claims.withColumn("service", F.expr("if(start_time = 950001, 'web', service)"))
    found = [tuple(r) for r in ordered.ordered_shared_links(known, ids, parts=16).collect()]
    assert found == [("web", "s950000", 1)]


def test_what_is_known_is_carried_over_empty_stretches(spark):
    claims = spark.range(1000).selectExpr(
        "concat('t', id % 3) as trace_id", "1L as span_id", "id as start_time",
        "concat('s', id) as service", "if(id >= 997, 's', 'c') as sides",
    )
    ids = spark.range(2).selectExpr("concat('t', id) as trace_id", "1L as span_id")
    # The traces 0 and 1 have the called services 999 and 997; 998 belongs to the third one.
    for parts in (1, 3, 100):
        found = sorted(tuple(r) for r in ordered.ordered_shared_links(claims, ids, parts).collect())
        assert found == [("s994", "s997", 1), ("s996", "s999", 1)]


def test_filter_keeps_all_asked_for_and_few_others(spark):
    rows = spark.range(100_000).selectExpr("cast(id % 1000 as string) as trace_id", "id as span_id", "'x' as sides")
    ids = rows.filter("span_id % 100 = 0").select("trace_id", "span_id")
    kept = ordered.may_be_among(rows, ids)
    assert kept.columns == rows.columns
    assert kept.filter("span_id % 100 = 0").count() == 1000 and kept.count() < 1010


def test_a_crowded_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(ordered, "FILTER_WORDS", 1)
    claims = spark.range(5000).selectExpr("'t' as trace_id", "id div 2 as span_id", "id as start_time", "concat('s', id % 2) as service", "if(id % 2 = 0, 'c', 's') as sides")
    ids = spark.range(100).selectExpr("'t' as trace_id", "id as span_id")
    assert ordered.ordered_shared_links(claims, ids).count() == 100


def test_one_scan_and_no_lists_for_shared_links(spark, tmp_path):
    spans = [span(1, "web", kind("client"), start=i) for i in range(3)] + [span(1, "api", kind("server"), start=9)]
    frame(spark, spans).write.parquet(str(tmp_path / "spans"))
    plan = final_plan(all_links(spark.read.parquet(str(tmp_path / "spans")), kinds=("shared",)))
    assert plan.count("FileScan") == 1 and "collect_list" not in plan
    assert "rangepartitioning" in plan and "getbit" in plan
