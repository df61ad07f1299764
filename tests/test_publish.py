"""What a run reports, how a day is published, and spans that arrive late."""

import pytest
from pyspark.sql import functions as F

from checks.queries import to_docs
from helpers import frame, kind, span
from spanweave import DayJob, ScanOptions
from spanweave.__main__ import summary
from spanweave.functions.days import day_start_micros, parse_day
from spanweave.operators.derive import derive
from spanweave.operators.increment import apply_changes, edge_changes, touched
from spanweave.operators.results import difference
from spanweave.plans import day as day_plan
from spanweave.plans.day import RunReport, run_and_report
from spanweave.plans.publish import publish_day, published_edges, published_folder
from spanweave.sources.names import NameRule
from spanweave.sources.spans import read_docs, read_json_docs, read_span_table
from test_links_random import random_spans

DAY = "2024-01-15"
START = day_start_micros(parse_day(DAY)) + 5


def pair(child="api", traces=1):
    spans = [span(1, "web", kind("client"), start=START, trace=f"t{i}") for i in range(traces)]
    return spans + [span(2, child, refs=[1], start=START + 1, trace=f"t{i}") for i in range(traces)]


def stored(spark, path, spans):
    frame(spark, spans).write.mode("overwrite").parquet(path)
    return path


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_run_counts_what_it_saw(spark, tmp_path):
    path = stored(spark, str(tmp_path / "in"), pair(traces=3) + pair()[:1])
    edges, report = run_and_report(spark, DayJob("span_table", path, str(tmp_path / "out"), DAY))
    assert rows(edges) == [("web", "api", 3)]
    assert report == RunReport(None, 7, 0, 1, 3) and report.rejects is None
    assert summary(report) == "1 links stored, 3 calls; 7 spans read, 0 without an id"


@pytest.mark.parametrize("lines, expected", [(4, RunReport(6, 4, 0, 1, 2)), (0, RunReport(2, 0, 0, 0, 0))])
def test_a_search_run_counts_its_rejects(spark, tmp_path, lines, expected):
    docs = to_docs(frame(spark, pair(traces=lines // 2))) if lines else spark.createDataFrame([], "value string")
    docs.unionAll(spark.createDataFrame([("{broken",), ('{"traceID":"1"}',)], "value string")).write.text(str(tmp_path / f"in/span-{DAY}"))
    scan = ScanOptions(range_millis=None, mode="permissive")
    _, report = run_and_report(spark, DayJob("json_docs", str(tmp_path / "in"), str(tmp_path / "out"), DAY, scan=scan))
    assert report == expected and report.rejects == 2


def test_nothing_read_counts_nothing(spark, tmp_path):
    for source in ("json_docs", "span_table"):
        edges, report = run_and_report(spark, DayJob(source, str(tmp_path / "none"), str(tmp_path / source), DAY))
        assert (edges.count(), report.spans, report.edges, report.calls) == (0, 0, 0, 0)


def test_a_day_is_published_whole(spark, tmp_path, monkeypatch):
    out = f"file://{tmp_path}/out"
    assert published_folder(spark, out, DAY) is None and rows(published_edges(spark, out, DAY)) == []
    old = stored(spark, str(tmp_path / "old"), pair("old"))
    new = stored(spark, str(tmp_path / "new"), pair("new", traces=2))
    publish_day(spark, DayJob("span_table", old, out, DAY, layout="v2"))
    first = published_folder(spark, out, DAY)

    def fails(*args):
        raise OSError("no space")

    for step in ("write_rows", "day_rows", "derive"):
        with monkeypatch.context() as patch:
            patch.setattr(day_plan, step, fails)
            with pytest.raises(OSError):
                publish_day(spark, DayJob("span_table", new, out, DAY))
        assert published_folder(spark, out, DAY) == first
        assert rows(published_edges(spark, out, DAY)) == [("web", "old", 1)]
    edges, report = publish_day(spark, DayJob("span_table", new, out, DAY))
    assert rows(edges) == rows(published_edges(spark, out, DAY)) == [("web", "new", 2)] and report.calls == 2
    # The layout of the day's last run is kept, and the old run can still be read by those who follow it.
    assert spark.read.parquet(f"{published_folder(spark, out, DAY)}/dependencies_v2").count() == 1
    assert spark.read.parquet(f"{first}/dependencies_v2").count() == 1
    assert published_folder(spark, out, "2024-01-16") is None


def test_documents_are_there_until_the_new_ones_are(spark, tmp_path, monkeypatch):
    job = DayJob("json_docs", str(tmp_path / "in"), str(tmp_path / "out"), DAY, scan=ScanOptions(names=NameRule(prefix="p", prefix_marks=("-", "_")), range_millis=None))
    to_docs(frame(spark, pair("old"))).write.text(str(tmp_path / f"in/p_span-{DAY}"))
    run_and_report(spark, job)
    to_docs(frame(spark, pair("new"))).write.text(str(tmp_path / f"in/p-span-{DAY}"))
    cleared = []
    monkeypatch.setattr(day_plan, "clear_documents", lambda _, path, day: cleared.append(path))
    run_and_report(spark, job)
    assert [path.rpartition("/")[2] for path in cleared] == [f"p_dependencies-{DAY}"]


# Late spans


@pytest.mark.parametrize("seed", [1, 2])
def test_late_spans_change_edges_as_a_full_run_would(spark, seed):
    spans = frame(spark, random_spans(seed, 400))
    late = F.expr("endswith(trace_id, '7') and span_id > 2 or endswith(trace_id, '51')")
    before, after = spans.filter(~late), spans.filter(late)
    changes = edge_changes(before, after.unionAll(before.limit(5)))
    assert difference(apply_changes(derive(before), changes), derive(spans)).isEmpty()
    assert seed == 1 or changes.filter("call_count < 0").count() > 0


def test_only_touched_traces_are_derived_again(spark):
    spans = spark.range(20_000).selectExpr(
        "cast(id div 2 as string) as trace_id", "id as span_id", "id as start_time", "'s' as service",
        "cast(array() as array<struct<key:string,vtype:string,value:string>>) as tags", "array(id - 1) as refs",
    )
    late = spans.filter("trace_id in ('5', '77')").withColumn("span_id", F.col("span_id") + 1_000_000)
    assert touched(spans, late).count() == 4
    assert edge_changes(spans, late.filter("false")).count() == 0


# Sources that cannot be read


@pytest.mark.parametrize("path", ["", "a:b", "mem:x", "file:x y%zz", "file://host/x"])
def test_a_wrong_path_is_no_empty_source(spark, path):
    for read in (read_span_table, read_docs):
        with pytest.raises(Exception):
            read(spark, path).count()


def test_names_with_colons_read_as_empty_where_they_cannot_be(spark, tmp_path):
    assert read_json_docs(spark, f"{tmp_path}/old:span-{DAY}", range_millis=None).count() == 0
    assert read_span_table(spark, f"file://{tmp_path}/none").count() == 0


def test_a_window_of_folders_needs_folders(spark, tmp_path):
    path = stored(spark, str(tmp_path / "flat"), pair())
    with pytest.raises(ValueError, match="dt= folders"):
        read_span_table(spark, path, parse_day(DAY), dt_window=(0, 1))
    assert read_span_table(spark, str(tmp_path / "none"), parse_day(DAY), dt_window=(0, 1)).count() == 0
    dated = spark.read.parquet(path).withColumn("dt", F.lit("2023-01-01"))
    dated.write.partitionBy("dt").parquet(str(tmp_path / "dated"))
    assert read_span_table(spark, str(tmp_path / "dated"), parse_day(DAY), dt_window=(0, 1)).count() == 0
