import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from helpers import frame, span
from spanweave.functions.days import DAY_MICROS, day_start_micros, parse_day
from spanweave.schema import SPAN_SCHEMA
from spanweave.sources.decode import rejected_docs
from spanweave.sources.names import NameRule
from spanweave.sources.spans import (
    first_with_rows,
    read_docs,
    read_json_docs,
    read_span_table,
)

DAY = dt.date(2024, 1, 15)

DOC = {
    "traceID": "abc",
    "spanID": "10",
    "startTime": 5,
    "startTimeMillis": 0,
    "process": {"serviceName": "web", "tags": []},
    "operationName": "unknown to the model",
    "tags": [
        {"key": "z", "type": "STRING", "value": "s"},
        {"key": "n", "type": "int64", "value": 3},
        {"key": "a", "type": "string"},
        {"key": "b", "type": "bool", "value": True},
    ],
    "tag": {"m": 1, "o": {"p": [1]}, "q": None, "a@b": True},
    "references": [{"refType": "CHILD_OF", "traceID": "other", "spanID": "2"}, {"spanID": "1"}],
    "parentSpanID": "2",
}


def docs(spark, tmp_path, *objects):
    (tmp_path / "docs.json").write_text("\n".join(json.dumps(o) for o in objects) + "\n")
    return str(tmp_path)


def without(*fields, **changes):
    return {k: v for k, v in DOC.items() if k not in fields} | changes


def read(spark, path, **options):
    return read_json_docs(spark, path, range_millis=None, **options)


def test_decode_one_document(spark, tmp_path):
    row = read(spark, docs(spark, tmp_path, DOC)).first()
    assert (row.trace_id, row.span_id, row.start_time, row.service) == ("abc".rjust(32, "0"), 16, 5, "web")
    assert row.refs == [1, 2, 2]
    assert [tuple(t) for t in row.tags] == [
        ("a", "string", None),
        ("a@b", None, "true"),
        ("b", "bool", None),
        ("m", None, "1"),
        ("n", "int64", None),
        ("o", None, json.dumps({"p": [1]})),
        ("q", None, None),
        ("z", "STRING", "s"),
    ]


def test_quoted_start_time_and_absent_parts(spark, tmp_path):
    path = docs(spark, tmp_path, without("tags", "references", "tag", "parentSpanID", "process", startTime="7"))
    row = read(spark, path).first()
    assert (row.start_time, row.service, row.tags, row.refs) == (7, None, [], [])
    with pytest.raises(Exception, match="missing tags"):
        read(spark, path, mode="strict").collect()


@pytest.mark.parametrize(
    "bad, reason",
    [
        (without("spanID"), "missing traceID or spanID"),
        (without("traceID"), "missing traceID or spanID"),
        (without(spanID="xyz"), "spanID is no hex number"),
        (without(startTime="soon"), "startTime is no number"),
        (without(parentSpanID=""), "reference is no hex number"),
        (without(references=[{"spanID": "-"}]), "reference is no hex number"),
    ],
)
def test_flawed_documents(spark, tmp_path, bad, reason):
    path = docs(spark, tmp_path, DOC, bad)
    with pytest.raises(Exception, match=reason):
        read(spark, path).collect()
    assert read(spark, path, mode="permissive").count() == 1
    assert [r.flaw for r in rejected_docs(read_docs(spark, path, "permissive")).collect()] == [reason]


def test_unknown_mode(spark, tmp_path):
    with pytest.raises(ValueError):
        read(spark, docs(spark, tmp_path, DOC), mode="other")


def test_range_counts_from_now(spark, tmp_path):
    path = docs(spark, tmp_path, *[without(startTimeMillis=t) for t in (899, 900, 1000)])
    assert read_json_docs(spark, path, now_millis=1000, range_millis=100).count() == 2
    assert read_json_docs(spark, path).count() == 0
    assert read_json_docs(spark, path, range_millis=None).count() == 3


def test_day_bounds(spark, tmp_path):
    low = day_start_micros(DAY)
    high = low + DAY_MICROS - 1
    starts = [low - 1, low, low + 1, high - 1, high, high + 1]
    path = str(tmp_path / "t")
    frame(spark, [span(1, "a", start=s) for s in starts], legacy=True).write.parquet(path)
    open_ends = read_span_table(spark, path, DAY)
    assert sorted(r.start_time for r in open_ends.collect()) == [low + 1, high - 1]
    closed = read_span_table(spark, path, DAY, closed=True)
    assert sorted(r.start_time for r in closed.collect()) == [low, low + 1, high - 1, high]
    plan = open_ends._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThan(start_time,{low})" in plan and f"LessThan(start_time,{high})" in plan


def test_day_folders_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    start = day_start_micros(DAY) + 1
    days = frame(spark, [span(1, "a", start=start), span(2, "b", start=start + DAY_MICROS)])
    days.withColumn("dt", F.to_date(F.timestamp_micros("start_time"))).write.partitionBy("dt").parquet(path)
    for window in (None, (0, 0), (1, 1)):
        day = read_span_table(spark, path, DAY, legacy_parent=False, dt_window=window)
        assert [r.service for r in day.collect()] == ["a"]
    one = read_span_table(spark, path, DAY, dt_window=(0, 0))
    assert {f.split("/")[-2] for f in one.inputFiles()} == {"dt=2024-01-15"}
    assert read_span_table(spark, path, DAY - dt.timedelta(9), dt_window=(1, 1)).count() == 0


def test_late_spans_are_found(spark, tmp_path):
    path = str(tmp_path / "t")
    days = frame(spark, [span(1, "a", start=day_start_micros(DAY) + 1)])
    days.withColumn("dt", F.lit("2024-01-16")).write.partitionBy("dt").parquet(path)
    assert read_span_table(spark, path, DAY).count() == 1
    assert read_span_table(spark, path, DAY, dt_window=(0, 1)).count() == 1
    assert read_span_table(spark, path, DAY, dt_window=(0, 0)).count() == 0


def test_nested_rows(spark, tmp_path):
    rows = spark.sql(
        "select X'0AFF' trace_id, 2L span_id, 3L start_time, named_struct('service_name', 'web', 'tags', 0) process,"
        " array(named_struct('key', 'k', 'value_type', 'string', 'value_string', 'v', 'value_long', 0L)) tags,"
        " array(named_struct('ref_type', 'x', 'trace_id', X'00', 'span_id', 1L)) refs"
    )
    rows.write.parquet(str(tmp_path / "t"))
    row = read_span_table(spark, str(tmp_path / "t")).first()
    assert (row.trace_id, row.span_id, row.service, row.refs, row.parent_id) == ("0aff", 2, "web", [1], None)
    assert [tuple(t) for t in row.tags] == [("k", "string", "v")]


def test_incomplete_tables_raise(spark, tmp_path):
    full = frame(spark, [span(1, "a")])
    for column in ("service", "tags", "span_id"):
        full.drop(column).write.parquet(str(tmp_path / column))
        with pytest.raises(ValueError, match=column):
            read_span_table(spark, str(tmp_path / column))
    full.withColumn("span_id", F.lit(None).cast("bigint")).write.parquet(str(tmp_path / "null"))
    with pytest.raises(Exception, match="a span has no span_id"):
        read_span_table(spark, str(tmp_path / "null")).collect()


def test_rejects_come_with_their_text(spark, tmp_path):
    lines = ['{"broken', '{"traceID":"1","spanID":"1","tags":"x"}', '{"traceID":"1"}', '{"traceID":"1","spanID":"1"}']
    (tmp_path / "docs.json").write_text("\n".join(lines) + "\n")
    raw = read_docs(spark, str(tmp_path), "permissive")
    assert sorted(r.text for r in rejected_docs(raw).collect()) == sorted(lines[:3])
    assert read(spark, str(tmp_path), mode="permissive").count() == 1
    with pytest.raises(Exception):
        read(spark, str(tmp_path)).collect()


def test_nested_values_are_no_text(spark, tmp_path):
    values = [{"a": 1}, [1], None, 3, True, "s"]
    path = docs(spark, tmp_path, without("tag", tags=[{"key": str(i), "type": "string", "value": v} for i, v in enumerate(values)]))
    assert [t.value for t in read(spark, path).first().tags] == [None, None, None, "3", "true", "s"]


def test_missing_source_is_empty(spark, tmp_path):
    absent = str(tmp_path / "absent")
    assert read_json_docs(spark, absent).collect() == []
    assert read_span_table(spark, absent, DAY).columns[:6] == SPAN_SCHEMA.fieldNames()
    assert read_span_table(spark, absent, DAY).collect() == []


def test_default_day_is_utc_today():
    assert parse_day(None) == dt.datetime.now(dt.timezone.utc).date()
    assert parse_day("2024-01-15") == DAY


@pytest.mark.parametrize(
    "rule, names",
    [
        (NameRule(), [("span-2024-01-15", "dependencies-2024-01-15")]),
        (
            NameRule(prefix="p", separator="'", span_base="s", dependency_base="d"),
            [("p-s-2024'01'15", "p-d-2024'01'15"), ("p:s-2024'01'15", "p:d-2024'01'15")],
        ),
        (NameRule(separator="", type_suffix=True), [("span-20240115", "dependencies-20240115/dependencies")]),
        (NameRule(aliases=True), [("span-read", "dependencies-write")]),
        (
            NameRule(aliases=True, prefix="p"),
            [("p-span-read", "p-dependencies-write"), ("p:span-read", "p:dependencies-write")],
        ),
    ],
)
def test_names(spark, rule, names):
    assert rule.candidates(DAY) == names
    row = spark.range(1).select(rule.candidate_columns(F.lit(DAY)).alias("c")).first()
    assert [tuple(c) for c in row.c] == names


def test_fallback_stops_at_the_first_result(spark):
    seen = []

    def results():
        for name, n in (("a", 0), ("b", 1), ("c", 1)):
            seen.append(name)
            yield name, spark.range(n)

    name, rows = first_with_rows(results())
    assert (name, rows.count(), seen) == ("b", 1, ["a", "b"])
