"""Whole days: from stored spans to stored records."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from checks.queries import to_docs
from helpers import frame, kind, span
from spanweave import DayJob, ScanOptions, run_day
from spanweave.__main__ import parse_args
from spanweave.functions.days import day_start_micros
from spanweave.operators.derive import derive
from spanweave.operators.results import assert_equal, difference, stored_difference, tree_edges
from spanweave.operators.trees import tree_spans, trees
from spanweave.sinks.records import day_documents, day_rows, sink_layout
from spanweave.sources.names import NameRule

DAY = dt.date(2024, 1, 15)
START = day_start_micros(DAY) + 10
CHAIN = [span(1, "web", start=START), span(2, "api", refs=[1], start=START + 1)]
MARKS = ("-", "_")


def edges(df):
    return sorted(tuple(r) for r in df.collect())


def search_job(tmp_path, **options):
    scan = ScanOptions(names=NameRule(prefix="p", prefix_marks=MARKS), range_millis=None)
    return DayJob("JSON_DOCS", str(tmp_path / "in"), str(tmp_path / "out"), DAY, scan=scan, **options)


def stored(tmp_path, name):
    return [json.loads(line) for f in sorted((tmp_path / "out" / name).rglob("*.txt")) for line in f.open()]


def test_search_day_is_idempotent(spark, tmp_path):
    to_docs(frame(spark, CHAIN)).write.text(str(tmp_path / "in/p-span-2024-01-15"))
    for _ in range(2):
        assert edges(run_day(spark, search_job(tmp_path, label="us"))) == [("web", "api", 1)]
    assert stored(tmp_path, "p-dependencies-2024-01-15") == [
        {
            "dependencies": [{"parent": "web", "child": "api", "callCount": 1, "source": "us"}],
            "timestamp": "2024-01-15T00:00:00Z",
            "part": 0,
            "parts": 1,
        }
    ]


def test_search_day_falls_back_on_links_not_spans(spark, tmp_path):
    to_docs(frame(spark, CHAIN[:1])).write.text(str(tmp_path / "in/p-span-2024-01-15"))
    to_docs(frame(spark, CHAIN)).write.text(str(tmp_path / "in/p_span-2024-01-15"))
    assert edges(run_day(spark, search_job(tmp_path))) == [("web", "api", 1)]
    assert len(stored(tmp_path, "p_dependencies-2024-01-15")) == 1
    assert stored(tmp_path, "p-dependencies-2024-01-15") == []


def test_empty_search_day_stores_nothing(spark, tmp_path):
    assert edges(run_day(spark, search_job(tmp_path))) == []
    assert stored(tmp_path, "p-dependencies-2024-01-15") == []


@pytest.mark.parametrize("layout, second", [("v1", "ts_index"), ("v2", "ts_bucket")])
@pytest.mark.parametrize("spans", [CHAIN, []])
def test_wide_row_day(spark, tmp_path, layout, second, spans):
    frame(spark, spans, legacy=True).write.parquet(str(tmp_path / "in"))
    job = DayJob("span_table", str(tmp_path / "in"), str(tmp_path / "out"), "2024-01-15", layout=layout)
    run_day(spark, job)
    row = spark.read.parquet(str(tmp_path / f"out/dependencies_{layout}")).first()
    assert row.ts == row[second] == START // 1000
    assert [(d.parent, d.child, d.callCount) for d in row.dependencies] == (
        [("web", "api", 1)] if spans else []
    )


def test_unknown_source(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported source"):
        run_day(spark, DayJob("other", "in", "out"))


def test_layout_follows_the_stored_table(spark, tmp_path):
    frame(spark, CHAIN, legacy=True).write.parquet(str(tmp_path / "in"))
    job = DayJob("span_table", str(tmp_path / "in"), str(tmp_path / "out"), DAY)
    run_day(spark, job)
    assert not (tmp_path / "out/dependencies_v2").exists()
    assert sink_layout(spark, str(tmp_path / "out/dependencies_v2")) == "v1"
    run_day(spark, DayJob("span_table", str(tmp_path / "in"), str(tmp_path / "out"), DAY, layout="v2"))
    assert sink_layout(spark, str(tmp_path / "out/dependencies_v2")) == "v2"
    run_day(spark, job)
    assert spark.read.parquet(str(tmp_path / "out/dependencies_v2")).count() == 1


def many_edges(spark, n):
    return spark.range(n).selectExpr(
        "date'2024-01-15' dt", "cast(id as string) parent", "'x' child", "id call_count"
    )


@pytest.mark.parametrize("n", [1, 200_000])
@pytest.mark.parametrize("parts", [1, 4])
def test_a_day_has_one_layout_at_every_size(spark, n, parts):
    rows = many_edges(spark, n)
    documents = [json.loads(d.value) for d in day_documents(rows, "us", parts).collect()]
    assert {d["parts"] for d in documents} == {parts} and len({d["part"] for d in documents}) == len(documents)
    assert sum(len(d["dependencies"]) for d in documents) == n
    stored = day_rows(rows, rows.select("dt").distinct(), "us", "v2", parts)
    keys = [(r.ts, r.ts_bucket, r.part, r.parts) for r in stored.collect()]
    assert len(keys) == parts == len(set(keys))
    assert stored.select(F.explode("dependencies")).count() == n


def test_an_empty_rerun_leaves_no_document(spark, tmp_path):
    source = str(tmp_path / "in/p_span-2024-01-15")
    to_docs(frame(spark, CHAIN)).write.text(source)
    run_day(spark, search_job(tmp_path))
    assert len(stored(tmp_path, "p_dependencies-2024-01-15")) == 1
    to_docs(frame(spark, CHAIN[:1])).write.mode("overwrite").text(source)
    assert edges(run_day(spark, search_job(tmp_path))) == []
    assert stored(tmp_path, "p_dependencies-2024-01-15") == []


def test_a_day_moves_with_its_source(spark, tmp_path):
    to_docs(frame(spark, CHAIN)).write.text(str(tmp_path / "in/p_span-2024-01-15"))
    run_day(spark, search_job(tmp_path))
    to_docs(frame(spark, CHAIN)).write.text(str(tmp_path / "in/p-span-2024-01-15"))
    run_day(spark, search_job(tmp_path))
    assert len(stored(tmp_path, "p-dependencies-2024-01-15")) == 1
    assert stored(tmp_path, "p_dependencies-2024-01-15") == []


@pytest.mark.parametrize("change", ["id", "if(id = 77777, null, id)", "if(id % 1000 = 3, id + 1, id)", "-id"])
def test_stored_difference_is_the_difference(spark, change):
    left = spark.range(100_000).selectExpr("id as n", "cast(id % 7 as string) as s", "array(id % 3) as a")
    right = left.withColumnRenamed("n", "id").selectExpr(f"{change} as n", "s", "a").unionAll(left.filter("n = 5"))
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(stored_difference(left, right)) == rows(difference(left, right))


def test_stored_difference_tells_places_of_nulls_and_repeats(spark):
    left = spark.createDataFrame([(None, "a"), ("b", "b"), ("b", "b")], "x string, y string")
    right = spark.createDataFrame([("a", None), ("b", "b")], "x string, y string")
    found = {tuple(r) for r in stored_difference(left, right).collect()}
    assert found == {(None, "a", 1), ("a", None, -1), ("b", "b", 1)}
    assert stored_difference(left, left).isEmpty() and stored_difference(left.filter("false"), left.filter("false")).isEmpty()


def test_difference_counts_repeats(spark):
    left = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "x string, y int")
    right = spark.createDataFrame([("b", None), ("a", 1), ("c", 3)], "x string, y int")
    assert edges(difference(left, right)) == [("a", 1, 1), ("c", 3, -1)]
    assert_equal(left, left)
    with pytest.raises(AssertionError):
        assert_equal(left, right)


SIZES = [(1, 3, 1), (16, 3, 4), (50, 3, 5), (50, 15, 50)]


@pytest.mark.parametrize("nodes, branching, services", SIZES)
def test_random_trees_derive_their_edges(spark, nodes, branching, services):
    sizes = spark.range(20).select(F.col("id").alias("tree_id"), F.lit(nodes).alias("nodes"))
    names = spark.range(services).selectExpr("id place", "'s' || id service")
    forest = trees(sizes, names, branching, chunk=7)
    rows = forest.collect()
    assert len(rows) == 20 * nodes and {r.service for r in rows if r.node == 0} == {"s0"}
    assert all(r.parent_node is None if r.node == 0 else r.parent_node == (r.node - 1) // branching for r in rows)
    assert_equal(derive(tree_spans(forest)), tree_edges(forest))


def test_impossible_trees(spark):
    names = spark.range(1).selectExpr("id place", "'s' service")
    with pytest.raises(ValueError):
        trees(spark.range(1), names, 0)
    with pytest.raises(Exception, match="must have nodes"):
        trees(spark.sql("select 1 tree_id, 0 nodes"), names, 3).collect()


def test_command_line(monkeypatch):
    monkeypatch.setenv("STORAGE", "span_table")
    monkeypatch.setenv("DATE", "2024-01-14")
    monkeypatch.setenv("PEER_SERVICE_TAG", "to")
    job = parse_args(["--input", "i", "--output", "o"])
    assert (job.source, job.day, job.peer_tag) == ("span_table", "2024-01-14", "to")
    job = parse_args(["2024-01-15", "--input", "i", "--output", "o", "--range-hours", "0", "--prefix", "p"])
    assert (job.day, job.scan.range_millis, job.scan.names.prefix) == ("2024-01-15", None, "p")
