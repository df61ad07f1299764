"""Traces that are counted first and exchanged once, against the general plan, and layouts that grow with the input."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks import queries
from helpers import frame, links
from spanweave.fixtures import ids_orders, repeated, spans_orders
from spanweave.operators import trees as trees_module
from spanweave.operators import whole
from spanweave.operators.derive import derive
from spanweave.operators.groups import leaf_spans, shared_groups
from spanweave.operators.increment import edge_changes
from spanweave.operators.spans import narrow_spans, scan_spans, trace_groups
from spanweave.operators.trees import trees
from spanweave.plans import day
from spanweave.shared import written
from spanweave.sinks import traces
from test_links_random import random_spans
from walk import Span, walk


def rows(df):
    return Counter(map(str, df.collect()))


def counted(df, **options):
    found = whole.counted_links(df, **options).groupBy("kind", "parent", "child").agg(F.sum("weight"))
    return Counter({tuple(r[:3]): r[3] for r in found.collect()})


@pytest.mark.parametrize("most", [100_000, 3, -100_000])
def test_links_of_random_traces(spark, monkeypatch, most):
    """All traces lie together, some of them, none of them."""
    monkeypatch.setattr(whole, "MOST_SPANS", most)
    spans = random_spans(13, 700)
    df = frame(spark, spans)
    split = whole.split_traces(df)
    assert (split.large is None) == (most == 100_000)
    expected = walk(spans)
    assert counted(df) == expected
    if most > 0:
        for kinds in (("shared",), ("parent",), ("peer",), ("shared", "parent")):
            assert counted(df, kinds=kinds) == {k: n for k, n in expected.items() if k[0] in kinds}


@pytest.mark.parametrize("most", [100_000, 3])
def test_groups_leaves_and_traces(spark, monkeypatch, most):
    monkeypatch.setattr(whole, "MOST_SPANS", most)
    df = frame(spark, random_spans(17, 400))
    # Also what the three treat in a way of their own: null ids, and tags that are missing or empty.
    odd = df.limit(1).selectExpr("trace_id", "cast(null as bigint) as span_id", "start_time", "service", "tags", "refs")
    bare = df.limit(1).selectExpr("trace_id", "span_id", "start_time", "service", "cast(null as array<struct<key:string,vtype:string,value:string>>) as tags", "refs")
    empty = bare.withColumn("tags", F.expr("filter(array(named_struct('key', 'a', 'vtype', 'b', 'value', 'c')), t -> false)"))
    df = df.unionAll(odd).unionAll(odd).unionAll(bare).unionAll(empty)
    assert rows(whole.counted_groups(df)) == rows(shared_groups(narrow_spans(df)))
    assert rows(whole.counted_leaves(df)) == rows(leaf_spans(narrow_spans(df)))
    columns = ["trace_id", "spans", "distinct_spans", "span_ids", "services", "first_start", "last_start"]
    assert rows(whole.counted_traces(df).select(columns)) == rows(trace_groups(df).select(columns))


def test_legacy_parents(spark):
    df = frame(spark, random_spans(19, 300)).withColumn("parent_id", F.expr("if(span_id % 2 = 0, span_id - 1, null)"))
    other = df.withColumn("parent_id", F.expr("if(span_id % 3 = 0, 1L, null)"))
    df = df.unionAll(other)
    assert rows(whole.derive_counted(df)) == rows(derive(df))


@pytest.mark.parametrize("most", [100_000, 3])
def test_changes_by_late_spans(spark, monkeypatch, most):
    monkeypatch.setattr(whole, "MOST_SPANS", most)
    df = frame(spark, random_spans(23, 300))
    late = F.expr("span_id % 3 = 1")
    changed = derive(df.filter(~late)).unionAll(edge_changes(df.filter(~late), df.filter(late)))
    summed = changed.groupBy("parent", "child").agg(F.sum("call_count").alias("call_count")).filter("call_count <> 0")
    assert rows(summed) == rows(derive(df))


def test_one_exchange_by_trace(spark, monkeypatch):
    monkeypatch.setattr(whole, "SPANS_A_TASK", 50)
    df = frame(spark, random_spans(3, 100))
    plan = whole.derive_counted(df)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(keys) == 2 and sum(k.startswith("trace_id") for k in keys) == 1


def test_windows_are_few_and_short(spark):
    """The order of a shared id was found in a second window over all facts about ids, on top of that which matches them."""
    df = frame(spark, random_spans(3, 100))
    for kinds, most in ((("shared", "parent", "peer"), 2), (("shared",), 1)):
        plan = whole.counted_links(df, kinds=kinds)._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"^[\s:+-]*Window \[", plan, re.M)) == most
    shared = whole.counted_links(df, kinds=("shared",))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in shared


def test_groups_with_legacy_parents(spark):
    """Copies that differ in the legacy parent id alone were counted as two spans."""
    df = frame(spark, random_spans(43, 200)).withColumn("parent_id", F.lit(None).cast("bigint"))
    df = df.unionAll(df.withColumn("parent_id", F.lit(1).cast("bigint")))
    assert rows(whole.counted_groups(df)) == rows(shared_groups(narrow_spans(df)))


def test_copies_in_one_pass(spark, sf):
    """The copies were found in a second pass over the joins that make the spans."""
    spans = spans_orders(spark, sf)
    plan = repeated(spans)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == spans._jdf.queryExecution().optimizedPlan().toString().count("Join")
    assert rows(repeated(spans)) == rows(spans.unionAll(spans.filter("span_id % 3 = 0")))


def test_ids_are_counted_in_place_of_spans(spark, sf):
    """Counting the spans took their joins a second time."""
    ids = ids_orders(spark, sf)
    assert "Join" not in ids._jdf.queryExecution().optimizedPlan().toString()
    spans = spans_orders(spark, sf)
    assert rows(ids) == rows(spans.select("trace_id", "span_id"))
    assert whole.split_traces(spans, ids=ids.unionAll(ids)).parts == whole.split_traces(spans.unionAll(spans)).parts


@pytest.mark.parametrize("most", [100_000, 3])
def test_scanned_spans_are_stored_once(spark, monkeypatch, most):
    """Each derivation of the same spans made and scanned them anew."""
    monkeypatch.setattr(whole, "MOST_SPANS", most)
    df = frame(spark, random_spans(47, 300))
    scanned = written(scan_spans(df), "spans")
    assert counted(repeated(scanned)) == counted(df)
    assert rows(derive(scanned)) == rows(derive(df))


def test_a_large_trace_lies_apart(spark, monkeypatch):
    monkeypatch.setattr(whole, "MOST_SPANS", 1000)
    spans = random_spans(29, 100) + [Span("hot", i % 7, i, "s", (("span.kind", "string", "client"),), (1,)) for i in range(3000)]
    df = frame(spark, spans)
    split = whole.split_traces(df)
    assert {r.trace_id for r in split.large.select("trace_id").collect()} == {"hot"}
    assert split.whole.count() == len(spans) - 3000
    assert counted(df) == links(df)


def test_partitions_grow_with_the_spans(spark, monkeypatch):
    monkeypatch.setattr(whole, "SPANS_A_TASK", 50)
    spans = random_spans(31, 200)
    assert whole.split_traces(frame(spark, spans)).parts == len(spans) // 50 + 1


def test_buckets_grow_with_the_spans(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(traces, "SPANS_A_BUCKET", 20)
    store = traces.TraceStore(f"file://{tmp_path}/s", buckets=3)
    for seed, number in ((37, 100), (41, 3)):
        df = frame(spark, random_spans(seed, number))
        traces.write_traces(df, store)
        spark.sql(f"drop table {store.table}")  # what a new application finds
        together, large = traces.read_traces(spark, store)
        found = int(re.search(r"Num Buckets\s*\|\s*(\d+)", spark.sql(f"describe extended {store.table}")._show_string(200, False)).group(1))
        least = 3
        while least * 20 < df.count():
            least *= 2
        assert found == least
        assert rows(whole.derive_stored(together, large)) == rows(derive(df))


def test_a_task_expands_few_nodes(spark, monkeypatch):
    """Small rows of chunks would all go to one task."""
    monkeypatch.setattr(trees_module, "NODES_A_TASK", 100)
    names = spark.sql("select 0 place, 'a' service union all select 1, 'b'")
    nodes = trees(spark.range(400).selectExpr("id as tree_id", "25 as nodes"), names, 3)
    assert nodes.count() == 10_000
    assert max(r[1] for r in nodes.groupBy(F.spark_partition_id()).count().collect()) < 400


def test_a_day_puts_few_bytes_into_a_task(spark):
    """The tables of a task held what 64 MiB of shuffled rows expand to."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    with day._whole_plans(spark):
        assert int(spark.conf.get(key).rstrip("b")) == day.TASK_BYTES == 16 << 20
    assert spark.conf.get(key) == before


def test_documents_are_packed(spark, sf):
    """Plain documents took more than ten times the disk."""
    docs = queries._docs_of(spans_orders(spark, sf))
    assert docs.inputFiles() and all(f.endswith(".gz") for f in docs.inputFiles())
    assert docs.count() == spans_orders(spark, sf).count()
