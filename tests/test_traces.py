"""Span tables laid out by trace, and the plan over them."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import frame
from spanweave.operators.derive import derive
from spanweave.operators.whole import derive_stored, whole_trace_links
from spanweave.sinks.traces import TraceStore, read_traces, write_traces
from test_links_random import random_spans
from walk import walk


def edges(df):
    return sorted(map(tuple, df.collect()))


def test_links_of_random_traces(spark):
    spans = random_spans(11, 1200)
    counted = whole_trace_links(frame(spark, spans)).groupBy("kind", "parent", "child").agg(F.sum("weight"))
    assert Counter({tuple(r[:3]): r[3] for r in counted.collect()}) == walk(spans)


@pytest.mark.parametrize("most", [0, 4, 1000])
def test_stored_spans_give_the_same_edges(spark, tmp_path, most):
    df = frame(spark, random_spans(5, 300))
    store = TraceStore(f"file://{tmp_path}/s", buckets=5)
    write_traces(df, store, most)
    whole, large = read_traces(spark, store)
    assert (whole.isEmpty(), large.isEmpty()) == (most == 0, most == 1000)
    assert edges(derive_stored(whole, large)) == edges(derive(df))


def test_a_store_is_replaced_and_opened_again(spark, tmp_path):
    store = TraceStore(f"file://{tmp_path}/s", buckets=3)
    write_traces(frame(spark, random_spans(1, 50)), store)
    write_traces(frame(spark, random_spans(2, 50)), store)
    spark.sql(f"drop table {store.table}")  # what a new application finds
    whole, large = read_traces(spark, store)
    assert edges(derive_stored(whole, large)) == edges(derive(frame(spark, random_spans(2, 50))))
    write_traces(frame(spark, []), store)
    assert edges(derive_stored(*read_traces(spark, store))) == []


def test_nothing_is_exchanged_by_trace(spark, tmp_path):
    store = TraceStore(f"file://{tmp_path}/s", buckets=4)
    write_traces(frame(spark, random_spans(3, 100)), store)
    whole, _ = read_traces(spark, store)
    plan = whole_trace_links(whole).groupBy("parent", "child").agg(F.sum("weight"))._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(exchanges) == 1 and exchanges[0].startswith("parent")
    assert "Bucketed: true" in plan
