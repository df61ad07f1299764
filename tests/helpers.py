from collections import Counter

from pyspark.sql import functions as F

from spanweave.operators.derive import all_links
from spanweave.schema import LEGACY_SPAN_SCHEMA, SPAN_SCHEMA
from walk import Span


def frame(spark, spans, legacy=False):
    rows = [(*s[:4], [tuple(t) for t in s.tags], list(s.refs)) for s in spans]
    if legacy:
        rows = [(*r, s.parent_id) for r, s in zip(rows, spans)]
    return spark.createDataFrame(rows, LEGACY_SPAN_SCHEMA if legacy else SPAN_SCHEMA)


def links(df, **options):
    rows = all_links(df, **options).groupBy("kind", "parent", "child").agg(F.sum("weight")).collect()
    return Counter({tuple(r[:3]): r[3] for r in rows})


def span(span_id, service, *tags, refs=(), start=None, trace="t", parent_id=None):
    full = tuple(t if len(t) == 3 else (t[0], "string", t[1]) for t in tags)
    return Span(trace, span_id, start, service, full, tuple(refs), parent_id)


def kind(value):
    return ("span.kind", value)
