"""Span-level operators: duplicates, trace statistics and the narrow form the link plan works on."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.functions.refs import append_parent, no_refs
from spanweave.functions.tags import (
    PEER_KEY,
    call_sides,
    is_client,
    is_server,
    no_tags,
    tag_value,
)
from spanweave.schema import SPAN_KEY


def dedup_spans(spans: DataFrame) -> DataFrame:
    """Distinct spans, compared on all six columns, null equal to null.

    The legacy parent id takes no part in the comparison; the smallest one is kept.
    """
    if "parent_id" in spans.columns:
        return spans.groupBy(*SPAN_KEY).agg(F.min("parent_id").alias("parent_id"))
    return spans.select(*SPAN_KEY).distinct()


def with_legacy_parent(spans: DataFrame) -> DataFrame:
    """Append the legacy parent id to the references of wide-row spans."""
    return spans.withColumn("refs", append_parent(F.col("refs"), F.col("parent_id"))).drop("parent_id")


def scan_spans(spans: DataFrame, peer_tag: str = PEER_KEY) -> DataFrame:
    """Spans, with their copies, reduced to what link derivation reads; see `narrow_spans`.  A legacy parent id stays a column.

    Spans that are scanned already, and were stored as such, stay as they are: they name the peer of their own scan.
    """
    if "digest" in spans.columns:
        return spans
    legacy = ["parent_id"] if "parent_id" in spans.columns else []
    filled = spans.filter(F.col("trace_id").isNotNull() & F.col("span_id").isNotNull()).select(
        "trace_id",
        "span_id",
        "start_time",
        "service",
        F.coalesce("refs", no_refs()).alias("refs"),
        F.coalesce("tags", no_tags()).alias("tags"),
        *legacy,
    )
    tags = F.col("tags")
    return filled.select(
        "trace_id",
        "span_id",
        "start_time",
        "service",
        "refs",
        F.unhex(F.sha2(F.to_json(F.struct("start_time", "service", "tags", "refs")), 256)).alias(
            "digest"
        ),
        is_client(tags).alias("client"),
        is_server(tags).alias("server"),
        call_sides(tags).alias("sides"),
        tag_value(tags, peer_tag).alias("peer"),
        *legacy,
    )


def narrow_spans(spans: DataFrame, peer_tag: str = PEER_KEY) -> DataFrame:
    """Distinct spans, reduced to what link derivation reads.

    Tags are most of a span's bytes, so they stay in the scan stage: what they say about links is
    computed there, and a SHA-256 digest of the whole span stands in for them in the comparison.
    Grouping on the digest and on columns that follow from it removes duplicates on the map side
    first and spreads any number of spans of one trace or id over all tasks.

    Trace and span ids are required; the readers see to that.

    Columns: trace_id, span_id, start_time, service, refs, digest, client, server, sides, peer.
    """
    narrow = scan_spans(spans, peer_tag)
    if "parent_id" in narrow.columns:
        keys = [c for c in narrow.columns if c != "parent_id"]
        return with_legacy_parent(narrow.groupBy(*keys).agg(F.min("parent_id").alias("parent_id")))
    return narrow.distinct()


def trace_groups(spans: DataFrame) -> DataFrame:
    """One row per trace: its spans, distinct spans, span ids, services and start times.

    The trace is never gathered: every column is a sum or an extreme, combined on the map side.
    """
    copies = spans.groupBy(*SPAN_KEY).agg(F.count("*").alias("copies"))
    per_id = copies.groupBy("trace_id", "span_id", "service").agg(
        F.sum("copies").alias("spans"),
        F.count("*").alias("distinct_spans"),
        F.min("start_time").alias("first_start"),
        F.max("start_time").alias("last_start"),
    )
    # Counted in two levels each; counting both distinctly at once would multiply the rows.
    ids = per_id.groupBy("trace_id", "span_id").agg(
        F.sum("spans").alias("spans"),
        F.sum("distinct_spans").alias("distinct_spans"),
        F.min("first_start").alias("first_start"),
        F.max("last_start").alias("last_start"),
    )
    totals = ids.groupBy("trace_id").agg(
        F.sum("spans").alias("spans"),
        F.sum("distinct_spans").alias("distinct_spans"),
        F.count("span_id").alias("span_ids"),
        F.min("first_start").alias("first_start"),
        F.max("last_start").alias("last_start"),
    )
    services = per_id.select("trace_id", "service").distinct().groupBy("trace_id").agg(F.count("service").alias("services"))
    joined = totals.join(services, "trace_id")
    return joined.select("trace_id", "spans", "distinct_spans", "span_ids", "services", "first_start", "last_start")
