"""Registered queries: every operator over the analytics tables, as flat comparable rows."""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.fixtures import (
    ids_orders,
    repeated,
    spans_conv,
    spans_events,
    spans_orders,
    table,
)
from spanweave.functions.ids import hex_to_long, long_to_hex, normalize_trace_id
from spanweave.functions.refs import append_parent, merge_refs, ref_text
from spanweave.functions.tags import (
    is_client,
    is_server,
    merge_tags,
    sort_tags,
    tag_value,
)
from spanweave.operators.derive import KINDS, PARENT, PEER, SHARED, count_calls, derive
from spanweave.operators.increment import apply_changes, edge_changes
from spanweave.operators.groups import eligible_spans
from spanweave.operators.results import (
    adjacency_map,
    stored_difference,
    read_documents,
    read_result,
    tree_edges,
)
from spanweave.operators.spans import dedup_spans, narrow_spans, scan_spans
from spanweave.operators.whole import counted_groups, counted_leaves, counted_links, counted_traces, derive_counted, derive_stored
from spanweave.operators.trees import tree_spans, trees
from spanweave.plans.day import DayJob, ScanOptions, run_day
from spanweave.plans.publish import publish_day, published_edges
from spanweave.shared import new_folder, written
from spanweave.sinks.records import day_documents, day_rows, sink_layout, write_documents, write_rows
from spanweave.sinks.traces import TraceStore, read_traces, write_traces
from spanweave.schema import RAW_JSON_SCHEMA
from spanweave.sources.decode import decode_docs, rejected_docs
from spanweave.sources.names import NameRule
from spanweave.sources.spans import read_docs, read_json_docs, read_span_table

DAY = dt.date(2024, 1, 15)
LAST_DAY = dt.date(2024, 1, 30)
NEXT_DAY = dt.date(2024, 1, 31)
NOW_MILLIS = 1_706_659_200_000  # 2024-01-31T00:00:00Z
FILE_MARKS = ("-", "_")

Query = Callable[[SparkSession, str], DataFrame]


def shared_folder(spark: SparkSession) -> str:
    return new_folder(spark, "spanweave")


def show_tags(tags: Column) -> Column:
    return F.array_join(
        F.transform(
            tags,
            lambda t: F.concat_ws(
                ":", t["key"], F.coalesce(t["vtype"], F.lit("-")), F.coalesce(t["value"], F.lit("-"))
            ),
        ),
        ";",
    )


def show_spans(spans: DataFrame) -> DataFrame:
    return spans.select(
        "trace_id",
        "span_id",
        "start_time",
        "service",
        show_tags(F.col("tags")).alias("tag_text"),
        ref_text(F.col("refs")).alias("ref_text"),
    )


def to_docs(spans: DataFrame) -> DataFrame:
    """Spans as a search store would hold them, one JSON text per span."""
    tags = F.transform(
        "tags", lambda t: F.struct(t["key"].alias("key"), t["vtype"].alias("type"), t["value"].alias("value"))
    )
    refs = F.transform(
        "refs",
        lambda r: F.struct(
            F.lit("CHILD_OF").alias("refType"),
            F.col("trace_id").alias("traceID"),
            long_to_hex(r).alias("spanID"),
        ),
    )
    return spans.select(
        F.to_json(
            F.struct(
                F.col("trace_id").alias("traceID"),
                long_to_hex(F.col("span_id")).alias("spanID"),
                F.col("start_time").alias("startTime"),
                F.expr("start_time div 1000").alias("startTimeMillis"),
                F.lit(1).alias("duration"),
                F.struct(F.col("service").alias("serviceName")).alias("process"),
                tags.alias("tags"),
                refs.alias("references"),
            )
        ).alias("value")
    )


def stored_docs(spans: DataFrame, folder: str, **options) -> str:
    to_docs(spans).write.mode("overwrite").options(**options).text(folder)
    return folder


def _kind_links(spans: DataFrame, kinds=KINDS, ids: DataFrame | None = None) -> DataFrame:
    return (
        counted_links(spans, kinds=kinds, ids=ids)
        .groupBy("kind", "parent", "child")
        .agg(F.sum("weight").alias("links"))
    )


# Sources


def day_scan(spark, sf_dir):
    path = f"{shared_folder(spark)}/spans"
    spans_events(spark, sf_dir).write.parquet(path)
    return read_span_table(spark, path, DAY, legacy_parent=False).select(
        "trace_id", "span_id", "start_time", "service"
    )


def _nested(spans: DataFrame) -> DataFrame:
    """The wide-row store's own layout."""
    tag = lambda t: F.struct(
        t["key"].alias("key"), t["vtype"].alias("value_type"), t["value"].alias("value_string")
    )
    return spans.select(
        F.unhex("trace_id").alias("trace_id"),
        "span_id",
        "start_time",
        F.struct(F.col("service").alias("service_name")).alias("process"),
        F.transform("tags", tag).alias("tags"),
        F.transform("refs", lambda r: F.struct(r.alias("span_id"), F.lit("CHILD_OF").alias("ref_type"))).alias("refs"),
    )


def decode_rows_query(spark, sf_dir):
    path = f"{shared_folder(spark)}/spans"
    _nested(spans_orders(spark, sf_dir)).write.parquet(path)
    return show_spans(read_span_table(spark, path))


def day_scan_late(spark, sf_dir):
    """Every span lies in the folder of the day after its own."""
    path = f"{shared_folder(spark)}/spans"
    arrived = F.date_add(F.to_date(F.timestamp_micros("start_time")), 1)
    spans_events(spark, sf_dir).withColumn("dt", arrived).write.partitionBy("dt").parquet(path)
    return read_span_table(spark, path, DAY, legacy_parent=False, dt_window=(0, 1)).select(
        "trace_id", "span_id", "start_time", "service"
    )


def rejected_docs_query(spark, sf_dir):
    """Of every four events one is a span; one is no JSON, one has a field of another type, one lacks an id."""
    path = f"{shared_folder(spark)}/docs"
    event = F.col("event_id").cast("string")
    span_id = F.lower(F.hex("event_id"))
    line = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('{"traceID":"1","spanID":"'), span_id, F.lit('"}')))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit('{"broken '), event))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit('{"traceID":"1","spanID":"1","tags":"'), event, F.lit('"}')))
        .otherwise(F.concat(F.lit('{"traceID":"'), span_id, F.lit('"}')))
    )
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    return rejected_docs(read_docs(spark, path, "permissive"))


def range_scan(spark, sf_dir):
    path = stored_docs(spans_events(spark, sf_dir), f"{shared_folder(spark)}/docs")
    return show_spans(read_json_docs(spark, path, now_millis=NOW_MILLIS))


def partition_names(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    rules = {
        "plain": NameRule(),
        "dots": NameRule(prefix="prod", separator="."),
        "joined": NameRule(separator="", type_suffix=True),
        "alias": NameRule(prefix="prod", aliases=True),
    }

    def named(name: str, rule: NameRule) -> Column:
        return F.transform(
            rule.candidate_columns(F.col("day")),
            lambda c, i: F.struct(F.lit(name).alias("rule"), i.alias("place"), "day", c.alias("c")),
        )

    names = [named(name, rule) for name, rule in rules.items()]
    return days.select(F.explode(F.concat(*names)).alias("n")).select(
        "n.rule",
        F.col("n.place").alias("place"),
        F.col("n.day").cast("string").alias("day"),
        F.col("n.c.read").alias("read_name"),
        F.col("n.c.write").alias("write_name"),
    )


def _fallback_job(folder: str) -> DayJob:
    names = NameRule(prefix="old", prefix_marks=FILE_MARKS)
    return DayJob(
        "json_docs",
        f"{folder}/in",
        f"{folder}/out",
        LAST_DAY,
        scan=ScanOptions(names=names, range_millis=None),
    )


def source_fallback(spark, sf_dir):
    folder = shared_folder(spark)
    spans = spans_events(spark, sf_dir)
    lone = spans.filter(F.size("refs") == 0)
    stored_docs(lone, f"{folder}/in/old-span-{LAST_DAY}")
    stored_docs(spans, f"{folder}/in/old_span-{LAST_DAY}")
    return run_day(spark, _fallback_job(folder))


def missing_source(spark, sf_dir):
    folder = shared_folder(spark)
    stored_docs(spans_events(spark, sf_dir), f"{folder}/in/old_span-{LAST_DAY}")
    return run_day(spark, _fallback_job(folder))


def sink_layout_query(spark, sf_dir):
    path = f"{shared_folder(spark)}/dependencies_v2"
    edges = _event_edges(spark, sf_dir)
    before = sink_layout(spark, path)
    days = spark.range(1).select(F.lit(LAST_DAY).alias("dt"))
    write_rows(day_rows(edges, days, "spanweave", "v2"), path)
    links = spark.read.parquet(path).select(F.explode("dependencies").alias("d"))
    layouts = F.explode(F.array(F.lit(before), F.lit(sink_layout(spark, path)))).alias("layout")
    return links.select("d.parent", "d.child", F.col("d.callCount").alias("call_count"), layouts)


# Decoding


def _docs_of(spans: DataFrame) -> DataFrame:
    # Documents repeat their field names: as gzip they take a tenth.  One task reads a file, so files have a bounded size.
    packed = {"compression": "gzip", "maxRecordsPerFile": 500_000}
    return read_docs(spans.sparkSession, stored_docs(spans, f"{shared_folder(spans.sparkSession)}/docs", **packed))


def decode_spans(spark, sf_dir):
    return show_spans(decode_docs(_docs_of(spans_orders(spark, sf_dir))))


def _raw_json(key: str, vtype: str, value: Column) -> Column:
    return F.concat(F.lit(f'{{"key":"{key}","type":"{vtype}","value":'), value, F.lit("}"))


def _raw_tag(key: str, vtype: str, value: Column) -> Column:
    return F.struct(
        F.lit(key).alias("key"), F.lit(vtype).alias("type"), value.cast("string").alias("value")
    )


def decode_tags_query(spark, sf_dir):
    number = F.col("event_id").cast("string")
    tags = F.concat_ws(
        ",",
        _raw_json("event", "STRING", F.to_json(F.struct("event_type")).substr(F.lit(15), F.length("event_type") + 2)),
        _raw_json("value", "float64", F.coalesce(F.to_json(F.col("value").cast("variant")), F.lit("null"))),
        _raw_json("k", "string", F.coalesce(F.to_json(F.get_json_object("props", "$.k").cast("variant")), F.lit("null"))),
        _raw_json("nested", "string", F.concat(F.lit('{"a":'), number, F.lit("}"))),
        _raw_json("list", "string", F.concat(F.lit("["), number, F.lit("]"))),
        _raw_json("flag", "string", F.lit("true")),
        _raw_json("number", "string", number),
        _raw_json("absent", "string", F.lit("null")),
    )
    docs = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit('{"traceID":"1","spanID":"'), F.hex("event_id"), F.lit('","tags":['), tags, F.lit("]}")).alias("d")
    )
    parsed = docs.select("event_id", F.from_json("d", RAW_JSON_SCHEMA, {"mode": "FAILFAST"}).alias("d"))
    spans = decode_docs(parsed.select("d.*"), canonical=False)
    return spans.select(F.col("span_id").alias("event_id"), show_tags(F.col("tags")).alias("tag_text"))


def merge_tag_fields(spark, sf_dir):
    tags = F.array(_raw_tag("event", "string", F.col("event_type")), _raw_tag("n", "int64", F.lit(1)))
    fields = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").select(
        "event_id", show_tags(merge_tags(tags, fields)).alias("tag_text")
    )


def hex_ids(spark, sf_dir):
    key = F.col("o_orderkey")
    digits = F.lower(F.hex(key))
    high = F.concat(F.lit("f"), F.lpad(digits, 15, "0"))
    long = F.concat(F.lit("1"), F.lpad(digits, 16, "0"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        hex_to_long(digits).alias("short_id"),
        hex_to_long(high).alias("high_id"),
        hex_to_long(long).alias("long_id"),
        hex_to_long(F.upper(high)).alias("upper_id"),
        hex_to_long(F.concat(F.lit("x"), digits)).alias("bad_id"),
    )


def merge_refs_query(spark, sf_dir):
    number = F.col("l_linenumber").cast("bigint")
    parent = F.when(number > 2, long_to_hex(F.shiftright(number, 1) + 1))
    listed = F.when(
        number > 1,
        F.array(
            F.struct(long_to_hex(F.shiftright(number, 1) + 1).alias("spanID")),
            F.struct(long_to_hex(number - 5).alias("spanID")),
        ),
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", ref_text(merge_refs(parent, listed)).alias("ref_text")
    )


def _with_parents(spark, sf_dir):
    number = F.col("span_id")
    return spans_orders(spark, sf_dir).withColumn(
        "parent_id", F.when(number % 2 == 0, F.expr("(span_id - 1) div 2 + 1"))
    )


def legacy_parent(spark, sf_dir):
    spans = _with_parents(spark, sf_dir)
    return spans.select(
        "trace_id",
        "span_id",
        "start_time",
        "service",
        ref_text(append_parent(F.col("refs"), F.col("parent_id"))).alias("ref_text"),
    )


def legacy_dependencies(spark, sf_dir):
    return derive_counted(_with_parents(spark, sf_dir), ids=ids_orders(spark, sf_dir))


def norm_trace_id(spark, sf_dir):
    digits = F.lower(F.hex("o_orderkey"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        normalize_trace_id(digits).alias("short_id"),
        normalize_trace_id(F.lpad(digits, 16, "0")).alias("id_16"),
        normalize_trace_id(F.lpad(digits, 32, "a")).alias("id_32"),
        normalize_trace_id(F.lpad(digits, 40, "b")).alias("id_40"),
        normalize_trace_id(F.concat(F.lit("a "), digits)).alias("blank_id"),
    )


def canonical_order(spark, sf_dir):
    mixed = F.concat(
        F.array(F.struct(F.lit("z").alias("key"), F.lit("string").alias("vtype"), F.col("service").alias("value"))),
        F.reverse("tags"),
        F.transform("tags", lambda t: F.struct(t["key"].alias("key"), t["vtype"].alias("vtype"), F.lit("again").alias("value"))),
    )
    refs = F.concat(F.array("span_id"), "refs", F.array(F.lit(-1).cast("bigint")))
    spans = spans_orders(spark, sf_dir)
    return show_spans(spans.withColumn("tags", sort_tags(mixed)).withColumn("refs", F.sort_array(refs)))


def tag_lookup(spark, sf_dir):
    tags = F.col("tags")
    return spans_orders(spark, sf_dir).select(
        "trace_id",
        "span_id",
        "start_time",
        "service",
        tag_value(tags, "peer.service").alias("peer"),
        tag_value(tags, "span.kind").alias("kind"),
        tag_value(tags, "absent").alias("absent"),
    )


def span_kinds(spark, sf_dir):
    tags = F.col("tags")
    return spans_orders(spark, sf_dir).select(
        "trace_id",
        "span_id",
        "start_time",
        "service",
        is_client(tags).alias("client"),
        is_server(tags).alias("server"),
    )


# Groups


def _repeated_orders(spark, sf_dir):
    return repeated(spans_orders(spark, sf_dir))


def _repeated_ids(spark, sf_dir):
    return repeated(ids_orders(spark, sf_dir))


def _tied_orders(spark, sf_dir):
    """Few ids, years for start times and short names: many spans of an id tie."""
    return spans_orders(spark, sf_dir).selectExpr(
        "trace_id", "span_id % 2 as span_id", "start_time div 31536000000000 as start_time",
        "substr(service, 1, 6) as service", "tags", "refs",
    )


def trace_groups_query(spark, sf_dir):
    return counted_traces(_repeated_orders(spark, sf_dir), ids=_repeated_ids(spark, sf_dir))


def dedup_spans_query(spark, sf_dir):
    return show_spans(dedup_spans(_repeated_orders(spark, sf_dir)))


def shared_groups_query(spark, sf_dir):
    return counted_groups(_repeated_orders(spark, sf_dir), ids=_repeated_ids(spark, sf_dir))


def _show_eligible(spans: DataFrame) -> DataFrame:
    return spans.select(
        "trace_id", "span_id", "service", "peer", ref_text(F.col("refs")).alias("ref_text")
    )


def eligible_spans_query(spark, sf_dir):
    return _show_eligible(eligible_spans(narrow_spans(_repeated_orders(spark, sf_dir))))


def leaf_spans_query(spark, sf_dir):
    return _show_eligible(counted_leaves(_repeated_orders(spark, sf_dir), ids=_repeated_ids(spark, sf_dir)))


def stored_dependencies(spark, sf_dir):
    """From a table bucketed by trace; traces of more than ten spans lie beside it."""
    store = TraceStore(shared_folder(spark), buckets=8)
    write_traces(_repeated_orders(spark, sf_dir), store, most=10)
    return derive_stored(*read_traces(spark, store))


def late_spans(spark, sf_dir):
    """Every fifth order has spans that arrive, with copies, after the rest was derived and stored."""
    folder = shared_folder(spark)
    _repeated_orders(spark, sf_dir).write.parquet(f"{folder}/spans")
    spans = spark.read.parquet(f"{folder}/spans")
    late = F.expr("endswith(trace_id, '5') and span_id % 3 <> 1")
    stored = spans.filter(~late)
    derive_counted(stored).write.parquet(f"{folder}/edges")
    return apply_changes(spark.read.parquet(f"{folder}/edges"), edge_changes(stored, spans.filter(late)))


# Results


def _event_edges(spark, sf_dir):
    return derive(spans_events(spark, sf_dir)).withColumn("dt", F.lit(LAST_DAY))


def day_document(spark, sf_dir):
    path = f"{shared_folder(spark)}/documents"
    write_documents(day_documents(_event_edges(spark, sf_dir), "spanweave"), path)
    return read_documents(spark.read.text(path))


def _stored_rows(spark, sf_dir, layout: str, second: str):
    edges = _event_edges(spark, sf_dir)
    days = spark.range(1).select(F.explode(F.array(F.lit(LAST_DAY), F.lit(NEXT_DAY))).alias("dt"))
    path = f"{shared_folder(spark)}/{layout}"
    write_rows(day_rows(edges, days, "spanweave", layout), path)
    return spark.read.parquet(path).select("ts", second, F.explode_outer("dependencies").alias("d")).select(
        "ts", second, "d.parent", "d.child", F.col("d.callCount").alias("call_count"), "d.source"
    )


def sink_v2(spark, sf_dir):
    return _stored_rows(spark, sf_dir, "v2", "ts_bucket")


def sink_v1(spark, sf_dir):
    return _stored_rows(spark, sf_dir, "v1", "ts_index")


def adjacency_map_query(spark, sf_dir):
    maps = adjacency_map(derive_counted(spans_orders(spark, sf_dir), ids=ids_orders(spark, sf_dir)))
    return maps.select("parent", F.explode("children").alias("child", "call_count"))


def read_document(spark, sf_dir):
    link = F.struct("parent", "child", F.col("call_count").alias("callCount"), F.lit(1).alias("extra"))
    answers = (
        derive_counted(spans_orders(spark, sf_dir), ids=ids_orders(spark, sf_dir))
        .groupBy("parent")
        .agg(F.collect_list(link).alias("data"))
        .select(F.to_json(F.struct("data", F.lit(0).alias("total"), F.lit(None).alias("errors"))).alias("value"))
    )
    return read_result(answers)


def assert_equal_query(spark, sf_dir):
    spans = written(scan_spans(spans_orders(spark, sf_dir)), "spans")
    calls = count_calls(counted_links(spans, kinds=(SHARED, PARENT)))
    return stored_difference(written(derive_counted(repeated(spans)), "edges"), written(calls, "edges"))


def _order_trees(spark, sf_dir):
    """A tree per customer with a node per order; services are the nations."""
    sizes = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("tree_id"))
        .agg(F.count("*").alias("nodes"))
    )
    services = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("place"), F.col("n_name").alias("service")
    )
    return trees(sizes, services, branching=3)


def tree_spans_query(spark, sf_dir):
    return show_spans(tree_spans(_order_trees(spark, sf_dir)))


def tree_edges_query(spark, sf_dir):
    return tree_edges(_order_trees(spark, sf_dir))


def tree_dependencies(spark, sf_dir):
    return derive_counted(tree_spans(_order_trees(spark, sf_dir)))


def run_day_query(spark, sf_dir):
    folder = shared_folder(spark)
    spans_events(spark, sf_dir).withColumn("parent_id", F.lit(None).cast("bigint")).withColumn(
        "dt", F.to_date(F.timestamp_micros("start_time"))
    ).write.partitionBy("dt").parquet(f"{folder}/in")
    return run_day(spark, DayJob("SPAN_TABLE", f"{folder}/in", f"{folder}/out", DAY, layout="v2"))


def published_day(spark, sf_dir):
    """Published twice, the first time without the spans of later hours."""
    folder = shared_folder(spark)
    spans = spans_events(spark, sf_dir)
    spans.filter("start_time % 2 = 0").write.parquet(f"{folder}/early")
    spans.write.parquet(f"{folder}/all")
    for name in ("early", "all"):
        publish_day(spark, DayJob("span_table", f"{folder}/{name}", f"{folder}/out", DAY))
    return published_edges(spark, f"{folder}/out", DAY)


QUERIES: dict[str, Query] = {
    "day_scan": day_scan,
    "day_scan_late": day_scan_late,
    "decode_rows": decode_rows_query,
    "rejected_docs": rejected_docs_query,
    "range_scan": range_scan,
    "partition_names": partition_names,
    "source_fallback": source_fallback,
    "missing_source": missing_source,
    "sink_layout": sink_layout_query,
    "decode_spans": decode_spans,
    "decode_tags": decode_tags_query,
    "merge_tag_fields": merge_tag_fields,
    "hex_ids": hex_ids,
    "merge_refs": merge_refs_query,
    "legacy_parent": legacy_parent,
    "legacy_dependencies": legacy_dependencies,
    "norm_trace_id": norm_trace_id,
    "canonical_order": canonical_order,
    "tag_lookup": tag_lookup,
    "span_kinds": span_kinds,
    "trace_groups": trace_groups_query,
    "dedup_spans": dedup_spans_query,
    "shared_groups": shared_groups_query,
    "eligible_spans": eligible_spans_query,
    "leaf_spans": leaf_spans_query,
    "shared_links": lambda spark, sf: _kind_links(spans_orders(spark, sf), (SHARED,), ids_orders(spark, sf)),
    "shared_ties": lambda spark, sf: _kind_links(_tied_orders(spark, sf), (SHARED,), ids_orders(spark, sf)),
    "parent_links": lambda spark, sf: _kind_links(spans_orders(spark, sf), (PARENT,), ids_orders(spark, sf)),
    "peer_links": lambda spark, sf: _kind_links(spans_orders(spark, sf), (PEER,), ids_orders(spark, sf)),
    "all_links": lambda spark, sf: _kind_links(_repeated_orders(spark, sf), ids=_repeated_ids(spark, sf)),
    "all_links_conv": lambda spark, sf: _kind_links(spans_conv(spark, sf)),
    "all_links_events": lambda spark, sf: _kind_links(spans_events(spark, sf)),
    "dependencies": lambda spark, sf: derive_counted(spans_orders(spark, sf), ids=ids_orders(spark, sf)),
    "dependencies_other_tag": lambda spark, sf: derive_counted(spans_orders(spark, sf), peer_tag="span.kind", ids=ids_orders(spark, sf)),
    "stored_dependencies": stored_dependencies,
    "late_spans": late_spans,
    "day_document": day_document,
    "sink_v1": sink_v1,
    "sink_v2": sink_v2,
    "adjacency_map": adjacency_map_query,
    "read_document": read_document,
    "assert_equal": assert_equal_query,
    "tree_spans": tree_spans_query,
    "tree_edges": tree_edges_query,
    "tree_dependencies": tree_dependencies,
    "run_day": run_day_query,
    "published_day": published_day,
}
