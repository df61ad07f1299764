"""One hand-made trace per rule that is easy to get wrong."""

from collections import Counter

from helpers import frame, kind, links, span
from spanweave.operators.derive import derive
from spanweave.operators.spans import dedup_spans
from walk import walk


def check(spark, spans, expected, **options):
    got = links(frame(spark, spans, legacy=options.pop("legacy", False)), **options)
    assert got == Counter(expected)


def test_shared_client_and_server(spark):
    spans = [span(1, "web", kind("client")), span(1, "api", kind("server"))]
    check(spark, spans, {("shared", "web", "api"): 1})


def test_shared_producer_and_consumer(spark):
    spans = [span(1, "web", kind("consumer")), span(1, "api", kind("producer"))]
    check(spark, spans, {("shared", "api", "web"): 1})


def test_shared_without_kind(spark):
    check(spark, [span(1, "web", ("tag", "tag")), span(1, "api", ("tag", "tag"))], {})


def test_value_counts_under_any_key(spark):
    spans = [span(1, "web", ("foo", "client")), span(1, "api", ("bar", "server"))]
    check(spark, spans, {("shared", "web", "api"): 1})


def test_one_span_with_both_ends_links_to_itself(spark):
    check(spark, [span(1, "web", ("a", "server"), ("b", "producer"))], {("shared", "web", "web"): 1})


def test_producer_is_no_client_for_parents(spark):
    spans = [
        span(1, "root"),
        span(2, "web", kind("producer"), refs=[1]),
        span(2, "api", kind("consumer"), refs=[1]),
    ]
    check(spark, spans, {("shared", "web", "api"): 1})


def test_shared_server_leaf_has_no_peer(spark):
    spans = [
        span(1, "root"),
        span(2, "web", kind("client"), ("peer.service", "db"), refs=[1]),
        span(2, "api", kind("server"), ("peer.service", "cache"), refs=[1]),
    ]
    check(
        spark,
        spans,
        {("shared", "web", "api"): 1, ("parent", "root", "web"): 1, ("peer", "web", "db"): 1},
    )


def test_root_leaf_has_a_peer_only_in_wide_rows(spark):
    root = [span(1, "web", ("peer.service", "db"))]
    check(spark, root, {})
    check(spark, root, {("peer", "web", "db"): 1}, legacy=True)


def test_legacy_parent_joins(spark):
    spans = [span(1, "web"), span(2, "api", parent_id=1), span(3, "db", refs=[2], parent_id=2)]
    check(spark, spans, {("parent", "web", "api"): 1, ("parent", "api", "db"): 2}, legacy=True)


def test_legacy_parent_is_not_compared(spark):
    spans = [span(1, "a"), span(2, "b"), span(3, "c", parent_id=2), span(3, "c", parent_id=1)]
    check(spark, spans, {("parent", "a", "c"): 1}, legacy=True)
    assert dedup_spans(frame(spark, spans, legacy=True)).count() == 3


def test_repeated_reference_counts_twice(spark):
    check(spark, [span(1, "web"), span(2, "api", refs=[1, 1])], {("parent", "web", "api"): 2})


def test_same_service_and_self_reference_stay(spark):
    spans = [span(1, "web", refs=[1]), span(2, "web", refs=[1])]
    check(spark, spans, {("parent", "web", "web"): 2})


def test_other_trace_is_not_looked_up(spark):
    check(spark, [span(1, "web", trace="a"), span(2, "api", refs=[1], trace="b")], {})


def test_first_server_answers_and_does_not_fall_through(spark):
    child = span(2, "api", refs=[1])
    servers = [span(1, "b", kind("server"), start=2), span(1, "a", kind("server"), start=3)]
    check(spark, [*servers, child], {("parent", "b", "api"): 1})
    unknown = span(1, None, kind("server"), start=1)
    check(spark, [*servers, unknown, child], {})


def test_two_clients_last_before_the_server_counts(spark):
    spans = [
        span(1, "a", kind("client"), start=1),
        span(1, "b", kind("client"), start=2),
        span(1, "s", kind("server"), start=3),
        span(1, "c", kind("client"), start=4),
    ]
    check(spark, spans, {("shared", "b", "s"): 1})


def test_unknown_service_takes_back_a_claim(spark):
    spans = [
        span(1, "a", kind("client"), start=1),
        span(1, None, kind("client"), start=2),
        span(1, "s", kind("server"), start=3),
    ]
    check(spark, spans, {})
    check(spark, [*spans, span(1, "c", kind("client"), start=4)], {("shared", "c", "s"): 1})


def test_null_value_hides_later_tags_of_the_key(spark):
    tags = [("peer.service", "string", None), ("peer.service", "db")]
    check(spark, [span(1, "web"), span(2, "api", *tags, refs=[9])], {})


def test_empty_peer_counts_and_tag_is_a_parameter(spark):
    spans = [span(2, "api", ("peer.service", ""), ("to", "db"), refs=[9])]
    check(spark, spans, {("peer", "api", ""): 1})
    check(spark, spans, {("peer", "api", "db"): 1}, peer_tag="to")


def test_reference_from_ineligible_span_makes_no_leaf(spark):
    spans = [span(2, "api", ("peer.service", "db"), refs=[9]), span(3, None, refs=[2])]
    check(spark, spans, {})


def test_absent_tags_and_refs_read_as_empty(spark):
    df = spark.sql(
        "select 't' trace_id, 1L span_id, 0L start_time, 'web' service,"
        " cast(null as array<struct<key:string,vtype:string,value:string>>) tags,"
        " cast(null as array<bigint>) refs"
    )
    assert derive(df).count() == 0


def test_spans_differing_in_any_tag_are_two_calls(spark):
    spans = [
        span(1, "web"),
        span(2, "api", kind("client"), ("url", "/a"), refs=[1]),
        span(2, "api", kind("client"), ("url", "/b"), refs=[1]),
        span(2, "api", kind("client"), ("url", "string", None), refs=[1]),
        span(2, "api", kind("client"), ("url", None, "/a"), refs=[1]),
    ]
    check(spark, spans, {("parent", "web", "api"): 4})
    check(spark, spans * 2, {("parent", "web", "api"): 4})


def test_same_time_and_service_claims(spark):
    """The calling end is claimed first, whatever the other tags say."""
    spans = [span(1, "a", kind("client")), span(1, "a", ("x", "server")), span(1, "a", kind("server"))]
    check(spark, spans, {("shared", "a", "a"): 1})
    for value in "0123":
        spans = [
            span(1, "a", kind("client"), start=1),
            span(1, "b", kind("server"), start=2),
            span(1, "b", kind("client"), ("x", value), start=2),
        ]
        check(spark, spans, {("shared", "b", "b"): 1})


def test_walk_agrees_on_fan_out(spark):
    spans = [span(1, "S1"), span(2, "S2", refs=[1]), span(3, "S3", refs=[1])]
    expected = {("parent", "S1", "S2"): 1, ("parent", "S1", "S3"): 1}
    assert walk(spans) == Counter(expected)
    check(spark, spans, expected)
