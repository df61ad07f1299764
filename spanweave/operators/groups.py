"""Groups of spans that share one id inside a trace.

Everything here is an aggregate over (trace_id, span_id) that combines on the map side, so one id
used by a large part of all spans is as cheap as any other.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# A span can have an incoming call only with references and a known service.
MAY_BE_CALLED = "(size(refs) > 0 and service is not null)"

# Service that answers for a span id when another span refers to it.
ANSWERS = "case when n = 1 then only_service else first_server end"

_ONE_EACH = "(n_calling = 1 and n_called = 1)"

# Groups whose shared link depends on the order of their spans: both ends are claimed, and not just
# by one calling and one called span or by one span alone.
NEEDS_ORDERING = f"(n_calling > 0 and n_called > 0 and not ({_ONE_EACH} and n_both <= 1))"

# The other groups with both ends have a link if both services are known.
PLAIN_LINK = f"({_ONE_EACH} and calling_service is not null and called_service is not null)"

_GROUP = [
    "count(*) as n",
    "count_if(contains(sides, 'c')) as n_calling",
    "count_if(contains(sides, 's')) as n_called",
    "count_if(length(sides) = 2) as n_both",
    "min(case when contains(sides, 'c') then service end) as calling_service",
    "min(case when contains(sides, 's') then service end) as called_service",
    "first(service) as only_service",
    f"first(case when not client and {MAY_BE_CALLED} then struct(refs, peer) end, true) as only_open",
    "min(case when server then struct(start_time, service) end).service as first_server",
]


def id_groups(narrow: DataFrame) -> DataFrame:
    """One row per (trace_id, span_id) with what the link rules ask of the group.

    n                   distinct spans
    n_calling, n_called spans claiming the calling, the called end of a call; n_both both ends
    calling_service,    smallest service on either end; exact where one span claims that end
    called_service
    only_service        service of the span, meaningful for n = 1
    only_open           references and peer of the span if it may have callers and is not a client,
                        for n = 1 (client spans are eligible in any group)
    first_server        service of the first server span by start time, then service, nulls first
    """
    return narrow.groupBy("trace_id", "span_id").agg(*map(F.expr, _GROUP))


def shared_groups(narrow: DataFrame) -> DataFrame:
    """Every span id with its number of distinct spans and the service that answers for it."""
    return id_groups(narrow).selectExpr(
        "trace_id", "span_id", "n", f"{ANSWERS} as parent_service"
    )


def eligible_spans(narrow: DataFrame) -> DataFrame:
    """Spans that take part in parent and peer links.

    They have references and a service, and are either alone under their id or client spans: of a
    shared id only the client side is the caller's child.
    """
    # Outer forms, here and below: Spark would push a plain filter into the scan, and the branches would each scan again
    # and not share the exchange of the distinct spans.
    client = f"case when client and {MAY_BE_CALLED} then array(struct(service, refs, peer)) end"
    clients = (
        narrow.selectExpr("trace_id", "span_id", f"explode_outer({client}) as span")
        .filter("span.service is not null")
        .select("trace_id", "span_id", "span.*")
    )
    alone = (
        id_groups(narrow)
        .filter("n = 1 and only_open is not null")
        .selectExpr("trace_id", "span_id", "only_service as service", "only_open.refs", "only_open.peer")
    )
    return clients.unionAll(alone)


def leaf_spans(narrow: DataFrame) -> DataFrame:
    """Eligible spans whose id no span of the trace refers to, eligible or not."""
    referred = (
        narrow.select("trace_id", F.explode_outer("refs").alias("span_id"))
        .filter(F.col("span_id").isNotNull())
        .distinct()
    )
    return eligible_spans(narrow).join(referred, ["trace_id", "span_id"], "left_anti")
