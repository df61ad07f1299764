"""Link rules as a plain walk over one trace at a time, to compare the Spark plan with."""

from collections import Counter, defaultdict
from typing import NamedTuple


class Span(NamedTuple):
    trace_id: str
    span_id: int
    start_time: int | None
    service: str | None
    tags: tuple  # of (key, vtype, value)
    refs: tuple
    parent_id: int | None = None


def _first_value(span, key):
    return next((v for k, _, v in span.tags if k == key), None)


def _place(span):
    return (
        (span.start_time is not None, span.start_time or 0),
        (span.service is not None, span.service or ""),
    )


def walk(spans, peer_tag="peer.service"):
    """Counter of (kind, parent, child)."""
    traces = defaultdict(set)
    for span in spans:
        traces[span.trace_id].add(span)
    found = Counter()
    for trace in traces.values():
        by_id, referred = defaultdict(list), set()
        for span in sorted(trace, key=_place):
            by_id[span.span_id].append(span)
            referred.update(span.refs)
        for group in by_id.values():
            client = server = None
            for _, _, value, service in [(*t, s.service) for s in group for t in s.tags]:
                if value in ("client", "producer"):
                    client = service
                elif value in ("server", "consumer"):
                    server = service
                if client is not None and server is not None:
                    found["shared", client, server] += 1
                    break
        for span in trace:
            if not span.refs or span.service is None:
                continue
            if len(by_id[span.span_id]) > 1 and _first_value(span, "span.kind") != "client":
                continue
            for ref in span.refs:
                parents = by_id.get(ref, []) if ref is not None else []
                if len(parents) > 1:
                    parents = [p for p in parents if _first_value(p, "span.kind") == "server"]
                if parents and parents[0].service is not None:
                    found["parent", parents[0].service, span.service] += 1
            peer = _first_value(span, peer_tag)
            if span.span_id not in referred and peer is not None:
                found["peer", span.service, peer] += 1
    return found
