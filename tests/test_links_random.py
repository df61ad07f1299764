"""The link plan against the plain walk, on small random traces full of shared ids."""

import random

import pytest

from helpers import frame, links
from walk import Span, walk

VALUES = ["client", "server", "producer", "consumer", "x", "", None]


def random_spans(seed, traces, ids=5, spans=8, services=("a", "b", "c", None), distinct_times=True):
    rnd = random.Random(seed)
    result = []
    for t in range(traces):
        # Order within an id is by time and service; spans of a walk must differ in one of them.
        times = rnd.sample(range(-1000, 1000), spans) if distinct_times else [None] * spans
        for i in range(rnd.randint(1, spans)):
            tags = tuple(
                (
                    rnd.choice(["span.kind", "span.kind", "peer.service", "foo"]),
                    rnd.choice(["string", "bool", None]),
                    rnd.choice(VALUES),
                )
                for _ in range(rnd.randint(0, 3))
            )
            one = Span(
                f"{t:04d}",
                rnd.randint(1, ids),
                times[i],
                rnd.choice(services),
                tags,
                tuple(rnd.randint(1, ids + 1) for _ in range(rnd.choice([0, 1, 1, 1, 2]))),
            )
            result += [one] * rnd.choice([1, 1, 1, 2])
    rnd.shuffle(result)
    return result


@pytest.mark.parametrize("parts", [None, 1, 7, 40])
def test_random_traces(spark, parts):
    spans = random_spans(7, 1500)
    assert links(frame(spark, spans), parts=parts) == walk(spans)


@pytest.mark.parametrize("parts", [None, 1, 50])
def test_long_shared_groups(spark, parts):
    """Many claims under one id, many of them of unknown services, spread over wide time ranges."""
    rnd = random.Random(3)
    spans = []
    for t in range(300):
        side, times = ["client", "server"], set()
        for _ in range(rnd.randint(1, 60)):
            start = rnd.choice([-1, 1]) * rnd.randrange(1 << rnd.choice([9, 17, 33, 49, 60]))
            if start in times:
                continue
            times.add(start)
            known = rnd.random() < 0.3
            value = rnd.choice(side) if rnd.random() < 0.3 else side[t % 2]
            spans.append(
                Span(
                    f"{t:04d}",
                    1,
                    start,
                    rnd.choice("abc") if known else None,
                    (("foo", "string", value),),
                    (),
                )
            )
    expected = walk(spans)
    assert sum(expected.values()) > 100
    assert links(frame(spark, spans), parts=parts) == expected


def test_one_span_id_holds_a_third(spark):
    """A hot span id, a hot parent and a hot exact copy, in one trace."""
    spans = [Span("hot", 1, 5, "root", (("span.kind", "string", "server"),), ())]
    spans += [
        Span("hot", 2, i, f"s{i % 3}", (("span.kind", "string", "client"), ("peer.service", "string", f"p{i % 50}")), (1,))
        for i in range(3000)
    ]
    spans += [Span("hot", 10 + i, i, "leaf", (), (1,)) for i in range(3000)]
    spans += [Span("hot", 9999, 1, "copy", (), (1,))] * 3000
    assert links(frame(spark, spans), parts=20) == walk(spans)
