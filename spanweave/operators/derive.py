"""Links between services, and their counts.

The plan, from spans to edges:

    distinct spans -> id groups ---+
          |                        |
          +-------> facts <--------+      (what a span or group states about one id, counted)
          |           |
          |      match facts on (trace_id, id)      -> parent, peer and plain shared links
          +-----> claims of ids that need ordering  -> remaining shared links (a filter of these ids, then a prefix scan)

A trace is never gathered and no column holds more than a span's own tags and references.  Facts
are counted per service before they are matched, so an id referred to by a large part of all spans
meets its parent as one row per calling service.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.functions.tags import PEER_KEY
from spanweave.operators.groups import (
    ANSWERS,
    MAY_BE_CALLED,
    NEEDS_ORDERING,
    PLAIN_LINK,
    id_groups,
)
from spanweave.operators.ordered import ordered_shared_links
from spanweave.operators.spans import narrow_spans

SHARED = "shared"
PARENT = "parent"
PEER = "peer"
KINDS = (SHARED, PARENT, PEER)

# Roles of a fact about an id.
CALL = "call"  # an eligible span of `service` refers to the id
ANSWER = "answer"  # `service` answers for the id
SEEN = "seen"  # some span refers to the id
LEAF = "leaf"  # an eligible span of `service` with the id names the peer `other`
LINK = "link"  # finished link service -> other, about no id
ORDER = "order"  # the shared link of the id depends on the order of its claims

# A call meets the answer, and a leaf candidate meets the sighting that rules it out.
_WAITING = {ANSWER: "a", LEAF: "l", LINK: "x"}
_ARRIVING = {CALL: "a", SEEN: "l"}



def _fact(condition: str, role: str, about: str = "0L", service: str = "null", other: str = "null") -> str:
    """A fact where the condition holds, else null."""
    return (
        f"case when {condition} then struct('{role}' as role, {about} as id,"
        f" cast({service} as string) as service, cast({other} as string) as other) end"
    )


def _explode_facts(df: DataFrame, facts: list[str]) -> DataFrame:
    # Outer form, nulls dropped behind it: the plain form would infer a filter on its input, and the
    # readers of `df` would no longer share one exchange.  For the same reason the keys are made
    # plainly non-null, which they are.
    return (
        df.selectExpr("trace_id", f"explode_outer(array({', '.join(facts)})) as fact")
        .filter("fact.id is not null")
        .selectExpr(
            f"if(fact.role = '{LINK}', '', coalesce(trace_id, '')) as trace_id",
            "coalesce(fact.role, '') as role",
            "coalesce(fact.id, 0L) as id",
            "fact.service",
            "fact.other",
        )
    )


# Facts about a span or group itself are stated with its first reference, or without any.
_FIRST = "coalesce(at, 0) = 0"


def _span_facts(narrow: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    per_ref = narrow.selectExpr(
        "trace_id",
        "span_id",
        "service",
        "peer",
        f"client and {MAY_BE_CALLED} as open",
        "posexplode_outer(refs) as (at, ref)",
    )
    facts = []
    if PARENT in kinds:
        facts.append(_fact("open and ref is not null", CALL, "ref", "service"))
    if PEER in kinds:
        facts.append(_fact("ref is not null", SEEN, "ref"))
        facts.append(
            _fact(f"open and peer is not null and {_FIRST}", LEAF, "span_id", "service", "peer")
        )
    return _explode_facts(per_ref, facts)


def _group_facts(groups: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    per_ref = groups.selectExpr(
        "trace_id",
        "span_id",
        "only_service as service",
        "if(n = 1, only_open.peer, null) as peer",
        f"{ANSWERS} as answers",
        f"{PLAIN_LINK} as linked",
        "calling_service",
        "called_service",
        f"{NEEDS_ORDERING} as unordered",
        "posexplode_outer(if(n = 1, only_open.refs, null)) as (at, ref)",
    )
    facts = []
    if SHARED in kinds:
        facts.append(
            _fact(f"linked and {_FIRST}", LINK, service="calling_service", other="called_service")
        )
        facts.append(_fact(f"unordered and {_FIRST}", ORDER, "span_id"))
    if PARENT in kinds:
        facts.append(_fact("ref is not null", CALL, "ref", "service"))
        facts.append(_fact(f"answers is not null and {_FIRST}", ANSWER, "span_id", "answers"))
    if PEER in kinds:
        facts.append(_fact(f"peer is not null and {_FIRST}", LEAF, "span_id", "service", "peer"))
    return _explode_facts(per_ref, facts)


def _facts(narrow: DataFrame, groups: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Facts with their multiplicity `weight`: trace_id, role, id, service, other, weight."""
    facts = _group_facts(groups, kinds)
    if PARENT in kinds or PEER in kinds:
        facts = _span_facts(narrow, kinds).unionAll(facts)
    return facts.groupBy("trace_id", "role", "id", "service", "other").agg(
        F.count("*").alias("weight")
    )


def _with_roles(facts: DataFrame, *roles: str) -> DataFrame:
    # The condition reads the weight too, so it stays above the exchange of the facts and all readers
    # of the facts reuse it.
    listed = ", ".join(f"'{role}'" for role in roles)
    return facts.filter(f"cast(role in ({listed}) as bigint) * weight > 0")


def _matched_links(facts: DataFrame) -> DataFrame:
    """A call meets the service that answers, a leaf candidate the sighting that rules it out."""
    waiting = _with_roles(facts, ANSWER, LEAF, LINK).selectExpr("*", f"role = '{ANSWER}' as by_call")
    arriving = _with_roles(facts, CALL, SEEN).selectExpr(
        "trace_id", "id", f"role = '{CALL}' as by_call", "service as caller", "weight as calls"
    )
    return (
        waiting.join(arriving, ["trace_id", "id", "by_call"], "left")
        .selectExpr(
            f"""case when role = '{LINK}' then '{SHARED}'
                     when role = '{ANSWER}' and calls is not null then '{PARENT}'
                     when role = '{LEAF}' and calls is null then '{PEER}' end as kind""",
            "service as parent",
            "if(by_call, caller, other) as child",
            "if(by_call, calls, weight) as weight",
        )
        .filter("kind is not null")
    )


def _claims(narrow: DataFrame) -> DataFrame:
    claim = "case when sides <> '' then array(struct(start_time, service, sides)) end"
    return (
        narrow.selectExpr("trace_id", "span_id", f"explode_outer({claim}) as claim")
        .filter("claim.sides is not null")
        .select("trace_id", "span_id", "claim.*")
    )


def links_of(
    narrow: DataFrame, kinds: tuple[str, ...] = KINDS, parts: int | None = None
) -> DataFrame:
    """Links of narrowed spans: kind, parent, child and how often (`weight`)."""
    facts = _facts(narrow, id_groups(narrow), kinds)
    links = _matched_links(facts)
    if SHARED in kinds:
        ordered = _with_roles(facts, ORDER).select("trace_id", F.col("id").alias("span_id"))
        rest = ordered_shared_links(_claims(narrow), ordered, parts)
        links = links.unionAll(rest.select(F.lit(SHARED).alias("kind"), "parent", "child", "weight"))
    return links


def all_links(
    spans: DataFrame,
    peer_tag: str = PEER_KEY,
    kinds: tuple[str, ...] = KINDS,
    parts: int | None = None,
) -> DataFrame:
    """The bag of links of all traces: kind, parent, child, weight.

    `weight` is a row's multiplicity in the bag; equal links may still come in several rows.  `parts` is the number of
    range partitions in which claims are put in order.
    """
    return links_of(narrow_spans(spans, peer_tag), kinds, parts)


def count_calls(links: DataFrame) -> DataFrame:
    """Edge table: calls per pair of services."""
    return links.groupBy("parent", "child").agg(F.sum("weight").alias("call_count"))


def derive(spans: DataFrame, peer_tag: str = PEER_KEY) -> DataFrame:
    """Service dependencies of all traces: parent, child, call_count."""
    return count_calls(all_links(spans, peer_tag))
