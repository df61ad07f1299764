"""Links of traces that lie together: every step groups by trace, so a table bucketed by trace is never exchanged, and any
other is exchanged once.

The rules are those of `derive`, in another shape.  A span id meets what refers to it in a window over (trace, id), not
in a join, and the order of a shared id is that of the window that drops its copies.  Windows hold the spans of one id of one trace at once.  A store
bounds them (`spanweave.sinks.traces`); for other spans `split_traces` counts first and leaves large traces to `derive`.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.functions.tags import PEER_KEY
from spanweave.operators.derive import KINDS, PARENT, PEER, SHARED, all_links, count_calls
from spanweave.operators.groups import MAY_BE_CALLED, leaf_spans, shared_groups
from spanweave.operators.spans import narrow_spans, scan_spans, trace_groups, with_legacy_parent

# Spans are counted per place, a hash of the trace id.  A place that holds many more than others has a large trace.
PLACES = 1 << 12
MOST_SPANS = 100_000
#: Spans that one task is to hold, and the least for which a task of its own pays.
SPANS_A_TASK = 250_000
LEAST_SPANS_A_TASK = 10_000

# Ids begin with the same digits as often as not, so rows are sorted by a hash of the trace first.  Functions of a window share
# its order and few frames: a group is a span or two, and each frame of it costs as much as a sort of its rows.
_ALL = "rows between unbounded preceding and unbounded following"
_BEFORE = "rows between unbounded preceding and 1 preceding"
_ID = "partition by mark, trace_id, id"


def _grouped(scanned: DataFrame, linked: bool = False) -> DataFrame:
    """Spans, copies one after the other, and what their group says.  Spans of an id are equal if their digests are.

    `link`, if asked for, is the shared link that a span completes, from what the spans before it claim.  A copy completes
    none that the first one did not, and the link of the id is that of the least `nth`.
    """
    # The smallest legacy parent id stays, as in `narrow_spans`.
    legacy = ["parent_id nulls last"] if "parent_id" in scanned.columns else []
    keys = ["start_time", "service", "sides", "digest"] if linked else ["digest"]
    order = f"partition by mark, trace_id, span_id order by {', '.join(keys + legacy)}"
    group, before = f"over ({order} {_ALL})", f"over ({order} {_BEFORE})"
    columns = [
        f"last(digest) {before} as digest_before",
        f"min(digest) {group} = max(digest) {group} as alone",
        f"min(case when server then struct(start_time, service) end) {group}.service as first_server",
    ]
    if linked:
        columns += [
            f"count(*) {before} as nth",
            f"last(if(contains(sides, 'c'), struct(service as name), null), true) {before}.name as calling",
            f"last(if(contains(sides, 's'), struct(service as name), null), true) {before}.name as called",
        ]
    grouped = scanned.withColumn("mark", F.xxhash64("trace_id")).selectExpr("*", *columns)
    if linked:
        grouped = grouped.selectExpr(
            "* except (calling, called)",
            """case when service is null then null
                    when sides = 'c' then if(called is null, null, struct(service as parent, called as child))
                    when sides = 's' then if(calling is null, null, struct(calling as parent, service as child))
                    when sides = 'cs' then struct(service as parent, coalesce(called, service) as child)
                    when sides = 'sc' then struct(coalesce(calling, service) as parent, service as child) end as link""",
        )
    return with_legacy_parent(grouped) if legacy else grouped


def _firsts(grouped: DataFrame) -> DataFrame:
    """Of copies the first."""
    return grouped.filter("digest_before is null or digest_before <> digest")


def _judged(scanned: DataFrame, linked: bool = False) -> DataFrame:
    """Distinct spans and their part in links."""
    return _firsts(_grouped(scanned, linked)).selectExpr(
        "mark", "trace_id", "span_id", "service", "peer", "refs",
        "if(alone, service, first_server) as answers",
        f"{MAY_BE_CALLED} and (alone or client) as open",
        *(["link", "nth"] if linked else []),
    )


def _links(scanned: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """kind, parent, child of spans, with their copies, that lie together by trace."""
    judged = _judged(scanned, SHARED in kinds)
    if PARENT not in kinds and PEER not in kinds:
        first = judged.filter("link is not null").groupBy("mark", "trace_id", "span_id").agg(F.min_by("link", "nth").alias("link"))
        return first.select(F.lit(SHARED).alias("kind"), "link.parent", "link.child")
    # A span about its own id, about each id it refers to, and, with a link, about its id once more.
    refs = "refs" if PEER in kinds else "if(open, refs, array())"
    link, of_link = ", if(link is null, array(), array(span_id))", ["nth", "link.parent as linked_parent", "link.child as linked_child"]
    if SHARED not in kinds:
        link, of_link = "", ["null as linked_parent", "null as linked_child"]
    told = judged.withColumn("told", F.expr(refs)).selectExpr("*", f"posexplode(concat(array(span_id), told{link})) as (at, id)")
    told = told.filter("id is not null").selectExpr(
        "mark", "trace_id", "id", "service", *of_link,
        "if(at = 0, 'own', if(at <= size(told), 'refers', 'link')) as role",
        "open and (at > 0 or peer is not null) as open",
        "if(at = 0, answers, null) as answers",
        "if(at = 0, peer, null) as peer",
    )
    about = [f"max(answers) over ({_ID}) as answer"]
    found = []
    if PARENT in kinds:
        found.append(f"when role = 'refers' and open and answer is not null then '{PARENT}'")
    if PEER in kinds:
        about.append(f"bool_or(role = 'refers') over ({_ID}) as referred")
        found.append(f"when role = 'own' and open and not referred then '{PEER}'")
    if SHARED in kinds:
        about.append(f"min(if(role = 'link', nth, null)) over ({_ID}) as first_nth")
        found.append(f"when role = 'link' and nth = first_nth then '{SHARED}'")
    return told.selectExpr("*", *about).selectExpr(
        f"case {' '.join(found)} end as kind",
        "case role when 'own' then service when 'refers' then answer else linked_parent end as parent",
        "case role when 'own' then peer when 'refers' then service else linked_child end as child",
    ).filter("kind is not null")


def whole_trace_links(spans: DataFrame, peer_tag: str = PEER_KEY, kinds: tuple[str, ...] = KINDS, parts: int | None = None) -> DataFrame:
    """The bag of links of traces that lie together, or are dealt over `parts` first: kind, parent, child, weight."""
    scanned = scan_spans(spans, peer_tag)
    if parts is not None:
        scanned = scanned.repartition(parts, "trace_id")
    return _links(scanned, kinds).withColumn("weight", F.lit(1).cast("bigint"))


def derive_stored(whole: DataFrame, large: DataFrame, peer_tag: str = PEER_KEY) -> DataFrame:
    """Service dependencies of a trace store: parent, child, call_count.

    Whole traces are exchanged by edge only, as partial counts.
    """
    return count_calls(whole_trace_links(whole, peer_tag).unionAll(all_links(large, peer_tag)))


def _place() -> Column:
    return F.pmod(F.xxhash64(F.lit(1), "trace_id"), F.lit(PLACES))


@dataclass(frozen=True)
class TraceSplit:
    """Spans of traces that a task may hold whole, the spans of other traces (None without any), and partitions for the first."""

    whole: DataFrame
    large: DataFrame | None
    parts: int
    crowded: tuple[int, ...] = ()

    def of(self, spans: DataFrame) -> "TraceSplit":
        """Other spans of the same traces, no more of them, split alike."""
        return _split(spans, self.crowded, self.parts)


def _split(spans: DataFrame, crowded: tuple[int, ...], parts: int) -> TraceSplit:
    if not crowded:
        return TraceSplit(spans, None, parts)
    large = _place().isin(list(crowded))
    return TraceSplit(spans.filter(~large), spans.filter(large), parts, crowded)


def split_traces(spans: DataFrame, most: int | None = None, ids: DataFrame | None = None) -> TraceSplit:
    """Counts the spans per place, in a pass of its own that exchanges PLACES counts, and splits them.

    A place with more than `most` spans above four times the mean counts as large, with all traces in it, so none of the
    other traces has more.

    `ids` are counted in place of the spans, where the spans themselves take joins to find: rows with a trace_id, at least as
    often as the spans have it.  They decide how the work is dealt, not what it finds.
    """
    most = MOST_SPANS if most is None else most
    counts = (spans if ids is None else ids).filter("trace_id is not null").groupBy(_place().alias("place")).agg(F.count("*").alias("spans")).collect()
    total = sum(c.spans for c in counts)
    crowded = tuple(c.place for c in counts if c.spans > most + 4 * total // PLACES)
    least = min(spans.sparkSession.sparkContext.defaultParallelism, total // LEAST_SPANS_A_TASK + 1)
    return _split(spans, crowded, max(least, total // SPANS_A_TASK + 1))


def counted_links(
    spans: DataFrame,
    peer_tag: str = PEER_KEY,
    kinds: tuple[str, ...] = KINDS,
    split: TraceSplit | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """As `all_links`, for spans that are cheap to read again: counted first, then exchanged once, large traces apart."""
    split = split or split_traces(spans, ids=ids)
    links = whole_trace_links(split.whole, peer_tag, kinds, split.parts)
    return links if split.large is None else links.unionAll(all_links(split.large, peer_tag, kinds))


def derive_counted(spans: DataFrame, peer_tag: str = PEER_KEY, ids: DataFrame | None = None) -> DataFrame:
    """As `derive`, for spans that are cheap to read again, or whose `ids` are; see `split_traces`."""
    return count_calls(counted_links(spans, peer_tag, ids=ids))


def _dealt(split: TraceSplit, peer_tag: str = PEER_KEY) -> DataFrame:
    return scan_spans(split.whole, peer_tag).repartition(split.parts, "trace_id")


def counted_groups(spans: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """As `shared_groups` of the narrowed spans, for spans that are cheap to read again."""
    split = split_traces(spans, ids=ids)
    groups = _firsts(_grouped(_dealt(split))).groupBy("mark", "trace_id", "span_id").agg(
        F.count("*").alias("n"),
        F.expr("if(count(*) = 1, min(service), min(case when server then struct(start_time, service) end).service)").alias("parent_service"),
    ).drop("mark")
    return groups if split.large is None else groups.unionByName(shared_groups(narrow_spans(split.large)))


def counted_leaves(spans: DataFrame, peer_tag: str = PEER_KEY, ids: DataFrame | None = None) -> DataFrame:
    """As `leaf_spans` of the narrowed spans, for spans that are cheap to read again."""
    split = split_traces(spans, ids=ids)
    about = _judged(_dealt(split, peer_tag)).selectExpr(
        "mark", "trace_id", "service", "if(open, refs, null) as refs", "peer", "posexplode(concat(array(span_id), refs)) as (at, id)"
    )
    told = about.filter("id is not null").selectExpr("*", f"bool_or(at > 0) over ({_ID}) as referred")
    leaves = told.filter("at = 0 and refs is not null and not referred").selectExpr("trace_id", "id as span_id", "service", "refs", "peer")
    return leaves if split.large is None else leaves.unionByName(leaf_spans(narrow_spans(split.large, peer_tag)))


def counted_traces(spans: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """As `trace_groups`, for spans that are cheap to read again.  A digest stands in for the tags and references."""
    split = split_traces(spans, ids=ids)
    whole = split.whole.filter("trace_id is not null").selectExpr(
        "trace_id", "span_id", "service", "start_time", "unhex(sha2(to_json(struct(start_time, service, tags, refs)), 256)) as digest"
    )
    dealt = whole.repartition(split.parts, "trace_id").withColumn("mark", F.xxhash64("trace_id"))
    in_id = "over (partition by mark, trace_id, span_id order by digest)"
    firsts = dealt.selectExpr("*", f"row_number() {in_id} as nth", f"lag(digest) {in_id} as digest_before").selectExpr(
        "mark", "trace_id", "service", "start_time",
        "nth = 1 or digest <> digest_before as new_span",
        "nth = 1 and span_id is not null as new_id",
    ).selectExpr(
        "*", "service is not null and row_number() over (partition by mark, trace_id, service order by start_time) = 1 as new_service"
    )
    groups = firsts.groupBy("trace_id").agg(
        F.count("*").alias("spans"),
        F.count_if("new_span").alias("distinct_spans"),
        F.count_if("new_id").alias("span_ids"),
        F.count_if("new_service").alias("services"),
        F.min("start_time").alias("first_start"),
        F.max("start_time").alias("last_start"),
    )
    return groups if split.large is None else groups.unionByName(trace_groups(split.large))
