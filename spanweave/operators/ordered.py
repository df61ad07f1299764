"""First call of a shared span id, where the order of its spans decides.

The rule is a scan: walk the spans of the id in order (start time, service, those that claim the calling end first before
the others), let every claim overwrite the last one of its end (also with an unknown service), and stop as soon as both
ends are known.

The scan is a prefix scan over range partitions of (id, time).  Each stretch of an id inside one partition is summed up
on its own: the link it holds if nothing is known before it, the called service that a calling service known before
would meet, the calling service that a called one would meet, and the last claim of either end.  What is known before a
stretch is the last claim of the stretches before it, of which an id has as many as there are range partitions at most.
So an id with any number of spans is spread over tasks, nothing is gathered in a list, and there is one plan for all
sizes.

Few ids need any of this.  Their ids go into a bitmap of a fixed size, and only claims that hit it are shuffled at all.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ID = ["trace_id", "span_id"]

# The filter holds this many words of 64 bits, at most; a crowded one lets more claims through to the exact join behind it.
FILTER_WORDS = 1 << 20

_EVENT_ORDER = ["start_time", "service", "step"]


def _place(keys: list[str]) -> tuple[str, str]:
    """Word and bit of a key.  Never null, and plainly so: Spark would infer a filter on a nullable join key, push it into
    the scan, and the readers of the spans would no longer share one exchange."""
    key = f"xxhash64({', '.join(keys)})"
    return f"shiftright({key} & {64 * FILTER_WORDS - 1}L, 6) as word", f"cast({key} & 63L as int) as bit"


def may_be_among(rows: DataFrame, ids: DataFrame, keys: list[str] = ID) -> DataFrame:
    """The rows whose keys are among the ids, and a few others.

    The ids become bits, ored on the map side; the bits are broadcast, since their number has a fixed bound.
    """
    set_bits = ids.selectExpr(*_place(keys)).selectExpr("word", "shiftleft(1L, bit) as bit")
    bits = set_bits.groupBy("word").agg(F.expr("bit_or(bit) as bits"))
    asked = rows.selectExpr("*", *_place(keys))
    return asked.join(F.broadcast(bits), "word").filter("getbit(bits, bit) = 1").select(*rows.columns)


def _events(claims: DataFrame) -> DataFrame:
    """What a service claims at one start time, one end after the other: *ID, start_time, service, step, calling.

    All claims of one service at one time carry the same service, so all that matters is which ends are claimed and which
    first: the calling end where any of the spans claims it first.
    """
    instants = claims.groupBy(*ID, "start_time", "service").agg(
        F.expr("bool_or(contains(sides, 'c')) as calling"),
        F.expr("bool_or(contains(sides, 's')) as called"),
        F.expr("bool_or(startswith(sides, 'c')) as calling_first"),
    )
    steps = "filter(if(calling_first, array(true, if(called, false, null)), array(false, if(calling, true, null))), e -> e is not null)"
    return instants.selectExpr(*ID, "start_time", "service", f"posexplode({steps}) as (step, calling)")


def _stretches(events: DataFrame, parts: int | None) -> DataFrame:
    """One row per id and range partition, see the head of the file.

    parent, child                the link if nothing was known before
    met_by_calling               called service that a calling service known before meets
    met_by_called                calling service that a called service known before meets
    last_calling, last_called    struct of the last service claimed for that end, null without a claim
    """
    by = [*ID, *_EVENT_ORDER]
    ranged = events.repartitionByRange(parts, *by) if parts else events.repartitionByRange(*by)
    running = f"over (partition by stretch, trace_id, span_id order by {', '.join(_EVENT_ORDER)} rows between unbounded preceding and current row)"
    walked = ranged.withColumn("stretch", F.spark_partition_id()).selectExpr(
        "stretch",
        *ID,
        "struct(start_time, service, step) as at",
        f"last(if(calling, struct(service as name), null), true) {running} as from_end",
        f"last(if(calling, null, struct(service as name)), true) {running} as to_end",
    )
    return walked.groupBy("stretch", *ID).agg(
        F.expr("min_by(struct(from_end.name as parent, to_end.name as child), at) filter (where from_end.name is not null and to_end.name is not null) as link"),
        F.expr("min_by(to_end.name, at) filter (where from_end is null and to_end.name is not null) as met_by_calling"),
        F.expr("min_by(from_end.name, at) filter (where to_end is null and from_end.name is not null) as met_by_called"),
        F.expr("max_by(from_end, at) as last_calling"),
        F.expr("max_by(to_end, at) as last_called"),
    )


def ordered_shared_links(claims: DataFrame, ordered: DataFrame, parts: int | None = None) -> DataFrame:
    """Shared links (parent, child, weight) of the ids in `ordered`.

    claims   trace_id, span_id, start_time, service, sides; of any id
    ordered  trace_id, span_id of the ids that need it, each once
    parts    range partitions of the scan; Spark's number of shuffle partitions if not given
    """
    # Plain exchanges on both sides: Spark splits an id with very many claims.
    asked = may_be_among(claims, ordered).join(ordered.select(*ID), ID)
    before = "over (partition by trace_id, span_id order by stretch rows between unbounded preceding and 1 preceding)"
    carried = _stretches(_events(asked), parts).selectExpr(
        "*",
        f"last(last_calling, true) {before} as calling_before",
        f"last(last_called, true) {before} as called_before",
    )
    # With one end known before, its link comes no later than the stretch's own; with both known, an earlier stretch has it.
    links = carried.selectExpr(
        *ID,
        "stretch",
        """case when calling_before.name is not null and met_by_calling is not null
                  then struct(calling_before.name as parent, met_by_calling as child)
                when called_before.name is not null and met_by_called is not null
                  then struct(met_by_called as parent, called_before.name as child)
                else link end as link""",
    )
    first = links.filter("link is not null").groupBy(*ID).agg(F.expr("min_by(link, stretch) as link"))
    return first.select("link.parent", "link.child", F.lit(1).cast("bigint").alias("weight"))
