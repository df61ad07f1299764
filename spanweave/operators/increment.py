"""Spans that arrive after a day was derived.

Links never cross traces, so a late span changes only the links of its own trace.  The touched traces are derived without
and with the late spans, and the difference is a table of signed edge counts that is added to the stored one.  The stored
spans are read once; a bitmap of the touched traces drops nearly all others in the scan stage, before any exchange.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.functions.tags import PEER_KEY
from spanweave.operators.derive import count_calls
from spanweave.operators.ordered import may_be_among
from spanweave.operators.whole import counted_links, split_traces


def touched(stored: DataFrame, late: DataFrame) -> DataFrame:
    """The stored spans of the traces that late spans belong to."""
    traces = late.select("trace_id").filter(F.col("trace_id").isNotNull()).distinct()
    known = stored.filter(F.col("trace_id").isNotNull())
    return may_be_among(known, traces, ["trace_id"]).join(traces, "trace_id", "left_semi").select(*stored.columns)


def edge_changes(stored: DataFrame, late: DataFrame, peer_tag: str = PEER_KEY) -> DataFrame:
    """parent, child, call_count: what the late spans add to each edge, or take from it.

    Late spans may repeat stored ones.  Edges that stay as they are do not appear.
    """
    before = touched(stored, late)
    after = before.unionByName(late.select(*stored.columns))
    split = split_traces(after)
    gone = counted_links(before, peer_tag, split=split.of(before)).withColumn("weight", -F.col("weight"))
    changes = count_calls(counted_links(after, peer_tag, split=split).unionAll(gone))
    return changes.filter("call_count <> 0")


def apply_changes(edges: DataFrame, changes: DataFrame) -> DataFrame:
    """The edge table with the changes; edges without calls go."""
    counted = edges.unionByName(changes).groupBy("parent", "child").agg(F.sum("call_count").alias("call_count"))
    return counted.filter("call_count <> 0")
