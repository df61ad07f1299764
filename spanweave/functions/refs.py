"""Reference expressions.  References are a bag of parent span ids: duplicates count."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanweave.functions.ids import hex_to_long


def no_refs() -> Column:
    return F.array().cast("array<bigint>")


def merge_refs(parent_span_id: Column, references: Column) -> Column:
    """The old single parent first, then every listed reference, of whatever type or trace."""
    first = F.when(parent_span_id.isNotNull(), F.array(hex_to_long(parent_span_id))).otherwise(
        no_refs()
    )
    listed = F.coalesce(F.transform(references, lambda r: hex_to_long(r["spanID"])), no_refs())
    return F.concat(first, listed)


def append_parent(refs: Column, parent_id: Column) -> Column:
    """Wide-row spans always get one more reference, a null one when there is no parent."""
    return F.concat(F.coalesce(refs, no_refs()), F.array(parent_id))


def ref_text(refs: Column) -> Column:
    return F.array_join(F.transform(refs, lambda r: r.cast("string")), ",", "null")
