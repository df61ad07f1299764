"""Search-store documents and wide rows to spans."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.functions.ids import hex_to_long, is_hex, normalize_trace_id
from spanweave.functions.refs import merge_refs
from spanweave.functions.tags import merge_tags, sort_tags
from spanweave.schema import CORRUPT, LEGACY_SPAN_SCHEMA, SPAN_KEY

# required    documents without ids, or with ids or times that are no numbers, fail the job; absent
#             tags and references read as none
# strict      absent tags and references fail the job too
# permissive  documents that would fail are left out; `rejected_docs` returns them
MODES = ("required", "strict", "permissive")


def json_text(value: Column) -> Column:
    """Text of a scalar JSON value; null for null, objects and arrays."""
    return F.when(~F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)"), F.try_variant_get(value, "$", "string"))


def _flaw(raw: DataFrame, strict: bool) -> Column:
    """Why a document is no span, or null."""
    start = F.col("startTime")
    corrupt = F.lit(False)
    if CORRUPT in raw.columns:
        # The reader only parses fields that are asked for: this asks for all, so that the verdict is always the same.
        sizes = F.greatest(F.size("tags"), F.size("tag"), F.size("references"), F.expr("int(process is null)"), F.expr("int(startTimeMillis is null)"))
        corrupt = F.col(CORRUPT).isNotNull() | F.coalesce(sizes < -9, F.lit(False))
    bad_refs = F.exists(
        F.coalesce("references", F.array()), lambda r: ~is_hex(r["spanID"])
    ) | (F.col("parentSpanID").isNotNull() & ~is_hex(F.col("parentSpanID")))
    flaw = (
        F.when(corrupt, "not in the documents' format")
        .when(F.col("traceID").isNull() | F.col("spanID").isNull(), "missing traceID or spanID")
        .when(~is_hex(F.col("spanID")), "spanID is no hex number")
        .when(bad_refs, "reference is no hex number")
        .when(start.isNotNull() & start.try_cast("bigint").isNull(), "startTime is no number")
    )
    if strict:
        flaw = flaw.when(F.col("tags").isNull(), "missing tags").when(
            F.col("references").isNull(), "missing references"
        )
    return flaw


def rejected_docs(raw: DataFrame) -> DataFrame:
    """Documents that permissive decoding leaves out: text and flaw.

    The text is the line as it is where it could not be parsed, else the fields that were read.
    """
    fields = F.to_json(F.struct(*(c for c in raw.columns if c != CORRUPT)))
    text = F.coalesce(F.col(CORRUPT), fields) if CORRUPT in raw.columns else fields
    return raw.select(text.alias("text"), _flaw(raw, strict=False).alias("flaw")).filter(F.col("flaw").isNotNull())


def decode_docs(raw: DataFrame, mode: str = "required", canonical: bool = True) -> DataFrame:
    """Spans of documents in RAW_JSON_SCHEMA.

    `canonical` pads trace ids and sorts tags and references, so that copies of a span that differ
    only in order compare equal; the search sources do this, the wide-row source does not.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    flaw = _flaw(raw, mode == "strict")
    if mode == "permissive":
        raw, trace_id = raw.filter(flaw.isNull()), F.col("traceID")
    else:
        trace_id = F.when(flaw.isNull(), F.col("traceID")).otherwise(
            F.raise_error(F.concat(F.lit("document is no span: "), flaw)).cast("string")
        )
    plain = F.transform(
        "tags", lambda t: F.struct(t["key"].alias("key"), t["type"].alias("type"), json_text(t["value"]).alias("value"))
    )
    tags = merge_tags(plain, F.col("tag"))
    refs = merge_refs(F.col("parentSpanID"), F.col("references"))
    if canonical:
        trace_id, tags, refs = normalize_trace_id(trace_id), sort_tags(tags), F.sort_array(refs)
    return raw.select(
        trace_id.alias("trace_id"),
        hex_to_long(F.col("spanID")).alias("span_id"),
        F.col("startTime").try_cast("bigint").alias("start_time"),
        F.col("process.serviceName").alias("service"),
        tags.alias("tags"),
        refs.alias("refs"),
    ).select(*SPAN_KEY)


def decode_rows(rows: DataFrame) -> DataFrame:
    """Spans of a wide-row table, flat or in the store's own nested layout, with the legacy parent_id.

    The nested layout has process.service_name, tags (key, value_type, value_string) and refs (span_id).  A binary trace
    id becomes lower-case hex.  `parent_id` may be absent; another column that is missing raises, and so do null ids.
    """
    kinds = dict(rows.dtypes)
    nested = "process" in kinds
    needed = ["trace_id", "span_id", "start_time", "process" if nested else "service", "tags", "refs"]
    missing = [c for c in needed if c not in kinds]
    if missing:
        raise ValueError(f"the span table has no {', '.join(missing)}")
    trace_id = F.lower(F.hex("trace_id")) if kinds["trace_id"] == "binary" else F.col("trace_id")
    known = lambda c, name: F.when(c.isNotNull(), c).otherwise(F.raise_error(F.lit(f"a span has no {name}")))
    tags, refs = F.col("tags"), F.col("refs")
    if nested:
        tags = F.transform(
            tags,
            lambda t: F.struct(
                t["key"].alias("key"), t["value_type"].alias("vtype"), t["value_string"].alias("value")
            ),
        )
        refs = F.transform(refs, lambda r: r["span_id"])
    columns = {
        "trace_id": known(trace_id, "trace_id"),
        "span_id": known(F.col("span_id"), "span_id"),
        "start_time": F.col("start_time"),
        "service": F.col("process.service_name") if nested else F.col("service"),
        "tags": tags,
        "refs": refs,
        "parent_id": F.col("parent_id") if "parent_id" in kinds else F.lit(None),
    }
    return rows.select(*(columns[f.name].cast(f.dataType).alias(f.name) for f in LEGACY_SPAN_SCHEMA))
