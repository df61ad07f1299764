"""Column layouts.  Nothing is inferred: every reader and writer uses these."""

from pyspark.sql import types as T

TAG = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("vtype", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

# One row per span.  `refs` is a bag of parent span ids, `start_time` is in microseconds.
SPAN_SCHEMA = T.StructType(
    [
        T.StructField("trace_id", T.StringType()),
        T.StructField("span_id", T.LongType()),
        T.StructField("start_time", T.LongType()),
        T.StructField("service", T.StringType()),
        T.StructField("tags", T.ArrayType(TAG)),
        T.StructField("refs", T.ArrayType(T.LongType())),
    ]
)

# Wide-row span tables also carry the parent id of old writers.
LEGACY_SPAN_SCHEMA = T.StructType(SPAN_SCHEMA.fields + [T.StructField("parent_id", T.LongType())])

# The six columns that make two spans the same span.
SPAN_KEY = SPAN_SCHEMA.fieldNames()

# Search-store documents, as written by the tracing backend.  `startTime` is read as text, so that
# both a JSON number and a quoted number are accepted; a tag's value may be of any JSON type.
RAW_JSON_SCHEMA = T.StructType(
    [
        T.StructField("traceID", T.StringType()),
        T.StructField("spanID", T.StringType()),
        T.StructField("parentSpanID", T.StringType()),
        T.StructField("startTime", T.StringType()),
        T.StructField("startTimeMillis", T.LongType()),
        T.StructField("process", T.StructType([T.StructField("serviceName", T.StringType())])),
        T.StructField(
            "tags",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("key", T.StringType()),
                        T.StructField("type", T.StringType()),
                        T.StructField("value", T.VariantType()),
                    ]
                )
            ),
        ),
        T.StructField("tag", T.MapType(T.StringType(), T.StringType())),
        T.StructField(
            "references", T.ArrayType(T.StructType([T.StructField("spanID", T.StringType())]))
        ),
    ]
)

# Column that permissive reading adds: the line, where it or one of its fields could not be parsed.
CORRUPT = "_corrupt_record"

# Edge table: the result of a run.
EDGE_SCHEMA = T.StructType(
    [
        T.StructField("parent", T.StringType()),
        T.StructField("child", T.StringType()),
        T.StructField("call_count", T.LongType()),
    ]
)

# Stored documents name the same fields differently.
LINK_JSON = T.StructType(
    [
        T.StructField("parent", T.StringType()),
        T.StructField("child", T.StringType()),
        T.StructField("callCount", T.LongType()),
        T.StructField("source", T.StringType()),
    ]
)

DAY_DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("dependencies", T.ArrayType(LINK_JSON)),
        T.StructField("timestamp", T.StringType()),
    ]
)

# Answer of the query service: links under `data`, `errors` null when all went well.
RESULT_SCHEMA = T.StructType(
    [
        T.StructField("data", T.ArrayType(LINK_JSON)),
        T.StructField("errors", T.StringType()),
    ]
)
