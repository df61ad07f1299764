"""Span tables laid out by trace, so that grouping and matching by trace need no exchange when they are read.

Whole traces lie in a table bucketed by trace id and sorted by trace and span id, one file per bucket.  A trace with more
than `most` spans would make its bucket grow with it; such traces lie beside it in a plain table and are derived by the
general plan, which spreads any trace over all tasks.
"""

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.schema import SPAN_SCHEMA
from spanweave.shared import written

MOST_SPANS = 100_000
#: Spans of a bucket, on average, that a task can sort and derive.
SPANS_A_BUCKET = 250_000
#: Spark reads a table with more buckets than these as one without.
MOST_BUCKETS = 100_000


@dataclass(frozen=True)
class TraceStore:
    """Where a store lies.

    `buckets` is the least number.  A store with more than SPANS_A_BUCKET spans for each doubles it until they fit a task,
    and says in its layout how many there are.  Readers name the same least number.
    """

    path: str
    buckets: int = 200

    @property
    def table(self) -> str:
        return "spans_" + hashlib.md5(f"{self.path} {self.buckets}".encode()).hexdigest()

    @property
    def whole(self) -> str:
        return f"{self.path}/whole"

    @property
    def layout(self) -> str:
        return f"{self.path}/layout"

    @property
    def large(self) -> str:
        return f"{self.path}/large"


def write_traces(spans: DataFrame, store: TraceStore, most: int = MOST_SPANS) -> None:
    """Store the spans, replacing what the store holds.  Null trace ids lie with the large traces."""
    spark = spans.sparkSession
    sizes = written(spans.groupBy("trace_id").agg(F.count("*").alias("spans")), "trace_sizes")
    large = sizes.filter((F.col("spans") > most) & F.col("trace_id").isNotNull()).select("trace_id")
    total = sizes.agg(F.sum("spans").alias("spans")).first().spans or 0
    buckets = store.buckets
    while buckets * SPANS_A_BUCKET < total and 2 * buckets <= MOST_BUCKETS:
        buckets *= 2
    columns = SPAN_SCHEMA.fieldNames()
    whole = spans.filter(F.col("trace_id").isNotNull()).join(large, "trace_id", "left_anti").select(*columns)
    rest = spans.join(large, "trace_id", "left_semi").unionByName(spans.filter(F.col("trace_id").isNull())).select(*columns)
    rest.write.mode("overwrite").parquet(store.large)
    spark.sql(f"drop table if exists {store.table}")
    (
        whole.repartition(buckets, "trace_id")
        .write.mode("overwrite")
        .option("path", store.whole)
        .bucketBy(buckets, "trace_id")
        .sortBy("trace_id", "span_id")
        .saveAsTable(store.table)
    )
    spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").parquet(store.layout)


def read_traces(spark: SparkSession, store: TraceStore) -> tuple[DataFrame, DataFrame]:
    """(spans of whole traces, spans of large traces).  The first one keeps its layout, also in a new session."""
    buckets = spark.read.schema("buckets int").parquet(store.layout).first().buckets
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SPAN_SCHEMA.fields)
    # What this session knows of the table may be of an earlier layout.  Its files stay when it is dropped.
    spark.sql(f"drop table if exists {store.table}")
    spark.sql(
        f"create table {store.table} ({fields}) using parquet clustered by (trace_id)"
        f" sorted by (trace_id, span_id) into {buckets} buckets location '{store.whole}'"
    )
    return spark.table(store.table), spark.read.schema(SPAN_SCHEMA).parquet(store.large)
