"""One day from stored spans to stored dependencies."""

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spanweave.functions.days import parse_day
from spanweave.functions.tags import PEER_KEY
from spanweave.operators.derive import derive
from spanweave.schema import EDGE_SCHEMA
from spanweave.sinks.records import (
    PARTS,
    clear_documents,
    day_documents,
    day_rows,
    sink_layout,
    write_documents,
    write_rows,
)
from spanweave.sources.names import NameRule
from spanweave.sources.spans import RANGE_MILLIS, first_with_rows, read_json_docs, read_span_table


@dataclass(frozen=True)
class ScanOptions:
    """What is read.

    names         partition names of the search source
    range_millis  how far back from now documents count; None reads the whole partition
    now_millis    the time `range_millis` counts from; the clock if not given
    mode          what happens to unreadable documents, see `spanweave.sources.decode`
    closed        include the first and last microsecond of the day (wide-row source)
    dt_window     days before and after the day whose `dt` folders are read (wide-row source); None reads all
    """

    names: NameRule = field(default_factory=NameRule)
    range_millis: int | None = RANGE_MILLIS
    now_millis: int | None = None
    mode: str = "required"
    closed: bool = False
    dt_window: tuple[int, int] | None = None


@dataclass(frozen=True)
class DayJob:
    """What to run.

    source    json_docs (search-store documents) or span_table (wide rows), in any case
    input     folder of the partitions, or the span table
    output    folder of the results: the edge table in edges/, the records beside it
    day       date or its text; today in UTC if not given
    layout    v2 or v1 of the wide-row records; v2 if the output holds such a table already, else v1, if not given
    label     value of the `source` field of stored links
    parts     records per day, see `spanweave.sinks.records`
    """

    source: str
    input: str
    output: str
    day: str | dt.date | None = None
    peer_tag: str = PEER_KEY
    layout: str | None = None
    label: str = "spanweave"
    parts: int = PARTS
    scan: ScanOptions = field(default_factory=ScanOptions)


def edges_path(job: DayJob, day: dt.date) -> str:
    return f"{job.output}/edges/dt={day.isoformat()}"


@dataclass(frozen=True)
class RunReport:
    """What a run saw, counted on its one pass over the source.

    documents  documents in range, before any was left out (search sources, else None)
    spans      spans read, with their copies
    null_ids   spans without a trace or span id, which no link can come from
    edges      pairs of services stored
    calls      calls of all pairs
    """

    documents: int | None
    spans: int
    null_ids: int
    edges: int
    calls: int

    @property
    def rejects(self) -> int | None:
        """Documents that permissive reading left out."""
        return None if self.documents is None else self.documents - self.spans


class _Counts:
    """Observations on the one write of a day's edges."""

    def __init__(self) -> None:
        self.documents, self.spans, self.edges = None, Observation(), Observation()

    def on_documents(self, docs: DataFrame) -> DataFrame:
        self.documents = Observation()
        return docs.observe(self.documents, F.count(F.lit(1)).alias("documents"))

    def on_spans(self, spans: DataFrame) -> DataFrame:
        null_ids = F.count_if(F.col("trace_id").isNull() | F.col("span_id").isNull())
        return spans.observe(self.spans, F.count(F.lit(1)).alias("spans"), null_ids.alias("null_ids"))

    def on_edges(self, edges: DataFrame) -> DataFrame:
        calls = F.coalesce(F.sum("call_count"), F.lit(0))
        return edges.observe(self.edges, F.count(F.lit(1)).alias("edges"), calls.alias("calls"))

    def report(self) -> RunReport:
        documents = _observed(self.documents, "documents")["documents"] if self.documents else None
        return RunReport(documents, **_observed(self.spans, "spans", "null_ids"), **_observed(self.edges, "edges", "calls"))


def _observed(observation: Observation, *names: str) -> dict[str, int]:
    try:
        return observation.get
    except Py4JJavaError:
        # There is no row of counts where Spark knew before running that the source is empty.
        return dict.fromkeys(names, 0)


#: Shuffled spans and facts take some 20 to 70 bytes each: more of them than these hold are too many for the tables of one task.
TASK_BYTES = 16 << 20


@contextmanager
def _whole_plans(spark: SparkSession) -> Iterator[None]:
    """Stages found to be empty stay in the plan meanwhile: what was observed below them would be lost with them.

    Partitions are put together up to TASK_BYTES only, so that what a task holds does not grow with the day.
    """
    rules, size = "spark.sql.adaptive.optimizer.excludedRules", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rule = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
    before = {key: spark.conf.get(key, None) for key in (rules, size)}
    spark.conf.set(rules, f"{before[rules]},{rule}" if before[rules] else rule)
    spark.conf.set(size, f"{TASK_BYTES}b")
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _store_edges(spark: SparkSession, job: DayJob, day: dt.date, spans: DataFrame, counts: _Counts) -> DataFrame:
    """Write the day's edges and read them back, so that nothing is derived twice."""
    path = edges_path(job, day)
    edges = counts.on_edges(derive(counts.on_spans(spans), job.peer_tag))
    with _whole_plans(spark):
        edges.write.mode("overwrite").parquet(path)
    return spark.read.schema(EDGE_SCHEMA).parquet(path)


def _dated(edges: DataFrame, day: dt.date) -> DataFrame:
    return edges.withColumn("dt", F.lit(day))


def _run_json_docs(spark: SparkSession, job: DayJob, day: dt.date) -> tuple[DataFrame, RunReport]:
    """The first candidate partition with links is stored; none leaves no document."""
    scan, reports = job.scan, {}

    def edges_of_candidates():
        for read_name, write_name in scan.names.candidates(day):
            counts = _Counts()
            spans = read_json_docs(
                spark, f"{job.input}/{read_name}", scan.now_millis, scan.range_millis, scan.mode, counts.on_documents
            )
            edges = _store_edges(spark, job, day, spans, counts)
            reports[write_name] = counts.report()
            yield write_name, edges

    write_name, edges = first_with_rows(edges_of_candidates())
    documents = day_documents(_dated(edges, day), job.label, job.parts)
    write_documents(documents, f"{job.output}/{write_name}")
    # An earlier run may have stored the day under another of the names, or under this one if there are no links now.
    for _, name in scan.names.candidates(day):
        if name != write_name or not reports[name].edges:
            clear_documents(spark, f"{job.output}/{name}", day.isoformat())
    return edges, reports[write_name]


def _run_span_table(spark: SparkSession, job: DayJob, day: dt.date) -> tuple[DataFrame, RunReport]:
    """A record is stored also for a day without links."""
    spans = read_span_table(spark, job.input, day, job.scan.closed, dt_window=job.scan.dt_window)
    counts = _Counts()
    edges = _store_edges(spark, job, day, spans, counts)
    layout = job.layout or sink_layout(spark, f"{job.output}/dependencies_v2")
    days = spark.range(1).select(F.lit(day).alias("dt"))
    rows = day_rows(_dated(edges, day), days, job.label, layout, job.parts)
    write_rows(rows, f"{job.output}/dependencies_{layout}")
    return edges, counts.report()


SOURCES = {"json_docs": _run_json_docs, "span_table": _run_span_table}


def run_and_report(spark: SparkSession, job: DayJob) -> tuple[DataFrame, RunReport]:
    """Run one day; its edge table, as stored, and what the run saw."""
    try:
        run = SOURCES[job.source.lower()]
    except KeyError:
        raise ValueError(f"unsupported source {job.source!r}; one of {sorted(SOURCES)}") from None
    return run(spark, job, parse_day(job.day))


def run_day(spark: SparkSession, job: DayJob) -> DataFrame:
    """Run one day and return its edge table, as stored."""
    return run_and_report(spark, job)[0]
