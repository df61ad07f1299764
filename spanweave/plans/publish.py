"""Days that are published whole.

A run writes everything into a folder of its own, `runs/<run>`, and touches nothing else.  Only when all of it is written
does it add one row (place, run) to the day's marker; the row with the highest place says which run readers follow.  The
row is one file, which the store shows whole or not at all, so at any moment a reader finds the old day or the new one.
A run that fails leaves a folder that no marker names.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.functions.days import parse_day
from spanweave.plans.day import DayJob, RunReport, edges_path, run_and_report
from spanweave.schema import EDGE_SCHEMA
from spanweave.shared import exists
from spanweave.sinks.records import sink_layout

MARKER = "place long, run string"


def _marker(output: str, day: dt.date) -> str:
    return f"{output}/published/dt={day.isoformat()}"


def _latest(spark: SparkSession, output: str, day: dt.date) -> tuple[int, str | None]:
    marker = _marker(output, day)
    if not exists(spark, marker):
        return 0, None
    row = spark.read.schema(MARKER).parquet(marker).agg(F.max(F.struct("place", "run")).alias("last")).first()
    return (row.last.place, row.last.run) if row.last else (0, None)


def published_folder(spark: SparkSession, output: str, day: str | dt.date) -> str | None:
    """The folder of the run that readers of the day follow; None where the day was never published."""
    run = _latest(spark, output, parse_day(day))[1]
    return run and f"{output}/runs/{run}"


def published_edges(spark: SparkSession, output: str, day: str | dt.date) -> DataFrame:
    """The published edge table of the day; empty where there is none."""
    day = parse_day(day)
    folder = published_folder(spark, output, day)
    if folder is None:
        return spark.createDataFrame([], EDGE_SCHEMA)
    return spark.read.schema(EDGE_SCHEMA).parquet(edges_path(DayJob("", "", folder), day))


def publish_day(spark: SparkSession, job: DayJob) -> tuple[DataFrame, RunReport]:
    """Run one day and publish it: records and edges as `run_day` stores them, under the folder of the run.

    Of runs of a day that overlap, the later marker counts, with equal places the run of the larger name.  Without a layout
    the job keeps that of the day's published run, else of a table in the output itself.
    """
    day = parse_day(job.day)
    place, last = _latest(spark, job.output, day)
    run = f"{day.isoformat()}-{uuid.uuid4().hex}"
    layout = job.layout
    if layout is None and job.source.lower() == "span_table":
        roots = ([f"{job.output}/runs/{last}"] if last else []) + [job.output]
        layout = "v2" if any(sink_layout(spark, f"{root}/dependencies_v2") == "v2" for root in roots) else "v1"
    staged = replace(job, output=f"{job.output}/runs/{run}", day=day, layout=layout)
    edges, report = run_and_report(spark, staged)
    row = spark.range(1).select(F.lit(place + 1).cast("long").alias("place"), F.lit(run).alias("run"))
    row.coalesce(1).write.mode("append").parquet(_marker(job.output, day))
    return edges, report
