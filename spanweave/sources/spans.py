"""Span readers over files: wide-row span tables and search-store documents."""

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.functions.days import in_day
from spanweave.schema import CORRUPT, LEGACY_SPAN_SCHEMA, RAW_JSON_SCHEMA, SPAN_SCHEMA
from spanweave.shared import exists, names_nothing
from spanweave.sources.decode import decode_docs, decode_rows

RANGE_MILLIS = 24 * 3600 * 1000


def or_empty(read: Callable[[], DataFrame], spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A source that does not exist reads as empty; any other failure to read it stays one."""
    try:
        return read()
    except (AnalysisException, IllegalArgumentException) as error:
        if not names_nothing(spark, path, error):
            raise
        return spark.createDataFrame([], schema)


def _folders(spark: SparkSession, path: str, day: dt.date, window: tuple[int, int]) -> list[str]:
    days = [day + dt.timedelta(days=n) for n in range(-window[0], window[1] + 1)]
    return [f for f in (f"{path}/dt={d.isoformat()}" for d in days) if exists(spark, f)]


def read_span_table(
    spark: SparkSession,
    path: str,
    day: dt.date | None = None,
    closed: bool = False,
    legacy_parent: bool = True,
    fmt: str = "parquet",
    dt_window: tuple[int, int] | None = None,
) -> DataFrame:
    """Spans of a wide-row table (see `decode_rows`), of one day if given.

    The day becomes plain bounds on start_time, which the file reader gets as pushed filters.  Where the table is
    partitioned by `dt`, dt_window (days before, days after) says how far a span's folder may be from its own day: only
    those folders are listed and read.  Without it all are, since `dt` may be a span's date of arrival.
    `legacy_parent` keeps the parent id, to be appended to the references.
    """
    schema = LEGACY_SPAN_SCHEMA if legacy_parent else SPAN_SCHEMA
    reader = spark.read.format(fmt)
    if dt_window is not None and day is not None:
        folders = _folders(spark, path, day, dt_window)
        if not folders:
            every = or_empty(lambda: reader.load(path), spark, path, LEGACY_SPAN_SCHEMA)
            if every.inputFiles() and "dt" not in every.columns:
                raise ValueError(f"dt_window needs a table with dt= folders, and {path} has none")
            return spark.createDataFrame([], schema)
        rows = reader.option("basePath", path).load(folders)
    else:
        rows = or_empty(lambda: reader.load(path), spark, path, LEGACY_SPAN_SCHEMA)
    if day is not None:
        rows = rows.filter(in_day(F.col("start_time"), day, closed))
    return decode_rows(rows).select(*schema.fieldNames())


def read_docs(spark: SparkSession, path: str, mode: str = "required") -> DataFrame:
    """Raw documents, one JSON object per line; unknown fields are ignored."""
    schema, reader = RAW_JSON_SCHEMA, "FAILFAST"
    if mode == "permissive":
        schema, reader = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]), "PERMISSIVE"
    read = spark.read.schema(schema).option("mode", reader).option("columnNameOfCorruptRecord", CORRUPT)
    return or_empty(lambda: read.json(path), spark, path, schema)


def in_range(now_millis: int | None, range_millis: int | None):
    """Documents not older than the range before now; all of them without a range."""
    if range_millis is None or now_millis is None:
        return F.lit(True)
    return F.col("startTimeMillis") >= F.lit(now_millis - range_millis)


def read_json_docs(
    spark: SparkSession,
    path: str,
    now_millis: int | None = None,
    range_millis: int | None = RANGE_MILLIS,
    mode: str = "required",
    watch: Callable[[DataFrame], DataFrame] = lambda docs: docs,
) -> DataFrame:
    """Spans of a folder of documents.

    The range is relative to now, also when the folder holds a past day; `range_millis=None` reads
    the whole folder.  `watch` may put an observation on the documents in range.
    """
    if range_millis is not None and now_millis is None:
        now_millis = int(dt.datetime.now(dt.timezone.utc).timestamp() * 1000)
    return decode_docs(watch(read_docs(spark, path, mode).filter(in_range(now_millis, range_millis))), mode)


def first_with_rows(results: Iterable[tuple[str, DataFrame]]) -> tuple[str | None, DataFrame | None]:
    """The first result that has rows, else the last one.

    Later results are not computed.  Each is looked at here and used again by the caller, so hand in
    tables that are already written.
    """
    name = rows = None
    for name, rows in results:
        if not rows.isEmpty():
            break
    return name, rows
