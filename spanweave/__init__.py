"""Service dependency analytics over distributed-tracing spans, on Spark DataFrames."""

from spanweave.operators.derive import all_links, derive
from spanweave.plans.day import DayJob, ScanOptions, run_day

__all__ = ["DayJob", "ScanOptions", "all_links", "derive", "run_day"]
