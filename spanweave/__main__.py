"""Command line: spark-submit spanweave/__main__.py --source span_table --input ... --output ... [day]"""

import argparse
import os

from pyspark.sql import SparkSession

from spanweave.functions.tags import PEER_KEY
from spanweave.plans.day import DayJob, RunReport, ScanOptions, run_and_report
from spanweave.sinks.records import PARTS
from spanweave.sources.names import NameRule
from spanweave.sources.spans import RANGE_MILLIS


def parse_args(argv: list[str] | None = None) -> DayJob:
    env = os.environ
    parser = argparse.ArgumentParser(prog="spanweave", description="Derive one day's service dependencies.")
    parser.add_argument("day", nargs="?", default=env.get("DATE"), help="yyyy-MM-dd, UTC; today if not given")
    parser.add_argument("--source", default=env.get("STORAGE"), help="json_docs or span_table")
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--peer-tag", default=env.get("PEER_SERVICE_TAG", PEER_KEY))
    parser.add_argument("--layout", choices=["v1", "v2"])
    parser.add_argument("--label", default="spanweave")
    parser.add_argument("--mode", default="required")
    parser.add_argument("--closed", action="store_true", help="read the whole day, both ends")
    parser.add_argument("--dt-window", type=int, nargs=2, help="days before and after whose dt folders are read")
    parser.add_argument("--range-hours", type=float, default=RANGE_MILLIS / 3_600_000, help="0 reads all")
    parser.add_argument("--span-base", default="span")
    parser.add_argument("--dependency-base", default="dependencies")
    parser.add_argument("--now-millis", type=int, help="what the range counts from; the clock if not given")
    parser.add_argument("--parts", type=int, default=PARTS, help="records a day is stored in")
    parser.add_argument("--prefix", default="")
    parser.add_argument("--prefix-marks", nargs="+", default=list(NameRule.prefix_marks), help="tried in this order")
    parser.add_argument("--separator", default="-")
    parser.add_argument("--aliases", action="store_true")
    parser.add_argument("--type-suffix", action="store_true")
    args = parser.parse_args(argv)
    if args.source is None:
        parser.error("--source is required")
    names = NameRule(
        span_base=args.span_base,
        dependency_base=args.dependency_base,
        prefix=args.prefix,
        prefix_marks=tuple(args.prefix_marks),
        separator=args.separator,
        aliases=args.aliases,
        type_suffix=args.type_suffix,
    )
    scan = ScanOptions(
        names=names,
        range_millis=int(args.range_hours * 3_600_000) or None,
        now_millis=args.now_millis,
        mode=args.mode,
        closed=args.closed,
        dt_window=tuple(args.dt_window) if args.dt_window else None,
    )
    return DayJob(
        args.source,
        args.input,
        args.output,
        args.day,
        args.peer_tag,
        args.layout,
        args.label,
        args.parts,
        scan=scan,
    )


def summary(report: RunReport) -> str:
    read = "" if report.documents is None else f"{report.documents} documents, {report.rejects} of them left out; "
    return f"{report.edges} links stored, {report.calls} calls; {read}{report.spans} spans read, {report.null_ids} without an id"


if __name__ == "__main__":
    job = parse_args()
    print(summary(run_and_report(SparkSession.builder.appName("spanweave").getOrCreate(), job)[1]))
