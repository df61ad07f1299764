"""Day records: the edges of one day as the stores keep them.

A record holds the day's edges in one array, or, with `parts` above one, those whose (parent, child) hashes to its part.
The number of parts is the job's choice and never depends on the edges: a day has the same layout at every size, each
record carries `part` and `parts`, and (day, part) is its key.  The edge table is the output without a bound on size.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.functions.days import day_millis, day_text
from spanweave.shared import exists

PARTS = 1
LAYOUTS = ("v2", "v1")


def day_links(edges: DataFrame, source: str, parts: int = PARTS) -> DataFrame:
    """Edges with a day column `dt` to rows of dt, part, dependencies; parts without edges have no row."""
    if parts < 1:
        raise ValueError("a record has one part at least")
    link = F.struct(
        "parent", "child", F.col("call_count").alias("callCount"), F.lit(source).alias("source")
    )
    return (
        edges.withColumn("part", F.pmod(F.xxhash64("parent", "child"), F.lit(parts)).cast("int"))
        .groupBy("dt", "part")
        .agg(F.sort_array(F.collect_list(link)).alias("dependencies"))
    )


def day_documents(edges: DataFrame, source: str, parts: int = PARTS) -> DataFrame:
    """Search-store documents: dt, part and the JSON text.  A day without edges has none."""
    body = F.struct("dependencies", day_text(F.col("dt")).alias("timestamp"), "part", F.lit(parts).alias("parts"))
    return day_links(edges, source, parts).select("dt", "part", F.to_json(body).alias("value"))


def day_rows(
    edges: DataFrame, days: DataFrame, source: str, layout: str = "v2", parts: int = PARTS
) -> DataFrame:
    """Wide-row records of the days in `days` (column dt): every part of every day, also without edges."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    empty = F.array().cast("array<struct<parent:string,child:string,callCount:bigint,source:string>>")
    second = "ts_bucket" if layout == "v2" else "ts_index"
    millis = day_millis(F.col("dt"))
    keys = days.select("dt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    return keys.join(day_links(edges, source, parts), ["dt", "part"], "left").select(
        "dt",
        millis.alias("ts"),
        millis.alias(second),
        "part",
        F.lit(parts).alias("parts"),
        F.coalesce("dependencies", empty).alias("dependencies"),
    )


def sink_layout(spark: SparkSession, path_v2: str) -> str:
    """v2 where the v2 table is in its place already, else v1."""
    return "v2" if exists(spark, path_v2) else "v1"


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON line per document under dt=<day>/.  Writing a day again replaces it."""
    (
        documents.select("dt", "value")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .text(path)
    )


def clear_documents(spark: SparkSession, path: str, day: str) -> None:
    """Leaves no documents of the day under the path, if there are any."""
    folder = f"{path}/dt={day}"
    if exists(spark, folder):
        spark.createDataFrame([], "value string").write.mode("overwrite").text(folder)


def write_rows(rows: DataFrame, path: str) -> None:
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .parquet(path)
    )
