"""Span views over the analytics tables, for tests and registered queries."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.functions.tags import no_tags
from spanweave.functions.refs import no_refs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _trace_id(key: Column) -> Column:
    return F.lpad(F.lower(F.hex(key)), 32, "0")


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _tag(key: str, value: Column) -> Column:
    return F.struct(
        F.lit(key).alias("key"), F.lit("string").alias("vtype"), value.alias("value")
    )


def spans_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trace per order: a client root and one span per line item, in a binary tree."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    roots = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _trace_id(F.col("o_orderkey")).alias("trace_id"),
            F.lit(1).cast("bigint").alias("span_id"),
            _micros(F.col("o_orderdate")).alias("start_time"),
            F.concat(F.lit("cust-"), "n_name").alias("service"),
            F.array(_tag("span.kind", F.lit("client"))).alias("tags"),
            no_refs().alias("refs"),
        )
    )
    number = F.col("l_linenumber").cast("bigint")
    kind = (
        F.when(F.col("l_returnflag") == "R", "client")
        .when(F.col("l_returnflag") == "A", "server")
        .when(F.col("l_linestatus") == "O", "producer")
        .otherwise("consumer")
    )
    peer = F.when(
        F.col("l_discount") >= 0.08, F.array(_tag("peer.service", F.col("p_brand")))
    ).otherwise(no_tags())
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            _trace_id(F.col("l_orderkey")).alias("trace_id"),
            (number + 1).alias("span_id"),
            _micros(F.col("l_shipdate")).alias("start_time"),
            F.concat(F.lit("supp-"), "n_name").alias("service"),
            F.concat(peer, F.array(_tag("span.kind", kind))).alias("tags"),
            F.array(F.shiftright(number, 1) + 1).alias("refs"),
        )
    )
    return roots.unionAll(lines)


def ids_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace and span ids of `spans_orders`, found without its joins.  These drop spans and add none."""
    roots = table(spark, sf_dir, "orders").select(_trace_id(F.col("o_orderkey")).alias("trace_id"), F.lit(1).cast("bigint").alias("span_id"))
    number = F.col("l_linenumber").cast("bigint")
    return roots.unionAll(table(spark, sf_dir, "lineitem").select(_trace_id(F.col("l_orderkey")).alias("trace_id"), (number + 1).alias("span_id")))


def spans_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trace per conversation, each turn called by the one before; no tags."""
    turn = F.col("turn")
    return table(spark, sf_dir, "conversations").select(
        _trace_id(F.col("conv_id")).alias("trace_id"),
        (turn + 1).alias("span_id"),
        F.lit(None).cast("bigint").alias("start_time"),
        F.col("role").alias("service"),
        no_tags().alias("tags"),
        F.when(turn > 0, F.array(turn)).otherwise(no_refs()).alias("refs"),
    )


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their rank `seq` within user and day.

    Ranked within user and minute, plus the events of the user's earlier minutes of the day: a busy
    user's day is split over 1440 pieces.
    """
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "props",
        F.to_date("ts").alias("day"),
        (F.hour("ts") * 60 + F.minute("ts")).alias("minute"),
    )
    piece = ["user_id", "day", "minute"]
    before = events.groupBy(*piece).agg(F.count("*").alias("events_in")).selectExpr(
        *piece,
        "sum(events_in) over (partition by user_id, day order by minute) - events_in as earlier",
    )
    ranked = events.selectExpr(
        "*", "row_number() over (partition by user_id, day, minute order by ts, event_id) as rank"
    )
    return ranked.join(before, piece).withColumn("seq", F.col("rank") + F.col("earlier"))


def spans_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trace per user and day, each event called by the one before."""
    seq = F.col("seq").cast("bigint")
    return numbered_events(spark, sf_dir).select(
        F.concat(F.col("user_id").cast("string"), F.lit("/"), F.col("day").cast("string")).alias(
            "trace_id"
        ),
        seq.alias("span_id"),
        _micros(F.col("ts")).alias("start_time"),
        F.col("event_type").alias("service"),
        F.array(_tag("k", F.get_json_object("props", "$.k"))).alias("tags"),
        F.when(seq > 1, F.array(seq - 1)).otherwise(no_refs()).alias("refs"),
    )


def repeated(spans: DataFrame) -> DataFrame:
    """Spans with exact copies of every third span id, found in one pass over them."""
    copies = F.when(F.col("span_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return spans.select("*", F.explode(copies).alias("copy")).drop("copy")
