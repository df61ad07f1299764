"""Random trees of bounded branching as data, to test link derivation against."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.functions.refs import no_refs
from spanweave.functions.tags import no_tags

#: Nodes that one task expands, on average.
NODES_A_TASK = 100_000


def trees(sizes: DataFrame, services: DataFrame, branching: int, chunk: int = 10_000) -> DataFrame:
    """Random trees of bounded branching, as rows: tree_id, node, parent_node, service.

    sizes     tree_id and nodes, the number of nodes; a tree must have some
    services  place (from 0, without gaps) and service; the root takes the first, other nodes any

    Nodes are numbered breadth-first, so that node i hangs below (i - 1) div branching.  The pick is a
    digest of tree and node: runs repeat, and nothing depends on how rows are spread.  Large trees
    are cut into chunks of nodes before they are expanded, and chunks dealt over a fixed number of
    tasks, counted from all nodes: a task would else take as many small rows as one can read, and
    hold all the nodes they expand to.
    """
    if branching < 1:
        raise ValueError("branching must be positive")
    positive = F.when(F.col("nodes") > 0, F.col("nodes")).otherwise(
        F.raise_error(F.lit("a tree must have nodes")).cast("bigint")
    )
    total = sizes.agg(F.sum("nodes").cast("bigint").alias("nodes")).first().nodes or 0
    chunks = (
        sizes.select("tree_id", positive.cast("bigint").alias("nodes"))
        .select("tree_id", "nodes", F.expr(f"explode(sequence(0L, nodes - 1, {chunk}L))").alias("low"))
        .repartition(max(1, total // NODES_A_TASK + 1), "tree_id", "low")
    )
    nodes = chunks.select(
        "tree_id",
        F.explode(
            F.sequence("low", F.least(F.col("low") + (chunk - 1), F.col("nodes") - 1))
        ).alias("node"),
    )
    count = services.agg(F.count("*")).scalar()
    pick = F.conv(F.left(F.md5(F.concat_ws("/", "tree_id", "node")), F.lit(8)), 16, 10).cast("bigint")
    place = F.when(F.col("node") == 0, 0).otherwise(F.pmod(pick, count)).cast("bigint")
    return (
        nodes.withColumn("place", place)
        .join(services.select(F.col("place").cast("bigint").alias("place"), "service"), "place")
        .select(
            "tree_id",
            "node",
            F.when(F.col("node") > 0, F.expr(f"(node - 1) div {branching}")).alias("parent_node"),
            "service",
        )
    )


def tree_spans(nodes: DataFrame) -> DataFrame:
    """Tree rows as spans: the node number is the start time and, from 1, the span id."""
    return nodes.select(
        F.lpad(F.col("tree_id").cast("string"), 32, "0").alias("trace_id"),
        (F.col("node") + 1).alias("span_id"),
        F.col("node").alias("start_time"),
        "service",
        no_tags().alias("tags"),
        F.when(F.col("parent_node").isNotNull(), F.array(F.col("parent_node") + 1))
        .otherwise(no_refs())
        .alias("refs"),
    )
