"""Queries over derived links."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.schema import DAY_DOCUMENT_SCHEMA, RESULT_SCHEMA


def adjacency_map(edges: DataFrame) -> DataFrame:
    """One row per parent with its children and their counts.  Edges are unique, as derived."""
    pair = F.struct("child", "call_count")
    return edges.groupBy("parent").agg(
        F.map_from_entries(F.sort_array(F.collect_list(pair))).alias("children")
    )


def tree_edges(nodes: DataFrame) -> DataFrame:
    """Edges counted straight from trees: (tree_id, node, parent_node, service) rows."""
    parents = nodes.select(
        "tree_id", F.col("node").alias("parent_node"), F.col("service").alias("parent")
    )
    # Counted per child service first: a parent with very many children meets them as a few rows.
    children = (
        nodes.filter(F.col("parent_node").isNotNull())
        .groupBy("tree_id", "parent_node", F.col("service").alias("child"))
        .agg(F.count("*").alias("calls"))
    )
    return (
        children.join(parents, ["tree_id", "parent_node"])
        .groupBy("parent", "child")
        .agg(F.sum("calls").alias("call_count"))
    )


def read_result(answers: DataFrame, column: str = "value") -> DataFrame:
    """Edges of query-service answers held as JSON text."""
    parsed = answers.select(F.from_json(column, RESULT_SCHEMA).alias("answer"))
    return parsed.select(F.explode("answer.data").alias("link")).select(
        "link.parent", "link.child", F.col("link.callCount").alias("call_count")
    )


def read_documents(documents: DataFrame, column: str = "value") -> DataFrame:
    """Edges of stored day documents held as JSON text, with the day's timestamp."""
    parsed = documents.select(F.from_json(column, DAY_DOCUMENT_SCHEMA).alias("doc"))
    return parsed.select("doc.timestamp", F.explode("doc.dependencies").alias("link")).select(
        "timestamp", "link.parent", "link.child", F.col("link.callCount").alias("call_count")
    )


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other, with the surplus of the left side.

    Empty where both hold the same bag of rows.  One aggregate, so repeated rows shrink on the map
    side.
    """
    columns = left.columns
    both = left.withColumn("surplus", F.lit(1).cast("bigint")).unionByName(
        right.select(*columns).withColumn("surplus", F.lit(-1).cast("bigint"))
    )
    return both.groupBy(*columns).agg(F.sum("surplus").alias("surplus")).filter("surplus <> 0")


# Bits of a row's hash that each level of the comparison looks at.
LEVEL_BITS = 12
LEVELS = 2
#: Where more prefixes than these differ, a closer look saves nothing.
MOST_PLACES = 1 << 11


def _hash(df: DataFrame, salt: int) -> Column:
    # A null changes no hash, so where the nulls are is hashed too.
    columns = [F.col(f"`{c}`") for c in df.columns]
    return F.xxhash64(F.lit(salt), *columns, *(c.isNull() for c in columns))


def _marked(df: DataFrame, sign: int) -> DataFrame:
    """sign, place (the leading bits that the levels look at) and a second hash of each row."""
    bits = LEVEL_BITS * LEVELS
    return df.select(
        F.lit(sign).cast("long").alias("sign"),
        F.shiftrightunsigned(_hash(df, 1), 64 - bits).alias("place"),
        _hash(df, 1).alias("first"),
        _hash(df, 2).alias("second"),
    )


def _differing_places(both: DataFrame, shift: int) -> list[int]:
    """The prefixes of `place` under which the two sides are no equal bags, by 128-bit sums in which order plays no part."""
    half = 0xFFFFFFFF
    parts = [F.col(h).bitwiseAND(F.lit(half)) for h in ("first", "second")]
    parts += [F.shiftrightunsigned(h, 32) for h in ("first", "second")]
    # Sums of 32-bit halves overflow a long after 2^31 rows more on one side than on the other; try_sum turns null then.
    sums = [F.try_sum(F.col("sign") * part).alias(f"s{i}") for i, part in enumerate(parts)]
    grouped = both.groupBy(F.shiftright("place", shift).alias("prefix")).agg(F.sum("sign").alias("rows"), *sums)
    unequal = " or ".join(["rows <> 0", *(f"s{i} is null or s{i} <> 0" for i in range(4))])
    return [row.prefix for row in grouped.filter(unequal).select("prefix").take(MOST_PLACES + 1)]


def stored_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """As `difference`, for tables that are cheap to read again: only rows under differing hash prefixes are exchanged.

    Both sides are read once per level; what is collected per level are MOST_PLACES prefixes at most.  The rows under
    prefixes that differ are compared as a whole.  Rows with columns of map type cannot be compared.
    """
    right = right.select(*(F.col(f"`{c}`") for c in left.columns))
    both = _marked(left, 1).unionAll(_marked(right, -1))
    places, shift = None, LEVEL_BITS * LEVELS
    for level in range(1, LEVELS + 1):
        within = both if places is None else both.filter(F.shiftright("place", shift).isin(places))
        found = _differing_places(within, LEVEL_BITS * (LEVELS - level))
        if len(found) > MOST_PLACES:
            break
        places, shift = found, LEVEL_BITS * (LEVELS - level)
        if not found:
            break
    if places is None:
        return difference(left, right)
    under = [df.filter(F.shiftright(F.shiftrightunsigned(_hash(df, 1), 64 - LEVEL_BITS * LEVELS), shift).isin(places)) for df in (left, right)]
    return difference(*under)


def assert_equal(left: DataFrame, right: DataFrame) -> None:
    rows = stored_difference(left, right).take(5)
    if rows:
        raise AssertionError(f"results differ, for example in {rows}")
