"""Sources mixed to target weights by systematic sampling.

Each source gets a target in words; its documents are expected target / size times each.  Systematic sampling adds up
the expected copies along an order of the source's documents, starts at one random offset below one, and emits a
document once for every integer the sum passes.  The sum at a document is its rank times the ratio, so it takes a rank
per source: ranks are computed in cells of (source, size class, hash), numbered by a prefix sum over the cells'
counts, so that no source, however large, is sorted in one task.  Documents follow each other by size, which keeps the
words taken close to the target.

Order and offset come from MD5 hashes: reruns agree, on any cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.llm.common import bits60, fresh, whole, word_count
from spanweave.shared import written

WEIGHTS = (5, 2, 1)  # repeating, over the sources in order
MOST = 3  # a target is at most so many times its source's size
CELL_BITS = 8  # each size class of a source is ranked in 2^CELL_BITS pieces
SEED = "mix"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """sizes: (source, source_size), a row per source -> adds target.

    Targets share the total by weight.  Those above most times their size stop there and the rest is shared anew: in
    the end min(most * size, level * weight) with one level.  The sources are put in the order of size / weight, where
    the ones that stop come first; the level is that of the first source that does not have to stop.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long")
    cap = F.lit(most) * F.col("source_size")
    by_ratio = Window.orderBy((cap / F.col("weight")).asc(), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum(cap).over(before), F.lit(0))) / F.sum(
        "weight"
    ).over(after)
    levels = sizes.withColumn("weight", weight).withColumn("level", level)
    # Up to the first source that needs not stop the level rises, behind it it falls.
    return levels.withColumn("level", F.max("level").over(Window.partitionBy())).select(
        "source", "source_size", F.least(cap.cast("double"), F.col("level") * F.col("weight")).alias("target")
    )


def _with_cells(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, keep: list[str]) -> DataFrame:
    """(id, source, size, h, class, piece, cell, row): row holds the columns to keep."""
    md5 = F.md5(whole(text_col))
    binary = F.bin(F.col("size") + 1)
    bit = lambda i: (F.substring(binary, i, 1) == "1").cast("int")
    size_class = F.length(binary) * 4 + bit(2) * 2 + bit(3)  # four classes between a power of two and the next
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(text_col).alias("size"),
        bits60(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), md5)).alias("h"),
        F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row") if keep else F.lit(None).cast("int").alias("row"),
    )
    rows = rows.withColumns({"class": size_class, "piece": F.shiftright("h", 60 - CELL_BITS)})
    source = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    return rows.withColumn("cell", F.concat_ws(":", "class", "piece", source))


def _counted(rows: DataFrame, weights: tuple[int, ...], most: int, seed: str) -> DataFrame:
    cells = written(
        rows.groupBy("cell", "source", "class", "piece").agg(F.count("*").alias("n"), F.sum("size").alias("words")), "cells"
    )
    targets = source_targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    earlier = Window.partitionBy("source").orderBy("class", "piece").rowsBetween(Window.unboundedPreceding, -1)
    ranked = cells.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    offset = bits60(F.concat_ws(":", F.lit(seed), F.lit("offset"), "c.source")) / F.lit(float(1 << 60))
    plan = ranked.alias("c").join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))).select(
        "cell", "earlier", "source_size", "target", offset.alias("offset"),
        F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)).alias("ratio"),
    )
    in_cell = Window.partitionBy("cell").orderBy("size", "h")
    joined = rows.withColumn("rank", F.row_number().over(in_cell)).join(plan, "cell")
    rank = F.col("rank") + F.col("earlier")
    # Whole copies apart, the sum runs with the fraction only and passes one integer at most per document.
    whole_copies, part = F.floor("ratio"), F.col("ratio") - F.floor("ratio")
    passed = F.floor(F.col("offset") + part * rank) - F.floor(F.col("offset") + part * (rank - 1))
    return joined.withColumn("copies", (whole_copies + F.least(passed, F.lit(1))).cast("long"))


def mark_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """id_col, source, size, source_size, target, copies and taken (words), a row per document.

    size counts the words of the text, null as none.  A null source is a source of its own, the last.  A source
    without words has the target 0 and no copies.  Rows alike in id and text may swap copies, which shows nowhere.
    No rows in, no rows out; other columns are not looked at.
    """
    rows = written(_with_cells(docs, id_col, text_col, source_col, seed, []), "mix")
    return _counted(rows, weights, most, seed).select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """docs, each row as often as the mix takes it, with all its columns.  Cases as in mark_copies."""
    rows = _with_cells(docs, id_col, text_col, source_col, seed, docs.columns)
    taken = _counted(rows, weights, most, seed).filter("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


SQL = r"""
WITH words AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(concat_ws(':', 'mix', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 15))::BIGINT AS h
  FROM documents
), cells AS (
  SELECT *, bin(size + 1) AS b, length(b) * 4 + 2 * (substr(b, 2, 1) = '1')::INT + (substr(b, 3, 1) = '1')::INT AS class,
         h >> 52 AS piece
  FROM words
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM words GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM sources
), levels AS (
  SELECT *, ((SELECT sum(source_size) FROM sources) - coalesce(sum(3 * source_size) OVER (
               ORDER BY 3 * source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(weight) OVER (ORDER BY 3 * source_size::DOUBLE / weight, source NULLS LAST
                                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed
), targets AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, (SELECT max(level) FROM levels) * weight) AS target FROM levels
), ranked AS (
  SELECT c.*, source_size, target, coalesce(target / nullif(source_size, 0), 0) AS ratio,
         row_number() OVER (PARTITION BY c.source ORDER BY class, piece, size, h) AS place,
         ('0x' || substr(md5(concat_ws(':', 'mix', 'offset', c.source)), 1, 15))::BIGINT / (1::BIGINT << 60)::DOUBLE AS start
  FROM cells c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken
FROM (
  SELECT *, (floor(ratio) + least(floor(start + (ratio - floor(ratio)) * place)
                                  - floor(start + (ratio - floor(ratio)) * (place - 1)), 1))::BIGINT AS copies
  FROM ranked)
"""
