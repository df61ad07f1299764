"""Shards by extendible hashing.

A directory is indexed by the leading bits of a document's hash.  It starts as one bucket; a bucket above the byte
limit splits on one more bit, the others stay.  So a prefix is a bucket exactly when it fits and its parent does not.
Sizes of prefixes are sums over cells, prefixes some bits finer than the shards will be: one pass over the documents
gives the cells, and all splits are worked out on them.  Only documents of cells that are still too large are looked at
again, CELL_BITS bits deeper.  A bucket whose documents all have one hash cannot split and is marked as not fitting.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import bits60, fresh, whole
from spanweave.shared import written

SHARD_BYTES = 1 << 20
HASH_BITS = 60
CELL_BITS = 8


def _hash(id_col: str, text_col: str) -> Column:
    # The text is in it for ids that repeat: else their rows could not be told apart and would share a shard.
    return bits60(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(whole(text_col))))


def _buckets(cells: DataFrame, start: int, bits: int, limit: int) -> DataFrame:
    """cells: (cell of that many bits, bytes, docs, low, high) -> the buckets (depth, prefix, ..., fits) deeper than start."""
    levels = F.explode(F.sequence(F.lit(start), F.lit(bits))).alias("depth")
    sizes = (
        cells.select("*", levels)
        .groupBy("depth", F.expr(f"shiftright(cell, {bits} - depth)").alias("prefix"))
        .agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"), F.min("low").alias("low"), F.max("high").alias("high"))
        .withColumn("fits", F.col("bytes") <= limit)
        .withColumn("closed", F.col("fits") | (F.col("low") == F.col("high")))
    )
    sizes = written(sizes, "prefixes")
    parents = sizes.filter("not closed").select((F.col("depth") + 1).alias("depth"), (F.col("prefix") * 2).alias("left"))
    split = parents.select("depth", F.explode(F.array("left", F.col("left") + 1)).alias("prefix"))
    # At the first level every prefix is open: it belongs to a cell that was found too large, or is the root.
    return sizes.filter(F.col("depth") == start).unionByName(sizes.join(split, ["depth", "prefix"]))


def shard_documents(
    docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text", hash_col: str | None = None
) -> DataFrame:
    """id_col, bytes, shard (its prefix as bits), depth, shard_bytes, shard_docs, fits: a row per document.

    bytes is the UTF-8 length of the text, null and empty texts have none.  Rows alike in id and text stay together;
    if they, or one text, are larger than the limit, that shard holds nothing else and fits is false.  A null id is
    hashed like an empty one.  hash_col may hold the rows' hashes, if they are known already.  No rows in, no rows out; other columns are not looked at.
    """
    rows = written(
        docs.select(
            F.col(id_col).alias("id"),
            F.octet_length(whole(text_col)).cast("long").alias("bytes"),
            (F.col(hash_col) if hash_col else _hash(id_col, text_col)).alias("hash"),
        ),
        "hashed",
    )
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    bits = min(HASH_BITS, max(0, math.ceil(math.log2(total / limit))) + CELL_BITS if total else CELL_BITS)
    start, open_rows, done = 0, rows, None
    while True:
        cell = F.shiftright("hash", HASH_BITS - bits)
        cells = open_rows.groupBy(cell.alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("docs"), F.min("hash").alias("low"), F.max("hash").alias("high")
        )
        buckets = written(_buckets(cells, start, bits, limit), "buckets")
        span = F.expr(f"shiftleft(1L, {bits} - depth)")
        cover = buckets.filter("closed").withColumn(
            "cell", F.explode(F.sequence(F.col("prefix") * span, F.col("prefix") * span + span - 1))
        )
        placed = open_rows.withColumn("cell", cell).join(
            cover.select(
                "cell", "depth", "fits", F.col("bytes").alias("shard_bytes"), F.col("docs").alias("shard_docs"),
                F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0"))).alias("shard"),
            ).hint("merge"),  # it has a row per cell, more than Spark's estimate says: not to be broadcast
            "cell",
        )
        placed = placed.select("id", "bytes", "shard", "depth", "shard_bytes", "shard_docs", "fits")
        done = placed if done is None else done.unionByName(placed)
        large = buckets.filter((F.col("depth") == bits) & ~F.col("closed")).select(F.col("prefix").alias("cell"))
        if bits == HASH_BITS or large.isEmpty():
            return done.withColumnRenamed("id", id_col)
        open_rows = written(open_rows.withColumn("cell", cell).join(large, "cell", "left_semi").drop("cell"), "open")
        start, bits = bits + 1, min(HASH_BITS, bits + CELL_BITS)


def directory(sharded: DataFrame) -> DataFrame:
    """The directory of a sharding: shard, depth, bytes, docs, fits and its first slot of 2^depth equal ones."""
    return sharded.groupBy("shard").agg(
        F.first("depth").alias("depth"), F.first("shard_bytes").alias("bytes"),
        F.first("shard_docs").alias("docs"), F.first("fits").alias("fits"),
        F.coalesce(F.conv(F.first("shard"), 2, 10).cast("long"), F.lit(0)).alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """docs as Parquet, a folder per shard of `shard_documents`, each with its documents in order of the id, null first.

    All rows and columns are kept, repeated rows too; without rows there is no folder.
    """
    key, shard = fresh(docs, "_hash"), fresh(docs, "shard")
    hashed = docs.withColumn(key, _hash(id_col, text_col))
    # Rows of one hash lie in one shard.
    places = shard_documents(hashed, limit, key, text_col, key).groupBy(F.col(key)).agg(F.first("shard").alias(shard))
    rows = hashed.join(places, key).drop(key)
    rows.repartition(shard).sortWithinPartitions(shard, id_col).write.partitionBy(shard).parquet(path)


SQL = f"""
WITH hashed AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS bytes,
         ('0x' || substr(md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 15))::BIGINT AS hash
  FROM documents
), levels AS (
  SELECT depth, hash >> ({HASH_BITS} - depth) AS prefix, sum(bytes)::BIGINT AS bytes, count(*) AS docs,
         min(hash) = max(hash) AS one
  FROM hashed, range(0, {HASH_BITS} + 1) AS r(depth) GROUP BY ALL
), found AS (
  SELECT doc_id, bytes, hash, min(depth) AS depth
  FROM (SELECT h.*, l.depth FROM hashed h JOIN levels l ON h.hash >> ({HASH_BITS} - l.depth) = l.prefix
        WHERE l.bytes <= {SHARD_BYTES} OR l.one)
  GROUP BY ALL
)
SELECT doc_id, f.bytes, CASE WHEN f.depth = 0 THEN '' ELSE lpad(bin(prefix), f.depth::INT, '0') END AS shard,
       f.depth::INT AS depth, l.bytes AS shard_bytes, docs AS shard_docs, l.bytes <= {SHARD_BYTES} AS fits
FROM found f JOIN levels l ON f.depth = l.depth AND f.hash >> ({HASH_BITS} - f.depth) = l.prefix
"""
