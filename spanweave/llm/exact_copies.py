"""Exact duplicates by two-pass Bloom filtering.

Pass 1 hashes every text into the cells of a Bloom filter and keeps the cells hit twice or more: a bitmap of a fixed
greatest size, which is why it may be broadcast.  Pass 2 asks it about every row.  A text whose cells were not all hit
twice occurs once and passes straight through; only the others, the truly repeated and a few false positives, are
shuffled and grouped by SHA-256.  A filter too small for its input lets more rows through to the shuffle and changes
nothing else.

Texts are equal when they are after each run of ASCII white space became one space; null counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import SPACES, fresh, whole
from spanweave.shared import written

FILTER_BITS = 1 << 27  # 16 MiB at most; false positives stay below 1 % up to some 6 million texts
HASHES = 2
BITMAP_BYTES = 4096  # of bitmap_construct_agg


def text_sha256(text: str) -> Column:
    return F.sha2(F.regexp_replace(whole(text), SPACES, " "), 256)


def _cell(key: Column, i: int, filter_bits: int) -> Column:
    share = filter_bits // HASHES
    return F.pmod(F.xxhash64(key, F.lit(i)), F.lit(share)) + F.lit(i * share + 1)


def repeated_cells(keys: DataFrame, key: str, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Pass 1: the filter as rows (bucket, bits), at most filter_bits / 32768 of them."""
    return cells_of(keys, key, filter_bits, 2)


def cells_of(keys: DataFrame, key: str, filter_bits: int = FILTER_BITS, hits: int = 1) -> DataFrame:
    """The cells that so many keys fall into, as bitmaps."""
    cells = keys.select(F.explode(F.array(*(_cell(F.col(key), i, filter_bits) for i in range(HASHES)))).alias("cell"))
    twice = cells.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") >= hits)
    return twice.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")
    )


def flag_repeated(rows: DataFrame, key: str, cells: DataFrame, flag: str, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Pass 2: adds flag, false only where a cell of the key is not in the filter.  The filter is broadcast: its size has a fixed bound."""
    out, held = rows, []
    for i in range(HASHES):
        bucket, bits, cell = (fresh(out, f"_{x}{i}") for x in ("bucket", "bits", "cell"))
        held += [bucket, bits, cell]
        out = out.withColumn(cell, _cell(F.col(key), i, filter_bits))
        side = cells.select(F.col("bucket").alias(bucket), F.col("bits").alias(bits))
        out = out.join(F.broadcast(side), F.bitmap_bucket_number(cell) == F.col(bucket), "left")
    tests = []
    for i in range(HASHES):
        bits, place = F.col(held[3 * i + 1]), F.bitmap_bit_position(held[3 * i + 2])
        byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        tests.append(F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False)))
    hit = tests[0]
    for test in tests[1:]:
        hit = hit & test
    return out.withColumn(flag, hit).drop(*held)


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per row of docs: id_col, keep_id (the smallest id of its group), group_size, kept, text_sha256.

    Of rows that repeat an id and its text one is kept.  A null id sorts last; a group with null ids only keeps one row.
    No rows in, no rows out; columns besides the two named are not looked at.
    """
    keys = written(docs.select(F.col(id_col).alias("id"), text_sha256(text_col).alias("sha")), "text-keys")
    flagged = flag_repeated(keys, "sha", written(repeated_cells(keys, "sha", filter_bits), "filter"), "again", filter_bits)
    single = flagged.filter("not again").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"
    )
    rows = written(flagged.filter("again").groupBy("sha", "id").agg(F.count("*").alias("n")), "repeated")
    # Written, so that both sides of the join are plain exchanges, which Spark splits where one text is very frequent.
    groups = written(rows.groupBy("sha").agg(F.min("id").alias("keep_id"), F.sum("n").alias("group_size")), "groups")
    several = (
        rows.join(groups, "sha")
        .withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .select("id", "keep_id", "group_size", (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("i") == 1)).alias("kept"), "sha")
    )
    return single.unionByName(several).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """The rows of docs that stay, with all their columns.  Rows that occur once are never shuffled.

    Of equal texts the row with the smallest id stays (null last), and of rows alike in both the one with the smallest
    hash of its other columns.  No rows in, no rows out.
    """
    sha, flag = fresh(docs, "_sha"), fresh(docs, "_again")
    keyed = docs.withColumn(sha, text_sha256(text_col))
    cells = written(repeated_cells(keyed, sha, filter_bits), "filter")
    flagged = flag_repeated(keyed, sha, cells, flag, filter_bits)
    # Maps have no hash in Spark; their JSON has.
    hashable = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kind else F.col(f"`{c}`") for c, kind in docs.dtypes]
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), F.xxhash64(*hashable))
    first = flagged.filter(F.col(flag)).groupBy(sha).agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), order).alias("row"))
    return flagged.filter(~F.col(flag)).select(*(f"`{c}`" for c in docs.columns)).unionByName(first.select("row.*"))


SQL = r"""
WITH keys AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM keys WINDOW g AS (PARTITION BY text_sha256)
"""
