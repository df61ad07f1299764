"""Hard negatives by coordinate pruning over length buckets.

Vectors lie in buckets of descending length, a bucket being a range partition of (length, id) that one task can hold.
Inside a task a bucket is cut into slabs; a slab holds its unit vectors' values sorted per coordinate.  An anchor visits
the slabs in order with the least score it still needs.  That score gives a greatest angle to the slab's longest vector,
so a slab out of reach is skipped as a whole, and every coordinate of a candidate must fall into a range around the
anchor's own value.  The coordinates with the fewest vectors in range are the anchor's focus; the rows in all their
ranges are candidates, and only these are scored.  Where no coordinate rules out enough, the slab is scored as a block.

Scores are inner products of the components scaled and rounded down, so they are whole numbers and compared exactly.
Anchors stream past a bucket in batches: a task never holds more than a bucket and a batch.  Each bucket hands on the best
few rows per anchor, which are merged by a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.shared import written

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these percentages of the positive's.
LOW, HIGH = 50, 95

BUCKET_ROWS = 1 << 16
LEAST_BUCKETS = 16
SLAB_ROWS = 1024
ANCHORS = 512  # searched at once
FOCUS = 4
#: Anchors whose narrowest coordinate keeps more than this share of a slab are scored against all of it.
WIDE = 0.5

_NONE = np.iinfo(np.int64).min
_LARGEST = np.iinfo(np.int64).max
_EXACT = float(1 << 53)
_SLACK = 1e-9

_FOUND = "anchor_id long, place int, id long, score long"


def _taking_part(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """id, label, vector, length of the rows that take part, one per id."""
    finite = F.forall(F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    one = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.*")
    # Only orders the buckets; a square too large for a double puts its row into the first one.
    square = F.aggregate(F.col("vector"), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return one.withColumn("length", square)


def _bucketed(rows: DataFrame) -> tuple[DataFrame, int]:
    rows = written(rows, "vectors")
    buckets = max(LEAST_BUCKETS, -(-rows.count() // BUCKET_ROWS))
    dealt = rows.repartitionByRange(buckets, F.desc("length"), F.col("id")).withColumn("bucket", F.spark_partition_id())
    dealt = written(dealt, "length-buckets")
    return dealt, 1 + (dealt.agg(F.max("bucket")).first()[0] or 0)


def _matrix(column: pa.Array, scale: int) -> np.ndarray:
    """Scaled whole components as doubles; shorter vectors are filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _widened(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] >= width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def _products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Whole inner products of all rows of a with all rows of b; beyond 64 bits the nearest 64-bit number."""
    if exact:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in b]
    out = [[sum(int(x) * y for x, y in zip(row, other)) for other in whole] for row in a]
    return np.array([[min(max(s, -_LARGEST), _LARGEST) for s in row] for row in out], np.int64).reshape(len(a), len(b))


class Slab:
    """A few vectors of like length, with their unit values sorted per coordinate."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.vectors, self.ids, self.labels = vectors, ids, labels
        lengths = np.sqrt(np.square(vectors).sum(axis=1))
        self.longest = float(lengths.max(initial=0.0))
        units = vectors / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.order = np.argsort(units, axis=0, kind="stable")
        self.sorted = np.take_along_axis(units, self.order, axis=0)
        self.place = np.empty_like(self.order)
        np.put_along_axis(self.place, self.order, np.arange(len(ids))[:, None].repeat(units.shape[1], axis=1), axis=0)

    def ranges(self, units: np.ndarray, angle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per anchor and coordinate, the stretch of the sorted list that a vector within the angle can stand in."""
        own = np.arccos(np.clip(units, -1.0, 1.0))
        low = np.cos(np.minimum(np.pi, own + angle[:, None])) - _SLACK
        high = np.cos(np.maximum(0.0, own - angle[:, None])) + _SLACK
        first, last = np.empty(units.shape, np.int64), np.empty(units.shape, np.int64)
        for f in range(units.shape[1]):
            first[:, f] = np.searchsorted(self.sorted[:, f], low[:, f], "left")
            last[:, f] = np.searchsorted(self.sorted[:, f], high[:, f], "right")
        return first, last

    def scored(self, anchors: Anchors, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor, row, score) of every pair whose score can reach least[anchor]; others may come too."""
        if not len(self.ids):
            return
        reach = anchors.lengths * self.longest
        exact = float(anchors.lengths.max(initial=0.0)) * self.longest < _EXACT and not np.isinf(reach).any()
        safe = np.where((reach > 0) & np.isfinite(reach), reach, 1.0)
        # With nothing gained so far, or a score below zero to reach, every direction is within reach.
        cosine = np.where((least > 0) & np.isfinite(reach), least / safe, -1.0)
        near = (cosine <= 1 + _SLACK) & ~((reach == 0) & (least > 0))
        at = np.flatnonzero(near)
        if not len(at):
            return
        wide = np.ones(len(at), bool)
        if self.vectors.shape[1]:
            units = _widened(anchors.units[at], self.vectors.shape[1])[:, : self.vectors.shape[1]]
            first, last = self.ranges(units, np.arccos(np.clip(cosine[at] - _SLACK, -1.0, 1.0)))
            spans = last - first
            wide = spans.min(axis=1) > WIDE * len(self.ids)
        block = at[wide]
        if len(block):
            width = max(anchors.vectors.shape[1], self.vectors.shape[1])
            scores = _products(_widened(anchors.vectors[block], width), _widened(self.vectors, width), exact)
            yield np.repeat(block, len(self.ids)), np.tile(np.arange(len(self.ids)), len(block)), scores.ravel()
        for i in np.flatnonzero(~wide):
            focus = np.argsort(spans[i], kind="stable")[:FOCUS]
            rows = self.order[first[i, focus[0]] : last[i, focus[0]], focus[0]]
            for f in focus[1:]:
                rows = rows[(self.place[rows, f] >= first[i, f]) & (self.place[rows, f] < last[i, f])]
            if len(rows):
                width = max(anchors.vectors.shape[1], self.vectors.shape[1])
                one = _widened(anchors.vectors[at[i] : at[i] + 1], width)
                yield np.full(len(rows), at[i]), rows, _products(one, _widened(self.vectors[rows], width), exact)[0]


class Anchors:
    """A batch of anchors and the best rows found for each of their searches."""

    def __init__(self, batch: pa.RecordBatch, scale: int, keep: int):
        self.ids = batch["id"].to_numpy()
        self.labels = batch["label"].to_numpy(zero_copy_only=False)
        self.vectors = _matrix(batch["vector"], scale)
        self.lengths = np.sqrt(np.square(self.vectors).sum(axis=1))
        self.units = self.vectors / np.where(self.lengths > 0, self.lengths, 1.0)[:, None]
        goals = [p or [] for p in batch["goals"].to_pylist()]
        places = max((len(g) for g in goals), default=0)
        self.low = np.full((len(goals), places), _LARGEST, np.int64)
        self.high = np.full((len(goals), places), _NONE, np.int64)
        for i, goal in enumerate(goals):
            for j, bounds in enumerate(goal):
                self.low[i, j], self.high[i, j] = bounds["low"], bounds["high"]
        self.keep = keep
        self.scores = np.full((len(goals), places, keep), _NONE, np.int64)
        self.found = np.full((len(goals), places, keep), _LARGEST, np.int64)

    def least(self) -> np.ndarray:
        """The least score that any search of the anchor still takes."""
        need = np.maximum(self.low, self.scores[:, :, -1])
        return np.where(self.high >= need, need, _LARGEST).min(axis=1, initial=_LARGEST)

    def take(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        for j in range(self.low.shape[1]):
            need = np.maximum(self.low[at, j], self.scores[at, j, -1])
            fits = (scores >= need) & (scores <= self.high[at, j])
            if not fits.any():
                continue
            a, s, i = at[fits], scores[fits], ids[fits]
            old = np.unique(a)
            a = np.concatenate([a, np.repeat(old, self.keep)])
            s = np.concatenate([s, self.scores[old, j].ravel()])
            i = np.concatenate([i, self.found[old, j].ravel()])
            order = np.lexsort((i, ~s, a))  # ~s falls as s grows, without overflow
            a, s, i = a[order], s[order], i[order]
            start = np.searchsorted(a, old)
            rank = np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a))))
            best = rank < self.keep
            self.scores[a[best], j, rank[best]], self.found[a[best], j, rank[best]] = s[best], i[best]

    def batch(self) -> pa.RecordBatch:
        a, j, k = np.nonzero(self.scores != _NONE)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[a]), pa.array(j.astype(np.int32)), pa.array(self.found[a, j, k]), pa.array(self.scores[a, j, k])],
            ["anchor_id", "place", "id", "score"],
        )


def _slabs(held: list[pa.RecordBatch], scale: int) -> list[Slab]:
    out = []
    for batch in held:
        for at in range(0, len(batch), SLAB_ROWS):
            part = batch.slice(at, SLAB_ROWS)
            out.append(Slab(_matrix(part["vector"], scale), part["id"].to_numpy(), part["label"].to_numpy(zero_copy_only=False)))
    return out


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(values)) + 1
    yield from zip([0, *edges], [*edges, len(values)])


def _searcher(scale: int, keep: int, same: bool):
    """Reads partitions sorted by bucket, rows before anchors, and yields the best rows of each bucket per anchor."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, slabs = None, [], None
        for batch in batches:
            keys = batch["bucket"].to_numpy() * 2 + batch["anchor"].to_numpy(zero_copy_only=False)
            for start, end in _runs(keys):
                part, key = batch.slice(start, end - start), int(keys[start])
                if key // 2 != bucket:
                    bucket, held, slabs = key // 2, [], None
                if key % 2 == 0:
                    held.append(part)
                    continue
                if slabs is None:
                    slabs, held = _slabs(held, scale), []
                for first in range(0, len(part), ANCHORS):
                    anchors = Anchors(part.slice(first, ANCHORS), scale, keep)
                    for slab in slabs:
                        for at, rows, scores in slab.scored(anchors, anchors.least()):
                            alike = slab.labels[rows] == anchors.labels[at]
                            wanted = (alike & (slab.ids[rows] != anchors.ids[at])) if same else ~alike
                            anchors.take(at[wanted], slab.ids[rows[wanted]], scores[wanted])
                    yield anchors.batch()

    return search


def _search(rows: DataFrame, buckets: int, anchors: DataFrame, scale: int, keep: int, same: bool) -> DataFrame:
    """The best rows (anchor_id, place, id, score) of every search: each anchor meets every bucket, in blocks."""
    goals = "cast(null as array<struct<low:bigint,high:bigint>>)"
    held = rows.selectExpr("bucket", "false as anchor", "length", "id", "label", "vector", f"{goals} as goals")
    asking = anchors.selectExpr(f"explode(sequence(0, {buckets - 1})) as bucket", "true as anchor", "0D as length", "id", "label", "vector", "goals")
    met = held.unionByName(asking).repartition(buckets, "bucket").sortWithinPartitions("bucket", "anchor", F.desc("length"), "id")
    found = met.drop("length").mapInArrow(_searcher(scale, keep, same), _FOUND)
    rank = F.expr("row_number() over (partition by anchor_id, place order by score desc, id)").alias("rank")
    return found.select("*", rank).filter(F.col("rank") <= keep)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: str | Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows where is_anchor (a condition on id, label and vector) holds.  An anchor's positives are the best
    other rows of its label; for each, its negatives are the best rows of another label whose score is between low and high
    per cent of the positive's.  Equal scores come by smaller id.  Fewer rows than asked for give all there are, none give none.

    Rows with a null id, label, vector or component, or a component that is not finite (also after scaling), take no part.
    Of rows with one id the smallest by label, then vector, takes part.  Vectors of several sizes are filled up with zeros.
    A score beyond 64 bits counts as the nearest 64-bit number.  Empty table: no rows.  Other columns are not looked at.
    """
    rows, buckets = _bucketed(_taking_part(vectors, id_col, vector_col, label_col, scale))
    anchors = rows.filter(is_anchor).select("id", "label", "vector")
    anything = f"array(struct({_NONE + 1}L as low, {_LARGEST}L as high))"
    near = written(_search(rows, buckets, anchors.selectExpr("*", f"{anything} as goals"), scale, positives, True), "positives")
    # Whole-number bounds of low * p <= 100 * s <= high * p, free of overflow.
    p = F.col("score").cast("decimal(30,0)")
    bound = F.struct(
        F.ceil(p * low / 100).cast("long").alias("low"), F.floor(p * high / 100).cast("long").alias("high"), F.col("rank").alias("nth")
    )
    goals = near.groupBy(F.col("anchor_id").alias("id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", bound.alias("b")))), lambda g: F.struct(g["b"]["low"].alias("low"), g["b"]["high"].alias("high"))).alias("goals")
    )
    far = _search(rows, buckets, anchors.join(goals, "id"), scale, negatives, False)
    pairs = near.select("anchor_id", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(pairs, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def query(embeddings: DataFrame) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings.select("vec_id", "embedding", label.alias("label")), "id % 50 = 0")


SQL = r"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::double)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS bigint) AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
),
n AS (
  SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS int) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
   AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
