"""Quality classifier by importance resampling.

Two generative models over hashed n-grams (words and marks, one and two at a time, BUCKETS buckets): one of target text,
the documents labelled good, and one of the raw text, which is all documents.  A document's weight is the ratio of its
probabilities under the two; a sample without replacement by these weights is the k largest of log weight + Gumbel noise.
As many documents are taken as the target model explains at least as well as the raw one, or as the labels call good,
whichever are more: with few labels the first would follow their chance mixture of languages.

The raw counts come from every document.  The target's come from FIT_ROWS labelled ones at most, whose ids are few
enough to be sent to all tasks; the counts themselves have BUCKETS rows whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import bits60, fresh, in_small_batches
from spanweave.llm.hashing import BY_KIND, scramble, text_chunks, token_hashes, windows
from spanweave.shared import written

BUCKETS = 10_000
FIT_ROWS = 20_000
SMOOTHING = 100.0  # n-grams a bucket
SEED = "resample"
BINS = 4096


def _features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for data, bounds in text_chunks(texts):
        tokens, starts = token_hashes(data, bounds, BY_KIND)
        pairs, pair_starts = windows(tokens, starts, 2)
        bucket = lambda h, salt: (scramble(h + np.uint64(salt)) % np.uint64(BUCKETS)).astype(np.int64)
        yield bucket(tokens, 1), starts, bucket(pairs, 2), pair_starts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        texts, good = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        at = 0
        for one, starts, two, pair_starts in _features(texts):
            n = len(starts) - 1
            for buckets, bounds in ((one, starts), (two, pair_starts)):
                counts[0] += np.bincount(buckets, minlength=BUCKETS)
                chosen = np.repeat(good[at : at + n], np.diff(bounds))
                counts[1] += np.bincount(buckets[chosen], minlength=BUCKETS)
            at += n
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(BUCKETS)), pa.array(counts[0]), pa.array(counts[1])], ["bucket", "raw", "target"]
    )


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS
) -> np.ndarray:
    """log of target over raw probability for every bucket.

    labels: (id_col, quality); rows with quality 1 are the target.  Without any, all ratios are one.
    """
    good = labels.filter("quality = 1 AND " + f"`{id_col}` IS NOT NULL").select(F.col(id_col).alias("_good")).distinct()
    good = good.orderBy(bits60(F.concat_ws(":", F.lit(SEED), "_good")), "_good").limit(fit_rows)
    rows = in_small_batches(docs).select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    marked = rows.join(F.broadcast(good), F.col("_id") == F.col("_good"), "left")
    counted = marked.select("text", F.col("_good").isNotNull().alias("good")).mapInArrow(
        _count, "bucket long, raw long, target long"
    )
    sums = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in sums:
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    # The target model is drawn towards the raw one where it has seen little: a bucket's noise adds up over a text.
    expected = raw * (target.sum() / max(raw.sum(), 1.0))
    return np.log((target + SMOOTHING) / (expected + SMOOTHING))


def log_weight(ratios: np.ndarray, text: str | Column) -> Column:
    """log of a text's probability under the target model over that under the raw model; 0 without text."""

    @F.arrow_udf("double")
    def weigh(texts: pa.Array) -> pa.Array:
        out = []
        for one, starts, two, pair_starts in _features(texts):
            found = np.zeros(len(starts) - 1)
            for buckets, bounds in ((one, starts), (two, pair_starts)):
                sums = np.concatenate([[0.0], np.cumsum(ratios[buckets])])
                found += sums[bounds[1:]] - sums[bounds[:-1]]
            out.append(found)
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return weigh(text)


def gumbel(id_col: str, seed: str = SEED) -> Column:
    """Noise of a document: the same in every run."""
    uniform = (bits60(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))) + 0.5) / float(1 << 60)
    return -F.log(-F.log(uniform))


def kth_largest(keys: DataFrame, key: str, k: int) -> float:
    """The k-th largest of a column of finite doubles, exactly: histograms of ever narrower ranges, BINS rows each."""
    keys = keys.select(F.col(key).alias("key"))
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    while True:
        inside = keys.filter((F.col("key") >= low) & (F.col("key") <= high))
        width = (high - low) / BINS
        if width == 0 or low + width == low:
            return low
        place = F.least(F.floor((F.col("key") - low) / width), F.lit(BINS - 1))
        bins = inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        for row in sorted(bins.collect(), key=lambda r: -r["bin"]):
            if k <= row["n"]:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
        if k == 1:
            return high
        if k == row["n"]:
            return low


def resample_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED
) -> tuple[DataFrame, np.ndarray, float]:
    """Scores (id, log_weight, key), a row per document; the ratios; the least key that is taken (rows that tie stay)."""
    ratios = fit(docs, labels, id_col, text_col)
    scores = docs.select(F.col(id_col).alias("id"), log_weight(ratios, text_col).alias("log_weight"))
    scores = written(scores.withColumn("key", F.col("log_weight") + gumbel("id", seed)), "weights")
    n, explained = scores.agg(F.count("*"), F.count_if(F.col("log_weight") >= 0)).first()
    share = labels.filter("quality IN (0, 1)").agg(F.avg("quality")).first()[0]
    k = max(explained, round(n * (1.0 if share is None else share)))
    return scores, ratios, kth_largest(scores, "key", k) if k else float("inf")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, log_weight, key, kept: a row per document.

    A null or empty text has log_weight 0.  Rows with one id share its noise.  No rows in, no rows out; other columns
    are not looked at.
    """
    scores, _, least = resample_scores(docs, labels, id_col, text_col)
    return scores.withColumn("kept", F.col("key") >= F.lit(least)).withColumnRenamed("id", id_col)


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that classify() keeps, with all their columns; no row is shuffled."""
    _, ratios, least = resample_scores(docs, labels, id_col, text_col)
    key = fresh(docs, "_key")
    kept = docs.withColumn(key, log_weight(ratios, text_col) + gumbel(id_col)).filter(F.col(key) >= F.lit(least))
    return kept.select(*(f"`{c}`" for c in docs.columns))
