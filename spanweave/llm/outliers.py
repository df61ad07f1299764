"""Quality rules by robust multivariate outliers.

A document is a vector of transformed statistics.  Per language and source, the minimum covariance determinant (MCD)
gives a centre and covariance that bad documents do not pull along: from several starts, concentration steps take the
mean and covariance of the share H of documents nearest so far, until the determinant stops falling; the start that ends
with the smallest determinant counts.  Documents with equal vectors (copies) count once there, and all are judged.
A document is rejected when its squared Mahalanobis distance passes CUTOFF.

The statistics come from one pass over the texts; the steps run on the narrow vectors.  A step is two aggregations per
group and start, combined before the shuffle: a histogram of log distances, whose bin with the H-quantile bounds the
nearest documents and counts with the share that makes up H, then their sums and products.  A group's parameters are one
row per start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.llm.common import in_small_batches
from spanweave.shared import written

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
H = 0.5
STEPS = 200  # a limit for safety: each step takes a thousandth off a determinant that has a least value
CUTOFF = 25.745  # 99.99 % of a chi-square with 5 degrees of freedom
# Mean of a share H of a chi-square with 5 degrees of freedom, against 5: makes the covariance of the nearest ones that of all.
CONSISTENCY = 1.91
DRAWN = 4  # starts around a vector drawn by hash, besides those at the medians and in the middle of the shortest halves
SLICES = 32  # quantiles between which the shortest half of a statistic is looked for
PRIOR_ROWS = 20  # so many documents' weight have the spreads below: what a small group is judged by
#: log words, log word length, share of symbols, of repeated lines and of repeated words (square roots).
#: For the two shares least and prior together leave room for CUTOFF: nine in ten lines repeated pass it in any group.
PRIOR_SPREADS = (1.0, 0.15, 0.03, 0.07, 0.03)
LEAST_SPREADS = (0.1, 0.03, 0.025, 0.17, 0.107)
P = len(PRIOR_SPREADS)
BINS = 16  # per unit of the log distance

SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
_MIX = np.random.default_rng(8).integers(1, 2**63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    keys = np.zeros(n, np.uint64)
    for j in range(window):
        keys += ids[j : j + n] * _MIX[j]
    ordered = np.sort(keys)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not again.size:
        return 0
    hit = np.isin(keys, again).astype(np.int64)
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += hit
    edges[window : window + n] -= hit
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


_KIND = np.ones(256, np.uint8)  # starts a code point
_KIND[0x80:0xC0] = 0
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[list(SYMBOLS)] = 1


def text_counts(text: bytes) -> tuple[int, ...]:
    """COUNTS of one text in UTF-8."""
    words = text.split()  # bytes split at ASCII white space only
    octets = np.frombuffer(text, np.uint8)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        int(_KIND[octets].sum(dtype=np.int64)),
        int(_SYMBOL[octets].sum(dtype=np.int64)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = batch.schema.names
        found = [text_counts(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(columns.index("text"))]
        counts = np.array(found, np.int64).reshape(-1, len(COUNTS))
        kept = [batch.column(i) for i, c in enumerate(columns) if c != "text"]
        yield pa.RecordBatch.from_arrays(
            kept + [pa.array(counts[:, i]) for i in range(len(COUNTS))], [c for c in columns if c != "text"] + COUNTS
        )


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(id, grp, COUNTS), a row per document; grp names its language and source, null unlike empty."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))
    rows = in_small_batches(docs).select(
        F.col(id_col).alias("id"),
        F.to_json(F.array(part(lang_col), part(source_col))).alias("grp"),
        F.col(text_col).cast("binary").alias("text"),
    )
    id_type = dict(rows.dtypes)["id"]
    return rows.mapInArrow(_count_batches, f"id {id_type}, grp string, " + ", ".join(f"{c} long" for c in COUNTS))


def _vector() -> list[Column]:
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return [
        F.log1p("n_words"),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
    ]


PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
ESTIMATES = ["det"] + [f"m{i}" for i in range(P)] + [f"w{i}{j}" for i, j in PAIRS]
_PARAMETERS = "grp string, start int, " + ", ".join(f"{c} double" for c in ESTIMATES)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a group and start, a row each, into its centre and inverse covariance."""
    prior, least = np.diag(np.square(PRIOR_SPREADS)), np.diag(np.square(LEAST_SPREADS))
    for batch in batches:
        t = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names) if n not in ("grp", "start")}
        n = t["n"].astype(float)
        mean = np.stack([t[f"s{i}"] for i in range(P)], 1) / n[:, None]
        cov = np.empty((len(n), P, P))
        for i, j in PAIRS:
            cov[:, i, j] = cov[:, j, i] = t[f"q{i}{j}"] - n * mean[:, i] * mean[:, j]
        cov = (cov * CONSISTENCY + PRIOR_ROWS * prior) / (n + PRIOR_ROWS)[:, None, None] + least
        inverse, det = np.linalg.inv(cov), np.linalg.det(cov)
        columns = [batch.column(batch.schema.names.index(c)) for c in ("grp", "start")] + [pa.array(det)]
        columns += [pa.array(np.ascontiguousarray(mean[:, i])) for i in range(P)]
        columns += [pa.array(np.ascontiguousarray(inverse[:, i, j]) * (1 if i == j else 2)) for i, j in PAIRS]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PARAMETERS.split(", ")])


def _distance() -> Column:
    total = F.lit(0.0)
    for i, j in PAIRS:
        total = total + F.col(f"w{i}{j}") * (F.col(f"x{i}") - F.col(f"m{i}")) * (F.col(f"x{j}") - F.col(f"m{j}"))
    return F.greatest(total, F.lit(0.0))


def _starts(vectors: DataFrame) -> DataFrame:
    """(grp, start, ESTIMATES): medians with quartiles, the middles of the shortest halves, and DRAWN vectors with the widths of those."""
    x = [F.col(f"x{i}") for i in range(P)]
    slices = [F.percentile_approx(x[i], [j / SLICES for j in range(SLICES + 1)], 1000).alias(f"p{i}") for i in range(P)]
    drawn = [F.min_by(F.struct(*x), F.xxhash64(F.lit(k), *x)).alias(f"drawn{k}") for k in range(DRAWN)]
    found = vectors.groupBy("grp").agg(*slices, *drawn)

    def half(i: int) -> Column:
        p = lambda j: F.get(f"p{i}", j)
        ends = lambda j: F.struct((p(j + SLICES // 2) - p(j)).alias("width"), ((p(j + SLICES // 2) + p(j)) / 2).alias("middle"))
        return F.array_min(F.transform(F.sequence(F.lit(0), F.lit(SLICES // 2)), ends)).alias(f"half{i}")

    found = found.select("*", *(half(i) for i in range(P)))
    # Half of a normal distribution is within 1.349 spreads.
    spread = lambda width, i: F.greatest(width / 1.349, F.lit(LEAST_SPREADS[i]))
    halves = [spread(F.col(f"half{i}.width"), i) for i in range(P)]
    quartiles = [spread(F.get(f"p{i}", F.lit(SLICES * 3 // 4)) - F.get(f"p{i}", F.lit(SLICES // 4)), i) for i in range(P)]
    medians = [F.get(f"p{i}", F.lit(SLICES // 2)) for i in range(P)]
    starts = [(medians, quartiles), ([F.col(f"half{i}.middle") for i in range(P)], halves)]
    starts += [([F.col(f"drawn{k}.x{i}") for i in range(P)], halves) for k in range(DRAWN)]
    rows = []
    for k, (middle, width) in enumerate(starts):
        inverse = [(1 / (width[i] * width[i]) if i == j else F.lit(0.0)) for i, j in PAIRS]
        values = [F.lit(float("inf")), *middle, *inverse]
        rows.append(F.struct(F.lit(k).alias("start"), *(v.alias(c) for v, c in zip(values, ESTIMATES))))
    return found.select("grp", F.inline(F.array(*rows)))


def robust_estimates(vectors: DataFrame, steps: int = STEPS) -> DataFrame:
    """vectors: (grp, x0..x4) -> the parameters of each group: centre m, inverse covariance w (off the diagonal doubled).

    The steps go on until no determinant falls by a thousandth; if one still does after so many steps, it is an error.
    """
    vectors = written(vectors.select("grp", *(f"x{i}" for i in range(P))).distinct(), "vectors")
    parameters = written(_starts(vectors).withColumn("moving", F.lit(True)), "estimates")
    run = ["grp", "start"]
    for _ in range(steps):
        # From about e^-12 up: below that all are one bin.
        moving = parameters.filter("moving")
        near = vectors.join(moving, "grp").withColumn("bin", F.floor(F.log(_distance() + 6e-6) * BINS).cast("int"))
        bins = near.groupBy(*run, "bin").agg(F.count("*").alias("n"))
        up_to = Window.partitionBy(*run).orderBy("bin")
        counted = bins.withColumns({"upto": F.sum("n").over(up_to), "wanted": H * F.sum("n").over(Window.partitionBy(*run))})
        share = (F.col("wanted") - F.col("upto") + F.col("n")) / F.col("n")
        last = counted.filter("upto >= wanted").groupBy(*run).agg(F.min("bin").alias("last"), F.min_by(share, "bin").alias("share"))
        nearest = near.join(written(last, "bins"), run).filter("bin <= last")
        weight = F.when(F.col("bin") < F.col("last"), 1.0).otherwise(F.col("share"))
        sums = nearest.withColumn("weight", weight).groupBy(*run).agg(
            F.sum("weight").alias("n"), *(F.sum(F.col("weight") * F.col(f"x{i}")).alias(f"s{i}") for i in range(P)),
            *(F.sum(F.col("weight") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in PAIRS),
        )
        better = sums.mapInArrow(_solve, _PARAMETERS).select(*run, F.struct(*ESTIMATES).alias("new"))
        fell = F.coalesce(F.col("new.det") < F.col("det") * 0.999, F.lit(False))
        values = [F.when(fell, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in ESTIMATES]
        parameters = written(parameters.join(better, run, "left").select(*run, *values, fell.alias("moving")), "estimates")
        if parameters.filter("moving").isEmpty():
            break
    else:
        raise RuntimeError(f"determinants still fall after {steps} steps")
    best = parameters.groupBy("grp").agg(F.min_by(F.struct(*ESTIMATES), F.struct("det", "start")).alias("best"))
    return best.select("grp", "best.*")


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    steps: int = STEPS, cutoff: float = CUTOFF,
) -> DataFrame:
    """id_col, COUNTS, base_failed, distance, kept: a row per row of docs.

    A null or empty text has no words and fails the base rules (fewer than 20 words, or more than 30 % of its words in
    repeated windows).  Documents that fail them take no part in the estimates and have no distance.  Null languages
    and sources are groups of their own.  No rows in, no rows out; other columns are not looked at.
    """
    counted = statistics(docs, id_col, text_col, lang_col, source_col)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = written(counted.withColumn("base_failed", failed).select("*", *(x.alias(f"x{i}") for i, x in enumerate(_vector()))), "counts")
    sound = rows.filter("not base_failed")
    parameters = robust_estimates(sound.select("grp", *(f"x{i}" for i in range(P))), steps)
    judged = sound.join(parameters, "grp").withColumn("distance", _distance())
    columns = ["id", *COUNTS, "base_failed"]
    out = judged.select(*columns, "distance", (F.col("distance") <= cutoff).alias("kept")).unionByName(
        rows.filter("base_failed").select(*columns, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    )
    return out.withColumnRenamed("id", id_col)
