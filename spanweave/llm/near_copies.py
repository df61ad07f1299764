"""Near duplicates by fast similarity sketching, banding and exact verification.

A document's set holds its distinct 5-word shingles, as 64-bit hashes.  The sketch has BINS coordinates.  In each of
BINS rounds every element falls into one bin with a value that grows by round; in BINS more rounds all elements fall
into the bin of the round.  A coordinate is the least value of its bin, so every one is filled, and how many coordinates
of two sets agree is concentrated around their similarity.  Bands of ROWS coordinates make buckets; two sets with a
similarity of exactly 0.75 share none of BANDS buckets with a chance of 4 in a million.

Documents with one set are a class; from there on a class counts once, and its set is built once.  Pairs of a bucket are
confirmed on the full sets in rounds, so that a group of m copies costs about m confirmations and not m * m.  First every
class is compared with the least of all classes it shares a bucket with.  Where a bucket then still holds several
components, classes with too few elements that occur anywhere else leave; in each of ROUNDS rounds every bucket names a
member, first the one with most elements that occur elsewhere, and a class is compared with the one that most of its
buckets name.  What is left is joined by prefix filtering:
two similar sets share one of their rarest elements, and the first they share comes early in both: within a seventh of sets
of one size.  Of the classes that share such an element those of its largest component are not paired among themselves.
So a pair of a bucket is confirmed, refuted, connected already, or ruled out by counts or by the sketches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.llm.common import fresh, in_small_batches
from spanweave.llm.exact_copies import cells_of, flag_repeated
from spanweave.llm.graph import components
from spanweave.llm.hashing import scramble, text_chunks, token_hashes, windows
from spanweave.shared import written

WORDS = 5
PERCENT = 75
BANDS, ROWS = 64, 6
BINS = BANDS * ROWS
ROUNDS = 3
#: Of the coordinates' last four bits so many agree, but for a chance of 1 in 10 million, when two sets are similar.
LEAST_AGREEING = 250

_U = np.uint64
_rng = np.random.default_rng(7)
_ROUND = _rng.integers(0, 2**63, 2 * BINS, dtype=np.uint64)
_BAND = _rng.integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) * _U(2) + _U(1)
_SEED = _rng.integers(0, 2**63, BANDS, dtype=np.uint64)
_LOW = _U(0xFFFFFFFF)
_NONE = _U(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, sorted; the whole text is one if it has fewer words; none without words."""
    for data, bounds in text_chunks(texts):
        words, starts = token_hashes(data, bounds)
        runs, run_starts = windows(words, starts, WORDS)
        for i in range(len(starts) - 1):
            n = starts[i + 1] - starts[i]
            if n >= WORDS:
                yield np.unique(runs[run_starts[i] : run_starts[i + 1]])
            elif n:
                whole, _ = windows(words[starts[i] : starts[i + 1]], np.array([0, n]), int(n))
                yield scramble(whole + _U(n))
            else:
                yield np.zeros(0, np.uint64)


def sketch(elements: np.ndarray) -> np.ndarray:
    """BINS coordinates of a set that is not empty."""
    out = np.full(BINS, _NONE)
    # Rounds in blocks: a later round's values are larger, so that rounds beyond the one that fills the last bin change nothing.
    at, step = 0, -(-8 * BINS // len(elements))
    while at < BINS and out.max() == _NONE:
        rounds = np.arange(at, min(BINS, at + step), dtype=np.uint64)
        h = scramble(elements[None, :] + _ROUND[at : at + len(rounds), None])
        bins = ((h >> _U(32)) % _U(BINS)).astype(np.int64)
        np.minimum.at(out, bins.ravel(), ((rounds[:, None] << _U(32)) | (h & _LOW)).ravel())
        at += step
    for empty in np.flatnonzero(out == _NONE):
        h = scramble(elements + _ROUND[BINS + empty])
        out[empty] = (_U(BINS + empty) << _U(32)) | (h & _LOW).min()
    return out


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    return scramble((coordinates.reshape(BANDS, ROWS) * _BAND).sum(axis=1, dtype=np.uint64) + _SEED)


def last_bits(coordinates: np.ndarray) -> np.ndarray:
    """Four bits of each coordinate, sixteen to a number."""
    nibbles = (coordinates & _U(15)).reshape(-1, 16) << (np.arange(16, dtype=np.uint64) * _U(4))
    return np.bitwise_or.reduce(nibbles, axis=1)


def _agreeing(one: str, other: str) -> str:
    """SQL: how many coordinates of two sketches agree in their last bits."""
    either = "(d | shiftrightunsigned(d, 1))"
    differ = f"bit_count(({either} | shiftrightunsigned({either}, 2)) & 1229782938247303441L)"  # 0x1111...
    return f"({BINS} - aggregate(zip_with({one}, {other}, (a, b) -> a ^ b), 0, (n, d) -> n + {differ}))"


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(np.concatenate(parts) if parts else []))


def _signed(values: np.ndarray | list) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        classes, sizes, bands, bits = [], [], [], []
        for elements in shingle_sets(batch.column(1)):
            coordinates = sketch(elements) if len(elements) else elements
            sizes.append(len(elements))
            classes.append(_class_of(elements))
            bands.append(band_keys(coordinates) if len(elements) else elements)
            bits.append(last_bits(coordinates) if len(elements) else elements)
        columns = [batch.column(0), _signed(classes), pa.array(sizes, pa.int64()), _lists(bands), _lists(bits)]
        yield pa.RecordBatch.from_arrays(columns, ["id", "class", "size", "bands", "bits"])


def _class_of(elements: np.ndarray) -> int:
    return int(scramble(scramble(elements).sum(dtype=np.uint64, keepdims=True))[0])


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(batch.column(1)))
        columns = [batch.column(0), _signed([_class_of(s) for s in sets]), _lists(sets)]
        yield pa.RecordBatch.from_arrays(columns, ["id", "class", "elements"])


@F.arrow_udf(T.LongType())
def class_of(texts: pa.Array) -> pa.Array:
    return _signed([_class_of(s) for s in shingle_sets(texts)])


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar, on their full sets."""
    left = sets.select(F.col("class").alias("a"), F.col("elements").alias("set_a"))
    right = sets.select(F.col("class").alias("b"), F.col("elements").alias("set_b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    counts = both.select("a", "b", F.size("set_a").alias("m"), F.size("set_b").alias("n"), F.size(F.array_intersect("set_a", "set_b")).alias("s"))
    return counts.filter(f"100L * s >= {PERCENT}L * (m + n - s)").select("a", "b")


def _fits(one: str, other: str) -> str:
    """Sets of sizes too far apart cannot be similar."""
    return f"100 * least({one}, {other}) >= {PERCENT} * greatest({one}, {other})"


def _near(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that share a bucket and whose sketches do not rule them out."""
    left, right = (classes.select(F.col("class").alias(c), F.struct("bits", "bands").alias(f"of_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b")
    return both.filter(f"{_agreeing('of_a.bits', 'of_b.bits')} >= {LEAST_AGREEING} AND arrays_overlap(of_a.bands, of_b.bands)").select("a", "b")


def class_links(docs: DataFrame, sketches: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, label): the components of the classes that have links."""
    classes = written(sketches.filter("size > 0").dropDuplicates(["class"]).select("class", "size", "bands", "bits"), "classes")
    rows = classes.select("class", "size", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(
        F.min("class").alias("pivot"), F.max("class").alias("last"), F.min_by("size", "class").alias("pivot_size")
    )
    buckets = written(buckets.filter("pivot < last").select("key", "pivot", "pivot_size"), "buckets")
    members = written(rows.join(buckets, "key"), "members")

    sets = _sets(docs, sketches, members.select("class").distinct(), id_col, text_col)
    first = members.filter("class <> pivot AND " + _fits("size", "pivot_size")).groupBy(F.col("class").alias("b"))
    labels = written(components(_confirmed(first.agg(F.min("pivot").alias("a")), sets)), "labels")

    split = _split(members.select("key", "class", "size"), labels)
    shared = _shared_elements(split, sets)
    known = shared.groupBy("class").agg(F.count("*").alias("known"))
    # A partner has at least PERCENT of its size, so at least PERCENT of its elements must occur elsewhere.
    split = written(split.join(known, "class").filter(f"100 * known >= {PERCENT} * size"), "able")
    for i in range(ROUNDS):
        # First a member in the middle of its group, most of whose elements others have; then any, by chance.
        rank = -F.col("known") if i == 0 else F.lit(0)
        by = F.struct(rank.alias("rank"), F.xxhash64("class", "key", F.lit(i)).alias("h"), "class", "size", "known", "label")
        named = split.groupBy("key").agg(F.min(by).alias("p"))
        checks = f"label <> p.label AND {_fits('size', 'p.size')} AND {_enough('size', 'known', 'p.size', 'p.known')}"
        often = split.join(written(named, "named"), "key").filter(checks).groupBy("class", F.col("p.class").alias("other")).agg(F.count("*").alias("n"))
        chosen = often.groupBy("class").agg(F.max(F.struct("n", "other")).alias("most"))
        stars = written(chosen.select(F.least("class", "most.other").alias("a"), F.greatest("class", "most.other").alias("b")).distinct(), "stars")
        labels = written(components(_edges(labels).unionByName(_confirmed(_near(stars, classes), sets))), "labels")
        split = _split(split.select("key", "class", "size", "known"), labels)

    pairs = written(_prefix_pairs(split, shared), "pairs")
    return components(_edges(labels).unionByName(_confirmed(_near(pairs, classes), sets)))


def _enough(size: str, known: str, other_size: str, other_known: str) -> str:
    """Two similar sets share so much that each must have as many elements which some other set has, too."""
    return f"{100 + PERCENT} * least({known}, {other_known}) >= {PERCENT} * ({size} + {other_size})"


def _split(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, with their present label."""
    named = members.join(labels.withColumnRenamed("node", "class"), "class", "left")
    named = written(named.withColumn("label", F.coalesce("label", "class")), "named")
    keys = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    return written(named.join(written(keys.select("key"), "keys"), "key", "left_semi"), "split")


def _shared_elements(split: DataFrame, sets: DataFrame) -> DataFrame:
    """(class, element, n): the elements that n > 1 classes of split have."""
    own = sets.join(split.select("class").distinct(), "class", "left_semi")
    elements = written(own.select("class", F.explode("elements").alias("element")), "elements")
    counts = written(elements.groupBy("element").agg(F.count("*").alias("n")).filter("n > 1"), "counts")
    return written(elements.join(counts, "element").select("class", "element", "n"), "shared")


def _shared_at_least(one: str, other: str) -> str:
    """SQL: how many elements two sets of these sizes share at least, when they are similar."""
    return f"((({one}) + ({other})) * {PERCENT}L + {99 + PERCENT}L) div {100 + PERCENT}L"


def _size_step(size: str) -> str:
    """SQL: the number of a range of sizes; a range is at most a sixteenth wide, and sizes below 32 have one each."""
    shift = f"greatest(0, length(bin({size})) - 5)"
    return f"({shift} * 16 + shiftright({size}, {shift}))"


_LEAST_OF_STEP = "CASE WHEN step < 32 THEN step ELSE shiftleft(step - 16 * (step div 16 - 1), CAST(step div 16 - 1 AS INT)) END"


def _prefix_pairs(split: DataFrame, shared: DataFrame) -> DataFrame:
    """(a, b): classes of split with two labels that may be similar, by the rarest elements of their sets.

    Elements are in the order of how many classes have them.  Those that one class alone has come first and are left out.
    Two similar sets share so many elements that the first they share leaves room, in both, for the rest: what it must
    leave depends on both sizes.  So a set looks for larger partners by a prefix for its own size, and for smaller ones
    by one prefix per range of sizes: common elements, which all sets of a large group have, are beyond these prefixes.
    """
    left = split.groupBy("class").agg(F.first("size").alias("size"), F.first("known").alias("known"), F.first("label").alias("label"))
    order = Window.partitionBy("class").orderBy("n", "element")
    ranked = shared.join(written(left, "left"), "class").withColumn("place", F.row_number().over(order))
    smallest = f"(size * {PERCENT}L + 99L) div 100"
    ranked = ranked.filter(f"place <= known - {smallest} + 1").drop("n")
    small = ranked.withColumn("step", F.expr(_size_step("size"))).filter(f"place <= known - {_shared_at_least('size', 'size')} + 1")
    steps = f"explode(sequence({_size_step(smallest)}, {_size_step('size')}))"
    large = ranked.withColumn("step", F.expr(steps))
    large = large.filter(f"place <= known - {_shared_at_least('size', f'greatest({smallest}, {_LEAST_OF_STEP})')} + 1")
    rows = written(small.withColumn("role", F.lit("small")).unionByName(large.withColumn("role", F.lit("large"))), "prefixes")
    per_label = rows.groupBy("element", "step", "label").agg(F.count("*").alias("m"))
    main = per_label.groupBy("element", "step").agg(F.max(F.struct("m", "label")).alias("most"), F.count("*").alias("labels"))
    main = written(main.filter("labels > 1").select("element", "step", F.col("most.label").alias("main")), "main")
    rows = written(rows.join(main, ["element", "step"]).withColumn("in_main", F.expr("label = main")).drop("main"), "postings")
    columns = ("class", "size", "known", "label", "place", "in_main")
    one, other = (
        rows.filter(F.col("role") == role).select("element", "step", *(F.col(c).alias(f"{c}_{i}") for c in columns))
        for i, role in ((1, "small"), (2, "large"))
    )
    least = _shared_at_least("size_1", "size_2")
    room = f"least(known_1 - place_1, known_2 - place_2) + 1 >= {least}"
    checks = f"(size_1, class_1) < (size_2, class_2) AND label_1 <> label_2 AND {_fits('size_1', 'size_2')} AND {room}"
    pairs = one.filter("NOT in_main_1").join(other, ["element", "step"]).filter(checks)
    pairs = pairs.unionByName(one.filter("in_main_1").join(other.filter("NOT in_main_2"), ["element", "step"]).filter(checks))
    return pairs.select(F.least("class_1", "class_2").alias("a"), F.greatest("class_1", "class_2").alias("b")).distinct()


def _edges(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("node").alias("a"), F.col("label").alias("b"))


def _sets(docs: DataFrame, sketches: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(class, elements) of the wanted classes.  A Bloom filter on the ids keeps the other texts out of the workers."""
    first = sketches.join(wanted, "class", "left_semi").groupBy("class").agg(F.min("id").alias("id"), F.count("id").alias("n"))
    ids = written(first, "wanted")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    maybe = flag_repeated(rows, "id", written(cells_of(ids.filter("n > 0"), "id"), "filter"), "maybe").filter("maybe OR id IS NULL")
    id_type = dict(rows.dtypes)["id"]
    found = maybe.select("id", "text").mapInArrow(_set_batches, f"id {id_type}, class long, elements array<long>")
    named = found.join(ids.withColumnRenamed("id", "first"), "class").filter("first = id OR (n = 0 AND id IS NULL)")
    return written(named.select("class", "elements").dropDuplicates(["class"]), "sets")


def mark_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_shingles, component_id (the smallest id reachable over links), kept: a row per row of docs.

    Null texts and texts without words have no shingles and no links: they are kept.  Rows that repeat an id and a text
    are of one component and kept or not together.  A null id is no component's smallest unless it has no other.  No rows
    in, no rows out; other columns are not looked at.
    """
    return _marked(docs, id_col, text_col).drop("class").withColumnRenamed("id", id_col)


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    texts = in_small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    id_type = dict(texts.dtypes)["id"]
    sketches = written(texts.mapInArrow(_sketch_batches, f"id {id_type}, class long, size long, bands array<long>, bits array<long>"), "sketches")
    labels = class_links(docs, sketches, id_col, text_col)
    rows = sketches.filter("size > 0").select("id", "class", "size").join(labels.withColumnRenamed("node", "class"), "class", "left")
    rows = written(rows.withColumn("label", F.coalesce("label", "class")), "labelled")
    least = written(rows.groupBy("label").agg(F.min("id").alias("component_id")), "components")
    found = rows.join(least, "label").select("id", "class", "size", "component_id")
    alone = sketches.filter("size = 0").select("id", "class", "size", F.col("id").alias("component_id"))
    return found.unionByName(alone).select(
        "id", "class", F.col("size").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that mark_near_copies() keeps, with all their columns.  Rows that cannot go are not shuffled."""
    gone = _marked(docs, id_col, text_col).filter("not kept").select(F.col("id").alias("_gone"), F.col("class").alias("_class"))
    gone = written(gone.distinct(), "gone")
    flag, own = fresh(docs, "_maybe"), fresh(docs, "_own")
    flagged = flag_repeated(docs, id_col, written(cells_of(gone, "_gone"), "filter"), flag)
    columns = [f"`{c}`" for c in docs.columns]
    maybe = flagged.filter(F.col(flag)).withColumn(own, class_of(text_col))
    rest = maybe.join(gone, F.col(id_col).eqNullSafe(F.col("_gone")) & (F.col(own) == F.col("_class")), "left_anti")
    return flagged.filter(~F.col(flag)).select(*columns).unionByName(rest.select(*columns))
