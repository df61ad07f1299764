"""Hashing, near duplicates, the quality classifier and the outlier rules against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import plain
from spanweave.llm import graph, hashing, importance, near_copies, outliers

TEXTS = ["", None, " ", "a", "A b", "a B  c\td e", "x" * 3000, "é ü ñ", "one two three four five six", "b\x0bc\x1cd", "a\n\nb"]
DOCS = "doc_id long, text string, lang string, source string"


def test_words_are_hashed_alike_wherever_they_stand():
    data, bounds = next(hashing.text_chunks(pa.array(TEXTS)))
    hashes, starts = hashing.token_hashes(data, bounds)
    seen = {}
    for i, text in enumerate(TEXTS):
        own = hashes[starts[i] : starts[i + 1]]
        expected = plain.words(text)
        assert len(own) == len(expected)
        for h, w in zip(own, expected):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_texts_take_their_own_chunk():
    texts = pa.array(["a b", "w " * (hashing.CHUNK_BYTES // 2 + 5), "a b"])
    sizes = [len(b) - 1 for _, b in hashing.text_chunks(texts)]
    assert sum(sizes) == 3 and len(sizes) == 3
    found = [hashing.token_hashes(d, b)[0] for d, b in hashing.text_chunks(texts)]
    assert (found[0] == found[2]).all() and len(set(found[1])) == 1


def test_words_whose_letters_alternate_to_cancel_are_apart():
    flip = str.maketrans("ab", "ba")
    one = "a"
    while len(one) < 1 << 13:
        one += one.translate(flip)
        texts = pa.array([f"{w} x y z end" for w in (one, one.translate(flip))])
        sets = list(near_copies.shingle_sets(texts))
        assert len(sets[0]) == len(sets[1]) == 1 and sets[0][0] != sets[1][0]
        for data, bounds in hashing.text_chunks(texts):
            hashes, starts = hashing.token_hashes(data, bounds)
            assert hashes[0] != hashes[starts[1]] and (hashes[1:5] == hashes[starts[1] + 1 :]).all()


def test_shingle_sets():
    for text, found in zip(TEXTS, near_copies.shingle_sets(pa.array(TEXTS))):
        assert len(found) == len(plain.shingles(text))


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    for size in (1, 7, 60, 1000, 3000):
        for share in (0.2, 0.75, 1.0):
            shared = int(2 * size * share / (1 + share))
            a = np.unique(pool[:size])
            b = np.unique(np.concatenate([pool[size - shared : size], rng.integers(0, 2**63, size - shared, dtype=np.uint64)]))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            agree = (near_copies.sketch(a) == near_copies.sketch(b)).mean()
            assert abs(agree - true) < 5 * np.sqrt(true * (1 - true) / min(size, near_copies.BINS)) + 0.01


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, 200 + i) for i in range(50)] + [(7, 7), (8, 9), (9, 8)]
    found = {r.node: r.label for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(found[i] == 100 for i in range(100, 161)) and all(found[200 + i] == 5 for i in range(50))
    assert found[8] == found[9] == 8 and 7 not in found
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_texts(seed=3):
    """Groups of variants, chains of variants, copies and unrelated texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(8, 300))]
        texts.append(" ".join(base))
        current = list(base)
        for _ in range(rng.randint(0, 12)):
            current = list(current if rng.random() < 0.5 else base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                current[rng.randrange(len(current))] = word()
            texts.append(rng.choice(["  ", "\n"]).join(current).upper() if rng.random() < 0.3 else " ".join(current))
    return texts + ["", None, "   ", "a b", "A  b", "a b c", "long " * 30_000]


def test_near_copies_against_all_pairs(spark):
    texts = dict(enumerate(near_texts()))
    rows = spark.createDataFrame([(i, t, "en", "s") for i, t in texts.items()], DOCS).withColumn("class", F.lit(1))
    expected = plain.near_groups(texts)
    found = near_copies.mark_near_copies(rows).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    left = near_copies.drop_near_copies(rows)
    assert left.columns == rows.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, (_, c) in expected.items() if i == c)


def prefix_pairs(spark, sets, labels):
    """The pairs that prefix filtering leaves, and those that are similar, of sets with different labels."""
    owners = {}
    for i, elements in enumerate(sets):
        for e in elements:
            owners.setdefault(e, []).append(i)
    shared = [(i, e, len(own)) for e, own in owners.items() if len(own) > 1 for i in own]
    known = np.bincount([i for i, _, _ in shared], minlength=len(sets))
    rows = [(0, i, len(s), int(known[i]), labels[i]) for i, s in enumerate(sets)]
    split = spark.createDataFrame(rows, "key long, class long, size long, known long, label long")
    found = near_copies._prefix_pairs(split, spark.createDataFrame(shared, "class long, element long, n long"))
    links = {
        (i, j) for j in range(len(sets)) for i in range(j)
        if labels[i] != labels[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    }
    return {(r.a, r.b) for r in found.collect()}, links


def test_prefix_pairs_hold_every_link(spark):
    rng = np.random.default_rng(5)
    base, sets = np.arange(140), []
    for i in range(150):  # a group around one base, of many sizes: some lose much of it, some add much
        kept = rng.permutation(base)[: rng.integers(95, 141)]
        sets.append({*kept.tolist(), *(1000 + rng.integers(0, 300, rng.integers(0, 30))).tolist()})
    sets += [set(range(5000, 5000 + n)) for n in (1, 2, 3, 4, 27, 30, 31, 33, 40, 41, 43, 64)]
    for labels in (list(range(len(sets))), [i % 3 if i < 100 else i for i in range(len(sets))]):
        found, links = prefix_pairs(spark, sets, labels)
        assert found >= links and len(links) > 100


def test_prefix_pairs_of_a_group_without_links_are_few(spark):
    rng = np.random.default_rng(6)
    base, sets = np.arange(140), []
    for i in range(300):  # all 44,850 pairs share common elements
        kept = rng.permutation(base)[: rng.integers(70, 120)].tolist()
        sets.append({*kept, *range(1000 * (i + 1), 1000 * (i + 1) + 140 - len(kept))})
    found, links = prefix_pairs(spark, sets, list(range(len(sets))))
    assert found >= links and len(found) < len(sets)


def test_near_copies_with_odd_ids(spark):
    base = " ".join(f"w{i}" for i in range(100))
    rows = [(None, base), (3, base + " end"), (3, "other text that is alone here"), (4, base), (4, base), (None, "quite alone it stands here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in near_copies.mark_near_copies(docs).collect()), key=str)
    assert found == sorted(
        [(None, 3, False), (3, 3, True), (3, 3, True), (4, 3, False), (4, 3, False), (None, None, True)], key=str
    )
    assert sorted(str(r.doc_id) for r in near_copies.drop_near_copies(docs).collect()) == ["3", "3", "None"]
    assert near_copies.mark_near_copies(docs.limit(0)).count() == 0
    assert near_copies.drop_near_copies(docs.limit(0)).count() == 0


def test_kth_largest(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=9000), np.full(1000, 0.25), [1e300, -1e300]])
    keys = spark.createDataFrame([(float(v),) for v in values], "key double")
    ordered = np.sort(values)[::-1]
    for k in (1, 2, 3000, 4200, 5000, 10_002):
        assert importance.kth_largest(keys, "key", k) == ordered[k - 1]
    assert importance.kth_largest(spark.range(5).selectExpr("1.5D key"), "key", 3) == 1.5


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    known = labels.filter("doc_id % 2 = 0")
    found = importance.classify(docs, known).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    good = [r.kept for r in found if r.quality == 1]
    bad = [r.kept for r in found if r.quality == 0]
    assert np.mean(good) > 0.9 and np.mean(bad) < 0.25
    kept = {r.doc_id for r in importance.classify(docs, known).filter("kept").collect()}
    assert kept == {r.doc_id for r in importance.resample(docs, known).collect()}


def test_classifier_on_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b", 0), (1, "a b", 0), (2, None, 0), (None, "", 0), (3, "c " * 50_000, 0)], "doc_id long, text string, kept int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int")
    found = importance.classify(docs, labels).collect()
    assert len(found) == 5 and {r.log_weight for r in found if r.doc_id in (2, None)} == {0.0}
    assert importance.resample(docs, labels).columns == docs.columns
    assert importance.classify(docs, labels.limit(0)).count() == 5
    assert importance.classify(docs.limit(0), labels).count() == 0
    assert importance.resample(docs.limit(0), labels).count() == 0


def test_text_counts_against_plain_python(spark, sf):
    rows = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [t or "" for t in TEXTS] + ["a b c d e f g h " * 3, "q\nq\n \nq", "<p>&|*#$%</p>"]
    for text in rows:
        assert outliers.text_counts(text.encode()) == plain.text_counts(text)


def mcd(x, steps=50):
    """Concentration steps on one group in numpy, with an exact quantile."""
    low, mid, high = (np.quantile(x, q, axis=0, method="inverted_cdf") for q in (0.25, 0.5, 0.75))
    inverse = np.diag(1 / np.maximum((high - low) / 1.349, outliers.LEAST_SPREADS) ** 2)
    for _ in range(steps):
        d = np.einsum("ij,jk,ik->i", x - mid, inverse, x - mid)
        near = x[d <= np.sort(d)[int(np.ceil(outliers.H * len(x))) - 1]]
        n, mid = len(near), near.mean(axis=0)
        cov = (near - mid).T @ (near - mid) * outliers.CONSISTENCY + outliers.PRIOR_ROWS * np.diag(np.square(outliers.PRIOR_SPREADS))
        inverse = np.linalg.inv(cov / (n + outliers.PRIOR_ROWS) + np.diag(np.square(outliers.LEAST_SPREADS)))
    return mid, inverse


def test_estimates_against_numpy(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(800, 5)) * [1, 0.3, 0.2, 0.5, 0.4] + [5, 1.5, 0, 0, 0]
    x[:150] = rng.normal(size=(150, 5)) * 0.1 + [9, 4, 3, 3, 3]  # 19 % bad, close together
    rows = spark.createDataFrame([("g", *map(float, r)) for r in x], "grp string, " + ", ".join(f"x{i} double" for i in range(5)))
    found = outliers.robust_estimates(rows, 20).first()
    mid, inverse = mcd(x)
    assert np.allclose([found[f"m{i}"] for i in range(5)], mid, atol=0.05)
    own = rows.crossJoin(spark.createDataFrame([found]).drop("grp", "det")).select(outliers._distance()).collect()
    d = np.array([r[0] for r in own])
    assert np.corrcoef(d[150:], np.einsum("ij,jk,ik->i", x - mid, inverse, x - mid)[150:])[0, 1] > 0.99
    assert (d[:150] > outliers.CUTOFF).all() and (d[150:] < outliers.CUTOFF).all()


VECTORS = "grp string, " + ", ".join(f"x{i} double" for i in range(5))


def distances(spark, x):
    """Squared distances of the rows of x as one group, with the production settings."""
    rows = spark.createDataFrame([("g", i, *map(float, r)) for i, r in enumerate(x)], VECTORS.replace(",", ", row long,", 1))
    judged = rows.join(outliers.robust_estimates(rows.drop("row")), "grp").select("row", outliers._distance().alias("d"))
    return np.array([r.d for r in judged.orderBy("row").collect()])


def clean_vectors(n, seed=4):
    """Like sound prose: hardly a symbol, repeated line or repeated word."""
    return np.random.default_rng(seed).normal(size=(n, 5)) * [0.9, 0.04, 0.002, 0.02, 0.02] + [5.6, 1.62, 0.002, 0.02, 0.02]


@pytest.mark.parametrize("share", [1 / 3, 0.45])
def test_copies_of_one_bad_document_do_not_make_it_usual(spark, share):
    x = clean_vectors(900)
    x[: int(900 * share)] = [6, 2.05, 0.45, 0.02, 0.02]
    d = distances(spark, x)
    bad = np.arange(900) < int(900 * share)
    assert (d[bad] > outliers.CUTOFF).all() and np.mean(d[~bad] < outliers.CUTOFF) > 0.99


@pytest.mark.parametrize("share", [0.3, 0.4])
def test_like_bad_documents_do_not_become_usual(spark, share):
    x = clean_vectors(900)
    n = int(900 * share)
    x[:n] = np.random.default_rng(6).normal(size=(n, 5)) * [0.3, 0.01, 0.01, 0.01, 0.01] + [6, 2.05, 0.45, 0.02, 0.02]
    d = distances(spark, x)
    assert (d[:n] > outliers.CUTOFF).all() and np.mean(d[n:] < outliers.CUTOFF) > 0.99


def test_steps_go_on_until_no_determinant_falls(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(800, 5)) * [1, 0.3, 0.2, 0.5, 0.4] + [5, 1.5, 0, 0, 0]
    x[:150] = rng.normal(size=(150, 5)) * 0.1 + [9, 4, 3, 3, 3]
    rows = spark.createDataFrame([("g", *map(float, r)) for r in x], VECTORS)
    found = outliers.robust_estimates(rows).first()  # the production setting
    assert np.allclose([found[f"m{i}"] for i in range(5)], mcd(x)[0], atol=0.05)
    with pytest.raises(RuntimeError, match="still fall after 2 steps"):
        outliers.robust_estimates(rows, 2)


def test_outliers_on_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = outliers.judge(docs).join(labels, "doc_id").collect()
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert np.mean([r.kept for r in found if r.quality == 1 and not r.base_failed]) > 0.99
    assert np.mean([r.kept for r in found if r.quality == 0]) < 0.25


def test_long_texts_of_repeated_short_lines_are_rejected(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7)))
    places = [("en", "src7"), ("fr", "src4"), ("es", "src1")]  # 38, 13 and 9 documents
    menus = []
    for i, place in enumerate(places):
        lines = [" ".join(word() for _ in range(3)) for _ in range(30)]
        menus.append((-1 - i, "\n".join(rng.choice(lines) for _ in range(600)), *place))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = outliers.judge(docs.unionByName(spark.createDataFrame(menus, DOCS)))
    found = judged.join(labels, "doc_id", "left").collect()
    planted = [r for r in found if r.doc_id < 0]
    assert len(planted) == 3 and not any(r.base_failed or r.kept for r in planted)
    assert np.mean([r.kept for r in found if r.quality == 1 and not r.base_failed]) > 0.99


def test_outliers_on_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None, None, None), (2, "", "en", ""), (3, text, None, "s"), (3, text, None, "s"), (None, text, "en", None), (4, "w " * 60_000, "en", "s")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"grp": F.lit(0), "kept": F.lit(0)})
    found = outliers.judge(docs).collect()
    assert len(found) == 6
    assert {r.doc_id: r.kept for r in found} == {1: False, 2: False, 3: True, None: True, 4: False}
    assert outliers.judge(docs.limit(0)).count() == 0
