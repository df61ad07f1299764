"""Collocations, hard negatives and licence scans: plain Python, DuckDB at other sizes and odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks.compare import bag, duck
from spanweave.llm import collocations, hard_negatives, licences

DOCS = "doc_id long, text string, lang string"
VECTORS = "vec_id long, embedding array<double>, label int"
EXTRA = ("lang_", "phrase", "n", "id", "row", "hits", "places", "bucket", "words", "score", "chunk")


def clashing(df):
    return df.withColumns({c: F.lit("mine") for c in EXTRA})


def rows(df):
    return Counter(map(tuple, df.collect()))


# Collocations


def plain_phrases(docs, longest, least, top, inside):
    counts, total = Counter(), Counter()
    for _, text, lang in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang or "und", tuple(words[i : i + size])] += 1
    often = {k: v for k, v in counts.items() if v >= least and len(k[1]) > 1}
    found = {}
    for (lang, p), a in often.items():
        cuts = [(10**6 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        around = [v for (tongue, q), v in often.items() if tongue == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if not any(100 * v >= inside * a for v in around):
            found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return Counter(
        (lang, i, p.decode(), -a, left, right, total[lang], -score)
        for lang, best in found.items()
        for i, (score, a, p, left, right) in enumerate(sorted(best)[:top], 1)
    )


def odd_texts(seed, n=120):
    rng = random.Random(seed)
    pool = ["a", "b", "the", "The", "é", "É", "new", "york", "x y", "-"]
    gaps = [" ", "  ", "\t", " . ", ", ", "\n", "\n\n", "\x0b", "!? "]
    texts = ["".join(rng.choice(pool) + rng.choice(gaps) for _ in range(rng.randrange(30))) for _ in range(n)]
    texts += ["", None, " ", ".,;", "a " * 3000, "x" * 5000, "new york new york " * 50, "one two"] + [texts[0]] * 20
    return [(i, t, rng.choice(["en", "de", None, "und"])) for i, t in enumerate(texts)]


@pytest.mark.parametrize("longest, least, top, chunk_words", [(2, 3, 1000, 4), (3, 10, 40, 16), (4, 2, 500, 2), (5, 4, 500, 1)])
def test_phrases_against_plain_counts(spark, longest, least, top, chunk_words):
    docs = odd_texts(longest)
    df = clashing(spark.createDataFrame(docs, DOCS)).repartition(5)
    found = rows(collocations.collocations(df, longest=longest, least=least, top=top, chunk_words=chunk_words))
    assert found == plain_phrases(docs, longest, least, top, 50)


def test_crowded_bitmaps_change_nothing(spark, monkeypatch):
    docs = odd_texts(9)
    monkeypatch.setattr(collocations, "FILTER_BITS", collocations.BITMAP_BITS)
    found = rows(collocations.collocations(spark.createDataFrame(docs, DOCS), least=5))
    assert found == plain_phrases(docs, 3, 5, 2000, 50)


def test_chunks_join_to_the_text_and_copies_are_cut_alike():
    text = " ".join(random.Random(3).choices("abcdefghij", k=2000))
    alone = collocations.parse(pa.array(["en"]), pa.array([text])).to_pylist()
    within = collocations.parse(pa.array(["en"]), pa.array(["q r s " + text + " t u"])).to_pylist()
    same = {c["chunk"] for c in alone} & {c["chunk"] for c in within}
    assert len(same) >= len(alone) - 2 and len(alone) > 50
    owned = sum(c["n"] * (len(c["chunk"].split(" ")) - (0 if c["last"] else 2)) for c in alone)
    assert owned == 2000


def test_no_phrases(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, None, None), (2, "a. b", "en")], DOCS)).count() == 0
    with pytest.raises(ValueError):
        collocations.collocations(spark.createDataFrame([], DOCS), longest=1)


# Hard negatives


def plain_negatives(vectors, step, positives=5, negatives=3):
    one = {}
    for i, v, label in vectors:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        one[i] = min(one.get(i, (label, v)), (label, v))
    scaled = {i: (label, [int(np.floor(256 * x)) for x in v]) for i, (label, v) in one.items()}
    clamp = lambda s: max(-(2**63 - 1), min(2**63 - 1, s))
    out = Counter()
    for a, (label, v) in scaled.items():
        if a % step:
            continue
        scores = sorted((-clamp(sum(x * y for x, y in zip(v, w))), i) for i, (_, w) in scaled.items() if i != a)
        for p, i in [(p, i) for p, i in scores if scaled[i][0] == label][:positives]:
            fits = [(n, j) for n, j in scores if scaled[j][0] != label and 50 * -p <= 100 * -n <= 95 * -p][:negatives]
            out.update((a, i, rank, j, -p, -n) for rank, (n, j) in enumerate(fits, 1))
    return out


def odd_vectors(seed, n=400, size=6, scale=1.0):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, size)) * scale * rng.choice([0.2, 1, 3], (n, 1))
    vectors[: n // 3] = vectors[0]  # a third are copies
    vectors[5] = 0
    out = [(i, list(map(float, v)), int(rng.integers(0, 3))) for i, v in enumerate(vectors)]
    nan, inf = float("nan"), float("inf")
    out += [(None, [1.0] * size, 1), (n, None, 1), (n + 1, [1.0] * size, None), (n + 2, [nan] * size, 1), (n + 3, [inf] * size, 1)]
    out += [(n + 4, [None] * size, 1), (n + 10, [1.0], 2), (n + 11, [], 2), (10, [9.0] * size, 0), (20, *out[20][1:]), (-7, [0.5] * size, 1)]
    return out


@pytest.mark.parametrize("scale", [1.0, 1e8, 1e17])
def test_negatives_against_all_pairs(spark, monkeypatch, scale):
    monkeypatch.setattr(hard_negatives, "SLAB_ROWS", 32)
    vectors = odd_vectors(1, scale=scale) if scale == 1 else odd_vectors(2, 80, 3, scale)
    df = clashing(spark.createDataFrame(vectors, VECTORS))
    found = hard_negatives.hard_negatives(df, "id % 10 = 0")
    assert rows(found) == plain_negatives(vectors, 10)


def test_coordinates_rule_rows_out_and_lose_none():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(800, 8))
    rows = np.floor(25600 * rows / np.sqrt(np.square(rows).sum(axis=1))[:, None])
    slab = hard_negatives.Slab(rows, np.arange(800), np.zeros(800, int))
    batch = pa.RecordBatch.from_pylist([{"id": i, "label": 0, "vector": list(rows[i] / 256), "goals": []} for i in range(50)])
    anchors = hard_negatives.Anchors(batch.set_column(2, "vector", batch["vector"].cast(pa.list_(pa.float64()))), 256, 5)
    least = (0.9 * anchors.lengths * slab.longest).astype(np.int64)
    pairs = {(a, r): s for at, place, scores in slab.scored(anchors, least) for a, r, s in zip(at, place, scores)}
    true = rows[:50] @ rows.T
    assert all((a, r) in pairs for a, r in zip(*np.nonzero(true >= least[:, None])))
    assert all(true[a, r] == s for (a, r), s in pairs.items()) and 50 <= len(pairs) < 0.2 * true.size


def test_no_vectors(spark):
    assert hard_negatives.hard_negatives(spark.createDataFrame([], VECTORS), "id % 50 = 0").count() == 0
    assert hard_negatives.hard_negatives(spark.createDataFrame([(50, [1.0], 1)], VECTORS), "id % 50 = 0").count() == 0


# Licences


def notice(label):
    return next(text for name, text, _ in licences.TEMPLATES if name == label)


def scanned(spark, texts, **options):
    df = clashing(spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOCS))
    return {r.doc_id: r for r in licences.scan(df, **options).collect()}


def test_licences_of_small_texts(spark):
    filler = " ".join(f"word{i}" for i in range(500))
    isc = notice("isc")
    texts = [
        None, "", "nothing here", "Released under the MIT License.", "CC-BY-NC, cc by nc; the Apache License (Version 2)",
        f"{filler} {isc} {filler}", isc.replace("purpose", "John Doe purpose 2024"), isc.replace("fee", "charge"),
        " ".join(reversed(isc.split())), "mit " * 3000 + "under the mit license", f"{notice('bsd')} {filler} {isc}",
        f"{notice('gpl-2')}", f"{notice('gpl-3')}", "under the\x00mit\x7flicense", "éunder the mit license",
    ]
    found = scanned(spark, texts)
    assert len(found) == len(texts)
    assert [(found[i].base_labels, found[i].labels, found[i].n_base) for i in range(5)] == [
        ("", "", 0), ("", "", 0), ("", "", 0), ("mit", "mit", 1), ("apache-2,cc-by-nc", "apache-2,cc-by-nc", 3),
    ]
    assert (found[4].first_word, found[4].last_word, found[4].n_words) == (0, 7, 11)
    assert [found[i].labels for i in range(5, 13)] == ["isc", "isc", "", "", "mit", "bsd,isc", "gpl-2", "gpl-3"]
    assert found[9].first_word == found[9].last_word == 3000 and found[0].first_word is None
    assert found[5].score == 1.0 and 0.7 <= found[6].score <= 1.0 and found[7].score == 0.0
    assert found[13].n_base == 1 and found[14].n_base == 0


def test_rows_of_licence_scan_stay_apart(spark):
    df = spark.createDataFrame([(None, notice("isc"), "en"), (1, "x", "en"), (1, "x", "en"), (None, None, None)], DOCS)
    found = licences.scan(df).collect()
    assert Counter((r.doc_id, r.labels) for r in found) == {(None, "isc"): 1, (1, ""): 2, (None, ""): 1}
    assert licences.scan(spark.createDataFrame([], DOCS)).count() == 0


def test_licence_scan_with_other_settings_equals_its_sql(spark):
    sf_dir, con = "/root/testdata/sf0.001", duck("/root/testdata/sf0.001")
    phrases = {"the": "the", "of the": "of", "and": "and"}
    templates = [("licence", "This work is licensed under the terms of", ["under the"]), ("the-of", "the of the and the in of", ["the of"])]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    df = licences.scan(docs, phrases=phrases, templates=templates, rare_words=3, least_share=0.3, window=4)
    index = licences.Index(phrases, templates)
    result = con.execute(licences.sql(index, 3, 0.3, 4))
    assert bag(df.columns, df.collect()) == bag([d[0] for d in result.description], result.fetchall())
    with pytest.raises(ValueError):
        licences.Index({}, [("x", "some words", ["other words"])])
