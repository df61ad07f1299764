"""Sharding, mixing, exact duplicates and revisits: small cases with known results, and SQL at other parameters."""

import hashlib

import pytest
from pyspark.sql import functions as F

from plain import normal
from spanweave.llm import exact_copies, mixing, revisits, shards

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, "a b c", "en", "s", 5),
    (2, "a  b\tc", "en", "s", 6),
    (3, None, "en", None, None),
    (4, "", None, "", 0),
    (5, "x " * 40_000, "en", "t", 80_000),
    (5, "x " * 40_000, "en", "t", 80_000),
    (None, "a b c", "en", "s", 5),
    (None, "alone", "en", "s", 5),
    (6, "é ü", "de", "u", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    # Columns whose names the operators use themselves.
    extra = {c: F.lit("mine") for c in ("kept", "size", "copies", "class", "_sha", "hash", "_again", "id")}
    return spark.createDataFrame(ROWS, DOCS).withColumns(extra)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_marked_copies(docs):
    found = sorted(map(tuple, exact_copies.mark_copies(docs).collect()), key=str)
    sha = lambda t: hashlib.sha256(normal(t).encode()).hexdigest()
    long = sha("x " * 40_000)
    assert found == sorted(
        [
            (1, 1, 3, True, sha("a b c")),
            (2, 1, 3, False, sha("a b c")),
            (None, 1, 3, False, sha("a b c")),
            (3, 3, 2, True, sha("")),
            (4, 3, 2, False, sha("")),
            (5, 5, 2, True, long),
            (5, 5, 2, False, long),
            (None, None, 1, True, sha("alone")),
            (6, 6, 1, True, sha("é ü")),
        ],
        key=str,
    )


@pytest.mark.parametrize("bits", [1 << 15, 1 << 16, exact_copies.FILTER_BITS])
def test_a_full_filter_changes_nothing(spark, bits):
    # 4,000 texts in 2^15 cells: most are flagged, and the groups stay the same.
    rows = spark.range(4000).selectExpr("id doc_id", "cast(id % 3990 as string) text")
    found = exact_copies.mark_copies(rows, filter_bits=bits)
    assert found.count() == 4000 and found.filter("kept").count() == 3990
    assert {(r.doc_id, r.keep_id) for r in found.filter("not kept").collect()} == {(3990 + i, i) for i in range(10)}
    assert exact_copies.drop_copies(rows, filter_bits=bits).count() == 3990


def test_the_filter_finds_every_repeat_and_few_others(spark):
    keys = spark.range(20_000).selectExpr("cast(id % 19000 as string) k")
    cells = exact_copies.repeated_cells(keys, "k")
    flagged = exact_copies.flag_repeated(keys, "k", cells, "again").filter("again")
    assert flagged.filter("cast(k as int) < 1000").count() == 2000
    assert flagged.count() < 2010


def test_dropped_copies_with_maps(docs):
    mapped = docs.withColumn("labels", F.create_map(F.lit("a"), "text"))
    found = exact_copies.drop_copies(mapped)
    assert found.columns == mapped.columns and found.count() == 5


def test_dropped_copies_keep_all_columns(docs):
    found = exact_copies.drop_copies(docs)
    assert found.columns == docs.columns
    assert sorted((str(r.doc_id) for r in found.collect())) == ["1", "3", "5", "6", "None"]


def test_nothing_in_nothing_out(spark):
    for found in (
        exact_copies.mark_copies(empty(spark)),
        exact_copies.drop_copies(empty(spark)),
        mixing.mark_copies(empty(spark)),
        mixing.mix(empty(spark)),
        shards.shard_documents(empty(spark)),
        revisits.resolve_revisits(spark.createDataFrame([], RECORDS)),
    ):
        assert found.count() == 0


def test_targets_stop_and_are_shared_anew(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 0), (None, 500)], "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # a stops at 30; c has nothing; b and the null source share 1480 as 2 to 5.
    assert found["a"] == 30 and found["c"] == 0
    assert found["b"] == pytest.approx(1480 * 2 / 7) and found[None] == pytest.approx(1480 * 5 / 7)


def test_mix_meets_its_targets(spark):
    rows = spark.range(3000).selectExpr(
        "id doc_id", "repeat('w ', cast(1 + id % 200 as int)) text", "case when id % 3 = 0 then 'a' when id % 3 = 1 then 'b' end source"
    )
    found = mixing.mark_copies(rows)
    sums = found.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most"))
    for row in sums.collect():
        assert abs(row.taken - row.target) <= 0.01 * row.target and row.most <= 3
    assert sorted(map(str, found.collect())) == sorted(map(str, mixing.mark_copies(rows.repartition(7)).collect()))
    assert mixing.mix(rows).count() == found.agg(F.sum("copies")).first()[0]


def test_mix_handles_odd_rows(docs):
    marked = mixing.mark_copies(docs).collect()
    assert len(marked) == len(ROWS)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in marked)


@pytest.mark.parametrize("limit", [1, 1000, 10**9])
def test_shards_fit(spark, limit):
    rows = spark.range(500).selectExpr("id doc_id", "repeat('t', cast(id % 50 as int)) text")
    found = shards.shard_documents(rows, limit).collect()
    assert len(found) == 500
    sums = {}
    for r in found:
        sums[r.shard] = sums.get(r.shard, 0) + r.bytes
    names = sorted(sums)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))  # no shard lies in another
    for r in found:
        assert sums[r.shard] == r.shard_bytes and r.fits == (r.shard_bytes <= limit) and len(r.shard) == r.depth
        assert r.fits or r.shard_docs == 1
    if limit == 1000:  # what was split had to be
        for name in names:
            if name:
                assert sum(b for n, b in sums.items() if n.startswith(name[:-1])) > limit
    slots = [(r.slot / 2**r.depth, 1 / 2**r.depth) for r in shards.directory(shards.shard_documents(rows, limit)).collect()]
    assert max(a + b for a, b in slots) <= 1


def test_shards_of_odd_rows(docs, tmp_path):
    found = shards.shard_documents(docs, 1000).collect()
    assert len(found) == len(ROWS)
    twins = [r for r in found if r.doc_id == 5]
    assert len(twins) == 2 and all(not r.fits and r.shard_docs == 2 for r in twins)
    shards.write_shards(docs, str(tmp_path / "out"), 1000)
    assert docs.sparkSession.read.parquet(str(tmp_path / "out")).count() == len(ROWS)


def test_folders_are_the_shards_reported(spark, tmp_path):
    rows = spark.range(300).selectExpr("id as doc_id", "repeat('x', cast(id % 90 as int)) as text")
    shards.write_shards(rows, str(tmp_path / "out"), 1000)
    told = {(r.doc_id, r.shard) for r in shards.shard_documents(rows, 1000).collect()}
    kept = spark.read.schema("doc_id long, text string, shard string").parquet(str(tmp_path / "out"))
    assert {(r.doc_id, r.shard) for r in kept.collect()} == told and len({shard for _, shard in told}) > 8


RECORDS = "record_id long, type string, url string, time long, status int, headers map<string,string>, payload string"


def resolved(spark, rows):
    found = revisits.resolve_revisits(spark.createDataFrame(rows, RECORDS).withColumn("key", F.lit("mine")))
    return {r.record_id: r for r in found.collect()}


def test_revisits(spark):
    page = lambda i, url, time, tag, status=200, body="b", **more: (
        i, "response", url, time, status, {"ETag": tag, "Content-Length": "1", "X": "old", **more}, body
    )
    again = lambda i, url, time, **headers: (i, "revisit", url, time, 304, headers, None)
    found = resolved(
        spark,
        [
            page(1, "http://www.A.com/p?utm_source=x", 10, '"t"', body="one"),
            page(2, "https://a.com/p/", 20, '"u"', body="two"),
            page(3, "https://a.com/p", 25, '"v"', status=206),
            page(4, "https://a.com/p", 25, '"w"', body=None),
            page(5, "https://a.com/p", 30, '"y"', body="five"),
            page(6, "https://a.com/p", 30, '"z"', body="six"),
            page(6, "https://a.com/p", 30, '"z"', body="six"),
            (7, "request", "https://a.com/p", 28, 200, {}, "x"),
            again(10, "a.com/p", 10, ETag='"t"'),
            again(11, "http://a.com/p#f", 11, etag='W/"t"', **{"Content-Length": "0", "x": "new"}),
            again(12, "http://a.com/p", 29, ETag='"u"'),
            again(13, "http://a.com/p", 29, ETag='"other"'),
            again(14, "http://a.com/p", 29, Date="d"),
            again(15, "http://a.com/p", 31, ETag='"z"'),
            again(16, "http://b.com/p", 31, ETag='"z"'),
            again(17, None, 31, ETag='"z"'),
            again(18, "http://a.com/p", None, ETag='"z"'),
            again(19, "http://a.com/p", 15, **{"Last-Modified": "m"}),
            (20, "revisit", "http://a.com/p", 15, 304, None, None),
        ],
    )
    verdicts = {i: (r.verdict, r.refers_to) for i, r in found.items()}
    assert verdicts == {
        10: ("no_response", None), 11: ("resolved", 1), 12: ("resolved", 2), 13: ("changed", 2), 14: ("no_validator", 2),
        15: ("resolved", 6), 16: ("no_response", None), 17: ("no_response", None), 18: ("no_response", None),
        19: ("changed", 1), 20: ("no_validator", 1),
    }
    assert found[11].payload == "one"
    assert found[11].headers == {"etag": 'W/"t"', "content-length": "1", "x": "new"}
    assert found[13].payload is None and found[13].headers is None


def test_one_page_visited_by_everybody(spark):
    rows = [(0, "response", "http://a/", 0, 200, {"ETag": "t"}, "body")]
    rows += [(i, "revisit", "http://a/", i, 304, {"ETag": "t"}, None) for i in range(1, 2000)]
    found = resolved(spark, rows)
    assert len(found) == 1999 and {r.refers_to for r in found.values()} == {0}
