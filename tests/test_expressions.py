import pytest
from pyspark.sql import functions as F

from spanweave.functions.ids import hex_to_long, long_to_hex, normalize_trace_id
from spanweave.functions.tags import call_sides, sort_tags, tag_value
from spanweave.schema import TAG


def values(spark, expression, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r.v for r in df.select("i", expression(F.col("x")).alias("v")).orderBy("i").collect()]


def test_hex_ids_keep_the_low_64_bits(spark):
    texts = ["1", "ff", "FF", "7fffffffffffffff", "8000000000000000", "ffffffffffffffff"]
    assert values(spark, hex_to_long, texts) == [1, 255, 255, 2**63 - 1, -(2**63), -1]
    assert values(spark, hex_to_long, ["1ffffffffffffffff", "a" + "0" * 31 + "2"]) == [-1, 2]
    assert values(spark, hex_to_long, ["", "xyz", " 1", None]) == [None] * 4


def test_hex_ids_round_trip(spark):
    numbers = [0, 1, -1, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    back = df.select(hex_to_long(long_to_hex(F.col("n"))).alias("n"))
    assert [r.n for r in back.collect()] == numbers


def test_trace_ids_are_padded_not_cut(spark):
    texts = ["abc", "a" * 16, "a" * 32, "b" * 40, "a b", None]
    assert values(spark, normalize_trace_id, texts) == [
        "abc".rjust(32, "0"),
        ("a" * 16).rjust(32, "0"),
        "a" * 32,
        "b" * 40,
        "a0b".rjust(32, "0"),
        None,
    ]


def on_tags(spark, expression, tags):
    df = spark.createDataFrame([(tags,)], f"tags array<{TAG.simpleString()}>")
    return df.select(expression(F.col("tags")).alias("v")).first().v


def tag(key, value):
    return (key, "string", value)


def test_tag_order_is_stable(spark):
    tags = [tag("b", "1"), tag("a", "2"), tag("b", "0"), tag("a", "1")]
    sorted_tags = [(t.key, t.value) for t in on_tags(spark, sort_tags, tags)]
    assert sorted_tags == [("a", "2"), ("a", "1"), ("b", "1"), ("b", "0")]


def test_first_tag_wins(spark):
    tags = [tag("a", None), tag("a", "2"), tag("b", "x"), tag("b", "y")]
    assert on_tags(spark, lambda t: tag_value(t, "a"), tags) is None
    assert on_tags(spark, lambda t: tag_value(t, "b"), tags) == "x"
    assert on_tags(spark, lambda t: tag_value(t, "c"), tags) is None


@pytest.mark.parametrize(
    "tag_values, sides",
    [
        ([], ""),
        (["x", None], ""),
        (["client"], "c"),
        (["x", "consumer", "server"], "s"),
        (["producer", "client", "server"], "cs"),
        ([None, "server", "client", "server"], "sc"),
    ],
)
def test_call_sides(spark, tag_values, sides):
    assert on_tags(spark, call_sides, [tag("k", v) for v in tag_values]) == sides
