"""Tag expressions.  A tag is struct<key, vtype, value>; a span holds an ordered array of them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanweave.schema import TAG

# Fixed values of the tracing convention.
KIND_KEY = "span.kind"
CLIENT_KIND = "client"
SERVER_KIND = "server"
CLIENT_VALUES = ("client", "producer")
SERVER_VALUES = ("server", "consumer")
PEER_KEY = "peer.service"

_NO_TAGS = f"array<{TAG.simpleString()}>"


def no_tags() -> Column:
    return F.array().cast(_NO_TAGS)


def decode_tags(tags: Column) -> Column:
    """Tag array of a document.  Only values of type "string" are kept; other tags stay, valueless."""
    return F.coalesce(
        F.transform(
            tags,
            lambda t: F.struct(
                t["key"].alias("key"),
                t["type"].alias("vtype"),
                F.when(F.lower(t["type"]) == "string", t["value"]).alias("value"),
            ),
        ),
        no_tags(),
    )


def tag_map_entries(tag: Column) -> Column:
    """Tag object of a document.  Unlike in the array, a value of any type is kept as text."""
    return F.coalesce(
        F.transform(
            F.map_entries(tag),
            lambda e: F.struct(
                e["key"].alias("key"),
                F.lit(None).cast("string").alias("vtype"),
                e["value"].alias("value"),
            ),
        ),
        no_tags(),
    )


def merge_tags(tags: Column, tag: Column) -> Column:
    """The array first, then the entries of the object."""
    return F.concat(decode_tags(tags), tag_map_entries(tag))


def sort_tags(tags: Column) -> Column:
    """Stable order by key: tags with equal keys keep their relative order."""
    placed = F.transform(
        tags, lambda t, i: F.struct(t["key"].alias("key"), i.alias("at"), t.alias("tag"))
    )
    return F.transform(F.array_sort(placed), lambda p: p["tag"])


def tag_value(tags: Column, key: str | Column) -> Column:
    """Value of the first tag with this key.  A null first value hides later tags of the key."""
    place = F.array_position(tags["key"], key)
    return F.get(tags["value"], (place - 1).cast("int"))


def is_client(tags: Column) -> Column:
    return F.coalesce(tag_value(tags, KIND_KEY) == CLIENT_KIND, F.lit(False))


def is_server(tags: Column) -> Column:
    return F.coalesce(tag_value(tags, KIND_KEY) == SERVER_KIND, F.lit(False))


def call_sides(tags: Column) -> Column:
    """Which ends of a call a span claims, by tag value under any key.

    '' none, 'c' calling end only, 's' called end only, 'cs' / 'sc' both, in order of appearance.
    """

    def first_place(values: tuple[str, ...]) -> Column:
        return F.least(*[F.nullif(F.array_position(tags["value"], v), F.lit(0)) for v in values])

    calling, called = first_place(CLIENT_VALUES), first_place(SERVER_VALUES)
    return (
        F.when(calling < called, "cs")
        .when(called < calling, "sc")
        .when(calling.isNotNull(), "c")
        .when(called.isNotNull(), "s")
        .otherwise("")
    )


def tag_text(tags: Column) -> Column:
    """All tags as one text, for showing spans."""
    return F.array_join(
        F.transform(tags, lambda t: F.concat(t["key"], F.lit("="), F.coalesce(t["value"], F.lit("")))),
        ";",
    )
