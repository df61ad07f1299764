"""Token ids in compressed files, written and read by all tasks at once.

Documents are tokenised in order of their ids, in range partitions, each with an end id.  One frequency table, counted
over all ids, is shared by all blocks; a block holds some BLOCK ids of one partition in an interleaved range asymmetric
numeral system, with checkpoints and checksums (ans.py).  A block is decoded without any other, and from each checkpoint.

The format is three Parquet folders: frequencies (symbol, n), blocks (part, block, the coded ids, and which documents they
belong to) and documents (part, place, id, offset, n).  A document longer than a block runs over several.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.llm import ans
from spanweave.llm.common import LETTER_BYTES, Remembered, chunks, cut_letters, in_small_batches, ranges, whole
from spanweave.shared import new_folder, written

END = 0
BLOCK = 1 << 20
REMEMBERED = 300_000  # words' letters a task remembers, and as many from before; the same of what follows letters
CHUNK = 1 << 22  # bytes taken at once
BATCH = 2048  # words the tokenizer is given at once
JOINED = 512  # words whose letters the merge model is given in one string

_TOKENS = "part int, place long, id {id}, n long, ids binary"
_WHITE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"  # as \s of str
_BLOCK = (
    "part int, block long, n long, lanes int, words binary, states binary, places array<long>, crcs array<long>, "
    "first_place long, pieces binary"
)


def _byte_alphabet() -> list[str]:
    """The character that byte-level BPE writes for each byte: itself if it is visible, else the next one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


class Words:
    """A byte-level BPE tokenizer that remembers the ids of words behind a space.

    Where a space stands between two characters that are no white space, the tokenizer always starts anew: a text without
    other spaces can be put together from its words.  So does it between letters and an ASCII character that is none: a
    word's letters go to the tokenizer's merge model as they are, the rest goes to the tokenizer.  Other texts go to it whole.

    If no merge joins a letter to a space behind it, the merge model gets the letters of many words in one string: no token
    runs over the start of a word, and what is merged inside one depends on nothing outside.
    """

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        strings = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([f" (?:{_WHITE}|$)", *strings])  # texts with an added token go to the tokenizer whole
        self.model = self.tokenizer.model
        self.alphabet = _byte_alphabet()
        self.space = self.alphabet[32]
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # tokens that start with a space
        self.begins[[i for token, i in vocabulary.items() if token.startswith(self.space)]] = True
        letters = "".join([self.alphabet[b] for b in LETTER_BYTES])
        over = re.compile(f"(?:^|{self.space})[{letters}]+{self.space}")
        self.joined = 1 if any(map(over.search, vocabulary)) else JOINED
        self.cores = Remembered(self.letters, REMEMBERED)
        self.rests = Remembered(self.plain, REMEMBERED)

    def plain(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(texts), BATCH):
            found = self.tokenizer.encode_batch_fast(texts[at : at + BATCH], add_special_tokens=False)
            out += [array("I", e.ids).tobytes() for e in found]
        return out

    def letters(self, words: list[str]) -> list[bytes]:
        """Ids of a space and a word of letters; no letters, no ids."""
        if "" in words:
            at = words.index("")
            return [*self.letters(words[:at]), b"", *self.letters(words[at + 1 :])]
        alphabet, out = self.alphabet, []
        mapped = [w if w.isascii() else "".join([alphabet[b] for b in w.encode()]) for w in words]
        for at in range(0, len(words), self.joined):
            some = mapped[at : at + self.joined]
            ids = np.array([t.id for t in self.model.tokenize(self.space + self.space.join(some))], np.uint32)
            cuts = [*(np.flatnonzero(self.begins[ids]) * 4).tolist(), 4 * len(ids)] if len(some) > 1 else [0, 4 * len(ids)]
            octets = ids.tobytes()
            out += [octets[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with end behind, and how many a text has."""
        own = texts.to_pylist()
        odd = pc.match_substring_regex(texts, self.odd)
        split = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        sizes = np.diff(split.offsets.to_numpy())
        values = split.flatten()
        behind = np.ones(len(values), bool)  # a space, that is, not the first of their text
        behind[np.cumsum(sizes) - sizes] = False
        coded = values.filter(pa.array(behind)).dictionary_encode()
        parts, halves = [b""], []
        if len(coded.dictionary):
            cores, rests, bare = cut_letters(coded.dictionary)
            rests = pc.binary_join_element_wise(pc.if_else(bare, " ", ""), rests, "")
            for half, remembered in ((cores, self.cores), (rests, self.rests)):
                half = half.dictionary_encode()
                strings = half.dictionary.to_numpy(zero_copy_only=False).tolist()  # ten times as fast as to_pylist()
                halves.append(half.indices.to_numpy()[coded.indices.to_numpy()] + len(parts))
                parts += remembered(strings)
        firsts = self.plain([t if o else t.partition(" ")[0] for t, o in zip(own, odd.to_pylist(), strict=True)])
        # Which of the parts follow each other: a text's first word and nothing, both halves of its other words, the end.
        order = np.zeros((len(values) + len(own), 2), np.int64)
        last = np.cumsum(sizes + 1) - 1
        order[last - sizes, 0] = len(parts) + np.arange(len(own))
        order[last, 0] = len(parts) + len(own)
        rest = np.ones(len(order), bool)
        rest[last] = rest[last - sizes] = False
        if halves:
            order[rest] = np.stack(halves, 1)
        parts += [*firsts, np.array([end], "<u4").tobytes()]
        ids, lengths = np.frombuffer(b"".join(parts), "<u4"), np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
        n = lengths[order.ravel()]
        found = ids[ranges((np.cumsum(lengths) - lengths)[order.ravel()], n)]
        return found, np.add.reduceat(n, 2 * (last - sizes))


_loaded: dict[str, Words] = {}


def _words(tokenizer: str) -> Words:
    if tokenizer not in _loaded:
        _loaded.clear()
        _loaded[tokenizer] = Words(tokenizer)
    return _loaded[tokenizer]


def _packed(ids: np.ndarray, n: np.ndarray) -> pa.Array:
    """The ids of every text as 16-bit numbers, if all of its ids are such, or 32-bit ones."""
    ends = np.cumsum(n)
    wide = np.maximum.reduceat(ids, ends - n) >= 1 << 16
    if not wide.any():
        bounds = np.concatenate([[0], 2 * ends]).astype(np.int64)
        packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(bounds), pa.py_buffer(ids.astype("<u2"))])
        return packed.cast(pa.binary())
    texts = zip(np.split(ids, ends[:-1]), wide.tolist(), strict=True)
    return pa.array([x.astype("<u4" if w else "<u2").tobytes() for x, w in texts], pa.binary())


def tokenise(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, place, id, n, ids): documents in order within range partitions, ids with the end id as 16- or 32-bit numbers."""
    rows = in_small_batches(docs).select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, place = _words(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            at = 0
            for texts in chunks(batch.column(1), CHUNK):
                ids, n = words.encode(texts, END)
                size = len(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(size, part, np.int32)), pa.array(np.arange(place, place + size)),
                        batch.column(0).slice(at, size), pa.array(n, pa.int64()), _packed(ids, n),
                    ],
                    ["part", "place", "id", "n", "ids"],
                )
                at, place = at + size, place + size

    return ordered.mapInArrow(run, _TOKENS.format(id=dict(rows.dtypes)["id"]))


def _unpack(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype(np.uint32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, held, size = np.zeros(0, np.int64), [], 0

    def add() -> None:
        nonlocal counts, held, size
        own = np.bincount(np.concatenate(held), minlength=len(counts))
        own[: len(counts)] += counts
        counts, held, size = own, [], 0

    for batch in batches:
        for n, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            held.append(_unpack(ids.as_py(), n))
            size += n
            if size >= BLOCK:
                add()
    if held:
        add()
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["symbol", "n"])


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes docs under path.  Cases as in read_token_files."""
    spark = docs.sparkSession
    tokens = written(tokenise(docs, tokenizer, id_col, text_col), "tokens")
    counts = tokens.select("n", "ids").mapInArrow(_count, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))
    counts.coalesce(1).write.parquet(f"{path}/frequencies")
    table = _frequencies(spark, path)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, pieces, first, size, block = None, [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal held, pieces, size, block
            coded = ans.encode(np.concatenate(held), table)
            row = [[part], [block], [coded.n], [coded.lanes], [coded.words], [coded.states], [coded.places], [coded.crcs], [first]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
            columns = [pa.array(v, k) for v, k in zip(row, kinds, strict=True)] + [pa.array([np.array(pieces, "<u4").tobytes()])]
            held, pieces, size, block = [], [], 0, block + 1
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            for p, place, n, packed in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if p != part and held:
                    yield close()
                if p != part:
                    part, block = p, place << 20  # blocks of a partition that several tasks read keep apart
                ids, at = _unpack(packed, n), 0
                while at < n:
                    if not held:
                        first = place
                    some = ids[at : at + BLOCK - size]
                    held.append(some)
                    pieces.append(len(some))
                    size, at = size + len(some), at + len(some)
                    if size == BLOCK:
                        yield close()
        if held:
            yield close()

    # A task's rows come file by file in the order they were written, a file is one partition.
    tokens.select("part", "place", "n", "ids").mapInArrow(pack, _BLOCK).write.parquet(f"{path}/blocks")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    index = tokens.select("part", "place", "id", "n", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("offset"))
    index = index.join(starts, "part").select("part", "place", "id", (F.col("begin") + F.col("offset")).alias("start"), "n")
    index.write.parquet(f"{path}/documents")


def _frequencies(spark: SparkSession, path: str) -> ans.Frequencies:
    """As many rows as the vocabulary has ids."""
    rows = spark.read.parquet(f"{path}/frequencies").collect()
    counts = np.zeros(max((r["symbol"] for r in rows), default=0) + 1, np.int64)
    for row in rows:
        counts[row["symbol"]] = row["n"]
    return ans.Frequencies(counts)


def _decoded(
    spark: SparkSession, path: str, schema: str, columns: Callable[[np.ndarray, np.ndarray], list[pa.Array]]
) -> DataFrame:
    """(part, place, block, ...): a row per document and block that it runs over; columns makes the rest from a block's
    ids and where its documents end."""
    table = _frequencies(spark, path)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}
                block = ans.Block(row["n"], row["lanes"], row["words"], row["states"], row["places"], row["crcs"])
                ids, sizes = ans.decode(block, table), np.frombuffer(row["pieces"], "<u4")
                ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                keys = [
                    pa.array(np.full(len(sizes), row["part"], np.int32)),
                    pa.array(row["first_place"] + np.arange(len(sizes), dtype=np.int64)),
                    pa.array(np.full(len(sizes), row["block"])),
                ]
                names = ["part", "place", "block", *(c.split()[0] for c in schema.split(", "))]
                yield pa.RecordBatch.from_arrays(keys + columns(ids, ends), names)

    return spark.read.parquet(f"{path}/blocks").mapInArrow(unpack, f"part int, place long, block long, {schema}")


def decode_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(part, place, block, ids array<int>): the ids of every document, in a row per block that it runs over."""
    ids_of = lambda ids, ends: [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.view(np.int32)))]
    return _decoded(spark, path, "ids array<int>", ids_of)


def _checksums(ids: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
    octets, cuts = memoryview(ids.astype("<u4").tobytes()), (ends * 4).tolist()
    return [pa.array(np.diff(ends)), pa.array([zlib.crc32(octets[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.int64())]


@F.arrow_udf(T.LongType())
def _joined_crc(pieces: pa.Array) -> pa.Array:
    out = []
    for parts in pieces.to_pylist():
        crc = parts[0]["crc"]
        for p in parts[1:]:
            crc = ans.join_crcs(crc, p["crc"], 4 * p["n"])
        out.append(crc)
    return pa.array(out, pa.int64())


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """id_col, start, n_tokens, ids_crc32, a row per document written, all from decoded blocks and their index.

    A null or empty text is the end id alone.  Documents are in ascending order of their ids, null first, those that
    repeat an id in the order of a hash of their texts.  No documents, no rows.
    """
    pieces = _decoded(spark, path, "n long, crc long", _checksums)
    whole_docs = pieces.groupBy("part", "place").agg(
        F.sum("n").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("block", "n", "crc"))).alias("pieces")
    )
    index = spark.read.parquet(f"{path}/documents")
    return index.join(whole_docs.withColumn("ids_crc32", _joined_crc("pieces")), ["part", "place"]).select(
        F.col("id").alias(id_col), "start", "n_tokens", "ids_crc32"
    )


def query(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    write_token_files(docs, path, tokenizer)
    return read_token_files(spark, path)
