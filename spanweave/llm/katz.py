"""A Katz backoff language model over word pairs, trained and evaluated in blocks of documents.

P(w | h) is the Good-Turing discounted relative count of the pair where it was seen, else alpha(h) P(w); P(w) is the
discounted relative count of the word, and words that were not seen share one unknown token with what discounting left.
alpha(h) makes the probabilities after h sum to one exactly, over the known words and the unknown token.

The model lives in tables partitioned by the hash of the key: words, pairs and, per history, the sums that alpha needs.
A block of documents (BLOCK_TOKENS tokens) asks for all its keys at once: it sends its distinct keys with its own counts to
the partitions, sorted and packed; a partition adds up, keeps its table and answers every block with the sums of the keys
it sent.  So a word in every document costs one key per block, not one per occurrence, and every exchange grows with the
distinct keys per block only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import in_small_batches, whole
from spanweave.llm.hashing import scramble, text_chunks, token_hashes
from spanweave.shared import written

FOLDS, HELD_OUT = 5, 1
BLOCK_TOKENS = 3 << 19
PARTITION_KEYS = 1 << 19
PAIR_BITS = 56  # of a pair's hash; among 10^9 pairs some four share one
TURING = 5  # counts up to this are discounted
END, BEGIN = np.uint64(1), np.uint64(2)

_U = np.uint64
_LEFT, _RIGHT = _U(0x8EBC6AF09C88C6E3), _U(0x589965CC75374CC3)


def pack(values: np.ndarray) -> bytes:
    """64-bit values: like bytes together, then compressed."""
    octets = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(octets.T).tobytes())


def unpack(data: bytes, kind: type = np.uint64) -> np.ndarray:
    octets = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(octets.T).reshape(-1).view(kind)


def _pack_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=_U(0)))


def _unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


_TEXT_BLOCK = "block long, ids array<{id}>, train binary, starts binary, words binary, tokens binary, n_pairs long, n_words long"


def text_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as blocks of numbered words: begin, words and end of each, and whether it trains."""
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS
    rows = in_small_batches(docs).select(F.col(id_col).alias("id"), whole(text_col).cast("binary").alias("text"), (fold != HELD_OUT).alias("train"))
    schema = _TEXT_BLOCK.format(id=dict(rows.dtypes)["id"])
    names = [c.split()[0] for c in schema.split(", ")]

    def close(number: int, ids: list, train: list, runs: list[np.ndarray]) -> pa.RecordBatch:
        words, tokens, counts = np.unique(np.concatenate(runs), return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")  # frequent words get small numbers, which pack well
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        words, tokens = words[order], rank[tokens]
        keys, _, _ = _pairs(words, tokens)
        starts = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
        row = [
            pa.array([number]), pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)), pa.array([pack(np.array(train, np.int64))]),
            pa.array([pack(starts)]), pa.array([pack(words)]), pa.array([pack(tokens.astype(np.int64))]),
            pa.array([len(np.unique(keys))]), pa.array([len(words)]),
        ]
        return pa.RecordBatch.from_arrays(row, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, train, runs, size = [], [], [], 0
        for batch in batches:
            trains, at = batch.column(2).to_pylist(), 0
            for data, bounds in text_chunks(batch.column(1)):
                hashes, starts = token_hashes(data, bounds)
                for i in range(len(starts) - 1):
                    runs.append(np.concatenate([[BEGIN], hashes[starts[i] : starts[i + 1]], [END]]))
                    size += len(runs[-1])
                n = len(starts) - 1
                ids.append(batch.column(0).slice(at, n))
                train += trains[at : at + n]
                at += n
                if size >= BLOCK_TOKENS:
                    yield close(number, ids, train, runs)
                    number += 1
                    ids, train, runs, size = [], [], [], 0
        if runs:
            yield close(number, ids, train, runs)

    return rows.mapInArrow(run, schema)


def _pairs(words: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all (history, word) of the documents of a block, and the numbers of both."""
    begin = np.flatnonzero(words == BEGIN)[0]
    inside = tokens[1:] != begin
    left, right = tokens[:-1][inside], tokens[1:][inside]
    return scramble(words[left] * _LEFT + words[right] * _RIGHT) >> _U(64 - PAIR_BITS), left, right


class Block(NamedTuple):
    """A block of texts, its distinct words and pairs in order of their keys."""

    ids: list
    train: np.ndarray
    sizes: np.ndarray  # tokens of each document, with its end
    words: np.ndarray
    word_order: np.ndarray  # sorts words
    left: np.ndarray
    right: np.ndarray
    pair_keys: np.ndarray
    pair_of: np.ndarray  # token -> place in pair_keys
    first: np.ndarray  # place in pair_keys -> one of its tokens
    trains: np.ndarray  # of each token


def _open(row: dict) -> Block:
    words, tokens = unpack(row["words"]), unpack(row["tokens"], np.int64)
    keys, left, right = _pairs(words, tokens)
    pair_keys, first, pair_of = np.unique(keys, return_index=True, return_inverse=True)
    train = unpack(row["train"], np.int64).astype(bool)
    sizes = np.diff(unpack(row["starts"], np.int64)) - 1
    return Block(row["ids"], train, sizes, words, np.argsort(words), left, right, pair_keys, pair_of, first, np.repeat(train, sizes))


_ASKED = "kind string, part int, block long, keys binary, sums array<binary>"


def _ask(kind: str, block: int, keys: np.ndarray, sums: list[np.ndarray], parts: int) -> Iterator[tuple]:
    """Sorted keys and what is to be added up, to the partitions."""
    high = keys >> _U((PAIR_BITS if kind == "pair" else 64) - 32)
    cuts = np.searchsorted((high * _U(parts)) >> _U(32), np.arange(parts + 1))
    for part, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        yield kind, part, block, _pack_keys(keys[low:high]), [pack(np.asarray(s[low:high], np.float64)) for s in sums]


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _add_up(table: pa.Table) -> pa.Table:
    """One partition: its table (block null) and the answers to the blocks; the last of an answer's arrays marks the keys
    that no other block has to count."""
    rows = table.to_pylist()
    asked = [_unpack_keys(r["keys"]) for r in rows]
    keys, first, place = np.unique(np.concatenate(asked), return_index=True, return_inverse=True)
    sums = [
        np.bincount(place, np.concatenate([unpack(r["sums"][i], np.float64) for r in rows]), len(keys))
        for i in range(len(rows[0]["sums"]))
    ]
    owned = np.zeros(len(place))
    owned[first] = 1
    kind, part = rows[0]["kind"], rows[0]["part"]
    if kind == "history":
        sums = [_backoff(*sums)]
    out, at = [(kind, part, None, _pack_keys(keys), [pack(s) for s in sums])], 0
    for row, own in zip(rows, asked, strict=True):
        here = slice(at, at + len(own))
        out.append((kind, part, row["block"], None, [*(pack(s[place[here]]) for s in sums), pack(owned[here])]))
        at += len(own)
    return pa.Table.from_batches([_rows(_ASKED, out)])


def _backoff(share: np.ndarray, covered: np.ndarray) -> np.ndarray:
    """What a history leaves to words not seen after it, over what those have without it.

    share is what its pairs take, covered what their words have.  Where discounting left nothing it is negative, and to
    be divided by minus the history's count and one: one more occurrence than counted makes room.
    """
    return np.where(share > 1 - 1e-9, -1.0, 1 - share) / (1 - covered)


def _exchange(asked: DataFrame) -> DataFrame:
    """Tables and answers of all partitions."""
    return written(asked.groupBy("kind", "part").applyInArrow(_add_up, _ASKED), "katz")


def _answers(rows: list[dict], kind: str) -> list[np.ndarray]:
    own = sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["part"])
    return [np.concatenate([unpack(r["sums"][i], np.float64) for r in own]) for i in range(len(own[0]["sums"]))]


def _stored(model: DataFrame, kind: str) -> DataFrame:
    return model.filter((F.col("kind") == kind) & F.col("block").isNull())


def counts_of_counts(model: DataFrame, kind: str) -> tuple[dict[int, int], int, int]:
    """How many keys have each small count, the number of keys with any, and the sum of counts; begins are no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = np.zeros(TURING + 3, np.int64), 0
        for batch in batches:
            for row in batch.to_pylist():
                counts = unpack(row["sums"][0], np.float64)[_unpack_keys(row["keys"]) != BEGIN]
                found += np.bincount(np.minimum(counts, TURING + 2).astype(np.int64), minlength=TURING + 3)
                total += int(counts.sum())
        yield pa.RecordBatch.from_arrays([pa.array([*range(TURING + 3), -1]), pa.array([*found.tolist(), total])], ["r", "n"])

    rows = _stored(model, kind).select("keys", "sums").mapInArrow(run, "r long, n long").groupBy("r").agg(F.sum("n")).collect()
    n = {r: c for r, c in rows}
    return n, sum(c for r, c in n.items() if r > 0), n.get(-1, 0)


def discounts(n: dict[int, int]) -> np.ndarray:
    """Factors for counts 0 to TURING + 1 (larger ones as the last).  Good-Turing, or where that makes no sense (a ratio
    outside 0 to 1, no keys to go by) the absolute discount n1 / (n1 + 2 n2)."""
    out = np.ones(TURING + 2)
    n1, n2 = n.get(1, 0), n.get(2, 0)
    absolute = n1 / (n1 + 2 * n2) if n1 else 0.5
    high = (TURING + 1) * n.get(TURING + 1, 0) / n1 if n1 else 1.0
    for r in range(1, TURING + 1):
        turing = (r + 1) * n.get(r + 1, 0) / (r * n[r]) if n.get(r) else 0.0
        d = (turing - high) / (1 - high) if high < 1 else 0.0
        out[r] = d if 0 < d < 1 else 1 - min(absolute, 0.9) / r
    return out


class Unigrams(NamedTuple):
    discount: np.ndarray
    total: int
    kinds: int
    unknown: float
    scale: float

    def probability(self, counts: np.ndarray) -> np.ndarray:
        known = self.scale * _discounted(counts, self.discount) / max(self.total, 1)
        return np.where(counts > 0, known, self.unknown)


def _discounted(counts: np.ndarray, discount: np.ndarray) -> np.ndarray:
    return counts * discount[np.minimum(counts, TURING + 1).astype(np.int64)]


def unigrams(n: dict[int, int], kinds: int, total: int) -> Unigrams:
    discount = discounts(n)
    left = sum((1 - discount[r]) * r * n.get(r, 0) for r in range(1, TURING + 1)) / total if total else 1.0
    unknown = left if left > 0 else 1 / (total + 1)
    return Unigrams(discount, total, kinds, unknown, (1 - unknown) / (1 - left) if left < 1 else 0.0)


def _asking(make: Callable[[int, Block], Iterator[tuple]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield _rows(_ASKED, list(make(row["block"], _open(row))))

    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, n_tokens, n_known, train_tokens, base_score, score: a row per row of docs.

    Rows whose crc32(id as text) mod 5 is not 1 train (a null id counts as an empty text); all are scored.  Words are in
    lower case (A-Z); each text has one end token more.  A null or empty text is the end token alone.  Without any
    training text all tokens are unknown.  No rows in, no rows out; other columns are not looked at.
    """
    blocks = written(text_blocks(docs, id_col, text_col), "blocks")
    words, pairs = blocks.agg(F.sum("n_words"), F.sum("n_pairs")).first()
    word_parts, pair_parts = (max(1, -(-(n or 0) // PARTITION_KEYS)) for n in (words, pairs))

    def ask_counts(number: int, b: Block) -> Iterator[tuple]:
        counts = np.bincount(b.right[b.trains], minlength=len(b.words))
        counts[np.flatnonzero(b.words == BEGIN)] = b.train.sum()
        yield from _ask("word", number, b.words[b.word_order], [counts[b.word_order]], word_parts)
        yield from _ask("pair", number, b.pair_keys, [np.bincount(b.pair_of[b.trains], minlength=len(b.pair_keys))], pair_parts)

    counted = _exchange(blocks.mapInArrow(_asking(ask_counts), _ASKED))
    lower = unigrams(*counts_of_counts(counted, "word"))
    discount = discounts(counts_of_counts(counted, "pair")[0])

    def counts_in(b: Block, answers: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of the block's words, of its pairs, and which of those it stands for."""
        word_counts = np.empty(len(b.words))
        word_counts[b.word_order] = _answers(answers, "word")[0]
        return word_counts, *_answers(answers, "pair")

    def ask_histories(texts: pa.Table, answers: pa.Table) -> pa.Table:
        row = texts.to_pylist()[0]
        b = _open(row)
        word_counts, pair_counts, owned = counts_in(b, answers.to_pylist())
        seen = (owned > 0) & (pair_counts > 0)
        left, right = b.left[b.first[seen]], b.right[b.first[seen]]
        mass = np.bincount(left, _discounted(pair_counts[seen], discount), len(b.words))
        covered = np.bincount(left, lower.probability(word_counts[right]), len(b.words))
        sums = [(mass / np.maximum(word_counts, 1))[b.word_order], covered[b.word_order]]
        return pa.Table.from_batches([_rows(_ASKED, list(_ask("history", row["block"], b.words[b.word_order], sums, word_parts)))])

    asked = counted.filter("block IS NOT NULL")
    histories = _exchange(blocks.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(ask_histories, _ASKED))
    id_type = dict(docs.dtypes)[id_col]

    def evaluate(texts: pa.Table, answers: pa.Table) -> pa.Table:
        b, rows = _open(texts.to_pylist()[0]), answers.to_pylist()
        word_counts, pair_counts, _ = counts_in(b, rows)
        backoff = np.empty(len(b.words))
        backoff[b.word_order] = _answers(rows, "history")[0]
        room = np.where(backoff < 0, word_counts / (word_counts + 1), 1.0)
        backoff = np.where(backoff < 0, -backoff / (word_counts + 1), backoff)
        single = lower.probability(word_counts)
        left, right, pair = b.left, b.right, pair_counts[b.pair_of]
        seen = pair > 0
        chance = np.where(
            seen, room[left] * _discounted(pair, discount) / np.maximum(word_counts[left], 1), backoff[left] * single[right]
        )
        base = (word_counts[right] + 0.5) / (lower.total + 0.5 * (lower.kinds + 1))
        starts = np.concatenate([[0], np.cumsum(b.sizes)])
        per_document = lambda x: np.add.reduceat(x, starts[:-1])  # noqa: E731  every document has a token
        return pa.Table.from_arrays(
            [
                texts.column("ids").combine_chunks().values, pa.array(~b.train), pa.array(b.sizes),
                pa.array(per_document((word_counts[right] > 0).astype(np.int64))), pa.array(np.full(len(b.sizes), lower.total)),
                pa.array(per_document(np.log10(base))), pa.array(per_document(np.log10(chance))),
            ],
            [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    answers = asked.unionByName(histories.filter("block IS NOT NULL"))
    schema = f"`{id_col}` {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(evaluate, schema)
