"""SentencePiece encoding and decoding by streaming Viterbi.

A text is cut into the pieces of a SentencePiece model file with the largest sum of the file's scores; at equal sums the
longer last piece wins.  The search goes over the text once.  Scores are kept for a window as long as the longest piece;
back pointers only until all surviving paths meet in one boundary: what lies before it is final and is emitted.  A
character that no piece covers is written as its UTF-8 bytes.

Where a space mark follows another character no piece runs across, so all paths meet there; so they do behind letters that
an ASCII character follows, if no piece of the file holds such a pair.  What lies between two such places depends on nothing
else, and a task remembers it.

This is what the library computes for a unigram model.  For a file of the kind BPE, whose scores are the ranks of its
merges, it computes merges in rank order; ids then differ from the ones here, the decoded text does not.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.llm.common import Remembered, chunks, cut_letters, in_small_batches, ranges
from spanweave.llm.hashing import scramble

MARK = "▁"
REMEMBERED = 100_000  # stretches a task remembers, and as many from before
LONGEST_REMEMBERED = 48
LANES = 2048
CHUNK = 1 << 19  # bytes taken at once
CHUNK_IDS = 1 << 17

_STRETCH = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_LETTER_AND_OTHER = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u023f][\x00-@\\[-`{-\x7f]")
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int) -> np.ndarray:
    table = np.full(LONGEST_REMEMBERED + 2, base, np.uint64)
    table[0] = 1
    return np.cumprod(table)


_POWER, _UNPOWER = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


class Pieces:
    """The piece table of a model file.  Its normalisation must be the identity, with or without a leading space mark."""

    def __init__(self, model: bytes):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        if library.normalize("ﬁ  Ⅳ").strip(MARK).replace(MARK, " ") != "ﬁ  Ⅳ":
            raise ValueError("only models with identity normalisation are supported")
        self.prefix = library.normalize("a").startswith((MARK, " "))
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.octets: list[bytes] = []
        byte_ids: dict[int, int] = {}
        for i in range(library.get_piece_size()):
            piece = library.id_to_piece(i)
            self.scores.append(library.get_score(i))
            if library.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                self.octets.append(bytes([int(piece[3:5], 16)]))
            elif library.is_control(i) or library.is_unknown(i):
                self.octets.append(b"" if library.is_control(i) else " ⁇ ".encode())
            else:
                self.octets.append(piece.replace(MARK, " ").encode())
                if not library.is_unused(i):
                    self.ids[piece] = i
        self.unknown = library.unk_id()
        self.byte_ids = [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else None
        self.unknown_score = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0
        self.longest = max(map(len, self.ids), default=1)
        self.starts = {p[:n] for p in self.ids for n in range(1, len(p) + 1)}
        self.cuts = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.cuts_letters = not any(map(_LETTER_AND_OTHER.search, self.ids))

    def spell(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode(errors="replace")] if self.byte_ids else [self.unknown]

    def stream(self, blocks: Iterable[str]) -> Iterator[list[int]]:
        """Ids of a normalised text that comes in blocks, in lists that are final as soon as they come."""
        ids, starts, longest = self.ids, self.starts, self.longest
        text, base, at = "", 0, 0  # text holds the characters from position base on; at is the position to start pieces from
        score = {0: 0.0}  # of the best path to a position in the window at .. at + longest
        back: dict[int, tuple[int, int]] = {}  # position -> where its last piece starts, and the piece; -1: a spelt character
        done, check = 0, 4 * longest
        blocks = iter(blocks)
        ended = False
        while True:
            while not ended and len(text) - (at - base) <= longest:
                block = next(blocks, None)
                ended = block is None
                text += block or ""
            here = at - base
            if here >= len(text):
                break
            reached = score.pop(at)
            covered = False
            for n in range(1, min(longest, len(text) - here) + 1):
                part = text[here : here + n]
                if part not in starts:
                    break
                piece = ids.get(part)
                if piece is not None:
                    covered = covered or n == 1
                    total = reached + self.scores[piece]
                    if at + n not in score or total > score[at + n]:
                        score[at + n], back[at + n] = total, (at, piece)
            if not covered and (at + 1 not in score or reached + self.unknown_score > score[at + 1]):
                score[at + 1], back[at + 1] = reached + self.unknown_score, (at, -1)
            at += 1
            if len(score) == 1 or at - done >= check:
                alive = set(score)
                while len(alive) > 1:  # the last one steps back until all are at one place
                    last = max(alive)
                    alive.remove(last)
                    alive.add(back[last][0])
                meet = alive.pop()
                if meet > done:
                    yield self._path(text, base, back, done, meet)
                    text, base, done = text[meet - base :], meet, meet
                check = 4 * longest if meet >= at - 4 * longest else 2 * (at - meet)
        if at > done:
            yield self._path(text, base, back, done, at)

    def _path(self, text: str, base: int, back: dict[int, tuple[int, int]], low: int, high: int) -> list[int]:
        out: list[int] = []
        at = high
        while at > low:
            start, piece = back[at]
            out.extend([piece] if piece >= 0 else reversed(self.spell(text[start - base])))
            at = start
        for key in [k for k in back if k <= high]:
            del back[key]
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        text = (MARK if self.prefix else "") + text.replace(" ", MARK)
        return [i for part in self.stream([text]) for i in part]

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.octets.__getitem__, ids)).decode(errors="replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


class Lanes:
    """The same search over many short stretches side by side, a character of all of them at a time, in numpy."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        starts = sorted(pieces.starts)
        hashes = np.array([self._hash(s) for s in starts], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.piece = np.array([pieces.ids.get(s, -1) for s in starts], np.int64)[order]
        self.scores = np.array(pieces.scores)
        self.spelt = np.full(128, -1, np.int64) if pieces.byte_ids is None else np.array(pieces.byte_ids[:128])

    @staticmethod
    def _sums(codes: np.ndarray) -> np.ndarray:
        width = codes.shape[1]
        sums = np.zeros((len(codes), width + 1), np.uint64)
        np.cumsum(scramble(codes.astype(np.uint64) + np.uint64(1)) * _POWER[:width], axis=1, out=sums[:, 1:])
        return sums

    def _hash(self, text: str) -> int:
        return int(self._sums(np.array([[ord(c) for c in text]], np.uint32))[0, -1])

    def encode(self, stretches: list[str]) -> list[bytes]:
        """Ids of stretches of at most LONGEST_REMEMBERED characters."""
        order = sorted(range(len(stretches)), key=lambda i: -len(stretches[i]))
        texts = [stretches[i] for i in order]
        sizes, width = np.array([len(t) for t in texts]), len(texts[0])
        padded = "".join([t.ljust(width, "\0") for t in texts]).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(padded, np.uint32).reshape(-1, width)
        sums = self._sums(codes)
        score = np.full((len(texts), width + 1), -np.inf)
        score[:, 0] = 0
        back, via = np.zeros(score.shape, np.int64), np.full(score.shape, -1, np.int64)
        for at in range(width):
            lanes = np.arange(np.searchsorted(-sizes, -at))  # those longer than at; the longest come first
            reached, covered = score[lanes, at], np.zeros(len(lanes), bool)
            every = lanes
            for n in range(1, min(self.pieces.longest, width - at) + 1):
                lanes = lanes[: np.searchsorted(-sizes[lanes], -(at + n), side="right")]
                found = (sums[lanes, at + n] - sums[lanes, at]) * _UNPOWER[at]
                place = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
                hit = self.hashes[place] == found
                lanes, piece = lanes[hit], self.piece[place[hit]]
                if not len(lanes):
                    break
                ends = lanes[piece >= 0]
                piece = piece[piece >= 0]
                if n == 1:
                    covered[ends] = True
                self._step(score, back, via, ends, at, at + n, reached[ends] + self.scores[piece], piece)
            bare = every[~covered]
            self._step(score, back, via, bare, at, at + 1, reached[bare] + self.pieces.unknown_score, -1)
        return self._paths(texts, codes, sizes, back, via, order)

    @staticmethod
    def _step(score, back, via, lanes, at, to, total, piece) -> None:
        better = total > score[lanes, to]
        lanes = lanes[better]
        score[lanes, to], back[lanes, to] = total[better], at
        via[lanes, to] = piece[better] if isinstance(piece, np.ndarray) else piece

    def _paths(self, texts, codes, sizes, back, via, order) -> list[bytes]:
        lanes, at = np.arange(len(texts)), sizes.copy()
        seen_lanes, seen_ids, odd = [], [], []
        while len(lanes):
            start, piece = back[lanes, at], via[lanes, at]
            char = codes[lanes, start]
            spelt = piece < 0
            piece = np.where(spelt & (char < 128), self.spelt[np.minimum(char, 127)], piece)
            odd.append(lanes[piece < 0])
            seen_lanes.append(lanes)
            seen_ids.append(piece)
            lanes, at = lanes[start > 0], start[start > 0]
        lanes, ids = np.concatenate(seen_lanes[::-1]), np.concatenate(seen_ids[::-1])
        ids = ids[np.argsort(lanes, kind="stable")].astype(np.int32).tobytes()
        ends = np.cumsum(np.bincount(lanes, minlength=len(texts))) * 4
        out: list[bytes] = [b""] * len(texts)
        low = 0
        for place, high in zip(order, ends.tolist(), strict=True):
            out[place] = ids[low:high]
            low = high
        for lane in set(np.concatenate(odd).tolist()):  # characters that take several bytes
            out[order[lane]] = _ids_of(self.pieces, texts[lane])
        return out


def _ids_of(pieces: Pieces, normalised: str) -> bytes:
    return np.array([i for part in pieces.stream([normalised]) for i in part], np.int32).tobytes()


class Memory:
    """Finds the ids of texts; remembers those of stretches."""

    def __init__(self, model: bytes):
        self.pieces = Pieces(model)
        self.lanes = Lanes(self.pieces)
        self.remembered = Remembered(self.find, REMEMBERED)
        lengths = np.array([len(o) for o in self.pieces.octets])
        self.octets = np.frombuffer(b"".join(self.pieces.octets), np.uint8)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths

    def cut(self, text: str) -> list[str]:
        pieces = self.pieces
        text = (MARK if pieces.prefix and text else "") + text.replace(" ", MARK)
        return _STRETCH.findall(text) if pieces.cuts else [text] * bool(text)

    def find(self, stretches: list[str]) -> list[bytes]:
        found = {s: _ids_of(self.pieces, s) for s in stretches if len(s) >= LONGEST_REMEMBERED or not s}
        short = [s for s in stretches if s not in found]
        for at in range(0, len(short), LANES):
            some = short[at : at + LANES]
            found.update(zip(some, self.lanes.encode(some), strict=True))
        return [found[s] for s in stretches]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and how many a text has."""
        pieces = self.pieces
        # Texts of words with one space between them are cut by Arrow, each of their words once.
        odd = pc.match_substring_regex(texts, f"^ | $|  |{MARK}|^$" if pieces.cuts and pieces.prefix else "")
        split = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        coded = split.flatten().dictionary_encode()
        if pieces.cuts_letters:
            cores, rests, bare = cut_letters(coded.dictionary)
        else:
            cores, rests, bare = pa.array([""] * len(coded.dictionary)), coded.dictionary, pa.array([True] * len(coded.dictionary))
        cores = pc.binary_join_element_wise(pc.if_else(bare, "", MARK), cores, "")
        rests = pc.binary_join_element_wise(pc.if_else(bare, MARK, ""), rests, "")
        others = [self.cut(t) for t in texts.filter(odd).to_pylist()]
        every = pa.concat_arrays([cores, rests, pa.array([s for o in others for s in o], pa.string())]).dictionary_encode()
        stretches = every.dictionary.to_numpy(zero_copy_only=False).tolist()  # ten times as fast as to_pylist()
        parts = self.remembered(stretches)
        for s in stretches:
            if len(s) >= LONGEST_REMEMBERED:
                del self.remembered.known[s]
        part = every.indices.to_numpy()
        words, size = coded.indices.to_numpy(), len(coded.dictionary)
        # Which of the stretches follow each other: both halves of a text's words, or what it was cut into.
        order = np.concatenate([np.stack([part[words], part[size + words]], 1).ravel(), part[2 * size :]])
        n = 2 * np.diff(split.offsets.to_numpy()).astype(np.int64)
        begin, odd = np.cumsum(n) - n, odd.to_numpy(zero_copy_only=False)
        n[odd] = [len(o) for o in others]
        begin[odd] = 2 * len(words) + np.cumsum(n[odd]) - n[odd]
        order = order[ranges(begin, n)]
        ids, lengths = np.frombuffer(b"".join(parts), np.int32), np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
        sizes = lengths[order]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(n)]
        return ids[ranges((np.cumsum(lengths) - lengths)[order], sizes)], np.diff(ends, prepend=0)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of ids[bounds[i]:bounds[i + 1]]."""
        sizes = self.ends[ids] - self.starts[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        octets = self.octets[np.repeat(self.starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
        cut = ends[bounds].tolist()
        texts = [octets[a:b].decode(errors="replace") for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return [t[1:] if self.pieces.prefix and t.startswith(" ") else t for t in texts]


_loaded: dict[bytes, Memory] = {}


def _memory(model: bytes) -> Memory:
    if model not in _loaded:
        _loaded.clear()
        _loaded[model] = Memory(model)
    return _loaded[model]


def encode_texts(texts: pa.Array, memory: Memory) -> pa.Array:
    return _lists([memory.encode(some) for some in chunks(texts.fill_null(""), CHUNK)])


def _lists(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    ends = np.cumsum(np.concatenate([[0], *(n for _, n in found)]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *(ids for ids, _ in found)])))


def decode_ids(lists: pa.Array, memory: Memory) -> pa.Array:
    bounds = np.frombuffer(lists.offsets.buffers()[1], np.int32)[lists.offsets.offset :][: len(lists) + 1].astype(np.int64)
    ids = lists.values.to_numpy(zero_copy_only=False)
    out: list[str] = []
    chunk = (bounds[:-1] - bounds[0]) // CHUNK_IDS
    cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(lists)] if len(lists) else [0]
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        own = bounds[low : high + 1]
        out += memory.decode(ids[own[0] : own[-1]], own - own[0])
    return pa.array(out, pa.string())


def check_batches(batches: Iterable[pa.RecordBatch], memory: Memory) -> Iterator[pa.RecordBatch]:
    """id, ids, round_trip of batches of ids and texts, in batches of some CHUNK bytes of text each."""
    for batch in batches:
        at = 0
        for texts in chunks(batch.column(1), CHUNK):
            ids = _lists([memory.encode(texts)])
            same = pc.equal(decode_ids(ids, memory), pc.replace_substring(texts, MARK, " "))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids, same], ["id", "ids", "round_trip"])
            at += len(texts)


def read_model(path: str) -> bytes:
    """A model file, read once on the driver: the tasks get its bytes."""
    with open(path, "rb") as file:
        return file.read()


def public_model() -> bytes:
    import public_tokenizers

    return read_model(public_tokenizers.path("piece_bpe_32k.model"))


def encode(docs: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs with the ids of their texts, array<int>; null and empty texts have none.  A column of that name is replaced."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids_of(texts: pa.Array) -> pa.Array:
        return encode_texts(texts, _memory(model))

    return in_small_batches(docs).withColumn(ids_col, ids_of(text_col))


def decode(encoded: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """encoded with the texts of their ids; null is no ids.  Bytes that are not UTF-8 become the replacement character.

    Undoes encode() but for space marks (U+2581) in a text, which come back as spaces.
    """

    @F.arrow_udf(T.StringType())
    def text_of(ids: pa.Array) -> pa.Array:
        return decode_ids(ids.fill_null([]) if ids.null_count else ids, _memory(model))

    return encoded.withColumn(text_col, text_of(ids_col))


def encode_and_check(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_ids, ids, round_trip: a row per row of docs.

    round_trip says whether the decoded ids are the text (null as empty), space marks read as spaces.  No rows in, no
    rows out; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # One pass: of decode(encode(rows)) with the ids beside it Spark makes a plan that encodes every text twice.
    schema = T.StructType([rows.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())])
    coded = in_small_batches(rows).mapInArrow(lambda batches: check_batches(batches, _memory(model)), schema)
    return coded.select(F.col("id").alias(id_col), F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")
