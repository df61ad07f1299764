"""Phrase collocations by prefix-free parsing.

Texts become words with a mark between pieces.  A window of words whose hash is 0 modulo CHUNK_WORDS is a trigger; a text
is cut at its triggers into chunks that overlap by the trigger's window, one word less than the longest phrase.  Where a
chunk begins and ends depends on its words alone, so what occurs often is cut alike everywhere.  The distinct chunks form
a dictionary with the frequencies of the parse, and phrases are counted inside the dictionary only, weighted by these.  A
phrase that begins in the window shared with the next chunk is counted there, so overlaps count once.

Counting goes in three steps over the dictionary.  Words are counted exactly.  Phrases of frequent words are counted as
48-bit hashes; a hash with a large enough sum marks its phrases as worth spelling out (too many are, if hashes collide,
never too few).  Those are spelt and counted exactly.  What is frequent travels to the tasks as a bitmap of FILTER_BITS;
a crowded bitmap lets more rows through and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import in_small_batches
from spanweave.llm.hashing import scramble
from spanweave.shared import written

CHUNK_WORDS = 16  # on average between two triggers
LONGEST = 3
LEAST = 10
TOP = 2000
#: A candidate goes if a longer one around it occurs in at least so many per cent of its places.
INSIDE = 50
SCALE = 1_000_000

FILTER_BITS = 1 << 27
HASH_BITS = 48
BITMAP_BITS = 8 * 4096  # of bitmap_construct_agg
SLICE_BYTES = 1 << 22
RANK_PARTS = 64

_SEPARATOR = r"[.,;:!?\x0A-\x0D]"
_MARK = "\n"
_U = np.uint64
_STEP = _U(0x2545F4914F6CDD1D)


def _slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, dealt anew: SLICE_BYTES of text at once, or one row with more."""
    held, size = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        place = size + np.cumsum(sizes)
        start = 0
        while start < len(batch):
            end = max(int(np.searchsorted(place, SLICE_BYTES, "right")), start + (not held))
            held.append(batch.slice(start, end - start))
            if end < len(batch):
                yield _joined(held)
                place, held = place - place[end - 1], []
            start = end
        size = int(place[-1]) if len(batch) else size
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def _numbered(keys: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, all below the bound, in order, and each key's place among them."""
    if bound > 8 * len(keys) + (1 << 20):
        return np.unique(keys, return_inverse=True)
    held = np.zeros(bound, bool)
    held[keys] = True
    return np.flatnonzero(held), (np.cumsum(held) - 1)[keys]


def _word_hashes(words: pa.Array, seed: int = 42) -> np.ndarray:
    """As Spark's xxhash64 gives them."""
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.cast(pa.binary()).to_pylist()), _U, len(words))


class Words:
    """The words of many texts in a row: codes into `names`, and where each text starts (one more)."""

    def __init__(self, texts: pa.Array, blanks: bool):
        lists = pc.split_pattern(texts, " ")
        words, starts = lists.flatten(), lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        if blanks:
            full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
            mark = pc.equal(words, _MARK).to_numpy(zero_copy_only=False)
            # One mark between two words is enough.
            at = np.flatnonzero(full)
            row = np.searchsorted(starts, at, "right")
            again = np.zeros(len(at), bool)
            again[1:] = mark[at[1:]] & mark[at[:-1]] & (row[1:] == row[:-1])
            full[at[again]] = False
            words = words.filter(pa.array(full))
            starts = np.concatenate([[0], np.cumsum(full)])[starts]
        coded = words.dictionary_encode()
        self.codes, self.names, self.starts = coded.indices.to_numpy().astype(np.int64), coded.dictionary, starts
        self.sizes = np.diff(starts)
        self.text = np.repeat(np.arange(len(starts) - 1), self.sizes)
        self.mark = np.flatnonzero(pc.equal(self.names, _MARK).to_numpy(zero_copy_only=False))

    def runs(self, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The words from starts on, so many each, joined by spaces."""
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        place = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), self.names.take(pa.array(self.codes[place])))
        return pc.binary_join(lists, " ")


def parse(langs: pa.Array, texts: pa.Array, longest: int = LONGEST, chunk_words: int = CHUNK_WORDS) -> pa.Table:
    """lang, chunk, last, n: how often each chunk occurs in the texts; last chunks share no window with a next one."""
    low = pc.ascii_lower(pc.fill_null(texts, ""))
    spaced = pc.replace_substring(pc.replace_substring_regex(low, _SEPARATOR, f" {_MARK} "), "\t", " ")
    words = Words(spaced, blanks=True)
    window, n = longest - 1, len(words.codes)
    hashes = _word_hashes(words.names)[words.codes]
    starts = words.starts[:-1][words.sizes > 0]
    if window and n >= window:
        rolled = np.zeros(n - window + 1, _U)
        for j in range(window):
            rolled = rolled * _STEP + hashes[j : n - window + 1 + j]
        at = np.flatnonzero(scramble(rolled) % _U(chunk_words) == 0)
        starts = np.union1d(starts, at[words.text[at] == words.text[at + window - 1]])
    row = words.text[starts]
    end = words.starts[row + 1]
    following = np.append(starts[1:], n)
    last = following >= end
    sizes = np.where(last, end, following + window) - starts
    rows = pa.table({"lang": pc.fill_null(langs, "und").take(pa.array(row)), "chunk": words.runs(starts, sizes), "last": pa.array(last)})
    return rows.group_by(["lang", "chunk", "last"]).aggregate([([], "count_all")]).rename_columns(["lang", "chunk", "last", "n"])


class Phrases:
    """The phrases that belong to some dictionary chunks: where they begin, by number of words."""

    def __init__(self, batch: pa.RecordBatch, longest: int):
        self.words = words = Words(batch["chunk"], blanks=False)
        langs = batch["lang"].dictionary_encode()
        self.langs, lang = langs.dictionary, langs.indices.to_numpy().astype(np.int64)
        place = np.arange(len(words.codes)) - np.repeat(words.starts[:-1], words.sizes)
        last = batch["last"].to_numpy(zero_copy_only=False)
        own = np.where(last, words.sizes, words.sizes - (longest - 1))
        self.open = ~np.isin(words.codes, words.mark)
        self.owned = place < own[words.text]
        self.weight = batch["n"].to_numpy()[words.text]
        self.lang = lang[words.text]
        # Words by language, numbered; their hashes name the language too.
        width = max(1, len(words.names))
        keys, self.word = _numbered(self.lang * width + words.codes, len(self.langs) * width)
        edges = np.searchsorted(keys, width * np.arange(len(self.langs) + 1))
        seeds = map(int, _word_hashes(self.langs))
        parts = [_word_hashes(words.names.take(pa.array(keys[i:j] % width)), seed) for i, j, seed in zip(edges, edges[1:], seeds)]
        self.hashes = np.concatenate([np.zeros(0, _U), *parts])

    def begins(self, size: int, open_word: np.ndarray) -> np.ndarray:
        """Places of this chunk's phrases of that many words, all of them open."""
        n = len(self.word) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        fits = self.owned[:n] & (self.words.text[:n] == self.words.text[size - 1 :])
        for j in range(size):
            fits &= open_word[j : n + j]
        return np.flatnonzero(fits)

    def hashed(self, at: np.ndarray, size: int) -> np.ndarray:
        total = np.full(len(at), _U(size))
        for j in range(size):
            total = total * _STEP + self.hashes[self.word[at + j]]
        return (scramble(total) >> _U(64 - HASH_BITS)).astype(np.int64)

    def counted(self, at: np.ndarray, size: int) -> pa.RecordBatch:
        """lang, phrase, size, n of the phrases at these places, compared word by word."""
        names = self.word[at]
        for j in range(1, size):
            names = np.unique(names, return_inverse=True)[1] * (len(self.hashes) + 1) + self.word[at + j]
        first, n = _sums(names, self.weight[at])
        at = at[first]
        sizes = np.full(len(at), size)
        return pa.RecordBatch.from_arrays(
            [self.langs.take(pa.array(self.lang[at])), self.words.runs(at, sizes), pa.array(sizes.astype(np.int32)), pa.array(n)],
            ["lang", "phrase", "size", "n"],
        )


def _sums(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and total weight of each distinct key."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0))
    return order[starts], np.add.reduceat(weight[order], starts)


def _bitmap(cells: DataFrame) -> bytearray:
    """The set of the cells (0..FILTER_BITS-1) as bits, little end first: at most FILTER_BITS / 8 bytes."""
    rows = cells.select((F.col("cell") + 1).alias("cell")).groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")
    )
    bits = bytearray(FILTER_BITS // 8)
    for row in rows.toLocalIterator():
        at = (row.bucket - 1) * BITMAP_BITS // 8
        bits[at : at + BITMAP_BITS // 8] = row.bits
    return bits


def _held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    cell = hashes.astype(_U) & _U(8 * len(bits) - 1)
    return (bits[(cell >> _U(3)).astype(np.int64)] >> (cell & _U(7)).astype(np.uint8)) & 1 == 1


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """lang, chunk, last, n: the distinct chunks of all texts and how often the parse holds them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, "text"):
            yield from parse(part["lang"], part["text"], longest, chunk_words).to_batches()

    texts = in_small_batches(docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")))
    chunks = texts.mapInArrow(cut, "lang string, chunk string, last boolean, n long")
    return chunks.groupBy("lang", "chunk", "last").agg(F.sum("n").alias("n"))


def count_phrases(chunks: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(words, phrases) with lang, phrase, size, n: all words, and the phrases of 2 to longest words that occur so often."""

    def spell_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, "chunk"):
            found = Phrases(part, longest)
            yield found.counted(found.begins(1, found.open), 1)

    spelt = "lang string, phrase string, size int, n long"
    keys = ["lang", "phrase", "size"]
    words = written(chunks.mapInArrow(spell_words, spelt).groupBy(*keys).agg(F.sum("n").alias("n")), "words")
    own_hash = F.xxhash64("lang", "phrase")
    frequent = words.filter(F.col("n") >= least).select(own_hash.bitwiseAND(F.lit(FILTER_BITS - 1)).alias("cell"))
    context = chunks.sparkSession.sparkContext
    word_bits = context.broadcast(bytes(_bitmap(frequent)))

    def hash_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(word_bits.value, np.uint8)
        for part in _slices(batches, "chunk"):
            found = Phrases(part, longest)
            often = found.open & _held(bits, found.hashes)[found.word]
            for size in range(2, longest + 1):
                at = found.begins(size, often)
                hashes = found.hashed(at, size)
                first, n = _sums(hashes, found.weight[at])
                yield pa.RecordBatch.from_arrays([pa.array(hashes[first]), pa.array(n)], ["hash", "n"])

    sums = chunks.mapInArrow(hash_phrases, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    phrase_bits = context.broadcast(
        bytes(_bitmap(sums.filter(F.col("n") >= least).select(F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("cell"))))
    )

    def spell_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_map, phrase_map = np.frombuffer(word_bits.value, np.uint8), np.frombuffer(phrase_bits.value, np.uint8)
        for part in _slices(batches, "chunk"):
            found = Phrases(part, longest)
            often = found.open & _held(word_map, found.hashes)[found.word]
            for size in range(2, longest + 1):
                at = found.begins(size, often)
                at = at[_held(phrase_map, found.hashed(at, size))]
                yield found.counted(at, size)

    phrases = chunks.mapInArrow(spell_phrases, spelt).groupBy(*keys).agg(F.sum("n").alias("n"))
    return words, written(phrases.filter(F.col("n") >= least), "phrases")


def _cuts(phrases: DataFrame) -> DataFrame:
    words = F.split("phrase", " ")
    part = lambda start, size: F.array_join(F.slice(words, start, size), " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut")
    return phrases.select("lang", "phrase", "size", F.col("n").alias("a"), cut).select(
        "lang", "phrase", "size", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"), part(F.col("cut") + 1, F.col("size")).alias("right")
    )


def _inner(phrases: DataFrame) -> DataFrame:
    """lang, phrase, around: the most places of a longer phrase around the phrase."""
    words = F.split("phrase", " ")
    whole = phrases.filter(F.col("size") > 2).select("lang", "n", "size", words.alias("words"))
    sized = whole.select("lang", "n", "size", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("part"))
    placed = sized.select("lang", "n", "words", "part", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("part") + 1)).alias("from"))
    return placed.select("lang", "n", F.array_join(F.slice("words", F.col("from"), F.col("part")), " ").alias("phrase")).groupBy(
        "lang", "phrase"
    ).agg(F.max("n").alias("around"))


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    inside: int = INSIDE,
    chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to `longest` words.

    Texts, with A-Z in lower case, fall into pieces at . , ; : ! ? and line ends, pieces into words at spaces and tabs.
    a counts the phrase's places, n the language's words.  A phrase cut in two has l and r places of its parts and scores
    floor(10^6 * a^2 / (l * r)), exact in 38 digits; its worst cut counts, of equal ones the first.  Phrases with fewer than
    `least` places are none, and those go that lie in a longer one with `inside` per cent of their places.  Ranks are by
    score, then a, both falling, then the phrase's UTF-8 bytes.

    A null language is und, a null text empty; texts without words count for nothing.  Equal rows count each.  No rows in,
    no rows out; other columns are not looked at.
    """
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    chunks = written(dictionary(docs, text_col, lang_col, longest, chunk_words), "chunks")
    words, phrases = count_phrases(chunks, longest, least)
    counts = written(words.filter(F.col("n") >= least).unionByName(phrases).select("lang", "phrase", "n"), "counts")
    part = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    cuts = _cuts(phrases).join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    wide = lambda name: F.col(name).cast("decimal(38,0)")
    cuts = cuts.withColumns({"top": wide("a") * wide("a") * F.lit(SCALE), "under": wide("l") * wide("r")})
    scored = (
        cuts.withColumn("score", F.expr("cast(top as decimal(38,0)) div cast(under as decimal(38,0))"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("worst"))
        .select("lang", "phrase", "a", "worst.l", "worst.r", "worst.score")
    )
    kept = scored.join(_inner(phrases), ["lang", "phrase"], "left").filter(
        F.coalesce(100 * wide("around") < inside * wide("a"), F.lit(True))
    )
    # Ranked in parts first, so that no task sorts all phrases of a language.
    order = "order by score desc, a desc, phrase"
    kept = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    best = kept.withColumn("rank", F.expr(f"row_number() over (partition by lang, part {order})")).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.expr(f"cast(row_number() over (partition by lang {order}) as bigint)")).filter(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
told AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM piece),
gram AS (
  SELECT lang, size, array_to_string(words[place : place + size - 1], ' ') AS phrase
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS place FROM told, (VALUES (1), (2), (3)) s(size))
),
f AS (SELECT lang, size, phrase, count(*) AS n FROM gram GROUP BY ALL HAVING count(*) >= 10),
total AS (SELECT lang, CAST(sum(len(words)) AS bigint) AS n FROM told GROUP BY lang),
cut AS (
  SELECT lang, phrase, n AS a, k, string_split(phrase, ' ') AS w, size
  FROM (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size > 1)
),
scored AS (
  SELECT cut.lang, cut.phrase, a, k, x.n AS l, y.n AS r,
         CAST((1000000::hugeint * a * a) // (x.n::hugeint * y.n) AS bigint) AS score
  FROM cut
  JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1 : k], ' ')
  JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[k + 1 : cut.size], ' ')
  QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, k) = 1
),
around AS (
  SELECT lang, phrase, max(n) AS n
  FROM (SELECT lang, n, unnest([array_to_string(string_split(phrase, ' ')[1 : 2], ' '), array_to_string(string_split(phrase, ' ')[2 : 3], ' ')]) AS phrase
        FROM f WHERE size = 3)
  GROUP BY ALL
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, t.n, score
FROM scored s JOIN total t ON t.lang = s.lang LEFT JOIN around o ON o.lang = s.lang AND o.phrase = s.phrase
WHERE o.n IS NULL OR 100 * o.n < 50 * a
QUALIFY rank <= 2000
"""
