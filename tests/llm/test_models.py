"""SentencePiece, Katz scores and token files against plain Python and the tokenizers themselves."""

import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import plain
from spanweave.llm import ans, katz, sentencepieces, token_files

ODD = ["", " ", "   ", "a  b ", " lead", "trail ", "▁x y", "x▁ ▁y", "日本語 テキスト🙂 ok", "a\n\n b\t c", "x" * 400, "é" * 300, "a" * 60 + " b", "!" * 200]


@pytest.fixture(scope="module")
def model():
    return sentencepieces.public_model()


@pytest.fixture(scope="module")
def memory(model):
    return sentencepieces.Memory(model)


@pytest.fixture(scope="module")
def texts(spark, sf):
    return [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()] + ODD


def test_streaming_equals_the_search_over_the_whole_text(memory, texts):
    for text in [t[:1500] for t in texts]:
        assert memory.pieces.encode(text) == plain.best_cut(memory.pieces, text)


def test_side_by_side_equals_one_by_one(memory, texts):
    found = sentencepieces.encode_texts(pa.array([*texts, None]), memory).to_pylist()
    assert found == [memory.pieces.encode(t) for t in texts] + [[]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("the anding▁ \nß🙂é.,x"), max_size=80), max_size=5))
def test_any_text(memory, some):
    found = sentencepieces.encode_texts(pa.array(some, pa.string()), memory)
    assert found.to_pylist() == [plain.best_cut(memory.pieces, t) for t in some]
    assert sentencepieces.decode_ids(found, memory).to_pylist() == [t.replace("▁", " ") for t in some]


def test_letters_are_searched_once_whatever_follows_them(model):
    memory, given_ = sentencepieces.Memory(model), []
    lanes = memory.lanes.encode
    memory.lanes.encode = lambda some: given_.extend(some) or lanes(some)
    signs = [",", ".", "###", ";\nAnd", "1999", "'s", "!?", ""]
    texts = [" ".join(f"erenesnd{s} tentionß{s}" for s in signs)] * 2 + ["erenesnd tentionß"]
    assert sentencepieces.encode_texts(pa.array(texts), memory).to_pylist() == [memory.pieces.encode(t) for t in texts]
    assert sorted(given_) == sorted({"▁erenesnd", "▁tentionß", *signs[:-1]})


def test_every_text_is_searched_once(spark, model, texts):
    memory, given_ = sentencepieces.Memory(model), []
    encode = memory.encode
    memory.encode = lambda some: given_.extend(some.to_pylist()) or encode(some)
    some = [*texts, "", "x" * sentencepieces.CHUNK, "a▁b", "word " * 200_000, "c"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(some))), pa.array(some)], ["id", "text"])
    found = list(sentencepieces.check_batches([batch, batch.slice(0, 0), batch.slice(2)], memory))
    assert given_ == some + some[2:] and len(found) > 4
    rows = [r for b in found for r in b.to_pylist()]
    assert [r["id"] for r in rows] == [*range(len(some)), *range(2, len(some))] and all(r["round_trip"] for r in rows)
    assert [r["ids"] for r in rows[: len(some)]] == [memory.pieces.encode(t) for t in some]
    plan = sentencepieces.encode_and_check(spark.createDataFrame([(1, "a")], "doc_id long, text string"), model)._jdf.queryExecution().executedPlan().toString()
    assert "ids_of" not in plan and plan.count("MapInArrow") == 1


def test_a_large_batch_takes_little_memory(model):
    memory = sentencepieces.Memory(model)
    batch = pa.array([" ".join(f"{i:x}er{i * j % 977}" for i in range(2000)) for j in range(150)])  # 2.6 MB of ever new words
    tracemalloc.start()
    ids = sentencepieces.encode_texts(batch, memory)
    sentencepieces.decode_ids(ids, memory)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20


@pytest.mark.parametrize("changed", [{"cuts_letters": False}, {"cuts": False}, {"prefix": False}, {}])
def test_cuts_change_no_ids(model, texts, monkeypatch, changed):
    monkeypatch.setattr(sentencepieces, "REMEMBERED", 300)
    monkeypatch.setattr(sentencepieces, "CHUNK", 5000)
    memory = sentencepieces.Memory(model)
    vars(memory.pieces).update(changed)
    some = [*texts, *ODD, None, "×a÷b ×, ǅa ɐ, ă. 日,a", "Ȁ×, x÷", "a  b", " a", "▁"]
    found = sentencepieces.encode_texts(pa.array(some), memory).to_pylist()
    assert found == [memory.pieces.encode(t or "") for t in some]
    assert len(memory.remembered.known) < 5000 and not any(len(s) >= sentencepieces.LONGEST_REMEMBERED for s in memory.remembered.known)


def test_nothing_is_held_back_behind_a_meeting_place(memory):
    # Blocks come one by one; after each all but a window's worth has been committed.
    pieces, given_, got = memory.pieces, 0, 0

    def blocks():
        nonlocal given_
        for _ in range(200):
            given_ += 1
            yield "▁word▁and▁another"

    for ids in pieces.stream(blocks()):
        got += sum(len(pieces.octets[i].decode()) for i in ids)
        assert given_ * 17 - got <= 5 * pieces.longest + 17


def test_the_library_finds_no_better_cut(memory, model):
    # The same file read as a unigram model: type 2 (BPE) becomes 1.
    at = model.index(b"\x18\x02\x20\x80\xfa\x01")
    library = sentencepiece.SentencePieceProcessor(model_proto=model[:at] + b"\x18\x01" + model[at + 2 :])
    score = lambda ids: sum(memory.pieces.scores[i] for i in ids)
    for text in ("the anding of thth", "hend and oftionnt", "Thtiont inger", "la ción de"):
        assert score(memory.pieces.encode(text)) == score(library.nbest_encode_as_ids(text, 2)[0])


def test_ids_decode_in_the_library(memory, model, texts):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    for text in texts:
        assert library.decode(memory.pieces.encode(text)) == text.replace("▁", " ")


def test_encoding_tables(spark, model):
    rows = [(1, "a b"), (1, "a b"), (2, None), (None, ""), (3, "word " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit(0), "decoded": F.lit(0)})
    found = sentencepieces.encode_and_check(docs, model).collect()
    assert len(found) == 5 and all(r.round_trip for r in found)
    assert {r.doc_id: r.n_ids for r in found}[2] == 0
    assert sentencepieces.encode_and_check(docs.limit(0), model).count() == 0
    assert sentencepieces.encode(docs, model).columns == docs.columns


def katz_rows(docs):
    return {r.doc_id: r for r in katz.score_documents(docs).collect()}


@pytest.mark.parametrize("tokens, keys", [(1 << 21, 1 << 20), (5000, 2000)])
def test_katz_against_plain_counts(spark, sf, monkeypatch, tokens, keys):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(katz, "PARTITION_KEYS", keys)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = plain.Katz({r.doc_id: r.text for r in docs.collect()})
    found = katz_rows(docs)
    for i, row in found.items():
        base, score = model.score(i)
        own = model.tokens[i]
        assert (row.held_out, row.n_tokens, row.train_tokens) == (i not in model.train, len(own), model.total)
        assert row.n_known == sum(model.single[w] > 0 for w in own)
        assert row.base_score == pytest.approx(base, abs=1e-6) and row.score == pytest.approx(score, abs=1e-6)
    held = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    for h in ["begin", *list(model.follow)[:50], b"never seen"]:  # all histories sum to one
        seen, other = model.after(h)
        rest = sum(p for w, p in model.lower.items() if w not in seen) + model.unknown
        assert sum(seen.values()) + other * rest == pytest.approx(1)


def test_katz_on_odd_rows(spark):
    rows = [(1, "a b"), (1, "a b"), (2, None), (None, ""), (3, "w " * 60_000), (4, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"block": F.lit(0), "score": F.lit(0)})
    found = katz.score_documents(docs).collect()
    assert len(found) == 6 and all(np.isfinite(r.score) for r in found)
    assert {r.doc_id: r.n_tokens for r in found} == {1: 3, 2: 1, None: 1, 3: 60_001, 4: 3}
    assert katz.score_documents(docs.limit(0)).count() == 0
    untrained = spark.createDataFrame([(i, "a") for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1], "doc_id long, text string")
    assert all(np.isfinite(r.score) and r.n_known == 0 for r in katz.score_documents(untrained).collect())


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000, 70_000, 600_001])
def test_coded_blocks(n):
    rng = np.random.default_rng(n)
    ids = (rng.pareto(1.0, n) * 20).astype(np.int64).clip(0, 70_000).astype(np.uint32)
    table = ans.Frequencies(np.bincount(ids, minlength=70_001))
    block = ans.encode(ids, table)
    assert (ans.decode(block, table) == ids).all()
    step = block.lanes * ans.CHECK_STEPS
    for check in range(len(block.places)):  # from every checkpoint
        assert (ans.decode(block, table, check, check + 1) == ids[check * step : (check + 1) * step]).all()
    if n > 10_000:
        p = np.bincount(ids)[np.bincount(ids) > 0] / n
        assert len(block.words) * 8 / n < -(p * np.log2(p)).sum() * 1.02
        broken = block._replace(words=block.words[:100] + bytes([block.words[100] ^ 1]) + block.words[101:])
        with pytest.raises((ValueError, IndexError)):
            ans.decode(broken, table)


def test_joined_checksums():
    for a, b in ((b"", b""), (b"abc", b""), (b"", b"abc"), (b"hello" * 100, b"tail" * 999)):
        assert ans.join_crcs(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@pytest.mark.parametrize("block", [1 << 20, 700])
def test_token_files_against_the_tokenizer(spark, sf, tmp_path, monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK", block)
    with open(public_tokenizers.path("byte_bpe_50k.json")) as file:
        tokenizer = file.read()
    library = tokenizers.Tokenizer.from_str(tokenizer)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate([None, *ODD, "it's 'tis <|endoftext|> x", "hello <|endoftext|> world", "a<|endoftext|>b <|endoftext|>", "été's naïve²x ½a x½ don't (see) +1 é́x āb ﬁ Ⅳ ʼn"])], docs.schema)
    docs = docs.unionByName(more)
    token_files.write_token_files(docs, str(tmp_path / "t"), tokenizer)
    found = {r.doc_id: r for r in token_files.read_token_files(spark, str(tmp_path / "t")).collect()}
    start = 0
    for row in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        own = found[row.doc_id]
        assert (own.start, own.n_tokens, own.ids_crc32) == (start, len(ids), crc)
        start += len(ids)
    assert len(found) == docs.count()
    decoded = token_files.decode_blocks(spark, str(tmp_path / "t"))
    assert decoded.agg(F.sum(F.size("ids"))).first()[0] == start


def test_token_files_of_odd_rows(spark, tmp_path):
    with open(public_tokenizers.path("byte_bpe_50k.json")) as file:
        tokenizer = file.read()
    docs = spark.createDataFrame([(2, "a b"), (2, "c d e"), (None, "x"), (1, None)], "doc_id long, text string").withColumn("part", F.lit("mine"))
    found = sorted((r.start, r.doc_id, r.n_tokens) for r in token_files.query(spark, docs, tokenizer).collect())
    assert [f[1] for f in found] == [None, 1, 2, 2] and found[-1][0] + found[-1][2] == sum(f[2] for f in found)
    assert token_files.query(spark, docs.limit(0), tokenizer).count() == 0


class Counted:
    """A merge model that counts its calls."""

    def __init__(self, model):
        self.model, self.calls = model, 0

    def tokenize(self, text):
        self.calls += 1
        return self.model.tokenize(text)


@pytest.mark.parametrize("remembered", [300_000, 500])
def test_the_merge_model_gets_many_words_at_once(monkeypatch, remembered):
    monkeypatch.setattr(token_files, "REMEMBERED", remembered)
    with open(public_tokenizers.path("byte_bpe_50k.json")) as file:
        tokenizer = file.read()
    library, words = tokenizers.Tokenizer.from_str(tokenizer), token_files.Words(tokenizer)
    words.model = counted = Counted(words.model)
    rng = np.random.default_rng(1)
    made = ["".join(rng.choice(list("aeioutnrsléßÀğ"), rng.integers(1, 9))) + rng.choice(["", "", ",", ".\n", "'s", "###", "日"]) for _ in range(6000)]
    spaces = ["x\u2003 y z", "x \u2003y z", "a \x1cb", "a \x85", "a\xa0 b \xa0c", "a b ", " a", "", "a <|endoftext|> b"]
    texts = [" ".join(made[at : at + 40]) for at in range(0, len(made), 40)] + spaces
    for low in (0, 40, 80, 120):
        some = texts[low : low + 40]
        ids, n = words.encode(pa.array(some), 0)
        assert np.split(ids, np.cumsum(n)[:-1])[0].dtype == np.uint32
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [[*library.encode(t, add_special_tokens=False).ids, 0] for t in some]
    assert counted.calls <= 4 * (1 + 1600 // token_files.JOINED)


def test_packed_ids_of_any_size():
    ids, n = np.array([1, 2, 70_000, 0, 65_535, 0], np.uint32), np.array([2, 2, 2])
    for own, sizes in ((ids, n), (ids[4:], n[:1]), (ids[:2], np.array([1, 1]))):
        rows = token_files._packed(own, sizes).to_pylist()
        assert [token_files._unpack(x, k).tolist() for x, k in zip(rows, sizes)] == [x.tolist() for x in np.split(own, np.cumsum(sizes)[:-1])]
    assert len(token_files._packed(ids[4:], n[:1])[0].as_py()) == 4


def test_ids_are_counted_in_batches_of_many_texts(monkeypatch):
    calls = []
    count = np.bincount
    monkeypatch.setattr(np, "bincount", lambda *args, **kinds: calls.append(1) or count(*args, **kinds))
    packed = [np.array([i % 7, 50_000 - i], "<u2").tobytes() for i in range(1000)]
    batches = [pa.RecordBatch.from_arrays([pa.array([2] * 500), pa.array(packed[low : low + 500])], ["n", "ids"]) for low in (0, 500)]
    (found,) = token_files._count(iter(batches))
    assert sum(found["n"].to_pylist()) == 2000 and found["symbol"].to_pylist() == [*range(7), *range(49_001, 50_001)]
    assert len(calls) == 1


def test_letters_go_to_the_merge_model_once_whatever_follows_them():
    with open(public_tokenizers.path("byte_bpe_50k.json")) as file:
        words = token_files.Words(file.read())
    given_, letters = [], words.cores.find
    words.cores.find = lambda some: given_.extend(some) or letters(some)
    texts = ["x erenesnd erenesnd, erenesnd.\nAnd", "x erenesnd### tentionß!", "x tentionß ×a ɐ日 1a"]
    for text in texts:
        ids, _ = words.encode(pa.array([text]), 0)
        assert ids.tolist() == [*words.tokenizer.encode(text, add_special_tokens=False).ids, 0]
    assert sorted(g for g in given_ if g) == ["erenesnd", "tentionß"]
