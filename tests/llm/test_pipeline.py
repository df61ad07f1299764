"""The registered queries against DuckDB, and the pipeline's stages against plain Python, each on its own input."""

import collections

import pytest

import corpus_pipeline
from __spark_entry__ import queries
import plain
from checks.compare import compare, duck
from spanweave.llm import importance, mixing, registry, sentencepieces
from spanweave.llm.common import table
from spanweave.shared import written


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_oracle(spark, name, size):
    folder = f"/root/testdata/{size}"
    assert compare(spark, duck(folder), name, folder) == ""


def test_registered():
    numbers = [n[2:].split("_")[0] for n in registry.QUERIES if n.startswith("op")]
    assert numbers == [str(n) for n in range(1, 14)] and "pipeline" in queries()


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns, inputs = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = {r.doc_id: r for r in docs.collect()}
        rows = docs.collect()
        docs = written(stage(spark, docs, sf), name)
        out = docs.collect()
        if name != "encode_pieces":
            assert docs.columns == columns
        if name == "quality":
            judged = importance.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))
            assert {r.doc_id for r in out} == {r.doc_id for r in judged.collect() if r.kept} and len(out) < len(rows)
        if name == "exact_dedup":
            first = {}
            for r in sorted(rows, key=lambda r: r.doc_id):
                first.setdefault(plain.normal(r.text), r.doc_id)
            assert sorted(r.doc_id for r in out) == sorted(first.values())
        if name == "near_dedup":
            groups = plain.near_groups({r.doc_id: r.text for r in rows})
            assert sorted(r.doc_id for r in out) == sorted(i for i, (_, c) in groups.items() if i == c)
        if name == "mix_sources":
            marked = {r.doc_id: r.copies for r in mixing.mark_copies(spark.createDataFrame(rows)).collect()}
            assert collections.Counter(r.doc_id for r in out) == {i: n for i, n in marked.items() if n}
        if name == "encode_pieces":
            pieces = sentencepieces.Pieces(sentencepieces.public_model())
            assert len(out) == len(rows) and all(r.round_trip for r in out)
            for r in out[:30]:
                assert r.ids == plain.best_cut(pieces, inputs[name][r.doc_id].text[:10**6])
        else:
            texts = {r.doc_id: r.text for r in rows}
            assert all(texts[r.doc_id] == r.text for r in out)
    again = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, tuple(r.ids)) for r in again) == sorted((r.doc_id, tuple(r.ids)) for r in out)
