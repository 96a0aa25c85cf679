import hashlib
from collections import Counter

import public_tokenizers
import pytest
from edge import edge_texts
from tokenizers import Tokenizer

import corpus_pipeline as P
from mercato.llm.mixing import mix
from mercato.llm.quality import quality


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def steps(spark, sf_dir, documents):
    """Input and output of every stage, as run() hands them on."""
    out, docs = [], documents
    for name, stage in P.STAGES:
        new = P.written(stage(spark, docs, sf_dir), name)
        out.append((docs, new))
        docs = new
    return out


def test_stages_return_the_columns_of_documents(steps, documents):
    assert [new.columns for _, new in steps[:-1]] == [documents.columns] * 4


def test_quality_rejects_what_the_classifier_rejects(steps, labels):
    docs, new = steps[0]
    good = {r.doc_id for r in quality(docs, labels).collect() if r.predicted}
    assert rows(new) == Counter(tuple(r) for r in docs.collect() if r.doc_id in good)
    assert 0 < new.count() < docs.count()


def test_exact_stage_keeps_the_largest_id_of_each_text(steps):
    docs, new = steps[1]
    best = {}
    for r in docs.collect():
        best[r.text or ""] = max(r.doc_id, best.get(r.text or "", r.doc_id))
    assert rows(new) == Counter(tuple(r) for r in docs.collect() if best[r.text or ""] == r.doc_id)


def test_near_stage_keeps_one_of_each_class(steps):
    from test_near_dedup import brute_classes

    docs, new = steps[2]
    every = [(r.doc_id, r.text) for r in docs.collect()]
    kept = {r.doc_id for r in new.collect()}
    assert kept == {min(every[i][0] for i in m) for m in brute_classes(every).values()}


def test_mix_stage_repeats_documents_as_decided(steps):
    docs, new = steps[3]
    copies = {r.doc_id: r.copies for r in mix(docs).collect()}
    assert Counter(r.doc_id for r in new.collect()) == Counter({k: v for k, v in copies.items() if v})


def test_last_stage_round_trips(steps):
    docs, new = steps[4]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert new.count() == docs.count()
    for r in new.collect():
        assert r.ids == t.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_edges(spark, sf_dir, edges, name, stage):
    out = stage(spark, edges, sf_dir)
    got = out.collect()
    if name != "bpe":
        assert out.columns == edges.columns
    assert stage(spark, edges.limit(0), sf_dir).collect() == []
    texts = {(t[0], t[1] or "") for t in edge_texts()}
    if name in ("exact_dedup", "near_dedup"):
        assert len({r.text or "" for r in got}) == len(got)
    if name == "exact_dedup":
        assert len(got) == len({t for _, t in texts})


@pytest.mark.parametrize("name, stage", P.STAGES[:4])
def test_names_used_inside_are_free(spark, sf_dir, documents, name, stage):
    docs = documents.filter("doc_id < 100")
    inside = ("__key", "__KEY_", "__quality", "__copy", "__copies")
    wide = docs.selectExpr("*", *[f"concat('{c}', doc_id) AS {c}" for c in inside])
    got, want = stage(spark, wide, sf_dir), stage(spark, docs, sf_dir)
    assert got.columns == wide.columns and rows(got.select(*docs.columns)) == rows(want)
    assert all(r[c] == f"{c}{r.doc_id}" for r in got.collect() for c in inside)


def test_run(spark, sf_dir, steps):
    got = P.run(spark, sf_dir)
    assert rows(got.select("doc_id", "n_tokens", "ids_sha256")) == rows(steps[-1][1].select("doc_id", "n_tokens", "ids_sha256"))
