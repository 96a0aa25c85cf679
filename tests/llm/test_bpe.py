import hashlib
import random

import public_tokenizers
import pytest
from edge import edge_texts
from tokenizers import Tokenizer

from mercato.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)), ids


@pytest.mark.parametrize("block_chars, deal", [(1 << 24, 64), (1000, 3)])
def test_edges(edges, library, monkeypatch, block_chars, deal):
    monkeypatch.setattr(B, "BLOCK_CHARS", block_chars)
    got = B.encode(edges, PATH, with_ids=True, deal=deal).collect()
    assert len(got) == len(edge_texts())
    texts = {t[0]: t[1] for t in edge_texts()}
    for r in got:
        n, ids_sha, decoded_sha, ids = want(library, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) == (n, ids_sha, decoded_sha, ids)


def test_empty_table(edges):
    assert B.encode(edges.limit(0), PATH).collect() == []


def test_words_of_odd_text_encode_as_the_whole(library):
    vocab = B.vocabulary(open(PATH, encoding="utf-8").read())
    r = random.Random(3)
    pool = [chr(c) for c in range(0x250)] + list("  ​　́﻿\U0001f600Ⅰ٠一\x85\xa0") + [
        "'s", "'ll", " ", "  ", "\n", " \n", "<|endoftext|>", "ab", "1"] * 25
    for _ in range(3000):
        text = "".join(r.choices(pool, k=r.randint(0, 14)))
        ids = [i for w in vocab.split(text) for i in library.encode(w, add_special_tokens=False).ids]
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert b"".join(vocab.pieces[i] for i in ids).decode() == library.decode(ids, skip_special_tokens=False) == text


def test_documents(documents, library):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in B.encode(documents, PATH).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(library, texts[r.doc_id])[:3]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        B.Vocabulary(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())


def test_buckets_follow_the_distinct_words(spark, edges, library, monkeypatch):
    monkeypatch.setattr(B, "DEAL", 2)
    monkeypatch.setattr(B, "BUCKET_WORDS", 100)
    many = spark.range(300).selectExpr("concat_ws(' ', transform(sequence(0, 19), i -> concat('w', id * 20 + i))) AS text")
    assert 50 <= B.word_buckets(many) <= 70 and B.word_buckets(many.limit(0)) == 2
    assert B.word_buckets(many.limit(1).crossJoin(spark.range(50)).select("text")) == 2  # repeats add none
    texts = {t[0]: t[1] for t in edge_texts()}
    for r in B.encode(edges, PATH).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(library, texts[r.doc_id])[:3]
