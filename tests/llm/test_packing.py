import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mercato.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def checked(pieces, docs, library, window):
    """Every document whole and in order, sequences gapless and full but for the last."""
    want = Counter((d, tuple(library.encode(t or "", add_special_tokens=False).ids) + (1,)) for d, t in docs)
    at = defaultdict(list)
    for p in pieces:
        assert len(p.ids) == p.length > 0 and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        at[p.sequence_id].append(p)
    stream = []
    for k, s in enumerate(sorted(at)):
        assert s == k
        offset = 0
        for p in sorted(at[s], key=lambda p: p.offset):
            assert p.offset == offset
            offset += p.length
            stream.append(p)
        assert offset == window or (k == len(at) - 1 and offset < window)
    got, held = Counter(), []
    for p in stream:
        assert p.start == len(held)
        held += p.ids
        if len(held) == p.doc_tokens:
            got[(p.doc_id, tuple(held))] += 1
            held = []
    assert not held and got == want


@pytest.mark.parametrize("window", [2048, 7])
def test_edges(edges, library, window):
    pieces = P.pack(edges, PATH, end_id=1, window=window, with_ids=True).collect()
    checked(pieces, [(r.doc_id, r.text) for r in edges.collect()], library, window)


def test_documents(documents, library):
    pieces = P.pack(documents.repartition(7), PATH, end_id=1, with_ids=True).collect()
    checked(pieces, [(r.doc_id, r.text) for r in documents.collect()], library, 2048)


def test_no_tokens_are_shuffled(documents):
    plan = P.pack(documents, PATH, end_id=1)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan and "SinglePartition" not in plan


def test_sequences_are_padded_except_at_powers_of_two(spark):
    pieces = spark.createDataFrame([(0, 2, [3, 4]), (0, 0, [1, 2]), (1, 0, [5, 6, 7])], "sequence_id long, offset long, ids array<int>")
    got = {r.sequence_id: (r.length, r.tokens) for r in P.sequences(pieces, pad_id=9, window=8).collect()}
    assert got == {0: (4, [1, 2, 3, 4]), 1: (3, [5, 6, 7, 9, 9, 9, 9, 9])}


def test_encoder_agrees_with_the_library(library):
    import random
    enc = P.Encoder(open(PATH, encoding="utf-8").read())
    assert enc.fast is not None
    r = random.Random(3)
    pool = [chr(c) for c in range(0x250)] + list("​　﻿\U0001f600Ⅰ٠一\x85\xa0́") + [
        "'s", "'ll", " ", "  ", "\n", " \n", "<|endoftext|>", "ab", "1"] * 25
    for _ in range(3000):
        text = "".join(r.choices(pool, k=r.randint(0, 14)))
        assert enc.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids
    every = "".join(f"a{chr(c)}a {chr(c)}1{chr(c)}  {chr(c)}\n" for c in range(0x3000))
    assert enc.ids(every).tolist() == library.encode(every, add_special_tokens=False).ids


def test_empty_table(edges):
    assert P.pack(edges.limit(0), PATH, end_id=1).collect() == []
