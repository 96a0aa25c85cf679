import random
import zlib
from collections import Counter

import numpy as np
import pytest
import regex

from mercato.llm import spelling as S

RUN = regex.compile(r"[A-Za-zÀ-ÿ]+")


def vocabulary(docs):
    n = Counter()
    for d, text in docs:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + 1:] == b[p + 1:] if len(a) == len(b) else a[p:] == b[p + 1:]


def brute(n):
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    best = {w: min(near[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: b if b is not None and n[b] >= 2 * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def result(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("list_words", [512, 2])
def test_edges_match_brute_force(edges, list_words):
    assert result(S.spelling_variants(edges, list_words=list_words)) == brute(vocabulary([(r.doc_id, r.text) for r in edges.collect()]))


@pytest.mark.parametrize("list_words", [512, 1])
def test_dense_vocabulary(spark, list_words):
    """Every edit at every place, among words over three letters, with chains, ties and very long words."""
    r = random.Random(5)
    words = {"".join(r.choices("abñ", k=r.randint(5, 7))) for _ in range(300)} | {"q" * 3000, "q" * 3001, "q" * 1500 + "z" + "q" * 1499}
    text = [(i, " ".join([w] * r.choice([3, 3, 6, 7, 14, 30]))) for i, w in enumerate(sorted(words))]
    docs = spark.createDataFrame(text, "doc_id long, text string")
    want = brute(vocabulary(text))
    assert result(S.spelling_variants(docs, list_words=list_words)) == want
    assert max(v[3] for v in want.values()) > 5 and any(v[0] not in (None, v[1]) for v in want.values())


def test_blocks_cut_at_lists(spark, documents, monkeypatch):
    docs = documents.filter("doc_id < 60")
    want = brute(vocabulary([(r.doc_id, r.text) for r in docs.collect()]))
    monkeypatch.setattr(S, "BLOCK_CELLS", 50)
    monkeypatch.setattr(S, "FLUSH", 20)
    assert result(S.spelling_variants(docs)) == want


def test_lists_are_bounded(spark):
    """Thousands of words with one beginning are dealt on until lists are small, and no pair is lost."""
    r = random.Random(1)
    words = sorted({"common" + "".join(r.choices("abcdefgh", k=6)) for _ in range(1500)})
    listed = S.lists(spark.createDataFrame([(w, 3) for w in words], "word string, n long"), most=40)
    assert max(x["count"] for x in listed.groupBy("list").count().collect()) <= 40
    got = {x.word: x.near for x in S.neighbours(listed).groupBy("word").agg({"near": "sum"}).withColumnRenamed("sum(near)", "near").collect()}
    want = {w: sum(one_edit(w, x) for x in words) for w in words}
    assert got == {w: c for w, c in want.items() if c}


def test_scan_of_one_block():
    words = ["casas", "casa", "cosas", "caasas", "basas"]
    m = np.full(5, 5)
    a, b = S.near_in_block(words[:1] + words[2:], np.ones(4, np.int64), m[:4], np.zeros(4, np.int64), m[:4], np.zeros(4, np.int64))
    assert sorted(zip(a.tolist(), b.tolist())) == [(0, 1), (0, 2), (0, 3), (1, 0), (2, 0), (3, 0)]


def test_empty_table(edges):
    assert S.spelling_variants(edges.limit(0)).collect() == []
