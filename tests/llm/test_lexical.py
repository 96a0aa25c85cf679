import math
from collections import Counter

import numpy as np
import pytest
import regex

from mercato.llm import lexical as X

TERM = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    big_n, big_l = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = Counter()
    for item, text in set(items):
        scored = []
        for d, c in counts:
            m = 100 - 75 + 75 * sum(c.values()) * big_n // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1):
            out[(item, r, d, -s)] += 1
    return out


def rows(df):
    return Counter((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect())


QUERIES = [(1, "Alpha beta BETA naïve x1 123"), (2, "日本語 Straße the the of of"), (2, "another text of gamma7"), (3, None), (4, ""),
           (1, "Alpha beta BETA naïve x1 123"), (None, "null id one"), (5, "nothingmatches"), (6, "hunter2hunter2 password alpha3 alpha4")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*q, "x", 1) for q in QUERIES], "item_id long, text string, term string, m int")


def test_edges_match_brute_force(edges, items):
    docs = [(r.doc_id, r.text) for r in edges.collect()]
    assert rows(X.lexical_search(edges, items)) == brute(docs, QUERIES, 10)


@pytest.mark.parametrize("block_rows, seeds, query_set, k", [(2, 1, 2, 3), (7, 2, 512, 10), (4096, 1, 1, 1)])
def test_small_blocks_and_query_sets_change_nothing(spark, documents, items, sf_dir, block_rows, seeds, query_set, k):
    docs = documents.filter("doc_id < 120")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").filter("item_id < 6").select("item_id", "text")
    index = X.build_index(docs, block_rows=block_rows)
    got = X.search(index, bench, k, seeds=seeds, query_set=query_set).withColumnsRenamed({"item": "item_id", "doc": "doc_id"})
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in bench.collect()], k)
    assert rows(got) == want


def test_ties_go_by_id_and_repeated_rows_take_ranks(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in (9, 3, 3, 7)] + [(1, "other"), (2, "more")], "doc_id long, text string")
    items = spark.createDataFrame([(0, "words")], "item_id long, text string")
    assert [(r.rank, r.doc_id) for r in X.lexical_search(docs, items, k=3).orderBy("rank").collect()] == [(1, 3), (2, 3), (3, 7)]


def test_blocks_are_equal_in_m_and_postings_descend(documents):
    index = X.build_index(documents, block_rows=5)
    ids = {(r.m, r.slice): r.ids for r in index.blocks.collect()}
    size = {r.doc_id: len(terms(r.text)) for r in documents.collect()}
    for (m, _), docs in ids.items():
        assert {25 + 75 * size[d] * index.documents // index.terms for d in docs} == {m}
    held = Counter()
    for r in index.postings.collect():
        tfs, runs = np.frombuffer(r.runs, "<u4").reshape(-1, 2).T.tolist()
        docs = np.frombuffer(r.docs, "<u2").tolist()
        assert tfs == sorted(set(tfs), reverse=True) and tfs[0] == r.max_tf and sum(runs) == r.df == len(set(docs))
        for d, tf in zip(docs, np.repeat(tfs, runs).tolist()):
            held[ids[r.m, r.slice][d]] += tf
    assert held == {d: n for d, n in size.items() if n}


def test_blocks_below_the_floor_are_not_scored(spark, monkeypatch):
    """Long documents that hold the term once can't reach short ones that do nothing else."""
    docs = spark.createDataFrame([(i, "needle " * 3) for i in range(20)] + [(100 + i, "needle " + f"hay{i} " * 500) for i in range(20)]
                                 + [(200 + i, "straw " * 40) for i in range(60)], "doc_id long, text string")
    index = X.build_index(docs)
    m = sorted({r.m for r in index.blocks.collect()})
    assert len(m) == 3
    visited, scored = [], X._scored
    monkeypatch.setattr(X, "_scored", lambda wanted, *a: (visited.extend(r.m for r in wanted.collect()), scored(wanted, *a))[1])
    got = X.search(index, spark.createDataFrame([(0, "needle")], "item_id long, text string"), 10, seeds=1).collect()
    assert sorted(r.doc for r in got) == list(range(10)) and visited == m[:1]


def test_empty_tables(edges, items):
    assert X.lexical_search(edges.limit(0), items).collect() == []
    assert X.lexical_search(edges, items.limit(0)).collect() == []
