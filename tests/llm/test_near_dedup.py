import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from edge import edge_texts
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from mercato.llm import near_dedup as N
from mercato.llm.alignment import allowed_edits, similar
from mercato.llm.components import components


def edits(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return d[-1]


WORDS = st.lists(st.integers(0, 12), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(WORDS, st.lists(st.tuples(st.integers(0, 40), st.integers(0, 12)), max_size=6)), max_size=8),
       st.sampled_from([0.5, 0.8, 0.95]))
def test_banded_alignment_is_the_edit_distance(cases, threshold):
    pairs = []
    for a, changes in cases:
        b = list(a)
        for at, x in changes:
            if at < len(b):
                b[at:at + 1] = [x, x] if x % 3 else []
        pairs.append((np.array(a, np.int64), np.array(b, np.int64)))
    want = [edits(a.tolist(), b.tolist()) <= allowed_edits(len(a), len(b), threshold) for a, b in pairs]
    assert similar(pairs, threshold).tolist() == want


def brute_classes(rows, threshold=0.8):
    """Union of all pairs of similar word lists, by comparing everything with everything."""
    words = [(t or "").lower().split() for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = words[i], words[j]
            if abs(len(a) - len(b)) <= allowed_edits(len(a), len(b), threshold) and (a or b) or rows[i][1] == rows[j][1]:
                if len(set(a) & set(b)) * 3 < min(len(set(a)), len(set(b))):
                    continue
                if similar([(np.array([hash(w) for w in a], np.int64), np.array([hash(w) for w in b], np.int64))], threshold)[0]:
                    root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    return groups


def check(docs, rows):
    got = N.near_dedup(docs).collect()
    assert len(got) == len(rows)
    classes = defaultdict(list)
    for r in got:
        classes[r.class_id].append(r)
    for c, members in classes.items():
        assert sum(r.kept for r in members) == 1 and {r.class_size for r in members} == {len(members)}
        assert next(r.doc_id for r in members if r.kept) == c == min((r.doc_id for r in members if r.doc_id is not None), default=None)
    return got


def test_documents_against_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: r.class_id for r in check(documents, rows)}
    for members in brute_classes(rows).values():
        assert len({got[rows[i][0]] for i in members}) == 1
    assert len(set(got.values())) == len(brute_classes(rows))


def test_edges(edges):
    got = check(edges, edge_texts())
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add(r.class_id)
    assert by_id[1] == by_id[2] == by_id[9] == {1}   # two copies and a near copy
    assert by_id[3] == by_id[4] == {3}               # null and empty text
    assert by_id[None] == {None} and by_id[6] == {6}
    assert N.near_dedup(edges.limit(0)).collect() == []


def test_a_large_group_and_a_shared_passage(spark):
    r = random.Random(5)
    word = lambda: f"w{r.randrange(5000)}"
    base, passage = [word() for _ in range(120)], " ".join(word() for _ in range(60))
    rows = []
    for i in range(80):  # near copies, each with a few other words
        w = list(base)
        for k in r.sample(range(120), 4):
            w[k] = word()
        rows.append((i, " ".join(w)))
    rows += [(100 + i, passage + " " + " ".join(word() for _ in range(90))) for i in range(40)]  # different texts
    got = {x.doc_id: x for x in check(spark.createDataFrame(rows, "doc_id long, text string"), rows)}
    assert {got[i].class_id for i in range(80)} == {0} and all(got[i].n_links >= 1 for i in range(80))
    assert all(got[100 + i].class_size == 1 and got[100 + i].kept for i in range(40))


def test_order_minhash_sees_order():
    a = [f"w{i}" for i in range(200)]
    b = a[100:] + a[:100]
    c = a[:60] + ["other"] + a[61:]
    tok, off = N.token_hashes(pa.array([" ".join(x) for x in (a, b, c)], pa.large_string()))
    s = N.order_minhash(*N.labelled_kmers(tok, off, 5), 200, 2)
    assert (s[0] == s[2]).mean() > 0.8 and (s[0] == s[1]).mean() < 0.75


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(139, 7), (200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {n: 0 for n in [*range(1, 31), *range(100, 140)]}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def planted(r, n, similarity):
    """A text of n words and a copy with as many other words as the similarity allows, spread over it."""
    a = [f"w{r.randrange(20000)}" for _ in range(n)]
    b = list(a)
    for i in r.sample(range(n), int((1 - similarity) * n + 1e-9)):
        b[i] = f"x{r.randrange(20000)}"
    return " ".join(a), " ".join(b)


def test_pairs_at_the_threshold_and_short_pairs_are_found(spark):
    r = random.Random(11)
    short = [planted(r, n, 0.8) for n in range(5, 13) for _ in range(12)]
    short += [(" ".join(w), " ".join(w[:i] + w[i + 1:])) for w in ([f"v{r.randrange(20000)}" for _ in range(n)]
                                                                   for n in range(5, 13)) for i in (0, len(w) // 2)]
    long = [planted(r, r.randrange(60, 250), s) for s in (0.8, 0.82, 0.85) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(t for pair in short + long for t in pair)]
    got = {x.doc_id: x.class_id for x in check(spark.createDataFrame(rows, "doc_id long, text string"), rows)}
    found = [got[2 * i] == got[2 * i + 1] for i in range(len(rows) // 2)]
    assert all(found[:len(short)])
    assert np.mean(found[len(short):]) >= 0.97


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=N.SHORT),
       st.lists(st.tuples(st.integers(0, N.SHORT), st.integers(0, 30), st.sampled_from("sdi")), max_size=9))
def test_similar_short_texts_share_a_name(a, changes):
    b = list(a)
    for at, x, what in changes:
        if at < len(b):
            b[at:at + 1] = {"s": [x], "d": [], "i": [x, b[at]]}[what]
    if b and max(len(a), len(b)) <= N.SHORT and edits(a, b) <= allowed_edits(len(a), len(b), 0.8):
        tok, off = N.token_hashes(pa.array([" ".join(f"w{x}" for x in t) for t in (a, b)], pa.large_string()))
        names, ends = N.bucket_names(tok, off, N.K, N.SKETCHES, N.MINIMA, N.THRESHOLD)
        assert set(names[:ends[1]]) & set(names[ends[1]:])


def test_a_text_similar_to_a_matched_member_only(spark):
    """x is similar to the bucket's first text c and to y, c and y are not similar: one class all the same."""
    r = random.Random(2)
    while True:
        x = [f"w{r.randrange(20000)}" for _ in range(100)]
        c = [f"c{i}" if i < 18 else w for i, w in enumerate(x)]
        y = [f"y{i}" if 90 <= i else w for i, w in enumerate(x)]
        tok, off = N.token_hashes(pa.array([" ".join(t) for t in (c, x, y)], pa.large_string()))
        names, _ = N.bucket_names(tok, off, N.K, 1, 1, N.THRESHOLD)
        if len(set(names.tolist())) == 1:  # the only bucket holds all three
            break
    assert (edits(c, x), edits(x, y), edits(c, y)) == (18, 10, 28)
    rows = [(i, " ".join(t)) for i, t in enumerate((c, x, y))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = N.near_dedup(docs, sketches=1, minima=1).collect()
    assert {g.class_id for g in got} == {0} and {g.doc_id: g.n_links for g in got} == {0: 1, 1: 2, 2: 1}


def test_members_of_one_component_are_not_paired_by_words(spark):
    rare = spark.createDataFrame([(n, 7, 10, c, 4, []) for n, c in enumerate([0] * 5 + [1, 1, 2, 3])],
                                 "node long, word long, n long, c int, groups long, prev array<long>")
    comp = dict(enumerate([0] * 5 + [1, 1, 2, 3]))
    got = sorted((p.node, p.centre) for p in N.joined_by_words(rare, 0.8).collect())
    assert got == sorted((i, j) for i in comp for j in comp if i > j and comp[i] != comp[j])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=80),
       st.lists(st.tuples(st.integers(0, 80), st.integers(0, 30), st.sampled_from("sdi")), max_size=16),
       st.sampled_from([0.75, 0.8, 0.9]))
def test_similar_texts_share_as_many_runs_as_needed(a, changes, threshold):
    b = list(a)
    for at, x, what in changes:
        if at < len(b):
            b[at:at + 1] = {"s": [x], "d": [], "i": [x, b[at]]}[what]
    if b and edits(a, b) <= allowed_edits(len(a), len(b), threshold):
        for width in {1, N.run_width(threshold)}:
            tok = np.array(a + b, np.uint64)
            runs, upto = N.labelled_kmers(tok, np.array([0, len(a), len(a) + len(b)]), width)
            both = set(runs[:upto[1]].tolist()) & set(runs[upto[1]:].tolist())
            assert len(both) >= max(N.needed(len(a), width, threshold), N.needed(len(b), width, threshold))


def test_the_join_of_the_rest_finds_every_similar_pair(spark):
    """Texts around one passage and near copies of some, each a component of its own, against all pairs."""
    r = random.Random(3)
    passage = [f"p{i}" for i in range(70)]
    texts = [passage + [f"w{r.randrange(300)}" for _ in range(30)] for _ in range(60)]  # crowded pairs of words
    texts += [[w if r.random() > 0.08 else f"x{r.randrange(300)}" for w in t] for t in texts[:20]]
    texts += [[f"y{r.randrange(40)}" for _ in range(n)] for n in (1, 2, 5, 10, 40) for _ in range(4)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    tokens = N.token_table(spark.createDataFrame(rows, "node long, text string"))
    nodes = spark.createDataFrame([(i, i) for i in range(len(texts))], "node long, comp long")
    found = {(p.node, p.centre) for p in N.pairs_of_the_rest(tokens, nodes, 0.8).collect()}
    want = {(i, j) for i in range(len(texts)) for j in range(i)
            if edits(texts[i], texts[j]) <= allowed_edits(len(texts[i]), len(texts[j]), 0.8)}
    assert len(want) > 15 and want <= found and len(found) < len(texts) * (len(texts) - 1) / 4


def test_of_buckets_with_the_same_members_one_is_enough(spark, monkeypatch):
    r = random.Random(4)
    texts = [planted(r, 100, 0.97)[0] for _ in range(20)]
    rows = list(enumerate(texts + [t + " end" for t in texts]))  # a pair shares most of its 48 sketches
    sizes, write = {}, N.written
    monkeypatch.setattr(N, "written", lambda df, name: sizes.setdefault(name, []).append((x := write(df, name)).count()) or x)
    got = check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert {g.class_id for g in got} == set(range(20)) and {g.n_links for g in got} == {1}
    assert sizes["members"] == [40] and sizes["asked"][0] == 20


def test_what_near_dedup_shuffles_is_narrow(spark, monkeypatch):
    plans, write = {}, N.written
    monkeypatch.setattr(N, "written", lambda df, name: plans.setdefault(name, []).append(
        df._jdf.queryExecution().optimizedPlan().toString()) or write(df, name))
    rows = [(0, "a b c d e f"), (1, "a b c d e g"), (2, "a b c d e f")]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    # the sketches meet the distinct texts once
    assert "LeftSemi" in plans["own"][0] and not any("LeftSemi" in p for p in plans["crowded"] + plans["gathered"])
    tokens = N.token_table(spark.createDataFrame([(7, "a b c"), (8, "a")], "node long, text string"))
    assert [(r.node, set(r.asDict())) for r in N.runs(tokens, 2).collect()] == [(7, {"node", "word"})] * 2 + [(8, {"node", "word"})]
    counts = N.run_counts(tokens.withColumn("comp", F.col("node") + 1), 2, 0.8).collect()
    assert sorted(map(tuple, counts)) == [(7, 8, 3, 2, 1), (8, 9, 1, 1, 1)]


def test_marks_leave_out_no_similar_pair(spark):
    r = random.Random(6)
    texts = []
    for n in (1, 4, 5, 9, 30, 60, 200, 700):
        for _ in range(6):
            a = [f"w{r.randrange(3000)}" for _ in range(n)]
            b = list(a)
            for _ in range(r.randrange(n // 4 + 2)):
                at = r.randrange(n)
                b[at:at + 1] = r.choice([[], [f"x{r.randrange(3000)}"], [a[at], f"x{r.randrange(3000)}"]])
                b += ["x"] * (n - len(b)) if r.random() < 0.5 else []
            texts += [a, b]
    tokens = N.token_table(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "node long, text string"))
    every = [(i, j) for i in range(len(texts)) for j in range(i)]
    got = {(p.node, p.centre) for p in N.possible(spark.createDataFrame(every, "node long, centre long"), tokens, 0.8).collect()}
    near = [(i, j) for i, j in every if abs(len(texts[i]) - len(texts[j])) <= allowed_edits(len(texts[i]), len(texts[j]), 0.8)]
    want = {(i, j) for i, j in near if edits(texts[i], texts[j]) <= allowed_edits(len(texts[i]), len(texts[j]), 0.8)}
    assert len(want) > 20 and want <= got and len(got) < len(near) / 4


def test_members_that_cannot_be_similar_do_not_meet(spark, monkeypatch):
    """Texts around a passage share many buckets: the rounds ask none of them, and of small buckets only possible pairs are aligned."""
    r = random.Random(8)
    word = lambda: f"w{r.randrange(5000)}"
    passage = [word() for _ in range(60)]
    texts = [passage + [word() for _ in range(90)] for _ in range(24)]
    near = [[*t[:100], "other", *t[101:]] for t in texts[:6]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts + near)]
    sizes, write = defaultdict(list), N.written
    monkeypatch.setattr(N, "written", lambda df, name: sizes[name].append((x := write(df, name)).count()) or x)
    got = {g.doc_id: (g.class_id, g.n_links) for g in check(spark.createDataFrame(rows, "doc_id long, text string"), rows)}
    assert got == {i: (i % 24, 1 if i % 24 < 6 else 0) for i in range(30)}
    assert sizes["members"][0] > 200 and sum(sizes["asked"]) < sizes["members"][0] / 4
    assert sum(sizes["verified"]) <= 12 and sum(sizes["rest"]) == 0


def test_all_pairs_of_components_of_a_small_bucket_meet(spark):
    r = random.Random(9)
    base = [f"w{r.randrange(3000)}" for _ in range(40)]
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1:]])) for i in range(8)] + [(8, "a b c"), (9, " ".join(base[:20]))]
    tokens = N.token_table(spark.createDataFrame(rows, "node long, text string"))
    comp = {i: i // 2 for i in range(10)}
    placed = spark.createDataFrame([(i, b, c) for b in (1, 2) for i, c in comp.items()], "node long, bucket long, comp long")
    got = sorted((p.node, p.centre) for p in N.pairs_of_small_buckets(placed, tokens, 0.8).collect())
    assert got == sorted((i, j) for i in range(8) for j in range(i) if comp[i] != comp[j])


def test_runs_of_one_component_are_not_chosen(spark, monkeypatch):
    """Near copies of one component share rare runs with a text of another one: those alone are chosen."""
    r = random.Random(10)
    base = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1:]])) for i in range(6)] + [(6, " ".join(["y", *base[1:38], "z", "z"]))]
    rows += [(7 + i, " ".join(f"v{r.randrange(10 ** 6)}" for _ in range(40))) for i in range(3)]
    sizes, write = defaultdict(list), N.written
    monkeypatch.setattr(N, "written", lambda df, name: sizes[name].append((x := write(df, name)).count()) or x)
    comp = {i: 0 if i < 6 else i for i in range(10)}
    texts = N.token_table(spark.createDataFrame(rows, "node long, text string")).join(
        spark.createDataFrame(list(comp.items()), "node long, comp long"), "node")
    pairs = N.joined_by_words(N.rare_words(texts, 2, 0.8), 0.8).collect()
    assert {(p.node, p.centre) for p in pairs} == {(6, i) for i in range(6)}
    words = dict(rows)
    pairs_of = {n: set(zip(words[n].split(), words[n].split()[1:])) for n in words}
    assert sizes["met"] == [len(set().union(*(pairs_of[i] for i in range(6))) & pairs_of[6])]
