import hashlib
import re

from edge import edge_texts
from hypothesis import given, settings, strategies as st

from mercato.llm import secrets as S
from mercato.llm.secrets import base_spans, find_secrets


def spec(text):
    """The three kinds by their plain patterns, failing matches dropped afterwards."""
    letters = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    words = "|".join(map(letters, ("password", "passwd", "secret", "token"))) + "|[aA][pP][iI]_?[kK][eE][yY]"
    out = [(m.start(), 0, m.end()) for m in
           re.finditer(rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


PIECES = st.sampled_from(["password", "PassWd", "SECRET", "toKen", "token", "api_key", "apiKey", "ſecret", "=", ":", " ", '"', "'",
                          "AKIA", "ABCD1234", "0123456789abcdef", "İ", "é", "xyz", "abcdefgh", "A1b2C3d4", "\n", "-", "=="])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    assert [s[:3] for s in base_spans(text)] == spec(text)


def test_edges(edges):
    got = find_secrets(edges).collect()
    assert len(got) == len(edge_texts())
    want = {}
    for t in edge_texts():
        spans = spec(t[1] or "")
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans)
        want.setdefault(t[0], (sum(k == 0 for _, k, _ in spans), sum(k == 1 for _, k, _ in spans),
                               sum(k == 2 for _, k, _ in spans), hashlib.sha256(text.encode()).hexdigest(), text))
    for r in got:
        w = want[r.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == w[:4]
        assert [s for s in r.spans.split(",") if not s.startswith("owned")] == w[4].split(",")
    assert find_secrets(edges.limit(0)).collect() == []


def test_ownership_tells_copied_examples_from_live_values(spark):
    token, example = "Zk3xQ9vLmT7wRb2YpN5sHd8c", "Ex4mpleT0kenCop1edEverywhere9"
    rows = [(1, f"use {token} now", "a", "x"), (2, f"password={'p4ssw0rdp4ss'} {token}", "a", "y")]
    rows += [(10 + i, f"see {example} password=changeme123", f"s{i}", "x") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r for r in find_secrets(df).collect()}
    assert got[1].spans == f"owned:4:{4 + len(token)}" and (got[1].n_live, got[1].n_copied) == (1, 0)
    assert got[2].spans == f"assign:0:21,owned:22:{22 + len(token)}" and got[2].n_live == 2
    assert got[10].spans.startswith("assign") and "owned" not in got[10].spans
    assert (got[10].n_live, got[10].n_copied) == (0, 1)


def test_a_value_in_many_repositories_of_one_owner_is_copied(spark):
    token, two = "Zk3xQ9vLmT7wRb2YpN5sHd8c", "Qm8vT2xWnB5kLr7YcJ4pZs9d"
    rows = [(i, f"use {token} password=changeme123", "a", f"l{i}") for i in range(4)]
    rows += [(10 + i, f"use {two}", "b", f"l{i % 2}") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r for r in find_secrets(df).collect()}
    for i in range(4):
        assert got[i].spans == "assign:29:49" and (got[i].n_live, got[i].n_copied) == (0, 1)
        assert (got[i].span_owners, got[i].span_repositories) == ([1], [4])
    for i in range(6):  # many documents of two repositories
        assert got[10 + i].spans == "owned:4:28" and (got[10 + i].n_live, got[10 + i].n_copied) == (1, 0)
        assert (got[10 + i].span_owners, got[10 + i].span_repositories) == ([1], [2])
    live = find_secrets(df, max_repositories=4).filter("doc_id = 0").first()
    assert (live.n_live, live.span_repositories) == (2, [4, 4])


def test_tokens_outside_spans_as_by_comparing_all_pairs():
    import random
    r = random.Random(6)
    parts = ["password: hunter2hunter2", "AKIA" + "B7" * 9, "0f" * 20, "xY7-kk3_Zq9pLm2Vt8Wn4", "token=abc", "plain words", "a" * 30,
             "secret='Zq9pLm2Vt8Wn4xY7kk3'", "Q1w2E3r4T5y6U7i8O9p0"]
    for _ in range(300):
        text = "".join(r.choice(parts) + r.choice([" ", "", "\n", ", "]) for _ in range(r.randint(1, 12)))
        base = S.base_spans(text)
        want = [(m.start(), 3, m.end(), m[0]) for m in S.TOKEN.finditer(text)
                if any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0]) and S.entropy(m[0]) >= S.MIN_ENTROPY
                and not any(s < m.end() and m.start() < e for s, _, e, _ in base)]
        assert S.random_tokens(text, base) == want


def test_a_long_text_of_secrets_takes_seconds():
    import time
    text = "".join(f"password = hunter{i}hunter{i} and Zq9pLm2Vt8Wn4xY7k{i}\n" for i in range(200_000))
    assert len(text) > 10_000_000
    began = time.perf_counter()
    base = S.base_spans(text)
    found = S.random_tokens(text, base)
    assert len(base) == 200_000 and len(found) == 199_900 and time.perf_counter() - began < 60
