import hashlib
import re
from collections import defaultdict

import pytest
from edge import edge_texts

from mercato.llm.mixing import mix, mixed


def brute(rows, weights=(5, 2, 1), passes=3):
    """(id, source, size) rows -> target by source and taken copies by row, one queue over all sources."""
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, capped = sum(sizes.values()), {}
    while True:  # share by weight; sources above their cap stop there
        rest = [s for s in order if s not in capped]
        level = (budget - sum(capped.values())) / sum(weight[s] for s in rest) if rest else 0
        over = [s for s in rest if level * weight[s] >= passes * sizes[s]]
        if not over:
            break
        capped |= {s: passes * sizes[s] for s in over}
    target = {s: capped.get(s, level * weight[s]) for s in order}
    queue = []
    for s in order:
        mine = sorted((hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest(), i is not None, i or 0, n, k)
                      for k, (i, src, n) in enumerate(rows) if src == s)
        upto = 0
        for h, _, _, n, k in mine:
            upto += n
            queue += [((p * sizes[s] + upto) / target[s], s is None, s or "", h, p, k, n) for p in range(passes) if n]
    taken, total = defaultdict(int), 0
    for *_, k, n in sorted(queue):
        if total + n > budget:
            break
        total += n
        taken[k] += 1
    return target, taken, budget


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("weights", [(5, 2, 1), (1,), (100, 1)])
def test_edges(edges, weights):
    rows = [(t[0], t[3], size(t[1])) for t in edge_texts()]
    target, taken, budget = brute(rows, weights)
    got = mix(edges, weights=weights).collect()
    assert len(got) == len(rows)
    assert sum(r.taken for r in got) <= budget
    for r in got:
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r["size"]
    key = lambda i, s, n, c: (str(i), str(s), n, c)
    assert sorted(key(r.doc_id, r.source, r["size"], r.copies) for r in got) == sorted(
        key(*rows[k], taken[k]) for k in range(len(rows)))


def test_sources_come_near_their_targets(documents):
    got = mix(documents).toPandas()
    longest = got.groupby("source")["size"].max()
    sums, targets = got.groupby("source")["taken"].sum(), got.groupby("source")["target"].first()
    assert ((sums - targets).abs() <= 2 * longest.max()).all()
    assert sums.sum() <= got["size"].sum() and sums.sum() > got["size"].sum() - longest.max()


def test_empty_table_and_no_words(spark, edges):
    assert mix(edges.limit(0)).collect() == []
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["size"], r.taken) for r in mix(blank).collect()] == [(0, 0), (0, 0)]


def test_mixed_stream_is_in_order_of_finish(documents):
    decisions = mix(documents)
    rows = mixed(documents, decisions).select("doc_id", "finish").collect()
    assert [r.finish for r in rows] == sorted(r.finish for r in rows)
    assert len(rows) == sum(r.copies for r in decisions.collect())
