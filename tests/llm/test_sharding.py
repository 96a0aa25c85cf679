import hashlib
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash

from mercato.llm import sharding as H


def test_table_is_filled_in_turns():
    names = [f"s{i}" for i in range(7)]
    owner = H.lookup_table(names, 101)
    assert set(owner.tolist()) == set(range(7))
    n = Counter(owner.tolist())
    assert max(n.values()) - min(n.values()) <= 1
    assert (owner == H.lookup_table(names, 101)).all()


def test_few_slots_move_when_a_shard_leaves():
    names = [f"s{i}" for i in range(20)]
    a, b = H.lookup_table(names, 65537), H.lookup_table(names[:-1], 65537)
    stayed = a != 19
    assert (a[stayed] != b[stayed]).mean() < 0.05


def test_bad_tables_are_refused():
    for names, size in ((["a"], 100), (["a", "a"], 101), ([], 101), ([str(i) for i in range(200)], 101), (["a"], 2 ** 31 - 1)):
        with pytest.raises(ValueError):
            H.lookup_table(names, size)


def test_placement(edges, tmp_path):
    names = [f"s{i}" for i in range(5)]
    owner = H.lookup_table(names, 101)
    got = H.place(edges, ["doc_id"], names, 101, slot_col="block", shard_col="key").collect()
    assert len(got) == edges.count()
    assert all(names[owner[r.block]] == r.key and 0 <= r.block < 101 for r in got)
    assert len({r.key for r in got if r.doc_id is None}) == 1
    assert H.place(edges.limit(0), ["doc_id"], names, 101).collect() == []
    H.write_shards(H.place(edges, ["doc_id"], names, 101), str(tmp_path / "out"))
    assert edges.sparkSession.read.parquet(str(tmp_path / "out")).count() == len(got)


def test_documents_spread_evenly(documents):
    n = Counter(r.shard for r in H.place(documents, ["doc_id"], [f"s{i}" for i in range(4)]).collect())
    assert len(n) == 4 and max(n.values()) < 2 * np.mean(list(n.values()))


def brute_table(names, size):
    """Whole preference lists; in each round every shard takes the first slot of its list that nobody has."""
    def number(name, part):
        return int(hashlib.sha256(name.encode()).hexdigest()[16 * part:16 * part + 16], 16)

    lists = {n: [(number(n, 0) % size + j * (number(n, 1) % (size - 1) + 1)) % size for j in range(size)] for n in names}
    assert all(sorted(order) == list(range(size)) for order in lists.values())
    taken = {}
    while len(taken) < size:
        for n in names:
            free = [slot for slot in lists[n] if slot not in taken]
            if free:
                taken[free[0]] = n
    return taken


@pytest.mark.parametrize("n, size", [(1, 7), (3, 3), (5, 101), (12, 211)])
def test_claims_as_by_whole_preference_lists(n, size):
    names = [f"shard {i}" for i in range(n)]
    want = brute_table(names, size)
    assert [names[o] for o in H.lookup_table(names, size)] == [want[i] for i in range(size)]


def test_rows_as_by_brute_force(spark, documents):
    names = [f"s{i}" for i in range(6)]
    want = brute_table(names, 101)
    docs = documents.select("doc_id").union(spark.createDataFrame([(None,), (-7,), (2 ** 62,)], "doc_id long"))
    got = H.place(docs, ["doc_id"], names, 101).collect()
    assert len(got) == docs.count()
    for r in got:
        h = 42 if r.doc_id is None else xxhash.xxh64_intdigest(struct.pack("<q", r.doc_id), seed=42)
        h -= (h >> 63) << 64  # signed
        assert r.slot == h % 101 and r.shard == want[r.slot]


def test_names_used_inside_are_free(spark):
    docs = spark.createDataFrame([(1, "a", "b", "c", "d")], "doc_id long, __at string, __slot string, __shard string, row string")
    r = H.place(docs, ["doc_id"], ["s0", "s1"], 101).first()
    assert (r["__at"], r["__slot"], r["__shard"], r.row) == ("a", "b", "c", "d") and r.shard in ("s0", "s1")


def test_many_shards_in_the_largest_table():
    names = [f"s{i}" for i in range(10_000)]
    n = Counter(H.lookup_table(names, 65537).tolist())
    assert len(n) == 10_000 and max(n.values()) - min(n.values()) <= 1
