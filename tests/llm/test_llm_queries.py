"""Registered queries against their SQL, and the shape of those without."""

import pytest
from _compare import rows_of
from edge import duck

import __spark_entry__ as E
from mercato.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_matches_sql(spark, sf_dir, name):
    df = E.queries()[name](spark, sf_dir)
    res = duck(sf_dir).execute(Q.ORACLE_SQL[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in res.description], res.fetchall())


def test_all_operators_and_the_pipeline_are_registered():
    names = E.queries()
    assert {n.split("_")[0] for n in Q.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(Q.QUERIES) | {"pipeline"} <= set(names)


CONTRACT = {
    "op1_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op2_mix_sources": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op3_top_k_search": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op4_warc_archives": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string",
                          "refers_to": "bigint"},
    "op6_secret_scan": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint",
                        "base_sha256": "string", "spans": "string"},
    "op7_bpe_round_trip": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op8_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11_lexical_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op12_spelling_variants": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint",
                               "form_n": "bigint"},
    "op13_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint",
                     "sequence_id": "bigint", "offset": "bigint"},
    "op9_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_column_types(spark, sf_dir, name):
    got = dict(E.queries()[name](spark, sf_dir).dtypes)
    assert CONTRACT[name].items() <= got.items()
