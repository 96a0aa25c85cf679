"""Corpus pipeline: quality filter, exact dedup, near dedup, source mix, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet and hands what it reads back to the next stage.  All
stages but the last return the columns of the documents table.  Decisions
are matched to rows by a key of id and text, so null and repeated ids are
safe; rows that repeat both are one document from the exact dedup on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mercato.llm.bpe import encode
from mercato.llm.common import table, text_of, written
from mercato.llm.exact_dedup import exact_dedup
from mercato.llm.mixing import mix
from mercato.llm.near_dedup import near_dedup
from mercato.llm.quality import THRESHOLD, quality_model, score_quality

def _free(docs: DataFrame, name: str) -> str:
    """``name``, longer by underscores as long as ``docs`` has such a column."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _key(digest: Column) -> Column:
    """A row's id and text digest as one key without nulls."""
    return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), digest)


def _keyed(docs: DataFrame, key: str) -> DataFrame:
    return docs.withColumn(key, _key(F.sha2(text_of("text"), 256)))


def _kept(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``decisions`` keep, each once."""
    key = _free(docs, "__key")
    keys = decisions.filter("kept").select(_key(F.col("text_sha256")).alias(key))
    return _keyed(docs, key).join(keys, key).dropDuplicates([key]).select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; a document without a verdict (no labels at all) stays.

    Null texts count as empty and are judged like any; repeated rows and ids,
    texts of any length and columns of any name pass through; an empty table stays empty."""
    score = _free(docs, "__quality")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    scored = score_quality(docs, model, score_col=score, keep_columns=True)
    return scored.filter(F.col(score) >= THRESHOLD).select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each distinct text: the one with the largest id.  Null texts
    equal empty ones; rows that repeat id and text are one; an empty table stays empty."""
    return _kept(docs, exact_dedup(docs))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies: the one with the smallest id.  Rows
    that repeat id and text are one; an empty table stays empty."""
    return _kept(docs, near_dedup(docs))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or up to three
    times.  Texts without words are not taken; a null source is a source; an empty table stays empty."""
    key, copies, copy = (_free(docs, c) for c in ("__key", "__copies", "__copy"))
    keyed = _keyed(docs, key)
    taken = mix(keyed, carry=(key,)).groupBy(key).agg(F.sum("copies").cast("int").alias(copies))
    out = keyed.dropDuplicates([key]).join(taken.filter(F.col(copies) > 0), key)
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and decoded text."""
    return encode(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mix_sources", mix_stage),
    ("bpe", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over the documents table; every stage is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# Stages 1, 3 and 5 (classifier, alignment, tokenizer) are beyond SQL; tests/llm has the brute-force versions.
ORACLE_SQL = None
