"""Held-out folds and bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from mercato.llm.common import hash_sample, text_of

PER_LABEL = 1000       # labelled rows of each label a classifier learns from, at most
LONGEST_CHARS = 50000  # longest text that may be in the sample


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, may_learn: Column, id_col: str = "doc_id",
                    text_col: str = "text", per_label: int = PER_LABEL) -> tuple[list[str], list[int]]:
    """Texts and labels to learn from: of each label the ``per_label`` rows with the smallest hash of the id.

    ``may_learn`` (over the labels table) says which rows may be used.  The
    label sample is bounded, so it is broadcast against the documents; of an
    id that documents repeat one text is taken (by hash), so the texts that
    come to the driver are bounded in number and length.
    """
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")).filter(
        F.col("__y").isin(0, 1) & F.col("__id").isNotNull())
    known = known.filter(may_learn)
    parts = [hash_sample(known.filter(F.col("__y") == y), per_label, F.xxhash64("__id")) for y in (0, 1)]
    texts = docs.select(F.col(id_col).alias("__doc"), text_of(text_col).alias("__text")).filter(
        F.length("__text") <= LONGEST_CHARS)
    rows = (texts.join(F.broadcast(parts[0].union(parts[1])), F.col("__doc") == F.col("__id"))
            .groupBy("__id", "__y").agg(F.min_by("__text", F.struct(F.xxhash64("__text"), "__text")).alias("__text")).collect())
    rows.sort(key=lambda r: (r["__id"], r["__y"], r["__text"]))
    return [r["__text"] for r in rows], [r["__y"] for r in rows]


def without_copies(texts: list[str], labels: list[int], hashes: int = 6) -> tuple[list[str], list[int]]:
    """Drop texts that look like copies of an earlier one, so that a copied text counts once.

    Two texts look like copies when two of their smallest hashed three-word
    shingles (under seeded hashes) agree.
    """
    seen: set[tuple[int, int, int]] = set()
    out_texts, out_labels = [], []
    for text, y in zip(texts, labels):
        words = text.split()
        base = np.array([zlib.crc32(" ".join(words[i:i + 3]).encode("utf-8", "replace"))
                         for i in range(max(1, len(words) - 2))], np.uint32)
        least = [int((base * np.uint32((2 * k + 3) * 0x9E3779B1 & 0xFFFFFFFF)).min()) for k in range(hashes)]
        marks = {(a, least[a], least[a + 1]) for a in range(hashes - 1)}
        if not marks & seen:
            out_texts.append(text)
            out_labels.append(y)
        seen |= marks
    return out_texts, out_labels
