"""Quality classifier: a linear-chain CRF labels every line good or bad.

Lines are described by character and token statistics of themselves and of
the lines beside them.  Training lines take the label of their document.
The forward-backward marginals of a document's lines, weighted by length,
give its quality, which is calibrated on the training documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from mercato.llm import crf
from mercato.llm.common import arrow_batches, text_of
from mercato.llm.labels import PER_LABEL, fold, labelled_sample

THRESHOLD = 0.3
SYMBOLS = b"$%&*#|@^~<>{}[]\\/_=+"
MARKS = b".,;:'\"?()-"
CLASSES = 6  # upper, lower, digit, symbol, exclamation, other mark


def _classes() -> np.ndarray:
    """Character class of every byte; 255 for none."""
    t = np.full(256, 255, np.uint8)
    t[ord("A"):ord("Z") + 1], t[ord("a"):ord("z") + 1], t[ord("0"):ord("9") + 1] = 0, 1, 2
    t[list(SYMBOLS)], t[ord("!")], t[list(MARKS)] = 3, 4, 5
    return t


CLASS = _classes()


def _buffers(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, bytes) of a large string array."""
    if not len(a):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    _, off, data = a.buffers()
    offsets = np.frombuffer(off, np.int64)[a.offset:a.offset + len(a) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0]:offsets[-1]]


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (c[offsets[1:]] - c[offsets[:-1]]).astype(float)


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line, its length in bytes, line offsets of the texts); a text has one line at least."""
    parts = pc.split_pattern(texts.cast(pa.large_string()), "\n")
    upto = np.asarray(parts.offsets).astype(np.int64)
    lines = parts.flatten()
    at, raw = _buffers(lines)
    kind = CLASS[raw]
    size = np.diff(at).astype(float)
    count = [_sums(kind == k, at) for k in range(CLASSES)]
    # capitals of the Latin-1 letters are the byte C3 and a byte 80-9E; their small forms A0-BE
    wide = np.concatenate([[False], (raw[:-1] == 0xC3)]) if len(raw) else np.empty(0, bool)
    upper = count[0] + _sums(wide & (raw >= 0x80) & (raw <= 0x9E), at)
    lower = count[1] + _sums(wide & (raw >= 0xA0), at)
    tokens = pc.utf8_split_whitespace(lines)
    token_upto = np.asarray(tokens.offsets).astype(np.int64)
    token_upto = token_upto - token_upto[0]
    flat = tokens.flatten()
    t_at, t_raw = _buffers(flat)
    t_size = np.diff(t_at)
    n = np.maximum(1.0, _sums(t_size > 0, token_upto))
    last = np.zeros(len(flat), np.uint8)
    before = np.zeros(len(flat), np.uint8)
    two = t_size >= 2
    if two.any():
        ends = t_at[1:][two]
        last[two], before[two] = t_raw[ends - 1], t_raw[ends - 2]
    doubled = two & (last == before) & np.isin(CLASS[last], (3, 4, 5))
    lone = (t_size == 1) & (CLASS[t_raw[np.minimum(t_at[:-1], max(0, len(t_raw) - 1))]] == 3) if len(t_raw) else t_size < 0
    codes = np.asarray(flat.dictionary_encode().indices) if len(flat) else np.empty(0, np.int64)
    same = np.concatenate([[False], codes[1:] == codes[:-1]]) & (t_size > 0) if len(flat) else np.empty(0, bool)
    if len(flat):
        first = token_upto[:-1][np.diff(token_upto) > 0]
        same[first] = False
    letters = np.maximum(1.0, upper + lower)
    chars = np.maximum(1.0, size)
    x = np.column_stack([
        np.log1p(size), np.log1p(n), upper / letters, count[2] / chars, count[3] / chars, count[4] / chars,
        count[5] / chars, np.minimum(1, _sums(doubled, token_upto) / n), np.minimum(1, _sums(lone, token_upto) / n),
        np.minimum(1, _sums(same, token_upto) / n), np.minimum(40.0, chars / n), (size == 0).astype(float)])
    return x, size, upto - upto[0]


def start_flags(offsets: np.ndarray, n: int) -> np.ndarray:
    flags = np.zeros(n, bool)
    flags[offsets[:-1]] = True
    return flags


def with_neighbours(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A line's features, then those of the line before and the line after (zero at the ends), then 1."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    inner = np.flatnonzero(~starts)
    before[inner], after[inner - 1] = x[inner - 1], x[inner]
    return np.column_stack([x, before, after, np.ones(len(x))])


@dataclass
class Grader:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    trans: np.ndarray
    calibration: np.ndarray

    def raw(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(good) of every line, the line offsets, and the length-weighted mean of every document."""
        x, size, upto = line_features(texts)
        starts = start_flags(upto, len(x))
        p, _ = crf.marginals(with_neighbours((x - self.mean) / self.scale, starts) @ self.weights, starts, self.trans)
        weight = size + 1
        c = lambda v: np.add.reduceat(v, upto[:-1]) if len(v) else np.empty(0)
        return p, upto, c(p * weight) / c(weight)

    def score(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.empty(0)
        return crf.sigmoid(self.calibration[0] * _logit(self.raw(texts)[2]) + self.calibration[1])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def learn(texts: list[str], labels: list[int]) -> Grader | None:
    """A grader from labelled texts; None when a label is missing."""
    y = np.array(labels)
    if not len(y) or y.min() == y.max():
        return None
    x, _, upto = line_features(pa.array(texts, pa.large_string()))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    starts = start_flags(upto, len(x))
    design = with_neighbours((x - mean) / scale, starts)
    weights, trans = crf.fit(lambda w: design @ w, lambda r: design.T @ r, design.shape[1],
                             np.repeat(y, np.diff(upto)), starts, l2=1e-3)
    model = Grader(mean, scale, weights, trans, np.array([1.0, 0.0]))
    model.calibration = crf.logistic(_logit(model.raw(pa.array(texts, pa.large_string()))[2])[:, None], y)
    return model


def score_quality(docs: DataFrame, model: Grader | None, id_col: str = "doc_id", text_col: str = "text",
                  score_col: str = "score", keep_columns: bool = False) -> DataFrame:
    """(id, score) of every row, or all columns and the score.

    A null text counts as empty, and an empty text is one empty line.
    Without a model (no rows of one label to learn from) every score is 0.5.
    Rows are scored one by one, so repeated rows and null ids need no care;
    an empty table gives an empty result.  With ``keep_columns`` a column
    named like ``score_col`` is replaced.
    """
    arrow_batches(docs.sparkSession)
    names = [c for c in docs.columns if c != score_col] if keep_columns else [id_col]
    base = docs.select(*[F.col(f"`{c}`") for c in names], text_of(text_col).alias("__text"))
    schema = T.StructType([*base.schema.fields[:-1], T.StructField(score_col, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1)
            scores = np.full(len(texts), 0.5) if model is None else model.score(texts)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64())], names=[*names, score_col])

    return base.mapInArrow(run, schema)


def quality_model(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None,
                  per_label: int = PER_LABEL) -> Grader | None:
    """Learn from the labelled rows outside the held-out fold."""
    return learn(*labelled_sample(docs, labels, "quality", fold("__id", 5) != 0 if may_learn is None else may_learn,
                                  per_label=per_label))


def quality(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None) -> DataFrame:
    """Score every document: doc_id, held_out, score, predicted (1: good)."""
    return score_quality(docs, quality_model(docs, labels, may_learn)).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
