"""Toxicity by a linear-chain CRF that tags toxic spans.

Labels are given per document, so tokens are labelled from them: a word
or word beginning that is far more frequent in toxic than in clean
training documents, beyond chance, marks its tokens in
toxic documents.  The chain learns from those tags with word, beginning
and neighbour features, every document is tagged, and the forward-backward
marginals give its score and the offending offsets.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mercato.llm import crf
from mercato.llm.common import arrow_batches, text_of
from mercato.llm.labels import PER_LABEL, fold, labelled_sample, without_copies
from mercato.llm.words import tokens

BEGINNINGS = (4, 5, 6)  # lengths of word beginnings used as features
SEED_RATIO = 5.0        # times as frequent in toxic documents as in clean ones, for a feature that labels tokens
LEAST_DOCS = 3          # training documents a feature must occur in
SPAN_P = 0.5            # marginal from which a token is an offending span
THRESHOLD = 0.7
TRAIN_TOKENS = 250_000  # tokens of labelled sequences the chain learns from: documents in order until they hold so many


def bare(token: str) -> str:
    """The token in lower case without marks at its ends."""
    a, b = 0, len(token)
    while a < b and not token[a].isalnum():
        a += 1
    while b > a and not token[b - 1].isalnum():
        b -= 1
    return token[a:b].lower()


def features_of(token: str) -> list[str]:
    w = bare(token)
    return ["=" + w] + [f"{n}{w[:n]}" for n in BEGINNINGS if len(w) >= n] if w else []


@dataclass
class Tagger:
    """Weights by feature: (own, previous, next); chain and calibration."""
    own: dict[str, float]
    before: dict[str, float]
    after: dict[str, float]
    bias: float
    trans: np.ndarray
    calibration: np.ndarray

    def emissions(self, words: list[str], codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        n = len(words)
        own, before, after = np.full(n, self.bias), np.zeros(n), np.zeros(n)
        for i, t in enumerate(words):
            fs = features_of(t)
            if fs:
                own[i] += sum(self.own.get(f, 0.0) for f in fs)
                before[i], after[i] = self.before.get(fs[0], 0.0), self.after.get(fs[0], 0.0)
        return chain_scores(own, before, after, codes, starts)

    def tag(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        words, codes, offsets = tokens(texts)
        starts = start_flags(offsets, len(codes))
        p, _ = crf.marginals(self.emissions(words, codes, starts), starts, self.trans)
        return words, codes, offsets, p

    def scores(self, p: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return crf.sigmoid(np.column_stack([document_features(p, offsets), np.ones(len(offsets) - 1)]) @ self.calibration)


def start_flags(offsets: np.ndarray, n: int) -> np.ndarray:
    flags = np.zeros(n + 1, bool)
    flags[offsets[:-1]] = True  # an empty text flags the next one's first token, which is flagged anyway
    return flags[:n]


def chain_scores(own, before, after, codes, starts) -> np.ndarray:
    """Emission of every token from the scores of its own word and of the words beside it."""
    e = own[codes]
    if len(codes) > 1:
        inner = ~starts[1:]
        e[1:] += before[codes[:-1]] * inner
        e[:-1] += after[codes[1:]] * inner
    return e


def document_features(p: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Log-odds of the worst token and log of the expected number of toxic tokens; an empty text has the least of both."""
    n = len(offsets) - 1
    out = np.full((n, 2), -12.0)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        p = np.clip(p, 6e-6, 1 - 6e-6)
        worst = np.maximum.reduceat(p, offsets[full])
        total = np.add.reduceat(np.where(p > 0.01, p, 0.0), offsets[full])
        out[full, 0], out[full, 1] = np.log(worst / (1 - worst)), np.log(total + 6e-6)
    return out


def learn(texts: list[str], labels: list[int]) -> Tagger | None:
    """A tagger from labelled texts; None when a label is missing."""
    texts, labels = without_copies(texts, labels)
    y = np.array(labels)
    if not len(y) or y.min() == y.max():
        return None
    words, codes, offsets = tokens(pa.array(texts, pa.large_string()))
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    by_word = [features_of(t) for t in words]
    # document frequency of every feature under either label
    pairs = np.unique(doc * len(words) + codes) if len(codes) else np.empty(0, np.int64)
    held: list[set] = [set() for _ in texts]
    for d, c in zip((pairs // max(1, len(words))).tolist(), (pairs % max(1, len(words))).tolist()):
        held[d].update(by_word[c])
    count = (Counter(), Counter())
    for d, fs in enumerate(held):
        count[labels[d]].update(fs)
    totals = [float((y == k).sum()) for k in (0, 1)]

    share, several = totals[1] / sum(totals), np.log(10.0 * max(1, len(count[1])))

    def marks_toxic(f: str) -> bool:
        """More frequent in toxic documents by SEED_RATIO, and beyond chance among all features (Chernoff's bound)."""
        c0, c1 = count[0][f], count[1][f]
        if (c1 + 0.5) / (totals[1] + 1) < SEED_RATIO * (c0 + 0.5) / (totals[0] + 1):
            return False
        x = c1 / (c0 + c1)
        return (c0 + c1) * (x * np.log(x / share) + (c0 and (1 - x) * np.log((1 - x) / (1 - share)))) >= several

    seeds = {f for f in count[1] if marks_toxic(f)}
    marked = np.array([any(f in seeds for f in fs) for fs in by_word], bool)
    tag = (marked[codes] & (y[doc] == 1)).astype(np.int64)
    has = np.zeros(len(texts), bool)
    has[doc[tag == 1]] = True
    fit_docs = (y == 0) | has  # a toxic document without a marked token says nothing about its tokens
    length = np.diff(offsets)
    mixed = np.argsort([zlib.crc32(t.encode("utf-8", "replace")) for t in texts], kind="stable")
    for k in (0, 1):  # half of the tokens from either label, whole documents, in the order of a hash of the text
        mine = mixed[(fit_docs & (y == k))[mixed]]
        fit_docs[mine[1:][np.cumsum(length[mine])[:-1] >= TRAIN_TOKENS // 2]] = False
    use = fit_docs[doc]
    both = count[0] + count[1]
    names = sorted(f for f, n in both.items() if n >= LEAST_DOCS)
    index = {f: i for i, f in enumerate(names)}
    k, none = 1 + len(BEGINNINGS), len(names)
    table = np.full((len(words), k), none, np.int64)
    for i, fs in enumerate(by_word):
        for j, f in enumerate(fs):
            table[i, j] = index.get(f, none)
    sel = np.flatnonzero(use)
    cs, starts = codes[sel], start_flags(np.concatenate([[0], np.cumsum(np.bincount(doc[sel], minlength=len(texts)))]), len(sel))
    size, v = len(names) + 1, len(words)

    def parts(w):
        own = w[:size].copy()
        own[none] = 0.0
        side = [np.append(w[size + s * none:size + (s + 1) * none], 0.0)[table[:, 0]] for s in (0, 1)]
        return own[table].sum(axis=1) + w[none], *side

    def score(w):
        return chain_scores(*parts(w), cs, starts)

    def back(r):
        g = np.zeros(size + 2 * none)
        by = np.bincount(cs, r, v)
        g[:size] = np.bincount(table.ravel(), np.repeat(by, k), size)
        g[none] = r.sum()
        if len(cs) > 1:
            inner = ~starts[1:]
            g[size:size + none] = np.bincount(table[cs[:-1], 0], r[1:] * inner, size)[:none]
            g[size + none:] = np.bincount(table[cs[1:], 0], r[:-1] * inner, size)[:none]
        return g

    w, trans = crf.fit(score, back, size + 2 * none, tag[sel], starts, steps=60, rate=0.3, l2=2e-6)
    some = lambda x: {f: float(x[i]) for f, i in index.items() if abs(x[i]) > 1e-3}
    model = Tagger(some(w[:none]), some(w[size:size + none]), some(w[size + none:]), float(w[none]), trans, np.zeros(3))
    p, _ = crf.marginals(model.emissions(words, codes, start_flags(offsets, len(codes))),
                         start_flags(offsets, len(codes)), trans)
    model.calibration = crf.logistic(document_features(p, offsets), y)
    return model


def score_toxicity(docs: DataFrame, model: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, spans) of every row; spans are (start, end, p) in code points, end exclusive.

    A null text counts as empty; an empty text has no span and the score of
    a document without a suspicious token.  Without a model (no rows of one
    label to learn from) every score is 0.5.  Rows are scored one by one, so
    repeated rows and null ids need no care; an empty table gives an empty
    result; other columns are ignored.
    """
    arrow_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def spans_of(text: str, words: list[str], p: np.ndarray) -> list[dict]:
        out, at = [], 0
        for w, x in zip(words, p.tolist()):
            at = text.index(w, at)
            if x >= SPAN_P:
                out.append({"start": at, "end": at + len(w), "p": x})
            at += len(w)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            if model is None:
                scores, spans = np.full(len(texts), 0.5), [[]] * len(texts)
            else:
                words, codes, offsets, p = model.tag(texts)
                scores, spans = model.scores(p, offsets), [[] for _ in range(len(texts))]
                hot = np.flatnonzero(p >= SPAN_P)
                for d in np.unique(np.searchsorted(offsets, hot, "right") - 1).tolist():
                    a, e = offsets[d], offsets[d + 1]
                    spans[d] = spans_of(texts[d].as_py(), [words[c] for c in codes[a:e].tolist()], p[a:e])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(scores), pa.array(spans, span_type)],
                                             names=["id", "score", "spans"])

    id_type = base.schema["id"].dataType.simpleString()
    out = base.mapInArrow(run, f"id {id_type}, score double, spans array<struct<start:long,end:long,p:double>>")
    return out.withColumnRenamed("id", id_col)


def toxicity(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, per_label: int = PER_LABEL) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold, then score every document."""
    held = fold("doc_id", 3) == 1
    model = learn(*labelled_sample(docs, labels, "toxic", fold("__id", 3) != 1 if may_learn is None else may_learn,
                                   per_label=per_label))
    return score_toxicity(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "spans")
