"""Spelling variants: words one edit apart, found by a scan of sorted lists.

A list of words is sorted, so words with a common beginning stand together
and the longest common prefixes (LCPs) of neighbours say how far a row of
the edit matrix can be reused: a row belongs to a prefix and serves every
word of the range that shares it.  Rows are banded to the diagonal and one
cell to either side.  A range is left as soon as all cells of its row
exceed one edit.  All queries of a block walk the ranges together, one
prefix length at a time, in arrays.

Which words meet in a list is decided by where the edit can be.  Of two
words one edit apart, let m be the length of the shorter one: the edit
falls into the first or into the second half of m, and the other half is
common to both.  So each word is dealt four times (as the shorter and as
the longer word, by either half); a list whose words share their end is
sorted from the end.  A list that holds more than ``most`` words is dealt
again by the halves of its half, and so on to single positions, where a
list is bounded by the alphabet: no list grows with the vocabulary and no
pair is lost.  A pair is counted in the one list whose window holds the
first position at which its words differ.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from mercato.llm.common import arrow_batches, text_of, written

NOISE = 97
MIN_LENGTH, MIN_COUNT = 5, 3
FLUSH = 1 << 18     # distinct words a task holds before it hands its counts on
LIST_WORDS = 512    # words of a list from which it is dealt again
BLOCK_CELLS = 1 << 20  # characters of the lists that are scanned together

# ASCII letters in lower case and U+00C0..U+00FF stay; all else ends a run.
RUNS = bytes((b + 32 if 65 <= b <= 90 else b) if 65 <= b <= 90 or 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs_of(text: str) -> list[bytes]:
    """Lower-cased letter runs in Latin-1; characters beyond it become '?', which ends a run."""
    return text.encode("latin-1", "replace").translate(RUNS).split(b" ")


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): distinct words of at least five letters that occur three times or more, noise applied."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()),
                                              pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for b in batches:
            for id_, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
                salt = zlib.crc32(f"{id_}:".encode())
                # equal runs of a document have equal hashes, so they change together
                for w, c in Counter(runs_of(text)).items():
                    if len(w) < MIN_LENGTH:
                        continue  # none gets longer
                    h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), salt)
                    if h % NOISE == 0:
                        k = h % len(w)
                        w = w[:k] + w[k + 1:]
                        if len(w) < MIN_LENGTH:
                            continue
                    held[w] += c
                if len(held) >= FLUSH:
                    yield flush()
        yield flush()

    base = docs.select(text_of(id_col).alias("id"), text_of(text_col).alias("text"))
    return (base.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= MIN_COUNT))


def lists(words: DataFrame, most: int = LIST_WORDS) -> DataFrame:
    """(word, n, m, lo, hi, list): the lists of all words, those with a single word left out."""
    m = F.explode(F.array(F.length("word"), F.length("word") - 1))
    rows = (words.select("word", "n", m.alias("m")).filter(F.col("m") >= MIN_LENGTH)
            .withColumns({"lo": F.lit(0), "hi": F.col("m")}))
    done = None
    while True:
        mid = F.expr("lo + (hi - lo) div 2")
        halves = F.array(F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi").alias("hi")))
        # the common letters are those before lo and, counted from the end, those after hi
        common = F.xxhash64("m", "lo", "hi", F.expr("left(word, lo)"), F.expr("right(word, m - hi)"))
        rows = (rows.select("word", "n", "m", F.explode(halves).alias("w")).select("word", "n", "m", "w.lo", "w.hi")
                .filter("lo < hi").withColumn("list", common))
        rows = written(rows, "variants")
        size = (rows.groupBy("list").agg(F.count("*").alias("size"), F.max(F.col("hi") - F.col("lo")).alias("width"),
                                         F.bool_or(F.length("word") == F.col("m")).alias("asked"))
                .filter("asked AND size > 1").drop("asked"))
        sized = rows.join(size, "list")
        large = (F.col("size") > most) & (F.col("width") > 1)
        small = sized.filter(~large).drop("size", "width")
        done = small if done is None else done.unionByName(small)
        if size.filter(large).isEmpty():
            return done
        rows = sized.filter(large).drop("size", "width", "list")


def near_in_block(words: list[str], n: np.ndarray, m: np.ndarray, lo: np.ndarray, hi: np.ndarray,
                  group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) of rows one edit apart, both ways round, of lists numbered by ``group``.

    Only pairs whose first difference falls into the list's window [lo, hi).
    """
    count, size = len(words), np.fromiter(map(len, words), np.int64, len(words))
    width = int(size.max()) + 1
    latin = [w.encode("latin-1") for w in words]
    forward = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in latin), np.uint8).reshape(count, width)
    # lists with a common end (window at the beginning) are read from the end
    back = (lo == 0) & (hi < m)
    text = forward.copy()
    for i in np.flatnonzero(back).tolist():
        text[i, :size[i]] = forward[i, :size[i]][::-1]
    order = np.lexsort((np.ascontiguousarray(text).view(f"S{width}").ravel(), group))
    text, forward, size, group, m, lo, hi = text[order], forward[order], size[order], group[order], m[order], lo[order], hi[order]

    lcp = np.full(count, -1)
    if count > 1:
        differ = text[1:] != text[:-1]
        lcp[1:] = np.where(group[1:] == group[:-1], np.where(differ.any(1), differ.argmax(1), width), -1)
    # query letters with a guard on both sides that equals no letter
    letters = np.full((count, width + 3), 1, np.uint8)
    letters[:, 1:width + 1] = np.where(text == 0, 1, text)

    query = np.flatnonzero(size == m)
    starts = np.flatnonzero(lcp < 0)
    node = np.searchsorted(starts, query, "right") - 1
    # row of the empty prefix: cells of the query's prefixes of -1, 0 and 1 letters
    below, here, above = np.full(len(query), 2), np.zeros(len(query), np.int64), np.ones(len(query), np.int64)
    found_q, found_w = [], []
    for depth in range(width):
        nxt = np.flatnonzero(lcp < depth + 1)   # ranges that share depth + 1 letters
        first = np.searchsorted(nxt, starts)
        children = np.append(first[1:], len(nxt))[node] - first[node]
        at = np.repeat(np.arange(len(node)), children)
        child = np.arange(len(at)) - np.repeat(np.cumsum(children) - children, children) + first[node[at]]
        letter, q = text[nxt[child], depth], query[at]
        ends = letter == 0
        if ends.any():
            # a word of this many letters: the cell of the whole query is its distance
            cell = size[q] - depth
            value = np.select([cell == -1, cell == 0, cell == 1], [below[at], here[at], above[at]], 2)
            hit = ends & (value == 1)
            found_q.append(q[hit])
            found_w.append(nxt[child[hit]])
        on = ~ends
        at, child, letter, q = at[on], child[on], letter[on], q[on]
        if not len(q):
            break
        b0 = np.minimum(below[at] + (letters[q, depth] != letter), here[at] + 1)
        b1 = np.minimum(np.minimum(here[at] + (letters[q, depth + 1] != letter), above[at] + 1), b0 + 1)
        b2 = np.minimum(above[at] + (letters[q, depth + 2] != letter), b1 + 1)
        keep = np.minimum(np.minimum(b0, b1), b2) <= 1
        query, node, below, here, above = q[keep], child[keep], b0[keep], b1[keep], b2[keep]
        starts = nxt
        if not len(query):
            break
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (found_q, found_w))
    if len(a):
        first_diff = np.minimum((forward[a] != forward[b]).argmax(1), m[a] - 1)
        own = (lo[a] <= first_diff) & (first_diff < hi[a])
        a, b = a[own], b[own]
        # the longer word of a pair asks nowhere else
        longer = size[b] > size[a]
        a, b = np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]])
    return order[a], order[b]


def neighbours(listed: DataFrame) -> DataFrame:
    """(word, near, best): per list and word the number of its near words and the best of them as (-n, word)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def scan(rows: pa.Table) -> pa.RecordBatch:
            words = rows.column("word").to_pylist()
            n, m, lo, hi, key = (rows.column(c).to_numpy().astype(np.int64) for c in ("n", "m", "lo", "hi", "list"))
            group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
            a, b = near_in_block(words, n, m, lo, hi, group)
            latin = np.array([w.encode("latin-1") for w in words])
            by = np.lexsort((latin[b], -n[b], a))
            a, b = a[by], b[by]
            first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.empty(0, np.int64)
            near = np.diff(np.append(first, len(a)))
            best = pa.StructArray.from_arrays([pa.array(-n[b[first]], pa.int64()),
                                               pa.array([words[i] for i in b[first].tolist()], pa.string())], ["neg_n", "word"])
            return pa.RecordBatch.from_arrays([pa.array([words[i] for i in a[first].tolist()], pa.string()),
                                               pa.array(near, pa.int64()), best], names=["word", "near", "best"])

        held, cells = [], 0
        for batch in batches:
            key = batch.column("list").to_numpy()
            # cut at ends of lists; the last list of a batch may go on in the next
            ends = np.flatnonzero(key[1:] != key[:-1]) + 1
            size = np.asarray(pc.utf8_length(batch.column("word"))).astype(np.int64)
            if held and batch.num_rows and held[-1].column("list")[-1].as_py() != key[0]:
                ends = np.concatenate([[0], ends])
            at = 0
            for e in ends.tolist():
                part = batch.slice(at, e - at)
                if part.num_rows:
                    held.append(part)
                    cells += int(size[at:e].sum())
                at = e
                if cells >= BLOCK_CELLS:
                    yield scan(pa.Table.from_batches(held).combine_chunks())
                    held, cells = [], 0
            if at < batch.num_rows:
                held.append(batch.slice(at))
                cells += int(size[at:].sum())
        if held:
            yield scan(pa.Table.from_batches(held).combine_chunks())

    dealt = listed.repartition("list").sortWithinPartitions("m", "list")
    return dealt.mapInArrow(run, "word string, near long, best struct<neg_n:long,word:string>")


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): the end of the chain of forms, reached by doubling the steps.

    Along a chain the count at least doubles, so there are few steps.
    """
    steps = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = written(steps.join(further, "root", "left")
                        .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if steps.filter("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.drop("moved")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = 2,
                      list_words: int = LIST_WORDS) -> DataFrame:
    """Words of all texts with the form they vary: (word, form, root, n, n_near, form_n).

    A word's form is its near word with the largest count (ties: the
    smallest), if that count is at least ``ratio`` times the word's own.
    Null texts have no words, a null id counts as the empty string; repeated
    rows count each time; other columns are ignored; an empty table
    gives no rows.  Texts and words may be of any length.
    """
    arrow_batches(docs.sparkSession)
    words = written(vocabulary(docs, id_col, text_col), "vocabulary")
    arrow_batches(docs.sparkSession, 10000)  # words, not texts, from here on
    best = written(neighbours(lists(words, list_words)).groupBy("word")
                   .agg(F.sum("near").alias("n_near"), F.min("best").alias("best")), "near")
    arrow_batches(docs.sparkSession)
    with_form = (words.join(best, "word", "left")
                 .withColumn("near_n", -F.col("best.neg_n"))
                 .withColumn("form", F.when(F.col("near_n") >= ratio * F.col("n"), F.col("best.word")))
                 .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form",
                         F.when(F.col("form").isNotNull(), F.col("near_n")).alias("form_n")))
    found = written(with_form, "forms")
    ends = roots(found.filter("form IS NOT NULL"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
