"""Near-dedup by Order MinHash, candidates verified by banded alignment.

The k-mers of a text are runs of three words, labelled with the number of
their occurrence.  A sketch holds the few k-mers with the smallest hashes
in the order in which they stand in the text, so two texts share a sketch
when they agree in k-mers and in their order, as texts of small edit
distance do.  Texts that share a sketch form a bucket.

A short text has too few k-mers for that.  Instead all its runs of a few
words are names of buckets: ``e`` edits leave one of ``e + 1`` pieces of the
shorter text whole, so short similar texts always share such a run.

Inside a bucket nobody is paired with everybody: all members are aligned
with the bucket's first text; those that are not similar to it are aligned
with the first of the rest, and so on for a few rounds.  Similarity is not
transitive, so members that left with a centre may be similar to others of
the bucket.  The links found so far form components.  In a bucket of a few
members that still spans several, all pairs of different components meet.
All members, centres too, of a larger one are joined by pairs of words.  Two
of them can be similar only if they share one of their rarest pairs of words
(two fifths of the pairs and a few more, in a fixed order from rare to
frequent), or of their rarest words, so exactly such pairs of texts of
different components are aligned, and texts of one bucket that are similar
end in one class.  Links of equal texts are not made: equal texts
are one node.

Wherever two texts meet, their numbers of words and a small set of marks of
their words are compared first.  Both bound the edits from below, so only
pairs that cannot be similar are left out, before their words are moved.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from mercato.llm.alignment import allowed_edits, similar
from mercato.llm.common import arrow_batches, text_of, written
from mercato.llm.components import components
from mercato.llm.words import tokens

K = 3           # words in a k-mer
SKETCHES = 48
MINIMA = 2      # k-mers in a sketch
THRESHOLD = 0.8
SHORT = 50      # two similar texts of at most so many words share a run of words
RUN = 3         # words of such a run, or fewer where the threshold asks for it
CROWD = 32      # components that share a rare pair of words; the texts of more of them meet by single words
FEW = 32        # members of a bucket whose pairs all meet; the members of larger ones are joined by rare words
MARKS = 512     # bits of a text's marks: one per word, by its hash
ROUNDS = 3      # texts of a bucket that its other members are aligned with, before the rest is joined by rare words
PLACE_BITS = 28  # a sketch value is a hash above the k-mer's place in its text
M64 = 0xFFFFFFFFFFFFFFFF


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = _mix(x)
    return x[:n], x[n:] | np.uint64(1)


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every lower-case token, and the token offsets of the texts."""
    words, codes, offsets = tokens(pc.utf8_lower(texts.cast(pa.large_string())))
    table = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    return table[codes] if len(codes) else np.empty(0, np.uint64), offsets


def labelled_kmers(tok: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every (k-mer, occurrence) in text order, and the k-mer offsets of the texts.

    A text of fewer than ``k`` words has one k-mer of all its words; an empty text has none.
    """
    lengths = np.diff(offsets)
    counts = np.where(lengths > 0, np.maximum(1, lengths - k + 1), 0)
    upto = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(len(lengths)), counts)
    at = np.arange(upto[-1]) - upto[doc] + offsets[doc]
    end, h = offsets[doc + 1], np.zeros(len(at), np.uint64)
    for j in range(k):
        here = at + j
        h = _mix(h * np.uint64(31) + np.where(here < end, tok[np.minimum(here, len(tok) - 1)], np.uint64(0)))
    own = h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # occurrences are counted within a text
    order = np.argsort(own, kind="stable")
    new = np.concatenate([[True], own[order][1:] != own[order][:-1]]) if len(own) else np.empty(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(own)), 0)) if len(own) else np.empty(0, np.int64)
    occurrence = np.empty(len(own), np.uint64)
    occurrence[order] = (np.arange(len(own)) - first).astype(np.uint64)
    return _mix(h + occurrence * np.uint64(0xD6E8FEB86659FD93)), upto


def order_minhash(kmers: np.ndarray, upto: np.ndarray, sketches: int, minima: int) -> np.ndarray:
    """One row per text with k-mers: the ``sketches`` names of its ordered smallest k-mers."""
    full = np.flatnonzero(np.diff(upto))
    starts = upto[:-1][full]
    place = (np.arange(len(kmers)) - np.repeat(starts, np.diff(upto)[full])).astype(np.uint64)
    mask, last = np.uint64((1 << PLACE_BITS) - 1), np.uint64(M64)
    xor, odd = _seeds(sketches)
    out = np.empty((len(full), sketches), np.int64)
    for s in range(sketches):
        v = (((kmers ^ xor[s]) * odd[s]) & ~mask) | place
        places = np.empty((minima, len(full)), np.uint64)
        for r in range(minima):
            m = np.minimum.reduceat(v, starts)
            places[r] = np.where(m == last, last, m & mask)  # no k-mer is left of a short text
            v[starts[m != last] + (m[m != last] & mask).astype(np.int64)] = last
        places.sort(axis=0)
        name = np.full(len(full), np.uint64(s + 1))
        for r in range(minima):
            there = places[r] != last
            at = np.where(there, starts + np.where(there, places[r], 0).astype(np.int64), 0)
            name = _mix(name * np.uint64(31) + np.where(there, kmers[at], np.uint64(0)))
        out[:, s] = name.view(np.int64)
    return out


def run_widths(threshold: float) -> np.ndarray:
    """[words of a text, width]: whether the text's runs of that width are names.

    Of two similar texts, the longer with ``m`` words, the shorter has a
    piece of (m - e) // (e + 1) words or more that none of the ``e`` allowed
    edits touches.  Both texts name all their runs of that width.
    """
    out = np.zeros((SHORT + 1, RUN + 1), bool)
    for m in range(1, SHORT + 1):
        e = allowed_edits(m, m, threshold)
        out[m - e:m + 1, min(RUN, max(1, (m - e) // (e + 1)))] = True
    out[0] = False
    return out


def _some(tok: np.ndarray, offsets: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and offsets of the texts ``docs`` alone."""
    lengths = np.diff(offsets)
    take = np.zeros(len(lengths), bool)
    take[docs] = True
    return tok[np.repeat(take, lengths)], np.concatenate([[0], np.cumsum(lengths[docs])])


def bucket_names(tok: np.ndarray, offsets: np.ndarray, k: int, sketches: int, minima: int,
                 threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The names of all texts one after the other, and their offsets; an empty text has none."""
    lengths = np.diff(offsets)
    # a pair whose longer text is not short has two texts of at least this many words
    least = SHORT + 1 - allowed_edits(SHORT + 1, SHORT + 1, threshold)
    long = np.flatnonzero(lengths >= max(1, least))
    docs, names = [], []
    if len(long):
        rows = order_minhash(*labelled_kmers(*_some(tok, offsets, long), k), sketches, minima)
        docs.append(np.repeat(long, sketches))
        names.append(rows.ravel())
    widths = run_widths(threshold)
    for w in range(1, RUN + 1):
        mine = np.flatnonzero((lengths <= SHORT) & widths[np.minimum(lengths, SHORT), w])
        if len(mine):
            kmers, upto = labelled_kmers(*_some(tok, offsets, mine), w)
            docs.append(np.repeat(mine, np.diff(upto)))
            names.append(_mix(kmers + np.uint64(w)).view(np.int64))
    if not docs:
        return np.empty(0, np.int64), np.zeros(len(lengths) + 1, np.int64)
    doc = np.concatenate(docs)
    ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(lengths)))])
    return np.concatenate(names)[np.argsort(doc, kind="stable")], ends


def sketched(docs: DataFrame, k: int, sketches: int, minima: int, threshold: float) -> DataFrame:
    """(id, sha, text) -> (id, sha, sketches array<long>); an empty text has no sketches."""
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, ends = bucket_names(*token_hashes(b.column("text")), k, sketches, minima, threshold)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("sha"), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(names))],
                names=["id", "sha", "sketches"])

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "sha", "text").mapInArrow(run, f"id {id_type}, sha string, sketches array<long>")


def marks_of(packed: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of MARKS bits per text, as 64-bit integers: those of its words' 32-bit hashes."""
    bits = np.zeros((len(offsets) - 1, MARKS), bool)
    bits[np.repeat(np.arange(len(bits)), np.diff(offsets)), packed % MARKS] = True
    return np.packbits(bits, axis=1).view(np.int64)


def token_table(texts: DataFrame) -> DataFrame:
    """(node, text) -> (node, tokens, n, marks): 32-bit hashes of the lower-case words, packed, their number and marks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tok, offsets = token_hashes(b.column("text"))
            packed = (tok >> np.uint64(32)).astype(np.uint32)
            rows = [packed[a:e].tobytes() for a, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            marks = marks_of(packed, offsets)
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), pa.array(rows, pa.binary()), pa.array(np.diff(offsets), pa.int32()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * marks.shape[1], pa.int32()), pa.array(marks.ravel()))],
                names=["node", "tokens", "n", "marks"])

    return texts.select("node", "text").mapInArrow(run, "node long, tokens binary, n int, marks array<long>")


def could_be_similar(threshold: float) -> Column:
    """Whether texts of ``n`` and ``m`` words with ``marks`` and ``centre_marks`` can be similar.

    An edit changes the number of words by one at most, and takes away and
    adds at most one mark.
    """
    # as alignment.allowed_edits
    edits = F.floor(F.lit(1 - threshold) * F.greatest("n", "m") + F.lit(1e-9))

    def without(a: str, b: str) -> Column:
        return reduce(Column.__add__, [F.bit_count(F.col(a)[i].bitwiseAND(F.bitwise_not(F.col(b)[i]))) for i in range(MARKS // 64)])

    return ((F.abs(F.col("n") - F.col("m")) <= edits) & (without("marks", "centre_marks") <= edits)
            & (without("centre_marks", "marks") <= edits))


def as_centre(rows: DataFrame, *others: str) -> DataFrame:
    """(node, n, marks) and the columns ``others`` -> (centre, m, centre_marks) and those."""
    return rows.select(F.col("node").alias("centre"), F.col("n").alias("m"), F.col("marks").alias("centre_marks"), *others)


def asked_of(open_: DataFrame, centres: DataFrame, token_rows: DataFrame, threshold: float) -> DataFrame:
    """Members (node, bucket) with the (bucket, centre) of their bucket that they could be similar to."""
    known = token_rows.select("node", "n", "marks")
    first = as_centre(centres.withColumnRenamed("centre", "node").join(known, "node"), "bucket")
    return (open_.join(known, "node").join(first, "bucket").filter(F.col("node") != F.col("centre"))
            .filter(could_be_similar(threshold)).select("node", "bucket", "centre"))


def pairs_of_small_buckets(placed: DataFrame, token_rows: DataFrame, threshold: float) -> DataFrame:
    """All pairs (node, centre) of different components of a bucket of (node, bucket, comp) that could be similar.

    Buckets have FEW members at most, so the pairs grow with the members.
    """
    members = written(placed.join(token_rows.select("node", "n", "marks"), "node"), "few")
    others = as_centre(members, "bucket", F.col("comp").alias("centre_comp"))
    return (members.join(others, "bucket").filter((F.col("node") > F.col("centre")) & (F.col("comp") != F.col("centre_comp")))
            .filter(could_be_similar(threshold)).select("node", "centre").distinct())


def possible(pairs: DataFrame, token_rows: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (node, centre) that could be similar."""
    known = token_rows.select("node", "n", "marks")
    return (pairs.join(known, "node").join(as_centre(known), "centre").filter(could_be_similar(threshold))
            .select("node", "centre"))


def verified(pairs: DataFrame, token_rows: DataFrame, threshold: float) -> DataFrame:
    """(node, centre) pairs, as written -> (node, centre, similar).

    Of the tokens only those of the pairs' texts are moved.
    """
    a, b = (token_rows.select(F.col("node").alias(key), F.col("tokens").alias(name)).join(pairs.select(key).distinct(), key, "left_semi")
            for key, name in (("node", "a"), ("centre", "b")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs_ = [(np.frombuffer(x, np.uint32).astype(np.int64), np.frombuffer(y, np.uint32).astype(np.int64))
                      for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("centre"), pa.array(similar(pairs_, threshold), pa.bool_())],
                names=["node", "centre", "similar"])

    return (pairs.join(a, "node").join(b, "centre").select("node", "centre", "a", "b")
            .mapInArrow(run, "node long, centre long, similar boolean"))


def needed(n: int, width: int, threshold: float) -> int:
    """How many runs of ``width`` words a text of ``n`` words shares, at least, with any similar text.

    Of the longer text, with m words, each edit spoils at most ``width`` of its m - width + 1 runs.
    """
    m = np.arange(n, int(n / threshold + 1e-9) + 1)
    edits = np.array((1 - threshold) * m + 1e-9, np.int64)
    return max(1, int((m - width + 1 - width * edits).min()))


def run_width(threshold: float) -> int:
    """Pairs of words where similar texts of any length share one; single words below such thresholds."""
    # m - 1 - 2 edits is at least 1 for every m from 2 on
    return 2 if threshold >= 0.75 else 1


def runs(token_rows: DataFrame, width: int) -> DataFrame:
    """(node, tokens) -> (node, word): every run of ``width`` words, and nothing else, as each is shuffled.

    Runs are labelled with their occurrence, so that shared ones count as
    often as both texts have them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [np.frombuffer(x, np.uint32) for x in b.column("tokens").to_pylist()]
            if not texts:
                continue
            lengths = np.array([len(t) for t in texts])
            label, upto = labelled_kmers(np.concatenate(texts).astype(np.uint64), np.concatenate([[0], np.cumsum(lengths)]), width)
            of = np.repeat(np.arange(len(texts)), np.diff(upto))
            for s in range(0, len(label), 1 << 16):
                at = pa.array(of[s:s + (1 << 16)])
                yield pa.RecordBatch.from_arrays([b.column("node").take(at), pa.array(label[s:s + (1 << 16)].view(np.int64))],
                                                 names=["node", "word"])

    return token_rows.select("node", "tokens").mapInArrow(run, "node long, word long")


def run_counts(token_rows: DataFrame, width: int, threshold: float) -> DataFrame:
    """(node, comp, tokens) -> (node, comp, n, n_runs, most): words and runs of a node.

    Among the ``most`` rarest runs of a node is one that a similar text shares.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [x // 4 for x in pc.binary_length(b.column("tokens")).to_pylist()]
            n_runs = [max(1, x - width + 1) if x else 0 for x in n]
            most = [r - needed(x, width, threshold) + 1 for r, x in zip(n_runs, n)]
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("comp"), *(pa.array(c, pa.int32()) for c in (n, n_runs, most))],
                                             names=["node", "comp", "n", "n_runs", "most"])

    return token_rows.select("node", "comp", "tokens").mapInArrow(run, "node long, comp long, n int, n_runs int, most int")


def rare_words(texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """(node, word, n, c, groups) for the rarest runs of each node, one of which a similar text has among its rarest.

    Texts come with their component (node, comp, tokens).  A text's runs are
    ordered from rare to frequent; those that no text of another component
    has come first and are only counted, as texts of different components
    alone are asked for.  The ``groups`` components that hold a run are
    numbered by ``c``; a run that only one of them chose is left out.
    What is known of a node joins its runs after the two shuffles.
    """
    every = runs(texts, width)
    of_comps = runs(texts.select(F.col("comp").alias("node"), "tokens"), width)
    met = written(of_comps.groupBy("word").agg(F.count(F.lit(1)).alias("texts"), F.min("node").alias("low"), F.max("node").alias("high"))
                  .filter("low < high").select("word", "texts"), "met")
    shared = every.join(met, "word")
    by_node = Window.partitionBy("node")
    ranked = (shared.withColumn("rank", F.row_number().over(by_node.orderBy("texts", "word")))
              .withColumn("met", F.count(F.lit(1)).over(by_node)))
    counts = written(run_counts(texts, width, threshold), "run-counts")
    chosen = written(ranked.join(counts, "node").filter("n_runs - met + rank <= most").select("node", "comp", "n", "word"), "chosen")
    held = chosen.select("word", "comp").distinct()
    by_word = Window.partitionBy("word")
    held = written(held.withColumn("c", F.row_number().over(by_word.orderBy("comp")) - 1)
                   .withColumn("groups", F.count(F.lit(1)).over(by_word)).filter("groups > 1"), "held")
    return chosen.join(held, ["word", "comp"]).select("node", "word", "n", "c", "groups")


def joined_by_words(rare: DataFrame, threshold: float) -> DataFrame:
    """Pairs (node, centre) of different components that share a rare run and could be similar by their lengths.

    Two numbers of components differ first at one of their bits, and a pair
    meets at that bit alone; members of one component never meet, however
    many of them share a run.
    """
    level = F.explode(F.sequence(F.lit(0), F.length(F.bin(F.col("groups") - 1)) - 1))
    rows = (rare.withColumn("level", level).withColumn("above", F.expr("shiftright(c, level + 1)"))
            .withColumn("bit", F.expr("shiftright(c, level) & 1"))
            # a number with the other bit is there
            .filter("bit = 1 OR shiftleft(2 * above + 1, level) < groups"))
    key = ["word", "level", "above"]
    a = rows.filter("bit = 1").select(*key, F.col("node").alias("x"), "n")
    b = rows.filter("bit = 0").select(*key, F.col("node").alias("y"), F.col("n").alias("m"))
    near = (F.col("n") >= F.col("m") * threshold) & (F.col("m") >= F.col("n") * threshold)
    return a.join(b, key).filter(near).select(F.greatest("x", "y").alias("node"), F.least("x", "y").alias("centre")).distinct()


def pairs_of_the_rest(token_rows: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """All pairs (node, centre) of different components of ``nodes`` (node, comp) that can be similar.

    Texts meet at a rare pair of words.  A pair of words that more than
    CROWD components hold (a passage that many documents share) makes no
    pairs: its texts meet at rare single words of theirs instead, among
    which the passage's are the frequent ones.  Either way is exact.
    """
    width = run_width(threshold)
    texts = written(token_rows.select("node", "tokens").join(nodes, "node"), "rest-tokens")
    rare = written(rare_words(texts, width, threshold), "rare")
    if width == 1:
        return joined_by_words(rare, threshold)
    crowd = written(texts.join(rare.filter(F.col("groups") > CROWD).select("node").distinct(), "node"), "crowd")
    pairs = joined_by_words(rare.filter(F.col("groups") <= CROWD), threshold)
    if crowd.isEmpty():
        return pairs
    return pairs.union(joined_by_words(written(rare_words(crowd, 1, threshold), "rare"), threshold)).distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, sketches: int = SKETCHES,
               minima: int = MINIMA, threshold: float = THRESHOLD) -> DataFrame:
    """Classes of documents linked by edit similarity of at least ``threshold`` (over lower-case words).

    Returns one row per input row: id, class_id (smallest id of the class),
    class_size (rows), n_links (verified links of the row's text to other
    texts), kept (one row of each class: the smallest id, of repeated rows
    one), text_sha256.  A null text counts as empty; all empty texts are one
    class, as equal texts always are.  A null id sorts after all others.  Texts
    of up to SHORT words are compared wherever they can be similar, longer
    ones where they share a sketch.  An empty table gives an empty result;
    other columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    base = base.withColumn("sha", F.sha2("text", 256))
    rows = written(sketched(base, k, sketches, minima, threshold).withColumn("row", F.monotonically_increasing_id()), "sketches")
    # sums that are joined back are written, so that the joins read plain shuffles and hot keys can be split
    nodes = written(rows.groupBy("sha").agg(F.min("row").alias("node")), "nodes")
    # written, as the names are read twice and the sketches are shuffled for it
    own = written(rows.join(nodes, (rows["row"] == nodes["node"]) & (rows["sha"] == nodes["sha"]), "left_semi")
                  .select(F.col("row").alias("node"), "sketches"), "own")
    names = own.select("node", F.explode("sketches").alias("bucket"))
    crowded = written(names.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket"), "crowded")
    members = written(names.join(crowded, "bucket"), "gathered")
    # of buckets with the same members one is enough
    same = [F.count(F.lit(1)).alias("n"), F.min("node").alias("first"), F.max("node").alias("last"),
            F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")]
    distinct = written(members.groupBy("bucket").agg(*same).groupBy("n", "first", "last", "x", "y").agg(F.min("bucket").alias("bucket"))
                       .select("bucket"), "distinct")
    members = written(members.join(distinct, "bucket"), "members")

    needed = (rows.join(members.select("node").distinct(), F.col("row") == F.col("node"))
              .select("node", F.col("sha").alias("its_sha"), F.col("id").alias("its_id")))
    texts = (base.join(needed, (F.col("sha") == F.col("its_sha")) & F.col("id").eqNullSafe(F.col("its_id")))
             .select("node", "text"))
    token_rows = written(token_table(texts).dropDuplicates(["node"]), "tokens")

    links, open_, tested = [], members, None

    def test(pairs: DataFrame) -> None:
        nonlocal tested
        if tested is not None:
            pairs = pairs.join(tested, ["node", "centre"], "left_anti")
        found = written(verified(written(pairs, "pairs"), token_rows, threshold), "verified")
        links.append(found.filter("similar").select(F.col("node").alias("u"), F.col("centre").alias("v")))
        tested = found if tested is None else tested.union(found)

    for left in reversed(range(ROUNDS)):
        centres = written(open_.groupBy("bucket").agg(F.min("node").alias("centre")), "centres")
        asked = written(asked_of(open_, centres, token_rows, threshold), "asked")
        if not asked.isEmpty():
            test(asked.select("node", "centre").distinct())
        if not left:  # what is open then is not asked again
            break
        done = centres.select(F.col("centre").alias("node"), "bucket")
        if tested is not None:
            linked = tested.filter("similar").select("node", "centre")
            done = done.union(asked.join(linked, ["node", "centre"], "left_semi").select("node", "bucket"))
        open_ = written(open_.join(done, ["node", "bucket"], "left_anti"), "open")
        if open_.isEmpty():
            break

    def edges_of(found: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.union, found) if found else rows.sparkSession.createDataFrame([], "u long, v long")

    roots = components(edges_of(links))
    placed = written(members.join(roots, "node", "left").select("node", "bucket", F.coalesce("root", "node").alias("comp")),
                     "placed")
    # the rounds have tested every pair of a bucket of ROUNDS + 1 members without links
    spans = written(placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket")
                    .agg(F.count(F.lit(1)).alias("comps"), F.sum("n").alias("members"))
                    .filter((F.col("comps") > 1) & ((F.col("comps") < F.col("members")) | (F.col("members") > ROUNDS + 1)))
                    .select("bucket", "members"), "spans")
    spanned = written(placed.join(spans, "bucket"), "spanned")
    if not spanned.isEmpty():
        few = F.col("members") <= FEW
        pairs = pairs_of_small_buckets(spanned.filter(few), token_rows, threshold)
        rest = written(spanned.filter(~few).select("node", "comp").distinct(), "rest")
        if not rest.isEmpty():
            pairs = pairs.union(possible(pairs_of_the_rest(token_rows, rest, threshold), token_rows, threshold)).distinct()
        test(pairs)
        roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(links[-1]))
    edges = edges_of(links)
    degrees = (edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
               .groupBy("u").agg(F.count(F.lit(1)).alias("n_links")))
    classes = (nodes.join(roots, "node", "left").join(degrees, F.col("node") == F.col("u"), "left")
               .select("sha", F.coalesce("root", "node").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    named = written(rows.select("id", "row", "sha").join(classes, "sha"), "classes")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    heads = written(named.groupBy("class").agg(F.min(order).alias("head"), F.count(F.lit(1)).alias("class_size")), "heads")
    return named.join(heads, "class").select(
        F.col("id").alias(id_col), F.col("head.id").alias("class_id"), "class_size",
        F.col("n_links").cast("long").alias("n_links"), (F.col("row") == F.col("head.row")).alias("kept"),
        F.col("sha").alias("text_sha256"))
