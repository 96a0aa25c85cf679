"""Ranked lexical search over a length-stratified index.

A stratum holds the documents of equal length normaliser m, so within it a
term's impact depends on its frequency tf alone: postings are kept by tf
and the impact is computed once per tf.  A large stratum is sliced by a
hash of its rows into blocks of bounded size, each with postings of its own.

Every query bounds its score in every block by the largest tf of its terms
there.  The blocks with the largest bounds are scored first; the k-th score
they give is the floor for the rest, and blocks whose bound lies below it
are never scored.  A block is scored by adding the impacts of the query's
terms to one array over its documents.  Queries are dealt to sets of
bounded size, so neither a block nor a set grows with the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from mercato.llm.common import arrow_batches, text_of, written

BLOCK_ROWS = 4096          # documents in a block, about
BLOCK_TERMS = 1 << 21      # terms with repeats in a block, about
QUERY_SET = 512            # queries scored together in a block, about
SEEDS = 3                  # blocks a query visits before it has a floor

# ASCII letters (in lower case), digits and all bytes of other characters stay; the rest ends a term.
TERMS = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256))


@dataclass(frozen=True)
class Index:
    """Postings (m, slice, term, max_tf, df, runs, docs), blocks (m, slice, ids), N and L of the corpus.

    ``runs`` holds pairs (tf, number of documents) by descending tf, ``docs``
    the documents' places in the block in that order, both as packed numbers.
    """

    postings: DataFrame
    blocks: DataFrame
    documents: int
    terms: int


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(TERMS).split()


def lengths(texts: DataFrame) -> DataFrame:
    """text -> (n, rows): how many texts have n terms, n above 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = Counter(len(terms_of(t)) for t in b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.int64()), pa.array(list(n.values()), pa.int64())], names=["n", "rows"])

    return (texts.select("text").mapInArrow(run, "n long, rows long").filter("n > 0")
            .groupBy("n").agg(F.sum("rows").alias("rows")))


def term_counts(texts: DataFrame) -> DataFrame:
    """(id, text) -> (id, row, n, terms, often): the distinct terms by descending count, joined by blanks.

    ``often`` packs the counts above 1; ``row`` is unique.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 32
        for b in batches:
            n, terms, often = [], [], []
            for text in b.column("text").to_pylist():
                found = terms_of(text)
                counts = Counter(found).most_common()
                n.append(len(found))
                terms.append(b" ".join(t for t, _ in counts))
                often.append(np.fromiter((c for _, c in counts if c > 1), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(np.arange(row, row + len(n))), pa.array(n, pa.int64()), pa.array(terms, pa.binary()),
                 pa.array(often, pa.binary())], names=["id", "row", "n", "terms", "often"])
            row += len(n)

    id_type = texts.schema["id"].dataType.simpleString()
    return texts.select("id", "text").mapInArrow(run, f"id {id_type}, row long, n long, terms binary, often binary")


def block_postings(rows: DataFrame) -> DataFrame:
    """(m, slice, id, terms, often), rows of a block together -> a row with the block's ids, then its postings."""
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(key: tuple, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(parts).combine_chunks()
            known: dict[bytes, int] = {}
            codes, tfs, docs = [], [], []
            for d, (terms, often) in enumerate(zip(t.column("terms").to_pylist(), t.column("often").to_pylist())):
                code = [known.setdefault(x, len(known)) for x in terms.split(b" ")]
                tf = np.ones(len(code), np.uint32)
                many = np.frombuffer(often, "<u4")
                tf[:len(many)] = many
                codes.append(np.array(code, np.uint32))
                tfs.append(tf)
                docs.append(np.full(len(code), d, "<u2"))
            code, tf, doc = np.concatenate(codes), np.concatenate(tfs), np.concatenate(docs)
            by = np.lexsort((doc, -tf.astype(np.int64), code))
            code, tf, doc = code[by], tf[by], doc[by]
            other = code[1:] != code[:-1]
            term_at = np.append(np.flatnonzero(np.concatenate([[True], other])), len(code))
            run_at = np.append(np.flatnonzero(np.concatenate([[True], other | (tf[1:] != tf[:-1])])), len(code))
            runs = np.stack([tf[run_at[:-1]], np.diff(run_at)], 1).astype("<u4")
            run_ends = np.searchsorted(run_at, term_at).tolist()
            packed_docs, packed_runs, ends = memoryview(doc.tobytes()), memoryview(runs.tobytes()), term_at.tolist()
            k = len(known)
            ids = pa.ListArray.from_arrays(pa.array([0, len(t)], pa.int32()), t.column("id").combine_chunks())
            names = ["m", "slice", "term", "max_tf", "df", "runs", "docs", "ids"]
            whole = pa.RecordBatch.from_arrays([
                pa.array([key[0]] * (k + 1), pa.int64()), pa.array([key[1]] * (k + 1), pa.int64()),
                pa.array([None, *known], pa.binary()).cast(pa.string()),
                pa.array([None, *tf[term_at[:-1]].tolist()], pa.int64()), pa.array([None, *np.diff(term_at).tolist()], pa.int64()),
                pa.array([None, *(bytes(packed_runs[8 * x:8 * y]) for x, y in zip(run_ends, run_ends[1:]))], pa.binary()),
                pa.array([None, *(bytes(packed_docs[2 * x:2 * y]) for x, y in zip(ends, ends[1:]))], pa.binary()),
                pa.concat_arrays([ids, pa.nulls(k, ids.type)])], names=names)
            for at in range(0, k + 1, 50_000):
                yield whole.slice(at, 50_000)

        key, parts = None, []
        for b in batches:
            m, s = b.column("m").to_numpy(), b.column("slice").to_numpy()
            cuts = [0, *(np.flatnonzero((m[1:] != m[:-1]) | (s[1:] != s[:-1])) + 1).tolist(), b.num_rows]
            for at, end in zip(cuts, cuts[1:]):
                if at == end:
                    continue
                if parts and key != (m[at], s[at]):
                    yield from close(key, parts)
                    parts = []
                key = (int(m[at]), int(s[at]))
                parts.append(b.slice(at, end - at))
        if parts:
            yield from close(key, parts)

    return rows.select("m", "slice", "id", "terms", "often").mapInArrow(
        run, f"m long, slice long, term string, max_tf long, df long, runs binary, docs binary, ids array<{id_type}>")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS,
                block_terms: int = BLOCK_TERMS) -> Index:
    """Index every row of ``docs`` that has a term: a pass that counts, then one that deals and inverts."""
    if not 0 < block_rows <= 1 << 14:
        raise ValueError("a block has from 1 to 16,384 documents, about")
    base = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    sizes = written(lengths(base), "lengths")
    total = sizes.agg(F.sum("rows").alias("docs"), F.sum(F.col("n") * F.col("rows")).alias("terms")).first()
    n_docs, n_terms = total.docs or 0, total.terms or 1  # an empty corpus has no rows below
    normaliser = F.expr(f"100 - 75 + (75L * n * {n_docs}L) div {n_terms}L")
    strata = sizes.groupBy(normaliser.alias("m")).agg(F.sum("rows").alias("rows"), F.sum(F.col("n") * F.col("rows")).alias("terms"))
    slices = strata.select("m", F.greatest(F.ceil(F.col("rows") / block_rows), F.ceil(F.col("terms") / block_terms)).alias("slices"))
    dealt = (term_counts(base).filter("n > 0").withColumn("m", normaliser).join(slices, "m")
             .withColumn("slice", F.pmod(F.xxhash64("row"), F.col("slices")))
             .select("m", "slice", "row", "id", "terms", "often").repartition("m", "slice").sortWithinPartitions("m", "slice", "row"))
    index = written(block_postings(dealt), "index")
    return Index(index.filter("term IS NOT NULL").drop("ids"), index.filter("term IS NULL").select("m", "slice", "ids"), n_docs, n_terms)


def _scored(wanted: DataFrame, hits: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """(chunk, m, slice, query, floor, terms, weights) -> (query, doc, score): the k best of every (query, block) pair."""
    id_type = blocks.schema["ids"].dataType.elementType.simpleString()
    id_arrow = to_arrow_type(blocks.schema["ids"].dataType.elementType)

    def score(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_d, out_s = [], [], []
        postings = left.filter(left.column("term").is_valid()).combine_chunks()
        if right.num_rows and left.num_rows:
            m = key[1].as_py()
            ids = left.filter(left.column("ids").is_valid()).column("ids")[0].values
            by_id = np.asarray(pc.rank(ids, "ascending", null_placement="at_end", tiebreaker="first"))
            runs, docs, place = postings.column("runs").to_pylist(), postings.column("docs").to_pylist(), {}
            for i, term in enumerate(postings.column("term").to_pylist()):
                tfs, times = np.frombuffer(runs[i], "<u4").reshape(-1, 2).T.astype(np.int64)
                impact = 1_000_000_000 * tfs // (1000 * tfs + 8 * m)  # once per tf
                place[term] = np.frombuffer(docs[i], "<u2").astype(np.int64), np.repeat(impact, times)
            total = np.zeros(len(ids), np.int64)
            for q, floor, terms, weights in zip(*(right.column(c).to_pylist() for c in ("query", "floor", "terms", "weights"))):
                total[:] = 0
                for t, w in zip(terms, weights):
                    if t in place:
                        at, impact = place[t]
                        total[at] += w * impact
                good = np.flatnonzero(total >= max(floor, 1))
                if len(good) > k:
                    good = good[np.lexsort((by_id[good], -total[good]))[:k]]
                out_q += [q] * len(good)
                out_d.append(good)
                out_s.append(total[good])
            at = np.concatenate(out_d) if out_d else np.empty(0, np.int64)
            return pa.table([pa.array(out_q, pa.int64()), ids.take(pa.array(at)),
                             pa.array(np.concatenate(out_s) if out_s else [], pa.int64())], names=["query", "doc", "score"])
        return pa.table([pa.array([], pa.int64()), pa.array([], id_arrow), pa.array([], pa.int64())],
                        names=["query", "doc", "score"])

    # a block's ids travel with its postings, as a row without a term
    both = hits.select("m", "slice", "term", "runs", "docs").unionByName(blocks, allowMissingColumns=True)
    visited = wanted.select(*(F.col(c).alias(c) for c in ("chunk", "m", "slice"))).distinct()
    sides = both.join(visited, ["m", "slice"]), wanted
    left, right = (s.groupBy("chunk", "m", "slice") for s in sides)
    return left.cogroup(right).applyInArrow(score, f"query long, doc {id_type}, score long")


def query_terms(queries: DataFrame) -> DataFrame:
    """(query, text) -> (query, term, times)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(q, t, c) for q, text in zip(b.column("query").to_pylist(), b.column("text").to_pylist())
                    for t, c in Counter(terms_of(text)).items()]
            q, t, c = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(t, pa.binary()).cast(pa.string()), pa.array(c, pa.int64())],
                                             names=["query", "term", "times"])

    return queries.select("query", "text").mapInArrow(run, "query long, term string, times long")


def search(index: Index, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text",
           seeds: int = SEEDS, query_set: int = QUERY_SET) -> DataFrame:
    """The k best documents of every item: (item, rank, doc, score), scores above 0 only.

    Rows of ``items`` that repeat both id and text are one item; the same id
    with another text is an item of its own.
    """
    base = items.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).dropDuplicates()
    queries = written(base.withColumn("query", F.xxhash64("id", "text")), "queries")
    sets = max(1, -(-queries.count() // query_set))
    asked = written(query_terms(queries), "asked")
    hits = written(index.postings.join(asked.select("term").distinct(), "term", "left_semi"), "hits")
    df = hits.groupBy("term").agg(F.sum("df").alias("df"))
    w = F.floor(1000 * F.log(F.lit(float(2 * index.documents + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weighed = written(asked.join(df.select("term", w.alias("w")), "term").select("query", "term", (F.col("w") * F.col("times")).alias("weight")),
                      "weights")
    # the impact of the largest tf bounds the term in the block
    most = F.expr("(1000000000L * max_tf) div (1000L * max_tf + 8L * m)")
    bounds = written(hits.select("m", "slice", "term", most.alias("most")).join(weighed, "term")
                     .groupBy("query", "m", "slice").agg(F.sum(F.col("weight") * F.col("most")).alias("bound"))
                     .filter("bound > 0"), "bounds")
    packed = weighed.groupBy("query").agg(F.collect_list(F.struct("term", "weight")).alias("t")).select(
        "query", F.pmod(F.xxhash64("query"), F.lit(sets)).alias("chunk"), F.col("t.term").alias("terms"), F.col("t.weight").alias("weights"))

    def visit(pairs: DataFrame) -> DataFrame:
        return _scored(written(pairs.join(packed, "query"), "wanted"), hits, index.blocks, k)

    order = Window.partitionBy("query").orderBy(F.desc("bound"), "m", "slice")
    seed = bounds.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= seeds)
    seed = written(seed.select("query", "m", "slice", F.lit(1).cast("long").alias("floor")), "seed")
    first = written(visit(seed), "first")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    floor = (first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k)
             .select("query", F.col("score").alias("floor")))
    rest = (bounds.join(seed.select("query", "m", "slice"), ["query", "m", "slice"], "left_anti")
            .join(floor, "query", "left").withColumn("floor", F.coalesce("floor", F.lit(1).cast("long")))
            .filter("bound >= floor").select("query", "m", "slice", "floor"))
    every = first.unionByName(visit(rest)).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return (every.join(queries.select("query", "id"), "query")
            .select(F.col("id").alias("item"), F.col("rank").cast("int").alias("rank"), "doc", "score"))


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", item_col: str = "item_id") -> DataFrame:
    """Index ``docs`` and answer every item: (item_id, rank, doc_id, score).

    Null texts have no terms: such documents aren't counted or found, such
    items find nothing.  Repeated rows of ``docs`` are documents of their own and can take several ranks;
    equal scores go by id, null ids last.  Other columns are ignored; an
    empty table on either side gives no rows.
    """
    arrow_batches(docs.sparkSession)
    index = build_index(docs, id_col)
    found = search(index, items, k, item_col)
    return found.withColumnsRenamed({"item": item_col, "doc": id_col})
