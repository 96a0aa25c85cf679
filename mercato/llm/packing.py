"""Packing documents into fixed windows of tokens: concatenate and cut.

Pass one encodes every text and writes, per document, its ids and the
number of tokens before it in its partition.  The partitions' totals, one
number per task, are added up to the place of every partition in the
concatenation of all documents.  Pass two shifts each document by its
partition's place and cuts it where the concatenation crosses a multiple
of the window, so a document on a boundary becomes two or more records.
No row moves between the passes: there is no shuffle of tokens, no sort
and no group, however many documents share a source or a text.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from mercato.llm.bpe import WORDS, Vocabulary, pack_numbers, unpack_numbers
from mercato.llm.common import arrow_batches, text_of, written

WINDOW = 2048


class Encoder:
    """Ids of texts under a byte-level BPE file.

    The merges run in tiktoken, about six times as fast, when the file's ids
    follow the order of its merges; that is checked here.  Other files, and
    texts that hold strings of special tokens, are encoded by the
    tokenizers library.
    """

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        self.vocabulary = Vocabulary(content)
        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()
        known, special = spec["model"]["vocab"], {t["id"] for t in spec["added_tokens"]}
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        ids = [known[m] for m in merges]
        pieces = {p: i for i, p in enumerate(self.vocabulary.pieces) if p and i not in special}
        self.fast = None
        if ids == sorted(ids) and len(pieces) == len(known.keys() - {t["content"] for t in spec["added_tokens"]}) \
                and len(pieces) == len(merges) + 256 and not spec["model"].get("ignore_merges"):
            self.fast = tiktoken.Encoding("own", pat_str=WORDS.pattern, mergeable_ranks=pieces, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and not any(s in text for s in self.vocabulary.special):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def encoder(content: str) -> Encoder:
    return Encoder(content)


def encoded(docs: DataFrame, content: str, end_id: int) -> DataFrame:
    """(id, text) -> (part, at, id, n, ids): a document's packed ids and the tokens before it in its partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = encoder(content), TaskContext.get().partitionId(), 0
        for b in batches:
            ns, packs = [], []
            for text in b.column("text").to_pylist():
                ids = np.append(enc.ids(text), np.uint32(end_id))
                ns.append(len(ids))
                packs.append(pack_numbers(ids))
            upto = list(accumulate(ns, initial=at))
            at = upto.pop()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(ns), pa.int32()), pa.array(upto, pa.int64()), b.column("id"), pa.array(ns, pa.int64()),
                 pa.array(packs, pa.binary())], names=["part", "at", "id", "n", "ids"])

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"part int, at long, id {id_type}, n long, ids binary")


def places(table: DataFrame) -> DataFrame:
    """(part, first): where each partition's documents begin in the concatenation of all.

    One number per task of the first pass meets on the driver, which has
    kept more than that about each of those tasks.
    """
    totals = sorted(table.groupBy("part").agg(F.max(F.col("at") + F.col("n")).alias("total")).collect())
    first = accumulate((r.total for r in totals), initial=0)
    return table.sparkSession.createDataFrame([(r.part, f) for r, f in zip(totals, first)], "part int, first long")


def cut(placed: DataFrame, window: int, with_ids: bool) -> DataFrame:
    """(id, at, n, ids), ``at`` in the whole concatenation -> one row per piece."""
    id_type = placed.schema["id"].dataType.simpleString()
    schema = (f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + ", ids array<int>" * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, start, length, crc, n_, place, own = [], [], [], [], [], [], []
            for r, (at, n, pack) in enumerate(zip(b.column("at").to_pylist(), b.column("n").to_pylist(),
                                                  b.column("ids").to_pylist())):
                ids = unpack_numbers(pack)
                raw = memoryview(ids.astype("<u4").tobytes())
                cuts = [0, *range(window - at % window, n, window), n]
                for s, e in zip(cuts, cuts[1:]):
                    row.append(r)
                    start.append(s)
                    length.append(e - s)
                    crc.append(zlib.crc32(raw[4 * s:4 * e]))
                    n_.append(n)
                    place.append(at + s)
                    if with_ids:
                        own.append(ids[s:e].astype(np.int32))
            at_ = np.array(place, np.int64)
            cols = [b.column("id").take(pa.array(row, pa.int32())),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc, n_, at_ // window, at_ % window))]
            if with_ids:
                cols.append(pa.array(own, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                                          "offset", "ids"][:len(cols)])

    return placed.select("id", "at", "n", "ids").mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_file: str, end_id: int, window: int = WINDOW, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pack every document, closed by ``end_id``, into sequences of ``window`` tokens.

    One row per piece: id, start (the document's tokens before the piece),
    length, ids_crc32 (of the ids as little-endian 32-bit numbers),
    doc_tokens (with the closing id), sequence_id and offset, and with
    ``with_ids`` the ids.  All sequences but the last are full.  A null text
    counts as empty: its document is the closing id alone.  Null and
    repeated ids and repeated texts are packed row by row; other columns are
    ignored, whatever their names; an empty table gives no rows.  A very long text is one
    row of pass one and one piece per window after it.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        content = f.read()
    encoder(content)
    arrow_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    table = written(encoded(base, content, end_id), "pack")
    placed = table.join(F.broadcast(places(table)), "part").withColumn("at", F.col("at") + F.col("first"))
    return cut(placed, window, with_ids).withColumnRenamed("id", id_col)


def sequences(pieces: DataFrame, pad_id: int, window: int = WINDOW) -> DataFrame:
    """Pieces with ids -> (sequence_id, length, tokens): at most ``window`` pieces make a sequence.

    A sequence that isn't full is padded to the window with ``pad_id``,
    except when its length is a power of two.
    """
    by_offset = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(F.flatten(by_offset["ids"]).alias("tokens"))
    n = F.size("tokens")
    missing = F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(F.greatest(F.lit(window) - n, F.lit(0)))
    return joined.select("sequence_id", n.cast("long").alias("length"),
                         F.concat("tokens", F.array_repeat(F.lit(pad_id), missing)).alias("tokens"))
