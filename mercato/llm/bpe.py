"""Byte-level BPE over a table of distinct words.

Texts are split into words, and a block of documents (some megabytes of
text) is rewritten as the list of its distinct words and, for every word of
the text, the word's rank in that list.  The lists, dealt by a hash of the
word, meet in tasks that encode each distinct word once; the ids go back to
their blocks and are joined to the words by position.  Decoding joins ids
to the pieces of the vocabulary.  Only word lists, id lists and packed
ranks move or are stored, never the texts.

A word is encoded without its context because the split already keeps
merges inside words; strings of special tokens are words of their own.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from mercato.llm.common import arrow_batches, scratch_dir, text_of

# Fixed value: the word pattern of byte-level BPE.
WORDS = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

BLOCK_CHARS = 6 << 20  # characters after which a block of documents is closed
DEAL = 64               # word buckets: tasks that can encode words at the same time, at least
BUCKET_WORDS = 1 << 18  # distinct words a bucket should have, about
BLOCK_ROWS = 2          # blocks in an Arrow batch

BLOCK_SCHEMA = ("block long, ids array<{id}>, words array<int>, ranks binary, buckets binary, "
                "parts array<struct<bucket:int,pack:binary>>")


class Vocabulary:
    """What the split and the decoding need of a tokenizer file."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        pre, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens", [])
        if (spec["model"]["type"] != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel"
                or pre.get("add_prefix_space") or not pre.get("use_regex", True)
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)):
            raise ValueError("only byte-level BPE without normaliser, prefix space or stripped tokens is supported")
        self.special = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        known = spec["model"]["vocab"]
        self.size = max([*known.values(), *(t["id"] for t in added)]) + 1
        # bytes that print stand for themselves, the others for the code points from 256 on
        prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(prints)]
        byte_of = {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}
        self.pieces = [b""] * self.size
        for t, i in known.items():
            self.pieces[i] = bytes(byte_of[c] for c in t)
        for t in added:
            self.pieces[t["id"]] = t["content"].encode()

    def split(self, text: str) -> list[str]:
        if self.special and any(s in text for s in self.special):
            out = []
            for k, part in enumerate(self.special_split.split(text)):
                out += [part] if k % 2 else WORDS.findall(part)
            return out
        return WORDS.findall(text)


@lru_cache(maxsize=2)
def vocabulary(content: str) -> Vocabulary:
    return Vocabulary(content)


def pack_numbers(x: np.ndarray) -> bytes:
    """32-bit numbers as compressed byte planes."""
    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 3)


def unpack_numbers(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(b), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack_lists(lengths: np.ndarray, content: bytes) -> bytes:
    head = pack_numbers(lengths)
    return len(head).to_bytes(4, "little") + head + zstandard.compress(content, 3)


def unpack_lists(b: bytes) -> tuple[np.ndarray, bytes]:
    k = 4 + int.from_bytes(b[:4], "little")
    return unpack_numbers(b[4:k]), zstandard.decompress(b[k:])


def word_buckets(docs: DataFrame) -> int:
    """Buckets for the distinct words of all texts, whose number a sketch over every word estimates."""
    words = docs.select(F.explode(F.split("text", " ")).alias("word")).agg(F.approx_count_distinct("word")).first()[0]
    return max(DEAL, -(-words // BUCKET_WORDS))


def blocks(docs: DataFrame, content: str, deal: int) -> DataFrame:
    """(id, text) -> blocks of documents; see BLOCK_SCHEMA."""
    id_type = docs.schema["id"].dataType.simpleString()
    part_type = pa.list_(pa.struct([("bucket", pa.int32()), ("pack", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, task, number = vocabulary(content), TaskContext.get().partitionId(), 0
        id_array = None

        def close(ids: list, codes: list[np.ndarray], known: dict[str, int]) -> pa.RecordBatch:
            nonlocal number
            every = np.concatenate(codes) if codes else np.empty(0, np.uint32)
            by_use = np.argsort(-np.bincount(every, minlength=len(known)), kind="stable")
            rank = np.empty(len(known), np.uint32)
            rank[by_use] = np.arange(len(known), dtype=np.uint32)
            words = list(known)
            utf8 = [words[c].encode("utf-8", "surrogatepass") for c in by_use.tolist()]
            bucket = np.fromiter((zlib.crc32(w) % deal for w in utf8), np.uint32, len(utf8))
            order = np.argsort(bucket, kind="stable")
            parts, ends = [], np.searchsorted(bucket[order], np.arange(deal + 1))
            for k in np.unique(bucket).tolist():
                mine = [utf8[i] for i in order[ends[k]:ends[k + 1]].tolist()]
                parts.append({"bucket": k, "pack": pack_lists(np.array([len(w) for w in mine], np.uint32), b"".join(mine))})
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + number], pa.int64()), pa.array([ids], pa.list_(id_array)),
                 pa.array([[len(c) for c in codes]], pa.list_(pa.int32())), pa.array([pack_numbers(rank[every])], pa.binary()),
                 pa.array([pack_numbers(bucket)], pa.binary()), pa.array([parts], part_type)],
                names=["block", "ids", "words", "ranks", "buckets", "parts"])

        ids, codes, held = [], [], 0
        known: dict[str, int] = defaultdict(itertools.count().__next__)
        for b in batches:
            id_array = b.column("id").type
            for id_, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
                words = vocab.split(text)
                ids.append(id_)
                codes.append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
                held += len(text)
                if held >= BLOCK_CHARS:
                    yield close(ids, codes, known)
                    ids, codes, held, known = [], [], 0, defaultdict(itertools.count().__next__)
                    pa.default_memory_pool().release_unused()
        if ids:
            yield close(ids, codes, known)

    return docs.select("id", "text").mapInArrow(run, BLOCK_SCHEMA.format(id=id_type))


def encoded_words(parts: DataFrame, content: str) -> DataFrame:
    """(block, bucket, pack of words), a bucket's rows together -> (block, bucket, pack of ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, bucket = Tokenizer.from_str(content), None
        table: dict[bytes, np.ndarray] = {}
        for b in batches:
            packs = []
            for k, pack in zip(b.column("bucket").to_pylist(), b.column("pack").to_pylist()):
                if k != bucket:
                    bucket, table = k, {}
                lengths, joined = unpack_lists(pack)
                ends = np.cumsum(lengths).tolist()
                words = [joined[a:e] for a, e in zip([0, *ends], ends)]
                new = [w for w in words if w not in table]
                for w, e in zip(new, tokenizer.encode_batch_fast([w.decode("utf-8", "surrogatepass") for w in new],
                                                                 add_special_tokens=False)):
                    table[w] = np.array(e.ids, np.uint32)
                ids = [table[w] for w in words]
                packs.append(pack_lists(np.fromiter(map(len, ids), np.uint32, len(ids)),
                                        pack_numbers(np.concatenate(ids) if ids else np.empty(0, np.uint32))))
            yield pa.RecordBatch.from_arrays([b.column("block"), b.column("bucket"), pa.array(packs, pa.binary())],
                                             names=["block", "bucket", "pack"])

    return parts.mapInArrow(run, "block long, bucket int, pack binary")


def _lists(values: pa.Array, ids: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """For each list of ids (ending at ``ends``) the joined values of its ids."""
    flat = values.take(pa.array(ids)).cast(pa.large_binary())
    _, off, data = flat.buffers()
    at = np.frombuffer(off, np.int64)[flat.offset:flat.offset + len(flat) + 1]
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(at[np.concatenate([[0], ends])]), data])


def assembled(joined: DataFrame, content: str, id_type: str, with_ids: bool) -> DataFrame:
    """Blocks with the id packs of their words -> one row per document."""
    schema = f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(content)
        pieces = pa.array(vocab.pieces, pa.large_binary())
        decimals = pa.array([b"%d," % i for i in range(vocab.size)], pa.large_binary())
        for b in batches:
            for r in range(b.num_rows):
                words = np.array(b.column("words")[r].as_py(), np.int64)
                bucket = unpack_numbers(b.column("buckets")[r].as_py())
                packs = sorted((p["bucket"], p["pack"]) for p in b.column("packs")[r].as_py())
                lengths, ids = [], []
                for _, pack in packs:
                    n, joined_ids = unpack_lists(pack)
                    lengths.append(n)
                    ids.append(unpack_numbers(joined_ids))
                lengths = np.concatenate(lengths).astype(np.int64) if lengths else np.empty(0, np.int64)
                ids = np.concatenate(ids).astype(np.int64) if ids else np.empty(0, np.int64)
                if len(lengths) != len(bucket):
                    raise ValueError("a block has lost words")
                ends = np.cumsum(lengths)
                # packs hold a bucket's words by rank, so a stable sort by bucket pairs them with the ranks
                entry = np.empty(len(bucket), np.int64)
                entry[np.argsort(bucket, kind="stable")] = np.arange(len(bucket))
                text = entry[unpack_numbers(b.column("ranks")[r].as_py())] if len(bucket) else np.empty(0, np.int64)
                at = np.concatenate([[0], np.cumsum(words)])
                upto = np.concatenate([[0], np.cumsum(lengths[text])])[at]
                digests = []
                for values, cut in ((decimals, 1), (pieces, 0)):
                    run_ = _lists(values, ids, ends).take(pa.array(text))
                    _, off, data = run_.buffers()
                    off = np.frombuffer(off, np.int64)[run_.offset:run_.offset + len(run_) + 1][at].tolist()
                    view = memoryview(data) if data is not None else memoryview(b"")
                    digests.append([hashlib.sha256(view[s:max(s, e - cut)]).hexdigest() for s, e in zip(off, off[1:])])
                cols = [b.column("ids")[r].values, pa.array(np.diff(upto)), *(pa.array(d, pa.string()) for d in digests)]
                if with_ids:
                    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends])), pa.array(ids.astype(np.int32)))
                    flat = lists.take(pa.array(text)).flatten()
                    cols.append(pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), flat))
                out = pa.RecordBatch.from_arrays(cols, names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(cols)])
                step = 512 if with_ids else 8192
                for s in range(0, out.num_rows, step):
                    yield out.slice(s, step)
                del cols, out, run_, data, view, text, ids
                pa.default_memory_pool().release_unused()

    return joined.select("ids", "words", "ranks", "buckets", "packs").mapInArrow(run, schema)


def encode(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False, deal: int | None = None) -> DataFrame:
    """Encode and decode every text with a byte-level BPE tokenizer file.

    Returns one row per input row: id, n_tokens, ids_sha256 (of the decimal
    ids joined by commas), decoded_sha256 (of the text decoded from the ids)
    and, with ``with_ids``, the ids.  Special strings in a text become their
    tokens; none are added.  A null text counts as empty and has no tokens.
    Rows are encoded one by one, so repeated rows and null ids need no care;
    an empty table gives an empty result; other columns are ignored.  The
    blocks are a bucketed table in the shared folder, so the join that
    brings the ids back moves the id lists alone.  ``deal`` is the number of
    word buckets; by default it follows the number of distinct words, so
    that the words of one task stay bounded.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        content = f.read()
    vocabulary(content)
    arrow_batches(spark)
    base = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    id_type = base.schema["id"].dataType.simpleString()
    name = f"llm_bpe_{uuid.uuid4().hex}"
    (blocks(base, content, deal or word_buckets(base)).write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block")
     .option("path", scratch_dir(spark, "bpe")).option("compression", "zstd").format("parquet").saveAsTable(name))
    table = spark.table(name)
    arrow_batches(spark, BLOCK_ROWS)  # from here on a row is a block, or the words of one
    parts = (table.select("block", F.explode("parts").alias("p")).select("block", "p.bucket", "p.pack")
             .repartition("bucket").sortWithinPartitions("bucket"))
    packs = encoded_words(parts, content).groupBy("block").agg(
        F.collect_list(F.struct("bucket", "pack")).alias("packs"))
    joined = (table.select("block", "ids", "words", "ranks", "buckets").join(packs, "block", "left")
              .withColumn("packs", F.coalesce("packs", F.array().cast("array<struct<bucket:int,pack:binary>>"))))
    return assembled(joined, content, id_type, with_ids).withColumnRenamed("id", id_col)
