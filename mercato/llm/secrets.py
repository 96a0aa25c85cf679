"""Secret scan with corpus-wide ownership frequency.

Every text is scanned for three kinds of credentials (assignments, access
keys, long hexadecimal strings) and for other random-looking tokens.  The
hashes of all candidates are counted over the whole corpus by distinct
repositories and owners.  A value that many owners or many repositories
hold is an example copied around; one that few owners hold in few
repositories looks live.  Random-looking tokens
are reported (kind ``owned``) only when they look live; the three base
kinds are always reported, with the number that look live beside them.
Only hashes of values leave the scan.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mercato.llm.common import arrow_batches, text_of, written

# The base kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run is matched from its start, so shorter runs drop out
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
MIN_ENTROPY = 3.0  # bits a character
MAX_OWNERS = 2     # a value held by more owners is a copied example
MAX_REPOSITORIES = 3  # so is one in more repositories, as in all four languages of one source

SCAN_SCHEMA = ("id {id}, owner string, repository string, n_assign long, n_access long, n_hex long, "
               "base_sha256 string, found array<struct<start:long,kind:int,end:long,hash:string>>")


def entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the base kinds, ordered by start and kind."""
    out = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def random_tokens(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Random-looking tokens outside the base spans.

    Tokens and spans both come by start, so one walk along the spans serves
    all tokens; ``reach`` is the largest end of the spans passed."""
    out, k, reach = [], 0, 0
    for m in TOKEN.finditer(text):
        while k < len(taken) and taken[k][0] < m.end():
            reach = max(reach, taken[k][2])
            k += 1
        v = m[0]
        if (reach <= m.start() and any(c.isdigit() for c in v) and any(c.isalpha() for c in v) and entropy(v) >= MIN_ENTROPY):
            out.append((m.start(), 3, m.end(), v))
    return out


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, *_ in spans)


def scan(docs: DataFrame, id_type: str) -> DataFrame:
    """(id, owner, repository, text) -> candidates per document; see SCAN_SCHEMA."""
    arrow_batches(docs.sparkSession)
    found_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()),
                                     ("hash", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, digests, found = [[], [], []], [], []
            for text in b.column("text").to_pylist():
                base = base_spans(text)
                for k in range(3):
                    counts[k].append(sum(s[1] == k for s in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                found.append([{"start": s, "kind": k, "end": e, "hash": hashlib.sha256(v.encode()).hexdigest()}
                              for s, k, e, v in base + random_tokens(text, base)])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("owner"), b.column("repository"), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array(digests, pa.string()), pa.array(found, found_type)],
                names=["id", "owner", "repository", "n_assign", "n_access", "n_hex", "base_sha256", "found"])

    return docs.select("id", "owner", "repository", "text").mapInArrow(run, SCAN_SCHEMA.format(id=id_type))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owner, repository) occurrences -> distinct owners and repositories of each hash."""
    pairs = found.select("hash", "owner", "repository").distinct()
    return pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories")).groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repository_cols: tuple[str, ...] = ("source", "lang"), max_owners: int = MAX_OWNERS,
                 max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """Secrets of every document, with ownership over the whole corpus.

    Returns one row per input row: id, n_assign, n_access, n_hex,
    base_sha256, spans (kind:start:end of every span by start, then kind;
    code points, end exclusive; empty when there is none), n_live (spans whose
    value at most ``max_owners`` owners hold in at most ``max_repositories``
    repositories), n_copied (the other spans), span_owners and
    span_repositories (counts of each span's value, in the order of spans).
    Null text is empty; null owners and repositories are one owner
    and one repository.  Repeated rows are separate documents of one owner.
    An empty table gives an empty result.  Other columns are ignored.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), part(owner_col).alias("owner"),
                       F.to_json(F.array(*[part(c) for c in repository_cols])).alias("repository"),
                       text_of(text_col).alias("text"))
    id_type = base.schema["id"].dataType.simpleString()
    scanned = written(scan(base, id_type).withColumn("row", F.monotonically_increasing_id()), "secrets")
    found = scanned.select("row", "owner", "repository", F.explode("found").alias("s")).select(
        "row", "owner", "repository", "s.*")
    # written, so that the join reads two plain shuffles and the rows of a hot value can be split
    verdicts = written(ownership(found).withColumn(
        "live", (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)), "verdicts")
    marks = (found.join(verdicts, "hash").groupBy("row")
             .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live", "owners", "repositories"))).alias("marks")))
    kind = lambda m: F.element_at(F.array(*map(F.lit, KINDS)), m["kind"] + 1)
    none = F.array().cast("array<struct<start:long,kind:int,end:long,live:boolean,owners:long,repositories:long>>")
    shown = F.filter(F.coalesce("marks", none), lambda m: (m["kind"] < 3) | m["live"])
    out = scanned.drop("found").join(marks, "row", "left").withColumn("shown", shown)
    return out.select(
        F.col("id").alias(id_col), "n_assign", "n_access", "n_hex", "base_sha256",
        F.array_join(F.transform("shown", lambda m: F.concat_ws(":", kind(m), m["start"].cast("string"),
                                                                m["end"].cast("string"))), ",").alias("spans"),
        F.size(F.filter("shown", lambda m: m["live"])).cast("long").alias("n_live"),
        F.size(F.filter("shown", lambda m: ~m["live"])).cast("long").alias("n_copied"),
        F.col("shown.owners").alias("span_owners"), F.col("shown.repositories").alias("span_repositories"))
