import base64
import glob
import hashlib
import tempfile

import pytest

from mercato.llm import warc as W

ROWS = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2\r\nX: y", "<p>x</p>"), (0, None, "ü" * 10), (3, "http://b", ""),
        (4, "http://b", None), (None, "http://c", "<p>x</p>"), (None, None, "only here"), (5, "u", "z" * 300000),
        (5, "u", "z" * 300000), (6, "h", "a\r\n\r\nb")]


def digest(s):
    return base64.b32encode(hashlib.sha1((s or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x", "y") for r in ROWS],
                                 "page_id long, url string, html string, key string, first string").repartition(2)


@pytest.fixture(scope="module")
def folder(pages):
    path = tempfile.mkdtemp(prefix="warc-") + "/archives"
    W.write_archives(pages, path, archive_bytes=400).collect()
    return path


def test_round_trip(spark, pages, folder):
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in W.read_archives(spark, folder).collect()), key=str)
    first = {}
    for i, _, h in ROWS:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in ROWS:
        f = first.get(h or "")
        revisit = f is not None and i != f
        want.append((i, len((h or "").encode()), digest(h), "revisit" if revisit else "response", f if revisit else None))
    assert got == sorted(want, key=str)
    assert len(glob.glob(folder + "/*.warc.zst")) > 2 and not glob.glob(folder + "/_*")
    payloads = [r.payload for r in W.read_archives(spark, folder, with_payload=True).collect() if r.record_type == "response"]
    assert "ü" * 10 in [p.decode() for p in payloads]


def test_small_payloads_can_stay_responses(spark, pages):
    path = tempfile.mkdtemp(prefix="warc-")
    W.write_archives(pages, path, revisit_from_bytes=100).collect()
    assert {r.page_id for r in W.read_archives(spark, path).collect() if r.record_type == "revisit"} == set()


def test_archive_layout(folder):
    data = open(sorted(glob.glob(folder + "/*.warc.zst"))[0], "rb").read()
    assert int.from_bytes(data[:4], "little") == 0x184D2A5D
    size = int.from_bytes(data[4:8], "little")
    assert data[8 + size:12 + size] == W.ZSTD_MAGIC


def test_empty_table(spark, pages):
    assert W.round_trip(pages.limit(0), tempfile.mkdtemp(prefix="warc-")).collect() == []


@pytest.mark.parametrize("harm", ["flip", "cut", "lead", "tail"])
def test_damage_is_found(spark, folder, harm):
    import os

    path = tempfile.mkdtemp(prefix="warc-")
    source = max(glob.glob(folder + "/*.warc.zst"), key=os.path.getsize)
    data = bytearray(open(source, "rb").read())
    if harm == "flip":
        data[-9] ^= 255
    elif harm == "cut":
        data = data[:-3]
    elif harm == "lead":
        data[0] ^= 1
    else:
        data += b"junk"
    open(path + "/x.warc.zst", "wb").write(bytes(data))
    problems = [r.problem for r in W.read_archives(spark, path, strict=False).collect() if r.problem]
    assert len(problems) == 1
    with pytest.raises(Exception, match="DamagedRecord"):
        W.read_archives(spark, path).collect()


def test_headers_and_lengths_are_validated():
    good = W.record_bytes(7, "http://x", b"hello", None, None, W.bare_digest(b"hello"), False)
    assert W.parse_record(good)["payload"] == b"hello"
    for bad in (good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"hello", b"hallo"), good[:-2],
                good.replace(b"WARC-Date", b"X-Date"), good.replace(b"response", b"metadata", 1),
                good.replace(b"Content-Length: 5", b"Content-Length: 6")):
        with pytest.raises(W.DamagedRecord):
            W.parse_record(bad)
