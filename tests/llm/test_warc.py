import gzip
import io
import zlib
from base64 import b32encode
from hashlib import sha1

import pytest

from tramlake.llm import warc as R

ROWS = [
    (5, "http://a/", "<p>é</p>"), (3, "http://b/", "<p>é</p>"), (9, "http://c c\n/", "<p>é</p>"), (1, None, None), (2, "u", ""), (7, "x", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"),
    (8, "y", "big " * 5000), (3, "http://b/", "<p>é</p>"), (None, "n", "nobody"), (None, "m", "<p>é</p>"), (-4, "neg", "big " * 5000),
]


def brute(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    out = []
    for page_id, _, html in rows:
        data, to = (html or "").encode(), first.get(html or "")
        revisit = to is not None and to != page_id
        out.append((page_id, len(data), b32encode(sha1(data).digest()).decode(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("file_bytes", [R.FILE_BYTES, 600])
def test_round_trip(spark, tmp_path, file_bytes):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    raw = R.cut(R.write_monolithic(R.decided(pages), f"file:{tmp_path}/raw", file_bytes))
    manifest = R.cut(R.normalise(raw, f"file:{tmp_path}"))
    assert sum(r.records for r in raw.collect()) == sum(r.records for r in manifest.collect()) == len(ROWS)
    assert sorted((tuple(r) for r in R.read_records(manifest).collect()), key=repr) == brute(ROWS)
    for r in manifest.collect():
        data = open(r.path.removeprefix("file:"), "rb").read()
        for line in open(r["index"].removeprefix("file:")):
            at, length, name = line.split("\t")
            one = zlib.decompress(data[int(at) : int(at) + int(length)], 31)
            assert one.startswith(b"WARC/1.1\r\n") and name.strip().encode() in one and one.endswith(b"\r\n\r\n")


def test_query(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert sorted((tuple(r) for r in R.query(pages).collect()), key=repr) == brute(rows)
    assert R.query(pages.limit(0)).count() == 0


def test_only_normalised_files_stay_in_the_store_of_the_path(spark, tmp_path):
    manifest = R.archive(spark.createDataFrame(ROWS, "page_id long, url string, html string"), str(tmp_path / "a"))
    left = sorted(f"file:{p}" for p in (tmp_path / "a").rglob("*") if p.is_file())
    assert left == sorted(x for r in manifest.collect() for x in (r.path, r["index"]))


def test_join_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(R, "BROADCAST_ROWS", 0)
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    assert sum(r.revisit for r in R.decided(pages).collect()) == sum(x[3] == "revisit" for x in brute(ROWS))


def test_streams_of_one_or_more_members(monkeypatch):
    monkeypatch.setattr(R, "READ_BYTES", 7)
    parts = [R.record(k, f"u{k}", b"x" * k, k, R.digest(b"x" * k), None, False) for k in range(20)]
    for data in (gzip.compress(b"".join(parts)), b"".join(map(gzip.compress, parts))):
        assert [*R.records(R.inflated(io.BytesIO(data)))] == parts
    with pytest.raises(ValueError):
        [*R.records([parts[3][:-9]])]


def test_digest_is_checked():
    data = R.record(1, "u", b"payload", 7, R.digest(b"other"), None, False)
    with pytest.raises(ValueError):
        R.parse(data)
