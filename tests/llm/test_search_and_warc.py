"""Top-k search and WARC archives against plain Python."""

import base64
import gzip
import hashlib
import io

import numpy as np
import pytest

from tierlake.llm import search as N
from tierlake.llm import warc as A


def brute(rows, queries, k):
    def whole(x):
        return None if x is None or any(v is None or not np.isfinite(v) for v in x) else [int(np.floor(256 * np.float64(np.float32(v)))) for v in x]

    kept = [(i, w) for i, x in rows if i is not None and (w := whole(x)) is not None]
    found = []
    for q in queries:
        own = min((w for i, w in kept if i == q), default=None)
        if own is None:
            continue
        scores = sorted((-max(-2**63 + 1, min(2**63 - 1, sum(a * b for a, b in zip(own, w)))), i) for i, w in kept if i != q)
        found += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return sorted(found)


def nearest(spark, rows, k=5, **more):
    table = spark.createDataFrame([(i, x, 0, 0) for i, x in rows], "vec_id long, embedding array<float>, score int, rank int")
    out = N.nearest(table, table.filter("vec_id % 2 = 0"), k, **more).collect()
    return sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in out)


@pytest.mark.parametrize("passes", [1, 3])
def test_search_equals_brute_force(spark, passes):
    pick = np.random.default_rng(passes)
    rows = [(i, [float(v) for v in pick.normal(0, 0.1, 40)]) for i in range(400)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)]  # ties
    before, N.SEEDS, N.DIMENSIONS = (N.SEEDS, N.DIMENSIONS), 50, 8
    try:
        got = nearest(spark, rows, query_bytes=230 * 40 * 8 // passes + 1)
    finally:
        N.SEEDS, N.DIMENSIONS = before
    assert got == brute(rows, [i for i, _ in rows if i % 2 == 0], 5)


def test_search_odd_rows(spark):
    nan, big = float("nan"), 3e30
    rows = [(0, [1.0, 2.0]), (2, None), (4, [1.0, None]), (6, [nan, 1.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (3, [2.0]),
            (8, []), (5, [big, -big]), (10, [big, 1.0]), (None, [1.0, 1.0]), (0, [1.0, 3.0])]
    assert nearest(spark, rows) == brute(rows, [0, 2, 4, 6, 8, 10], 5)
    assert nearest(spark, rows[:1]) == [] and nearest(spark, []) == []


PAGES = [(1, "http://a.example/", "<p>é</p>"), (2, "http://b.example/ x", "<p>é</p>"), (3, None, None), (4, "u", ""),
         (5, "v", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n" * 3), (6, "w", "ü€🙂" * 30_000), (None, "n", "alone"), (7, "t", "<p>é</p>"),
         (8, "r", "twice"), (8, "r", "twice")]


def expected(least):
    def digest(text):
        return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()

    largest = {}
    for key, _, html in PAGES:
        if len((html or "").encode()) >= least and key is not None:
            largest[html or ""] = max(largest.get(html or "", key), key)
    return sorted(((key, len((h or "").encode()), digest(h or ""),
                    "revisit" if largest.get(h or "", key) != key else "response",
                    largest[h or ""] if largest.get(h or "", key) != key else None) for key, _, h in PAGES), key=repr)


@pytest.mark.parametrize("least, chunk, broadcast", [(0, 1 << 18, 10), (0, 1000, -1), (4, 7, 10)])
def test_archives_round_trip(spark, tmp_path, monkeypatch, least, chunk, broadcast):
    monkeypatch.setattr(A, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(A.to_chunks, "__defaults__", (chunk,))
    monkeypatch.setattr(A, "BROADCAST_ROWS", broadcast)
    pages = spark.createDataFrame([(*p, 1, b"") for p in PAGES], "page_id long, url string, html string, chunk int, data binary").repartition(3)
    files = A.write_archives(pages, str(tmp_path), least_bytes=least)
    got = A.archived_records(files).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(least)
    chunks = A.read_archives(files, chunk_bytes=5000).filter("type = 'response' AND id = 6").orderBy("chunk").collect()
    payload = b"".join(r["data"] for r in chunks)
    assert payload.decode() == "ü€🙂" * 30_000 and max(len(r["data"]) for r in chunks) <= 5000
    so_far = hashlib.sha1()
    for r in chunks:
        so_far.update(r["data"])
        assert r["digest"] == base64.b32encode(so_far.digest()).decode()
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".part")]


def test_archive_bytes(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a.example/", "<p>é</p>")], "page_id long, url string, html string")
    path = A.write_archives(pages, str(tmp_path)).first()["path"]
    text = gzip.decompress(open(path, "rb").read()).decode()
    head, http, payload = text.split("\r\n\r\n")[:3]
    assert head.startswith("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:1>")
    assert f"Content-Length: {len((http + '\r\n\r\n' + payload).encode())}" in head and payload == "<p>é</p>"
    assert text.endswith(payload + "\r\n\r\n")


def test_files_roll_and_empty_tables_give_none(spark, tmp_path):
    pages = spark.range(20).selectExpr("id AS page_id", "'u' AS url", "repeat(cast(id AS string), 5000) AS html").coalesce(1)
    files = A.write_archives(pages, str(tmp_path), archive_bytes=100)
    assert files.count() > 5 and A.archived_records(files).count() == 20
    none = A.write_archives(pages.limit(0), str(tmp_path))
    assert none.count() == 0 and A.archived_records(none).count() == 0


def test_damaged_archives_are_errors():
    digest = base64.b32encode(hashlib.sha1(b"other").digest()).decode()
    record = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:1>\r\nWARC-Target-URI: u\r\n"
              f"WARC-Payload-Digest: sha1:{digest}\r\nContent-Length: 31\r\n\r\n"
              "HTTP/1.1 200\r\nContent-Length: 4\r\n\r\n").encode()
    whole = record.replace(b"Content-Length: 31", b"Content-Length: %d" % (len(b"HTTP/1.1 200\r\nContent-Length: 4\r\n\r\n") + 4)) + b"text\r\n\r\n"
    for bad in (whole, whole[:-6]):
        with pytest.raises(ValueError):
            list(A.record_chunks(io.BytesIO(gzip.compress(bad)), 10))
