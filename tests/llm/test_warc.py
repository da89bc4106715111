"""WARC (11): pages written and read back, archives of others, damaged archives."""

import base64
import glob
import gzip
import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from retailstar.llm import warc as A


def brute(rows, min_bytes=0):
    """rows of (page_id, payload text or None)."""
    by = defaultdict(list)
    for i, t in rows:
        by[(t or "").encode()].append(i)
    out = []
    for p, ids in by.items():
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        ids = sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)
        for k, i in enumerate(ids):
            alone = k == 0 or len(p) < min_bytes
            out.append((i, len(p), digest, "response" if alone else "revisit", None if alone else ids[0]))
    return sorted(out, key=repr)


COLS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def got(df):
    assert df.where("NOT intact").count() == 0
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=repr)


def test_whole_table(spark):
    df = A.query(spark, "/root/testdata/sf0.01")
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html").collect()
    assert sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=repr) == brute([tuple(r) for r in rows])


def odd_rows():
    long = "".join(chr(0x61 + (i * i) % 26) + ("é" if i % 97 == 0 else "") for i in range(30_000))
    rows = [(i, f"http://a/{i}", "<p>x\r\n\r\n\0y</p>") for i in range(40)]                 # copies, zero bytes
    rows += [(100, "http://a b\r\nX: 1", long), (101, None, long), (102, "http://c", long + "!")]
    rows += [(200, None, None), (201, "http://e", ""), (None, "http://n", "lone"), (None, None, "<p>x\r\n\r\n\0y</p>")]
    rows += [(300, "http://d", "twice")] * 3 + [(300, "http://d2", "twice"), (301, "http://é/ü", "é" * 500), (302, "u", "WARC/1.1\r\n\r\n")]
    rows += [(400 + i, "http://t", "tiny") for i in range(4)]
    return rows


@pytest.mark.parametrize("min_bytes,chunk", [(0, 1_000), (6, 7_777), (0, 1 << 20)])
def test_odd_pages(spark, tmp_path, monkeypatch, min_bytes, chunk):
    monkeypatch.setattr(A, "PACK_BYTES", 5_000)
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, `a.b` string, key int")
    A.write_archives(df.repartition(5), str(tmp_path / "a"), min_bytes=min_bytes, chunk_bytes=chunk)
    want = brute([(r[0], r[2]) for r in rows], min_bytes)
    back = A.read_archives(spark, str(tmp_path / "a"), 600)
    assert got(back) == want and back.select("record_id").distinct().count() == len(rows)
    # any reader of gzip finds WARC records, one member each
    data = b"".join(gzip.open(f).read() for f in sorted(glob.glob(f"{tmp_path}/a/part-*")))
    assert data.count(b"WARC/1.1\r\nWARC-Type: re") == len(rows) and b"\r\nX: 1" not in data
    # the same archives from another layout of the table
    A.write_archives(df.repartition(1), str(tmp_path / "b"), min_bytes=min_bytes, chunk_bytes=chunk)
    again = A.read_archives(spark, str(tmp_path / "b"))
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, back.collect()), key=repr)


def test_chunk_table_gives_payloads_and_running_digests(spark, tmp_path):
    rows = [(r[0], r[1], r[2]) for r in odd_rows() if r[0] in (100, 102, 201, 301)]
    A.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "a"), chunk_bytes=4_000)
    table = A.read_chunks(spark, str(tmp_path / "a"), 1_500).orderBy("record_id", "segment", "chunk").collect()
    by = defaultdict(list)
    for r in table:
        by[r.record_id].append(r)
        assert len(r.data) <= 1_500
    texts = {i: t.encode() for i, _, t in rows}
    for part in by.values():
        assert b"".join(r.data for r in part) == texts[part[0].page_id]
        sizes = {}
        for r in part:
            piece = b"".join(x.data for x in part if (x.segment, x.chunk) <= (r.segment, r.chunk) and x.segment == r.segment) \
                if r.segment is not None else b"".join(x.data for x in part if x.chunk <= r.chunk)
            assert r.digest == "sha1:" + base64.b32encode(hashlib.sha1(piece).digest()).decode() and r.size == len(piece)
            sizes[r.segment] = r.last
        assert all(sizes.values())


FOREIGN = (b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:1>\r\nContent-Length: 4\r\n\r\ninfo\r\n\r\n"
           b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:2>\r\nWARC-Target-URI: http://x\r\n"
           b"Content-Type: application/http; msgtype=response\r\nContent-Length: 28\r\n\r\nHTTP/1.1 200 OK\r\nA: b\r\n\r\nhi!\r\n\r\n"
           b"WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:3>\r\nWARC-Refers-To: <urn:9>\r\nContent-Length: 0\r\n\r\n\r\n\r\n")


@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_archives_of_others(spark, tmp_path, pack):
    (tmp_path / "x.warc").write_bytes(pack(FOREIGN))
    rows = {r.record_id: r for r in A.read_archives(spark, str(tmp_path)).collect()}
    assert set(rows) == {"<urn:2>", "<urn:3>"}
    assert rows["<urn:2>"].payload_bytes == 3 and rows["<urn:2>"].uri == "http://x" and rows["<urn:2>"].intact
    assert rows["<urn:3>"].payload_bytes is None


def members(rows, chunk=1_000):
    return [list(A.response_members(i, "u", f"k{i}", 0, hashlib.sha1(t).digest(), memoryview(t), chunk, A.DATE)) for i, t in rows]


def test_long_payloads_in_pieces():
    # several MB, in one segment and in many: chunks are bounded, digests those of the whole
    payload = bytes(range(256)) * 20_000
    one, many = members([(1, payload)], 1 << 24)[0], members([(1, payload)], 1 << 18)[0]
    assert len(one) == 1 and len(many) == 20 and all(m[-1] == 0 for m in one + many)
    rows = list(A.chunk_rows(memoryview(b"".join(one)), 100_000, True))
    assert max(len(r["data"]) for r in rows) == 100_000 and b"".join(r["data"] for r in rows) == payload
    assert rows[-1]["last"] and rows[-1]["digest"] == rows[-1]["declared"]
    assert b"".join(r["data"] for r in A.chunk_rows(memoryview(b"".join(many)), 1 << 30, False)) == payload
    assert len(list(A.chunk_rows(memoryview(b"".join(one)), 1 << 20, False))) == 1


def test_members_over_sixteen_megabytes():
    big = A.member(b"a" * (A.MEMBER_BYTES + 10))
    assert big[-1] == 0 and b"".join(A.unpacked(memoryview(big))) == b"a" * (A.MEMBER_BYTES + 10)


def test_damaged_archives(spark, tmp_path):
    whole = b"".join(members([(1, b"x" * 300)])[0])
    for bad in (whole[:-9], FOREIGN[:150], b"no archive\r\n\r\n", FOREIGN + b"WARC/1.0\r\nWARC-Type: x"):
        with pytest.raises(ValueError):
            list(A.chunk_rows(memoryview(bad), 100, True))
    parts = members([(1, b"x" * 3_000)])[0]
    for k, keep in enumerate(([0, 2], [0, 1], [1, 2])):
        (tmp_path / f"{k}").mkdir()
        (tmp_path / f"{k}" / "x").write_bytes(b"".join(parts[i] for i in keep))
        with pytest.raises(Exception, match="segment"):
            A.read_archives(spark, str(tmp_path / f"{k}")).collect()
    # another payload under the same digest is told
    (tmp_path / "y").mkdir()
    (tmp_path / "y" / "x").write_bytes(b"".join(A.response_members(1, "u", "k", 0, b"0" * 20, memoryview(b"abc"), 100, A.DATE)))
    assert [r.intact for r in A.read_archives(spark, str(tmp_path / "y")).collect()] == [False]


def test_empty_table(spark, tmp_path):
    A.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "a"))
    assert A.read_archives(spark, str(tmp_path / "a")).count() == 0


def test_lookup_of_keys_that_many_rows_share(spark):
    rows = spark.range(1_000).select(F.col("id").cast("string").alias("row"), F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("k"))
    table = spark.createDataFrame([("hot", 7), ("other", 8)], "k string, v int")
    out = A.looked_up(rows, "k", "row", 1_000, table)
    assert out.columns == ["row", "k", "v"] and out.count() == 1_000 and out.where("v = 7").count() == 666
