import base64
import gzip
import hashlib
import io

import duckdb

from arcash.llm import warc as W
from arcash.llm.common import Scratch


def expected(rows):
    top = {}
    for p, _, h in rows:
        if p is not None:
            top[h or ""] = max(top.get(h or "", p), p)
    out, seen = [], set()
    for p, _, h in rows:
        b = (h or "").encode()
        d = base64.b32encode(hashlib.sha1(b).digest()).decode()
        first = p == top.get(h or "") and (p, d) not in seen
        if first:
            seen.add((p, d))
        out.append((p, len(b), d, "response" if first else "revisit", None if first else top[h or ""], True))
    return sorted(out, key=str)


def test_round_trip(spark, tables):
    same = "<p>x</p>"
    rows = [(1, "http://a/1", same), (2, "http://a/2", same), (9, "http://a/9", same), (3, "u", None),
            (4, "u", ""), (5, None, "Ünï\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n日本"), (9, "again", same),
            (6, "two\r\nlines", "WARC/1.1"), (7, "u", "x" * 3_000_000), (None, "u", same), (8, "u", "\x00\x01")]
    got = W.op4_warc(spark, tables(pages=rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)
    assert W.op4_warc(spark, tables(pages=[])).collect() == []


def test_many_archives_and_foreign_reader(spark, tables):
    rows = [(i, f"http://h/{i}", f"page {i % 50} " * (i % 40)) for i in range(400)]
    d = tables(pages=rows)
    s = Scratch(spark, "test")
    manifest = W.write_archives(s, W.plan_records(spark.read.parquet(f"{d}/pages.parquet")), roll_bytes=2000)
    got = manifest.collect()
    assert len(got) > 4 and sum(r.records for r in got) == 1200
    # each record is a gzip member of its own, and Spark's binary reader gives the same rows
    data = open(got[0].path.replace("file:", ""), "rb").read()
    assert gzip.GzipFile(fileobj=io.BytesIO(data)).read(9) == b"WARC/1.1\r" and data.count(b"\x1f\x8b\x08") >= 3
    a = W.read_archives(spark, manifest.select("path")).drop("headers")
    b = W.read_archives(spark, [r.path for r in got]).drop("headers")
    assert a.count() == 1200 and a.exceptAll(b).count() == 0
    s.drop()


def test_assembly_across_archives_and_dangling_records(spark):
    def rec(kind, rid, to=None):
        return (kind, rid, to, "u", None, None, 1, "d", b"x", None)
    rows = [rec("request", "q1", "r1"), rec("metadata", "m1", "r1"), rec("response", "r1"),
            rec("response", "r2"), rec("request", "q3", "gone"), rec("metadata", "m4"), rec("warcinfo", "i")]
    got = {r.capture_id: tuple(x and x.record_id for x in (r.request, r.response, r.metadata))
           for r in W.assemble(spark.createDataFrame(rows, W.RECORD), "content").collect()}
    assert got == {"r1": ("q1", "r1", "m1"), "r2": (None, "r2", None), "gone": ("q3", None, None),
                   "m4": (None, None, "m4")}


def test_same_as_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{d}/pages.parquet'")
    got = W.op4_warc(spark, d)
    want = sorted(con.sql(f"select {', '.join(got.columns)} from ({W.oracle_sql()})").fetchall(), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
