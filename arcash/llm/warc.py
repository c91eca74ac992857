"""WARC archives: write page captures, read them back, assemble transactions (operator 4).

Each capture is a request, a response (or revisit) and a metadata record. Tasks write them as
archives of one gzip member per record into the shared folder; a task's files count only
once its manifest row is written, so a task that is run again leaves nothing doubled. Reading
goes through Spark's binary reader over the archives that the manifest names; archives are
rolled at a size that fits a task. ``assemble`` joins requests, responses and metadata through
their concurrent-to identifiers, whatever archive they lie in, into one nested row per capture,
and a revisit to the response it refers to.

Defined results: a null page is an empty payload; a null page_id is kept as null and is
never the response of a page with an id; of rows that repeat the largest page_id of a payload
one is the response; records of no capture come as captures with null parts; an empty table
gives an empty result; columns besides page_id, url and html play no part.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.llm.common import Scratch, read, ship

ship(__name__)

VERSION = b"WARC/1.1\r\n"
# FIXED VALUE of the WARC 1.1 standard
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"
HEADERS = ("type", "record_id", "concurrent_to", "target_uri", "payload_digest", "refers_to")
COLUMNS = [*HEADERS, "payload_bytes", "payload_sha1", "content", "headers"]
RECORD = "".join(f"{h} string, " for h in HEADERS) + \
    "payload_bytes long, payload_sha1 string, content binary, headers map<string,string>"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: list[tuple[str, str | None]], content: bytes) -> bytes:
    """One record: header lines, block, two line ends. A header value keeps to its line."""
    lines = [f"{k}: {' '.join(str(v).split())}\r\n" for k, v in headers if v is not None]
    head = VERSION + "".join(lines).encode("utf-8", "surrogatepass")
    return head + b"Content-Length: %d\r\n\r\n" % len(content) + content + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def capture_records(page_id, url, html, uid, response_uid, sha1_hex=None) -> Iterator[bytes]:
    """Request, response or revisit, and metadata of one page. A revisit needs only the
    digest of its payload."""
    payload = (html or "").encode("utf-8", "surrogatepass")
    digest = "sha1:" + (sha1_base32(payload) if sha1_hex is None else
                        base64.b32encode(bytes.fromhex(sha1_hex)).decode())
    revisit = uid != response_uid
    capture = f"<urn:uuid:{uid}>"
    common = [("WARC-Date", DATE), ("WARC-Target-URI", url)]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    yield record([("WARC-Type", "request"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                  ("WARC-Concurrent-To", capture), *common,
                  ("Content-Type", "application/http; msgtype=request")],
                 b"GET / HTTP/1.1\r\nAccept: text/html\r\n\r\n")
    yield record([("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", capture),
                  *common, ("WARC-Payload-Digest", digest),
                  ("WARC-Refers-To", f"<urn:uuid:{response_uid}>" if revisit else None),
                  ("WARC-Profile", SAME_PAYLOAD if revisit else None),
                  ("Content-Type", "application/http; msgtype=response")],
                 http if revisit else http + payload)
    fields = "" if page_id is None else f"page-id: {page_id}\r\n"
    yield record([("WARC-Type", "metadata"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                  ("WARC-Concurrent-To", capture), *common,
                  ("Content-Type", "application/warc-fields")], fields.encode())


def open_shared(uri: str, mode: str):
    """A stream on a file of the shared folder, by its scheme."""
    scheme, sep, path = uri.partition(":")
    if not sep or scheme == "file":
        return open("/" + path.lstrip("/") if sep else uri, mode)
    from pyarrow import fs
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_output_stream(path) if "w" in mode else store.open_input_stream(path)


def parse_records(stream) -> Iterator[tuple[dict, bytes]]:
    """(headers, content) of each record of an uncompressed stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            k, _, v = line.decode("utf-8", "surrogatepass").partition(":")
            headers[k.strip().lower()] = v.strip()
        content = stream.read(n := int(headers["content-length"]))
        if len(content) != n:
            raise ValueError("truncated WARC record")
        yield headers, content


def plan_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, uid, response): one row per record set to write.

    The response of a payload is the row of largest page_id; its id is drawn from the digest,
    so revisits name it without a lookup. Only responses carry their page: rows that repeat a
    payload are counted by (payload, page, url) without it, however many there are.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"),
                        F.octet_length(html).alias("size"))
    uid = F.concat_ws("-", *[F.substring("digest", at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    # nulls order first, so a page without an id is the response of none that has one
    best = F.max(F.struct("page_id", "url")).alias("r")
    responses = rows.groupBy("digest", "size").agg(best, F.first("html").alias("html")).select(
        "r.page_id", "r.url", "html", uid.alias("uid"), uid.alias("response"))
    copies = rows.groupBy("digest", "size", "page_id", "url").agg(F.count("*").alias("n"))
    top = copies.groupBy("digest", "size").agg(best)
    first = F.col("page_id").eqNullSafe(F.col("r.page_id")) & F.col("url").eqNullSafe(F.col("r.url"))
    again = copies.join(top, ["digest", "size"]).withColumn("n", F.col("n") - F.when(first, 1).otherwise(0))
    revisits = again.where("n > 0").select(
        "page_id", "url", F.lit(None).cast("string").alias("html"), uid.alias("response"), "digest", "size",
        F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k")).select(
        "page_id", "url", "html", F.expr("uuid()").alias("uid"), "response", "digest")
    return responses.withColumn("digest", F.lit(None).cast("string")).unionByName(revisits)


def write_archives(scratch: Scratch, planned: DataFrame, roll_bytes: int = 16 << 20) -> DataFrame:
    """Write the records as archives of about ``roll_bytes``; their manifest (path, records)."""
    folder = scratch.path("archives")
    jvm = scratch.spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(scratch.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size, count, path = None, 0, 0, None
        for pdf in batches:
            for row in pdf.itertuples(index=False, name=None):
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    out, size, count = open_shared(path, "wb"), 0, 0
                for r in capture_records(*row):
                    data = member(r)
                    out.write(data)
                    size, count = size + len(data), count + 1
                if size >= roll_bytes:
                    out.close()
                    yield pd.DataFrame({"path": [path], "records": [count]})
                    out = None
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [path], "records": [count]})

    rows = planned.select(F.col("page_id").cast("string").alias("id"), "url", "html", "uid", "response", "digest")
    return scratch.cut(rows.mapInPandas(write, "path string, records long"), "manifest")


def read_archives(spark: SparkSession, paths: list[str] | DataFrame) -> DataFrame:
    """One row per record of the archives: its main headers, the length and digest of its
    payload (of an HTTP block, what follows the HTTP headers), all headers and its content.

    ``paths`` may be a table with a column path: archives are then read from the shared
    folder by the tasks that hold their names, and no list passes through the driver.
    """
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import gzip
        for pdf in batches:
            for name, data in zip(pdf["path"], pdf["content"] if "content" in pdf else pdf["path"]):
                raw = open_shared(name, "rb") if data is name else io.BytesIO(data)
                with raw, gzip.GzipFile(fileobj=raw) as stream:
                    rows, held = [], 0
                    for h, content in parse_records(stream):
                        body = content
                        if h.get("content-type", "").startswith("application/http"):
                            body = content.partition(b"\r\n\r\n")[2]
                        rows.append((h.get("warc-type"), h.get("warc-record-id"), h.get("warc-concurrent-to"),
                                     h.get("warc-target-uri"), h.get("warc-payload-digest"),
                                     h.get("warc-refers-to"), len(body), sha1_base32(body), content, h))
                        held += len(content)
                        if held > 4 << 20 or len(rows) >= 2000:
                            yield pd.DataFrame(rows, columns=COLUMNS)
                            rows, held = [], 0
                    if rows:
                        yield pd.DataFrame(rows, columns=COLUMNS)

    source = paths if isinstance(paths, DataFrame) else \
        spark.read.format("binaryFile").load(paths).select("path", "content")
    return source.mapInPandas(parse, RECORD)


def assemble(records: DataFrame, *parts: str) -> DataFrame:
    """One nested row per capture: its request, response (or revisit) and metadata, each with
    the given columns of its record.

    Requests and metadata name their capture in concurrent_to, responses are named by their
    own id; both meet under it by one shuffle. What names a record that is not there becomes
    a capture without a response. Of several requests or metadata records of a capture the
    one of least id counts.
    """
    part = F.struct("record_id", "type", *parts)
    kind = F.col("type")

    def of(*kinds):
        return F.min_by(F.when(kind.isin(*kinds), part), F.when(kind.isin(*kinds), F.col("record_id")))
    return (records.where(kind.isin("request", "response", "revisit", "resource", "metadata"))
            .withColumn("capture_id", F.when(kind.isin("request", "metadata"), F.col("concurrent_to")))
            .withColumn("capture_id", F.coalesce("capture_id", "record_id"))
            .groupBy("capture_id").agg(of("request").alias("request"),
                                       of("response", "revisit", "resource").alias("response"),
                                       of("metadata").alias("metadata")))


def page_captures(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, through archives."""
    scratch = Scratch(spark, "warc")
    manifest = write_archives(scratch, plan_records(pages))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    records = read_archives(spark, manifest.select("path").repartition(tasks, "path"))
    # payloads stay where they were read; only their lengths and digests are shuffled
    small = F.when(F.col("type") == "metadata", F.decode("content", "UTF-8")).alias("fields")
    found = assemble(records.select(*HEADERS, "payload_bytes", "payload_sha1", small),
                     "payload_digest", "refers_to", "payload_bytes", "payload_sha1", "fields")
    page = F.regexp_extract(F.col("metadata.fields"), r"page-id: (-?[0-9]+)", 1)
    found = scratch.cut(found.select(
        "capture_id", F.when(page != "", page.cast("long")).alias("page_id"),
        F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("ref"),
        F.col("response.payload_digest").alias("told"),
        F.struct(F.col("response.payload_bytes").alias("n"), F.col("response.payload_sha1").alias("digest"))
        .alias("body")), "captures")
    first = found.where("record_type = 'response'").select(
        F.col("capture_id").alias("ref"), F.col("page_id").alias("refers_to"), F.col("body").alias("full"))
    same = F.col("told") == F.concat(F.lit("sha1:"), F.col("body.digest"))
    whole_ones = found.where("record_type = 'response'").select(
        "page_id", "body", "record_type", F.lit(None).cast("long").alias("refers_to"), "told")
    revisits = found.where("record_type = 'revisit'").join(first, "ref", "left").select(
        "page_id", F.col("full").alias("body"), "record_type", "refers_to", "told")
    out = scratch.cut(whole_ones.union(revisits).select(
        "page_id", F.col("body.n").alias("payload_bytes"), F.col("body.digest").alias("payload_digest"),
        "record_type", "refers_to", same.alias("digest_verified")), "result")
    scratch.drop("archives", "manifest", "captures")
    return out


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, read back and assembled."""
    return page_captures(spark, read(spark, sf_dir, "pages"))


def oracle_sql() -> str:
    """DuckDB SQL of op4's contract; base32 is spelt out from the digest's bits."""
    return """with p as (select page_id, coalesce(html, '') h from pages),
    d as (select page_id, octet_length(encode(h)) n, sha1(h) x from p),
    m as (select x, max(page_id) top from d group by x)
    select page_id, n::bigint payload_bytes,
      array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + list_sum(list_transform(range(5), lambda b:
          (((instr('0123456789abcdef', x[1 + (5 * i + b) // 4]) - 1) >> (3 - (5 * i + b) % 4)) & 1)
            << (4 - b)))::int, 1)), '') payload_digest,
      case when page_id = top then 'response' else 'revisit' end record_type,
      case when page_id <> top then top end refers_to, true digest_verified
    from d join m using (x)"""
