"""WARC archives: writing captures, reading them back, assembling transactions.

Every page becomes a request, a response and a metadata record; the first and last name the response by
WARC-Concurrent-To. Of responses with equal payloads of ``SMALL`` bytes or more only the one of largest page_id holds the payload,
the others are revisits that refer to it. The archives are written by Spark's text writer with the record
end as its separator, gzip-compressed, ``RECORDS`` records at most in a file.

Reading takes each file as one row, decompresses it as a stream in the task, and follows
the Content-Length of each record, so payloads may hold anything. A file has to fit in a task (Spark's limit for
one value is 2 GB); that is the writer's choice here. A record without a length, or cut short, raises with the file's name. Digests
are computed from the payloads read and compared with the headers. Requests and metadata are
grouped by the record they are concurrent to and joined to the captures: one nested row per capture, and one for
a request or metadata record whose capture is missing.

Defined cases: a null html is an empty payload; a null page_id is less than any other and writes no page_id, and where only rows
with null ids share a payload all of them are responses; a null or odd url is written without line breaks. Of
repeated rows of the largest id one is the response and the others revisit it. An empty table gives no rows. Other columns are not read.
"""

import gzip
import hashlib
import io
import uuid

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.scratch import scratch_dir
from .common import keyed_join, land

SMALL = 1_000
RECORDS = 30_000
DATE = "1970-01-01T00:00:00Z"  # of the capture, where the table has none
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def planned(pages, small=SMALL):
    """(page_id, url, payload, bytes, digest, main, turn): which page of equal payloads is the response."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.sha1(F.col("payload").cast("binary"))})
    mains = rows.filter(F.col("bytes") >= small).groupBy("digest").agg(F.max("page_id").alias("main"), F.count("*").alias("n"))
    rows = keyed_join(rows, land(mains.filter("n > 1").drop("n")), ["digest"])
    # Repeated rows of one id are told apart; rows without an id need not be.
    rows = rows.withColumn("_page", F.coalesce(F.col("page_id").cast("string"), F.uuid()))
    return rows.withColumn("turn", F.row_number().over(Window.partitionBy("_page", "digest").orderBy("url"))).drop("_page")


def _id(*parts):
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _record(kind, record_id, uri, content_type, block, *headers):
    """One record without its end. ``headers`` are columns that may be null."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}") if isinstance(kind, str) else F.concat(F.lit("WARC-Type: "), kind),
             F.concat(F.lit("WARC-Record-ID: "), record_id), F.lit(f"WARC-Date: {DATE}"),
             F.concat(F.lit("WARC-Target-URI: "), uri), *headers, F.lit(f"Content-Type: {content_type}"),
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def write_archives(pages, path, small=SMALL, records=RECORDS):
    """Write the captures of (page_id, url, html) as WARC files under ``path``."""
    rows = planned(pages, small)
    main = F.col("main").isNull() | (F.col("page_id").eqNullSafe(F.col("main")) & (F.col("turn") == 1))
    own = F.when(F.col("page_id").isNull(), F.uuid()).otherwise(F.concat_ws("|", F.col("page_id").cast("string"), "digest", F.col("turn").cast("string")))
    rows = rows.withColumns({"is_main": main, "own": own})
    capture = _id(F.lit("capture"), "own")
    target = _id(F.lit("capture"), F.concat_ws("|", F.col("main").cast("string"), "digest", F.lit("1")))
    uri = F.coalesce(F.regexp_replace("url", r"[\x00-\x20]+", "%20"), F.lit("about:blank"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    revisit = lambda text: F.when(~F.col("is_main"), text)
    response = _record(
        F.when(F.col("is_main"), "response").otherwise("revisit"), capture, uri, "application/http; msgtype=response",
        F.when(F.col("is_main"), F.concat(http, "payload")).otherwise(http),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        revisit(F.concat(F.lit("WARC-Refers-To: "), target)), revisit(F.lit(f"WARC-Profile: {PROFILE}")))
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), capture)
    request = _record("request", _id(F.lit("request"), "own"), uri, "application/http; msgtype=request",
                      F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{END}")), concurrent)
    fields = F.concat_ws("\r\n", F.concat(F.lit("page_id: "), F.col("page_id").cast("string")), F.lit("fetchTimeMs: 0"))
    metadata = _record("metadata", _id(F.lit("metadata"), "own"), uri, "application/warc-fields", fields, concurrent)
    (
        rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
        .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", 3 * (records // 3)).text(path)
    )
    return path


_FIELDS = ("record_id", "type", "concurrent_to", "refers_to", "uri", "http", "payload", "payload_bytes", "payload_digest", "fields")
_SCHEMA = ("record_id string, type string, concurrent_to string, refers_to string, uri string, http string, payload binary, "
           "payload_bytes long, payload_digest string, fields string")


def parse(stream, name, payloads):
    """The records of one WARC stream as tuples of ``_FIELDS``."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: a record begins with {line[:40]!r}")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            key, _, value = line.partition(b":")
            head[key.strip().lower()] = value.strip().decode("utf-8", "replace")
        if not head.get(b"content-length", "").isdigit():
            raise ValueError(f"{name}: a record without a length")
        block = stream.read(int(head[b"content-length"]))
        if len(block) < int(head[b"content-length"]):
            raise ValueError(f"{name}: a record is cut short")
        kind = head.get(b"warc-type", "")
        http = payload = size = digest = fields = None
        if kind in ("response", "revisit", "request"):
            top, _, body = block.partition(b"\r\n\r\n")
            http = top.decode("utf-8", "replace")
            if kind == "response":
                digest, size = hashlib.sha1(body).hexdigest(), len(body)
                stated = head.get(b"warc-payload-digest", "")
                if stated.startswith("sha1:") and len(stated) == 45 and stated[5:].lower() != digest:
                    raise ValueError(f"{name}: a payload does not have its digest {stated}")
                payload = body if payloads else None
            elif kind == "revisit":
                digest = head.get(b"warc-payload-digest", "").removeprefix("sha1:") or None
        elif kind == "metadata":
            fields = block.decode("utf-8", "replace")
        yield (head.get(b"warc-record-id"), kind, head.get(b"warc-concurrent-to"), head.get(b"warc-refers-to"),
               head.get(b"warc-target-uri"), http, payload, size, digest, fields)


def _parse_files(payloads):
    types = [pa.binary() if f == "payload" else pa.int64() if f == "payload_bytes" else pa.string() for f in _FIELDS]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], list(_FIELDS))

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                stream = io.BytesIO(content.as_py())
                if name.endswith(".gz"):
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
                rows, held = [], 0
                for row in parse(stream, name, payloads):
                    rows.append(row)
                    held += 1_000 + len(row[6] or b"")
                    if held > 8 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)
    return run


def read_records(spark, path, payloads=True):
    """Every record of the archives under ``path``; without ``payloads`` their bytes stay behind."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*{.warc,.warc.gz,.txt,.txt.gz}").load(path)
    return files.select("path", "content").mapInArrow(_parse_files(payloads), _SCHEMA)


def assemble(records):
    """One row (capture_id, capture, requests, metadata) per capture."""
    captures = records.filter(F.col("type").isin("response", "revisit"))
    sides = records.filter(F.col("type").isin("request", "metadata")).groupBy(
        F.coalesce("concurrent_to", "record_id").alias("capture_id")).agg(
        F.sort_array(F.collect_list(F.when(F.col("type") == "request", F.struct("record_id", "uri", "http")))).alias("requests"),
        F.sort_array(F.collect_list(F.when(F.col("type") == "metadata", F.struct("record_id", "fields")))).alias("metadata"))
    nested = captures.select(F.col("record_id").alias("capture_id"), F.struct(
        "type", "uri", "http", "payload", "payload_bytes", "payload_digest", "refers_to").alias("capture"))
    return nested.join(sides, "capture_id", "full")


def resolved(captures):
    """``captures`` with page_id from the metadata, and size, digest and page of the payload a revisit refers to."""
    page = F.regexp_extract(F.get("metadata", 0)["fields"], r"(?:^|\r\n)page_id: (-?\d+)", 1)
    whole = land(captures.withColumn("page_id", F.when(page != "", page.cast("long"))))
    aims = whole.filter("capture.type = 'revisit'").select(F.col("capture.refers_to").alias("capture_id")).distinct()
    mains = land(keyed_join(whole, aims, ["capture_id"], "inner").select(
        F.col("capture_id").alias("refers_id"), F.struct(
            F.col("page_id").alias("page"), F.col("capture.payload_bytes").alias("bytes")).alias("main")))
    return keyed_join(whole.withColumn("refers_id", F.col("capture.refers_to")), mains, ["refers_id"]).withColumns({
        "payload_bytes": F.coalesce("capture.payload_bytes", "main.bytes"), "refers_to": F.col("main.page")})


def op3_warc_captures(spark, sf_dir):
    from .common import read_table

    path = f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
    write_archives(read_table(spark, sf_dir, "pages"), path)
    captures = resolved(assemble(read_records(spark, path, payloads=False)))
    return captures.select("page_id", "payload_bytes", F.col("capture.payload_digest").alias("payload_digest"),
                           F.col("capture.type").alias("record_type"), "refers_to")


OP3_SQL = """
with p as (select page_id, coalesce(html, '') as h, sha1(coalesce(html, '')) as d from pages),
r as (
  select *, octet_length(encode(h)) as n, max(page_id) over (partition by d) as m,
         row_number() over (partition by page_id, d) as t from p),
k as (select *, n < 1000 or m is null or (page_id is not distinct from m and t = 1) as main from r)
select page_id, n::bigint as payload_bytes, d as payload_digest, case when main then 'response' else 'revisit' end as record_type,
       case when not main then m end as refers_to
from k
"""
